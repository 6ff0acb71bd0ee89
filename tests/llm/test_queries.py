import duckdb
import pytest

import __spark_entry__ as entry
from check import TABLES, compare
from tracewell.llm.queries import ORACLE


@pytest.fixture(scope="module")
def con(sf_dir):
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return connection


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, con, sf_dir, name):
    status, n, _, note = compare(spark, con, sf_dir, name, ORACLE[name])
    assert status == "ok", note
    assert n > 0


def test_all_operators_and_the_pipeline_are_registered():
    names = entry.queries()
    assert "pipeline" in names
    assert all(any(name.startswith(f"op{n}_") for name in names) for n in range(1, 14))
