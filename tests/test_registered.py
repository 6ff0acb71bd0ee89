import duckdb
import pytest

import __spark_entry__ as entry
from check import TABLES, compare


@pytest.fixture(scope="module")
def con(sf_dir):
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return connection


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_equals_sql(spark, con, sf_dir, name):
    sql = entry.oracle_sql()[name]
    status, n, _, note = compare(spark, con, sf_dir, name, sql)
    assert status == "ok", note
    assert n > 0


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_attributes_are_parsed_once_for_all_extras(spark, sf_dir):
    plan = entry.queries()["structured_extras"](spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("format_string(") == 2
