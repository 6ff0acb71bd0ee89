import pytest


@pytest.fixture(scope="session")
def rows(spark):
    """Small tables from tuples."""
    return lambda data, schema: spark.createDataFrame(data, schema)
