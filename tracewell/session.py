"""Session settings the jobs rely on."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession

# Repeated JSON keys and repeated attribute keys resolve to the last value, and
# timestamps are UTC everywhere. The JVM does not compile methods of more than 8000 bytes of code;
# a stage that would be one is generated in parts instead (the mapping of spans is such a stage).
# A Python worker holds a batch several times over, as JSON and as objects: batches are small in bytes.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
    "spark.sql.variant.allowDuplicateKeys": "true",
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(2 << 20),
}


def prepare_session(spark: SparkSession) -> SparkSession:
    """Set the runtime SQL options above on ``spark`` and return it."""
    for key, value in RUNTIME_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def checkpoint_location(spark: SparkSession, name: str) -> str:
    """A path for stream state: the cluster's shared checkpoint folder when it
    names one in ``spark.checkpoint.dir``, else a fresh local folder (tests)."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        import uuid

        return f"{shared.rstrip('/')}/{name}-{uuid.uuid4().hex}"
    return f"{tempfile.mkdtemp(prefix=name)}/{name}"


def stored_once(df: DataFrame, name: str) -> DataFrame:
    """``df`` written now to the folder of ``checkpoint_location`` and read back: what is
    read of it more than once is computed once, also when an executor is lost."""
    path = checkpoint_location(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
