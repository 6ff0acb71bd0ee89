"""What the operators of this subpackage share: folders, Arrow text, fold numbers."""

from __future__ import annotations

import ctypes
import functools
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Texts are handled in slices of about this many bytes, so that the arrays made
#: from a slice stay small whatever the size of an Arrow batch.
SLICE_BYTES = 2 << 20


#: Rows and bytes that Spark hands to Python at once: long texts come in small batches. Written
#: tables of whole texts get small row groups, which a writing task holds in memory.
BATCHES = {"spark.sql.execution.arrow.maxRecordsPerBatch": "1000", "spark.sql.execution.arrow.maxBytesPerBatch": str(4 << 20),
           "parquet.block.size": str(16 << 20)}


def bounded_batches(spark: SparkSession) -> SparkSession:
    """Sets BATCHES, which bound the memory of every task that runs Python."""
    for key, value in BATCHES.items():
        spark.conf.set(key, value)
    return spark


def shared_folder(spark: SparkSession, name: str) -> str:
    """A fresh path below ``spark.checkpoint.dir``, the folder all executors share.

    Only where that is unset (tests on one machine) a local folder is used.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or tempfile.gettempdir()
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str, *partition_by: str) -> DataFrame:
    """``df`` written once to the shared folder and read back: its rows are not
    computed again when an executor is lost, and the plan starts anew."""
    spark = df.sparkSession
    path = shared_folder(spark, name)
    df.write.partitionBy(*partition_by).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def fold(doc_id: str | Column, parts: int) -> Column:
    """crc32 of the id as text, modulo ``parts``; a null id counts as empty text."""
    column = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.crc32(F.coalesce(column.cast("string"), F.lit(""))) % parts


def lower_ascii(text: pa.Array) -> pa.Array:
    """A-Z in lower case, every other character as it is; null becomes empty."""
    data, offsets = text_bytes(text)
    table = np.arange(256, dtype=np.uint8)
    table[65:91] += 32
    out = table[data]
    return pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(offsets) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(out)])


def text_bytes(text: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all texts end to end, and where each starts (one more
    entry than texts). Null counts as empty."""
    if isinstance(text, pa.ChunkedArray):
        text = text.combine_chunks()
    if text.null_count:
        text = pc.fill_null(text, b"" if pa.types.is_binary(text.type) or pa.types.is_large_binary(text.type) else "")
    wide = pa.types.is_large_string(text.type) or pa.types.is_large_binary(text.type)
    _, offsets, data = text.buffers()
    starts = np.frombuffer(offsets, np.int64 if wide else np.int32)[text.offset:text.offset + len(text) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8)[starts[0]:starts[-1]] if data is not None else np.zeros(0, np.uint8)
    return raw, starts - starts[0]


def slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows whose texts have about ``limit`` bytes together; a
    longer text makes a run of its own."""
    sizes = pc.binary_length(batch.column(column)).fill_null(0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(sizes, dtype=np.int64)
    start = 0
    while start < batch.num_rows:
        base = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, base + limit, "right")))
        yield batch.slice(start, stop - start)
        start = stop


def spread(n: int, target: int) -> int:
    """How many groups hold ``n`` things at about ``target`` each."""
    return max(1, -(-n // target))


def release() -> None:
    """Gives memory that this process has freed back to the machine. Python workers live
    on after a task, and what they keep is missing beside the next task."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def tidy(function: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]):
    """For functions of ``mapInArrow``: releases memory when a task ends."""
    @functools.wraps(function)
    def run(batches):
        try:
            yield from function(batches)
        finally:
            release()

    return run
