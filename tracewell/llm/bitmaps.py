"""A bitmap of hashed keys, to send a large table's rows past a join with few of them.

The bitmap has at most ``MOST_BITS`` bits whatever the number of keys, so it can be
broadcast. A bit that is set by chance only sends one more row into the exact join.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: 16 MB. 64 bits for each key up to here; more keys share the bits.
MOST_BITS = 1 << 27
LEAST_BITS = 1 << 16


class KeyBits:
    """Which values of the top bits of a 64-bit hash occur."""

    def __init__(self, words: np.ndarray):
        self.words = words
        self.shift = np.uint64(64 - (int(len(words)) * 64 - 1).bit_length())

    def __contains__(self, hashes):  # pragma: no cover - the array form is meant
        raise TypeError("use hit()")

    def hit(self, hashes: np.ndarray) -> np.ndarray:
        slot = hashes.view(np.uint64) >> self.shift
        return (self.words[(slot >> np.uint64(6)).astype(np.int64)] >> (slot & np.uint64(63)) & np.uint64(1)).astype(bool)


def key_bits(hashes: DataFrame, column: str) -> KeyBits:
    """The bitmap of a table's 64-bit hashes; only its words that are not zero come to
    the driver, never the keys."""
    n = hashes.count()
    bits = 1 << min(MOST_BITS, max(LEAST_BITS, n * 64)).bit_length() - 1
    slot = F.shiftrightunsigned(F.col(column), 64 - (bits - 1).bit_length())
    words = hashes.select(F.shiftrightunsigned(slot, 6).alias("word"), (slot % 64).cast("int").alias("at")) \
        .groupBy("word").agg(F.expr("bit_or(shiftleft(1L, at))").alias("set")).toArrow()
    out = np.zeros(bits // 64, np.uint64)
    out[words.column("word").to_numpy()] = words.column("set").to_numpy().astype(np.int64).view(np.uint64)
    return KeyBits(out)


def probably_in(df: DataFrame, hashed: Column, bits: KeyBits) -> Column:
    """True for every row whose hash is in the bitmap (and few others)."""
    shared = df.sparkSession.sparkContext.broadcast(bits)
    test = F.arrow_udf(lambda h: pa.array(shared.value.hit(h.to_numpy(zero_copy_only=False).astype(np.int64))), "boolean")
    return test(hashed)


def without(df: DataFrame, gone: DataFrame, *on: str) -> DataFrame:
    """The rows of ``df`` whose ``on`` is not in ``gone`` (null equals null). Rows that
    the bitmap clears stay where they are; only the others are shuffled and compared."""
    keys = gone.select(*on).distinct()
    bits = key_bits(keys.select(F.xxhash64(*on).alias("_hash")), "_hash")
    maybe = probably_in(df, F.xxhash64(*on), bits)
    marked = df.withColumn("_maybe", maybe)
    same = [marked[c].eqNullSafe(keys[c]) for c in on]
    rest = marked.filter("_maybe").join(keys, on=_all(same), how="left_anti")
    return marked.filter("not _maybe").unionByName(rest).drop("_maybe")


def _all(conditions: list[Column]) -> Column:
    out = conditions[0]
    for c in conditions[1:]:
        out = out & c
    return out
