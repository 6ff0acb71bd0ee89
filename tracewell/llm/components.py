"""Connected components of an edge table, by alternating large and small stars.

Each round points every node's neighbours at the smallest node near it; the number of
rounds grows with the logarithm of the longest path. A node's edges are never gathered:
a round takes minima and joins them back. Rounds are written to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracewell.llm.shared import written


def components(edges: DataFrame) -> DataFrame:
    """(id, root) for every end of an edge of ``edges`` (a, b): the smallest id that it
    is connected with. Loops and repeated edges are allowed, nulls are not."""
    edges = edges.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    edges, before = written(edges, "edges"), None
    while True:
        n = edges.agg(F.count("*"), F.coalesce(F.bit_xor(F.xxhash64("u", "v")), F.lit(0))).first()
        if n[0] == 0 or tuple(n) == before:
            break
        before = tuple(n)
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        near = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.filter("v > u").join(near, "u").select(F.col("v").alias("u"), F.col("m").alias("v")) \
            .filter("u <> v").distinct()
        near = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(near, "u")
        small = joined.filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            near.select("u", F.col("m").alias("v"))).distinct()
        edges = written(small, "edges")
    return edges.select(F.col("u").alias("id"), F.col("v").alias("root")).unionByName(
        edges.select(F.col("v").alias("id"), F.col("v").alias("root")).distinct())
