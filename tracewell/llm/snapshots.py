"""Chat logs: snapshots that a longer log begins with are dropped, the rest rendered.

A conversation is logged again as it grows, so one log is often the beginning of another.
Every turn gets a hash of all turns up to it: two running sums of hashes of (place, role,
text), kept exactly as decimals. A conversation goes when its whole hash is a proper
prefix hash of another (anti-join), or equals that of a conversation with a smaller id.

Turns are in order of ``turn`` (null first), then of their content; turns that repeat in
all columns count once; null role or text counts as empty. Running sums are taken within
parts of ``PART`` turn numbers and carried over parts, so a long conversation is not one
task's work. Rendered conversations come in rows of at most ``PART`` turns, numbered by
``part``. Extra columns are not looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

PART = 256
TEMPLATE = ("<|im_start|>", "\n", "<|im_end|>\n")


def prefixes(turns: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """(conv, place, n, role, text, h1, h2): h1 and h2 stand for the turns up to ``place``."""
    rows = turns.select(F.col(conv).alias("conv"), F.col(turn).alias("turn"), F.coalesce(F.col(role).cast("string"), F.lit("")).alias("role"),
                        F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text")).distinct()
    rows = rows.withColumn("digest", F.sha2(F.concat_ws("\x00", "role", "text"), 256)) \
        .withColumn("cut", F.floor(F.col("turn") / PART))
    # Places: within a part of the conversation, then behind the parts before it.
    order = [F.col("turn").asc_nulls_first(), F.col("role"), F.col("text")]
    inside = Window.partitionBy("conv", "cut")
    rows = rows.withColumn("place", F.row_number().over(inside.orderBy(*order)).cast("long"))
    sizes = rows.groupBy("conv", "cut").agg(F.count("*").alias("size"))
    rows = _carried(rows, sizes, "size", "place")
    hashed = [F.xxhash64(F.lit(seed), "place", "digest").cast("decimal(20,0)") for seed in (1, 2)]
    rows = rows.withColumns({"x1": hashed[0], "x2": hashed[1]})
    sums = rows.groupBy("conv", "cut").agg(*(F.sum(x).cast("decimal(38,0)").alias(f"s{x}") for x in ("x1", "x2")), F.count("*").alias("size"))
    running = inside.orderBy("place").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = rows.withColumns({h: F.sum(x).over(running).cast("decimal(38,0)") for h, x in (("h1", "x1"), ("h2", "x2"))})
    before = Window.partitionBy("conv").orderBy(F.col("cut").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("conv", "cut", *(F.coalesce(F.sum(f"s{x}").over(before), F.lit(0)).cast("decimal(38,0)").alias(f"b{x}") for x in ("x1", "x2")),
                       F.sum("size").over(Window.partitionBy("conv")).alias("n"))
    rows = _beside(rows, sums)
    return rows.select("conv", "place", "n", "role", "text", *((F.col(h) + F.col(f"b{x}")).cast("decimal(38,0)").alias(h)
                                                              for h, x in (("h1", "x1"), ("h2", "x2"))))


def _carried(rows: DataFrame, sizes: DataFrame, size: str, place: str) -> DataFrame:
    before = Window.partitionBy("conv").orderBy(F.col("cut").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("conv", "cut", F.coalesce(F.sum(size).over(before), F.lit(0)).alias("_offset"))
    return _beside(rows, offsets).withColumn(place, F.col(place) + F.col("_offset")).drop("_offset")


def _beside(rows: DataFrame, parts: DataFrame) -> DataFrame:
    parts = parts.withColumnsRenamed({"conv": "_conv", "cut": "_cut"})
    return rows.join(parts, F.col("conv").eqNullSafe(F.col("_conv")) & F.col("cut").eqNullSafe(F.col("_cut"))).drop("_conv", "_cut")


def maximal(hashed: DataFrame) -> DataFrame:
    """Ids of the conversations that stay, from ``prefixes``."""
    whole = hashed.filter("place = n").groupBy("n", "h1", "h2").agg(F.min("conv").alias("conv"), F.count("*").alias("copies"))
    begun = hashed.filter("place < n").select(F.col("place").alias("n"), "h1", "h2").distinct()
    return whole.join(begun, ["n", "h1", "h2"], "left_anti").select("conv", "copies")


def rendered_turn(template: tuple[str, str, str] = TEMPLATE) -> Column:
    opens, after_role, closes = template
    return F.concat(F.lit(opens), F.col("role"), F.lit(after_role), F.col("text"), F.lit(closes))


def collapse_and_render(turns: DataFrame, conv: str, turn: str, role: str, text: str, template=TEMPLATE) -> DataFrame:
    """(conv, part, n, copies, rendered) of each maximal conversation; ``copies`` counts
    the conversations with exactly its turns."""
    hashed = prefixes(turns, conv, turn, role, text)
    kept = maximal(hashed).withColumnRenamed("conv", "_kept")
    rows = hashed.join(kept, F.col("conv").eqNullSafe(F.col("_kept"))) \
        .withColumns({"part": F.floor((F.col("place") - 1) / PART).cast("long"), "turn": rendered_turn(template)})
    return rows.groupBy("conv", "part", "n", "copies").agg(
        F.array_sort(F.collect_list(F.struct("place", "turn"))).alias("turns")).select(
        "conv", "part", "n", "copies", F.array_join(F.col("turns.turn"), "").alias("rendered"))
