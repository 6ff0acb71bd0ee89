"""The first k rows of every group in an order, for any k and any size of group.

A window that ranks rows sorts a whole group in one task, unless k is small. Here the last
place that is taken is looked for first: counts of a large group's rows between sampled bounds
show in which run the k-th row lies, that run is divided again while it is large, and only
what is left of it is counted place by place. Rows are then taken by comparing them with that place;
they are neither shuffled nor sorted. Groups of up to ``run_rows`` rows are ranked by a window.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tracewell.operators.timeline import RUN_ROWS, bounds_of, local, place_of, run_of

#: Runs of a key in one round, so that a row meets few bounds however many rows there are: a key of
#: n rows takes log(n / run_rows) / log(ROUND_RUNS) rounds, of which all but the first read little.
ROUND_RUNS = 64


def last_places(placed: DataFrame, k: int, run_rows: int = RUN_ROWS) -> DataFrame | None:
    """(_key, _last, _left, _equal) of the keys of ``placed`` (_key, _place) with more than
    ``k`` and more than ``run_rows`` rows, null when there are none: the place of the k-th
    row, how many rows of that place are still to be taken, and how many there are."""
    counts = placed.groupBy("_key").agg(F.count("*").alias("_n")).filter(F.col("_n") > max(k, run_rows))
    nothing = F.lit(None).cast(placed.schema["_place"].dataType)
    state = local(counts.select("_key", "_n", nothing.alias("_from"), nothing.alias("_to"), F.lit(k).cast("long").alias("_need")))
    if state.isEmpty():
        return None

    def reached() -> DataFrame:
        here = placed.join(F.broadcast(state), "_key")
        return here.filter((F.col("_from").isNull() | (F.col("_place") >= F.col("_from")))
                           & (F.col("_to").isNull() | (F.col("_place") < F.col("_to"))))

    order = Window.partitionBy("_key").orderBy("_run")
    while True:
        bounds = bounds_of(reached().select("_key", "_place"), run_rows, ROUND_RUNS)
        if bounds is None:
            break
        runs = reached().join(F.broadcast(bounds), "_key").withColumn("_run", run_of(F.col("_place"))) \
            .groupBy("_key", "_need", "_to", F.col("_n").alias("_before_n"), "_run") \
            .agg(F.count("*").alias("_n"), F.min("_place").alias("_from"))
        before = F.coalesce(F.sum("_n").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        runs = runs.withColumns({"_before": before, "_to": F.coalesce(F.lead("_from").over(order), F.col("_to"))})
        found = runs.filter((F.col("_before") < F.col("_need")) & (F.col("_need") <= F.col("_before") + F.col("_n")))
        found = local(found.select("_key", "_n", "_from", "_to", (F.col("_need") - F.col("_before")).alias("_need"), "_before_n"))
        # Runs that a bound no longer divides hold few places, however many rows.
        progress = found.filter("_n < _before_n").limit(1).count()
        state = local(state.join(found, "_key", "left_anti").unionByName(found.drop("_before_n")))
        if not progress:
            break
    ranked = reached().groupBy("_key", "_need", "_place").agg(F.count("*").alias("_equal"))
    places = Window.partitionBy("_key").orderBy("_place").rowsBetween(Window.unboundedPreceding, -1)
    ranked = ranked.withColumn("_left", F.col("_need") - F.coalesce(F.sum("_equal").over(places), F.lit(0)))
    last = ranked.filter((F.col("_left") > 0) & (F.col("_left") <= F.col("_equal")))
    return local(last.select("_key", F.col("_place").alias("_last"), "_left", "_equal"))


def first_of_each(df: DataFrame, k: int, keys: Sequence[str], order: Sequence[Column], *, run_rows: int = RUN_ROWS) -> DataFrame:
    """The first ``k`` rows of each group of ``keys`` in ascending ``order``, null first; of
    rows that are equal in it any. ``df`` is read a few times, narrowly, before its rows are, so it
    should be a stored table."""
    rows = df.withColumns({"_key": F.struct(*keys) if keys else F.struct(F.lit(0).alias("all")), "_place": place_of(*order)})
    placed = rows.select("_key", "_place")
    last = last_places(placed, k, run_rows)
    if last is None:
        rank = F.row_number().over(Window.partitionBy("_key").orderBy("_place"))
        return rows.withColumn("_rank", rank).filter(F.col("_rank") <= k).select(*df.columns)
    joined = rows.join(F.broadcast(last), "_key", "left")
    found, place = F.col("_last").isNotNull(), F.col("_place")
    near = joined.filter(~found | (place <= F.col("_last")))
    smaller = placed.groupBy("_key").count().join(F.broadcast(last), "_key", "left_anti").agg(F.max("count")).first()[0] or 0
    if smaller <= k and last.filter("_left < _equal").isEmpty():
        return near.select(*df.columns)
    # Rows below the last place need no rank: they are spread, each alone in its share of the window.
    below = found & (place < F.col("_last"))
    share = F.when(below, F.pmod(F.xxhash64("_place"), F.lit(1 << 20))).otherwise(-1)
    rank = F.row_number().over(Window.partitionBy("_key", "_share").orderBy("_place"))
    ranked = near.withColumn("_share", share).withColumn("_rank", rank)
    return ranked.filter(below | (F.col("_rank") <= F.coalesce("_left", F.lit(k)))).select(*df.columns)
