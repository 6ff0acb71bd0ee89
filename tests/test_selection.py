import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tracewell.operators import accounting, analytics
from tracewell.operators.selection import ROUND_RUNS, first_of_each, last_places
from tracewell.operators.timeline import bounds_of, place_of


@pytest.fixture(scope="module")
def crowd(spark):
    """5000 rows: one group holds most, many share a value, some have none."""
    key = F.when(F.col("id") % 5 > 0, "hot").when(F.col("id") % 50 == 0, F.lit(None)).otherwise(F.concat(F.lit("g"), F.col("id") % 7))
    return spark.range(5000).select(
        "id", key.alias("g"), F.when(F.col("id") % 97 > 0, F.pmod(F.xxhash64("id"), F.lit(40))).alias("v")).cache()


def brute(rows, k, keys, order):
    rank = F.row_number().over(Window.partitionBy(*[F.coalesce(F.col(c), F.lit("-")) for c in keys]).orderBy(*order))
    return rows.withColumn("r", rank).filter(F.col("r") <= k).drop("r")


@pytest.mark.parametrize("k", [1, 2100, 4999, 6000])
@pytest.mark.parametrize("keys", [["g"], []])
def test_equals_ranking_by_a_window(crowd, k, keys):
    got = first_of_each(crowd, k, keys, [F.col("v"), F.col("id")], run_rows=200)
    want = brute(crowd, k, keys, ["v", "id"])
    assert sorted(r["id"] for r in got.collect()) == sorted(r["id"] for r in want.collect())
    assert got.columns == crowd.columns


def test_ties_at_the_border_are_filled_up_to_k(crowd):
    got = first_of_each(crowd, 1000, ["g"], [F.col("v")], run_rows=100)
    counts = {r["g"]: r["count"] for r in got.groupBy("g").count().collect()}
    assert counts["hot"] == 1000 and max(counts.values()) == 1000
    values = sorted((r["v"] is not None, r["v"] or 0) for r in got.filter("g = 'hot'").collect())
    want = sorted((r["v"] is not None, r["v"] or 0) for r in crowd.filter("g = 'hot'").collect())[:1000]
    assert values == want
    same = crowd.withColumn("v", F.lit(1))
    assert first_of_each(same, 700, [], [F.col("v")], run_rows=50).count() == 700
    assert first_of_each(crowd.filter("id < 0"), 700, [], [F.col("v")], run_rows=50).count() == 0


def test_a_large_group_is_neither_sorted_nor_shuffled(crowd):
    rows = crowd.filter("g = 'hot'")
    plan = first_of_each(rows, 2100, [], [F.col("v"), F.col("id")], run_rows=200)._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "Sort" not in plan and "hashpartitioning" not in plan
    placed = rows.select(F.struct(F.lit(0).alias("all")).alias("_key"), place_of(F.col("v"), F.col("id")).alias("_place"))
    last = last_places(placed, 2100, 200).collect()
    assert [(r["_left"], r["_equal"]) for r in last] == [(1, 1)]


def test_admission_and_top_consumers_above_a_thousand(spark, crowd):
    calls = crowd.select("id", F.timestamp_seconds(F.lit(1767225600) + F.coalesce("v", F.lit(0))).alias("ts"),
                         F.concat(F.lit("u"), F.col("id") % 2500).alias("user_id"), F.lit("p").alias("provider"),
                         F.lit("ok").alias("status"), "v", F.lit("x").alias("event_id"))
    got = accounting.admit_bounded(calls, 1500, "1 day", tie="id", run_rows=300)
    want = [r["id"] for r in calls.orderBy("ts", "id").limit(1500).collect()]
    assert sorted(r["id"] for r in got.collect()) == sorted(want)
    top = analytics.top_consumers(calls, 1200, by=("provider",), tokens="v", run_rows=300).orderBy("rank").collect()
    used = calls.groupBy("user_id").agg(F.sum("v").alias("t")).orderBy(F.col("t").desc(), "user_id").limit(1200).collect()
    assert [r["user_id"] for r in top] == [r["user_id"] for r in used]
    assert [r["rank"] for r in top] == list(range(1, 1201))


def test_a_row_meets_few_bounds_in_a_round(spark):
    placed = spark.range(20_000).select(F.struct(F.lit(0).alias("all")).alias("_key"), place_of(F.pmod(F.xxhash64("id"), F.lit(10**9))).alias("_place"))
    bounds = bounds_of(placed, 5, ROUND_RUNS).select(F.size(F.flatten("_bounds")).alias("n")).first()["n"]
    assert ROUND_RUNS // 2 < bounds < ROUND_RUNS
    last = last_places(placed, 7777, 5).collect()
    assert [r["_last"]["p0"] for r in last] == [placed.orderBy("_place").limit(7777).agg(F.max("_place.p0")).first()[0]]
