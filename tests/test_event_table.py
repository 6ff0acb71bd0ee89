import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tests.fixtures import spans as S
from tests.test_spans import spans
from tracewell.operators import analytics
from tracewell.operators.accounting import OUTCOMES
from tracewell.plans.exports import EVENT_SCHEMA, event_table, span_events
from tracewell.sinks.writers import write_counted
from tracewell.sources.http import RequestOptions, http_events


def requests(spark, *rows):
    return spark.createDataFrame([(str(i), path, status, ms) for i, (path, status, ms) in enumerate(rows)],
                                 "event_id string, path string, response_status int, duration_ms double").select(
        "*", F.timestamp_seconds(F.lit(1767225600)).alias("ts"), F.lit("get").alias("method"), F.lit("http").alias("scheme"),
        F.array(F.struct(F.lit("user-agent").alias("name"), F.lit("x").alias("value"))).alias("headers"),
        *(F.lit(None).cast("string").alias(c) for c in ("body", "source_address", "response_body", "response_type", "response_encoding", "metrics")))


LOG = (("/a", 200, 1.5), ("/a", 404, 2.5), ("/b", None, None), ("/health", 200, 1.0), ("/private/x", 200, 1.0), ("/c", 399, 0.5))


def test_status_duration_and_reasons(spark):
    options = RequestOptions(exclude_paths=("/private/**",))
    got = http_events(requests(spark, *LOG), options).orderBy("event_id").collect()
    assert [(r["endpoint"], r["status"], r["duration_ms"]) for r in got] == [
        ("/a", "ok", 1.5), ("/a", "error", 2.5), ("/b", None, None), ("/c", "ok", 0.5)]
    every = http_events(requests(spark, *LOG), options, dropped=True).orderBy("event_id").collect()
    assert [r["outcome"] for r in every] == ["http", "http", "http", "health", "path", "http"]
    assert [r["user_agent"] for r in every] == ["x", "x", "x", None, None, "x"]
    none = http_events(requests(spark, *LOG), RequestOptions(rate=0.0), dropped=True)
    assert {r["outcome"] for r in none.collect()} == {"health", "unsampled"}


def test_one_table_is_written_and_counted_in_one_pass(spark, tmp_path):
    reads = spark.sparkContext.accumulator(0)

    def seen(batches):
        for batch in batches:
            reads.add(batch.num_rows)
            yield batch

    log = requests(spark, *LOG)
    events = event_table(span_events(spans(spark, S.CHAT, S.TOOL_CALL, S.NOISE)),
                         http_events(log.mapInArrow(seen, log.schema), RequestOptions(exclude_paths=("/private/**",)), dropped=True))
    assert events.schema.names == T.StructType.fromDDL(EVENT_SCHEMA).names
    counts = write_counted(events, str(tmp_path / "events"))
    assert {k: v for k, v in counts.items() if v} == {"llm": 1, "mcp": 1, "ignored": 1, "http": 4, "health": 1, "path": 1, "received": 9}
    assert set(counts) == {*OUTCOMES, "received"} and reads.value == len(LOG)
    back = spark.read.parquet(str(tmp_path / "events"))
    assert {r["kind"]: r["count"] for r in back.groupBy("kind").count().collect()} == {"llm": 1, "mcp": 1, "http": 4}
    assert back.filter("kind = 'mcp'").first()["args_hash"] is not None


@pytest.mark.parametrize("run_rows", [3, 10 ** 6])
def test_exact_percentile_equals_the_aggregate(spark, run_rows):
    df = spark.range(400).select(F.when(F.col("id") % 3 > 0, F.concat(F.lit("k"), F.col("id") % 4)).alias("k"),
                                 F.when(F.col("id") % 11 > 0, F.pmod(F.xxhash64("id"), F.lit(30)) / 4).alias("v"))
    for fraction in (0.0, 0.5, 0.95, 1.0):
        got = analytics.exact_percentile(df, ["k"], "v", fraction, "p", run_rows=run_rows).collect()
        want = df.groupBy("k").agg(F.percentile("v", fraction).alias("p")).collect()
        assert sorted(map(str, got)) == sorted(map(str, want))
