import os

import pytest
from pyspark.sql import functions as F

from tests.fixtures import spans as S
from tracewell.plans import sample_tables
from tracewell.plans.exports import span_events, stored
from tracewell.sources import mcp, otlp
from tracewell.sinks import writers
from tracewell.streaming import jobs


@pytest.fixture()
def stream(spark, sf_dir, tmp_path, monkeypatch):
    """The call events as a stream of several files, in time order."""
    batch = sample_tables.calls(spark, sf_dir)
    for part in range(3):  # one file after the other, so that they arrive in time order
        lo, hi = (f"timestamp'2024-01-{d:02d}'" for d in (1 + 10 * part, 11 + 10 * part))
        batch.filter(f"ts >= {lo} and ts < {hi}").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    return spark.readStream.schema(batch.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))


def run(spark, df, tmp_path):
    query = jobs.stream_job(df, lambda d: d, str(tmp_path / "out"), checkpoint=str(tmp_path / "cp"), trigger=jobs.ONCE)
    query.awaitTermination(90)
    return spark.read.parquet(str(tmp_path / "out"))


def rows(df, *cols):
    return sorted(map(tuple, df.select(*cols).collect()))


def closed(df, spark, sf_dir, end):
    """Rows of the batch twin that a watermark of 10 minutes has closed."""
    last = sample_tables.calls(spark, sf_dir).agg(F.max("ts") - F.expr("interval 10 minutes")).first()[0]
    return df.filter(end <= F.lit(last))


def test_windowed_tokens(spark, stream, sf_dir, tmp_path):
    got = run(spark, jobs.windowed_tokens(stream, "1 hour", ["provider"]), tmp_path)
    want = jobs.windowed_tokens(sample_tables.calls(spark, sf_dir), "1 hour", ["provider"])
    want = closed(want, spark, sf_dir, F.col("window_start") + F.expr("interval 1 hour"))
    assert rows(got, "window_start", "provider", "calls", "tokens") == rows(want, "window_start", "provider", "calls", "tokens")


def test_sessions_and_loops(spark, stream, sf_dir, tmp_path):
    got = run(spark, jobs.session_totals(stream, "12 hours"), tmp_path)
    want = closed(jobs.session_totals(sample_tables.calls(spark, sf_dir), "12 hours"), spark, sf_dir, F.col("session_end"))
    cols = ("session_start", "session_end", "user_id", "calls")
    found, expected = set(rows(got, *cols)), set(rows(want, *cols))
    assert found <= expected and len(found) > 0.95 * len(expected)
    loops = run(spark, jobs.windowed_loops(stream, 2, "6 hours", ["user_id"]), tmp_path / "loops")
    assert loops.count() > 0 and loops.agg(F.min("calls")).first()[0] == 2


def test_correlated_windows(spark, stream, sf_dir, tmp_path):
    got = run(spark, jobs.correlate_windows(stream.filter("kind = 'llm'"), stream.filter("kind = 'mcp'"), "user_id", "6 hours"),
              tmp_path)
    batch = sample_tables.calls(spark, sf_dir)
    want = jobs.correlate_windows(batch.filter("kind = 'llm'"), batch.filter("kind = 'mcp'"), "user_id", "6 hours")
    cols = ("window_start", "user_id", "llm_calls", "mcp_calls")
    found, expected = set(rows(got, *cols)), set(rows(want, *cols))
    assert found <= expected and len(found) > 0.9 * len(expected)


def test_dedup_and_reports(spark, sf_dir, tmp_path):
    batch = sample_tables.table(spark, sf_dir, "events").select(
        "ts", F.col("event_id").cast("string").alias("trace_id"), F.lit("s").alias("span_id"))
    batch.unionByName(batch).repartitionByRange(3, "ts").write.parquet(str(tmp_path / "in"))
    source = spark.readStream.schema(batch.schema).parquet(str(tmp_path / "in"))
    assert run(spark, jobs.dedup_spans(source), tmp_path).count() == batch.count()
    with pytest.raises(ValueError):
        mcp.one_report_per_server(source)


def test_failure_streaks(spark, stream, tmp_path):
    streaks = jobs.failure_streaks(stream.withColumn("status", F.when(F.col("k") % 2 == 0, "error").otherwise("ok")), 2)
    got = run(spark, streaks, tmp_path)
    assert got.count() > 0 and got.agg(F.min("failures")).first()[0] >= 2


def test_exports_stream_into_the_event_table(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.json").write_text(S.export(S.CHAT, S.NOISE) + "\n{bad\n")
    (tmp_path / "in" / "b.json").write_text(S.export(S.TOOL_CALL, S.INITIALIZE) + "\n")
    spans = otlp.read_otlp_traces(spark, str(tmp_path / "in"), stream=True)
    query = writers.write_events(span_events(spans), str(tmp_path / "out"), checkpoint=str(tmp_path / "cp"), trigger=jobs.ONCE)
    query.awaitTermination(90)
    got = spark.read.parquet(str(tmp_path / "out"))
    want = stored(span_events(otlp.read_otlp_traces(spark, str(tmp_path / "in"))))
    assert rows(got, "event_id", "endpoint", "size_action") == rows(want, "event_id", "endpoint", "size_action")
    assert got.count() == 2


def test_delivery_per_micro_batch(spark, stream, tmp_path):
    seen = []

    def handle(batch, batch_id):
        wire = batch.withColumn("wire", F.to_json(F.struct("event_id")))
        acks = writers.deliver(writers.batch_envelopes(wire, 100), lambda envelope: (200, "{}"))
        seen.append(acks.agg(F.sum("n")).first()[0])

    query = jobs.stream_batches(stream, handle, checkpoint=str(tmp_path / "cp"), trigger=jobs.ONCE)
    query.awaitTermination(90)
    assert sum(seen) == 1000 and len(seen) == 3


def test_settings(spark):
    assert jobs.flush_trigger(500) == {"processingTime": "500 milliseconds"}
    with pytest.raises(ValueError):
        jobs.flush_trigger(50)
    with pytest.raises(ValueError):
        writers.write_events(jobs.bounded_intake(spark.readStream.format("rate"), max_offsets=5).load().selectExpr(
            "timestamp ts", "'llm' kind", "'llm' outcome"), "x")


def test_open_windows_are_stored(spark, tmp_path):
    """The last windows are in the table although no watermark has passed them."""
    (tmp_path / "in").mkdir()
    for n, hours in enumerate(([1, 1, 26], [2, 50], [51])):
        rows = "\n".join(f'{{"ts":"2026-01-01T00:00:00Z","h":{h}}}' for h in hours)
        (tmp_path / "in" / f"{n}.json").write_text(rows + "\n")
        os.utime(tmp_path / "in" / f"{n}.json", (1_700_000_000 + n * 60,) * 2)  # files are taken in this order
    events = spark.readStream.schema("ts timestamp, h int").option("maxFilesPerTrigger", 1).json(str(tmp_path / "in"))
    events = events.select((F.col("ts") + F.make_dt_interval(F.lit(0), F.col("h"))).alias("ts"), F.lit("p").alias("provider"), F.lit(2).alias("tokens_total"))
    totals = jobs.windowed_tokens(events, "1 day", ("provider",))
    path = str(tmp_path / "out")
    jobs.stream_latest(totals, path, checkpoint=str(tmp_path / "state"), trigger=jobs.ONCE).awaitTermination()
    got = jobs.latest_rows(spark, path, totals.schema, ("window_start", "provider")).orderBy("window_start").collect()
    assert [(r["window_start"].day, r["calls"], r["tokens"]) for r in got] == [(1, 3, 6), (2, 1, 2), (3, 2, 4)]
