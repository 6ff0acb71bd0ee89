"""The same jobs on unbounded input.

Stateless steps (mapping, filters, scrubbing) take a streaming DataFrame as they
are. Every stateful job below has a watermark, so its state expires.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import LongType, StructField, StructType

from tracewell.constants import REDACTED
from tracewell.session import checkpoint_location

FLUSH = {"processingTime": "2 seconds"}
ONCE = {"availableNow": True}


def flush_trigger(interval_ms: int = 2000) -> Mapping[str, str]:
    if not 100 <= interval_ms <= 60000:
        raise ValueError("interval_ms must be within 100..60000")
    return {"processingTime": f"{interval_ms} milliseconds"}


def stream_job(source: DataFrame, transform: Callable[[DataFrame], DataFrame], path: str, *,
               checkpoint: str | None = None, trigger: Mapping[str, object] = FLUSH,
               partition_by: Sequence[str] = (), name: str = "events") -> StreamingQuery:
    """Run ``transform`` over a stream into a parquet table (exactly once)."""
    out = transform(source)
    writer = out.writeStream.format("parquet").outputMode("append").option(
        "checkpointLocation", checkpoint or checkpoint_location(source.sparkSession, name))
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    return writer.trigger(**trigger).start(path)


def stream_batches(source: DataFrame, handle: Callable[[DataFrame, int], None], *, checkpoint: str | None = None,
                   trigger: Mapping[str, object] = FLUSH, name: str = "batches") -> StreamingQuery:
    """Hand each micro-batch to ``handle(rows, batch_id)``, e.g. to deliver it. A
    batch may be handed over again after a failure, with the same id."""
    return (source.writeStream.foreachBatch(handle)
            .option("checkpointLocation", checkpoint or checkpoint_location(source.sparkSession, name))
            .trigger(**trigger).start())


def stream_latest(source: DataFrame, path: str, *, checkpoint: str | None = None,
                  trigger: Mapping[str, object] = FLUSH, name: str = "latest") -> StreamingQuery:
    """Store what each micro-batch changes in an aggregation, open windows included. A
    batch that is repeated after a failure replaces what it wrote; see ``latest_rows``."""
    def store(rows: DataFrame, batch: int) -> None:
        rows.write.mode("overwrite").parquet(f"{path}/_batch={batch}")

    return (source.writeStream.outputMode("update").foreachBatch(store)
            .option("checkpointLocation", checkpoint or checkpoint_location(source.sparkSession, name))
            .trigger(**trigger).start())


def latest_rows(spark: SparkSession, path: str, schema: StructType, keys: Sequence[str]) -> DataFrame:
    """The newest row of every key that ``stream_latest`` stored."""
    rows = spark.read.schema(StructType([*schema.fields, StructField("_batch", LongType())])).parquet(path)
    newest = F.max_by(F.struct(*schema.names), "_batch").alias("_row")
    return rows.groupBy(*(F.col(k).alias(f"_{k}") for k in keys)).agg(newest).select("_row.*")


def bounded_intake(reader, max_files: int | None = None, max_offsets: int | None = None):
    """Limit what one micro-batch takes in. Unlike a bounded queue nothing is lost:
    what does not fit waits at the source."""
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if max_offsets is not None:
        reader = reader.option("maxOffsetsPerTrigger", max_offsets)
    return reader


def dedup_spans(spans: DataFrame, watermark: str = "10 minutes") -> DataFrame:
    """One event per (trace, span) although exporters resend and replicate."""
    keys = ["trace_id", "span_id"]
    if not spans.isStreaming:
        return spans.dropDuplicates(keys)
    return spans.withWatermark("ts", watermark).dropDuplicatesWithinWatermark(keys)


def _on_time(df: DataFrame, watermark: str) -> DataFrame:
    return df.withWatermark("ts", watermark) if df.isStreaming else df


def windowed_tokens(events: DataFrame, window: str, dims: Sequence[str], *, slide: str | None = None,
                    tokens: str = "tokens_total", watermark: str = "10 minutes") -> DataFrame:
    """Calls and tokens per (tumbling or sliding) window and ``dims``."""
    return _on_time(events, watermark).groupBy(F.window("ts", window, slide).alias("w"), *dims).agg(
        F.count("*").alias("calls"), F.sum(tokens).alias("tokens")
    ).select(F.col("w.start").alias("window_start"), *dims, "calls", "tokens")


def windowed_loops(events: DataFrame, n: int, window: str, keys: Sequence[str], *,
                   watermark: str = "10 minutes") -> DataFrame:
    """Keys called at least ``n`` times in a window."""
    counted = _on_time(events, watermark).groupBy(F.window("ts", window).alias("w"), *keys).agg(
        F.count("*").alias("calls"))
    return counted.filter(F.col("calls") >= n).select(F.col("w.start").alias("window_start"), *keys, "calls")


def session_totals(events: DataFrame, gap: str, keys: Sequence[str] = ("user_id",), *,
                   watermark: str = "10 minutes") -> DataFrame:
    """Calls per activity session; a session ends after ``gap`` without a call."""
    grouped = _on_time(events, watermark).groupBy(F.session_window("ts", gap).alias("w"), *keys)
    return grouped.agg(F.count("*").alias("calls")).select(
        F.col("w.start").alias("session_start"), F.col("w.end").alias("session_end"), *keys, "calls")


def correlate_windows(llm: DataFrame, mcp: DataFrame, key: str, window: str, *,
                      watermark: str = "10 minutes") -> DataFrame:
    """Model calls next to tool calls per correlator and time window.

    Each stream is counted per (window, correlator) before they are joined, so the
    join is one to one whatever the number of calls behind a correlator.
    """

    def counted(df: DataFrame, name: str) -> DataFrame:
        usable = df.filter(F.col(key).isNotNull() & (F.col(key) != REDACTED))
        return _on_time(usable, watermark).groupBy(F.window("ts", window).alias("w"), F.col(key)).agg(
            F.count("*").alias(name))

    joined = counted(llm, "llm_calls").join(counted(mcp, "mcp_calls"), ["w", key])
    return joined.select(F.col("w.start").alias("window_start"), key, "llm_calls", "mcp_calls")


STREAK_SCHEMA = "failures BIGINT, first_ts TIMESTAMP, last_ts TIMESTAMP"


def failure_streaks(events: DataFrame, n: int, keys: Sequence[str] = ("session_id",), *,
                    watermark: str = "10 minutes", quiet_ms: int = 3_600_000) -> DataFrame:
    """A row whenever a key's current run of failures grows and is at least ``n``.

    Rows of one micro-batch are put in time order; order across micro-batches is
    that of arrival, so bound the intake. A key is forgotten when event time has
    moved ``quiet_ms`` past its last call.
    """
    import pandas as pd
    from pyspark.sql.streaming.state import GroupStateTimeout

    key_schema = ", ".join(f"{k} {events.schema[k].dataType.simpleString()}" for k in keys)
    columns = [*keys, "failures", "first_ts", "last_ts"]

    def step(key, batches, state):
        if state.hasTimedOut:
            state.remove()
            return
        rows = pd.concat(list(batches)).sort_values(["ts", "event_id"])
        count, first, last = state.get if state.exists else (0, 0, 0)
        before = count
        for failed, ts in zip(rows["status"] == "error", rows["ts"], strict=True):
            now = ts.value // 1000
            count, first, last = (count + 1, first if count else now, now) if failed else (0, 0, 0)
        state.update((count, first, last))
        seen_ms = rows["ts"].iloc[-1].value // 1_000_000
        state.setTimeoutTimestamp(max(seen_ms, state.getCurrentWatermarkMs()) + quiet_ms)
        if count >= n and count != before:
            yield pd.DataFrame([(*key, count, pd.Timestamp(first, unit="us"), pd.Timestamp(last, unit="us"))],
                               columns=columns)

    timed = events.withWatermark("ts", watermark).select(*keys, "ts", "event_id", "status")
    return timed.groupBy(*keys).applyInPandasWithState(
        step, f"{key_schema}, {STREAK_SCHEMA}", "count BIGINT, first_us BIGINT, last_us BIGINT", "append",
        GroupStateTimeout.EventTimeTimeout)
