"""Event tables, the wire form, delivery batches and their accounts."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator, Mapping, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tracewell.constants import DEFAULT_BATCH_SIZE, MAX_BATCH_SIZE
from tracewell.functions.variants import to_object, variant_map
from tracewell.operators.accounting import observed
from tracewell.operators.sizing import wire_time
from tracewell.operators.timeline import RUN_ROWS, with_running_total
from tracewell.plans.exports import stored

ACK_SCHEMA = (
    "batch_id STRING, n BIGINT, status INT, delivered BOOLEAN, accepted BIGINT, skipped BIGINT, error STRING"
)


def write_events(events: DataFrame, path: str, *, checkpoint: str | None = None,
                 trigger: Mapping[str, object] | None = None, mode: str = "append",
                 spread: int | None = None) -> StreamingQuery | None:
    """Write the stored events as parquet, partitioned by date and kind.

    As it is, every task writes to every partition it holds rows of. With
    ``spread`` rows are first shuffled so that a partition is written by that many
    tasks, whatever its share of the rows. A streaming input starts a query (``checkpoint`` required) and returns it.
    """
    rows = stored(events).withColumn("date", F.to_date("ts"))
    if spread:
        rows = rows.repartition("date", "kind", F.pmod(F.xxhash64("event_id"), F.lit(spread)))
    if not events.isStreaming:
        rows.write.partitionBy("date", "kind").mode(mode).parquet(path)
        return None
    if not checkpoint:
        raise ValueError("a stream needs a checkpoint location")
    return (rows.writeStream.format("parquet").partitionBy("date", "kind").option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"processingTime": "2 seconds"})).start(path))


def write_counted(events: DataFrame, path: str, *, mode: str = "append", spread: int | None = None) -> dict[str, int]:
    """``write_events`` for a batch, and the account of its outcomes from the same pass:
    a count of each, stored or not, and ``received``, which is their sum."""
    counted, account = observed(events)
    write_events(counted, path, mode=mode, spread=spread)
    return dict(account.get)


def _wire_params() -> Column:
    return F.transform_values("query_params", lambda k, vs: F.when(
        F.size(vs) == 1, F.get(vs, F.lit(0)).cast("variant")).otherwise(F.to_variant_object(vs)))


def to_wire(events: DataFrame, credentials: Mapping[str, str] | None = None, out: str = "wire") -> DataFrame:
    """Adds the JSON object sent for each event.

    HTTP events carry ``scheme`` as a boolean (is it https). Without credentials
    optional fields that are null are left out; with them (``api_key``,
    ``client_id``, ``token``) every field and the response body are present.
    """
    keep = credentials is not None
    scheme = F.when(F.col("scheme").isin("http", "https"), (F.col("scheme") == "https").cast("variant")).otherwise(
        F.col("scheme").cast("variant"))
    columns = set(events.columns)

    def optional(name: str, value: Column) -> tuple[str, Column, bool]:
        return (name, value if name in columns else F.lit(None).cast("variant"), keep)

    fields = [(name, F.lit(value)) for name, value in (credentials or {}).items()]
    fields += [
        ("remote_addr", F.col("remote_addr")),
        ("endpoint", F.col("endpoint")),
        ("scheme", scheme),
        ("method", F.col("method")),
        ("timestamp", wire_time(F.col("ts"))),
        optional("custom_data", F.col("custom_data")),
        optional("headers", F.to_variant_object(F.transform_values("headers", lambda k, v: v.cast("variant")))
                 if "headers" in columns else F.lit(None)),
        optional("query_params", F.to_variant_object(_wire_params()) if "query_params" in columns else F.lit(None)),
        optional("body", F.col("body")),
        optional("user_agent", F.col("user_agent")),
        optional("user_id", F.col("user_id")),
    ]
    if keep:
        fields.append(optional("response_body", F.col("response_body")))
    return events.withColumn(out, F.to_json(to_object(variant_map(fields))))


def batch_numbers(events: DataFrame, batch_size: int = DEFAULT_BATCH_SIZE, keys: Sequence[str] = ("kind",), *,
                  ts: str = "ts", tie: str = "event_id", run_rows: int = RUN_ROWS) -> DataFrame:
    """Adds ``batch_no``: the rows of each key, first come first served, in runs
    of ``batch_size``. A key of any size is spread over the cluster."""
    if not 1 <= batch_size <= MAX_BATCH_SIZE:
        raise ValueError(f"batch_size must be within 1..{MAX_BATCH_SIZE}")
    rows = with_running_total(events, keys, F.lit(1), "_seq", ts=ts, tie=tie, run_rows=run_rows)
    return rows.withColumn("batch_no", F.floor((F.col("_seq") - 1) / batch_size))


def batch_envelopes(wire: DataFrame, batch_size: int = DEFAULT_BATCH_SIZE, keys: Sequence[str] = ("kind",), *,
                    ts: str = "ts", tie: str = "event_id", col: str = "wire",
                    run_rows: int = RUN_ROWS) -> DataFrame:
    """One row per batch: its ``{"events": [...]}`` text, size and order bounds."""
    # Only what an envelope is made of is shuffled.
    needed = wire.select(*dict.fromkeys((*keys, ts, tie, col)))
    rows = batch_numbers(needed, batch_size, keys, ts=ts, tie=tie, run_rows=run_rows)
    # A group never holds more than batch_size rows.
    placed = F.struct(F.col("_seq"), F.col(col))
    ordered = F.array_sort(F.collect_list(placed))
    texts = F.array_join(F.transform(ordered, lambda r: r[col]), ",")
    return rows.groupBy(*keys, "batch_no").agg(
        F.count("*").alias("n"),
        F.min(ts).alias("first_ts"),
        F.max(ts).alias("last_ts"),
        F.concat(F.lit('{"events":['), texts, F.lit("]}")).alias("envelope"),
    ).withColumn("batch_id", F.concat_ws("-", *keys, F.col("batch_no").cast("string")))


def deliver(envelopes: DataFrame, post: Callable[[str], tuple[int, str]]) -> DataFrame:
    """Post each envelope once from the executors; one acknowledgement per batch.

    ``post(envelope)`` returns (HTTP status, response text). Only 2xx counts as
    delivered; any other status or an exception drops the whole batch, which the
    acknowledgement records. Spark may rerun a lost task, so write the
    acknowledgements to a table and let receivers drop repeated batch ids.
    """

    def send(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            acks = []
            for row in batch.itertuples(index=False):
                status, text, error = None, "", None
                try:
                    status, text = post(row.envelope)
                except Exception as failure:  # noqa: BLE001 - any failure loses the batch
                    error = type(failure).__name__
                delivered = status is not None and 200 <= status < 300
                counts = counters(text) if delivered else (0, 0)
                acks.append((row.batch_id, int(row.n), status, delivered, *counts, error))
            yield pd.DataFrame(acks, columns=["batch_id", "n", "status", "delivered", "accepted", "skipped", "error"])

    return envelopes.select("batch_id", "n", "envelope").mapInPandas(send, ACK_SCHEMA)


def deliver_once(envelopes: DataFrame, post: Callable[[str], tuple[int, str]], acks_path: str) -> DataFrame:
    """Posts the envelopes that the table of acknowledgements does not know, adds theirs to
    it, and returns it. Calling this again, or reading the result often, posts nothing twice: an
    acknowledged batch is done, delivered or not. After a failed job only what its lost tasks had
    posted without an acknowledgement goes out again, under the same ids."""
    spark = envelopes.sparkSession
    spark.createDataFrame([], ACK_SCHEMA).write.mode("append").parquet(acks_path)
    acks = spark.read.schema(ACK_SCHEMA)
    pending = envelopes.join(acks.parquet(acks_path).select("batch_id"), "batch_id", "left_anti")
    deliver(pending, post).write.mode("append").parquet(acks_path)
    return acks.parquet(acks_path)


def counters(text: str) -> tuple[int, int]:
    """(accepted, skipped) of a response; anything unreadable counts as zero."""
    try:
        reply = json.loads(text)
    except ValueError:
        return 0, 0
    if not isinstance(reply, dict):
        return 0, 0

    def number(value: object) -> int:
        try:
            return int(value or 0)
        except (TypeError, ValueError):
            return 0

    return number(reply.get("accepted")), number(reply.get("skipped"))
