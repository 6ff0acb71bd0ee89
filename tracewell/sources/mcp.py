"""Tool-server call records and declared inventories."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tracewell.functions.hashing import hmac_hex
from tracewell.functions.ip import normalize_ip
from tracewell.functions.variants import as_text, to_object, truthy, variant_map
from tracewell.operators.privacy import sanitize_mcp_arguments, summarize_result
from tracewell.session import prepare_session

LOCAL = "mcp-local"
NO_SESSION = "no-session"
CALL_SCHEMA = (
    "event_id STRING, ts TIMESTAMP, mcp_server STRING, handler_name STRING, event_type STRING,"
    " arguments STRING, result STRING, error STRING, duration_ms DOUBLE, session_id STRING,"
    " client_name STRING, client_version STRING, request_id STRING, client_id STRING, source_ip STRING"
)


def read_mcp_calls(spark: SparkSession, path: str, fmt: str = "json", *, secret: str | None = None,
                   user_agent: str = "tracewell/1.0") -> DataFrame:
    prepare_session(spark)
    return call_events(spark.read.format(fmt).schema(CALL_SCHEMA).load(path), secret=secret, user_agent=user_agent)


def call_events(calls: DataFrame, *, secret: str | None = None, user_agent: str = "tracewell/1.0") -> DataFrame:
    """Call records (``CALL_SCHEMA``) -> tool events.

    Errors are class names; results are summarised, and only without an error.
    Calls without a client address are local and stay unhashed.
    """
    rows = sanitize_mcp_arguments(calls, "arguments")
    rows = summarize_result(rows, "result")
    address = normalize_ip(F.coalesce(F.when(F.col("source_ip") != "", F.col("source_ip")), F.lit(LOCAL)))
    hashed = hmac_hex(address, secret) if secret else address
    custom = to_object(variant_map([
        ("mcp_server", F.col("mcp_server")),
        ("handler_name", F.col("handler_name")),
        ("event_type", F.col("event_type")),
        ("duration_ms", F.round("duration_ms", 2)),
        ("error", F.col("error")),
        ("result_summary", F.when(F.col("error").isNull(), F.col("result_summary"))),
        ("session_id", F.col("session_id")),
        ("client_name", F.col("client_name")),
        ("client_version", F.col("client_version")),
        ("request_id", F.col("request_id")),
        ("mcp_client_id", F.col("client_id")),
    ]))
    return rows.select(
        "event_id",
        F.lit("mcp").alias("kind"),
        F.lit("mcp").alias("outcome"),
        "ts",
        F.when(address == LOCAL, address).otherwise(hashed).alias("remote_addr"),
        F.concat(F.lit("mcp://"), "mcp_server", F.lit("/"), "handler_name").alias("endpoint"),
        F.lit("mcp").alias("scheme"),
        F.concat(F.lit("mcp_"), "event_type").alias("method"),
        F.col("arguments").alias("body"),
        F.lit(user_agent).alias("user_agent"),
        F.col("client_id").alias("user_id"),
        "mcp_server",
        "handler_name",
        "event_type",
        "session_id",
        F.round("duration_ms", 2).alias("duration_ms"),
        F.when(F.col("error").isNull(), "ok").otherwise("error").alias("status"),
        "error",
        F.when(F.col("error").isNull(), F.col("result_summary")).alias("result_summary"),
        custom.alias("custom_data"),
    )


def session_identity(events: DataFrame) -> DataFrame:
    """Calls outside a live session share the name ``no-session``."""
    return events.withColumn("session_id", F.coalesce("session_id", F.lit(NO_SESSION)))


def read_schema_reports(events: DataFrame) -> DataFrame:
    """Declared inventory, one row per declared item of each schema report.

    ``item_kind`` is ``tool``, ``resource`` or ``prompt``; resources are named by
    their URI template. Reports that declare nothing yield no rows.
    """
    def items(kind: str, path: str) -> Column:
        found = F.try_variant_get("custom_data", path, "array<variant>")
        entries = F.transform(found, lambda i: F.struct(F.lit(kind).alias("item_kind"), i.alias("item")))
        return F.coalesce(entries, F.array().cast("array<struct<item_kind: string, item: variant>>"))

    def text(name: str) -> Column:
        value = F.try_variant_get("item", f"$.{name}", "variant")
        return F.when(~F.is_variant_null(value), as_text(value))

    listed = F.concat(items("tool", "$.tools"), items("resource", "$.resources"), items("prompt", "$.prompts"))
    rows = events.filter(F.col("method") == "mcp_schema_report").select(
        "event_id", "ts", "mcp_server", F.inline(listed)
    )
    schema = F.try_variant_get("item", "$.input_schema", "variant")
    arguments = F.try_variant_get("item", "$.arguments", "variant")
    return rows.select(
        "event_id",
        "ts",
        "mcp_server",
        "item_kind",
        F.coalesce(text("uri_template"), text("name")).alias("name"),
        F.coalesce(text("description"), F.lit("")).alias("description"),
        F.when(truthy(schema), schema).alias("input_schema"),
        F.when(truthy(arguments), arguments).alias("arguments"),
        # Keys are sorted in VARIANT text, so equal definitions have equal digests.
        F.sha2(F.to_json("item"), 256).alias("def_hash"),
    )


def one_report_per_server(inventory: DataFrame, *, watermark: str | None = None) -> DataFrame:
    """Each distinct definition once per server. On a stream give a ``watermark``
    so that the remembered definitions expire."""
    keys = ["mcp_server", "item_kind", "name", "def_hash"]
    if inventory.isStreaming:
        if not watermark:
            raise ValueError("a stream needs a watermark to bound its state")
        return inventory.withWatermark("ts", watermark).dropDuplicatesWithinWatermark(keys)
    first = F.struct("ts", "event_id")
    return inventory.groupBy(*keys).agg(F.min(first).alias("_first")).select(
        *keys, F.col("_first.ts").alias("ts"), F.col("_first.event_id").alias("event_id")
    )
