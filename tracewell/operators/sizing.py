"""Event size limits, shed in stages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracewell import constants as C
from tracewell.functions.lets import fence
from tracewell.functions.variants import OBJECT, as_object, to_object, variant_map

CATALOGUES = ("tools", "resources", "prompts")
# The parts of an event that are sent, in wire order.
WIRE_FIELDS = (
    "remote_addr", "endpoint", "scheme", "method", "timestamp", "custom_data",
    "headers", "query_params", "body", "user_agent", "user_id",
)

# A JSON string with its quotes (possessive: no backtracking on long text).
_STRING = r'"(?:[^"\\]|\\.)*+"'


def json_size(text: Column, measure: str = "ascii") -> Column:
    """Bytes of compact JSON text.

    ``utf8``: as it is. ``ascii``: with non-ASCII characters escaped and a blank
    after every separator, the form the size limit is defined on.
    """
    size = F.octet_length(text)
    if measure == "utf8":
        return size
    if measure != "ascii":
        raise ValueError("measure must be 'ascii' or 'utf8'")
    wide = F.length(F.regexp_replace(text, r"[\x00-\x7f]+", ""))
    astral = F.length(F.regexp_replace(text, r"[\x{0}-\x{ffff}]+", ""))
    escaped = F.length(text) + F.when(size > F.length(text), wide * 5 + astral * 6).otherwise(F.lit(0))
    blanks = F.length(F.regexp_replace(F.regexp_replace(text, _STRING, ""), "[^,:]+", ""))
    return escaped + blanks


def exceeds(text: Column, limit: int, measure: str) -> Column:
    """Whether the size passes ``limit``; the exact ASCII size is only computed
    where the plain byte count does not already decide."""
    plain = F.octet_length(text)
    if measure == "utf8":
        return plain > limit
    return F.when(plain > limit, F.lit(True)).when(plain * 6 <= limit, F.lit(False)).otherwise(
        json_size(text, measure) > limit
    )


def event_json(custom: Column, body: Column) -> Column:
    """JSON text of the sent fields with the given custom data and body."""
    parts = {"custom_data": custom, "body": body, "timestamp": wire_time(F.col("ts"))}
    fields = [parts.get(name, F.col(name)).alias(name) for name in WIRE_FIELDS]
    return F.to_json(F.struct(*fields), {"ignoreNullFields": "false"})


def wire_time(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'")


def enforce_event_size(events: DataFrame, max_bytes: int = C.DEFAULT_EVENT_BYTES, *, measure: str = "ascii",
                       extra_keys: str | None = None) -> DataFrame:
    """Bring events under ``max_bytes``; adds ``size_action`` and ``event_bytes``.

    In order: ``fits``; ``content_dropped`` (body, arguments and declared lists
    emptied); ``extras_dropped`` (also the custom keys listed in the array column
    ``extra_keys``); ``dropped`` for events that still do not fit. Dropped rows
    stay in the result so they can be counted; writers skip them.
    """
    if not C.MIN_EVENT_BYTES <= max_bytes <= C.MAX_EVENT_BYTES:
        raise ValueError(f"max_bytes must be within {C.MIN_EVENT_BYTES}..{C.MAX_EVENT_BYTES}")
    no_body = F.lit(None).cast("variant")
    over_full, over_slim, over_bare = F.col("_over_full"), F.col("_over_slim"), F.col("_over_bare")

    full = event_json(F.col("custom_data"), F.col("body"))
    staged = events.withColumn("_full", full).withColumn("_over_full", exceeds(F.col("_full"), max_bytes, measure))

    custom = F.coalesce(as_object(F.col("custom_data")), F.create_map().cast(OBJECT))
    empty_list = F.parse_json(F.lit("[]"))
    emptied = F.transform_values(
        custom,
        lambda k, v: F.when(k == "arguments", F.parse_json(F.lit("{}")))
        .when(k.isin(*CATALOGUES) & ~F.is_variant_null(v), empty_list)
        .otherwise(v),
    )
    flag = F.create_map(F.lit("content_dropped_oversize"), F.lit(True).cast("variant"))
    staged = staged.withColumn("_slim", F.when(over_full, to_object(F.map_concat(emptied, flag))))
    staged = staged.withColumn("_slim_json", F.when(over_full, event_json(F.col("_slim"), no_body)))
    staged = staged.withColumn("_over_slim", over_full & exceeds(F.col("_slim_json"), max_bytes, measure))

    if extra_keys:
        shed = F.col(extra_keys)
        kept = F.map_filter(as_object(F.col("_slim")), lambda k, v: ~F.array_contains(shed, k))
        more = F.create_map(F.lit("extras_dropped_oversize"), F.lit(True).cast("variant"))
        bare = F.when(over_slim & (F.size(shed) > 0), to_object(F.map_concat(kept, more)))
    else:
        bare = no_body
    staged = staged.withColumn("_bare", bare)
    staged = staged.withColumn("_bare_json", F.when(F.col("_bare").isNotNull(), event_json(F.col("_bare"), no_body)))
    staged = staged.withColumn(
        "_over_bare",
        over_slim & F.coalesce(exceeds(F.col("_bare_json"), max_bytes, measure), F.lit(True)),
    )
    action = (
        F.when(~over_full, F.lit("fits"))
        .when(~over_slim, F.lit("content_dropped"))
        .when(~over_bare, F.lit("extras_dropped"))
        .otherwise(F.lit("dropped"))
    )
    chosen = F.when(~over_full, F.col("_full")).when(~over_slim, F.col("_slim_json")).otherwise(
        F.coalesce("_bare_json", "_slim_json"))
    return staged.withColumns({
        "size_action": fence(action),
        "event_bytes": json_size(chosen, measure),
        "custom_data": F.when(~over_full, F.col("custom_data")).otherwise(F.coalesce("_bare", "_slim")),
        "body": F.when(~over_full, F.col("body")),
    }).drop("_full", "_over_full", "_slim", "_slim_json", "_over_slim", "_bare", "_bare_json", "_over_bare")


def custom_object(*fields: tuple) -> Column:
    """A ``custom_data`` value from (name, column) pairs."""
    return to_object(variant_map(list(fields)))
