"""Trace exports -> finished events: one lazy plan, narrow up to the sink."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tracewell import constants as C
from tracewell.functions.jsonwalk import Walk, rewrite
from tracewell.functions.lets import cut
from tracewell.functions.variants import OBJECT, as_array, as_object, to_object
from tracewell.operators.privacy import address_pseudonym
from tracewell.operators.sizing import enforce_event_size
from tracewell.operators.spans import SpanOptions, map_spans


def _items() -> Column:
    """The captured content of a row as a list, whatever its kind, so that all of
    it is rewritten by one call: the body, the arguments, or the declared tools."""
    return (
        F.when(F.col("tools").isNotNull(), F.col("tools"))
        .when(F.col("kind") == "mcp", F.array("arguments"))
        .when(F.col("body").isNotNull(), F.array("body"))
    )


def finalize_events(mapped: DataFrame, options: SpanOptions = SpanOptions(),
                    max_bytes: int = C.DEFAULT_EVENT_BYTES, *, measure: str = "ascii") -> DataFrame:
    """Scrub and bound mapped span events: address, text caps, content, size.

    ``outcome`` becomes ``oversize`` where even the barest form is too large.
    """
    clean = rewrite(F.to_json(_items()), Walk(limit=C.MAX_VALUE_CHARS, start_depth=-1))
    rows = mapped.withColumn("_clean", F.when(F.col("outcome").isin("llm", "mcp"), as_array(clean)))
    called = (F.col("kind") == "mcp") & F.col("tools").isNull()
    first = F.get(F.col("_clean"), F.lit(0))
    arguments = first if options.capture_mcp_arguments else F.parse_json(F.lit("{}"))
    error = cut(F.col("error"), C.MAX_ERROR_CHARS, C.TRUNCATION_MARK)
    replaced = F.transform_values(
        "custom",
        lambda k, v: F.when(k == "error", error.cast("variant"))
        .when((k == "arguments") & called, arguments)
        .when((k == "tools") & F.col("tools").isNotNull(), F.to_variant_object(F.col("_clean")))
        .otherwise(v),
    )
    handed = F.when(F.size(as_object(arguments)) > 0, arguments)
    rows = rows.withColumns({
        "remote_addr": address_pseudonym(F.col("remote_addr"), options.secret),
        "user_agent": cut(F.col("user_agent"), C.MAX_USER_AGENT_CHARS, C.TRUNCATION_MARK),
        "user_id": cut(F.col("user_id"), C.MAX_USER_ID_CHARS, C.TRUNCATION_MARK),
        "error": error,
        "body": F.when(F.col("kind") == "llm", first).when(called, handed),
        "custom_data": to_object(F.map_concat(
            F.coalesce(F.col("extras"), F.create_map().cast(OBJECT)), replaced)),
        "_extra_keys": F.map_keys("extras"),
        # Of the scrubbed arguments, whose keys are in order.
        "args_hash": F.when(called, F.sha2(F.to_json(arguments), 256)),
    })
    sized = enforce_event_size(rows, max_bytes, measure=measure, extra_keys="_extra_keys")
    event = F.col("outcome").isin("llm", "mcp")
    return sized.withColumns({
        "outcome": F.when(event & (F.col("size_action") == "dropped"), F.lit("oversize")).otherwise(F.col("outcome")),
        "size_action": F.when(event, F.col("size_action")),
        "event_bytes": F.when(event, F.col("event_bytes")),
    }).drop("_clean", "_extra_keys", "custom", "extras", "tools", "arguments")


def span_events(spans: DataFrame, options: SpanOptions = SpanOptions(), max_bytes: int = C.DEFAULT_EVENT_BYTES, *,
                measure: str = "ascii") -> DataFrame:
    """Spans -> finished events with their outcome (see ``accounting``)."""
    return finalize_events(map_spans(spans, options), options, max_bytes, measure=measure)


#: The event table: what ``event_table`` makes of events of any source.
EVENT_SCHEMA = (
    "event_id STRING, kind STRING, outcome STRING, ts TIMESTAMP, remote_addr STRING, endpoint STRING, scheme STRING, method STRING,"
    " headers MAP<STRING, STRING>, query_params MAP<STRING, ARRAY<STRING>>, body VARIANT, response_body VARIANT, user_agent STRING,"
    " user_id STRING, provider STRING, model STRING, mcp_server STRING, handler_name STRING, event_type STRING, session_id STRING,"
    " args_hash STRING, duration_ms DOUBLE, status STRING, error STRING, tokens_prompt BIGINT, tokens_completion BIGINT,"
    " tokens_total BIGINT, trace_id STRING, span_id STRING, custom_data VARIANT"
)


def event_table(*sources: DataFrame) -> DataFrame:
    """Events of several sources (requests, spans) as one table of EVENT_SCHEMA. What a source
    does not have is null; columns beyond the schema are left out."""
    fields = T.StructType.fromDDL(EVENT_SCHEMA)
    parts = [df.select(*((F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in fields))
             for df in sources]
    return reduce(DataFrame.unionAll, parts)


def stored(events: DataFrame) -> DataFrame:
    """The rows that are events, without what was ignored, filtered or oversize."""
    return events.filter(F.col("outcome").isin("llm", "mcp", "http"))
