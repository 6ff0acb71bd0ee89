"""Spans -> events, in one pass over the span table.

Model calls and tool calls share one projection, so the (large) exports are
decoded once; the cases are chosen per row by ``kind``.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracewell import constants as C
from tracewell.functions.ip import forwarded_ip
from tracewell.functions.lets import fence
from tracewell.functions.variants import (
    OBJECT,
    Fields,
    as_array,
    as_object,
    as_text,
    is_number,
    is_string,
    parse_if_json,
    text_or,
    to_object,
    truthy,
    variant_map,
)
from tracewell.operators.extras import attribute_names, check_extras, extra_fields
from tracewell.operators.filters import span_kind
from tracewell.operators.messages import messages


@dataclass(frozen=True)
class SpanOptions:
    """How spans become events; sizes are checked when built, names when spans are mapped."""

    client_ip_attribute: str = "http.client_ip"
    user_agent_attribute: str = "http.user_agent"
    user_id_attribute: str | None = None
    default_user_agent: str = "tracewell/1.0"
    server_fallback: str = "ai-gateway"
    integration: str = "ai-gateway"
    capture_llm_content: bool = True
    capture_mcp_arguments: bool = True
    extra_attributes: Sequence[str] = ()
    hash_attributes: Sequence[str] = ()
    secret: str | None = None

    def __post_init__(self) -> None:
        for field in ("extra_attributes", "hash_attributes"):
            object.__setattr__(self, field, attribute_names(getattr(self, field), field))


def _attr(attrs: Column, name: str) -> Column:
    return F.try_element_at(attrs, F.lit(name))


def _label(value: Column) -> Column:
    return F.left(value, F.lit(C.MAX_LABEL_CHARS))


def llm_method(operation: Column) -> Column:
    """Event method from an operation or span name."""
    name = F.lower(F.trim(F.coalesce(operation, F.lit(""))))
    compact = F.translate(name, " _-", "")
    result = None
    for known, method in C.LLM_METHODS.items():
        result = F.when(name == known, method) if result is None else result.when(name == known, method)
    for hint, method in C.LLM_METHOD_HINTS:
        result = result.when(compact.contains(hint), method)
    return result.otherwise(C.LLM_METHOD_DEFAULT)


def embedding_provider(model: Column) -> Column:
    result = None
    for hint, provider in C.EMBEDDING_HINTS:
        hit = F.lower(model).contains(hint)
        result = F.when(hit, provider) if result is None else result.when(hit, provider)
    return result.otherwise("unknown")


def _as_bool(value: Column) -> Column:
    return F.when(
        is_string(value), F.lower(F.trim(as_text(value))).isin("true", "1", "yes")
    ).when(is_number(value), truthy(value))


def mcp_arguments(found: Column, attrs: Column) -> Column:
    """Arguments of a call as a JSON object, ``{}`` when there are none.

    ``found`` is the parsed argument attribute; only when it is no object do the
    attributes with one argument each count.
    """
    members = as_object(found)

    def inner(path: str) -> Column:
        value = F.try_variant_get(found, path, "variant")
        return F.when(as_object(value).isNotNull(), value)

    envelope = F.map_contains_key(members, "jsonrpc") | F.map_contains_key(members, "method")
    whole = F.coalesce(inner("$.arguments"), inner("$.params.arguments"), F.when(~envelope, found),
                       F.parse_json(F.lit("{}")))
    single = F.map_filter(attrs, lambda k, v: F.startswith(k, F.lit(C.ARGUMENT_PREFIX)))
    named = F.transform_values(
        F.transform_keys(single, lambda k, v: F.substring(k, len(C.ARGUMENT_PREFIX) + 1, 1 << 30)),
        lambda k, v: parse_if_json(v),
    )
    return F.when(members.isNotNull(), whole).otherwise(to_object(named))


def declared_tools(found: Column) -> Column:
    """Tools of a parsed listing as an array of objects; null when there are none."""
    items = F.coalesce(as_array(found), F.try_variant_get(found, "$.tools", "array<variant>"))

    def tool(item: Column) -> Column:
        members = as_object(item)
        schema = _attr(members, "inputSchema")
        return to_object(variant_map([
            ("name", _attr(members, "name")),
            ("description", _attr(members, "description")),
            ("input_schema", F.when(truthy(schema), schema).otherwise(_attr(members, "input_schema"))),
        ]))

    named = F.transform(F.filter(items, lambda item: truthy(F.try_variant_get(item, "$.name", "variant"))), tool)
    return F.when(F.size(named) > 0, named)


def _non_empty(value: Column) -> Column:
    """Truth of a parsed value without rendering it as text."""
    return F.coalesce(F.size(as_object(value)) > 0, F.size(as_array(value)) > 0, truthy(value))


def _read(spans: DataFrame, options: SpanOptions) -> DataFrame:
    """Every attribute the mapping needs as a column of its own (``a_*``), once."""
    attrs = F.col("attrs")
    wanted = {
        "a_error": (C.ERROR_KEY,),
        "a_provider": C.PROVIDER_KEYS,
        "a_model": C.MODEL_KEYS,
        "a_response_model": C.RESPONSE_MODEL_KEYS,
        "a_route": C.ROUTE_KEYS,
        "a_operation": (C.OPERATION_KEY,),
        "a_server": C.SERVER_KEYS,
        "a_session": C.SESSION_KEYS,
        "a_rpc": (C.MCP_METHOD_KEY,),
        "a_agent": (options.user_agent_attribute,),
        "a_client": (options.client_ip_attribute,),
        **{f"a_{name}": keys for name, keys in C.TOKEN_KEYS.items()},
    }
    handlers = {f"a_{method}": (key,) for method, _, key in C.MCP_METHODS.values()}
    parsed = {"a_params": (C.INVOCATION_KEYS, "llm"), "a_arguments": (C.ARGUMENT_KEYS, "mcp"), "a_tools": (C.TOOL_LIST_KEYS, "mcp")}
    contents = {"a_input": C.INPUT_KEYS, "a_output": C.OUTPUT_KEYS} if options.capture_llm_content else {}
    single = {f"a_{name}": C.REQUEST_PREFIX + name for name in C.REQUEST_PARAMS} | {
        "a_request_id": C.REQUEST_ID_KEY, "a_transport": C.TRANSPORT_KEY, "a_protocol": C.PROTOCOL_KEY}
    texts = {"a_client_name": C.CLIENT_NAME_KEY, "a_client_version": C.CLIENT_VERSION_KEY}
    user = (options.user_id_attribute,) if options.user_id_attribute else ()
    lists = [*wanted.values(), *handlers.values(), *(keys for keys, _ in parsed.values()), *contents.values(), user]
    fields = Fields([*(key for keys in lists for key in keys), *single.values(), *texts.values()])
    kind, nothing = F.col("kind"), F.lit(None).cast("variant")
    params = F.coalesce(*[F.when(truthy(fields.get(k)), fields.get(k)) for k in C.INVOCATION_KEYS])
    # One decode of the map; everything after it reads plain columns.
    rows = spans.withColumns({"kind": span_kind(attrs), fields.column: fence(fields.struct(attrs))})
    return rows.select(
        *spans.columns, "kind",
        *[fields.first_present(keys).alias(name) for name, keys in {**wanted, **handlers}.items()],
        (as_text(fields.first_present(user)) if user else F.lit(None).cast("string")).alias("user_id"),
        parse_if_json(F.when(kind == "llm", params)).alias("a_params"),
        *[parse_if_json(F.when(kind == of, fields.first_present(keys))).alias(name)
          for name, (keys, of) in parsed.items() if name != "a_params"],
        *[(parse_if_json(F.when(kind == "llm", fields.first_present(contents[name]))) if contents else nothing).alias(name)
          for name in ("a_input", "a_output")],
        *[F.when(~F.is_variant_null(fields.get(key)), fields.get(key)).alias(name) for name, key in single.items()],
        *[fields.first_present((key,)).alias(name) for name, key in texts.items()],
    )


def _resolve(read: DataFrame, options: SpanOptions) -> DataFrame:
    """Names, tokens, arguments and content, each only for its own kind."""
    attrs, llm, mcp = F.col("attrs"), F.col("kind") == "llm", F.col("kind") == "mcp"
    failed = F.coalesce(F.col("status_code").isin("STATUS_CODE_ERROR", "2"), F.lit(False)) | truthy(F.col("a_error"))
    message = F.when(F.col("status_message") != "", F.col("status_message"))
    spent = F.col("end_ns") - F.col("start_ns")
    rpc = text_or(F.col("a_rpc"), "")
    call = handler = None
    for name, (method, _, _) in C.MCP_METHODS.items():
        shown = text_or(F.col(f"a_{method}"), "unknown")
        call = F.when(rpc == name, method) if call is None else call.when(rpc == name, method)
        handler = F.when(rpc == name, shown) if handler is None else handler.when(rpc == name, shown)
    operation = F.when(truthy(F.col("a_operation")), as_text(F.col("a_operation"))).otherwise(F.col("name"))

    def number(name: str) -> Column:
        return F.when(llm & is_number(F.col(f"a_{name}")), F.try_variant_get(F.col(f"a_{name}"), "$", "bigint"))

    def content(name: str, prefix: str) -> Column:
        if not options.capture_llm_content:
            return F.lit(None).cast("variant")
        recorded = F.when(_non_empty(F.col(name)), F.col(name))
        return F.when(llm, F.coalesce(recorded, messages(attrs, prefix)))

    staged = read.withColumns({
        "ts": F.timestamp_micros(F.expr("start_ns div 1000")),
        "duration_ms": F.when(spent > 0, spent / F.lit(1e6)).otherwise(F.lit(0.0)),
        "error": F.when(failed, F.coalesce(message, text_or(F.col("a_error"), "error"))),
        "remote_addr": forwarded_ip(F.when(is_string(F.col("a_client")), as_text(F.col("a_client"))), mode="span"),
        "user_agent": text_or(F.col("a_agent"), options.default_user_agent),
        "params": as_object(F.col("a_params")),
        "provider": F.when(llm, _label(text_or(F.col("a_provider"), "unknown"))),
        "tools": F.when(mcp & (rpc == "tools/list"), declared_tools(F.col("a_tools"))),
        "mcp_server": F.when(mcp, _label(text_or(F.col("a_server"), options.server_fallback))),
        "handler_name": F.when(mcp, _label(handler)),
        "session_id": F.when(mcp, as_text(F.col("a_session"))),
        "method": F.when(llm, llm_method(operation)).when(mcp, call),
        "content_in": content("a_input", C.INPUT_MESSAGES),
        "content_out": content("a_output", C.OUTPUT_MESSAGES),
        **{name: number(name) for name in C.TOKEN_KEYS},
    })
    fallback = _attr(F.col("params"), "model")
    model = F.when(truthy(F.col("a_model")), as_text(F.col("a_model"))).otherwise(text_or(fallback, "unknown"))
    named = staged.withColumns({
        "model": F.when(llm, _label(model)),
        "method": F.when(F.col("tools").isNotNull(), F.lit("mcp_schema_report")).otherwise(F.col("method")),
        "arguments": F.when(mcp & F.col("method").isNotNull(), mcp_arguments(F.col("a_arguments"), attrs)),
        **{f"p_{name}": F.coalesce(F.col(f"a_{name}"), _attr(F.col("params"), name)) for name in C.REQUEST_PARAMS},
    })
    inferred = (F.col("provider") == "unknown") & (F.col("method") == "llm_embeddings")
    return named.withColumn(
        "provider", F.when(inferred, embedding_provider(F.col("model"))).otherwise(F.col("provider"))
    )


def map_spans(spans: DataFrame, options: SpanOptions = SpanOptions()) -> DataFrame:
    """Raw (unscrubbed) events of all spans plus their ``outcome``.

    ``outcome`` is ``llm`` or ``mcp`` for events, ``ignored`` for spans of no
    interest and ``filtered`` for protocol calls without an event. ``custom`` and
    ``extras`` are maps; ``finalize_events`` turns them into ``custom_data``.
    """
    check_extras(options.extra_attributes, options.hash_attributes,
                 (options.client_ip_attribute, options.user_id_attribute, options.user_agent_attribute))
    attrs = F.col("attrs")
    row = _resolve(_read(spans, options), options)
    llm = F.col("kind") == "llm"
    report = F.col("tools").isNotNull()

    ids = [("trace_id", F.col("trace_id")), ("span_id", F.col("span_id"))]
    stream = _attr(F.col("params"), "stream")

    llm_custom = variant_map([
        ("integration", F.lit(options.integration)),
        ("event_type", F.regexp_replace("method", "^llm_", "")),
        ("provider", F.col("provider")),
        ("model", F.col("model")),
        ("response_model", F.col("a_response_model")),
        ("duration_ms", F.col("duration_ms")),
        ("status", F.when(F.col("error").isNotNull(), F.lit("error")).otherwise(F.lit("ok"))),
        ("error", F.col("error")),
        ("streaming", _as_bool(stream)),
        *ids,
        *[(name, F.col(name), False) for name in C.TOKEN_KEYS],
        *[(name, F.when(is_number(F.col(f"p_{name}")), F.col(f"p_{name}")), False) for name in C.REQUEST_PARAMS],
        ("route_path", F.when(truthy(F.col("a_route")), F.col("a_route")), False),
    ])
    request_id = F.col("a_request_id")
    event_type = F.regexp_replace("method", "^mcp_", "")
    mcp_custom = variant_map([
        ("integration", F.lit(options.integration)),
        ("mcp_server", F.col("mcp_server")),
        ("handler_name", F.col("handler_name")),
        ("event_type", event_type),
        ("duration_ms", F.col("duration_ms")),
        ("arguments", F.col("arguments")),
        ("error", F.col("error")),
        ("result_summary", F.lit(None).cast("variant")),
        ("session_id", F.col("a_session")),
        ("client_name", F.col("a_client_name")),
        ("client_version", F.col("a_client_version")),
        ("request_id", F.when(is_string(request_id), _label(as_text(request_id)).cast("variant"))
         .otherwise(request_id)),
        ("mcp_transport", F.col("a_transport")),
        ("mcp_protocol_version", F.col("a_protocol")),
        *ids,
    ])
    empty = F.lit(None).cast("array<variant>")
    report_custom = variant_map([
        ("integration", F.lit(options.integration)),
        ("mcp_server", F.col("mcp_server")),
        ("event_type", F.lit("schema_report")),
        ("tools", F.to_variant_object(F.col("tools"))),
        ("resources", F.to_variant_object(F.coalesce(empty, F.array().cast("array<variant>")))),
        ("prompts", F.to_variant_object(F.coalesce(empty, F.array().cast("array<variant>")))),
        *ids,
    ])
    custom = F.when(llm, llm_custom).when(report, report_custom).when(F.col("method").isNotNull(), mcp_custom)
    spoken = F.to_variant_object(F.struct(F.col("content_in").alias("input"), F.col("content_out").alias("output")))
    handed = F.when(F.size(as_object(F.col("arguments"))) > 0, F.col("arguments"))
    body = F.when(F.col("content_in").isNotNull() | F.col("content_out").isNotNull(), spoken).when(~report, handed)
    endpoint = (
        F.when(llm, F.concat(F.lit("llm://"), "provider", F.lit("/"), "model"))
        .when(report, F.concat(F.lit("mcp://"), "mcp_server", F.lit("/schema_report")))
        .otherwise(F.concat(F.lit("mcp://"), "mcp_server", F.lit("/"), "handler_name"))
    )
    outcome = (
        F.when(F.col("kind").isNull(), F.lit("ignored"))
        .when(F.col("method").isNull(), F.lit("filtered"))
        .otherwise(F.col("kind"))
    )
    copied = extra_fields(attrs, options.extra_attributes, options.hash_attributes, options.secret)
    events = row.select(
        F.concat_ws("-", "trace_id", "span_id").alias("event_id"),
        "kind",
        fence(outcome).alias("outcome"),
        "ts",
        "remote_addr",
        F.when(F.col("method").isNotNull(), endpoint).alias("endpoint"),
        F.col("kind").alias("scheme"),
        "method",
        F.lit(None).cast("map<string,string>").alias("headers"),
        F.lit(None).cast("map<string,array<string>>").alias("query_params"),
        body.alias("body"),
        F.lit(None).cast("variant").alias("response_body"),
        "user_agent",
        "user_id",
        "provider",
        "model",
        "mcp_server",
        F.when(~report, F.col("handler_name")).alias("handler_name"),
        F.when(llm, F.regexp_replace("method", "^llm_", "")).when(report, F.lit("schema_report"))
        .otherwise(event_type).alias("event_type"),
        "session_id",
        F.when(~report, F.col("duration_ms")).alias("duration_ms"),
        F.when(F.col("error").isNotNull(), F.lit("error")).otherwise(F.lit("ok")).alias("status"),
        "error",
        *C.TOKEN_KEYS,
        "trace_id",
        "span_id",
        custom.alias("custom"),
        F.when(F.col("method").isNotNull(), copied).alias("extras"),
        "tools",
        "arguments",
    )
    # Keys of the mapping always win over copied attributes.
    free = F.map_filter("extras", lambda k, v: ~F.map_contains_key(F.col("custom"), k))
    return events.withColumn("extras", F.coalesce(free, F.create_map().cast(OBJECT)))


def map_llm_spans(spans: DataFrame, options: SpanOptions = SpanOptions()) -> DataFrame:
    return map_spans(spans, options).filter(F.col("outcome") == "llm")


def map_mcp_spans(spans: DataFrame, options: SpanOptions = SpanOptions()) -> DataFrame:
    return map_spans(spans, options).filter(F.col("outcome") == "mcp")


def drop_unroutable_mcp(spans: DataFrame, options: SpanOptions = SpanOptions()) -> tuple[DataFrame, DataFrame]:
    """(routable, dropped) tool-protocol spans. Dropped are protocol overhead and
    listings without a recorded result."""
    mapped = map_spans(spans, options).filter(F.col("kind") == "mcp")
    return mapped.filter(F.col("outcome") == "mcp"), mapped.filter(F.col("outcome") == "filtered")
