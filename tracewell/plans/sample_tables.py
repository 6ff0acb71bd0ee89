"""Telemetry inputs derived from the sample tables, whole table each time.

``events`` plays the call log and the trace exports, ``pages`` the request log,
``documents`` free-text bodies and ``conversations`` model messages.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tracewell.functions.variants import to_object, variant_map
from tracewell.session import prepare_session
from tracewell.sources.otlp import (
    attribute_names,
    flatten_attributes,
    merge_span_event_attributes,
    quarantine_undecodable,
    spans_of,
)

SECRET = "sample-key"
SPANS_PER_EXPORT = 10


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    df = prepare_session(spark).read.parquet(f"{sf_dir}/{name}.parquet")
    return df.withColumn("ts", F.col("ts").cast("timestamp")) if "ts" in df.columns else df


def stream_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The same table as a stream."""
    schema = prepare_session(spark).read.parquet(f"{sf_dir}/{name}.parquet").schema
    df = spark.readStream.schema(schema).option("pathGlobFilter", f"{name}.parquet").parquet(sf_dir)
    return df.withColumn("ts", F.col("ts").cast("timestamp"))


def _k() -> Column:
    return F.get_json_object("props", "$.k").cast("bigint")


def _id(prefix: str, number: Column) -> Column:
    return F.concat(F.lit(prefix), number.cast("string"))


def calls(spark: SparkSession, sf_dir: str, *, stream: bool = False) -> DataFrame:
    """Light call events: model calls are views and clicks, the rest tool calls."""
    user = F.col("user_id")
    return (stream_table if stream else table)(spark, sf_dir, "events").select(
        "event_id",
        "ts",
        F.when(F.col("event_type").isin("view", "click"), "llm").otherwise("mcp").alias("kind"),
        _id("user-", user).alias("user_id"),
        _id("session-", user).alias("session_id"),
        _id("server-", user % 7).alias("mcp_server"),
        F.col("event_type").alias("handler_name"),
        F.concat(F.lit("mcp://server-"), (user % 7).cast("string"), F.lit("/"), F.col("event_type")).alias("endpoint"),
        F.concat(F.lit("mcp_"), F.col("event_type")).alias("method"),
        F.when(F.col("event_type") == "error", "error").otherwise("ok").alias("status"),
        F.col("value").alias("duration_ms"),
        F.floor("value").alias("tokens_total"),
        _id("provider-", user % 3).alias("provider"),
        _id("model-", _k() % 5).alias("model"),
        F.md5("props").alias("args_hash"),
        _k().alias("k"),
    )


def call_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw tool-server call records."""
    long_text = F.repeat(F.lit("x"), (_k() * 4).cast("int"))
    arguments = F.to_json(F.struct(
        _k().alias("item"), F.lit("abc").alias("token"), long_text.alias("note"),
        F.struct(F.lit("p").alias("Password"), F.col("event_type").alias("kind")).alias("nested")))
    result = (
        F.when(_k() % 5 == 0, F.to_json(F.struct(_k().alias("a"), _k().alias("b"))))
        .when(_k() % 5 == 1, F.lit("[1,2,3]"))
        .when(_k() % 5 == 2, F.concat(F.lit('"'), F.col("event_type"), F.lit('"')))
        .when(_k() % 5 == 3, _k().cast("string"))
    )
    return table(spark, sf_dir, "events").select(
        F.col("event_id").cast("string").alias("event_id"),
        "ts",
        _id("server-", F.col("user_id") % 7).alias("mcp_server"),
        F.col("event_type").alias("handler_name"),
        F.lit("tool_call").alias("event_type"),
        arguments.alias("arguments"),
        result.alias("result"),
        F.when(F.col("event_type") == "error", "ValueError").alias("error"),
        (F.col("value") / 3).alias("duration_ms"),
        F.when(F.col("user_id") % 4 > 0, _id("session-", F.col("user_id"))).alias("session_id"),
        F.lit("agent").alias("client_name"),
        F.lit("1.0").alias("client_version"),
        F.col("event_id").cast("string").alias("request_id"),
        _id("user-", F.col("user_id")).alias("client_id"),
        F.when(F.col("user_id") % 3 > 0, _address()).alias("source_ip"),
    )


def _address() -> Column:
    user = F.col("user_id")
    return F.concat(F.lit("10.0."), F.floor(user / 256).cast("string"), F.lit("."), (user % 256).cast("string"))


def requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw HTTP requests, one per page."""
    page = F.col("page_id")

    def h(name: str, value: Column) -> Column:
        return F.struct(F.lit(name).alias("name"), value.alias("value"))

    body = F.to_json(F.struct(
        F.length("html").alias("size"), F.lit("hunter2").alias("Password"),
        F.struct(F.lit("k").alias("api_key"), page.alias("page")).alias("meta")))
    prompt = F.to_json(F.struct(F.lit("m").alias("model"), F.lit("hi").alias("prompt")))
    return table(spark, sf_dir, "pages").select(
        page.cast("string").alias("event_id"),
        F.timestamp_seconds(F.lit(1704067200) + page * 60).alias("ts"),
        F.when(page % 2 == 0, "post").otherwise("GET").alias("method"),
        F.regexp_extract("url", "^([a-z]+)://", 1).alias("scheme"),
        F.regexp_extract("url", "^[a-z]+://[^/]+(/.*)$", 1).alias("path"),
        F.array(
            h(":path", F.lit("/")),
            h("user-agent", F.concat(F.lit("agent/"), (page % 5).cast("string"))),
            h("content-type", F.when(page % 3 == 0, "application/json; charset=utf-8").otherwise("text/plain")),
            h("authorization", F.concat(F.lit("Bearer t"), (page % 11).cast("string"))),
            h("cookie", F.lit("sid=1")),
            h("accept", F.lit("a/b")),
            h("accept", F.lit("c/d")),
            h("x-forwarded-for", F.concat(F.lit("10.1.0."), (page % 250).cast("string"), F.lit(":443, 172.16.0.1"))),
            h("x-user", _id("user-", page % 17)),
        ).alias("headers"),
        F.when(page % 4 == 0, prompt).otherwise(body).alias("body"),
        F.lit("192.168.0.9:5000").alias("source_address"),
        F.when(page % 5 > 0, F.to_json(F.struct(page.alias("id"), F.lit("v").alias("secret")))).otherwise("[oops")
        .alias("response_body"),
        F.lit("application/json").alias("response_type"),
        F.when(page % 7 == 0, "GZIP").alias("response_encoding"),
        F.lit(None).cast("string").alias("metrics"),
        F.when(page % 9 == 0, 500).when(page % 9 < 8, 200).alias("response_status"),
        (page % 40 + 0.5).cast("double").alias("duration_ms"),
    )


def _kv(key: str, value: Column, kind: str = "stringValue") -> Column:
    text = value.cast("string")
    return F.struct(F.lit(key).alias("key"), F.struct(
        (text if kind == "stringValue" else F.lit(None).cast("string")).alias("stringValue"),
        (text if kind == "intValue" else F.lit(None).cast("string")).alias("intValue"),
    ).alias("value"))


def exports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trace exports of ten spans each, as OTLP/JSON text in column ``value``."""
    k, user, kind = _k(), F.col("user_id"), F.col("event_type")
    done = F.floor("value")
    provider = F.element_at(F.array(F.lit("openai"), F.lit("anthropic"), F.lit("google")), (user % 3 + 1).cast("int"))
    tool = _id("tool-", k % 4)
    question = F.to_json(F.struct(
        F.array(F.struct(F.lit("user").alias("role"), _id("q", k).alias("content"))).alias("messages"),
        _id("sk-", k).alias("api_key")))
    client = F.concat(_address(), F.lit(", 192.168.0.1"))
    correlator = _kv("corr.session", _id("s", user))
    chat = F.array(
        _kv("openinference.span.kind", F.lit("LLM")),
        _kv("llm.system", provider),
        _kv("llm.model_name", _id("model-", k % 5)),
        _kv("llm.token_count.prompt", k, "intValue"),
        _kv("llm.token_count.completion", done, "intValue"),
        _kv("llm.token_count.total", k + done, "intValue"),
        _kv("llm.invocation_parameters", F.lit('{"stream": true, "temperature": 0.5}')),
        _kv("input.value", question),
        _kv("llm.output_messages.0.message.role", F.lit("assistant")),
        _kv("llm.output_messages.0.message.content", _id("answer ", k)),
        _kv("llm.output_messages.0.message.tool_calls.0.tool_call.function.name", tool),
        _kv("http.client_ip", client),
        correlator,
    )
    messages = F.array(
        _kv("span.kind", F.lit("llm")),
        _kv("llm.model", _id("claude-", k % 3)),
        _kv("gen_ai.usage.input_tokens", k, "intValue"),
        correlator,
    )
    embeddings = F.array(
        _kv("openinference.span.kind", F.lit("EMBEDDING")),
        _kv("embedding.invocation_parameters",
            F.concat(F.lit('{"model": "text-embedding-'), (k % 2).cast("string"), F.lit('"}'))),
    )
    call = F.array(
        _kv("mcp.method.name", F.lit("tools/call")),
        _kv("mcp.tool.name", tool),
        _kv("mcp.tool.arguments", F.to_json(F.struct(k.alias("item"), F.lit("abc").alias("token")))),
        correlator,
    )
    listing = F.array(
        _kv("mcp.method.name", F.lit("tools/list")),
        _kv("mcp.backend.name", _id("server-", user % 7)),
        _kv("output.value", F.to_json(F.struct(F.array(
            F.struct(F.lit("tool-0").alias("name"), F.lit("first").alias("description")),
            F.struct(F.lit("tool-9").alias("name"), _id("v", k % 2).alias("description"))).alias("tools")))),
    )
    start = F.array(_kv("mcp.method.name", F.lit("initialize")))
    noise = F.array(_kv("upstream.cluster", F.lit("x")))
    attributes = (
        F.when(kind == "view", chat).when(kind == "click", messages).when(kind == "signup", embeddings)
        .when(kind == "purchase", call).when(k % 3 == 0, listing).when(k % 3 == 1, start).otherwise(noise)
    )
    routed = F.array(_kv("mcp.backend.name", _id("server-", user % 7)), _kv("mcp.session.id", _id("s", user)))
    name = (
        F.when(kind == "view", "ChatCompletions").when(kind == "click", "Messages")
        .when(kind == "signup", "CreateEmbeddings").otherwise("tools/call")
    )
    failed = (kind == "view") & (k % 10 == 0)
    begin = F.unix_micros("ts") * 1000
    span = F.struct(
        F.base64(F.unhex(F.md5(F.col("event_id").cast("string")))).alias("traceId"),
        F.base64(F.unhex(F.substring(F.md5(F.col("event_id").cast("string")), 1, 16))).alias("spanId"),
        name.alias("name"),
        begin.cast("string").alias("startTimeUnixNano"),
        (begin + F.floor(F.col("value") * 1000) * 1000).cast("string").alias("endTimeUnixNano"),
        F.struct(F.when(failed, "STATUS_CODE_ERROR").alias("code"), F.when(failed, "upstream 429").alias("message"))
        .alias("status"),
        attributes.alias("attributes"),
        F.when(kind == "purchase", F.array(F.struct(F.lit("route").alias("name"), routed.alias("attributes"))))
        .alias("events"),
    )
    # Spans are shuffled as text, which is a fraction of their structs.
    grouped = table(spark, sf_dir, "events").select(F.floor(F.col("event_id") / SPANS_PER_EXPORT).alias("n"), F.to_json(span).alias("span")).groupBy(
        "n").agg(F.array_join(F.collect_list("span"), ",").alias("spans"))
    return grouped.select(F.concat(F.lit('{"resourceSpans":[{"scopeSpans":[{"scope":{"name":"gateway"},"spans":['), F.col("spans"),
                                   F.lit("]}]}]}")).alias("value"))


#: (reason, export) of exports as careless senders write them; ``%s`` takes a value of the row.
ODD_EXPORTS = (
    (None, '{"resource_spans":[{"scope_spans":[{"spans":[{"name":"n%s","attributes":[{"value":{"int_value":"7"}}]}]}]}]}'),
    (None, '{"resourceSpans":[{"scopeSpans":[{"spans":[{"name":"n%s","status":null,"attributes":[{"key":"","value":{"intValue":7.0}}]}]}]}]}'),
    ("null_entry", '{"resourceSpans":[{"scopeSpans":[{"spans":[{"name":"n%s"},null]}]}]}'),
    ("bad_scalar", '{"resourceSpans":[{"scopeSpans":[{"spans":[{"attributes":[{"key":"k","value":{"intValue":"a%s"}}]}]}]}]}'),
    ("bad_scalar", '{"resourceSpans":[{"scopeSpans":[{"spans":[{"attributes":[{"key":"n%s","value":{"bytesValue":"!!!"}}]}]}]}]}'),
    ("bad_scalar", '{"resourceSpans":[{"scopeSpans":[{"spans":[{"attributes":[{"key":"k","value":{"arrayValue":{"values":[{"intValue":"a%s"}]}}}]}]}]}]}'),
    ("null_entry", '{"resourceSpans":[{"scopeSpans":[{"spans":[{"attributes":[{"key":"n%s","value":{"kvlistValue":{"values":[null]}}}]}]}]}]}'),
    ("unknown_field", '{"resourceSpans":[{"scopeSpans":[{"spans":[{"title":"n%s"}]}]}]}'),
    ("field_twice", '{"resourceSpans":[{"scopeSpans":[{"spans":[{"traceId":"","trace_id":"","name":"n%s"}]}]}]}'),
    ("several_values", '{"resourceSpans":[{"scopeSpans":[{"spans":[{"attributes":[{"key":"k","value":{"intValue":"%s","boolValue":true}}]}]}]}]}'),
    ("not_a_list", '{"resourceSpans":{"name":"n%s"}}'),
    ("not_an_object", '["n%s"]'),
    ("undecodable", '{"resourceSpans":[n%s'),
)


def odd_exports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An export for each event, in column ``value``, of all the kinds above in turn."""
    k = _k().cast("string")
    kinds = F.array(*(F.format_string(text, k) for _, text in ODD_EXPORTS))
    return table(spark, sf_dir, "events").select(F.get(kinds, (F.col("event_id") % len(ODD_EXPORTS)).cast("int")).alias("value"))


def spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    good, _ = quarantine_undecodable(exports(spark, sf_dir))
    return merge_span_event_attributes(flatten_attributes(spans_of(good)))


def named_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The spans of ``spans`` with the names of their attributes alone."""
    good, _ = quarantine_undecodable(exports(spark, sf_dir))
    return attribute_names(spans_of(good))


def declarations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events of all types; purchases are schema reports, which declare tools, resources and prompts."""
    def item(*fields: tuple[str, Column]) -> Column:
        return to_object(variant_map(list(fields)))

    k = _k()
    tools = F.array(item(("name", F.lit("purchase")), ("description", _id("v", k % 2))),
                    item(("name", F.lit("refund")), ("description", F.lit("static"))))
    resources = F.array(item(("uri_template", _id("doc://", k % 3)), ("name", F.lit("doc"))))
    prompts = F.when(k % 2 == 0, F.array(item(("name", F.lit("greet")))))
    custom = to_object(variant_map([
        ("tools", F.to_variant_object(tools)),
        ("resources", F.to_variant_object(resources)),
        ("prompts", F.to_variant_object(F.coalesce(prompts, F.array().cast("array<variant>")))),
    ]))
    method = F.when(F.col("event_type") == "purchase", "mcp_schema_report").otherwise("mcp_tool_call")
    return table(spark, sf_dir, "events").select(
        "event_id", "ts", method.alias("method"),
        _id("server-", F.col("user_id") % 7).alias("mcp_server"), custom.alias("custom_data"))
