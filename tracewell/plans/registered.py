"""Registered queries: each runs an operator over whole sample tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracewell.functions.ip import forwarded_ip
from tracewell.functions.lets import fence
from tracewell.functions.variants import as_object, as_text
from tracewell.operators import accounting, analytics, extras, filters, privacy, requests, spans as mapping
from tracewell.operators.messages import rebuild_messages
from tracewell.operators.rules import Rule
from tracewell.operators.sizing import custom_object, enforce_event_size
from tracewell.plans import sample_tables as S
from tracewell.plans.exports import event_table, span_events, stored
from tracewell.session import checkpoint_location
from tracewell.sinks import writers
from tracewell.sources import http, mcp, otlp
from tracewell.streaming import jobs

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}

RULES = (
    Rule(r"[a-z0-9._%+-]+@[a-z0-9.-]+\.[a-z]{2,}", label="email", action="hash"),
    Rule(r"[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}", label="ipv4"),
    Rule(r"[0-9]{13,16}", label="card"),
)
SPAN_OPTIONS = mapping.SpanOptions(
    extra_attributes=("upstream.zone",), hash_attributes=("corr.session",), secret=S.SECRET)
REQUEST_OPTIONS = http.RequestOptions(
    secret=S.SECRET, exclude_paths=("/de/**",), user_id_header="x-user", extra_keys=("ref",))


def query(function):
    QUERIES[function.__name__] = function
    return function


def us(name: str):
    return F.unix_micros(name)


def jtext(path: str, col: str = "body"):
    return F.try_variant_get(col, path, "string")


# --- request log ------------------------------------------------------------


@query
def http_inventory(spark, sf_dir):
    events = http.http_events(S.requests(spark, sf_dir), REQUEST_OPTIONS)
    out = analytics.endpoint_inventory(events, exact=True)
    return out.select("kind", "endpoint", "method", "calls", "errors", us("first_seen").alias("first_us"),
                      us("last_seen").alias("last_us"), F.round("p95_duration_ms", 6).alias("p95_duration_ms"))


@query
def http_event_fields(spark, sf_dir):
    events = http.http_events(S.requests(spark, sf_dir), REQUEST_OPTIONS)
    return events.select(
        F.col("event_id").cast("bigint").alias("page_id"), us("ts").alias("ts_us"), "remote_addr", "endpoint", "scheme",
        "method", "user_agent", "user_id",
        F.col("headers")["Authorization"].alias("h_authorization"), F.col("headers")["Cookie"].alias("h_cookie"),
        F.col("headers")["Accept"].alias("h_accept"), F.size("headers").cast("bigint").alias("n_headers"),
        F.array_join(F.col("query_params")["page"], ",").alias("q_page"),
        F.array_join(F.col("query_params")["ref"], ",").alias("q_ref"),
        jtext("$.size").alias("b_size"), jtext("$.Password").alias("b_password"),
        jtext("$.meta.api_key").alias("b_key"), jtext("$.meta.page").alias("b_page"), jtext("$.model").alias("b_model"))


@query
def parse_query(spark, sf_dir):
    rows = requests.parse_query(S.requests(spark, sf_dir), extra_keys=("ref",))
    pairs = rows.select("event_id", "endpoint", F.explode_outer("query_params").alias("name", "vals"))
    return pairs.select(F.col("event_id").cast("bigint").alias("page_id"), "endpoint", "name",
                        F.array_join("vals", ",").alias("value"))


@query
def build_headers(spark, sf_dir):
    rows = requests.build_headers(S.requests(spark, sf_dir), secret=S.SECRET, allow=("Accept ", "authorization", "COOKIE"))
    return rows.select(F.col("event_id").cast("bigint").alias("page_id"), F.explode("headers").alias("name", "value"))


@query
def filter_headers(spark, sf_dir):
    rows = requests.build_headers(S.requests(spark, sf_dir))
    rows = requests.filter_headers(rows, ("user-agent", "x-user"))
    return rows.select(F.col("event_id").cast("bigint").alias("page_id"), F.explode("headers").alias("name", "value"))


@query
def resolve_client_ip(spark, sf_dir):
    rows = S.requests(spark, sf_dir)
    header = http.header("x-forwarded-for")
    return rows.select(
        F.col("event_id").cast("bigint").alias("page_id"),
        forwarded_ip(header, F.col("source_address")).alias("gateway_ip"),
        forwarded_ip(F.concat(F.lit(" ,"), header), F.col("source_address")).alias("fallback_ip"),
        forwarded_ip(F.concat(F.lit(" ,"), header), mode="span").alias("span_ip"))


@query
def drop_health_exact(spark, sf_dir):
    rows = S.requests(spark, sf_dir).withColumn("endpoint", requests.split_path(F.col("path"))[0])
    marked = rows.withColumn("endpoint", F.when(F.length("endpoint") % 2 == 0, F.lit("/ready")).otherwise(F.col("endpoint")))
    return filters.drop_health_exact(marked).select(F.col("event_id").cast("bigint").alias("page_id"), "endpoint")


@query
def split_health_segment(spark, sf_dir):
    rows = S.calls(spark, sf_dir)
    ends = F.when(F.col("k") % 4 == 0, "/Healthz/").when(F.col("k") % 4 == 1, "/live").otherwise("/x")
    prefix = F.when(F.col("k") % 3 == 0, F.lit("mcp://s")).otherwise(F.lit("/api"))
    marked = filters.split_health_segment(rows.withColumn("endpoint", F.concat(prefix, ends)))
    return marked.groupBy("endpoint", "ingest").agg(F.count("*").alias("n"))


@query
def filter_paths(spark, sf_dir):
    rows = S.requests(spark, sf_dir).withColumn("endpoint", requests.split_path(F.col("path"))[0])
    kept = filters.filter_paths(rows, ("/en/*", "/{fr,de}/**"), ("/**/*.html", "/fr/1*"))
    return kept.select(F.col("event_id").cast("bigint").alias("page_id"), "endpoint")


@query
def sample_requests(spark, sf_dir):
    return filters.sample_requests(S.table(spark, sf_dir, "events"), 0.25, key="event_id").select("event_id")


@query
def body_eligible(spark, sf_dir):
    rows = S.requests(spark, sf_dir).withColumn("content_type", http.header("content-type"))
    page = F.col("event_id").cast("bigint")
    rows = rows.withColumn("body", F.when(page % 10 == 6, '"bare"').when(page % 10 == 0, "{bad").otherwise(F.col("body")))
    out = filters.body_eligible(rows)
    return out.select(page.alias("page_id"), F.col("body").isNotNull().alias("captured"), jtext("$.size").alias("b_size"))


@query
def response_body_eligible(spark, sf_dir):
    out = filters.response_body_eligible(S.requests(spark, sf_dir))
    return out.select(F.col("event_id").cast("bigint").alias("page_id"), jtext("$.id", "response_body").alias("r_id"),
                      jtext("$.body_skipped_encoding", "response_body").alias("skipped"))


@query
def split_metrics(spark, sf_dir):
    rows = S.requests(spark, sf_dir).select("event_id", F.to_variant_object(F.struct(
        F.col("event_id").alias("id"),
        F.struct(F.col("method").alias("m"), F.lit("t").alias("token")).alias("_metrics"))).alias("response_body"))
    out = http.split_metrics(rows)
    return out.select(F.col("event_id").cast("bigint").alias("page_id"), jtext("$.m", "custom_data").alias("m"),
                      jtext("$.token", "custom_data").alias("token"), jtext("$.id", "response_body").alias("r_id"),
                      jtext("$._metrics", "response_body").alias("left_over"))


def _shaped(spark, sf_dir):
    """Requests whose path and body look like model, tool or ordinary traffic."""
    k = F.col("k")
    path = F.when(k % 6 == 0, "/v1/chat/completions").when(k % 6 == 1, "/model/x/invoke").otherwise("/api/orders")
    body = (
        F.when(k % 5 == 0, '{"jsonrpc":"2.0","method":"tools/call"}')
        .when(k % 5 == 1, '{"messages":[{"role":"user","content":"x"}]}')
        .when(k % 5 == 2, '[{"role":"user","content":"x"}]')
        .when(k % 5 == 3, '{"model":"m","texts":[]}')
        .otherwise('{"order":1,"prompt":"p"}')
    )
    return S.calls(spark, sf_dir).withColumns({"endpoint": path, "body": F.try_parse_json(body)})


@query
def withhold_ai_bodies(spark, sf_dir):
    return filters.withhold_ai_bodies(_shaped(spark, sf_dir)).select("event_id", F.col("body").isNotNull().alias("kept"))


@query
def ai_traffic_report(spark, sf_dir):
    return accounting.ai_traffic_report(_shaped(spark, sf_dir))


# --- text and JSON privacy --------------------------------------------------


@query
def pseudonymize(spark, sf_dir):
    users = S.table(spark, sf_dir, "customer").select("c_custkey", "c_name", F.col("c_mktsegment").alias("segment"))
    return privacy.pseudonymize(users, ["c_name", "segment"], S.SECRET)


@query
def normalize_ip_column(spark, sf_dir):
    rows = S.table(spark, sf_dir, "events").select(
        "event_id", F.concat(F.lit(" "), S._address(), F.lit("%eth0")).alias("ip"))
    return privacy.normalize_ip_column(rows, "ip")


@query
def scrub_pii(spark, sf_dir):
    docs = S.table(spark, sf_dir, "documents").select("doc_id", "text")
    out = privacy.scrub_pii(docs, ["text"], RULES, S.SECRET)
    return out.select("doc_id", F.md5("text").alias("text_md5"), F.length("text").cast("bigint").alias("n_chars"))


@query
def scrub_map_keys(spark, sf_dir):
    rows = S.table(spark, sf_dir, "events").select("event_id", F.create_map(
        F.lit("account_ref"), F.col("user_id").cast("string"), F.lit("Token"), F.lit("t"),
        F.lit("note"), F.concat(F.lit("from 10.0.0."), (F.col("user_id") % 200).cast("string"))).alias("m"))
    rules = (Rule("^account_", action="hash", scope="keys"), RULES[1])
    out = privacy.scrub_pii(rows, ["m"], rules, S.SECRET)
    return out.select("event_id", F.explode("m").alias("name", "value"))


@query
def pii_hit_report(spark, sf_dir):
    return accounting.pii_hit_report(S.table(spark, sf_dir, "documents"), ["text"], RULES, by=["source"])


@query
def truncate_strings(spark, sf_dir):
    out = privacy.truncate_strings(S.table(spark, sf_dir, "documents").select("doc_id", "text"), {"text": 256})
    return out.select("doc_id", F.md5("text").alias("text_md5"))


def _document_bodies(spark, sf_dir):
    docs = S.table(spark, sf_dir, "documents")
    return docs.select("doc_id", "lang", F.to_json(F.struct(
        F.col("text"), F.col("source").alias("Api_Key"), F.struct(F.col("lang"), F.col("source").alias("CVV")).alias("meta")))
        .alias("body"))


@query
def redact_json(spark, sf_dir):
    out = privacy.redact_json(_document_bodies(spark, sf_dir), "body", extra_keys=["lang"], limit=500)
    return out.select("doc_id", F.md5(jtext("$.text")).alias("text_md5"), jtext("$.Api_Key").alias("api_key"),
                      jtext("$.meta.lang").alias("lang"), jtext("$.meta.CVV").alias("cvv"))


@query
def redact_struct(spark, sf_dir):
    rows = S.table(spark, sf_dir, "documents").select("doc_id", F.struct(
        F.col("source").alias("token"), F.col("lang"), F.struct(F.col("n_chars").alias("ssn"), F.col("n_chars")).alias("meta"))
        .alias("body"))
    out = privacy.redact_struct(rows, "body")
    return out.select("doc_id", F.col("body.token").alias("token"), F.col("body.lang").alias("lang"),
                      F.col("body.meta.ssn").alias("ssn"), F.col("body.meta.n_chars").alias("n_chars"))


@query
def head_tail_body(spark, sf_dir):
    rows = _document_bodies(spark, sf_dir).select("doc_id", "body")
    out = privacy.head_tail_body(rows, "body", 300, 200)
    return out.select("doc_id", F.coalesce(jtext("$.body_truncated"), F.lit("false")).alias("truncated"),
                      jtext("$.body_bytes_total").cast("bigint").alias("total"),
                      jtext("$.body_bytes_dropped").cast("bigint").alias("dropped"))


@query
def fit_encoded(spark, sf_dir):
    docs = S.table(spark, sf_dir, "documents")
    return docs.select("doc_id", F.md5(privacy.fit_encoded(F.col("text"), 300)).alias("text_md5"))


@query
def sanitize_mcp_arguments(spark, sf_dir):
    out = privacy.sanitize_mcp_arguments(S.call_records(spark, sf_dir), "arguments")
    return out.select(F.col("event_id").cast("bigint").alias("event_id"), jtext("$.item", "arguments").alias("item"),
                      jtext("$.token", "arguments").alias("token"), jtext("$.note", "arguments").alias("note"),
                      jtext("$.nested.Password", "arguments").alias("password"),
                      jtext("$.nested.kind", "arguments").alias("kind"))


@query
def summarize_result(spark, sf_dir):
    out = privacy.summarize_result(S.call_records(spark, sf_dir), "result")
    return out.select(F.col("event_id").cast("bigint").alias("event_id"), "result_summary")


@query
def enforce_event_size_by_document(spark, sf_dir):
    return _sized_documents(spark, sf_dir).select("doc_id", "size_action", F.col("event_bytes").cast("bigint").alias("event_bytes"))


def _sized_documents(spark, sf_dir):
    docs = S.table(spark, sf_dir, "documents")
    absent = F.lit(None).cast("string")
    events = docs.select(
        "doc_id", "source",
        F.timestamp_seconds(F.lit(1704067200)).alias("ts"), absent.alias("remote_addr"), F.lit("/d").alias("endpoint"),
        F.lit("http").alias("scheme"), F.lit("POST").alias("method"), absent.alias("headers"),
        absent.alias("query_params"), absent.alias("user_agent"), absent.alias("user_id"),
        F.to_variant_object(F.struct(F.col("text"))).alias("body"),
        custom_object(("lang", F.col("lang")), ("extra", F.col("text"))).alias("custom_data"),
        F.array(F.lit("extra")).alias("extra_keys"))
    return enforce_event_size(events, 1800, measure="utf8", extra_keys="extra_keys")


@query
def payload_size_report(spark, sf_dir):
    out = accounting.payload_size_report(_sized_documents(spark, sf_dir), by=("source",))
    return out.select("source", "size_action", "events", F.col("total_bytes").cast("bigint").alias("total_bytes"),
                      F.round("p50_bytes", 6).alias("p50_bytes"), F.round("p95_bytes", 6).alias("p95_bytes"),
                      F.col("max_bytes").cast("bigint").alias("max_bytes"))


@query
def redaction_coverage(spark, sf_dir):
    source = F.col("source")
    deep = F.struct(F.struct(F.array(F.struct(source.alias("password"))).alias("c")).alias("b"))
    items = F.array(F.struct(source.alias("token"), F.col("text")), F.struct(source.alias("token"), F.col("lang").alias("text")))
    bodies = S.table(spark, sf_dir, "documents").select(F.to_json(F.struct(
        F.col("text"), source.alias("Api_Key"), F.struct(F.col("lang"), source.alias("CVV")).alias("meta"), deep.alias("a"),
        items.alias("items"))).alias("body"))
    return accounting.redaction_coverage(privacy.redact_json(bodies, "body"), "body")


# --- spans ------------------------------------------------------------------


@query
def decode_traces(spark, sf_dir):
    rows = S.spans(spark, sf_dir)
    return rows.select("trace_id", "span_id", "name", "start_ns", "end_ns", "scope", "status_message",
                       F.size("attrs").cast("bigint").alias("n_attrs"))


@query
def span_attributes(spark, sf_dir):
    rows = S.spans(spark, sf_dir).select("trace_id", F.explode("attrs").alias("name", "v"))
    return rows.groupBy("name").agg(F.count("*").alias("spans"), F.countDistinct(as_text(F.col("v"))).alias("distinct_values"))


@query
def nested_span_attributes(spark, sf_dir):
    """Lists and maps, with doubles that JSON has no number for, and bytes."""
    k = F.get_json_object("props", "$.k")
    text = F.format_string(
        '{"resourceSpans":[{"scopeSpans":[{"scope":{"name":"s"},"spans":[{"name":"%s","attributes":['
        '{"key":"nest","value":{"kvlistValue":{"values":[{"key":"bad","value":{"doubleValue":"NaN"}},'
        '{"key":"good","value":{"intValue":"%s"}},{"key":"raw","value":{"bytesValue":"aGk="}}]}}},'
        '{"key":"list","value":{"arrayValue":{"values":[{"doubleValue":"-Infinity"},{"doubleValue":0.5}]}}},'
        '{"key":"raw","value":{"bytesValue":"/w=="}}]}]}]}]}', k, k)
    good, _ = otlp.quarantine_undecodable(S.table(spark, sf_dir, "events").select(text.alias("value")))
    attrs = F.col("attrs")
    def nested(path: str, name: str):
        return F.try_variant_get(attrs[name], path, "string")
    rows = otlp.flatten_attributes(otlp.spans_of(good)).select(
        "name", nested("$.bad", "nest").alias("bad"), nested("$.good", "nest").alias("good"), nested("$.raw", "nest").alias("nested_raw"),
        nested("$[0]", "list").alias("first"), nested("$[1]", "list").alias("second"), as_text(attrs["raw"]).alias("raw"))
    return rows.groupBy(*rows.columns).agg(F.count("*").alias("n"))


@query
def odd_exports(spark, sf_dir):
    """Exports in both spellings, with absent keys, and broken in many ways: counts by reason, and what the sound ones hold."""
    decoded = otlp.decode_exports(S.odd_exports(spark, sf_dir))
    refused = decoded.groupBy("reason").agg(F.count("*").alias("exports")).filter("reason IS NOT NULL")
    spans = otlp.flatten_attributes(otlp.spans_of(decoded))
    number = F.try_variant_get(F.col("attrs")[""], "$", "bigint")
    sound = spans.groupBy("name").agg(F.count("*").alias("exports"), F.sum(number).alias("total"))
    return refused.select("reason", F.lit(None).cast("string").alias("name"), "exports", F.lit(None).cast("bigint").alias("total")) \
        .unionByName(sound.select(F.lit("sound").alias("reason"), "name", "exports", "total"))


@query
def quarantine_undecodable(spark, sf_dir):
    rows = S.table(spark, sf_dir, "events")
    k = F.get_json_object("props", "$.k").cast("bigint")
    text = F.when(k % 7 == 0, "{broken").when(k % 7 == 1, F.repeat(F.lit("x"), 600)).otherwise('{"resourceSpans": []}')
    decoded = otlp.decode_exports(rows.select(text.alias("value")), max_bytes=500)
    return decoded.groupBy(F.coalesce("reason", F.lit("good")).alias("reason")).agg(F.count("*").alias("n"))


@query
def classify_spans(spark, sf_dir):
    rows = filters.classify_spans(S.spans(spark, sf_dir))
    return rows.groupBy("name", F.coalesce("kind", F.lit("none")).alias("kind")).agg(F.count("*").alias("n"))


@query
def map_llm_spans(spark, sf_dir):
    rows = mapping.map_llm_spans(S.spans(spark, sf_dir), SPAN_OPTIONS)
    return rows.select("trace_id", "endpoint", "method", "event_type", "remote_addr", "status", "error",
                       F.round("duration_ms", 6).alias("duration_ms"), "tokens_prompt", "tokens_completion",
                       "tokens_total", us("ts").alias("ts_us"),
                       jtext("$.input.messages[0].content").alias("asked"),
                       jtext("$.output[0].content").alias("answered"),
                       jtext("$.output[0].tool_calls[0].name").alias("tool"),
                       F.try_variant_get(F.col("custom")["temperature"], "$", "double").alias("temperature"))


@query
def map_mcp_spans(spark, sf_dir):
    rows = mapping.map_mcp_spans(S.spans(spark, sf_dir), SPAN_OPTIONS)
    return rows.select("trace_id", "endpoint", "method", "session_id", "handler_name", "mcp_server",
                       jtext("$.item").alias("item"), jtext("$.token").alias("token"),
                       F.coalesce(F.size("tools"), F.lit(0)).cast("bigint").alias("n_tools"))


@query
def drop_unroutable_mcp(spark, sf_dir):
    kept, dropped = mapping.drop_unroutable_mcp(S.spans(spark, sf_dir))
    return kept.select(F.lit("kept").alias("fate"), "trace_id").unionByName(
        dropped.select(F.lit("dropped").alias("fate"), "trace_id"))


@query
def copy_extra_attributes(spark, sf_dir):
    rows = mapping.map_spans(S.spans(spark, sf_dir), SPAN_OPTIONS)
    return rows.filter(F.size("extras") > 0).select("trace_id", as_text(F.col("extras")["corr_session"]).alias("corr_session"))


@query
def structured_extras(spark, sf_dir):
    """Chosen attributes that hold maps and lists: redacted by the words of nested names, or digested as stable text."""
    k = F.get_json_object("props", "$.k")
    profile = F.parse_json(F.format_string(
        '{"plan":"p%s","acme.apiKey":"sk","deep":[{"userPassword":"x","ok":%s}],"billing-credit-card":{"n":1}}', k, k))
    tags = F.parse_json(F.format_string('{"b":[1,"%s"],"a":null}', k))
    attrs = F.create_map(F.lit("corr.profile"), profile, F.lit("corr.tags"), tags)
    chosen, hashed = ("corr.profile",), ("corr.tags",)
    extras.check_extras(chosen, hashed)
    # The attributes are a column before they are read: an expression would be computed anew at each of its uses.
    rows = S.table(spark, sf_dir, "events").select("event_id", fence(attrs).alias("attrs"))
    rows = rows.select("event_id", extras.extra_fields(F.col("attrs"), chosen, hashed, S.SECRET).alias("extras"))
    return rows.select("event_id", as_text(F.col("extras")["corr_profile"]).alias("profile"), as_text(F.col("extras")["corr_tags"]).alias("tags"))


@query
def rebuild_conversations(spark, sf_dir):
    turns = S.table(spark, sf_dir, "conversations")

    def key(field):
        return F.concat(F.lit("llm.input_messages."), F.col("turn").cast("string"), F.lit(f".message.{field}"))

    pairs = F.array(F.struct(key("role").alias("key"), F.col("role").alias("value")),
                    F.struct(key("content").alias("key"), F.col("text").alias("value")))
    # A span holds at most 64 turns, however long the conversation is.
    part = F.floor(F.col("turn") / 64).alias("part")
    spans = turns.groupBy("conv_id", part).agg(F.flatten(F.collect_list(pairs)).alias("pairs")).select(
        "conv_id", "part", F.transform_values(F.map_from_entries("pairs"), lambda k, v: v.cast("variant")).alias("attrs"))
    found = rebuild_messages(spans).select("conv_id", "part", F.posexplode(
        F.try_variant_get("input_messages", "$", "array<variant>")).alias("pos", "m"))
    return found.select("conv_id", (F.col("part") * 64 + F.col("pos")).alias("pos"), jtext("$.role", "m").alias("role"),
                        F.md5(jtext("$.content", "m")).alias("content_md5"))


@query
def finalize_events(spark, sf_dir):
    rows = stored(span_events(S.spans(spark, sf_dir), SPAN_OPTIONS))
    return rows.select("trace_id", "kind", "remote_addr", "endpoint", "size_action",
                       jtext("$.input.api_key").alias("sent_key"), jtext("$.token").alias("token"),
                       jtext("$.corr_session", "custom_data").alias("corr_session"),
                       jtext("$.arguments.item", "custom_data").alias("item"))


@query
def outcome_accounting(spark, sf_dir):
    return accounting.outcome_accounting(span_events(S.spans(spark, sf_dir), SPAN_OPTIONS))


@query
def stored_accounting(spark, sf_dir):
    """Requests and spans as one event table, written once, and what became of all of them."""
    requests = http.http_events(S.requests(spark, sf_dir), REQUEST_OPTIONS, dropped=True)
    path = checkpoint_location(spark, "events")
    counts = writers.write_counted(event_table(span_events(S.spans(spark, sf_dir), SPAN_OPTIONS), requests), path)
    assert counts.pop("received") == sum(counts.values())
    kept = spark.read.parquet(path).groupBy(F.col("kind").alias("outcome")).agg(F.count("*").alias("stored"))
    return spark.createDataFrame(list(counts.items()), "outcome string, counted bigint").join(kept, "outcome", "left").select(
        "outcome", "counted", F.coalesce("stored", F.lit(0)).alias("stored"))


@query
def repeated_arguments(spark, sf_dir):
    """Tool calls of one session with the same arguments within a day."""
    rows = stored(span_events(S.spans(spark, sf_dir), SPAN_OPTIONS)).filter("method = 'mcp_tool_call'")
    out = analytics.call_loops(rows, 1, "1 day", ("handler_name", "args_hash"))
    return out.select(us("window_start").alias("window_us"), "handler_name", "args_hash", "calls")


@query
def refused_accounting(spark, sf_dir):
    """Outcomes of exports of which some cannot be decoded or are too large."""
    k = F.get_json_object("props", "$.k").cast("bigint")
    text = F.when(k % 7 == 0, "{broken").when((k % 7 == 1) & (F.col("event_id") % 50 == 0), F.repeat(F.lit("x"), 100_001))
    others = S.table(spark, sf_dir, "events").select(text.alias("value")).filter("value IS NOT NULL")
    good, refused = otlp.quarantine_undecodable(S.exports(spark, sf_dir).unionByName(others), max_bytes=100_000)
    spans = otlp.merge_span_event_attributes(otlp.flatten_attributes(otlp.spans_of(good)))
    return accounting.outcome_accounting(span_events(spans, SPAN_OPTIONS), refused)


@query
def attribute_catalog(spark, sf_dir):
    out = accounting.attribute_catalog(S.named_spans(spark, sf_dir), "names")
    return out.select("name", "derived_key", "sensitive", "owned", "spans", "names_with_key")


@query
def name_sensitivity(spark, sf_dir):
    rows = S.table(spark, sf_dir, "part").select("p_partkey", F.create_map(
        F.concat(F.lit("http.request."), F.regexp_replace("p_name", " ", "-")), F.lit(1),
        F.concat(F.lit("X-Api-Key."), F.col("p_type")), F.lit(2)).alias("attrs"))
    out = accounting.attribute_catalog(rows, trace="p_partkey")
    return out.select("name", "derived_key", "sensitive", "spans")


@query
def requested_vs_observed(spark, sf_dir):
    events = stored(span_events(S.spans(spark, sf_dir), SPAN_OPTIONS))
    keyed = events.withColumn("corr", jtext("$.corr_session", "custom_data"))
    return analytics.requested_vs_observed(keyed, "corr")


# --- tool servers -----------------------------------------------------------


@query
def read_mcp_calls(spark, sf_dir):
    rows = mcp.session_identity(mcp.call_events(S.call_records(spark, sf_dir), secret=S.SECRET))
    return rows.select(F.col("event_id").cast("bigint").alias("event_id"), "endpoint", "method", "remote_addr", "session_id",
                       "user_id", F.round("duration_ms", 2).alias("duration_ms"), "error", "result_summary", "status")


@query
def read_schema_reports(spark, sf_dir):
    rows = mcp.read_schema_reports(S.declarations(spark, sf_dir))
    return rows.select("event_id", "mcp_server", "item_kind", "name", "description")


@query
def one_report_per_server(spark, sf_dir):
    rows = mcp.one_report_per_server(mcp.read_schema_reports(S.declarations(spark, sf_dir)))
    return rows.groupBy("mcp_server", "item_kind", "name").agg(
        F.count("*").alias("definitions"), F.min("event_id").alias("first_event"))


@query
def undeclared_calls(spark, sf_dir):
    inventory = mcp.read_schema_reports(S.declarations(spark, sf_dir))
    out = analytics.undeclared_calls(S.calls(spark, sf_dir), inventory)
    return out.select("mcp_server", "name", "calls", us("first_seen").alias("first_us"))


@query
def never_called(spark, sf_dir):
    inventory = mcp.read_schema_reports(S.declarations(spark, sf_dir))
    out = analytics.never_called(S.calls(spark, sf_dir), inventory)
    return out.select("mcp_server", "item_kind", "name", us("declared_at").alias("declared_us"))


@query
def definition_drift(spark, sf_dir):
    out = analytics.definition_drift(mcp.read_schema_reports(S.declarations(spark, sf_dir)))
    return out.select("mcp_server", "item_kind", "name", "event_id", us("prev_ts").alias("prev_us"))


# --- analyses ---------------------------------------------------------------


@query
def endpoint_inventory(spark, sf_dir):
    out = analytics.endpoint_inventory(S.calls(spark, sf_dir), exact=True)
    return out.select("kind", "endpoint", "method", "calls", "errors", F.round(F.col("avg_duration_ms") * F.col("calls"), 2).alias("sum_duration_ms"),
                      F.round("p95_duration_ms", 6).alias("p95_duration_ms"), us("first_seen").alias("first_us"),
                      us("last_seen").alias("last_us"))


@query
def observed_arguments(spark, sf_dir):
    rows = mcp.call_events(S.call_records(spark, sf_dir))
    return analytics.observed_arguments(rows, ("endpoint",))


@query
def call_graph(spark, sf_dir):
    out = analytics.call_graph(S.calls(spark, sf_dir))
    return out.select("src", "dst", "n", F.round(F.col("avg_gap_s") * F.col("n"), 6).alias("sum_gap_s"),
                      *[F.round(c, 6).alias(c) for c in ("min_gap_s", "max_gap_s")])


@query
def chain_matches(spark, sf_dir):
    rows = S.calls(spark, sf_dir)
    out = analytics.chain_matches(rows, F.col("handler_name") == "view", F.col("handler_name") == "purchase", 6 * 3600)
    return out.select("event_id", F.col("last_event_id").alias("first_event_id"), F.round("gap_s", 6).alias("gap_s"))


@query
def repeated_failures(spark, sf_dir):
    out = analytics.repeated_failures(S.calls(spark, sf_dir), 2, keys=("session_id",))
    return out.select("session_id", "failures", us("first_ts").alias("first_us"), us("last_ts").alias("last_us"))


@query
def call_loops(spark, sf_dir):
    out = analytics.call_loops(S.calls(spark, sf_dir), 2, "1 day", ("session_id", "handler_name"))
    return out.select(us("window_start").alias("window_us"), "session_id", "handler_name", "calls")


@query
def sessionize(spark, sf_dir):
    out = analytics.sessionize(S.calls(spark, sf_dir), 12 * 3600)
    return out.select("event_id", "user_id", F.col("session_no").cast("bigint").alias("session_no"))


@query
def token_consumption(spark, sf_dir):
    out = analytics.token_consumption(S.calls(spark, sf_dir), "1 day", ("provider", "model"))
    return out.select(us("window_start").alias("window_us"), "provider", "model",
                      F.col("level").cast("bigint").alias("level"), "calls", "tokens")


@query
def token_spikes(spark, sf_dir):
    out = analytics.token_spikes(S.calls(spark, sf_dir), "1 day", 3, 1.5)
    return out.select("provider", "model", us("window_start").alias("window_us"), "tokens",
                      F.round("trailing_mean", 6).alias("trailing_mean"))


@query
def user_activity_baseline(spark, sf_dir):
    out = analytics.user_activity_baseline(S.calls(spark, sf_dir))
    return out.select("user_id", F.col("day").cast("string").alias("day"), "calls",
                      *[F.round(c, 6).alias(c) for c in ("mean_calls", "stddev_calls", "z_score")])


@query
def top_consumers(spark, sf_dir):
    return analytics.top_consumers(S.calls(spark, sf_dir), 10)


@query
def top_consumers_by_provider(spark, sf_dir):
    out = analytics.top_consumers(S.calls(spark, sf_dir), 5, by=("provider",))
    return out.withColumn("rank", F.col("rank").cast("bigint"))


@query
def correlate_llm_mcp(spark, sf_dir):
    out = analytics.correlate_llm_mcp(S.calls(spark, sf_dir), "user_id", 3600 * 4)
    return out.select("user_id", "mcp_event_id", "llm_event_id", "model", F.round("lag_s", 6).alias("lag_s"))


@query
def order_volume(spark, sf_dir):
    orders = S.table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("user_id"), F.when(F.col("o_orderstatus") == "F", "error").otherwise("ok").alias("status"),
        F.floor("o_totalprice").alias("tokens_total"), F.col("o_orderpriority").alias("model"))
    return analytics.top_consumers(orders, 3, by=("model",)).withColumn("rank", F.col("rank").cast("bigint"))


# --- accounts, batches and sinks --------------------------------------------


@query
def admit_bounded(spark, sf_dir):
    return accounting.admit_bounded(S.calls(spark, sf_dir), 3, "1 hour", ("mcp_server",)).select("event_id")


@query
def admit_bounded_large(spark, sf_dir):
    """One crowd of all rows, of which 10,000 are let in."""
    arrivals = S.table(spark, sf_dir, "lineitem").select(
        F.col("l_shipdate").cast("timestamp").alias("ts"), (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("row"))
    return accounting.admit_bounded(arrivals, 10_000, "36500 days", tie="row", run_rows=5000).select("row")


@query
def admission_report(spark, sf_dir):
    out = accounting.admission_report(S.calls(spark, sf_dir), 3, "1 day", ("mcp_server",))
    return out.select(us("window_start").alias("window_us"), "mcp_server", F.col("admitted").cast("bigint").alias("admitted"),
                      F.col("dropped").cast("bigint").alias("dropped"))


@query
def scale_sampled_counts(spark, sf_dir):
    sampled = filters.sample_requests(S.calls(spark, sf_dir), 0.25, key="event_id")
    out = accounting.scale_sampled_counts(sampled, 0.25, ["handler_name"])
    return out.select("handler_name", "sampled", F.round("estimated", 6).alias("estimated"),
                      F.round("std_error", 6).alias("std_error"))


@query
def batch_envelopes(spark, sf_dir):
    wire = S.calls(spark, sf_dir).withColumn("wire", F.to_json(F.struct("event_id")))
    out = writers.batch_envelopes(wire, 50)
    return out.select("kind", "batch_no", "n", us("first_ts").alias("first_us"), us("last_ts").alias("last_us"),
                      F.md5("envelope").alias("envelope_md5"))


@query
def to_wire(spark, sf_dir):
    events = http.http_events(S.requests(spark, sf_dir), REQUEST_OPTIONS)
    rows = writers.to_wire(events).withColumn("w", F.parse_json("wire"))
    return rows.select(F.col("event_id").cast("bigint").alias("page_id"), jtext("$.scheme", "w").alias("scheme"),
                       jtext("$.timestamp", "w").alias("timestamp"), jtext("$.query_params.page", "w").alias("q_page"),
                       jtext("$.remote_addr", "w").alias("remote_addr"),
                       F.map_contains_key(as_object(F.col("w")), "body").alias("has_body"))


@query
def delivery_accounting(spark, sf_dir):
    acks = S.calls(spark, sf_dir).select(
        F.lit(50).cast("bigint").alias("n"), (F.col("status") == "ok").alias("delivered"),
        F.when(F.col("status") == "ok", F.col("k")).otherwise(0).alias("accepted"),
        F.when(F.col("status") == "ok", 100 - F.col("k")).otherwise(0).alias("skipped"))
    return accounting.delivery_accounting(acks)


@query
def deliver_batches(spark, sf_dir):
    wire = S.calls(spark, sf_dir).withColumn("wire", F.to_json(F.struct("event_id")))

    def post(envelope):
        return 200, '{"accepted": %d, "skipped": 0}' % envelope.count("event_id")

    acks = writers.deliver(writers.batch_envelopes(wire, 50), post)
    return accounting.delivery_accounting(acks)


@query
def deliver_once(spark, sf_dir):
    """All events up to now, then again with those that came later: each batch goes out once."""
    wire = S.calls(spark, sf_dir).withColumn("wire", F.to_json(F.struct("event_id")))

    def post(envelope):
        return 200, '{"accepted": %d, "skipped": 0}' % envelope.count("event_id")

    path, batches = checkpoint_location(spark, "acks"), writers.batch_envelopes(wire, 50)
    writers.deliver_once(batches.filter("batch_no < 20"), post, path)
    return accounting.delivery_accounting(writers.deliver_once(batches, post, path))


@query
def windowed_tokens(spark, sf_dir):
    out = jobs.windowed_tokens(S.calls(spark, sf_dir), "2 hours", ("provider",), slide="1 hour")
    return out.select(us("window_start").alias("window_us"), "provider", "calls", "tokens")


@query
def session_totals(spark, sf_dir):
    out = jobs.session_totals(S.calls(spark, sf_dir), "12 hours")
    return out.select("user_id", us("session_start").alias("start_us"), us("session_end").alias("end_us"), "calls")


@query
def correlate_windows(spark, sf_dir):
    rows = S.calls(spark, sf_dir)
    out = jobs.correlate_windows(rows.filter("kind = 'llm'"), rows.filter("kind = 'mcp'"), "user_id", "1 day")
    return out.select(us("window_start").alias("window_us"), "user_id", "llm_calls", "mcp_calls")


@query
def dedup_spans(spark, sf_dir):
    once = S.table(spark, sf_dir, "events").select(
        "ts", F.md5((F.col("event_id") % 5000).cast("string")).alias("trace_id"), (F.col("event_id") % 2).alias("span_id"))
    return jobs.dedup_spans(once).select("trace_id", "span_id")


# --- streams, run until the input is used up --------------------------------


def _finished(spark, stream):
    """Run a streaming DataFrame over all available input; the written table."""
    path = checkpoint_location(spark, "table")
    jobs.stream_job(stream, lambda rows: rows, path, trigger=jobs.ONCE).awaitTermination()
    return spark.read.schema(stream.schema).parquet(path)


@query
def stream_calls(spark, sf_dir):
    rows = filters.sample_requests(S.calls(spark, sf_dir, stream=True), 0.5, key="session_id")
    rows = privacy.pseudonymize(rows.filter(F.col("status") == "ok"), ["user_id"], S.SECRET)
    return _finished(spark, rows.select("event_id", "user_id", "endpoint", us("ts").alias("ts_us")))


@query
def stream_windowed_tokens(spark, sf_dir):
    out = jobs.windowed_tokens(S.calls(spark, sf_dir, stream=True), "1 day", ("provider",), tokens="tokens_total")
    path = checkpoint_location(spark, "table")
    jobs.stream_latest(out, path, trigger=jobs.ONCE).awaitTermination()
    latest = jobs.latest_rows(spark, path, out.schema, ("window_start", "provider"))
    return latest.select(us("window_start").alias("window_us"), "provider", "calls", "tokens")


@query
def stream_loops(spark, sf_dir):
    """Open windows included: the counts that the stream last stored."""
    out = jobs.windowed_loops(S.calls(spark, sf_dir, stream=True), 2, "1 day", ("session_id", "handler_name"))
    path = checkpoint_location(spark, "table")
    jobs.stream_latest(out, path, trigger=jobs.ONCE).awaitTermination()
    latest = jobs.latest_rows(spark, path, out.schema, ("window_start", "session_id", "handler_name"))
    return latest.select(us("window_start").alias("window_us"), "session_id", "handler_name", "calls")


@query
def stream_session_totals(spark, sf_dir):
    """The sessions that are over: whose end the watermark has passed."""
    out = jobs.session_totals(S.calls(spark, sf_dir, stream=True), "12 hours")
    return _finished(spark, out).select("user_id", us("session_start").alias("start_us"), us("session_end").alias("end_us"), "calls")


@query
def stream_correlate_windows(spark, sf_dir):
    """Windows that both streams have left behind, joined as streams."""
    rows = S.calls(spark, sf_dir, stream=True)
    out = jobs.correlate_windows(rows.filter("kind = 'llm'"), rows.filter("kind = 'mcp'"), "user_id", "1 day")
    return _finished(spark, out).select(us("window_start").alias("window_us"), "user_id", "llm_calls", "mcp_calls")


@query
def stream_failure_streaks(spark, sf_dir):
    """Runs of failures that sessions are in at the end."""
    out = jobs.failure_streaks(S.calls(spark, sf_dir, stream=True), 2)
    latest = _finished(spark, out).groupBy("session_id").agg(F.max_by(F.struct("failures", "first_ts", "last_ts"), "last_ts").alias("run"))
    return latest.select("session_id", "run.failures", us("run.first_ts").alias("first_us"), us("run.last_ts").alias("last_us"))


@query
def stream_dedup_spans(spark, sf_dir):
    rows = S.calls(spark, sf_dir, stream=True).withColumns({
        "trace_id": F.md5((F.col("event_id") % 5000).cast("string")), "span_id": F.col("event_id") % 2})
    return _finished(spark, jobs.dedup_spans(rows, "60 days").select("trace_id", "span_id"))
