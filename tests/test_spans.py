import json
import time

from pyspark.sql import functions as F

from tests.fixtures import spans as S
from tracewell.operators.accounting import attribute_catalog, outcome_accounting
from tracewell.operators.filters import classify_spans
from tracewell.operators.messages import rebuild_messages
from tracewell.operators.spans import SpanOptions, drop_unroutable_mcp, map_spans
from tracewell.plans import sample_tables
from tracewell.plans.exports import span_events, stored
from tracewell.sources.mcp import read_schema_reports
from tracewell.sources.otlp import (
    attribute_names,
    decode_exports,
    flatten_attributes,
    merge_span_event_attributes,
    quarantine_undecodable,
    read_otlp_traces,
    spans_of,
    traces_and_refused,
)


def spans(spark, *items):
    raw = spark.createDataFrame([(S.export(*items),)], "value string")
    good, _ = quarantine_undecodable(raw)
    return merge_span_event_attributes(flatten_attributes(spans_of(good)))


def rows(df, *variants):
    """Rows as dicts with the named VARIANT columns parsed."""
    shown = df.withColumns({v: F.to_json(F.col(v)) for v in variants})
    out = [r.asDict(recursive=True) for r in shown.collect()]
    for row in out:
        for v in variants:
            row[v] = json.loads(row[v]) if row[v] is not None else None
    return out


def all_mapped(spark, items, options=SpanOptions()):
    df = map_spans(spans(spark, *items), options)
    df = df.withColumn("custom", F.to_variant_object("custom"))
    return rows(df, "custom", "body")


def mapped(spark, item, options=SpanOptions()):
    return all_mapped(spark, [item], options)[0]


def all_finished(spark, items, options=SpanOptions(), **kw):
    return rows(span_events(spans(spark, *items), options, **kw), "custom_data", "body")


def finished(spark, item, options=SpanOptions(), **kw):
    return all_finished(spark, [item], options, **kw)[0]


def test_chat_span(spark):
    row = mapped(spark, S.CHAT, SpanOptions(user_id_attribute="user.id"))
    assert row["remote_addr"] == "192.0.2.44"
    assert row["endpoint"] == "llm://tidewater/tidewater-small-3"
    assert (row["scheme"], row["method"], row["user_id"]) == ("llm", "llm_chat_completion", "skipper-9")
    assert row["user_agent"] == "harbour-desk/3.2"
    assert row["ts"].isoformat() == "2025-11-05T12:27:58.500000"
    assert row["body"] == {
        "input": {"question": "When does the ferry leave?", "secret": "k-0815"},
        "output": [{"role": "assistant", "content": "At noon."}],
    }
    assert row["custom"] == {
        "integration": "ai-gateway", "event_type": "chat_completion", "provider": "tidewater",
        "model": "tidewater-small-3", "response_model": None, "duration_ms": 820.25, "status": "ok", "error": None,
        "streaming": False, "trace_id": S.TRACES[0].hex(), "span_id": S.TRACES[0][:8].hex(),
        "tokens_prompt": 311, "tokens_completion": 57, "tokens_total": 368, "temperature": 0.25, "max_tokens": 90,
    }


def test_messages_span_without_content(spark):
    row = mapped(spark, S.MESSAGES, SpanOptions(capture_llm_content=False))
    assert row["remote_addr"] == "2001:db8:7::f00d"
    assert row["endpoint"] == "llm://lighthouse/lighthouse-xl"
    assert (row["method"], row["body"], row["user_id"], row["user_agent"]) == ("llm_messages", None, None, "tracewell/1.0")
    assert row["ts"].isoformat() == "2025-11-05T13:39:59"
    assert row["custom"] == {
        "integration": "ai-gateway", "event_type": "messages", "provider": "lighthouse",
        "model": "lighthouse-xl", "response_model": "lighthouse-xl-0905", "duration_ms": 41.0, "status": "ok", "error": None,
        "streaming": True, "trace_id": S.TRACES[1].hex(), "span_id": S.TRACES[1][:8].hex(),
        "tokens_cache_write": 64, "tokens_reasoning": 12, "top_p": 0.9,
    }


def test_tool_call_span(spark):
    row = mapped(spark, S.TOOL_CALL)
    arguments = {"boat": "Marie", "nights": 2, "cvv": "901"}
    assert (row["remote_addr"], row["endpoint"]) == ("192.0.2.91", "mcp://harbour/book_berth")
    assert (row["scheme"], row["method"], row["body"]) == ("mcp", "mcp_tool_call", arguments)
    assert row["custom"] == {
        "integration": "ai-gateway", "mcp_server": "harbour", "handler_name": "book_berth",
        "event_type": "tool_call", "duration_ms": 12.5, "arguments": arguments, "error": None,
        "result_summary": None, "session_id": "tide-77", "client_name": "desk", "client_version": "8",
        "request_id": None, "mcp_transport": None, "mcp_protocol_version": None,
        "trace_id": S.TRACES[2].hex(), "span_id": S.TRACES[2][:8].hex(),
    }


def test_error_span(spark):
    row = mapped(spark, S.LLM_ERROR)
    assert row["error"] == row["custom"]["error"] == "no berth free"
    assert row["custom"]["status"] == row["status"] == "error"
    assert row["remote_addr"] is None and row["user_agent"] == "tracewell/1.0"


def test_error_type_without_status(spark):
    found = all_mapped(spark, [S.span("x", {"llm.model": "m", "error.type": "timeout"}),
                               S.span("x", {"llm.model": "m"}, status={"code": 2})])
    assert [(r["error"], r["status"]) for r in found] == [("timeout", "error"), ("error", "error")]


def test_route_from_span_events(spark):
    row = mapped(spark, S.TOOL_CALL_ROUTED)
    assert (row["mcp_server"], row["session_id"]) == ("harbour", "tide-78")


def test_resource_and_listing(spark):
    read, row = all_mapped(spark, [S.RESOURCE_READ, S.TOOLS_LIST])
    assert read["endpoint"] == "mcp://charts/chart://north/12"
    assert (row["endpoint"], row["method"], row["body"]) == ("mcp://harbour/schema_report", "mcp_schema_report", None)
    assert [t["name"] for t in row["custom"]["tools"]] == ["book_berth", "tides"]
    assert row["custom"]["tools"][0] == {"name": "book_berth", "description": "Reserve a berth", "input_schema": {"required": ["boat"]}}
    assert row["custom"]["resources"] == row["custom"]["prompts"] == []
    assert "duration_ms" not in row["custom"]


def test_outcomes(spark):
    df = map_spans(spans(spark, S.CHAT, S.TOOL_CALL, S.INITIALIZE, S.NOISE, S.span("l", {"mcp.method.name": "tools/list"})))
    assert [r.outcome for r in df.collect()] == ["llm", "mcp", "filtered", "ignored", "filtered"]
    kept, dropped = drop_unroutable_mcp(spans(spark, S.TOOL_CALL, S.INITIALIZE, S.NOISE))
    assert (kept.count(), dropped.count()) == (1, 1)


KINDS = [
    ({"mcp.method.name": None, "llm.model": "m"}, "mcp"),
    ({"llm.model_name": ""}, None),
    ({"gen_ai.request.model": "m"}, "llm"),
    ({"openinference.span.kind": "EMBEDDING"}, "llm"),
    ({"span.kind": "Llm"}, "llm"),
    ({"span.kind": "server"}, None),
    ({"span.kind": 5}, None),
    ({}, None),
]


def test_classify(spark):
    df = classify_spans(spans(spark, *[S.span("x", attrs) for attrs, _ in KINDS]))
    assert [r.kind for r in df.select("kind").collect()] == [kind for _, kind in KINDS]


METHODS = [
    ("ChatCompletions", {}, "llm_chat_completion"),
    ("x", {"gen_ai.operation.name": "text_completion"}, "llm_completion"),
    ("Create Embeddings", {}, "llm_embeddings"),
    ("MessagesStream", {}, "llm_messages"),
    ("my-completion", {}, "llm_completion"),
    ("responses", {}, "llm_call"),
]


def test_llm_method(spark):
    found = all_mapped(spark, [S.span(name, {"llm.model": "m", **attrs}) for name, attrs, _ in METHODS])
    assert [row["method"] for row in found] == [method for _, _, method in METHODS]


def test_embedding_model_and_provider_from_parameters(spark):
    row = mapped(spark, S.span("CreateEmbeddings", {
        "openinference.span.kind": "EMBEDDING",
        "embedding.invocation_parameters": '{"model": "text-embedding-3-small"}'}))
    assert row["endpoint"] == "llm://openai/text-embedding-3-small"
    row = mapped(spark, S.span("CreateEmbeddings", {"openinference.span.kind": "EMBEDDING"}))
    assert row["endpoint"] == "llm://unknown/unknown"


def test_tokens_only_numbers_and_zero_counts(spark):
    row = mapped(spark, S.span("x", {"llm.model": "m", "llm.token_count.prompt": "12", "gen_ai.usage.output_tokens": 7.9,
                                     "llm.token_count.total": 0, "gen_ai.usage.total_tokens": 9}))
    assert (row["tokens_prompt"], row["tokens_completion"], row["tokens_total"]) == (None, 7, 0)
    assert "tokens_prompt" not in row["custom"]


FLAGS = [
    ("true", True), ("0", False), ('"YES"', True), ('"no"', False), ("null", None), ("[1]", None),
]


def test_streaming_flag(spark):
    items = [S.span("x", {"llm.model": "m", "llm.invocation_parameters": f'{{"stream": {flag}}}'}) for flag, _ in FLAGS]
    assert [row["custom"]["streaming"] for row in all_mapped(spark, items)] == [expected for _, expected in FLAGS]


ARGUMENTS = [
    ({"mcp.tool.arguments": '{"name": "t", "arguments": {"a": 1}}'}, {"a": 1}),
    ({"input.value": '{"jsonrpc": "2.0", "params": {"arguments": {"b": 2}}}'}, {"b": 2}),
    ({"input.value": '{"jsonrpc": "2.0", "params": {}}'}, {}),
    ({"input.value": '{"method": "x"}'}, {}),
    ({"mcp.request.arguments": '{"plain": true}'}, {"plain": True}),
    ({"mcp.request.argument.city": "SF", "mcp.request.argument.opts": '{"x": 1}'}, {"city": "SF", "opts": {"x": 1}}),
    ({"mcp.tool.arguments": "not json", "mcp.request.argument.z": 1}, {"z": 1}),
    ({}, {}),
]


def test_arguments(spark):
    items = [S.span("x", {"mcp.method.name": "tools/call", "mcp.tool.name": "t", **attrs}) for attrs, _ in ARGUMENTS]
    for row, (_, expected) in zip(all_mapped(spark, items), ARGUMENTS, strict=True):
        assert row["custom"]["arguments"] == expected
        assert row["body"] == (expected or None)


def test_messages_in_numeric_order_with_tool_calls(spark):
    p = "llm.output_messages"
    attrs = {
        f"{p}.10.message.role": "assistant", f"{p}.10.message.content": "last",
        f"{p}.2.message.role": "assistant",
        f"{p}.2.message.tool_calls.1.tool_call.function.name": "second",
        f"{p}.2.message.tool_calls.0.tool_call.function.name": "first",
        f"{p}.2.message.tool_calls.0.tool_call.function.arguments": '{"q": 1}',
        f"{p}.x.message.role": "ignored", f"{p}.3.other": "ignored", "llm.output_messagesx.0.message.role": "no",
    }
    df = rebuild_messages(spans(spark, S.span("x", attrs)))
    (row,) = rows(df.select("input_messages", "output_messages"), "input_messages", "output_messages")
    assert row["input_messages"] is None
    assert row["output_messages"] == [
        {"role": "assistant", "tool_calls": [{"name": "first", "arguments": {"q": 1}}, {"name": "second", "arguments": None}]},
        {"role": "assistant", "content": "last"},
    ]


def test_attribute_values(spark):
    deep = {"k": 1}
    for _ in range(40):
        deep = {"k": deep}
    df = spans(spark, S.span("x", [("s", "a"), ("s", "b"), ("i", -3), ("d", 1.5), ("t", True), ("n", None),
                                   ("utf", b"ok"), ("bin", b"\xff\xfe"), ("list", ["a", 1, {"x": None}]), ("deep", deep)]))
    (row,) = rows(df.select(F.to_variant_object("attrs").alias("attrs")), "attrs")
    found = row["attrs"]
    assert [found[k] for k in ("s", "i", "d", "t", "n")] == ["b", -3, 1.5, True, None]
    assert (found["utf"], found["bin"]) == ("ok", "base64://4=")
    assert found["list"] == ["a", 1, {"x": None}]
    depth, node = 0, found["deep"]
    while isinstance(node, dict):
        depth, node = depth + 1, node["k"]
    assert (depth, node) == (32, None)


def test_span_attributes_win_over_event_attributes(spark):
    df = spans(spark, S.span("x", {"a": "top"}, events=[{"a": "1", "b": "1"}, {"b": "2"}]))
    (row,) = rows(df.select(F.to_variant_object("attrs").alias("attrs")), "attrs")
    assert row["attrs"] == {"a": "top", "b": "2"}


def test_non_finite_numbers_stay_at_their_value(spark):
    nested = {"kvlistValue": {"values": [{"key": "a", "value": {"doubleValue": "NaN"}}, {"key": "b", "value": {"doubleValue": "Infinity"}},
                                         {"key": "c", "value": {"doubleValue": 1.5}}, {"key": "d", "value": {"stringValue": "x"}}]}}
    item = S.span("x", {})
    item["attributes"] = [{"key": "n", "value": nested}, {"key": "m", "value": {"arrayValue": {"values": [{"intValue": "3"}]}}}]
    (row,) = rows(spans(spark, item).select(F.to_variant_object("attrs").alias("attrs")), "attrs")
    assert row["attrs"] == {"n": {"a": "NaN", "b": "Infinity", "c": 1.5, "d": "x"}, "m": [3]}


def test_a_span_of_many_turns_is_rebuilt_in_linear_time(spark):
    def seconds(turns):
        attrs = {}
        for i in range(turns):
            attrs[f"llm.input_messages.{i}.message.role"] = "user"
            attrs[f"llm.input_messages.{i}.message.content"] = f"turn {i}"
        for j in range(turns):
            attrs[f"llm.output_messages.0.message.tool_calls.{j}.tool_call.function.name"] = f"f{j}"
        df = rebuild_messages(spans(spark, S.span("x", attrs)).cache())
        df.select(F.col("attrs")).collect()
        began = time.perf_counter()
        row = df.select(F.to_json("input_messages").alias("i"), F.to_json("output_messages").alias("o")).first()
        spent = time.perf_counter() - began
        asked, answered = json.loads(row["i"]), json.loads(row["o"])
        assert [m["content"] for m in asked] == [f"turn {i}" for i in range(turns)]
        assert [c["name"] for c in answered[0]["tool_calls"]] == [f"f{j}" for j in range(turns)]
        return spent

    seconds(10)
    assert seconds(5000) < 10 * max(seconds(1000), 0.5)


def test_quarantine(spark):
    raw = spark.createDataFrame([(S.export(S.CHAT),), ("{bad",), ('{"resourceSpans": 3}',), ("x" * 200,)], "value string")
    reasons = [r.reason for r in decode_exports(raw, max_bytes=1 << 20).collect()]
    assert reasons == [None, "undecodable", "not_a_list", "undecodable"]
    good, bad = quarantine_undecodable(raw, max_bytes=100)
    assert good.count() == 0
    assert {r.reason for r in bad.collect()} == {"too_large", "undecodable", "not_a_list"}


def test_read_from_files(spark, tmp_path):
    (tmp_path / "a.json").write_text(S.export(S.CHAT, S.TOOL_CALL) + "\n" + S.export(S.NOISE) + "\n")
    assert read_otlp_traces(spark, str(tmp_path)).count() == 3


def test_refused_exports_are_kept_and_counted(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.json").write_text(S.export(S.CHAT) + "\n{bad\n" + "x" * 5000 + "\n{worse\n")
    found, refused = traces_and_refused(spark, str(tmp_path / "in"), max_bytes=4000)
    row = outcome_accounting(span_events(found), refused).first()
    assert (row["llm"], row["received"], row["exports_undecodable"], row["exports_too_large"]) == (1, 1, 2, 1)
    assert read_otlp_traces(spark, str(tmp_path / "in"), refused_path=str(tmp_path / "refused")).count() == 1
    kept = {r["value"]: r["reason"] for r in spark.read.parquet(str(tmp_path / "refused")).collect()}
    assert kept == {"{bad": "undecodable", "x" * 5000: "undecodable", "{worse": "undecodable"}


def test_finished_event_is_scrubbed(spark):
    chat, row, failed = all_finished(spark, [S.CHAT, S.TOOL_CALL, S.LLM_ERROR])
    assert chat["body"]["input"] == {"question": "When does the ferry leave?", "secret": "[REDACTED]"}
    assert chat["remote_addr"] == "192.0.2.44" and chat["size_action"] == "fits"
    assert failed["remote_addr"] == "unknown"
    assert row["body"] == row["custom_data"]["arguments"] == {"boat": "Marie", "nights": 2, "cvv": "[REDACTED]"}
    row = finished(spark, S.TOOL_CALL, SpanOptions(capture_mcp_arguments=False))
    assert (row["body"], row["custom_data"]["arguments"]) == (None, {})


def test_finished_event_caps(spark):
    item = S.span("x" , {"llm.model": "m" * 400, "http.user_agent": "u" * 2000, "user.id": "i" * 300,
                         "error.type": "e" * 3000, "input.value": "v" * 9000, "http.client_ip": "z" * 100})
    row = finished(spark, item, SpanOptions(user_id_attribute="user.id"))
    mark = "...[TRUNCATED]"
    assert row["model"] == "m" * 256
    assert row["user_agent"] == "u" * 1024 + mark and row["user_id"] == "i" * 256 + mark
    assert row["error"] == row["custom_data"]["error"] == "e" * 2048 + mark
    assert row["body"]["input"] == "v" * 8192 + mark
    assert row["remote_addr"] == "z" * 64


def test_size_stages(spark):
    big = {f"k{i}": "v" * 8000 for i in range(10)}
    item = S.span("x", {"mcp.method.name": "tools/call", "mcp.tool.name": "t", "mcp.tool.arguments": json.dumps(big),
                        "corr.session": "c" * 900})
    options = SpanOptions(extra_attributes=("corr.session",))
    row = finished(spark, item, options)
    assert (row["size_action"], row["body"], row["custom_data"]["arguments"]) == ("content_dropped", None, {})
    assert row["custom_data"]["content_dropped_oversize"] is True and row["custom_data"]["corr_session"] == "c" * 900
    assert row["event_bytes"] <= 57344
    row = finished(spark, item, options, max_bytes=1500)
    assert row["size_action"] == "extras_dropped" and "corr_session" not in row["custom_data"]
    assert row["custom_data"]["extras_dropped_oversize"] is True
    row = finished(spark, S.span("x", {"llm.model": "m", "http.user_agent": "u" * 1100}), max_bytes=1024)
    assert (row["size_action"], row["outcome"]) == ("dropped", "oversize")


def test_declared_lists_are_shed_and_scrubbed(spark):
    tools = [{"name": f"t{i}", "description": "d" * 8000, "inputSchema": {"token": "abc"}} for i in range(10)]
    item = S.span("x", {"mcp.method.name": "tools/list", "output.value": json.dumps(tools)})
    row = finished(spark, item, max_bytes=63488)
    assert (row["size_action"], row["custom_data"]["tools"]) == ("content_dropped", [])
    item = S.span("x", {"mcp.method.name": "tools/list", "output.value": json.dumps(tools[:1])})
    events = stored(span_events(spans(spark, item)))
    (row,) = rows(read_schema_reports(events), "input_schema")
    assert (row["item_kind"], row["name"], row["input_schema"]) == ("tool", "t0", {"token": "[REDACTED]"})


def test_no_stage_is_one_method_too_large_for_the_compiler(spark):
    """The JVM interprets methods of more than 8000 bytes; the mapping of spans makes such a one if it may."""
    from tracewell.session import prepare_session

    spark.conf.unset("spark.sql.codegen.hugeMethodLimit")
    assert int(prepare_session(spark).conf.get("spark.sql.codegen.hugeMethodLimit")) <= 8000


def test_names_are_those_of_the_flattened_attributes(spark):
    """The catalog reads no values: names come from the spans as decoded."""
    texts = [
        '{"resourceSpans":[{"scopeSpans":[{"spans":[{"attributes":[{"key":"a","value":{"intValue":"1"}},{"key":"a"},{"value":{"boolValue":true}},'
        '{"key":"list","value":{"arrayValue":{"values":[{"intValue":"1"}]}}}],"events":[{"attributes":[{"key":"b"},{"key":"a"}]},{"name":"e"}]},'
        '{"name":"none"},{"attributes":[],"events":[]},{"events":[{"attributes":[{"key":"","value":{"stringValue":"x"}}]}]}]}]}]}',
        '{"resource_spans":[{"scope_spans":[{"spans":[{"trace_id":"","attributes":[{"key":"b"},{"key":"map","value":{"kvlist_value":{"values":[]}}}]}]}]}]}',
    ]
    good, _ = quarantine_undecodable(spark.createDataFrame([(t,) for t in texts], "value string"))
    whole = merge_span_event_attributes(flatten_attributes(spans_of(good))).select(F.sort_array(F.map_keys("attrs")))
    named = attribute_names(spans_of(good)).select(F.sort_array("names"))
    assert sorted(r[0] for r in named.collect()) == sorted(r[0] for r in whole.collect())
    assert ["", "a", "b", "list"] in [r[0] for r in named.collect()]


def test_catalog_takes_names_or_maps(spark):
    rows = spark.createDataFrame([({"a": 1, "api_key": 2}, "t1"), ({"api_key": 2, "a": 1}, "t2"), ({"a": 3}, "t2"), ({}, None), (None, "t3")],
                                 "attrs map<string,int>, trace_id string")
    by_map = attribute_catalog(rows).select("name", "spans", "traces", "sensitive", "names_with_key")
    by_name = attribute_catalog(rows.withColumn("names", F.map_keys("attrs")), "names").select(*by_map.columns)
    want = [("a", 3, 2, False, 1), ("api_key", 2, 2, True, 1)]
    assert sorted(map(tuple, by_map.collect())) == sorted(map(tuple, by_name.collect())) == want


def test_sample_exports_shuffle_text(spark):
    plan = sample_tables.exports(spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert "collect_list(span" in plan and "collect_list(struct" not in plan
