import json

import pytest
from pyspark.sql import functions as F

from tests.test_privacy import KEY, R, apply, column, digest, parsed
from tracewell.functions.globs import glob_regex
from tracewell.operators import filters, requests
from tracewell.operators.rules import Rule
from tracewell.sources.http import REQUEST_SCHEMA, RequestOptions, http_events, read_http_log, split_metrics

PATHS = [
    ("/", [], [], True), ("/api/v1/users/42/profile", [], [], True), ("/api/v1/users", ["/api/**"], [], True),
    ("/admin/dashboard", ["/api/**"], [], False), ("/users/alice", ["/users/*"], [], True),
    ("/users/alice/profile", ["/users/*"], [], False), ("/users/alice/profile/avatar", ["/users/**"], [], True),
    ("/billing/invoices", ["/api/**", "/billing/**"], [], True), ("/internal/debug", [], ["/internal/**"], False),
    ("/api/v1/users", [], ["/internal/**"], True), ("/api/internal/secret", ["/api/**"], ["/api/internal/**"], False),
    ("/api/v1/users", ["/api/**"], ["/api/internal/**"], True), ("/api/v1/users/", ["/api/v1/users"], [], False),
    ("/api/v1/users/", ["/api/v1/users/"], [], True),
    ("/users", ["/users/**"], [], False), ("/users/", ["/users/**"], [], True), ("/a/b/c", ["/a/**/c"], [], True),
    ("/a/c", ["/a/**/c"], [], True), ("/x/y.json", ["**/*.json"], [], True), ("/y.txt", ["/[xy].{json,txt}"], [], True),
    ("/z.txt", ["/[!xy].txt"], [], True), ("/ab", ["/a?"], [], True), ("/a/", ["/a?"], [], False), ("/a.b", ["/a*b"], [], True),
    ("/aXb", ["/a.b"], [], False),
]


def test_paths(spark):
    for endpoint, capture, exclude, kept in PATHS:
        df = spark.createDataFrame([(endpoint,)], "endpoint string")
        assert filters.filter_paths(df, capture, exclude).count() == int(kept), (endpoint, capture, exclude)
    for bad in ("/a[", "/{a", "/a}"):
        with pytest.raises(ValueError):
            glob_regex(bad)


def test_content_types(spark):
    types = {"application/json": True, "application/json; charset=utf-8": True, "Application/JSON": True,
             "application/vnd.api+json": False, "application/ld+json": False, "text/json": False, "": False, None: False}
    assert apply(spark, list(types), filters.is_json_type) == list(types.values())


LLM_PATHS = [
    "/v1/chat/completions", "/openai/deployments/d/chat/completions", "/v1/completions", "/v1/embeddings", "/v1/messages",
    "/v1/messages/batches", "/v1beta/models/g:generateContent", "/x:streamGenerateContent", "/model/m/converse",
    "/model/m/converse-stream", "/model/m/invoke", "/model/m/invoke-with-response-stream", "/v1/responses",
    "/v1/p:predict", "/v1/p:rawPredict", "/v1/p:streamRawPredict", "/model/invoke",
]
PLAIN_PATHS = ["/api/orders", "/rpc/invoke", "/predict", "/completions/x", "/messages", "/v2/responses", "/converse/x"]
SHAPES = [
    ({"messages": [{"role": "user"}]}, True), ({"messages": [{"x": 1}]}, False), ({"messages": "x"}, False),
    ({"model": "m", "input": "x"}, True), ({"model": "m", "chat_history": []}, True), ({"model": "m"}, False),
    ({"contents": [{"parts": []}]}, True), ({"contents": [1]}, False), ({"prompt": "x", "top_p": 1}, True),
    ({"prompt": "x"}, False), ({"anthropic_version": "1"}, True), ({"inputText": "x", "textGenerationConfig": {}}, True),
    ({"inputText": "x"}, False), ([{"role": "u", "content": "x"}], True), ([{"a": 1}, {"role": "u", "content": "x"}], False),
    ([], False), ({}, False), ({"message": "hi"}, False),
]


def test_ai_content(spark):
    assert apply(spark, LLM_PATHS, filters.is_llm_path) == [True] * len(LLM_PATHS)
    assert apply(spark, PLAIN_PATHS, filters.is_llm_path) == [False] * len(PLAIN_PATHS)
    texts = [json.dumps(s) for s, _ in SHAPES]
    assert apply(spark, texts, lambda c: filters.is_prompt_shaped(F.parse_json(c))) == [e for _, e in SHAPES]
    df = spark.createDataFrame([("/api", '{"jsonrpc":"2.0","messages":[{"role":"u"}]}'), ("/v1/messages", '{"jsonrpc":"2.0"}'),
                                ("/api", '{"messages":[{"role":"u"}]}'), ("/api", '{"a":1}')], "endpoint string, body string")
    df = df.withColumn("body", F.parse_json("body"))
    assert [r.body is not None for r in filters.withhold_ai_bodies(df).collect()] == [True, False, False, True]
    assert filters.withhold_ai_bodies(df, capture_ai_content=True).filter("body is null").count() == 0


def test_health(spark):
    df = spark.createDataFrame([(p,) for p in ("/health", "/health/", "/api/Ready", "mcp://s/health", "llm://a/live", "/", "/x")],
                               "endpoint string")
    assert filters.drop_health_exact(df).count() == 6
    assert [r.ingest for r in filters.split_health_segment(df).collect()] == [
        "skipped", "skipped", "skipped", "accepted", "accepted", "accepted", "accepted"]
    assert filters.split_health_segment(df, exempt_ai_schemes=False).filter("ingest = 'skipped'").count() == 5


def test_sampling(spark):
    df = spark.range(20000)
    assert filters.sample_requests(df, float("nan")).count() == 20000
    assert filters.sample_requests(df, 7.0).count() == 20000
    assert filters.sample_requests(df, -1.0).count() == 0
    for sampled in (filters.sample_requests(df, 0.3, seed=1), filters.sample_requests(df, 0.3, key="id")):
        assert abs(sampled.count() - 6000) < 300


def test_body_rules(spark):
    rows = [("POST", "application/json", '{"a":1}'), ("put", "Application/JSON", "[1]"), ("GET", "application/json", "{}"),
            ("PATCH", "text/plain", "{}"), ("POST", "application/json", "5"), ("POST", "application/json", "{bad"),
            ("POST", "application/json", ""), ("POST", None, "{}")]
    df = spark.createDataFrame(rows, "method string, content_type string, body string")
    assert [r.body is not None for r in filters.body_eligible(df).collect()] == [True, True] + [False] * 6
    rows = [("application/json", None, False, '{"a":1}'), ("application/json", "Identity", False, "[]"),
            ("application/json", "GZIP", False, "x"), ("application/json", None, True, "{}"), ("text/html", "gzip", False, "x")]
    df = spark.createDataFrame(rows, "response_type string, response_encoding string, s boolean, response_body string")
    out = filters.response_body_eligible(df, streaming="s").select(F.to_json("response_body").alias("b")).collect()
    assert [r.b for r in out] == ['{"a":1}', "[]", '{"body_skipped_encoding":"gzip"}', None, None]


def test_headers(spark):
    pairs = [(":path", "/"), ("x-api-key", "k"), ("AUTHORIZATION", "Bearer 1"), ("accept", "a"), ("Accept", "b"), ("Set-Cookie", "c")]
    df = spark.createDataFrame([(pairs,), ([(":path", "/")],), ([],)], "headers array<struct<name:string,value:string>>")
    got = [r.headers for r in requests.build_headers(df, secret=KEY).collect()]
    assert got == [{"X-Api-Key": R, "Authorization": digest("Bearer 1"), "Accept": "a, b", "Set-Cookie": R}, None, None]
    assert requests.build_headers(df).first().headers["Authorization"] == R
    assert requests.build_headers(df, allow=[" ", "ACCEPT "]).first().headers == {"Accept": "a, b"}
    assert len(requests.build_headers(df, allow=[" "]).first().headers) == 4
    meta = spark.createDataFrame([({"HTTP_X_API_KEY": "k", "CONTENT_TYPE": "t", "SERVER_NAME": "s", "HTTP_ACCEPT": "a",
                                    "AUTHORIZATION": "raw", "HTTP_AUTHORIZATION": "Bearer 1"},)], "m map<string,string>")
    assert meta.select(requests.server_headers(F.col("m"), KEY).alias("h")).first().h == {
        "X-Api-Key": R, "Content-Type": "t", "Accept": "a", "Authorization": digest("Bearer 1")}


def test_query(spark):
    queries = {"a=1&b=2&a=3": {"a": ["1", "3"], "b": ["2"]}, "q=a+b%20c&flag": {"q": ["a b c"], "flag": [""]},
               "bad=%zz&x=%41": {"bad": ["%zz"], "x": ["A"]}, "": None, None: None, "&&": None, "k=a=b": {"k": ["a=b"]},
               "%6Bey=v": {"key": ["v"]}}
    assert apply(spark, list(queries), requests.query_params) == list(queries.values())
    df = spark.createDataFrame([("/p?Token=a&Token=b&n=1-2?x&ref=9",), ("/p",)], "path string")
    rules = [Rule(r"\d-\d"), Rule("^ref$", scope="keys", action="hash")]
    rows = requests.parse_query(df, rules=rules, secret=KEY).collect()
    assert rows[0].endpoint == "/p" and rows[0].query_params == {"Token": [R], "n": [f"{R}?x"], "ref": [digest("9")]}
    assert (rows[1].endpoint, rows[1].query_params) == ("/p", None)


def test_request_log_to_events(spark, tmp_path):
    def request(i, path, body="", method="post", **headers):
        pairs = [{"name": k.replace("_", "-"), "value": v} for k, v in headers.items()]
        return json.dumps({"event_id": str(i), "ts": "2026-01-01T00:00:00Z", "method": method, "scheme": "HTTPS", "path": path,
                           "headers": pairs, "body": body, "source_address": "[::1]:9", "metrics": '{"token": 1, "n": 2}'})

    lines = [
        request(1, "/api/x?token=t", '{"password":"p","note":"ssn 123-45-6789"}', content_type="application/json",
                x_forwarded_for="10.0.0.1:5, 9.9.9.9", user_agent="ua", x_user="u1"),
        request(2, "/health"), request(3, "/internal/y"),
        request(4, "/v1/messages", '{"jsonrpc":"2.0"}', content_type="application/json"),
        request(5, "/api/z", '{"messages":[{"role":"u"}]}', content_type="application/json"),
        request(6, "/api/z", '{"jsonrpc":"2.0","messages":[{"role":"u"}]}', content_type="application/json"),
    ]
    (tmp_path / "log.json").write_text("\n".join(lines))
    options = RequestOptions(secret=KEY, exclude_paths=("/internal/**",), user_id_header="X-User", capture_ai_content=False,
                             rules=(Rule(r"\d{3}-\d{2}-\d{4}"),))
    events = read_http_log(spark, str(tmp_path), options)
    rows = {r.event_id: r for r in events.withColumns({c: F.to_json(c) for c in ("body", "custom_data")}).collect()}
    assert sorted(rows) == ["1", "4", "5", "6"]
    one = rows["1"]
    assert json.loads(one.body) == {"password": R, "note": f"ssn {R}"}
    assert (one.remote_addr, one.scheme, one.method, one.user_id) == (digest("10.0.0.1"), "https", "POST", "u1")
    assert one.query_params == {"token": [R]} and json.loads(one.custom_data) == {"token": R, "n": 2}
    assert rows["4"].remote_addr == digest("::1")
    assert [rows[i].body is not None for i in "456"] == [False, False, True]


def test_response_capture_and_metrics(spark):
    row = ("1", None, "GET", "http", "/x", [], "", None, '{"secret":"s","k":1}', "application/json", None, None)
    df = spark.createDataFrame([row], REQUEST_SCHEMA)
    event = http_events(df, RequestOptions(capture_response_body=True)).select(F.to_json("response_body").alias("b")).first()
    assert json.loads(event.b) == {"secret": R, "k": 1}
    texts = ['{"_metrics": {"cvv": 1, "m": 2}, "a": 1}', '{"_metrics": 5, "a": 1}', "[1]"]
    out = split_metrics(column(spark, texts).select("i", F.parse_json("v").alias("response_body")))
    assert parsed(out, "custom_data") == [{"cvv": R, "m": 2}, {}, {}]
    assert parsed(out, "response_body") == [{"a": 1}, {"a": 1}, [1]]


def test_cheap_tests_come_first(spark, sf_dir):
    from tracewell.plans.registered import QUERIES

    plan = QUERIES["filter_paths"](spark, sf_dir)._jdf.queryExecution().toString()
    assert "ReadSchema: struct<page_id:bigint,url:string>" in plan and "Exchange" not in plan
