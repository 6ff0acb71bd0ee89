import json
from datetime import datetime, timedelta

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tests.test_privacy import KEY, R, digest
from tracewell.operators import accounting, analytics, timeline
from tracewell.operators.extras import attribute_names, check_extras
from tracewell.sinks import writers
from tracewell.sources import mcp

T0 = datetime(2026, 1, 1)


def calls(spark, rows, schema="event_id bigint, session_id string, handler_name string, ts timestamp, status string"):
    return spark.createDataFrame(rows, schema)


@pytest.fixture(scope="module")
def hot(spark):
    """6000 calls: one session holds a third, one is null, ties in time occur."""
    key = F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 50 == 1, F.lit(None)).otherwise(
        F.concat(F.lit("s"), (F.col("id") % 40).cast("string")))
    return spark.range(6000).select(
        F.col("id").alias("event_id"), key.alias("session_id"),
        F.concat(F.lit("h"), (F.xxhash64("id") % 3).cast("string")).alias("handler_name"),
        F.timestamp_seconds(F.lit(1767225600) + (F.pmod(F.xxhash64(F.col("id") + 7), F.lit(9000)) * 97)).alias("ts"),
        F.when(F.pmod(F.xxhash64(F.col("id") + 3), F.lit(3)) > 0, "error").otherwise("ok").alias("status"),
    ).cache()


def same(got, want, *cols):
    assert sorted(map(str, got.select(*cols).collect())) == sorted(map(str, want.select(*cols).collect()))


@pytest.mark.parametrize("run_rows", [7, 100, 10**7])
def test_timeline_equals_plain_windows(hot, run_rows):
    plain = Window.partitionBy("session_id").orderBy("ts", "event_id")
    prev = timeline.with_previous(hot, ["session_id"], ["event_id", "ts"], run_rows=run_rows)
    same(prev, hot.withColumns({"prev_event_id": F.lag("event_id").over(plain), "prev_ts": F.lag("ts").over(plain)}),
         "event_id", "prev_event_id", "prev_ts")
    after = timeline.with_next(hot, ["session_id"], ["event_id"], run_rows=run_rows)
    same(after, hot.withColumn("next_event_id", F.lead("event_id").over(plain)), "event_id", "next_event_id")
    total = timeline.with_running_total(hot, ["session_id"], F.col("event_id") % 5, "total", run_rows=run_rows)
    same(total, hot.withColumn("total", F.sum(F.col("event_id") % 5).over(plain)), "event_id", "total")
    mark = F.col("handler_name") == "h1"
    last = timeline.with_latest(hot, ["session_id"], mark, ["event_id"], run_rows=run_rows)
    frame = Window.partitionBy("session_id").orderBy(F.unix_micros("ts")).rangeBetween(Window.unboundedPreceding, -1)
    best = F.max(F.when(mark, F.struct("ts", "event_id"))).over(frame)
    same(last, hot.withColumn("last_event_id", best["event_id"]), "event_id", "last_event_id")


@pytest.mark.parametrize("run_rows", [7, 100, 10**7])
def test_group_numbers_equal_plain_windows(hot, run_rows):
    plain = Window.partitionBy("session_id").orderBy("ts", "event_id")
    got = analytics.sessionize(hot, 300, ["session_id"], run_rows=run_rows)
    fresh = F.coalesce((F.unix_micros("ts") - F.unix_micros(F.lag("ts").over(plain)) > 300_000_000).cast("int"), F.lit(1))
    want = hot.withColumn("fresh", fresh).withColumn("session_no", F.sum("fresh").over(plain))
    same(got, want, "event_id", "session_no")


def test_rows_without_time_are_kept(spark):
    df = calls(spark, [(1, "s", "a", None, "ok"), (2, "s", "b", T0, "ok"), (3, "s", "c", None, "ok")])
    got = timeline.with_previous(df, ["session_id"], ["event_id"]).orderBy("event_id").collect()
    assert [r.prev_event_id for r in got] == [None, 3, 1]


def test_a_hot_key_is_spread(hot):
    line = timeline._Timeline(hot, ["session_id"], "ts", "event_id", 100)
    sizes = line.rows.groupBy("_key", "_run").count()
    assert sizes.agg(F.max("count")).first()[0] < 300 < hot.filter("session_id = 'hot'").count()


@pytest.fixture(scope="module")
def one_second(spark):
    """3000 calls of one session at two times only, some rows without any."""
    return spark.range(3000).select(
        F.col("id").alias("event_id"), F.lit("hot").alias("session_id"),
        F.when(F.col("id") % 100 > 0, F.timestamp_seconds(F.lit(1767225600) + F.floor(F.col("id") / 2000))).alias("ts"),
        F.when(F.pmod(F.xxhash64("id"), F.lit(5)) == 0, "h1").otherwise("h2").alias("handler_name")).cache()


@pytest.mark.parametrize("mark", ["h1", "h2", "none"])
def test_a_key_within_one_second_is_cut_by_the_tie(one_second, mark):
    line = timeline._Timeline(one_second, ["session_id"], "ts", "event_id", 100)
    assert line.rows.groupBy("_run").count().agg(F.max("count")).first()[0] < 300
    frame = Window.partitionBy("session_id").orderBy(F.unix_micros("ts")).rangeBetween(Window.unboundedPreceding, -1)
    marked = F.col("handler_name") == mark
    best = F.max(F.when(marked, F.struct(F.unix_micros("ts").alias("at"), "event_id"))).over(frame)
    got = timeline.with_latest(one_second, ["session_id"], marked, ["event_id"], run_rows=100)
    want = one_second.withColumn("last_event_id", F.when(F.col("ts").isNotNull(), best["event_id"]))
    same(got.filter("ts IS NOT NULL"), want.filter("ts IS NOT NULL"), "event_id", "last_event_id")
    plain = Window.partitionBy("session_id").orderBy("ts", "event_id")
    got = timeline.with_previous(one_second, ["session_id"], ["event_id"], run_rows=100)
    same(got, one_second.withColumn("prev_event_id", F.lag("event_id").over(plain)), "event_id", "prev_event_id")


def test_a_cut_timeline_reads_its_input_once(spark, hot, tmp_path):
    hot.write.parquet(str(tmp_path / "hot"))
    df = spark.read.parquet(str(tmp_path / "hot"))
    got = timeline.with_running_total(df, ["session_id"], F.lit(1), "n", run_rows=100)
    got.collect()
    plan = got._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("FileScan parquet") == 1 and "ReusedExchange" in plan


def test_streaks_chains_and_graph(spark):
    rows = [(i, "s", h, T0 + timedelta(minutes=m), st) for i, (h, m, st) in enumerate([
        ("read", 0, "ok"), ("post", 5, "error"), ("post", 70, "error"), ("post", 200, "error"), ("read", 201, "ok"),
        ("read", 260, "error"), ("post", 261, "ok"), ("post", 261, "ok")])]
    df = calls(spark, rows)
    (streak,) = analytics.repeated_failures(df, 3, keys=("session_id",)).collect()
    assert (streak.failures, streak.first_ts, streak.last_ts) == (3, T0 + timedelta(minutes=5), T0 + timedelta(minutes=200))
    chain = analytics.chain_matches(df, F.col("handler_name") == "read", F.col("handler_name") == "post", 600)
    assert {(r.event_id, r.last_event_id, r.gap_s) for r in chain.collect()} == {(1, 0, 300.0), (6, 5, 60.0), (7, 5, 60.0)}
    edges = {(r.src, r.dst): r.n for r in analytics.call_graph(df).collect()}
    assert edges == {("read", "post"): 2, ("post", "post"): 3, ("post", "read"): 1, ("read", "read"): 1}


def test_correlation_ignores_the_sentinel(spark):
    def row(i, kind, corr, minute):
        return (i, kind, corr, T0 + timedelta(minutes=minute), "s", "t", "m")

    df = spark.createDataFrame([row(1, "llm", R, 0), row(2, "mcp", R, 1), row(3, "llm", "c", 0), row(4, "llm", "c", 2),
                                row(5, "mcp", "c", 3), row(6, "mcp", "c", 200), row(7, "mcp", None, 1)],
                               "event_id bigint, kind string, corr string, ts timestamp, mcp_server string, handler_name string,"
                               " model string")
    got = analytics.correlate_llm_mcp(df, "corr", 3600).collect()
    assert [(r.mcp_event_id, r.llm_event_id, r.lag_s) for r in got] == [(5, 4, 60.0)]


def test_batches_spread_and_keep_order(spark, hot):
    wire = hot.withColumns({"kind": F.lit("mcp"), "wire": F.to_json(F.struct("event_id"))})
    out = writers.batch_envelopes(wire, 50, run_rows=300)
    rows = out.orderBy("batch_no").collect()
    assert [r.n for r in rows] == [50] * 120
    ids = [e["event_id"] for r in rows for e in json.loads(r.envelope)["events"]]
    assert ids == [r.event_id for r in hot.orderBy("ts", "event_id").collect()]
    with pytest.raises(ValueError):
        writers.batch_envelopes(wire, 1001)


def test_batches_shuffle_only_what_an_envelope_holds(spark, hot):
    wire = hot.withColumns({"kind": F.lit("mcp"), "wire": F.to_json(F.struct("event_id")), "unsent": F.repeat("status", 100)})
    plan = writers.batch_envelopes(wire, 50, run_rows=300)._jdf.queryExecution().optimizedPlan().toString()
    assert "batch_no" in plan and "unsent" not in plan


def test_batches_are_posted_once(spark, tmp_path):
    posted, acks = tmp_path / "posted", str(tmp_path / "acks")
    posted.mkdir()
    df = spark.createDataFrame([(f"b{i}", 1, f"e{i}") for i in range(12)], "batch_id string, n bigint, envelope string").repartition(4)

    def post(envelope, broken=()):
        if envelope in broken:
            raise KeyboardInterrupt  # the worker dies, not only this post
        with open(posted / envelope, "a") as out:
            out.write("x")
        return 200, "{}"

    with pytest.raises(Exception):
        writers.deliver_once(df, lambda e: post(e, ("e7",)), acks).collect()
    done = writers.deliver_once(df, post, acks)
    assert sorted(r["batch_id"] for r in done.collect()) == sorted(f"b{i}" for i in range(12)) and done.count() == 12
    before = {p.name: p.read_text() for p in posted.iterdir()}
    assert len(before) == 12 and before["e7"] == "x"
    again = writers.deliver_once(df.union(spark.createDataFrame([("b12", 1, "e12")], df.schema)), post, acks)
    assert again.count() == 13 and again.count() == 13
    assert {p.name: p.read_text() for p in posted.iterdir()} == {**before, "e12": "x"}


def test_delivery(spark):
    df = spark.createDataFrame([(str(i), 2, f'{{"i":{i}}}') for i in range(5)], "batch_id string, n bigint, envelope string")

    def post(envelope):
        i = json.loads(envelope)["i"]
        if i == 4:
            raise OSError("down")
        return [(200, '{"accepted": 1, "skipped": "x"}'), (302, ""), (500, ""), (204, "junk")][i]

    acks = writers.deliver(df, post)
    assert accounting.delivery_accounting(acks).first().asDict() == {"posted": 4, "post_failures": 3, "accepted": 1, "skipped": 0}
    assert writers.counters("[1]") == (0, 0) and writers.counters('{"accepted": "3"}') == (3, 0)


def test_call_events(spark):
    record = ("1", T0, "srv", "tool", "tool_call", '{"token": "x", "q": 1}', "[1, 2]", None, 1.23456, None, "c", "1", "9", "cl", None)
    rows = [record, ("2", *record[1:7], "ValueError", 2.0, "s", "c", "1", "9", "cl", "FE80::1%e")]
    events = mcp.session_identity(mcp.call_events(spark.createDataFrame(rows, mcp.CALL_SCHEMA), secret=KEY))
    one, two = events.withColumns({c: F.to_json(c) for c in ("body", "custom_data")}).orderBy("event_id").collect()
    assert (one.endpoint, one.method, one.remote_addr, one.user_id) == ("mcp://srv/tool", "mcp_tool_call", "mcp-local", "cl")
    assert json.loads(one.body) == {"token": R, "q": 1} and one.session_id == "no-session"
    assert json.loads(one.custom_data) == {
        "mcp_server": "srv", "handler_name": "tool", "event_type": "tool_call", "duration_ms": 1.23, "error": None,
        "result_summary": "list(len=2)", "session_id": None, "client_name": "c", "client_version": "1", "request_id": "9",
        "mcp_client_id": "cl"}
    assert (two.remote_addr, two.error, two.result_summary, two.status) == (digest("fe80::1"), "ValueError", None, "error")


def test_wire_forms(spark):
    df = spark.sql("select timestamp'2026-05-02 23:14:05.1' ts, null remote_addr, '/x' endpoint, 'https' scheme, 'GET' method,"
                   " cast(null as variant) body, map('q', array('1'), 'r', array('a','b')) query_params, 'ua' user_agent")
    wire = json.loads(writers.to_wire(df).first().wire)
    assert wire == {"remote_addr": None, "endpoint": "/x", "scheme": True, "method": "GET",
                    "timestamp": "2026-05-02T23:14:05.100000+00:00", "query_params": {"q": "1", "r": ["a", "b"]}, "user_agent": "ua"}
    full = json.loads(writers.to_wire(df.withColumn("scheme", F.lit("mcp")), {"api_key": "k", "client_id": "c", "token": "k"}).first().wire)
    assert (full["api_key"], full["scheme"], full["body"], full["response_body"]) == ("k", "mcp", None, None)


def test_write_events(spark, tmp_path):
    df = spark.sql("select 'e' event_id, timestamp'2026-01-01 01:00:00' ts, 'llm' kind, outcome, parse_json('{\"a\":1}') body"
                   " from values ('llm'), ('ignored'), ('oversize') t(outcome)")
    writers.write_events(df, str(tmp_path / "t"))
    back = spark.read.parquet(str(tmp_path / "t"))
    assert back.count() == 1 and str(back.first().date) == "2026-01-01"
    writers.write_events(df, str(tmp_path / "t"), spread=2)
    assert spark.read.parquet(str(tmp_path / "t")).count() == 2


def test_admission(spark, hot):
    admitted = accounting.admit_bounded(hot, 5, "1 hour", ["session_id"])
    report = accounting.admission_report(hot, 5, "1 hour", ["session_id"]).agg(F.sum("admitted"), F.sum("dropped")).first()
    assert admitted.count() == report[0] and report[0] + report[1] == 6000
    assert "WindowGroupLimit" in admitted._jdf.queryExecution().executedPlan().toString()


def test_inventory_reports(spark):
    df = spark.sql("""select 1 event_id, timestamp'2026-01-01' ts, 'mcp_schema_report' method, 's' mcp_server, parse_json('{
        "tools":[{"name":"a","description":"d","input_schema":{"x":1}}], "resources":[{"uri_template":"u","name":"n"}],
        "prompts":[{"name":"p","arguments":[{"name":"q","required":true}]}]}') custom_data
        union all select 2, timestamp'2026-01-02', 'mcp_schema_report', 's', parse_json('{"tools":[],"resources":[],"prompts":[]}')
        union all select 3, timestamp'2026-01-03', 'mcp_tool_call', 's', parse_json('{"tools":[{"name":"z"}]}')""")
    rows = mcp.read_schema_reports(df).orderBy("item_kind").collect()
    assert [(r.event_id, r.item_kind, r.name) for r in rows] == [(1, "prompt", "p"), (1, "resource", "u"), (1, "tool", "a")]
    again = df.unionByName(df.filter("event_id = 1").withColumn("event_id", F.lit(9)))
    assert mcp.one_report_per_server(mcp.read_schema_reports(again)).count() == 3


@pytest.mark.parametrize("extras, hashed", [
    (["llm.system"], []), ([], ["MCP.session.id"]), (["gen_ai.request.seed"], []), (["http.client_ip"], []),
    (["tenant-id"], ["tenant.id"]), (["mcp.request.argument.x"], [])])
def test_refused_attributes(spark, extras, hashed):
    with pytest.raises(ValueError):
        check_extras(extras, hashed, ("http.client_ip", None))


def test_attribute_limits(spark):
    assert attribute_names([" a ", "a", "", "b"], "x") == ("a", "b")
    check_extras(["corr.session"], ["corr.session"])
    for names in (["n" * 129], [f"a{i}" for i in range(21)]):
        with pytest.raises(ValueError):
            attribute_names(names, "x")


def test_extras_on_spans(spark):
    from tests.fixtures import spans as S
    from tests.test_spans import all_mapped
    from tracewell.operators.spans import SpanOptions

    attrs = {"llm.model": "m", "tenant.id": "t1", "app.list": ["a", {"password": "p", "http.header.cookie": "c"}],
             "x.api-key": "secret", "corr.id": "c-1", "zone": 5, "long": "é" * 500, "trace.id": "spoof", "raw": b"\xff"}
    options = SpanOptions(extra_attributes=("tenant.id", "app.list", "x.api-key", "zone", "long", "trace.id", "none", "raw"),
                          hash_attributes=("corr.id", "tenant.id"), secret=KEY)
    import dataclasses
    row, bare = all_mapped(spark, [S.span("x", attrs), S.span("x", {"llm.model": "m"})], options)
    extras = {k: json.loads(str(v)) if v is not None else None for k, v in row["extras"].items()}
    assert extras.pop("long").startswith("é" * 100) and bare["extras"] == {}
    assert json.loads(extras.pop("app_list")) == ["a", {"password": R, "http.header.cookie": R}]
    assert extras == {"tenant_id": digest("t1"), "x_api_key": R, "corr_id": digest("c-1"), "zone": 5, "raw": "base64:/w=="}
    assert row["custom"]["trace_id"] == S.TRACES[3].hex()
    (row,) = all_mapped(spark, [S.span("x", attrs)], dataclasses.replace(options, secret=None))
    assert str(row["extras"]["corr_id"]) == f'"{R}"'
