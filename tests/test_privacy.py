import hashlib
import hmac
import json
import re

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tracewell.constants import SENSITIVE_KEYS
from tracewell.functions.hashing import hmac_hex, pseudonym
from tracewell.functions.ip import forwarded_ip, normalize_ip, strip_port
from tracewell.functions.names import SENSITIVE_NAME, is_sensitive_name, name_key
from tracewell.operators import privacy
from tracewell.operators.rules import Rule, check_rules
from tracewell.operators.sizing import json_size

KEY = "unit-test-key"
SSN = r"\b\d{3}-\d{2}-\d{4}\b"
R = "[REDACTED]"


def digest(text, key=KEY):
    return hmac.new(key.encode(), text.encode(), hashlib.sha256).hexdigest()


def column(spark, values, dtype="string"):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {dtype}")


def apply(spark, values, expression, dtype="string"):
    rows = column(spark, values, dtype).select("i", expression(F.col("v")).alias("out")).orderBy("i").collect()
    return [r.out for r in rows]


def parsed(df, col="v"):
    return [json.loads(r.out) if r.out is not None else None
            for r in df.select("i", F.to_json(col).alias("out")).orderBy("i").collect()]


def test_hmac(spark):
    values = ["192.168.1.1", "::1", "Bearer abc123token", "é", "", None]
    for key in (KEY, "k" * 100):
        assert apply(spark, values, lambda c, k=key: hmac_hex(c, k)) == [
            None if v is None else digest(v, key) for v in values]
    # RFC 4231, case 2
    assert apply(spark, ["what do ya want for nothing?"], lambda c: hmac_hex(c, "Jefe")) == [
        "5bdcc146bf60754e6a042426089575c75a003f089d2739839dec58b964ec3843"]


def test_missing_key(spark):
    assert apply(spark, ["a", None], lambda c: pseudonym(c, None)) == [R, None]
    assert apply(spark, ["a", None], lambda c: pseudonym(c, None, "pass")) == ["a", None]
    shown = apply(spark, ["fe80::1%e", "", None, "z" * 90], lambda c: privacy.address_pseudonym(c, None))
    assert shown == ["fe80::1", "unknown", "unknown", "z" * 64]


IPS = {
    "192.168.1.1": "192.168.1.1", "127.0.0.1": "127.0.0.1", "0.0.0.0": "0.0.0.0", "::1": "::1",
    "0000:0000:0000:0000:0000:0000:0000:0001": "::1", "fe80::1": "fe80::1", "fe80::1%eth0": "fe80::1",
    "fe80::1%25en0": "fe80::1", "fe80::1%2": "fe80::1", "::ffff:192.168.1.1": "::ffff:c0a8:101", "": "",
    "not-an-ip": "not-an-ip", "12.foo.3.4": "12.foo.3.4", None: None, "2001:DB8::00A0": "2001:db8::a0",
    "::": "::", "1::": "1::", "1:0:0:2:0:0:0:3": "1:0:0:2::3", "1:0:0:2:3:0:0:4": "1::2:3:0:0:4",
    "1:0:2:3:4:5:6:7": "1:0:2:3:4:5:6:7", "1::3:4:5:6:7:8": "1:0:3:4:5:6:7:8", "1:2:3:4:5:6:7::": "1:2:3:4:5:6:7:0",
    "1::2::3": "1::2::3", "1:2:3:4:5:6:7:8:9": "1:2:3:4:5:6:7:8:9", "256.1.1.1": "256.1.1.1", "01.2.3.4": "01.2.3.4",
    ":::": ":::", "12345::": "12345::", " 10.0.0.1 %x": "10.0.0.1", "::1.2.3.4": "::102:304", "1.2.3": "1.2.3",
}


def test_normalize_ip(spark):
    assert apply(spark, list(IPS), normalize_ip) == list(IPS.values())


def test_hops_and_ports(spark):
    assert apply(spark, ["1.2.3.4:5678", "[::1]:80", "[::1]", "1.2.3.4", "::1", "[oops"], strip_port) == [
        "1.2.3.4", "::1", "::1", "1.2.3.4", "::1", "[oops"]
    hops = ["203.0.113.7:99, 10.0.0.1", ",10.0.0.1", " ", None]
    assert apply(spark, hops, lambda c: forwarded_ip(c, F.lit("9.9.9.9:1"))) == ["203.0.113.7", "9.9.9.9", "9.9.9.9", "9.9.9.9"]
    assert apply(spark, hops, lambda c: forwarded_ip(c, mode="span")) == ["203.0.113.7:99", "10.0.0.1", None, None]


def nest(depth, leaf):
    for _ in range(depth):
        leaf = {"a": leaf}
    return leaf


REDACT = [
    *[({k.upper() if i % 2 else k: "x", "keep": 1}, {k.upper() if i % 2 else k: R, "keep": 1})
      for i, k in enumerate(SENSITIVE_KEYS)],
    ({"user": {"name": "a", "credentials": {"token": "x"}}}, {"user": {"name": "a", "credentials": R}}),
    ({"l1": {"l2": {"password": "x", "value": 42}}}, {"l1": {"l2": {"password": R, "value": 42}}}),
    ([{"u": "a", "password": "x"}, "plain", {"k": 1}], [{"u": "a", "password": R}, "plain", {"k": 1}]),
    ({"m": [[{"secret": "x"}], [{"value": "y"}]]}, {"m": [[{"secret": R}], [{"value": "y"}]]}),
    ([1, "hello", True, None], [1, "hello", True, None]),
    ({}, {}), ([], []),
    ({"name": "a", "age": 30, "active": True, "score": 9.5}, {"name": "a", "age": 30, "active": True, "score": 9.5}),
    (nest(22, 1), nest(21, R)),
    (nest(21, 1), nest(21, 1)),
    ({"tokens": 1, "my_password": "kept"}, {"tokens": 1, "my_password": "kept"}),
]


def test_redact_json(spark):
    df = column(spark, [json.dumps(i) for i, _ in REDACT])
    assert parsed(privacy.redact_json(df, "v")) == [o for _, o in REDACT]
    typed = df.withColumn("v", F.parse_json("v"))
    assert parsed(privacy.redact_json(typed, "v")) == [o for _, o in REDACT]


def test_redact_json_edges(spark):
    texts = ['{"pass\\u0077ord": 1}', "{bad", None, '"bare"', '{"password" : 1, "password" : 2}', '{"t\\u212aen": 1}']
    assert parsed(privacy.redact_json(column(spark, texts), "v"))[:5] == [{"password": R}, None, None, "bare", {"password": R}]
    once = privacy.redact_json(column(spark, ['{"a": {"token": 1}}']), "v")
    assert parsed(privacy.redact_json(once, "v")) == parsed(once)


def test_extra_keys_and_word_runs(spark):
    text = json.dumps({"Member_Number": "M", "beneficiary": {"a": 1}, "api_key": "k", "x": {"http.header.authorization": "b"}})
    out = privacy.redact_json(column(spark, [text]), "v", extra_keys=[" member_number", "BENEFICIARY", " "])
    assert parsed(out) == [{"Member_Number": R, "beneficiary": R, "api_key": R, "x": {"http.header.authorization": "b"}}]
    out = privacy.redact_json(column(spark, [text]), "v", word_runs=True)
    assert parsed(out)[0]["x"] == {"http.header.authorization": R}


RULED = [
    ([Rule(SSN, "ssn")], {"note": "is 123-45-6789, ok 078-05-1120"}, {"note": f"is {R}, ok {R}"}),
    ([Rule(r"confidential-\d+")], {"tag": "ref CONFIDENTIAL-42"}, {"tag": f"ref {R}"}),
    ([Rule(r"(?-i)confidential-\d+")], {"tag": "ref CONFIDENTIAL-42"}, {"tag": "ref CONFIDENTIAL-42"}),
    ([Rule(SSN)], {"m": [{"c": "my 123-45-6789"}, "078-05-1120"]}, {"m": [{"c": f"my {R}"}, R]}),
    ([Rule(SSN, action="HASH")], {"note": "id 123-45-6789 end"}, {"note": f"id {digest('123-45-6789')} end"}),
    ([Rule("internal_id", scope="keys")], {"x_internal_id_v2": [1], "note": "internal_id"},
     {"x_internal_id_v2": R, "note": "internal_id"}),
    ([Rule("^account_ref$", action="hash", scope="keys")], {"account_ref": "AC-1"}, {"account_ref": digest("AC-1")}),
    ([Rule("^account_ref$", action="hash", scope="keys")], {"account_ref": {"id": 1}}, {"account_ref": R}),
    ([Rule(r"caseref-\d+", scope="both")], {"caseref-9": "open", "s": "from caseref-8 now"}, {"caseref-9": R, "s": f"from {R} now"}),
    ([Rule(r"\d+")], {"count": 123, "active": True, "note": "code 42"}, {"count": 123, "active": True, "note": f"code {R}"}),
    ([Rule(r"hunter\d", action="hash")], {"password": "hunter2", "note": "hunter2!"}, {"password": R, "note": digest("hunter2") + "!"}),
]


@pytest.mark.parametrize("case", range(len(RULED)))
def test_rules_on_json(spark, case):
    rules, given, expected = RULED[case]
    assert parsed(privacy.scrub_pii(column(spark, [json.dumps(given)]).withColumn("v", F.parse_json("v")), ["v"], rules, KEY)) == [
        expected]


def test_rules_on_text(spark):
    email = Rule(r"[a-z0-9._%+-]+@[a-z0-9.-]+\.[a-z]{2,}", action="hash")
    texts = ["alice@example.com", "to Bob@X.org, 123-45-6789.", "none", "", None, "a@b.co c@d.io"]
    got = apply(spark, texts, lambda c: privacy.scrub_text(c, [email, Rule(SSN)], KEY))
    assert got == [digest("alice@example.com"), f"to {digest('Bob@X.org')}, {R}.", "none", "", None,
                   f"{digest('a@b.co')} {digest('c@d.io')}"]
    assert apply(spark, texts[:1], lambda c: privacy.scrub_text(c, [email])) == [R]


@pytest.mark.parametrize("bad", [
    {"pattern": " "}, {"pattern": "("}, {"pattern": "a", "action": "drop"}, {"pattern": "a", "scope": "rows"}])
def test_bad_rules(bad):
    with pytest.raises(ValueError):
        Rule(**bad)


def test_rule_defaults_and_jvm_check(spark):
    rule = Rule("a", action=" ", scope="")
    assert (rule.action, rule.scope) == ("redact", "values")
    assert check_rules(spark, [rule]) == [rule]
    with pytest.raises(ValueError):
        check_rules(spark, [Rule(r"(?P<x>a)")])
    with pytest.raises(ValueError):
        privacy.scrub_text(F.lit("x"), [Rule("a*", action="hash")], KEY)


def test_truncate(spark):
    df = column(spark, ["x" * 12, "y" * 10])
    assert [r.v for r in privacy.truncate_strings(df, {"v": 10}).collect()] == ["x" * 10 + "...[TRUNCATED]", "y" * 10]
    df = column(spark, [json.dumps({"password": "z" * 12, "b": ["ok", 5]})]).withColumn("v", F.parse_json("v"))
    assert parsed(privacy.truncate_strings(df, {"v": 10})) == [{"password": "z" * 10 + "...[TRUNCATED]", "b": ["ok", 5]}]


def test_fit_encoded(spark):
    texts = ["a" * 1022, "a" * 1023, "😀" * 200, "é" * 171, "\"\\\n\x01\x7f" * 60, "short", ""]
    mark = "...[TRUNCATED]"
    for text, got in zip(texts, apply(spark, texts, privacy.fit_encoded), strict=True):
        if len(json.dumps(text)) <= 1024:
            assert got == text
            continue
        kept = got.removesuffix(mark)
        assert got.endswith(mark) and text.startswith(kept)
        budget = 1024 - len(json.dumps(mark))
        assert len(json.dumps(kept)) <= budget < len(json.dumps(text[: len(kept) + 1]))


def test_json_size(spark):
    values = [{"a": "é😀\x7f", "b": [1, "x, y: z", {"c": None}]}, {}, ["q\"uo\\te,", ""], {"k": "plain"}]
    texts = [json.dumps(v, ensure_ascii=False, separators=(",", ":")) for v in values]
    assert apply(spark, texts, json_size) == [len(json.dumps(v).replace("\\u007f", "\x7f")) for v in values]


def test_arguments(spark):
    nested = {"a": {"token": "x", "t": "n" * 300}, "list": [{"ssn": 1}]}
    values = [{"Password": "x", "s": "v" * 250, "n": 5, **nested}, {}, None, [1, 2], "w" * 250, nest(23, 1)]
    out = privacy.sanitize_mcp_arguments(column(spark, [json.dumps(v) for v in values]), "v")
    got = parsed(out)
    assert got[0] == {"Password": R, "s": "v" * 200 + "... (250 chars)", "n": 5,
                      "a": {"token": R, "t": "n" * 300}, "list": [{"ssn": R}]}
    assert got[1:4] == [None, None, {"_raw": "[1, 2]"}]
    assert got[4] == {"_raw": "w" * 200 + "... (250 chars)"}
    assert got[5] == nest(22, R)


def test_summaries(spark):
    values = [None, "null", '"hello world"', "[1, 2, 3]", '{"a": 1}', "true", "false", "42", "3.14", "[]"]
    out = privacy.summarize_result(column(spark, values), "v")
    assert [r.result_summary for r in out.orderBy("i").collect()] == [
        "None", "None", "str(len=11)", "list(len=3)", "dict(keys=1)", "True", "False", "42", "3.14", "list(len=0)"]


def test_head_tail(spark):
    body = {"password": "p", "t": "é" * 300}
    got = parsed(privacy.head_tail_body(column(spark, [json.dumps(body), '{"a": 1}', '"bare"', "{x"]), "v", 20, 51))
    whole = json.dumps({**body, "password": R}, ensure_ascii=False, separators=(",", ":")).encode()
    assert got[1:] == [{"a": 1}, None, None]
    assert (got[0]["body_truncated"], got[0]["body_bytes_total"]) == (True, len(whole))
    assert got[0]["body_bytes_dropped"] == len(whole) - 71
    assert got[0]["head"] == whole[:20].decode(errors="replace")
    assert got[0]["tail"] == whole[-51:].decode(errors="replace")
    assert privacy.byte_limit("x", 7) == 7 and privacy.byte_limit(-3, 7) == 0


NAMES = {
    "http.request.header.authorization": True, "HTTPAuthorization": True, "x-api-key": True, "xApiKey": True,
    "X_API_Key": True, "privatekey": False, "tenant.id": False, "creditCardNumber": True, "sessionId": True,
    "author": False, "userToken2": False, "auth": True, "": False, "http/request/Cookie": True,
}


def test_names(spark):
    assert apply(spark, list(NAMES), is_sensitive_name) == list(NAMES.values())
    assert [bool(re.search(SENSITIVE_NAME, n)) for n in NAMES] == list(NAMES.values())
    names = ["HTTPServer.userId/x", " _a--B_ ", "passWord", "v2Key", "é.naïve", ""]
    assert apply(spark, names, name_key) == ["http_server_user_id_x", "a_b", "pass_word", "v2_key", "na_ve", ""]
    assert apply(spark, names, is_sensitive_name) == [False] * 6


def test_redact_struct(spark):
    df = spark.sql("select named_struct('Token', 't', 'in', named_struct('ssn', 5, 'ok', array(named_struct('cvv','1','z',2))),"
                   " 'm', map('AUTH','x','b','y')) v")
    row = privacy.redact_struct(df, "v").first().v.asDict(recursive=True)
    assert row == {"Token": R, "in": {"ssn": None, "ok": [{"cvv": R, "z": 2}]}, "m": {"AUTH": R, "b": "y"}}
    assert "Python" not in privacy.redact_struct(df, "v")._jdf.queryExecution().executedPlan().toString()


def test_python_gets_batches_of_few_bytes(spark):
    """Bodies of any length: a worker holds a few megabytes of them, however many rows there are."""
    @F.pandas_udf("long")
    def held(texts: pd.Series) -> pd.Series:
        return pd.Series([int(texts.str.len().sum())] * len(texts))

    sizes = spark.range(0, 2000, 1, 1).select(held(F.repeat(F.lit("x"), 10_000)).alias("n")).agg(F.max("n")).first()
    assert sizes[0] < 4 << 20
