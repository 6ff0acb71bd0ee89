import json

import pytest
from pyspark.sql import functions as F

from tests.fixtures import spans as S
from tracewell.sources.otlp import (
    _RESOURCE_SPANS,
    decode_exports,
    flatten_attributes,
    merge_span_event_attributes,
    quarantine_undecodable,
    spans_of,
    store_traces,
)
from tracewell.sources.otlp_faults import usual


def with_span(**fields):
    return {"resourceSpans": [{"scopeSpans": [{"spans": [{"name": "s", **fields}]}]}]}


def with_value(value):
    return with_span(attributes=[{"key": "k", "value": value}])


def nest(levels, value):
    for _ in range(levels):
        value = {"arrayValue": {"values": [value]}}
    return value


REFUSED = [
    ("not_an_object", 3), ("not_an_object", []), ("not_a_list", {"resourceSpans": 3}), ("not_a_list", {"resourceSpans": {"a": 1}}),
    ("unknown_field", {"resourceSpan": []}), ("unknown_field", with_span(nmae="x")), ("not_an_object", {"resourceSpans": ["x"]}),
    ("field_twice", with_span(traceId="AA==", trace_id="AA==")), ("null_entry", {"resourceSpans": [None]}),
    ("null_entry", with_span(attributes=[None])), ("null_entry", with_value({"arrayValue": {"values": [None]}})),
    ("null_entry", with_value({"kvlistValue": {"values": [None]}})), ("bad_scalar", with_span(name=5)),
    ("bad_scalar", with_span(traceId="!!!")), ("bad_scalar", with_span(startTimeUnixNano="-1")), ("bad_scalar", with_span(startTimeUnixNano=1.5)),
    ("bad_scalar", with_span(status={"code": "FINE"})), ("bad_scalar", with_span(kind=True)), ("bad_scalar", with_span(flags=1 << 32)),
    ("not_an_object", with_span(status="x")), ("bad_scalar", with_value({"intValue": "abc"})), ("bad_scalar", with_value({"intValue": str(1 << 63)})),
    ("bad_scalar", with_value({"intValue": 0.5})), ("bad_scalar", with_value({"doubleValue": "one"})), ("bad_scalar", with_value({"boolValue": "true"})),
    ("bad_scalar", with_value({"stringValue": 1})), ("bad_scalar", with_value({"bytesValue": "!!!"})), ("bad_scalar", with_value({"bytesValue": "AAAAA"})),
    ("several_values", with_value({"intValue": "1", "stringValue": "1"})), ("several_values", with_value(nest(1, {"intValue": "1", "boolValue": True}))),
    ("not_an_object", with_value("x")), ("unknown_field", with_value({"floatValue": 1})), ("not_a_list", with_value({"arrayValue": {"values": {}}})),
    ("not_an_object", with_value({"arrayValue": []})), ("bad_scalar", with_value(nest(3, {"intValue": "abc"}))),
    ("bad_scalar", with_value({"kvlistValue": {"values": [{"key": 1, "value": {}}]}})), ("unknown_field", with_value(nest(2, {"textValue": ""}))),
    ("field_twice", with_value(nest(1, {"intValue": "1", "int_value": "1"}))), ("too_deep", with_value(nest(150, {"intValue": "1"}))),
    ("bad_scalar", {"resourceSpans": [{"resource": {"attributes": [{"key": "k", "value": {"intValue": "abc"}}]}}]}),
    ("bad_scalar", with_span(events=[{"name": "e", "timeUnixNano": "x"}])), ("bad_scalar", with_span(links=[{"traceId": 1}])),
]
TAKEN = [
    ({}, []), ({"resourceSpans": None}, []), ({"resource_spans": [{"scope_spans": [{"spans": [{"name": "s"}]}]}]}, [{}]),
    (with_span(attributes=None, status=None, events=None, traceId=None), [{}]),
    (with_span(attributes=[{"value": {"stringValue": "v"}}, {"key": "null", "value": None}, {"key": "none"}, {"key": "empty", "value": {}}]),
     [{"": "v", "null": None, "none": None, "empty": None}]),
    (with_span(attributes=[{"key": "a", "value": {"int_value": 7.0}}, {"key": "b", "value": {"bool_value": False}},
                           {"key": "c", "value": {"double_value": "1.5"}}, {"key": "d", "value": {"bytes_value": "_-8="}}]),
     [{"a": 7, "b": False, "c": 1.5, "d": "base64:/+8="}]),
    (with_value({"array_value": {"values": [{"int_value": "3"}, {}, {"kvlist_value": {"values": [{"value": {"stringValue": "x"}}, {"key": "y"}]}}]}}),
     [{"k": [3, None, {"": "x", "y": None}]}]),
    (with_value({"arrayValue": None}), [{"k": None}]), (with_value(nest(31, {"intValue": "1"})), [{"k": nest(0, 1)}]),
    (with_span(kind=3, flags=257, traceState="x=1", droppedLinksCount=1, links=[{"traceId": "AA", "spanId": "AAA="}], status={"code": 2}), [{}]),
]


def table(spark, exports):
    return spark.createDataFrame([(i, e if isinstance(e, str) else json.dumps(e)) for i, e in enumerate(exports)], "n long, value string")


def test_faults_by_reason(spark):
    texts = ['{"resourceSpans":[', "", "[" * 5000 + "]" * 5000]
    got = decode_exports(table(spark, [e for _, e in REFUSED] + texts)).orderBy("n").collect()
    assert [r["reason"] for r in got] == [reason for reason, _ in REFUSED] + ["undecodable"] * 3
    assert all(r["export"] is None for r in got)


def test_odd_but_sound_exports(spark):
    def plain(value):
        return value if not isinstance(value, list) or len(value) != 1 else plain(value[0])

    good, refused = quarantine_undecodable(table(spark, [e for e, _ in TAKEN]))
    assert refused.count() == 0
    rows = good.select("n", "export").collect()
    assert len(rows) == len(TAKEN)
    for i, (_, want) in enumerate(TAKEN):
        spans = merge_span_event_attributes(flatten_attributes(spans_of(good.filter(F.col("n") == i))))
        got = [json.loads(r[0]) for r in spans.select(F.to_json(F.to_variant_object("attrs"))).collect()]
        if i == 8:
            got = [{"k": plain(got[0]["k"])}]
        assert got == want, i


def test_null_entries_can_be_skipped(spark):
    exports = [with_span(attributes=[None, {"key": "k", "value": {"arrayValue": {"values": [None, {"intValue": "1"}]}}}, None]),
               {"resourceSpans": [None, with_span()["resourceSpans"][0]]}, with_value({"kvlistValue": {"values": [None]}})]
    good, refused = quarantine_undecodable(table(spark, exports), null_entries="skip")
    assert refused.count() == 0
    spans = flatten_attributes(spans_of(good.orderBy("n"))).select(F.to_json(F.to_variant_object("attrs"))).collect()
    assert sorted(r[0] for r in spans) == ['{"k":[1]}', '{"k":{}}', "{}"]


@pytest.mark.parametrize("text", [json.dumps(with_value({"intValue": "abc"})), json.dumps(with_value({"kvlistValue": {"values": [None, 3]}}))])
def test_flattening_unchecked_values_does_not_fail(spark, text):
    """Spans from another source than ``decode_exports``, whose values nobody has checked."""
    values = F.from_json(F.get_json_object(F.lit(text), "$.resourceSpans[0].scopeSpans[0].spans[0].attributes"),
                         "array<struct<key:string,value:variant>>")
    row = flatten_attributes(spark.range(1).select(values.alias("attributes"))).select(F.to_json(F.to_variant_object("attrs"))).first()
    assert json.loads(row[0])["k"] in (None, {})


def test_stored_traces_are_decoded_once(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.json").write_text("\n".join(
        [S.export(S.CHAT, S.TOOL_CALL), "{bad", json.dumps(with_span(nmae=1)), '{"resourceSpans":[]}', S.export(S.NOISE)]))
    spans, refused = store_traces(spark, str(tmp_path / "in"), str(tmp_path / "out"))
    assert spans.count() == 3 and spans.filter("map_contains_key(attrs, 'user.id')").count() == 1
    assert sorted((r["reason"], r["value"][:4]) for r in refused.collect()) == [("undecodable", "{bad"), ("unknown_field", '{"re')]
    store_traces(spark, str(tmp_path / "in"), str(tmp_path / "out"))
    assert spark.read.parquet(str(tmp_path / "out")).count() == 10


def test_nested_values_do_not_make_an_export_unusual(spark):
    """Only what the schema cannot tell is tested field by field; nested values are judged apart from that."""
    several = {"kvlistValue": {"values": [{"key": "a", "value": {"doubleValue": "NaN"}}, {"key": "b", "value": nest(3, {"doubleValue": 0.5})}]}}
    texts = [with_value(several), with_value({"bytesValue": "/w=="}), with_value({"bytesValue": "!!"}),
             with_value({"arrayValue": {"`<": 1}}), with_value({"arrayValue": 3}), with_value({"intValue": "1", "boolValue": True})]
    parsed = table(spark, texts).withColumn("document", F.parse_json("value"))
    parsed = parsed.withColumn("typed", F.try_variant_get("document", "$.resourceSpans", _RESOURCE_SPANS))
    found = parsed.select(usual(parsed, "document", "typed")).collect()
    assert [r[0] for r in found] == [True, True, False, False, False, False]
    bad = [with_value(nest(2, {"intValue": "a"})), with_value({"kvlistValue": {"values": [{"key": "a", "value": {"bytesValue": "!!"}}]}})]
    assert {r["reason"] for r in decode_exports(table(spark, bad)).collect()} == {"bad_scalar"}
