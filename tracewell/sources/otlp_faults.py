"""What makes a trace export unreadable, told before anything of it is unpacked.

An export is a message of typed fields. Field names are accepted in both spellings of the
format (``traceId``, ``trace_id``), null fields count as absent. Whatever else departs
from the types below refuses the whole export, with the first fault found:

``not_an_object``, ``not_a_list``  another JSON type where a message or a list belongs
``unknown_field``                  a name that the message does not have
``field_twice``                    a field in both spellings
``null_entry``                     null in a list, unless such entries are skipped
``bad_scalar``                     a value that its type cannot hold
``several_values``                 an attribute value of more than one kind
``too_deep``                       more than MAX_MESSAGES messages inside each other

All of this is column expressions over the parsed VARIANT. Only attribute values that hold lists
or maps, which nest without bound, are looked at in Arrow batches.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable
from functools import reduce
from operator import add

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracewell.functions.lets import fence, let
from tracewell.functions.variants import as_array, as_object, as_text

#: A list counts two, a map three; values below MAX_ATTRIBUTE_DEPTH of them read as null.
MAX_MESSAGES = 200

# Fixed values of the format: names of enumerated values.
SPAN_KINDS = ("SPAN_KIND_UNSPECIFIED", "SPAN_KIND_INTERNAL", "SPAN_KIND_SERVER", "SPAN_KIND_CLIENT", "SPAN_KIND_PRODUCER",
              "SPAN_KIND_CONSUMER")
STATUS_CODES = ("STATUS_CODE_UNSET", "STATUS_CODE_OK", "STATUS_CODE_ERROR")
BASE64 = "^[A-Za-z0-9+/_-]*={0,2}$"


def snake(name: str) -> str:
    return re.sub("[A-Z]", lambda m: "_" + m.group().lower(), name)


def _names(name: str) -> tuple[str, ...]:
    return tuple(dict.fromkeys((name, snake(name))))


# Types of fields. LIST and MESSAGE are looked into as messages of their own.
TEXT, BYTES, INT64, UINT64, UINT32, DOUBLE, BOOLEAN, KIND, STATUS, LIST, MESSAGE = (
    "text", "bytes", "int64", "uint64", "uint32", "double", "boolean", "kind", "status", "list", "message")
_RANGES = {INT64: (-(1 << 63), (1 << 63) - 1), UINT64: (0, (1 << 64) - 1), UINT32: (0, (1 << 32) - 1)}
_NUMBER = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"

_DROPPED = {"droppedAttributesCount": UINT32}
_REQUEST = {"resourceSpans": LIST}
_RESOURCE_SPANS = {"resource": MESSAGE, "scopeSpans": LIST, "schemaUrl": TEXT}
_RESOURCE = {"attributes": LIST, **_DROPPED}
_SCOPE_SPANS = {"scope": MESSAGE, "spans": LIST, "schemaUrl": TEXT}
_SCOPE = {"name": TEXT, "version": TEXT, "attributes": LIST, **_DROPPED}
_SPAN = {"traceId": BYTES, "spanId": BYTES, "traceState": TEXT, "parentSpanId": BYTES, "flags": UINT32, "name": TEXT, "kind": KIND,
         "startTimeUnixNano": UINT64, "endTimeUnixNano": UINT64, "attributes": LIST, "events": LIST, "droppedEventsCount": UINT32,
         "links": LIST, "droppedLinksCount": UINT32, "status": MESSAGE, **_DROPPED}
_EVENT = {"timeUnixNano": UINT64, "name": TEXT, "attributes": LIST, **_DROPPED}
_LINK = {"traceId": BYTES, "spanId": BYTES, "traceState": TEXT, "attributes": LIST, "flags": UINT32, **_DROPPED}
_STATUS = {"message": TEXT, "code": STATUS}
_PAIR = {"key": TEXT, "value": MESSAGE}
_VALUE = {"stringValue": TEXT, "boolValue": BOOLEAN, "intValue": INT64, "doubleValue": DOUBLE, "bytesValue": BYTES,
          "arrayValue": MESSAGE, "kvlistValue": MESSAGE}


def _scalar_test(code: Column, value: Column) -> Column:
    """``bad_scalar`` where a value does not fit its type, else null."""
    def of(x: Column) -> Column:
        kind, text = x["kind"], x["text"]
        string, number = kind == "STRING", kind.rlike("^(BIGINT|DECIMAL|DOUBLE|FLOAT)")
        exact = text.try_cast("decimal(38,6)")
        low, high = (F.coalesce(*(F.when(code == c, F.lit(str(r[i]))) for c, r in _RANGES.items())).cast("decimal(38,0)") for i in (0, 1))
        whole = (number | string & text.rlike(r"^[+-]?\d{1,30}$")) & (exact == F.floor(exact)) & exact.between(low, high)
        names = F.when(code == KIND, text.isin(*SPAN_KINDS)).otherwise(text.isin(*STATUS_CODES))
        good = (
            F.when(code == TEXT, string)
            .when(code == BYTES, string & text.rlike(BASE64) & (F.length(F.rtrim(text, F.lit("="))) % 4 != 1))
            .when(code == BOOLEAN, kind == "BOOLEAN")
            .when(code == DOUBLE, number | string & (text.isin("NaN", "Infinity", "-Infinity") | text.rlike(_NUMBER)))
            .when(code.isin(KIND, STATUS), (kind == "BIGINT") | string & (names | text.rlike(r"^[+-]?\d{1,9}$")))
            .otherwise(whole))
        return F.when(~F.coalesce(good, F.lit(False)), "bad_scalar")

    return let(F.struct(F.schema_of_variant(value).alias("kind"), as_text(value).alias("text")), of)


def _test(field: Column) -> Column:
    """The fault of one (code, value), or null."""
    code, value = field["code"], field["value"]
    return (F.when(code == MESSAGE, F.lit(None).cast("string"))
            .when(code == LIST, F.when(as_array(value).isNull(), "not_a_list"))
            .when(code.isin(TEXT, BYTES, INT64, UINT64, UINT32, DOUBLE, BOOLEAN, KIND, STATUS), _scalar_test(code, value))
            .otherwise(code))


def _fields(messages: Column, types: dict[str, str], skip_null: bool, one_of: bool = False) -> Column:
    """(code, value) of all fields of all messages: the code is the field's type, or a fault."""
    codes = F.create_map(*(F.lit(x) for name, code in types.items() for n in _names(name) for x in (n, code)))
    nothing = F.array().cast("array<struct<code:string,value:variant>>")

    def fault(name: str) -> Column:
        return F.array(F.struct(F.lit(name).alias("code"), F.lit(None).cast("variant").alias("value")))

    def of(entries: Column) -> Column:
        names = F.transform(entries, lambda e: F.translate(F.lower(e["key"]), "_", ""))
        typed = F.transform(entries, lambda e: F.struct(
            F.coalesce(F.try_element_at(codes, e["key"]), F.lit("unknown_field")).alias("code"), e["value"].alias("value")))
        twice = F.when(F.size(F.array_distinct(names)) < F.size(names), fault("field_twice")).otherwise(nothing)
        several = F.when(F.size(names) > 1, fault("several_values")).otherwise(nothing)
        return F.when(entries.isNull(), fault("not_an_object")).otherwise(F.concat(twice, several, typed) if one_of else F.concat(twice, typed))

    def present(message: Column) -> Column:
        return F.filter(F.map_entries(as_object(message)), lambda e: ~F.is_variant_null(e["value"]))

    return F.flatten(F.transform(messages, lambda m: F.when(
        F.is_variant_null(m), nothing if skip_null else fault("null_entry")).otherwise(let(present(m), of))))


def get_field(message: Column, name: str, dtype: str = "string") -> Column:
    """A message's field in either spelling of its name; ``name`` may be a path."""
    return F.coalesce(*(F.try_variant_get(message, f"$.{n}", dtype) for n in _names(name)))


def get_list(message: Column, name: str) -> Column:
    return F.coalesce(as_array(get_field(message, name, "variant")), F.array().cast("array<variant>"))


def _shape(types: dict[str, str], inner: dict[str, str]) -> str:
    """Pattern of the schema of messages whose fields have their usual JSON types. Fields come by name."""
    usual = {TEXT: "STRING", BYTES: "STRING", UINT64: "(?:STRING|BIGINT)", INT64: "(?:STRING|BIGINT)", UINT32: "BIGINT",
             KIND: "BIGINT", STATUS: "STRING", BOOLEAN: "BOOLEAN", DOUBLE: r"(?:DOUBLE|BIGINT|DECIMAL\(\d+,\d+\))"}
    fields = []
    for name in sorted(types):
        code = types[name]
        if (code in usual and not name.startswith("dropped")) or name in inner:
            shape = usual.get(code) or inner[name]
            fields.append(f"(?:{name}: {shape if code != LIST else f'ARRAY<(?:{shape}|VOID)>'}(?:, |(?=>)))?")
    return f"OBJECT<{''.join(fields)}>"


def _anything(depth: int = 24) -> str:
    """Pattern of what stands inside the schema of a nested value, whose fields ``nested_fault`` judges. Names
    with signs of their own are quoted and do not match."""
    held = "[^<>`]*+"
    for _ in range(depth):
        held = f"[^<>`]*+(?:<{held}>[^<>`]*+)*+"
    return held


def _plain() -> str:
    """Pattern of the schema of exports in camel case, whatever their nested attribute values hold."""
    nested = f"OBJECT<{_anything()}>"
    pairs = {"attributes": _shape(_PAIR, {"value": _shape(_VALUE, {"arrayValue": nested, "kvlistValue": nested})})}
    span = _shape(_SPAN, {**pairs, "events": _shape(_EVENT, pairs), "status": _shape(_STATUS, {})})
    scoped = _shape(_SCOPE_SPANS, {"scope": _shape(_SCOPE, pairs), "spans": span})
    return "^" + _shape(_REQUEST, {"resourceSpans": _shape(_RESOURCE_SPANS, {"resource": _shape(_RESOURCE, pairs), "scopeSpans": scoped})}) + "$"


def _usual_span(span: Column) -> Column:
    """True for typed spans whose texts are what nearly all senders write."""
    ids = F.concat_ws(",", span["traceId"], span["spanId"], span["parentSpanId"])
    times = F.concat_ws(",", span["startTimeUnixNano"], span["endTimeUnixNano"], span["flags"])
    return (ids.rlike("^(?:(?:[A-Za-z0-9+/]{22}==|[A-Za-z0-9+/]{11}=)(?:,|$)){0,3}$") & times.rlike(r"^(?:\d{1,19}(?:,|$)){0,3}$")
            & (F.length(F.coalesce(span["flags"], F.lit(""))) < 10) & F.coalesce(span["status"]["code"], F.lit("")).isin("", *STATUS_CODES))


def _usual_value(value: Column) -> Column:
    """The same for attribute values: one kind, bytes that can be read, and whole numbers short enough."""
    kinds = [value[name].isNotNull().cast("int") for name in _VALUE]
    data = value["bytesValue"]
    readable = data.isNull() | (data.rlike(BASE64) & (F.length(F.rtrim(data, F.lit("="))) % 4 != 1))
    return (reduce(add, kinds) == 1) & (value["intValue"].isNull() | value["intValue"].rlike(r"^-?\d{1,18}$")) & readable


def usual(exports: DataFrame, document: str, typed: str) -> Column:
    """True for exports that are sound at first sight: the schema of the whole document, taken in one
    go, is the usual one, and so are the texts of its spans and attributes in ``typed``."""
    found = F.col(typed)

    def attributes(holders: Column) -> Column:
        return F.flatten(F.filter(F.transform(holders, lambda h: h["attributes"]), lambda a: a.isNotNull()))

    def checked(scoped: Column) -> Column:
        spans = F.flatten(F.transform(scoped, lambda s: s["spans"]))
        return let(spans, lambda of: F.forall(of, lambda s: s.isNotNull() & _usual_span(s)) & let(
            F.flatten(F.transform(F.filter(of, lambda s: s["events"].isNotNull()), lambda s: s["events"])), lambda events: F.forall(
                events, lambda e: e.isNotNull() & F.coalesce(e["timeUnixNano"], F.lit("0")).rlike(r"^\d{1,19}$")) & F.forall(
                F.concat(attributes(of), attributes(events), attributes(F.transform(scoped, lambda s: s["scope"])),
                         attributes(F.transform(found, lambda r: r["resource"]))),
                lambda pair: pair.isNotNull() & (pair["value"].isNull() | _usual_value(pair["value"])))))

    sound = let(F.flatten(F.transform(found, lambda r: r["scopeSpans"])), checked)
    return F.schema_of_variant(document).rlike(_plain()) & F.coalesce(sound, F.lit(False))


def export_fault(exports: DataFrame, document: str, text: Column, skip_null: bool = False) -> DataFrame:
    """``exports`` with ``_fault``: the first fault of the parsed ``document``, null for a sound
    one (and for a null document), or else of the nested values in ``text``. Messages are gathered level by level, then all their fields
    are tested in one place.
    """
    doc = F.col(document)

    def below(messages: str, name: str) -> Column:
        return F.flatten(F.transform(messages, lambda m: get_list(m, name)))

    def held(messages: str | Column, name: str) -> Column:
        found = F.transform(messages, lambda m: get_field(m, name, "variant"))
        return F.filter(found, lambda v: v.isNotNull() & ~F.is_variant_null(v))

    steps = [
        {"_rs": F.when(doc.isNotNull(), get_list(doc, "resourceSpans"))},
        {"_ss": below("_rs", "scopeSpans"), "_re": held("_rs", "resource")},
        {"_sp": below("_ss", "spans"), "_sc": held("_ss", "scope")},
        {"_ev": below("_sp", "events"), "_li": below("_sp", "links")},
        {"_at": F.concat(*(below(m, "attributes") for m in ("_re", "_sc", "_sp", "_ev", "_li")))},
        {"_fields": F.concat(
            _fields(F.array(doc), _REQUEST, False), _fields(F.col("_rs"), _RESOURCE_SPANS, skip_null), _fields(F.col("_re"), _RESOURCE, False),
            _fields(F.col("_ss"), _SCOPE_SPANS, skip_null), _fields(F.col("_sc"), _SCOPE, False), _fields(F.col("_sp"), _SPAN, skip_null),
            _fields(held("_sp", "status"), _STATUS, False), _fields(F.col("_ev"), _EVENT, skip_null), _fields(F.col("_li"), _LINK, skip_null),
            _fields(F.col("_at"), _PAIR, skip_null), _fields(held("_at", "value"), _VALUE, False, one_of=True))},
    ]
    rows = exports
    for columns in steps:
        rows = rows.withColumns(columns)
    faults = F.filter(F.transform("_fields", _test), lambda fault: fault.isNotNull())
    first = F.coalesce(F.get(faults, F.lit(0)), nested_fault(text, skip_null))
    return rows.withColumn("_fault", fence(first)).drop(*(c for columns in steps for c in columns))


_KINDS = {n: name for name in _VALUE for n in _names(name)}
#: Messages around an attribute value: the request, its resource and scope, the span, the pair.
_AROUND = 6


def _scalar_fault(kind: str, value: object) -> str | None:
    good = {
        "stringValue": lambda: isinstance(value, str),
        "boolValue": lambda: isinstance(value, bool),
        "intValue": lambda: not isinstance(value, bool) and (
            isinstance(value, int) or isinstance(value, float) and value.is_integer()
            or isinstance(value, str) and re.fullmatch(r"[+-]?\d{1,30}", value, re.ASCII) is not None) and -(1 << 63) <= int(value) < 1 << 63,
        "doubleValue": lambda: not isinstance(value, bool) and (isinstance(value, (int, float)) or isinstance(value, str) and (
            value in ("NaN", "Infinity", "-Infinity") or re.fullmatch(r"[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?", value, re.ASCII) is not None)),
        "bytesValue": lambda: isinstance(value, str) and re.fullmatch(BASE64, value) is not None and len(value.rstrip("=")) % 4 != 1,
    }[kind]()
    return None if good else "bad_scalar"


def _value_fault(value: object, skip_null: bool, messages: int) -> str | None:
    """The first fault of an attribute value and all it holds."""
    if messages > MAX_MESSAGES:
        return "too_deep"
    if not isinstance(value, dict):
        return "not_an_object"
    if value.keys() - _KINDS.keys():
        return "unknown_field"
    present = [(_KINDS[name], held) for name, held in value.items() if held is not None]
    if len(present) > 1:
        return "field_twice" if len({kind for kind, _ in present}) == 1 else "several_values"
    for kind, held in present:
        if kind not in ("arrayValue", "kvlistValue"):
            return _scalar_fault(kind, held)
        if not isinstance(held, dict):
            return "not_an_object"
        if held.keys() - {"values"}:
            return "unknown_field"
        items = held.get("values")
        if items is not None and not isinstance(items, list):
            return "not_a_list"
        for item in items or []:
            fault = _entry_fault(item, kind == "kvlistValue", skip_null, messages + 2)
            if fault:
                return fault
    return None


def _entry_fault(item: object, pair: bool, skip_null: bool, messages: int) -> str | None:
    if item is None:
        return None if skip_null else "null_entry"
    if not pair:
        return _value_fault(item, skip_null, messages)
    if not isinstance(item, dict):
        return "not_an_object"
    if item.keys() - {"key", "value"}:
        return "unknown_field"
    if item.get("key") is not None and not isinstance(item["key"], str):
        return "bad_scalar"
    return None if item.get("value") is None else _value_fault(item["value"], skip_null, messages + 1)


def _text_fault(text: str, skip_null: bool) -> str | None:
    """The first fault of the nested attribute values anywhere in an export."""
    try:
        waiting = [json.loads(text)]
    except (ValueError, RecursionError):
        return "undecodable"
    while waiting:
        node = waiting.pop()
        if isinstance(node, list):
            waiting += reversed(node)
        elif isinstance(node, dict):
            if any(name in node for kind in ("arrayValue", "kvlistValue") for name in _names(kind)):
                fault = _value_fault(node, skip_null, _AROUND)
                if fault:
                    return fault
            else:
                waiting += reversed(list(node.values()))
    return None


def nested_fault(text: Column, skip_null: bool = False) -> Column:
    """The first fault of nested attribute values; texts without any stay in the JVM."""
    @F.pandas_udf("string")
    def found(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: _text_fault(t, skip_null), na_action="ignore").astype(object)

    nested = "|".join(n for kind in ("arrayValue", "kvlistValue") for n in _names(kind))
    return found.asNondeterministic()(F.when(text.rlike(rf'"(?:{nested})"\s*:'), text))
