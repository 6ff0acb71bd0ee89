"""OpenTelemetry trace exports (OTLP/JSON) as a table of spans.

One export is one text row: either a line (``layout="lines"``, splittable) or a
whole file. Everything up to the span table is narrow: no shuffle.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tracewell.constants import MAX_EXPORT_BYTES
from tracewell.functions.jsonwalk import plain_attributes
from tracewell.functions.lets import fence, let
from tracewell.functions.variants import OBJECT
from tracewell.session import prepare_session
from tracewell.sources.otlp_faults import export_fault, get_field, get_list, usual

# An attribute value: the field of its kind is set, the others are null. Whole numbers are digits.
_VALUE = ("struct<stringValue:string,intValue:string,boolValue:boolean,doubleValue:double,bytesValue:string,"
          "arrayValue:variant,kvlistValue:variant>")
_ATTRIBUTES = f"array<struct<key:string,value:{_VALUE}>>"
_SPAN = (
    "struct<traceId:string,spanId:string,parentSpanId:string,name:string,startTimeUnixNano:string,endTimeUnixNano:string,flags:string,"
    f"status:struct<code:string,message:string>,attributes:{_ATTRIBUTES},"
    f"events:array<struct<name:string,timeUnixNano:string,attributes:{_ATTRIBUTES}>>>"
)
_RESOURCE_SPANS = (
    f"array<struct<resource:struct<attributes:{_ATTRIBUTES}>,"
    f"scopeSpans:array<struct<scope:struct<name:string,attributes:{_ATTRIBUTES}>,spans:array<{_SPAN}>>>>>"
)


def read_exports(spark: SparkSession, path: str, *, stream: bool = False, layout: str = "lines") -> DataFrame:
    """Raw export texts, one per row, in column ``value``."""
    prepare_session(spark)
    reader = spark.readStream if stream else spark.read
    return reader.format("text").option("wholetext", layout == "file").load(path).select("value")


def _list(message: Column, name: str, item: Callable[[Column], Column]) -> Column:
    """``item`` of every entry of a list; null entries, where they are let in, are skipped."""
    return F.transform(F.filter(get_list(message, name), lambda e: ~F.is_variant_null(e)), item)


def _value(value: Column) -> Column:
    """A value of any spelling as a struct of its kinds."""
    kinds = {"stringValue": "string", "intValue": "bigint", "boolValue": "boolean", "doubleValue": "double",
             "bytesValue": "string", "arrayValue": "variant", "kvlistValue": "variant"}
    fields = (get_field(value, name, kind) for name, kind in kinds.items())
    return F.struct(*(f.alias(n) for f, n in zip(fields, kinds))).cast(_VALUE)


def _attributes(message: Column) -> Column:
    """Pairs of a key, which is empty when absent, and a value."""
    return _list(message, "attributes", lambda pair: F.struct(
        F.coalesce(get_field(pair, "key"), F.lit("")).alias("key"),
        let(get_field(pair, "value", "variant"), _value).alias("value")))


def _span(span: Column) -> Column:
    texts = ("traceId", "spanId", "parentSpanId", "name", "startTimeUnixNano", "endTimeUnixNano", "flags")
    return F.struct(
        *(get_field(span, name).alias(name) for name in texts),
        F.struct(get_field(span, "status.code").alias("code"), get_field(span, "status.message").alias("message")).alias("status"),
        _attributes(span).alias("attributes"),
        _list(span, "events", lambda event: F.struct(
            *(get_field(event, name).alias(name) for name in ("name", "timeUnixNano")), _attributes(event).alias("attributes"))).alias("events"))


def _typed(document: Column) -> Column:
    """A sound export of any spelling as nested structs."""
    def holder(message: Column, name: str, *texts: str) -> Column:
        held = F.coalesce(get_field(message, name, "variant"), F.try_parse_json(F.lit("{}")))
        return F.struct(*(get_field(held, t).alias(t) for t in texts), _attributes(held).alias("attributes")).alias(name)

    return _list(document, "resourceSpans", lambda resource: F.struct(
        holder(resource, "resource"), _list(resource, "scopeSpans", lambda scoped: F.struct(
            holder(scoped, "scope", "name"), _list(scoped, "spans", _span).alias("spans"))).alias("scopeSpans"))).cast(_RESOURCE_SPANS)


def decode_exports(raw: DataFrame, col: str = "value", max_bytes: int = MAX_EXPORT_BYTES,
                   null_entries: str = "refuse") -> DataFrame:
    """Adds ``export`` (decoded, or null) and ``reason``: null, ``too_large``, ``undecodable``
    (no JSON) or a fault of ``otlp_faults``. An export is taken or refused as a whole.

    Absent fields read as the empty value of their type. With ``null_entries="skip"`` null in a list is
    passed over instead of refusing the export. Each text is parsed once.
    """
    prepare_session(raw.sparkSession)
    text = F.col(col)
    fits = F.octet_length(text) <= max_bytes
    # Each text is parsed once, and usual exports are made into structs in one go; only
    # the others are taken apart and tested field by field.
    parsed = raw.withColumn("_document", fence(F.try_parse_json(F.when(fits, text))))
    parsed = parsed.withColumn("_export", fence(F.try_variant_get("_document", "$.resourceSpans", _RESOURCE_SPANS)))
    parsed = parsed.withColumn("_usual", fence(usual(parsed, "_document", "_export")))
    other = F.when(~F.coalesce("_usual", F.lit(False)), F.col("_document"))
    sound = F.when(F.col("_document").isNotNull(), text)
    judged = export_fault(parsed.withColumn("_other", other), "_other", sound, null_entries == "skip")
    reason = F.when(~fits, F.lit("too_large")).when(F.col("_document").isNull(), F.lit("undecodable")).otherwise(F.col("_fault"))
    typed = F.when(F.col("_usual"), F.col("_export")).when(reason.isNull(), _typed(F.col("_document")))
    export = F.when(reason.isNull(), F.struct(typed.alias("resourceSpans")))
    return judged.select(*raw.columns, export.alias("export"), reason.alias("reason"))


def quarantine_undecodable(raw: DataFrame, col: str = "value", max_bytes: int = MAX_EXPORT_BYTES,
                           null_entries: str = "refuse") -> tuple[DataFrame, DataFrame]:
    """(good, quarantine): decoded exports, and refused texts with their reason."""
    decoded = decode_exports(raw, col, max_bytes, null_entries)
    good = decoded.filter(F.col("reason").isNull()).drop("reason")
    return good, decoded.filter(F.col("reason").isNotNull()).drop("export")


def traces_and_refused(spark: SparkSession, path: str, stream: bool = False, *, layout: str = "lines",
                       max_bytes: int = MAX_EXPORT_BYTES) -> tuple[DataFrame, DataFrame]:
    """(spans, refused): spans of all decodable exports under ``path``, attributes
    flattened, and the texts of the others (``value``) with their ``reason``, to be
    written beside them and counted by ``accounting.outcome_accounting``."""
    good, refused = quarantine_undecodable(read_exports(spark, path, stream=stream, layout=layout), max_bytes=max_bytes)
    return merge_span_event_attributes(flatten_attributes(spans_of(good))), refused


def store_traces(spark: SparkSession, path: str, out: str, *, layout: str = "lines", max_bytes: int = MAX_EXPORT_BYTES,
                 null_entries: str = "refuse") -> tuple[DataFrame, DataFrame]:
    """Appends the spans under ``path`` and the refused exports to ``out`` in one pass over
    the texts, and returns both as they are stored: (spans, refused). ``traces_and_refused``
    decodes anew for each of its tables; this is for batches that want both.
    """
    decoded = decode_exports(read_exports(spark, path, layout=layout), max_bytes=max_bytes, null_entries=null_entries)
    refused = F.col("reason").isNotNull()
    # A refused export is carried on as one span without fields.
    nothing = F.from_json(F.lit('{"resourceSpans":[{"scopeSpans":[{"spans":[{}]}]}]}'), decoded.schema["export"].dataType)
    kept = decoded.select(F.when(refused, F.col("value")).alias("value"), "reason", F.when(refused, nothing).otherwise(F.col("export")).alias("export"))
    spans = merge_span_event_attributes(flatten_attributes(spans_of(kept, "value", "reason")))
    part = F.when(F.col("reason").isNull(), "spans").otherwise("refused")
    spans.withColumn("part", part).write.mode("append").partitionBy("part").parquet(out)
    stored = spark.read.schema(spans.withColumn("part", part).schema).parquet(out)
    return stored.filter("part = 'spans'").drop("part", "value", "reason"), stored.filter("part = 'refused'").select("value", "reason")


def read_otlp_traces(spark: SparkSession, path: str, stream: bool = False, *, layout: str = "lines",
                     refused_path: str | None = None) -> DataFrame:
    """Spans of all decodable exports under ``path``, attributes flattened. The refused
    exports of a batch are appended to ``refused_path``; without it, and on streams,
    ``traces_and_refused`` has them."""
    if stream and refused_path:
        raise ValueError("refused exports of a stream are a stream of their own: see traces_and_refused")
    spans, refused = traces_and_refused(spark, path, stream, layout=layout)
    if refused_path:
        refused.write.mode("append").parquet(refused_path)
    return spans


def spans_of(exports: DataFrame, *carried: str) -> DataFrame:
    """One row per span; ids as lower-case hex, times as nanoseconds. ``carried`` columns
    of the export are repeated on each."""

    def hex_id(name: str) -> Column:
        text = F.translate(F.col(name), "-_", "+/")
        padded = F.rpad(text, F.ceil(F.length(text) / 4).cast("int") * 4, F.lit("="))
        return F.lower(F.hex(F.try_to_binary(padded, F.lit("base64")))).alias

    spans = (
        exports.select(*carried, F.inline("export.resourceSpans"))
        .select(*carried, F.inline("scopeSpans"))
        .select(*carried, F.col("scope.name").alias("scope"), F.inline("spans"))
    )
    return spans.select(
        *carried,
        "scope",
        "name",
        hex_id("traceId")("trace_id"),
        hex_id("spanId")("span_id"),
        hex_id("parentSpanId")("parent_span_id"),
        F.coalesce(F.col("startTimeUnixNano").try_cast("bigint"), F.lit(0)).alias("start_ns"),
        F.coalesce(F.col("endTimeUnixNano").try_cast("bigint"), F.lit(0)).alias("end_ns"),
        F.col("status.code").alias("status_code"),
        F.col("status.message").alias("status_message"),
        "attributes",
        "events",
    )


def _plain_value(value: Column) -> Column:
    """Scalar attribute value -> plain VARIANT; nested values -> null here."""
    data = F.unbase64(F.translate(value["bytesValue"], "-_", "+/"))
    text = let(data, lambda d: F.when(F.is_valid_utf8(d.cast("string")), d.cast("string")).otherwise(
        F.concat(F.lit("base64:"), F.base64(d))))
    return F.coalesce(
        value["stringValue"].cast("variant"),
        value["intValue"].try_cast("bigint").cast("variant"),
        value["boolValue"].cast("variant"),
        value["doubleValue"].cast("variant"),
        F.when(value["bytesValue"].isNotNull(), text).cast("variant"),
    )


def _is_nested(value: Column) -> Column:
    return value["arrayValue"].isNotNull() | value["kvlistValue"].isNotNull()


def _attribute_map(entries: Column) -> Column:
    """Plain attribute map; a repeated key keeps its last value."""
    pairs = F.transform(entries, lambda e: F.struct(
        F.coalesce(e["key"], F.lit("")).alias("key"), _plain_value(e["value"]).alias("value")))
    return F.map_from_entries(F.coalesce(pairs, F.array().cast("ARRAY<STRUCT<key: STRING, value: VARIANT>>")))


def _nested_map(entries: Column) -> Column:
    """Attributes that hold lists or maps, unwrapped in Arrow batches; null
    (nothing leaves the JVM) for the usual span without any."""
    nested = F.filter(entries, lambda e: _is_nested(e["value"]))
    text = F.when(F.size(nested) > 0, F.to_json(nested))
    return F.try_variant_get(F.try_parse_json(plain_attributes(text)), "$", OBJECT)


def _flat(entries: Column) -> Column:
    plain = _attribute_map(entries)
    return let(_nested_map(entries), lambda nested: F.when(nested.isNull(), plain).otherwise(F.map_concat(plain, nested)))


def flatten_attributes(spans: DataFrame) -> DataFrame:
    """Adds ``attrs``: the span's attributes as a map of plain values. Values are those of ``spans_of``,
    or VARIANTs as they stand in an export."""
    of, entries = spans.schema["attributes"].dataType.elementType["value"].dataType, F.col("attributes")
    if isinstance(of, T.VariantType):
        entries = F.transform(entries, lambda e: F.struct(e["key"].alias("key"), _value(e["value"]).alias("value")))
        spans = spans.withColumn("attributes", entries)
    return spans.withColumn("attrs", _flat(F.col("attributes"))).drop("attributes")


def merge_span_event_attributes(spans: DataFrame) -> DataFrame:
    """Merges attributes of span events under the span's own ones: later events
    win over earlier ones, the span always wins."""
    none = F.array().cast(_ATTRIBUTES)
    rows = spans.withColumn("_of_events", F.flatten(F.transform(F.col("events"), lambda e: F.coalesce(e["attributes"], none))))
    merged = F.when(F.size("_of_events") > 0, F.map_concat(_flat(F.col("_of_events")), F.col("attrs")))
    return rows.withColumn("attrs", F.coalesce(merged, F.col("attrs"))).drop("events", "_of_events")


def attribute_names(spans: DataFrame) -> DataFrame:
    """Adds ``names``: the keys of the ``attrs`` that ``flatten_attributes`` and ``merge_span_event_attributes``
    give the spans of ``spans_of``. No value is read."""
    none = F.array().cast("array<string>")
    of_events = F.transform(F.col("events"), lambda e: F.coalesce(e["attributes"]["key"], none))
    keys = F.concat(F.coalesce(F.col("attributes")["key"], none), F.coalesce(F.flatten(of_events), none))
    names = F.array_distinct(F.transform(keys, lambda key: F.coalesce(key, F.lit(""))))
    return spans.withColumn("names", names).drop("attributes", "events")
