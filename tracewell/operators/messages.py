"""Chat messages recorded as flattened span attributes."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracewell.constants import INPUT_MESSAGES, OUTPUT_MESSAGES
from tracewell.functions.lets import let
from tracewell.functions.variants import parse_if_json, to_object, variant_map


def _grouped(entries: Column, marker: Column, body: Callable[[Column, Column], Column]) -> Column:
    """``body(number, its entries)`` for every number that directly follows ``marker`` in the keys,
    in numeric order. Entries are sorted by number once and cut where it changes."""
    def place(entry: Column, at: Column) -> Column:
        head = F.substring_index(F.substring(entry["key"], F.length(marker) + 1, F.length(entry["key"])), ".", 1)
        number = F.when(head.rlike("^(0|[1-9][0-9]*)$"), head.try_cast("bigint"))
        return F.struct(F.when(F.startswith(entry["key"], marker), number).alias("number"), at.alias("at"))

    def cut(order: Column) -> Column:
        starts = F.filter(F.transform(order, lambda o, j: F.when((j == 0) | (F.get(order, j - 1)["number"] != o["number"]), j)),
                          lambda j: j.isNotNull())

        def group(start: Column, end: Column) -> Column:
            own = F.transform(F.slice(order, start + 1, end - start), lambda o: F.get(entries, o["at"]))
            return let(own, lambda found: body(F.get(order, start)["number"], found))

        return let(starts, lambda at: F.transform(at, lambda start, j: group(start, F.coalesce(F.get(at, j + 1), F.size(order)))))

    places = F.filter(F.transform(entries, place), lambda o: o["number"].isNotNull())
    return let(F.array_sort(places), cut)


def _value(entries: Column, key: Column) -> Column:
    return F.get(F.filter(entries, lambda e: e["key"] == key), F.lit(0))["value"]


def _tool_calls(entries: Column, base: Column) -> Column:
    marker = F.concat(base, F.lit(".tool_calls."))

    def call(j: Column, own: Column) -> Column:
        function = F.concat(marker, j.cast("string"), F.lit(".tool_call.function."))
        name = _value(own, F.concat(function, F.lit("name")))
        arguments = _value(own, F.concat(function, F.lit("arguments")))
        shape = to_object(variant_map([("name", name), ("arguments", parse_if_json(arguments))]))
        return F.when(name.isNotNull() | arguments.isNotNull(), shape)

    calls = F.filter(_grouped(entries, marker, call), lambda c: c.isNotNull())
    return F.when(F.size(calls) > 0, F.to_variant_object(calls))


def messages(attrs: Column, prefix: str) -> Column:
    """The messages under ``prefix`` in numeric order as a VARIANT list, each with
    its role, content and tool calls; null when there are none."""

    def rebuilt(entries: Column) -> Column:
        def message(i: Column, own: Column) -> Column:
            base = F.concat(F.lit(prefix + "."), i.cast("string"), F.lit(".message"))
            return variant_map([
                ("role", _value(own, F.concat(base, F.lit(".role"))), False),
                ("content", _value(own, F.concat(base, F.lit(".content"))), False),
                ("tool_calls", _tool_calls(own, base), False),
            ])

        found = _grouped(entries, F.lit(prefix + "."), message)
        kept = F.transform(F.filter(found, lambda m: F.size(m) > 0), to_object)
        return F.when(F.size(kept) > 0, F.to_variant_object(kept))

    return let(F.filter(F.map_entries(attrs), lambda e: F.startswith(e["key"], F.lit(prefix + "."))), rebuilt)


def rebuild_messages(spans: DataFrame, attrs: str = "attrs") -> DataFrame:
    """Adds ``input_messages`` and ``output_messages`` (VARIANT lists or null).

    All attributes of a span are in its row, so this needs no shuffle.
    """
    return spans.withColumns({
        "input_messages": messages(F.col(attrs), INPUT_MESSAGES),
        "output_messages": messages(F.col(attrs), OUTPUT_MESSAGES),
    })
