"""Readers for VARIANT values. A missing key, SQL NULL and JSON null all read as
null; an empty string is a value unless a function says otherwise."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

OBJECT = "map<string,variant>"
ARRAY = "array<variant>"


def as_object(value: Column) -> Column:
    """The entries of a JSON object as a map, else null."""
    return F.try_variant_get(value, "$", OBJECT)


def as_array(value: Column) -> Column:
    return F.try_variant_get(value, "$", ARRAY)


def as_text(value: Column) -> Column:
    """Strings unquoted, other values as JSON text."""
    return F.try_variant_get(value, "$", "string")


def is_object(value: Column) -> Column:
    return F.coalesce(F.schema_of_variant(value).startswith("OBJECT<"), F.lit(False))


def is_array(value: Column) -> Column:
    return F.coalesce(F.schema_of_variant(value).startswith("ARRAY<"), F.lit(False))


def is_container(value: Column) -> Column:
    """Object or array. Only looks at the value itself, not at what it holds."""
    return as_object(value).isNotNull() | as_array(value).isNotNull()


def scalar_type(value: Column) -> Column:
    """Type name of a scalar; null for containers and missing values."""
    return F.when(~is_container(value), F.schema_of_variant(value))


def is_number(value: Column) -> Column:
    """Numbers and booleans."""
    return F.coalesce(F.schema_of_variant(value).rlike("^(BIGINT|DOUBLE|FLOAT|DECIMAL|BOOLEAN)"), F.lit(False))


def is_string(value: Column) -> Column:
    return F.coalesce(F.schema_of_variant(value) == "STRING", F.lit(False))


def present(value: Column) -> Column:
    """The value unless it is missing, JSON null or the empty string."""
    return F.when(as_text(value) != "", value)


def truthy(value: Column) -> Column:
    """Neither missing, null, empty, zero nor false."""
    text = as_text(value)
    return F.coalesce(
        F.when(F.schema_of_variant(value) == "STRING", text != "")
        .otherwise(~text.isin("false", "0", "0.0", "-0.0", "{}", "[]")),
        F.lit(False),
    )


def text_or(value: Column, default: str) -> Column:
    """Text of a truthy value, else ``default``."""
    return F.coalesce(F.when(truthy(value), as_text(value)), F.lit(default))


def first_present(attrs: Column, keys: Sequence[str]) -> Column:
    """First of the attributes that is present; zero and false count as values."""
    return F.coalesce(*[present(F.try_element_at(attrs, F.lit(key))) for key in keys])


def first_text(attrs: Column, keys: Sequence[str]) -> Column:
    return as_text(first_present(attrs, keys))


class Fields:
    """Named entries of a map of variants, taken out of it in one go.

    ``struct(attrs)`` is to be kept as a column under ``column``; ``get`` and the others read it.
    """

    def __init__(self, names: Sequence[str], column: str = "_fields"):
        self.column, self.places = column, {name: f"f{i}" for i, name in enumerate(dict.fromkeys(names))}

    def struct(self, attrs: Column) -> Column:
        quoted = ",".join("`" + name.replace("`", "``") + "`:variant" for name in self.places)
        found = F.try_variant_get(F.to_variant_object(attrs), "$", f"struct<{quoted}>")
        # Names that differ by case alone would be one field to Spark: from here on they are numbered.
        return found.cast("struct<" + ",".join(f"{place}:variant" for place in self.places.values()) + ">")

    def get(self, name: str) -> Column:
        return F.col(self.column)[self.places[name]]

    def first_present(self, keys: Sequence[str]) -> Column:
        """As the function of this name."""
        return F.coalesce(*[present(self.get(key)) for key in keys])


def parse_if_json(value: Column) -> Column:
    """A string that starts like an object or array is parsed; when that fails,
    and for every other value, the value itself."""
    text = as_text(value)
    # Text that parses is a string: other values are already what they would parse to.
    return F.coalesce(F.when(text.rlike(r"^\s*[\[{]"), F.try_parse_json(text)), value)


def variant_map(fields: Sequence[tuple[str, Column] | tuple[str, Column, bool]]) -> Column:
    """A map of variants from (name, value[, keep_null]) in one expression.

    Fields are kept when null unless ``keep_null`` is false.
    """
    always = [(name, value) for name, value, *keep in fields if keep != [False]]
    if_present = [(name, value) for name, value, *keep in fields if keep == [False]]
    parts = []
    if always:
        parts.append(F.create_map(*[c for name, value in always for c in (F.lit(name), value.cast("variant"))]))
    if if_present:
        entries = F.array(*[F.struct(F.lit(name).alias("key"), value.cast("variant").alias("value"))
                            for name, value in if_present])
        parts.append(F.map_from_entries(F.filter(entries, lambda e: e["value"].isNotNull())))
    return parts[0] if len(parts) == 1 else F.map_concat(*parts)


def to_object(fields: Column) -> Column:
    """A JSON object from a map of variants."""
    return F.to_variant_object(fields)
