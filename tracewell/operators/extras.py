"""Attributes an operator chose to copy onto events, raw or as keyed digests."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from tracewell import constants as C
from tracewell.functions.hashing import hmac_hex
from tracewell.functions.jsonwalk import Walk, rewrite
from tracewell.functions.lets import let
from tracewell.functions.names import SENSITIVE_NAME, name_key
from tracewell.functions.variants import OBJECT, as_text, is_container, is_string, to_object
from tracewell.operators.privacy import fit_encoded


def attribute_names(names: Sequence[str], what: str) -> tuple[str, ...]:
    """The distinct names without outer blanks, in order; ValueError if there are too
    many of them or any is too long."""
    chosen = tuple(dict.fromkeys(filter(None, map(str.strip, names))))
    faults = [f"{n[:40]!r}... has over {C.MAX_EXTRA_NAME_CHARS} characters" for n in chosen if len(n) > C.MAX_EXTRA_NAME_CHARS]
    if len(chosen) > C.MAX_EXTRA_ATTRIBUTES:
        faults.append(f"{len(chosen)} attributes, {C.MAX_EXTRA_ATTRIBUTES} are allowed")
    if faults:
        raise ValueError(f"{what}: {'; '.join(faults)}")
    return chosen


def mapping_reads(name: Column) -> Column:
    """Whether the span mapping itself reads an attribute of this name."""
    small = F.lower(F.trim(name))
    return reduce(or_, (F.startswith(small, F.lit(p)) for p in sorted(C.READ_PREFIXES)), small.isin(*sorted(C.READ_NAMES)))


def check_extras(extras: Sequence[str], hashed: Sequence[str], reserved: Sequence[str | None] = ()) -> None:
    """ValueError, before any row is read, for attributes that the mapping reads anyway (a
    digest would stand beside the raw value) and for two that become one key. Names are
    judged by the columns that later judge the rows."""
    names = sorted({n.strip() for n in (*extras, *hashed)})
    if not names:
        return
    spark = SparkSession.active()
    judged = spark.createDataFrame([(n,) for n in names], "name string").select(
        "name", name_key(F.col("name")).alias("key"),
        (mapping_reads(F.col("name")) | F.lower("name").isin(*(r.strip().lower() for r in reserved if r))).alias("read")).collect()
    if read := [r["name"] for r in judged if r["read"]]:
        raise ValueError(f"the span mapping already reads {read}")
    keys = Counter(r["key"] for r in judged)
    if clashing := [r["name"] for r in judged if keys[r["key"]] > 1]:
        raise ValueError(f"these attributes share a key: {clashing}")


def stable_text(value: Column) -> Column:
    """Strings as they are, other values as JSON with sorted keys."""
    return F.when(is_string(value), as_text(value)).otherwise(F.to_json(value))


def extra_fields(attrs: Column, extras: Sequence[str], hashed: Sequence[str], secret: str | None) -> Column:
    """Map of derived key -> value for the chosen attributes a span carries.

    Sensitive names are redacted, hashed ones digested (or redacted without a
    key), structured values redacted by nested key, everything bounded in size.
    """
    nothing = F.create_map().cast(OBJECT)
    plain = [name for name in extras if name not in hashed]

    def value(name: str) -> Column:
        found = F.try_element_at(attrs, F.lit(name))
        return F.when(~F.is_variant_null(found), found)

    def collect(pairs: list[tuple[Column, Column]]) -> Column:
        entries = F.array(*[F.struct(k.alias("key"), v.alias("value")) for k, v in pairs])
        return F.map_from_entries(F.filter(entries, lambda e: e["value"].isNotNull()))

    pairs, nested = [], []
    for name in plain:
        key, found = name_key(F.lit(name)), value(name)
        if re.search(SENSITIVE_NAME, name):
            pairs.append((key, F.when(found.isNotNull(), F.lit(C.REDACTED).cast("variant"))))
            continue
        nested.append((key, F.when(is_container(found), found)))
        text = F.when(is_string(found), fit_encoded(as_text(found)).cast("variant")).otherwise(found)
        pairs.append((key, F.when(~is_container(found), text)))
    for name in hashed:
        found = value(name)
        digest = hmac_hex(stable_text(found), secret) if secret else F.lit(C.REDACTED)
        pairs.append((name_key(F.lit(name)), F.when(found.isNotNull(), digest.cast("variant"))))
    result = collect(pairs) if pairs else nothing
    if nested:
        structured = collect(nested)
        text = F.when(F.size(structured) > 0, F.to_json(to_object(structured)))
        clean = F.try_variant_get(rewrite(text, Walk(word_runs=True)), "$", OBJECT)
        bounded = F.transform_values(clean, lambda k, v: let(stable_text(v), lambda text: fit_encoded(text)).cast("variant"))
        result = F.map_concat(result, F.coalesce(bounded, nothing))
    return result
