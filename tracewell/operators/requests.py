"""Request parts: headers and query parameters."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracewell.constants import REDACTED, SENSITIVE_HEADERS
from tracewell.functions.hashing import pseudonym
from tracewell.functions.jsonwalk import Walk
from tracewell.operators.privacy import scrub_text
from tracewell.operators.rules import Rule


def title_case(name: Column) -> Column:
    """``x-api-key`` -> ``X-Api-Key``."""
    parts = F.transform(
        F.split(name, "-"), lambda p: F.concat(F.upper(F.left(p, F.lit(1))), F.lower(F.substring(p, 2, 1 << 30)))
    )
    return F.array_join(parts, "-")


def header_allowlist(names: Iterable[str] | None) -> tuple[str, ...]:
    """Lower-cased names; empty (nothing asked, or only blanks) captures all."""
    return tuple(dict.fromkeys(n.strip().lower() for n in names or () if n.strip()))


def captured_headers(headers: Column, secret: str | None, allow: Iterable[str] | None = None) -> Column:
    """``array<struct<name,value>>`` -> map with canonical names.

    Pseudo-headers and names outside ``allow`` are left out, sensitive ones
    redacted (authorization digested when there is a key), repeats joined by
    ``", "``. Nothing left -> null.
    """
    allowed = header_allowlist(allow)

    def wanted(h: Column) -> Column:
        keep = ~F.startswith(h["name"], F.lit(":"))
        return keep & F.lower(h["name"]).isin(*allowed) if allowed else keep

    def shown(h: Column) -> Column:
        lower = F.lower(h["name"])
        value = F.when(lower == "authorization", pseudonym(h["value"], secret)).when(
            lower.isin(*SENSITIVE_HEADERS), F.lit(REDACTED)
        ).otherwise(h["value"])
        return F.struct(title_case(h["name"]).alias("name"), value.alias("value"))

    kept = F.transform(F.filter(headers, wanted), shown)
    return F.when(F.size(kept) > 0, F.transform_values(_grouped(kept), lambda k, vs: F.array_join(vs, ", ")))


def _grouped(pairs: Column) -> Column:
    """``array<struct<name,value>>`` -> map of name to its values, sorted by name."""
    names = F.array_sort(F.array_distinct(F.transform(pairs, lambda p: p["name"])))
    return F.map_from_entries(F.transform(names, lambda n: F.struct(
        n.alias("key"),
        F.transform(F.filter(pairs, lambda p: p["name"] == n), lambda p: p["value"]).alias("value"),
    )))


def build_headers(df: DataFrame, col: str = "headers", *, secret: str | None = None,
                  allow: Iterable[str] | None = None) -> DataFrame:
    return df.withColumn(col, captured_headers(F.col(col), secret, allow))


def filter_headers(df: DataFrame, allow: Iterable[str] | None, col: str = "headers") -> DataFrame:
    """Keep the allowed names of a header map; an empty list keeps all."""
    allowed = header_allowlist(allow)
    if not allowed:
        return df
    return df.withColumn(col, F.map_filter(col, lambda k, v: F.lower(k).isin(*allowed)))


def server_headers(meta: Column, secret: str | None) -> Column:
    """Headers from a server-variable map (``HTTP_X_Y``, ``CONTENT_TYPE``)."""
    entries = F.filter(
        F.map_entries(meta),
        lambda e: F.startswith(e["key"], F.lit("HTTP_")) | e["key"].isin("CONTENT_TYPE", "CONTENT_LENGTH"),
    )
    pairs = F.transform(entries, lambda e: F.struct(
        F.replace(F.regexp_replace(e["key"], "^HTTP_", ""), F.lit("_"), F.lit("-")).alias("name"),
        e["value"].alias("value"),
    ))
    return captured_headers(pairs, secret)


def query_params(query: Column) -> Column:
    """Form-encoded query text -> map of name to values; none -> null. A part
    without ``=`` has the value ``""``; bad escapes stay as they are."""

    def decoded(text: Column) -> Column:
        return F.coalesce(F.try_url_decode(text), F.replace(text, F.lit("+"), F.lit(" ")))

    parts = F.filter(F.split(query, "&"), lambda p: p != "")
    pairs = F.transform(parts, lambda p: F.struct(
        decoded(F.substring_index(p, "=", 1)).alias("name"),
        F.when(p.contains("="), decoded(F.substring(p, F.instr(p, "=") + 1, F.length(p)))).otherwise("").alias("value"),
    ))
    return F.when(F.size(parts) > 0, _grouped(pairs))


def scrub_params(params: Column, *, extra_keys: Iterable[str] = (), rules: Sequence[Rule] = (),
                 secret: str | None = None) -> Column:
    """Redact sensitive parameters (one sentinel whatever the count), then apply rules."""
    keys = sorted(Walk(extra_keys=tuple(extra_keys)).keys)

    def entry(k: Column, vs: Column) -> Column:
        out = F.when(F.lower(k).isin(*keys), F.array(F.lit(REDACTED)))
        for rule in rules:
            if rule.on_keys:
                hashed = F.transform(vs, lambda v, r=rule: pseudonym(v, secret))
                one = hashed if rule.action == "hash" and secret else F.array(F.lit(REDACTED))
                out = out.when(k.rlike(rule.java), F.when(F.size(vs) == 1, one).otherwise(F.array(F.lit(REDACTED))))
        return out.otherwise(F.transform(vs, lambda v: scrub_text(v, rules, secret)))

    return F.transform_values(params, entry)


def split_path(path: Column) -> tuple[Column, Column]:
    """(endpoint, query) at the first ``?``; query is null without one."""
    query = F.when(path.contains("?"), F.substring(path, F.instr(path, "?") + 1, F.length(path)))
    return F.substring_index(path, "?", 1), query


def parse_query(df: DataFrame, path: str = "path", *, extra_keys: Iterable[str] = (),
                rules: Sequence[Rule] = (), secret: str | None = None) -> DataFrame:
    """Adds ``endpoint`` and scrubbed ``query_params``."""
    endpoint, query = split_path(F.col(path))
    return df.withColumns({
        "endpoint": endpoint,
        "query_params": scrub_params(query_params(query), extra_keys=extra_keys, rules=rules, secret=secret),
    })
