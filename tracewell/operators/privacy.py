"""Scrubbing jobs: redact by key, by pattern, pseudonymise, cap."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tracewell.constants import (
    BODY_HEAD_BYTES,
    BODY_TAIL_BYTES,
    MAX_ARGUMENT_CHARS,
    MAX_EXTRA_VALUE_BYTES,
    MAX_IP_CHARS,
    MAX_REDACT_DEPTH,
    REDACTED,
    TRUNCATION_MARK,
)
from tracewell.functions.hashing import hmac_hex, pseudonym
from tracewell.functions.ip import normalize_ip
from tracewell.functions.jsonwalk import Walk, rewrite
from tracewell.functions.lets import cut
from tracewell.functions.variants import (
    as_array,
    as_object,
    as_text,
    is_container,
    is_string,
    scalar_type,
    to_object,
)
from tracewell.operators.rules import Rule, check_rules


def json_text(df: DataFrame, col: str) -> Column:
    """JSON text of a string or VARIANT column."""
    return F.col(col) if isinstance(df.schema[col].dataType, T.StringType) else F.to_json(F.col(col))


# --- pseudonyms -------------------------------------------------------------


def pseudonymize(df: DataFrame, cols: Sequence[str], key: str | None, on_missing_key: str = "redact") -> DataFrame:
    """Replace each column by its keyed digest; null stays null."""
    return df.withColumns({c: pseudonym(F.col(c).cast("string"), key, on_missing_key) for c in cols})


def normalize_ip_column(df: DataFrame, col: str) -> DataFrame:
    return df.withColumn(col, normalize_ip(F.col(col)))


def address_pseudonym(address: Column, key: str | None, *, empty: str | None = "unknown",
                      limit: int | None = MAX_IP_CHARS) -> Column:
    """Digest of the canonical address. Without a key the canonical address is
    kept, cut to ``limit`` characters; a missing address becomes ``empty``."""
    canonical = normalize_ip(address)
    if key:
        shown = hmac_hex(canonical, key)
    else:
        shown = canonical if limit is None else F.left(canonical, F.lit(limit))
    if empty is None:
        return shown
    return F.when(address.isNull() | (address == ""), F.lit(empty)).otherwise(shown)


# --- redaction by key -------------------------------------------------------


def redact_json(df: DataFrame, col: str, *, extra_keys: Iterable[str] = (), rules: Sequence[Rule] = (),
                secret: str | None = None, limit: int | None = None, word_runs: bool = False,
                start_depth: int = 0) -> DataFrame:
    """Redact a JSON column (string or VARIANT) of any shape; result is VARIANT.

    A sensitive key hides its whole value; containers nested deeper than the
    limit are hidden too; ``rules`` then apply to keys and string leaves, and
    ``limit`` cuts long strings. ``word_runs`` also matches namespaced keys.
    Text that is not JSON becomes null.
    """
    walk = Walk(extra_keys=tuple(extra_keys), rules=tuple(rules), secret=secret, limit=limit,
                word_runs=word_runs, start_depth=start_depth)
    return df.withColumn(col, rewrite(json_text(df, col), walk))


def _redact_typed(value: Column, dtype: T.DataType, keys: frozenset[str], depth: int) -> Column:
    """Column rewrite for a declared type: decided from the schema, no UDF."""
    if isinstance(dtype, (T.StructType, T.MapType, T.ArrayType)) and depth > MAX_REDACT_DEPTH:
        return F.lit(None).cast(dtype)
    if isinstance(dtype, T.StructType):
        fields = []
        for f in dtype.fields:
            inner = value.getField(f.name)
            if f.name.lower() in keys:
                shown = F.lit(REDACTED) if isinstance(f.dataType, T.StringType) else F.lit(None).cast(f.dataType)
                inner = F.when(inner.isNotNull(), shown)
            else:
                inner = _redact_typed(inner, f.dataType, keys, depth + 1)
            fields.append(inner.alias(f.name))
        return F.when(value.isNotNull(), F.struct(*fields))
    if isinstance(dtype, T.ArrayType):
        return F.transform(value, lambda x: _redact_typed(x, dtype.elementType, keys, depth + 1))
    if isinstance(dtype, T.MapType):
        hidden = F.lit(REDACTED) if isinstance(dtype.valueType, T.StringType) else F.lit(None).cast(dtype.valueType)
        return F.transform_values(
            value,
            lambda k, v: F.when(F.lower(k).isin(*sorted(keys)), hidden).otherwise(
                _redact_typed(v, dtype.valueType, keys, depth + 1)
            ),
        )
    return value


def redact_struct(df: DataFrame, col: str, *, extra_keys: Iterable[str] = ()) -> DataFrame:
    """Redact a column of declared type (struct, map, array) inside Catalyst.

    The type stays as declared, so a hidden string reads as the sentinel and a
    hidden value of any other type as null.
    """
    keys = Walk(extra_keys=tuple(extra_keys)).keys
    return df.withColumn(col, _redact_typed(F.col(col), df.schema[col].dataType, keys, 0))


# --- redaction by pattern ---------------------------------------------------


def scrub_text(value: Column, rules: Sequence[Rule], secret: str | None = None) -> Column:
    """Apply value rules in order, each to the result of the one before."""
    for rule in rules:
        if not rule.on_values:
            continue
        if rule.action == "hash" and secret:
            if rule.compiled.search(""):
                raise ValueError(f"rule {rule.name!r}: a hash pattern must not match empty text")
            gaps = F.split(value, rule.java, -1)
            digests = F.transform(F.regexp_extract_all(value, F.lit(rule.java), F.lit(0)),
                                  lambda m: hmac_hex(m, secret))
            pieces = F.zip_with(gaps, digests, lambda gap, digest: F.concat(gap, F.coalesce(digest, F.lit(""))))
            value = F.when(value.rlike(rule.java), F.array_join(pieces, "")).otherwise(value)
        else:
            value = F.regexp_replace(value, rule.java, REDACTED)
    return value


def scrub_pii(df: DataFrame, cols: Sequence[str], rules: Sequence[Rule], secret: str | None = None, *,
              extra_keys: Iterable[str] = ()) -> DataFrame:
    """Scrub text, ``map<string,string>`` and VARIANT columns with ``rules``.

    In maps and JSON the sensitive keys go first, then key rules, then values. A rule
    that the JVM cannot read raises ValueError here, not at run time.
    """
    check_rules(df.sparkSession, rules)
    extra = tuple(extra_keys)
    for col in cols:
        dtype = df.schema[col].dataType
        if isinstance(dtype, T.StringType):
            df = df.withColumn(col, scrub_text(F.col(col), rules, secret))
        elif isinstance(dtype, T.MapType) and isinstance(dtype.valueType, T.StringType):
            keys = sorted(Walk(extra_keys=extra).keys)

            def entry(k: Column, v: Column) -> Column:
                out = F.when(F.lower(k).isin(*keys), F.lit(REDACTED))
                for rule in rules:
                    if rule.on_keys:
                        hashed = rule.action == "hash" and secret
                        out = out.when(k.rlike(rule.java), hmac_hex(v, secret) if hashed else F.lit(REDACTED))
                return out.otherwise(scrub_text(v, rules, secret))

            df = df.withColumn(col, F.transform_values(col, entry))
        else:
            df = redact_json(df, col, extra_keys=extra, rules=rules, secret=secret)
    return df


# --- caps -------------------------------------------------------------------


def truncate_strings(df: DataFrame, limits: Mapping[str, int]) -> DataFrame:
    """Cut each string column to its limit; in VARIANT columns every string leaf."""
    plain = {c: cut(F.col(c), n, TRUNCATION_MARK) for c, n in limits.items()
             if isinstance(df.schema[c].dataType, T.StringType)}
    df = df.withColumns(plain) if plain else df
    for col, limit in limits.items():
        if col not in plain:
            df = df.withColumn(col, rewrite(json_text(df, col), Walk(limit=limit, redact=False)))
    return df


def escaped_size(char: Column) -> Column:
    """Bytes of one character inside ASCII-escaped JSON text."""
    code = F.ascii(char)
    return (
        F.when(char.isin('"', "\\", "\n", "\r", "\t", "\b", "\f"), F.lit(2))
        .when(code.between(32, 126), F.lit(1))
        .when(code < 65536, F.lit(6))
        .otherwise(F.lit(12))
    )


def fit_encoded(text: Column, max_bytes: int = MAX_EXTRA_VALUE_BYTES) -> Column:
    """The longest prefix of ``text`` whose escaped JSON form, with the cut mark,
    fits ``max_bytes``; text that already fits is unchanged."""
    mark = TRUNCATION_MARK
    budget = max_bytes - (len(mark) + 2) - 2
    if budget + 2 <= 0:
        mark, budget = "", max_bytes - 2

    def used(prefix: Column, cap: int) -> Column:
        """(bytes, characters) of the longest prefix within ``cap`` bytes."""
        start = F.struct(F.lit(0).alias("size"), F.lit(0).alias("kept"), F.lit(False).alias("full"))

        def step(acc: Column, char: Column) -> Column:
            size = acc["size"] + escaped_size(char)
            full = acc["full"] | (size > cap)
            return F.struct(
                F.when(full, acc["size"]).otherwise(size).alias("size"),
                F.when(full, acc["kept"]).otherwise(acc["kept"] + 1).alias("kept"),
                full.alias("full"),
            )

        # No character is smaller than a byte, so longer prefixes need no look.
        chars = F.regexp_extract_all(F.left(prefix, F.lit(max(cap, 0) + 1)), F.lit("(?s)."), F.lit(0))
        return F.aggregate(chars, start, step)

    over = used(text, max_bytes - 2)["full"]
    trimmed = F.concat(F.left(text, used(text, budget)["kept"]), F.lit(mark))
    surely_fits = F.octet_length(text) * 6 + 2 <= max_bytes
    return F.when(surely_fits | ~over, text).otherwise(trimmed)


# --- tool arguments, results and bodies -------------------------------------


def sanitize_mcp_arguments(df: DataFrame, col: str, limit: int = MAX_ARGUMENT_CHARS) -> DataFrame:
    """Tool-call arguments: sensitive keys hidden at every level, top-level
    strings cut with their length noted, nested strings whole. Empty -> null;
    anything but an object -> ``{"_raw": text}``."""

    def shorten(text: Column) -> Column:
        note = F.concat(F.lit("... ("), F.length(text).cast("string"), F.lit(" chars)"))
        return F.when(F.length(text) > limit, F.concat(F.left(text, F.lit(limit)), note)).otherwise(text)

    raw = json_text(df, col)
    redacted = rewrite(raw, Walk(start_depth=-1))
    out = df.withColumn("_args", redacted).withColumn("_raw", raw)
    members = as_object(F.col("_args"))
    shortened = F.transform_values(
        members, lambda k, v: F.when(is_string(v), shorten(as_text(v)).cast("variant")).otherwise(v)
    )
    fallback = to_object(F.create_map(F.lit("_raw"), shorten(F.coalesce(
        F.when(is_string(F.col("_args")), as_text(F.col("_args"))), F.col("_raw"))).cast("variant")))
    empty = F.col("_raw").isNull() | (F.trim("_raw") == "") | F.trim("_raw").isin("null", "{}", "[]", '""', "0", "false")
    value = F.when(~empty, F.when(members.isNotNull(), F.when(F.size(members) > 0, to_object(shortened)))
                   .otherwise(fallback))
    return out.withColumn(col, value).drop("_args", "_raw")


def summarize_result(df: DataFrame, col: str, out: str = "result_summary") -> DataFrame:
    """Kind and size of a JSON result, never its content; not JSON or missing -> ``None``."""
    value = F.try_parse_json(F.col(col)) if isinstance(df.schema[col].dataType, T.StringType) else F.col(col)
    text, kind = as_text(value), scalar_type(value)

    def sized(name: str, size: Column) -> Column:
        return F.concat(F.lit(name), size.cast("string"), F.lit(")"))

    return df.withColumn(
        out,
        F.when(value.isNull() | F.is_variant_null(value), F.lit("None"))
        .when(as_object(value).isNotNull(), sized("dict(keys=", F.size(as_object(value))))
        .when(as_array(value).isNotNull(), sized("list(len=", F.size(as_array(value))))
        .when(kind == "STRING", sized("str(len=", F.length(text)))
        .when(kind == "BOOLEAN", F.initcap(text))
        .otherwise(text),
    )


def byte_limit(value: object, default: int) -> int:
    """A non-negative size from a configured value; the default when it is bad."""
    try:
        return max(0, int(value))
    except (TypeError, ValueError):
        return default


def head_tail_body(df: DataFrame, col: str, head: object = BODY_HEAD_BYTES, tail: object = BODY_TAIL_BYTES) -> DataFrame:
    """Redact a JSON body; one larger than ``head + tail`` bytes becomes a marker
    object with its first and last bytes and the counts. Sizes are those of the
    compact UTF-8 text."""
    head, tail = byte_limit(head, BODY_HEAD_BYTES), byte_limit(tail, BODY_TAIL_BYTES)
    out = redact_json(df, col).withColumn("_text", F.to_json(F.col(col)))
    data, total = F.col("_text").cast("binary"), F.octet_length("_text")

    def piece(start: Column, size: int) -> Column:
        return F.make_valid_utf8(F.substring(data, start, F.lit(size)).cast("string"))

    marker = F.to_variant_object(
        F.struct(
            F.lit(True).alias("body_truncated"),
            total.alias("body_bytes_total"),
            (total - head - tail).alias("body_bytes_dropped"),
            piece(F.lit(1), head).alias("head"),
            piece(total - tail + 1, tail).alias("tail"),
        )
    )
    keep = is_container(F.col(col))
    return out.withColumn(
        col, F.when(keep & (total > head + tail), marker).when(keep, F.col(col))
    ).drop("_text")
