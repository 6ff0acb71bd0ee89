"""Which requests and spans go on, and which bodies travel with them.

Predicates are plain column expressions; place the cheap path tests before any
JSON parsing, Catalyst does not order filters by cost.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracewell.constants import (
    HEALTH_PATHS,
    HEALTH_SEGMENTS,
    LLM_PATH_PATTERN,
    MCP_METHOD_KEY,
    MODEL_COMPANIONS,
    MODEL_KEYS,
    PROMPT_COMPANIONS,
    SPAN_KIND_KEYS,
    SPAN_KIND_VALUES,
)
from tracewell.functions.globs import matches_any
from tracewell.functions.lets import any_of
from tracewell.functions.variants import as_array, as_object, as_text, is_container, is_string, truthy


def drop_health_exact(df: DataFrame, col: str = "endpoint") -> DataFrame:
    return df.filter(~F.col(col).isin(*HEALTH_PATHS))


def is_health_segment(endpoint: Column, exempt_ai_schemes: bool = True) -> Column:
    """Whether the last path segment names a health check."""
    last = F.lower(F.substring_index(F.rtrim(endpoint, F.lit("/")), "/", -1))
    hit = F.coalesce(last.isin(*HEALTH_SEGMENTS), F.lit(False))
    return hit & ~endpoint.rlike("^(?:mcp|llm)://") if exempt_ai_schemes else hit


def split_health_segment(df: DataFrame, col: str = "endpoint", *, exempt_ai_schemes: bool = True) -> DataFrame:
    """Adds ``ingest`` = ``accepted`` or ``skipped``; filter or group on it."""
    skipped = is_health_segment(F.coalesce(F.col(col), F.lit("")), exempt_ai_schemes)
    return df.withColumn("ingest", F.when(skipped, F.lit("skipped")).otherwise(F.lit("accepted")))


def path_wanted(endpoint: Column, capture: Sequence[str] = (), exclude: Sequence[str] = ()) -> Column:
    """Whether a path matches a ``capture`` glob (any path when there is none) and no
    ``exclude`` glob. Invalid globs raise ValueError here, not at run time."""
    wanted = matches_any(endpoint, capture) if capture else F.lit(True)
    return wanted & ~matches_any(endpoint, exclude) if exclude else wanted


def filter_paths(df: DataFrame, capture: Sequence[str] = (), exclude: Sequence[str] = (),
                 col: str = "endpoint") -> DataFrame:
    """Keep the paths that are wanted."""
    return df.filter(path_wanted(F.col(col), capture, exclude)) if capture or exclude else df


def sample_rate(rate: float) -> float:
    """A configured rate forced into [0, 1]; not-a-number means 1."""
    return 1.0 if math.isnan(rate) else min(1.0, max(0.0, rate))


def in_sample(rate: float, key: str | None = None, seed: int | None = None) -> Column:
    """True with probability ``rate``: see ``sample_requests``."""
    rate = sample_rate(rate)
    if rate in (0.0, 1.0):
        return F.lit(rate == 1.0)
    if key is None:
        return F.rand(seed) < rate
    point = F.conv(F.substring(F.md5(F.col(key).cast("string")), 1, 8), 16, 10).cast("double")
    return point / F.lit(4294967296.0) < rate


def sample_requests(df: DataFrame, rate: float, key: str | None = None, seed: int | None = None) -> DataFrame:
    """Keep each row with probability ``rate``.

    With ``key`` the choice is a function of that column, so it is the same in
    every run and for every row of one key; without, each row is drawn freshly.
    """
    return df if sample_rate(rate) == 1.0 else df.filter(in_sample(rate, key, seed))


# --- bodies -----------------------------------------------------------------


def is_json_type(content_type: Column) -> Column:
    return F.coalesce(F.lower(content_type).contains("application/json"), F.lit(False))


def parsed_container(text: Column) -> Column:
    """Parsed JSON when it is an object or array; bare values and bad JSON -> null."""
    parsed = F.try_parse_json(text)
    return F.when(is_container(parsed), parsed)


def body_eligible(df: DataFrame, body: str = "body", method: str = "method",
                  content_type: str = "content_type") -> DataFrame:
    """``body`` text -> VARIANT for JSON POST, PUT and PATCH requests, else null."""
    wanted = F.upper(method).isin("POST", "PUT", "PATCH") & is_json_type(F.col(content_type))
    return df.withColumn(body, F.when(wanted, parsed_container(F.col(body))))


def response_body_eligible(df: DataFrame, body: str = "response_body", content_type: str = "response_type",
                           encoding: str = "response_encoding", streaming: str | None = None) -> DataFrame:
    """``body`` text -> VARIANT for whole, identity-encoded JSON responses. Other
    encodings leave a marker object naming the encoding."""
    enc = F.lower(F.coalesce(F.col(encoding), F.lit("")))
    marker = F.to_variant_object(F.struct(enc.alias("body_skipped_encoding")))
    wanted = is_json_type(F.col(content_type))
    if streaming:
        wanted = wanted & ~F.coalesce(F.col(streaming), F.lit(False))
    return df.withColumn(
        body,
        F.when(wanted & ~enc.isin("", "identity"), marker).when(wanted, parsed_container(F.col(body))),
    )


def is_llm_path(path: Column) -> Column:
    return F.lower(path).rlike(LLM_PATH_PATTERN)


def is_jsonrpc_shaped(body: Column) -> Column:
    return F.coalesce(F.map_contains_key(as_object(body), "jsonrpc"), F.lit(False))


def is_prompt_shaped(body: Column) -> Column:
    """Whether a parsed body looks like a model prompt."""
    top = as_object(body)

    def has(key: str) -> Column:
        return F.coalesce(F.map_contains_key(top, key), F.lit(False))

    def some_item_has(key: str, member: str) -> Column:
        items = F.try_variant_get(body, f"$.{key}", "array<variant>")
        found = F.exists(items, lambda m: F.coalesce(F.map_contains_key(as_object(m), member), F.lit(False)))
        return F.coalesce(found, F.lit(False))

    first = as_object(F.get(as_array(body), F.lit(0)))
    message_list = F.map_contains_key(first, "role") & F.map_contains_key(first, "content")
    return (
        some_item_has("messages", "role")
        | (has("model") & any_of(has(k) for k in MODEL_COMPANIONS))
        | some_item_has("contents", "parts")
        | (has("prompt") & any_of(has(k) for k in PROMPT_COMPANIONS))
        | has("anthropic_version")
        | (has("inputText") & has("textGenerationConfig"))
        | F.coalesce(message_list, F.lit(False))
    )


def ai_verdict(path: Column, body: Column) -> Column:
    """``jsonrpc``, ``path``, ``shape`` or ``none`` for a request with a parsed body."""
    return (
        F.when(is_jsonrpc_shaped(body), F.lit("jsonrpc"))
        .when(is_llm_path(path), F.lit("path"))
        .when(is_prompt_shaped(body), F.lit("shape"))
        .otherwise(F.lit("none"))
    )


def withhold_ai_bodies(df: DataFrame, body: str = "body", endpoint: str = "endpoint",
                       capture_ai_content: bool = False) -> DataFrame:
    """Null the bodies that carry model prompts; the events themselves stay. A
    model path loses its body whatever its shape, elsewhere JSON-RPC is kept."""
    if capture_ai_content:
        return df
    withheld = is_llm_path(F.col(endpoint)) | (~is_jsonrpc_shaped(F.col(body)) & is_prompt_shaped(F.col(body)))
    return df.withColumn(body, F.when(~withheld, F.col(body)))


# --- spans ------------------------------------------------------------------


def span_kind(attrs: Column) -> Column:
    """``mcp``, ``llm`` or null from the merged span attributes."""
    model = any_of(truthy(F.try_element_at(attrs, F.lit(key))) for key in MODEL_KEYS)

    def marked(key: str) -> Column:
        value = F.try_element_at(attrs, F.lit(key))
        return F.coalesce(is_string(value) & F.lower(as_text(value)).isin(*SPAN_KIND_VALUES), F.lit(False))

    return (
        F.when(F.map_contains_key(attrs, MCP_METHOD_KEY), F.lit("mcp"))
        .when(F.coalesce(model, F.lit(False)), F.lit("llm"))
        .when(any_of(marked(key) for key in SPAN_KIND_KEYS), F.lit("llm"))
    )


def classify_spans(spans: DataFrame, attrs: str = "attrs") -> DataFrame:
    """Adds ``kind``: ``llm``, ``mcp`` or null for spans of no interest."""
    return spans.withColumn("kind", span_kind(F.col(attrs)))
