"""What became of the input: counts, admissions, samples, coverage, sizes."""

from __future__ import annotations

import math
import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tracewell.constants import REDACTED, SENSITIVE_KEYS
from tracewell.functions.names import is_sensitive_name, name_key
from tracewell.operators.extras import mapping_reads
from tracewell.operators.filters import ai_verdict
from tracewell.operators.rules import Rule
from tracewell.operators.selection import first_of_each
from tracewell.operators.timeline import RUN_ROWS

REFUSALS = ("undecodable", "too_large")
OUTCOMES = ("ignored", "filtered", "oversize", "queue_full", "health", "path", "unsampled", "llm", "mcp", "http")


def _outcome_counts() -> list[Column]:
    return [*(F.count_if(F.col("outcome") == o).alias(o) for o in OUTCOMES), F.count("*").alias("received")]


def observed(events: DataFrame, name: str = "outcomes") -> tuple[DataFrame, Observation]:
    """``events``, whose outcomes are counted in whatever single pass reads them, and the
    observation that has the counts afterwards (``.get``): no second mapping for the account."""
    observation = Observation(name)
    return events.observe(observation, *_outcome_counts()), observation


def outcome_accounting(events: DataFrame, refused: DataFrame | None = None) -> DataFrame:
    """One row: a count per outcome and ``received``, which is their sum. With the
    ``refused`` exports, whose spans nobody can count, also a count of exports per reason:
    ``unsound`` are those whose JSON is none of the format, for any of its reasons."""
    row = events.agg(*_outcome_counts())
    if refused is None:
        return row
    return row.crossJoin(refused.agg(*(F.count_if(F.col("reason") == r).alias(f"exports_{r}") for r in REFUSALS),
                                     F.count_if(~F.col("reason").isin(*REFUSALS)).alias("exports_unsound")))


def delivery_accounting(acks: DataFrame) -> DataFrame:
    ok = F.col("delivered")
    return acks.agg(
        F.coalesce(F.sum(F.when(ok, F.col("n"))), F.lit(0)).alias("posted"),
        F.count_if(~ok).alias("post_failures"),
        F.coalesce(F.sum("accepted"), F.lit(0)).alias("accepted"),
        F.coalesce(F.sum("skipped"), F.lit(0)).alias("skipped"),
    )


def _windowed(df: DataFrame, ts: str, window: str) -> DataFrame:
    return df.withColumn("window_start", F.window(ts, window).start)


def admit_bounded(df: DataFrame, capacity: int, window: str, keys: Sequence[str] = (), *, ts: str = "ts",
                  tie: str = "event_id", run_rows: int = RUN_ROWS) -> DataFrame:
    """The first ``capacity`` arrivals of each key and time window, in (ts, tie) order; later
    ones are dropped. However large the capacity or the crowd in one window, no task sorts more than
    about ``run_rows`` of its rows (see ``selection``)."""
    rows = _windowed(df, ts, window)
    return first_of_each(rows, capacity, ["window_start", *keys], [F.col(ts), F.col(tie)], run_rows=run_rows)


def admission_report(df: DataFrame, capacity: int, window: str, keys: Sequence[str] = (), *,
                     ts: str = "ts") -> DataFrame:
    """Admitted and dropped counts per key and window."""
    return _windowed(df, ts, window).groupBy("window_start", *keys).agg(
        F.least(F.count("*"), F.lit(capacity)).alias("admitted"),
        F.greatest(F.count("*") - capacity, F.lit(0)).alias("dropped"),
    )


def scale_sampled_counts(df: DataFrame, rate: float, keys: Sequence[str]) -> DataFrame:
    """Estimated full counts behind a sample of known rate, with standard error."""
    if not 0 < rate <= 1 or math.isnan(rate):
        raise ValueError("rate must be within (0, 1]")
    n = F.count("*")
    return df.groupBy(*keys).agg(
        n.alias("sampled"),
        (n / F.lit(rate)).alias("estimated"),
        (F.sqrt(n * F.lit(1 - rate)) / F.lit(rate)).alias("std_error"),
    )


# --- redaction coverage -----------------------------------------------------


def _redacted_entries(df: DataFrame, col: str) -> Column:
    """Keys with a redacted value, at every depth and through lists. They are found in the
    JSON text: a key stands behind ``{`` or ``,``, a quote inside a string behind ``\\``."""
    value = F.col(col)
    if isinstance(df.schema[col].dataType, T.MapType):
        value = F.transform_values(col, lambda k, v: v.cast("variant"))
    found = rf'(?<=[{{,])"((?:[^"\\]|\\.)*)":"{re.escape(REDACTED)}"'
    return F.regexp_extract_all(F.to_json(value), F.lit(found), 1)


def redaction_coverage(df: DataFrame, col: str) -> DataFrame:
    """How often each sensitive key was redacted; keys never seen count zero."""
    seen = df.select(F.explode(_redacted_entries(df, col)).alias("name"))
    counts = seen.groupBy(F.lower("name").alias("key")).agg(F.count("*").alias("redactions"))
    known = df.sparkSession.createDataFrame([(k,) for k in SENSITIVE_KEYS], "key string")
    return counts.join(known, "key", "full_outer").select("key", F.coalesce("redactions", F.lit(0)).alias("redactions"))


def attribute_catalog(spans: DataFrame, attrs: str = "attrs", trace: str = "trace_id") -> DataFrame:
    """Every attribute name seen, with its derived key, whether it looks
    sensitive, whether the mapping reads it, and how many names share the key. ``attrs`` is a map, or
    the array of a span's distinct names; ``traces`` is approximate. Spans are counted by all their names
    first, so only combinations of names are taken apart."""
    names = F.col(attrs) if isinstance(spans.schema[attrs].dataType, T.ArrayType) else F.map_keys(attrs)
    sets = spans.groupBy(names.alias("_names")).agg(
        F.count("*").alias("_spans"), F.hll_sketch_agg(F.col(trace).cast("string")).alias("_traces"))
    used = sets.select(F.explode("_names").alias("name"), "_spans", "_traces").groupBy("name").agg(
        F.sum("_spans").alias("spans"), F.hll_sketch_estimate(F.hll_union_agg("_traces")).alias("traces"))
    described = used.withColumns({
        "derived_key": name_key(F.col("name")),
        "sensitive": is_sensitive_name(F.col("name")),
        "owned": mapping_reads(F.col("name")),
    })
    return described.withColumn("names_with_key", F.count("*").over(Window.partitionBy("derived_key")))


def pii_hit_report(df: DataFrame, cols: Sequence[str], rules: Sequence[Rule], by: Sequence[str] = ()) -> DataFrame:
    """Rows and matches per rule and column, on the text as stored."""
    hits = [
        F.struct(F.lit(rule.name).alias("rule"), F.lit(col).alias("source_column"),
                 F.size(F.regexp_extract_all(F.col(col), F.lit(rule.java), F.lit(0))).alias("hits"))
        for rule in rules if rule.on_values for col in cols
    ]
    found = df.select(*by, F.explode(F.array(*hits)).alias("h")).filter(F.col("h.hits") > 0)
    return found.groupBy(*by, F.col("h.rule").alias("rule"), F.col("h.source_column").alias("source_column")).agg(
        F.count("*").alias("docs"), F.sum("h.hits").alias("hits"))


def ai_traffic_report(requests: DataFrame, endpoint: str = "endpoint", body: str = "body") -> DataFrame:
    """Requests per endpoint and verdict: jsonrpc, path, shape or none."""
    verdict = ai_verdict(F.col(endpoint), F.col(body)).alias("verdict")
    return requests.groupBy(F.col(endpoint).alias("endpoint"), verdict).agg(F.count("*").alias("requests"))


def payload_size_report(events: DataFrame, by: Sequence[str] = ("kind",), size: str = "event_bytes") -> DataFrame:
    """Event sizes per group and size action. Sizes are counted first, so the
    percentiles are exact and their state is bounded by the size limit."""
    counted = events.groupBy(*by, "size_action", size).agg(F.count("*").alias("_n"))

    def share(p: float) -> Column:
        return F.percentile(size, p, F.col("_n"))

    return counted.groupBy(*by, "size_action").agg(
        F.sum("_n").alias("events"),
        F.sum(F.col(size) * F.col("_n")).alias("total_bytes"),
        share(0.5).alias("p50_bytes"),
        share(0.95).alias("p95_bytes"),
        F.max(size).alias("max_bytes"),
    )
