"""Questions the events are recorded for.

All results are linear in the input: counts are taken before joins, and "what
came before" is one row per event (see ``timeline``), never pairs within a group.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tracewell.constants import REDACTED
from tracewell.functions.variants import as_object
from tracewell.operators.selection import first_of_each
from tracewell.operators.timeline import (
    RUN_ROWS,
    with_group_number,
    with_latest,
    with_next,
    with_previous,
    with_running_total,
)
from tracewell.session import stored_once


def _columns(events: DataFrame, *names: str) -> DataFrame:
    return events.select(*dict.fromkeys(names))


def seconds_between(later: Column, earlier: Column) -> Column:
    return (F.unix_micros(later) - F.unix_micros(earlier)) / F.lit(1e6)


# --- inventory --------------------------------------------------------------


def endpoint_inventory(events: DataFrame, keys: Sequence[str] = ("kind", "endpoint", "method"), *,
                       exact: bool = False, run_rows: int = RUN_ROWS) -> DataFrame:
    """Calls, errors, durations and first/last sight per endpoint.

    The 95th percentile is approximate; with ``exact`` it is that of all durations, from
    running totals over their distinct values: no state grows with these.
    """
    facts = [
        F.count("*").alias("calls"),
        F.count_if(F.col("status") == "error").alias("errors"),
        F.avg("duration_ms").alias("avg_duration_ms"),
        F.min("ts").alias("first_seen"),
        F.max("ts").alias("last_seen"),
    ]
    if not exact:
        return events.groupBy(*keys).agg(*facts, F.percentile_approx("duration_ms", 0.95, 10000).alias("p95_duration_ms"))
    binned = stored_once(events.groupBy(*keys, "duration_ms").agg(
        F.count("*").alias("_n"), F.count_if(F.col("status") == "error").alias("_e"),
        F.sum("duration_ms").alias("_s"), F.min("ts").alias("_lo"), F.max("ts").alias("_hi")), "durations")
    timed = F.when(F.col("duration_ms").isNotNull(), F.col("_n"))
    whole = binned.groupBy(F.struct(*keys).alias("_group")).agg(
        F.sum("_n").alias("calls"),
        F.sum("_e").alias("errors"),
        (F.sum("_s") / F.sum(timed)).alias("avg_duration_ms"),
        F.min("_lo").alias("first_seen"),
        F.max("_hi").alias("last_seen"),
    )
    found = exact_percentile(binned, keys, "duration_ms", 0.95, "p95_duration_ms", weight=F.col("_n"), run_rows=run_rows)
    return whole.join(found.select(F.struct(*keys).alias("_group"), "p95_duration_ms"), "_group", "left").select("_group.*", *(
        c for c in [*whole.columns, "p95_duration_ms"] if c != "_group"))


def exact_percentile(df: DataFrame, keys: Sequence[str], value: str, fraction: float, out: str, *, weight: Column | None = None,
                     run_rows: int = RUN_ROWS) -> DataFrame:
    """(keys, ``out``): the value at ``fraction`` of each group's values, between neighbours
    by linear interpolation. A row stands for ``weight`` rows, or for itself. Groups without a
    value are left out; NaN is the largest. ``df`` is read more than once.

    Values are counted first. Of the counts' running totals, which a group of any size has
    in runs (see ``timeline``), the first that passes a rank gives the value of that rank.
    """
    times = F.count("*") if weight is None else F.sum(weight)
    binned = df.filter(F.col(value).isNotNull()).groupBy(*keys, value).agg(times.alias("_n"))
    counted = with_running_total(binned, keys, F.col("_n"), "_upto", ts=value, tie=value, run_rows=run_rows)
    group = F.struct(*keys).alias("_group")
    totals = binned.groupBy(group).agg((F.lit(float(fraction)) * (F.sum("_n") - 1)).alias("_place"))
    ranked = counted.withColumn("_group", group).join(totals, "_group")

    def at(rank: Column) -> Column:
        return F.min(F.when(F.col("_upto") > rank, F.col(value)))

    ends = ranked.groupBy("_group", "_place").agg(at(F.floor("_place")).alias("_low"), at(F.ceil("_place")).alias("_high"))
    share = F.col("_place") - F.floor("_place")
    between = F.when(share == 0, F.col("_low")).otherwise((1 - share) * F.col("_low") + share * F.col("_high"))
    return ends.select("_group.*", between.cast("double").alias(out))


def observed_arguments(events: DataFrame, keys: Sequence[str] = ("kind", "endpoint"), body: str = "body") -> DataFrame:
    """Argument names seen per endpoint, with counts, as rows (a set per endpoint
    could grow without bound)."""
    names = events.select(*keys, F.explode(F.map_keys(as_object(F.col(body)))).alias("argument"))
    return names.groupBy(*keys, "argument").agg(F.count("*").alias("calls"))


def _called(events: DataFrame) -> DataFrame:
    tools = events.filter(F.col("handler_name").isNotNull())
    return tools.groupBy("mcp_server", F.col("handler_name").alias("name")).agg(
        F.count("*").alias("calls"), F.min("ts").alias("first_seen"))


def undeclared_calls(events: DataFrame, inventory: DataFrame) -> DataFrame:
    """Called but never declared (server, name); both sides are reduced first."""
    declared = inventory.select("mcp_server", "name").distinct()
    return _called(events).join(declared, ["mcp_server", "name"], "left_anti")


def never_called(events: DataFrame, inventory: DataFrame) -> DataFrame:
    """Declared but never called."""
    declared = inventory.groupBy("mcp_server", "item_kind", "name").agg(F.max("ts").alias("declared_at"))
    return declared.join(_called(events).select("mcp_server", "name"), ["mcp_server", "name"], "left_anti")


def definition_drift(inventory: DataFrame, *, run_rows: int = RUN_ROWS) -> DataFrame:
    """Declarations whose definition differs from the one before."""
    keys = ["mcp_server", "item_kind", "name"]
    rows = with_previous(inventory.select(*keys, "event_id", "ts", "def_hash"), keys, ["def_hash", "ts"], run_rows=run_rows)
    changed = rows.filter(F.col("prev_def_hash").isNotNull() & (F.col("prev_def_hash") != F.col("def_hash")))
    return changed.select(*keys, "event_id", "ts", "prev_ts", "prev_def_hash", "def_hash")


# --- sequences --------------------------------------------------------------


def call_graph(events: DataFrame, keys: Sequence[str] = ("session_id",), node: str = "handler_name", *,
               run_rows: int = RUN_ROWS) -> DataFrame:
    """Edges from one call to the next of a session, with gap statistics."""
    rows = with_next(_columns(events, *keys, "event_id", "ts", node), keys, [node, "ts"], run_rows=run_rows).filter(F.col("next_ts").isNotNull())
    gap = seconds_between(F.col("next_ts"), F.col("ts"))
    return rows.groupBy(F.col(node).alias("src"), F.col(f"next_{node}").alias("dst")).agg(
        F.count("*").alias("n"), F.avg(gap).alias("avg_gap_s"), F.min(gap).alias("min_gap_s"), F.max(gap).alias("max_gap_s"))


def chain_matches(events: DataFrame, first: Column, second: Column, within_seconds: float,
                  keys: Sequence[str] = ("session_id",), *, run_rows: int = RUN_ROWS) -> DataFrame:
    """``second`` calls preceded by a ``first`` call of the session within the
    time, each with the latest such ``first``."""
    rows = with_latest(events.filter(first | second), keys, first, ["event_id", "ts"], run_rows=run_rows)
    gap = seconds_between(F.col("ts"), F.col("last_ts"))
    return rows.filter(second & (gap <= within_seconds)).withColumn("gap_s", gap)


def _runs(events: DataFrame, keys: Sequence[str], failed: Column, run_rows: int) -> DataFrame:
    """Adds ``_streak``: number of non-failures up to each row, constant in a streak."""
    return with_running_total(events, keys, F.when(failed, F.lit(0)).otherwise(F.lit(1)), "_streak", run_rows=run_rows)


def repeated_failures(events: DataFrame, n: int, keys: Sequence[str] = ("session_id", "handler_name"),
                      failed: Column | None = None, *, run_rows: int = RUN_ROWS) -> DataFrame:
    """Streaks of at least ``n`` failures in a row per key."""
    failed = F.col("status") == "error" if failed is None else failed
    narrow = events.select(*dict.fromkeys([*keys, "event_id", "ts"]), failed.alias("_failed"))
    rows = _runs(narrow, keys, F.col("_failed"), run_rows).filter("_failed")
    streaks = rows.groupBy(*keys, "_streak").agg(
        F.count("*").alias("failures"), F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"))
    return streaks.filter(F.col("failures") >= n).drop("_streak")


def call_loops(events: DataFrame, n: int, within: str, keys: Sequence[str] = ("session_id", "handler_name", "args_hash")
               ) -> DataFrame:
    """The same call at least ``n`` times in one time window."""
    return events.groupBy(F.window("ts", within).alias("w"), *keys).agg(F.count("*").alias("calls")).filter(
        F.col("calls") >= n).select(F.col("w.start").alias("window_start"), *keys, "calls")


def sessionize(events: DataFrame, gap_seconds: float, keys: Sequence[str] = ("user_id",), *,
               run_rows: int = RUN_ROWS) -> DataFrame:
    """Adds ``session_no`` (from 1) per key: a new session after a quiet gap."""
    gap = F.make_dt_interval(secs=F.lit(gap_seconds))
    return with_group_number(events, keys, gap, "session_no", run_rows=run_rows)


# --- use --------------------------------------------------------------------


def token_consumption(events: DataFrame, window: str, dims: Sequence[str] = ("provider", "model", "user_id"), *,
                      tokens: str = "tokens_total") -> DataFrame:
    """Calls and tokens per time window and every prefix of ``dims``, with grand
    totals. Counted at the finest grain first; the roll-up runs on the counts."""
    fine = events.groupBy(F.window("ts", window).start.alias("window_start"), *dims).agg(
        F.count("*").alias("_n"), F.sum(tokens).alias("_t"))
    level = F.grouping_id().alias("level")
    return fine.rollup("window_start", *dims).agg(
        level, F.sum("_n").alias("calls"), F.sum("_t").alias("tokens"))


def token_spikes(events: DataFrame, window: str, trailing: int, factor: float,
                 keys: Sequence[str] = ("provider", "model"), *, tokens: str = "tokens_total") -> DataFrame:
    """Windows whose tokens exceed ``factor`` times the mean of the ``trailing``
    windows before. Windows without calls do not count as zero."""
    used = events.groupBy(*keys, F.window("ts", window).start.alias("window_start")).agg(F.sum(tokens).alias("tokens"))
    before = Window.partitionBy(*keys).orderBy("window_start").rowsBetween(-trailing, -1)
    return used.withColumn("trailing_mean", F.avg("tokens").over(before)).filter(
        F.col("tokens") > F.lit(factor) * F.col("trailing_mean"))


def user_activity_baseline(events: DataFrame, user: str = "user_id") -> DataFrame:
    """Daily calls per user with mean, deviation and z-score over the user's days."""
    daily = events.groupBy(user, F.to_date("ts").alias("day")).agg(F.count("*").alias("calls"))
    days = Window.partitionBy(user)
    mean, spread = F.avg("calls").over(days), F.stddev_pop("calls").over(days)
    return daily.withColumns({"mean_calls": mean, "stddev_calls": spread}).withColumn(
        "z_score", F.when(F.col("stddev_calls") > 0, (F.col("calls") - F.col("mean_calls")) / F.col("stddev_calls")))


#: Ranks up to which Spark keeps only the first rows of each task.
SMALL_RANK = 1000


def top_consumers(events: DataFrame, k: int, consumer: str = "user_id", by: Sequence[str] = (), *,
                  tokens: str = "tokens_total", run_rows: int = RUN_ROWS) -> DataFrame:
    """The ``k`` consumers with most tokens, overall or per group; ties by name. For more than
    SMALL_RANK of a group the last one is looked for first (see ``selection``): only those taken are ranked."""
    used = events.groupBy(*by, consumer).agg(
        F.count("*").alias("calls"),
        F.count_if(F.col("status") == "error").alias("errors"),
        F.sum(tokens).alias("tokens"),
    )
    order = [F.col("tokens").desc(), F.col(consumer)]
    if not by:
        return used.orderBy(*order).limit(k)
    if k > SMALL_RANK:
        taken = first_of_each(used, k, by, [F.col("tokens").isNull(), -F.col("tokens"), F.col(consumer)], run_rows=run_rows)
        return taken.withColumn("rank", F.row_number().over(Window.partitionBy(*by).orderBy(*order)))
    # Spark limits each task to k rows per group before the shuffle.
    ranked = used.withColumn("rank", F.row_number().over(Window.partitionBy(*by).orderBy(*order)))
    return ranked.filter(F.col("rank") <= k)


# --- model calls and tool calls ---------------------------------------------


def correlate_llm_mcp(events: DataFrame, key: str, within_seconds: float, *,
                      run_rows: int = RUN_ROWS) -> DataFrame:
    """Each tool call with the model call that most recently came before it for
    the same correlator within the time. Unknown and redacted correlators never
    match (all of them are equal). Trace ids do not connect the two kinds."""
    usable = events.filter(F.col("kind").isin("llm", "mcp") & F.col(key).isNotNull() & (F.col(key) != REDACTED))
    usable = _columns(usable, key, "event_id", "ts", "kind", "model", "mcp_server", "handler_name")
    rows = with_latest(usable, [key], F.col("kind") == "llm", ["event_id", "ts", "model"], prefix="llm_", run_rows=run_rows)
    lag = seconds_between(F.col("ts"), F.col("llm_ts"))
    return rows.filter((F.col("kind") == "mcp") & (lag <= within_seconds)).select(
        F.col(key), F.col("event_id").alias("mcp_event_id"), F.col("ts").alias("mcp_ts"), "mcp_server", "handler_name",
        "llm_event_id", "llm_ts", F.col("llm_model").alias("model"), lag.alias("lag_s"))


def requested_tools(body: Column) -> Column:
    """Names of the tools a model's answer asks for, repeats included."""
    output = F.try_variant_get(body, "$.output", "array<variant>")

    def tools(message: Column) -> Column:
        calls = F.try_variant_get(message, "$.tool_calls", "array<variant>")
        return F.coalesce(F.transform(calls, lambda c: F.try_variant_get(c, "$.name", "string")),
                          F.array().cast("array<string>"))

    return F.flatten(F.transform(output, tools))


def requested_vs_observed(events: DataFrame, key: str, body: str = "body") -> DataFrame:
    """Tool calls models asked for against those servers saw, per correlator and
    tool. One pass and one shuffle, counted before it; the result is that of a
    full outer join of the two counts."""
    nothing = F.array().cast("array<string>")
    asked = F.coalesce(F.when(F.col("kind") == "llm", requested_tools(F.col(body))), nothing)
    seen = F.when(F.col("method") == "mcp_tool_call", F.array("handler_name")).otherwise(nothing)

    def marked(tools: Column, requested: bool) -> Column:
        return F.transform(tools, lambda t: F.struct(t.alias("tool"), F.lit(requested).alias("_requested")))

    known = events.filter(F.col(key).isNotNull() & (F.col(key) != REDACTED))
    filled = known.select(key, F.inline(F.concat(marked(asked, True), marked(seen, False)))).groupBy(key, "tool").agg(
        F.count_if("_requested").alias("requested"), F.count_if(~F.col("_requested")).alias("observed"))
    verdict = (
        F.when(F.col("observed") == 0, "requested_only")
        .when(F.col("requested") == 0, "observed_only")
        .when(F.col("requested") == F.col("observed"), "equal")
        .otherwise("differs")
    )
    return filled.withColumn("verdict", verdict)
