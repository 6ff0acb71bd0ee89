"""Order-dependent steps over one key's rows that survive a hot key.

A plain ``partitionBy(key)`` window puts every row of a key into one task. Here a key
with more than ``run_rows`` rows is cut, in (time, tie) order, into runs of about that many rows;
the window works per (key, run), and what reaches a run from the ones before it is an
exclusive scan over a summary of each run. Results equal those of the plain window,
whatever the cuts: a key whose rows all carry one time is cut by the tie.

Which keys are cut, and where, is found beforehand from counts and a sample of the large
keys' (key, time, tie); it decides about balance only. Where no key is large, the plan is
the plain window. Otherwise rows are read and shuffled once: summaries and rows are
both taken from the same exchange.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from tracewell.functions.lets import fence, let

#: Rows of a key that one task takes in order.
RUN_ROWS = 1_000_000
#: Runs of large keys at most, so that their bounds fit a broadcast; above, runs grow.
MOST_RUNS = 1 << 16
#: Sampled rows for each bound.
SAMPLES = 32

_RUN = ["_key", "_run"]


def _inside() -> WindowSpec:
    return Window.partitionBy(*_RUN)


def _runs() -> WindowSpec:
    return Window.partitionBy("_key").orderBy("_run")


def _earlier() -> WindowSpec:
    return _runs().rowsBetween(Window.unboundedPreceding, -1)


def place_of(*order: Column) -> Column:
    """What rows of a key are ordered by: nulls come first."""
    return F.struct(*(c.alias(f"p{i}") for i, c in enumerate(order)))


def bounds_of(placed: DataFrame, run_rows: int, key_runs: int = MOST_RUNS) -> DataFrame | None:
    """(_key, _bounds, _width) of the keys of ``placed`` (_key, _place) with more than
    ``run_rows`` rows, null when there are none. ``_bounds`` are places in groups of
    about the square root of their number. Where a key would have more than ``key_runs`` runs,
    runs grow, and keys below their size are left for another time."""
    counts = placed.groupBy("_key").agg(F.count("*").alias("n"))
    total, most = counts.agg(F.sum("n"), F.max("n")).first()
    limit = max(run_rows, math.ceil((total or 0) / MOST_RUNS), math.ceil((most or 0) / key_runs))
    if not most or most <= limit:
        return None
    large = counts.filter(F.col("n") > limit).withColumn("runs", F.ceil(F.col("n") / limit))
    seen = placed.join(F.broadcast(large), "_key").filter(F.rand(7) < SAMPLES * F.col("runs") / F.col("n"))
    sampled = seen.groupBy("_key", "runs").agg(F.array_sort(F.collect_list("_place")).alias("s"))
    picked = F.array_distinct(F.transform(F.sequence(F.lit(1), F.col("runs").cast("int") - 1), lambda i: F.get(
        "s", F.floor(i * F.size("s") / F.col("runs")).cast("int"))))
    sampled = sampled.select("_key", picked.alias("b")).filter("size(b) > 0")
    width = F.ceil(F.sqrt(F.size("b"))).cast("int")
    grouped = F.transform(F.sequence(F.lit(0), F.floor((F.size("b") - 1) / width).cast("int")), lambda g: F.slice("b", g * width + 1, width))
    return local(sampled.select("_key", grouped.alias("_bounds"), width.alias("_width")))


def local(small: DataFrame) -> DataFrame:
    """A table of at most about MOST_RUNS rows, computed now."""
    return small.sparkSession.createDataFrame(small.collect(), small.schema)


def run_of(place: Column) -> Column:
    """How many of the key's bounds are not after ``place``: first among the groups'
    first bounds, then inside the last group that begins before it."""
    def reached(bounds: Column) -> Column:
        return F.size(F.filter(bounds, lambda b: b <= place))

    groups = F.size(F.filter("_bounds", lambda g: F.get(g, F.lit(0)) <= place))
    return let(groups, lambda g: F.when(g > 0, (g - 1) * F.col("_width") + reached(F.get("_bounds", g - 1))).otherwise(0))


class _Timeline:
    """Rows of ``df`` with ``_key`` and ``_run``, and what reaches a run from earlier ones."""

    def __init__(self, df: DataFrame, keys: Sequence[str], ts: str, tie: str, run_rows: int):
        # A struct compares equal to itself even when members are null.
        place = place_of(F.col(ts), F.col(tie))
        bounds = bounds_of(df.select(F.struct(*keys).alias("_key"), place.alias("_place")), run_rows)
        self.columns, self.cut = df.columns, bounds is not None
        rows = df.withColumn("_key", F.struct(*keys))
        if not self.cut:
            self.rows = rows.withColumn("_run", F.lit(0))
            return
        run = F.when(F.col("_bounds").isNull(), F.lit(0)).otherwise(run_of(place))
        marked = rows.join(F.broadcast(bounds), "_key", "left").withColumn("_run", run)
        # One column holds the row, so that both readers of the exchange want the same columns of it.
        row = F.struct(*df.columns, F.col("_bounds").isNotNull().alias("_cut"))
        self._packed = marked.select(*_RUN, fence(row).alias("_row")).repartition(*_RUN)
        whole = self._packed.select(*_RUN, fence(F.col("_row")).alias("_row"))
        self.rows = whole.select(*_RUN, *(F.col("_row")[c].alias(c) for c in self.columns))

    def carry(self, rows: DataFrame, summary: dict[str, Column], scan: Callable[[DataFrame], Column],
              before: Callable[[DataFrame], DataFrame] | None = None) -> tuple[DataFrame, Column | None]:
        """``rows`` with what ``scan`` makes of the runs' summaries. Nothing reaches rows of keys
        that are not cut: their carry is null, and it is None where no key is cut."""
        if not self.cut:
            return rows, None
        own = self._packed.select(*_RUN, "_row", *(F.col("_row")[c].alias(c) for c in [*self.columns, "_cut"]))
        own = before(own) if before else own
        runs = own.groupBy(*_RUN).agg(F.max("_cut").alias("_cut"), F.count("_row").alias("_n"), *(c.alias(n) for n, c in summary.items()))
        runs = runs.filter(F.col("_cut") & (F.col("_n") > 0))
        carried = scan(runs.drop("_cut", "_n"))
        return rows.join(F.broadcast(carried), _RUN, "left"), F.col("_carry")

    def done(self, rows: DataFrame, *out: str) -> DataFrame:
        return rows.select(*self.columns, *out)


def with_previous(df: DataFrame, keys: Sequence[str], cols: Sequence[str], *, ts: str = "ts", tie: str = "event_id",
                  run_rows: int = RUN_ROWS, prefix: str = "prev_") -> DataFrame:
    """``cols`` of the row before, per key, in (ts, tie) order; none -> null."""
    return _with_neighbour(df, keys, cols, ts, tie, run_rows, prefix, after=False)


def with_next(df: DataFrame, keys: Sequence[str], cols: Sequence[str], *, ts: str = "ts", tie: str = "event_id",
              run_rows: int = RUN_ROWS, prefix: str = "next_") -> DataFrame:
    """``cols`` of the row after, per key, in (ts, tie) order; none -> null."""
    return _with_neighbour(df, keys, cols, ts, tie, run_rows, prefix, after=True)


def _with_neighbour(df, keys, cols, ts, tie, run_rows, prefix, after):
    line = _Timeline(df, keys, ts, tie, run_rows)
    packed = F.struct(*[F.col(c).alias(f"v{i}") for i, c in enumerate(cols)])
    place = F.struct(F.col(ts).alias("at"), F.col(tie).alias("tie"))
    inside = _inside().orderBy(ts, tie)
    edge, step = (F.min_by, F.lead) if after else (F.max_by, F.lag)
    rows, carry = line.carry(line.rows.withColumn("_near", step(packed).over(inside)), {"_edge": edge(packed, place)},
                             lambda runs: runs.select(*_RUN, step("_edge").over(_runs()).alias("_carry")))
    near = F.col("_near") if carry is None else F.coalesce("_near", carry)
    rows = rows.withColumn("_near", near)
    named = {f"{prefix}{c}": F.col("_near")[f"v{i}"] for i, c in enumerate(cols)}
    return line.done(rows.withColumns(named), *named)


def with_running_total(df: DataFrame, keys: Sequence[str], value: Column, out: str, *, ts: str = "ts",
                       tie: str = "event_id", run_rows: int = RUN_ROWS) -> DataFrame:
    """Sum of ``value`` over the key's rows up to and including this one."""
    line = _Timeline(df, keys, ts, tie, run_rows)
    inside = _inside().orderBy(ts, tie).rowsBetween(Window.unboundedPreceding, 0)
    rows, carry = line.carry(line.rows.withColumn("_sum", F.sum(value).over(inside)), {"_edge": F.sum(value)},
                             lambda runs: runs.select(*_RUN, F.sum("_edge").over(_earlier()).alias("_carry")))
    # A sum without values is null until the first one.
    total = F.col("_sum") if carry is None else F.when(
        F.col("_sum").isNull(), carry).otherwise(F.col("_sum") + F.coalesce(carry, F.lit(0)))
    return line.done(rows.withColumn(out, total), out)


def with_latest(df: DataFrame, keys: Sequence[str], when: Column, cols: Sequence[str], *, ts: str = "ts",
                tie: str = "event_id", run_rows: int = RUN_ROWS, prefix: str = "last_") -> DataFrame:
    """``cols`` of the key's latest row with ``when`` true and an earlier ``ts``. Rows without
    a time are earlier than all others.

    Rows of one time may lie in several runs. A run's rows that share its first time must not see
    marked rows of that time in the run before; all later ones see every run before.
    """
    line = _Timeline(df, keys, ts, tie, run_rows)
    us = F.coalesce(F.unix_micros(F.col(ts)), F.lit(-(1 << 62)))
    mark = F.when(when, F.struct(us.alias("at"), F.col(tie).alias("tie"), *[F.col(c).alias(f"v{i}") for i, c in enumerate(cols)]))
    earlier = _inside().orderBy(us).rangeBetween(Window.unboundedPreceding, -1)

    def scan(runs: DataFrame) -> DataFrame:
        below = Window.partitionBy("_key").orderBy("_hi").rangeBetween(Window.unboundedPreceding, -1)
        last_time = Window.partitionBy("_key", "_hi")
        runs = runs.withColumns({
            "_all": F.max("_mark").over(_earlier()),
            "_strict": F.greatest(F.max("_mark").over(below), F.max("_low").over(last_time))})
        meets = F.lag("_hi").over(_runs()).eqNullSafe(F.col("_lo"))
        first = F.when(meets, F.lag("_strict").over(_runs())).otherwise(F.col("_all"))
        return runs.select(*_RUN, F.struct("_lo", "_all", first.alias("_first")).alias("_carry"))

    rows, carry = line.carry(
        line.rows.withColumns({"_us": us, "_near": F.max(mark).over(earlier)}),
        {"_lo": F.min(us), "_hi": F.max(us), "_mark": F.max(mark), "_low": F.max(F.when(us < F.col("_end"), mark))},
        scan, lambda own: own.withColumn("_end", F.max(us).over(_inside())))
    near = F.col("_near")
    if carry is not None:
        near = F.coalesce(near, F.when(F.col("_us") > carry["_lo"], carry["_all"]).otherwise(carry["_first"]))
    rows = rows.withColumn("_near", near)
    named = {f"{prefix}{c}": F.col("_near")[f"v{i}"] for i, c in enumerate(cols)}
    return line.done(rows.withColumns(named), *named)


def with_group_number(df: DataFrame, keys: Sequence[str], gap: Column, out: str, *, ts: str = "ts",
                      tie: str = "event_id", run_rows: int = RUN_ROWS) -> DataFrame:
    """Numbers, from 1, the groups of a key's rows between pauses longer than ``gap``
    (an interval). A run's summary holds its ends and its own pauses."""
    line = _Timeline(df, keys, ts, tie, run_rows)
    at = F.col(ts)

    def paused(rows: DataFrame) -> DataFrame:
        inside = _inside().orderBy(ts, tie)
        return rows.withColumn("_pause", F.coalesce((at - F.lag(at).over(inside)) > gap, F.lit(False)).cast("int"))

    def scan(runs: DataFrame) -> DataFrame:
        quiet = F.coalesce((F.col("_lo") - F.lag("_hi").over(_runs())) > gap, F.lit(False)).cast("int")
        runs = runs.withColumn("_opens", quiet)
        begun = F.coalesce(F.sum(F.col("_opens") + F.col("_pauses")).over(_earlier()), F.lit(0))
        return runs.select(*_RUN, (begun + F.col("_opens")).alias("_carry"))

    inside = _inside().orderBy(ts, tie).rowsBetween(Window.unboundedPreceding, 0)
    rows, carry = line.carry(paused(line.rows), {"_lo": F.min(at), "_hi": F.max(at), "_pauses": F.sum("_pause")}, scan, paused)
    number = F.lit(1) + F.sum("_pause").over(inside) + (F.lit(0) if carry is None else F.coalesce(carry, F.lit(0)))
    return line.done(rows.withColumn(out, number), out)
