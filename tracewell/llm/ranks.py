"""Places of rows in a global order, without one task that sees all rows.

Rows are dealt out by ranges of the order and numbered inside their range; what lies
before a range is a running sum over a table with a row for each range (and group).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tracewell.llm.shared import spread, written

#: Rows of a range, about.
RANGE_ROWS = 100_000


def placed(df: DataFrame, order: Sequence[Column], group: str | None = None) -> DataFrame:
    """``df`` with ``pos`` (long, from 0) in the given order and ``total``, the number of
    rows; with ``group`` (a column, without nulls) both within the group.

    Rows that tie in ``order`` get different places, and a tie of any size is dealt out
    over ranges as well. ``df`` is read twice, so it should be a written table of few
    and short columns; its own columns may not be called pos, total, _row, _run, _first or _n.
    """
    n = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), spread(df.count(), RANGE_ROWS))
    by = [F.col(group)] if group else []
    keys = [*by, *order, F.col("_row")]
    ranges = df.withColumn("_row", F.monotonically_increasing_id()).repartitionByRange(n, *keys).sortWithinPartitions(*keys)
    rows = written(ranges.withColumn("_row", F.monotonically_increasing_id()), "placed")
    rows = rows.withColumn("_run", F.shiftright("_row", 33))
    runs = rows.groupBy(*by, "_run").agg(F.min("_row").alias("_first"), F.count("*").alias("_n"))
    whole = Window.partitionBy(*by)
    before = F.sum("_n").over(whole.orderBy("_run").rowsBetween(Window.unboundedPreceding, -1))
    runs = runs.select(*by, "_run", (F.coalesce(before, F.lit(0)) - F.col("_first")).alias("_first"),
                       F.sum("_n").over(whole).alias("total"))
    return rows.join(runs, [*([group] if group else []), "_run"]) \
        .select(*df.columns, (F.col("_row") + F.col("_first")).alias("pos"), "total")
