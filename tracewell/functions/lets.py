"""Small building blocks for larger column expressions."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once however often it is used."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def fence(value: Column) -> Column:
    """``value``, in a form the optimizer does not copy into filters above it.

    Filters are pushed through projections by substituting what they refer to;
    where that is a costly chain it would be computed again, many times over.
    """
    return F.when(F.spark_partition_id() >= 0, value)


def any_of(conditions: Iterable[Column]) -> Column:
    result = F.lit(False)
    for condition in conditions:
        result = result | condition
    return result


def cut(value: Column, limit: int, mark: str) -> Column:
    """``value`` when it has at most ``limit`` characters, else prefix + ``mark``."""
    return F.when(F.length(value) > limit, F.concat(F.left(value, F.lit(limit)), F.lit(mark))).otherwise(
        value
    )
