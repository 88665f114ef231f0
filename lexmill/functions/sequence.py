"""Expressions over ordered rows."""

from __future__ import annotations

from pyspark.sql import Column, Window
from pyspark.sql import functions as F


def carry_forward(value: Column, partition: str | list[str], order: str) -> Column:
    """The last known value at or before each row."""
    keys = [partition] if isinstance(partition, str) else partition
    return F.last(value, ignorenulls=True).over(Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, 0))


def floored_depth(items: Column, up: str = "(", down: str = ")") -> Column:
    """Running depth over an array of strings, never below 0; a plain running sum would go on from negative depths."""
    count = lambda x, c: F.char_length(x) - F.char_length(F.replace(x, F.lit(c), F.lit("")))
    step = lambda a, x: F.concat(a, F.array(F.greatest(F.coalesce(F.try_element_at(a, F.lit(-1)), F.lit(0)) + count(x, up) - count(x, down), F.lit(0))))
    return F.aggregate(items, F.array().cast("array<int>"), step)
