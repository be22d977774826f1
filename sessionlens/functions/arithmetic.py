"""Small numeric expressions used by several operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def ratio(numerator: Column, denominator: Column) -> Column:
    """`numerator / denominator` as DOUBLE, NULL unless the denominator is positive."""
    return F.when(denominator > 0, numerator.cast("double") / denominator.cast("double"))


def count_when(condition: Column) -> Column:
    """Number of rows that satisfy `condition` (0 when there is none)."""
    return F.count(F.when(condition, F.lit(1)))


def count_or_null(condition: Column) -> Column:
    """Like `count_when`, but NULL instead of 0: the class of rows is absent."""
    return F.nullif(count_when(condition), F.lit(0).cast("bigint"))


def capped(value: Column, upper: float) -> Column:
    return F.least(F.lit(float(upper)), value)


def floored(value: Column, lower: float = 0.0) -> Column:
    return F.greatest(F.lit(float(lower)), value)
