"""Numeric expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def percent(part: Column, whole: Column) -> Column:
    """100 * part / whole, NULL for an empty whole."""
    return F.try_divide(part * F.lit(100.0), whole.cast("double"))


def ratio_or_null(a: Column, b: Column) -> Column:
    """a / b where b is a positive number, otherwise NULL."""
    return F.when(b > 0, a / b)


def null_outside(c: Column, low: float, high: float) -> Column:
    """Keep values within the inclusive bounds, NULL the others."""
    return F.when(c.between(F.lit(low), F.lit(high)), c)


def null_negative(c: Column) -> Column:
    return F.when(c >= 0, c)


def at_least(c: Column, floor: float) -> Column:
    return F.greatest(c, F.lit(floor))


def clip(c: Column, low: float, high: float) -> Column:
    return F.least(F.greatest(c, F.lit(low)), F.lit(high))


def truncated(c: Column) -> Column:
    """Whole part as a bigint (the cast truncates towards zero)."""
    return c.cast("bigint")


def flag(condition: Column) -> Column:
    """1 where the condition holds, 0 where it is false or NULL."""
    return F.when(condition, F.lit(1)).otherwise(F.lit(0))
