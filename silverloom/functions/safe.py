"""Arithmetic that tolerates nulls and zero divisors, and bucketing."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from .keys import as_column


def _zeroed(columns) -> list[Column]:
    if not columns:
        raise ValueError("at least one column is needed")
    return [F.coalesce(as_column(c), F.lit(0)) for c in columns]


def safe_add(*columns) -> Column:
    return reduce(lambda a, b: a + b, _zeroed(columns))


def safe_subtract(*columns) -> Column:
    return reduce(lambda a, b: a - b, _zeroed(columns))


def safe_divide(numerator, denominator) -> Column:
    """null where the divisor is null or zero."""
    bottom = as_column(denominator)
    return as_column(numerator) / F.when(bottom != 0, bottom)


def width_bucket(value, low, high, buckets: int, native: bool = False) -> Column:
    """Equal-width bucket number.

    The default is the portable formula (an edge belongs to the bucket above it when
    the value is a multiple of the bucket width); ``native`` is Spark's own function,
    which differs when ``low`` is no multiple of the width or the value is outside.
    """
    x = as_column(value).cast("double")
    low, high = F.lit(low).cast("double"), F.lit(high).cast("double")
    if native:
        return F.width_bucket(x, low, high, F.lit(buckets).cast("bigint"))
    width = (high - low) / F.lit(buckets)
    exact = "decimal(28,6)"
    on_edge = (x.cast(exact) % width.cast(exact)) == 0
    steps = F.least(F.ceil((x - low) / width), F.lit(buckets + 1).cast("bigint"))
    return F.when(on_edge, 1).otherwise(0) + steps
