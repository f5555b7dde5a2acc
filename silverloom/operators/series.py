"""Number and date series."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_PARTS = ("second", "minute", "hour", "day", "week", "month", "quarter", "year")


def number_series(spark: SparkSession, upper: int) -> DataFrame:
    """1 .. upper"""
    if upper <= 0:
        raise ValueError("upper bound must be positive")
    return spark.range(1, upper + 1).select(F.col("id").alias("generated_number"))


def periods_between(start: dt.date, end: dt.date, part: str) -> int:
    """Boundaries of ``part`` crossed from start to end."""
    if part not in _PARTS:
        raise ValueError(f"part must be one of {_PARTS}")
    if part in ("year", "quarter", "month"):
        months = (end.year - start.year) * 12 + end.month - start.month
        if part == "month":
            return months
        if part == "year":
            return end.year - start.year
        return (end.year - start.year) * 4 + (end.month - 1) // 3 - (start.month - 1) // 3
    first, last = dt.date(start.year, start.month, start.day), dt.date(end.year, end.month, end.day)
    days = (last - first).days
    if part == "day":
        return days
    if part == "week":  # weeks start on Sunday
        return (days + first.isoweekday() % 7 - last.isoweekday() % 7) // 7
    hours = days * 24 + getattr(end, "hour", 0) - getattr(start, "hour", 0)
    if part == "hour":
        return hours
    minutes = hours * 60 + getattr(end, "minute", 0) - getattr(start, "minute", 0)
    if part == "minute":
        return minutes
    return minutes * 60 + getattr(end, "second", 0) - getattr(start, "second", 0)


def date_spine(spark: SparkSession, part: str, start: dt.date, end: dt.date) -> DataFrame:
    """``date_<part>`` from start on, one row per period, ``end`` excluded."""
    n = periods_between(start, end, part)
    if n <= 0:
        raise ValueError("end must lie after start")
    is_moment = isinstance(start, dt.datetime)
    kind = "timestamp_ntz" if is_moment or part in ("hour", "minute", "second") else "date"
    first = f"cast('{start.isoformat(sep=' ') if is_moment else start.isoformat()}' as timestamp_ntz)"
    added = f"{first} + id * interval '1' second" if part == "second" else f"timestampadd({part.upper()}, cast(id as int), {first})"
    moment = F.expr(added).cast(kind)
    last = F.lit(end.isoformat()).cast(kind)
    return spark.range(n).select(moment.alias(f"date_{part}")).where(F.col(f"date_{part}") <= last)
