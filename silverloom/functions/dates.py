"""Calendar helpers. Anything that depends on today takes ``as_of``."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .keys import as_column


def effective_timestamp(created, updated) -> Column:
    """Later of the two, ignoring nulls: the watermark of a row."""
    return F.greatest(as_column(created), as_column(updated))


def month_label(c) -> Column:
    return F.date_format(as_column(c), "yyyy-MM")


def month_end(year, month) -> Column:
    return F.last_day(F.make_date(as_column(year).cast("int"), as_column(month).cast("int"), F.lit(1)))


def age_days(c, as_of) -> Column:
    today = as_of if isinstance(as_of, Column) else F.lit(as_of)
    return F.datediff(today.cast("date"), as_column(c).cast("date"))


def in_month(c, month: str) -> Column:
    """Half-open range of ``YYYY-MM`` on the bare column, so that it reaches the scan."""
    import datetime as dt

    year, number = (int(p) for p in month.split("-"))
    first = dt.datetime(year, number, 1)
    following = dt.datetime(year + number // 12, number % 12 + 1, 1)
    column = as_column(c)
    return (column >= F.lit(first.isoformat(sep=" ")).cast("timestamp_ntz")) & (
        column < F.lit(following.isoformat(sep=" ")).cast("timestamp_ntz")
    )
