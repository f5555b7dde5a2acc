"""Hashed row keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the text hashed in place of a null, so that keys equal those already stored.
NULL_MARK = "_dbt_utils_surrogate_key_null_"


def as_column(c) -> Column:
    return c if isinstance(c, Column) else F.col(c)


def surrogate_key(*columns, nulls_as_empty: bool = False) -> Column:
    """md5 over the text of ``columns`` joined by ``-``; null and '' differ by default."""
    mark = F.lit("" if nulls_as_empty else NULL_MARK)
    return F.md5(F.concat_ws("-", *[F.coalesce(as_column(c).cast("string"), mark) for c in columns]))
