"""Parts of a URL, also for text without a scheme."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .keys import as_column


def _without(c: Column, *prefixes: str) -> Column:
    for prefix in prefixes:
        c = F.replace(c, F.lit(prefix), F.lit(""))
    return c


def _part(c: Column, sign: str, n: int) -> Column:
    return F.split_part(c, F.lit(sign), F.lit(n))


def url_host(c) -> Column:
    bare = _without(as_column(c), "android-app://", "http://", "https://")
    return _part(_part(bare, "/", 1), "?", 1)


def url_path(c) -> Column:
    """Text after the first ``/`` up to ``?``, without a leading slash."""
    bare = _without(as_column(c), "http://", "https://")
    slash = F.instr(bare, "/")
    skip = F.when(slash > 0, slash).otherwise(F.instr(bare, "?") - 1)
    return _part(F.substr(bare, skip + 1), "?", 1)


def url_parameter(c, name: str) -> Column:
    """Text between ``name=`` and the next ``&``; null when empty or absent."""
    return F.nullif(_part(_part(as_column(c), f"{name}=", 2), "&", 1), F.lit(""))
