"""Column expressions that need a value more than once, or sums over an array so far."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

_STEP = 64


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which is computed once, also where body uses it inside a loop."""
    return F.transform(F.array(value), body)[0]


def upto(count: Column) -> Column:
    """0, 1, ... count - 1; an empty array for 0."""
    return F.slice(F.sequence(F.lit(0), F.greatest(count, F.lit(1)) - 1), F.lit(1), count)


def _total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0).cast("long"), lambda a, x: a + x)


def sums_before(values: Column) -> Column:
    """For each element of an array of longs the sum of those before it, by sums of blocks."""

    def blocks(v: Column) -> Column:
        return F.transform(upto(F.ceil(F.size(v) / _STEP).cast("int")), lambda b: _total(F.slice(v, b * _STEP + 1, F.lit(_STEP))))

    def within(v: Column, base: Column) -> Column:
        return F.transform(v, lambda x, i: base[(i / _STEP).cast("int")] + _total(F.slice(v, (i / _STEP).cast("int") * _STEP + 1, i % _STEP)))

    return let(
        values,
        lambda v: let(blocks(v), lambda s: let(F.transform(s, lambda x, b: _total(F.slice(s, F.lit(1), b))), lambda base: within(v, base))),
    )
