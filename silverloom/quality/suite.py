"""Many checks on one table: row checks share one scan, thresholds give the verdict."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import checks


@dataclass(frozen=True)
class Check:
    """One check. ``error_if`` and ``warn_if`` are conditions on ``failures``."""

    name: str
    violation: Column | None = None  # a row check: true marks a bad row
    rows: Callable[[DataFrame], DataFrame] | None = None  # any other check
    where: Column | str | None = None
    severity: str = "error"
    error_if: str = "failures <> 0"
    warn_if: str = "failures <> 0"
    fail_calc: Column | None = field(default=None)


def failures_of_equality() -> Column:
    """Rows plus the imbalance of the two sides."""
    signed = F.when(F.col("which_diff") == "a_minus_b", 1).otherwise(-1)
    return F.count(F.lit(1)) + F.coalesce(F.abs(F.sum(signed)), F.lit(0))


def failures_of_rowcount() -> Column:
    return F.sum(F.coalesce("diff_count", F.lit(0)))


def failures_of_fewer_rows() -> Column:
    return F.sum(F.coalesce("row_count_delta", F.lit(0)))


def not_null(column: str, **options) -> Check:
    return Check(f"not_null_{column}", violation=F.col(column).isNull(), **options)


def in_range(column: str, low=None, high=None, inclusive: bool = True, **options) -> Check:
    bad = checks._outside(F.col(column), low, high, inclusive)
    return Check(f"accepted_range_{column}", violation=bad, **options)


def is_true(name: str, expression: str, **options) -> Check:
    return Check(name, violation=~F.expr(expression), **options)


def filled_text(column: str, **options) -> Check:
    return Check(f"not_empty_string_{column}", violation=F.trim(column) == "", **options)


def _condition(where) -> Column:
    if where is None:
        return F.lit(True)
    return F.expr(where) if isinstance(where, str) else where


def run_suite(df: DataFrame, suite: Iterable[Check]) -> DataFrame:
    """``check_name, failures, status`` per check; status is pass, warn or error.

    All row checks are counted in a single aggregate over one scan.
    """
    suite = list(suite)
    single = [c for c in suite if c.violation is not None]
    parts = []
    if single:
        counts = df.agg(
            *[F.count_if(_condition(c.where) & c.violation).alias(f"c{i}") for i, c in enumerate(single)]
        )
        cells = [
            F.struct(F.lit(c.name).alias("check_name"), F.col(f"c{i}").alias("failures"))
            for i, c in enumerate(single)
        ]
        parts.append(counts.select(F.inline(F.array(*cells))))
    for check in suite:
        if check.rows is not None:
            chosen = df if check.where is None else df.where(_condition(check.where))
            calc = F.count(F.lit(1)) if check.fail_calc is None else check.fail_calc
            found = check.rows(chosen).agg(F.coalesce(calc, F.lit(0)).cast("bigint").alias("failures"))
            parts.append(found.select(F.lit(check.name).alias("check_name"), "failures"))
    return reduce(DataFrame.unionAll, parts).withColumn("status", _status(suite))


def _status(suite: list[Check]) -> Column:
    verdict = F.lit("pass")
    for check in suite:
        named = F.col("check_name") == check.name
        warned = F.when(F.expr(check.warn_if), "warn").otherwise("pass")
        judged = warned
        if check.severity == "error":
            judged = F.when(F.expr(check.error_if), "error").otherwise(warned)
        verdict = F.when(named, judged).otherwise(verdict)
    return verdict
