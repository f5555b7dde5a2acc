"""Data-quality checks. Each returns the rows that break the rule; none means it holds."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.keys import as_column
from ..functions.text import slug_name
from ..operators.ordered import SPACING, in_order, repeat_rows

_ROWS = "*"


def unique(df: DataFrame, column: str) -> DataFrame:
    """Values that occur more than once, nulls apart."""
    counted = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(_ROWS).alias("n_records"))
    return counted.where("n_records > 1")


def not_null(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column).isNull())


def accepted_values(df: DataFrame, column: str, values) -> DataFrame:
    counted = df.groupBy(F.col(column).alias("value_field")).agg(F.count(_ROWS).alias("n_records"))
    return counted.where(~F.col("value_field").isin(*values))


def not_accepted_values(df: DataFrame, column: str, values) -> DataFrame:
    return df.where(F.col(column).isin(*values)).select(F.col(column).alias("value_field")).distinct()


def orphan_counts(df: DataFrame, column: str, to: DataFrame, field: str, from_where=None, to_where=None) -> DataFrame:
    """Filled keys without a partner and how many rows hold each.

    Keys are counted before the join, so a frequent key crosses the network once per task.
    """
    left = df if from_where is None else df.where(from_where)
    right = to if to_where is None else to.where(to_where)
    filled = left.where(F.col(column).isNotNull())
    ids = filled.groupBy(F.col(column).alias("id")).agg(F.count(_ROWS).alias("n_records"))
    known = right.where(F.col(field).isNotNull()).select(F.col(field).alias("id")).distinct()
    return ids.join(known, "id", "left_anti")


def relationships(df: DataFrame, column: str, to: DataFrame, field: str, from_where=None, to_where=None) -> DataFrame:
    """Filled keys without a partner, one row per offending row."""
    orphans = orphan_counts(df, column, to, field, from_where, to_where)
    return repeat_rows(orphans, F.col("n_records")).drop("n_records")


def accepted_range(df: DataFrame, column, low=None, high=None, inclusive: bool = True) -> DataFrame:
    """Values outside the bounds (literals or columns); null is no violation."""
    return df.where(_outside(as_column(column), low, high, inclusive))


def _outside(value: Column, low, high, inclusive: bool) -> Column:
    bad = F.lit(False)
    if low is not None:
        bad = bad | ~(value >= low if inclusive else value > low)
    if high is not None:
        bad = bad | ~(value <= high if inclusive else value < high)
    return bad


def at_least_one(df: DataFrame, column: str, group_by=()) -> DataFrame:
    """Groups (or the whole table) without any filled value."""
    if not group_by:
        df = df.where(F.col(column).isNotNull()).select(column).limit(1)
    return df.groupBy(*group_by).agg(F.count(column).alias("filled")).where("filled = 0")


def _pair_counts(df: DataFrame, other: DataFrame, left: list[Column], right: list[Column], names: list[str]) -> DataFrame:
    """Count of each row on both sides in one pre-aggregated pass; nulls are equal."""
    a = df.select(*[c.alias(n) for c, n in zip(left, names)], F.lit(1).alias("_a"), F.lit(0).alias("_b"))
    b = other.select(*[c.alias(n) for c, n in zip(right, names)], F.lit(0).alias("_a"), F.lit(1).alias("_b"))
    return a.unionAll(b).groupBy(*names).agg(F.sum("_a").alias("_a"), F.sum("_b").alias("_b"))


def cardinality_equality(df: DataFrame, column: str, to: DataFrame, field: str) -> DataFrame:
    """Values whose count differs between two columns, with the count of either side."""
    counts = _pair_counts(df, to, [F.col(column)], [F.col(field)], [column])
    sides = F.array(F.col("_a"), F.col("_b"))
    differing = counts.where("_a <> _b").select(column, F.explode(sides).alias("num_rows"))
    return differing.where("num_rows > 0")


def _counted(df: DataFrame, group_by, name: str, side: str) -> DataFrame:
    keys = [F.col(c).alias(f"{c}_{side}") for c in group_by]
    return df.groupBy(*keys).agg(F.count(_ROWS).alias(name))


def _count_pairs(df: DataFrame, other: DataFrame, group_by, left: str, right: str) -> DataFrame:
    if not group_by:
        a = df.agg(F.count(_ROWS).alias(left)).withColumn("_one", F.lit(1))
        b = other.agg(F.count(_ROWS).alias(right)).withColumn("_one", F.lit(1))
        return a.join(b, "_one", "full").drop("_one")
    a, b = _counted(df, group_by, left, "a"), _counted(other, group_by, right, "b")
    on = F.lit(True)
    for c in group_by:
        on = on & (F.col(f"{c}_a") == F.col(f"{c}_b"))
    keys = [f"{c}_{side}" for c in group_by for side in ("a", "b")]
    return a.join(b, on, "full").select(*keys, left, right)


def equal_rowcount(df: DataFrame, other: DataFrame, group_by=()) -> DataFrame:
    """Counts per group side by side; the failure is the sum of ``diff_count``."""
    pairs = _count_pairs(df, other, group_by, "count_a", "count_b")
    return pairs.withColumn("diff_count", F.abs(F.col("count_a") - F.col("count_b")))


def fewer_rows_than(df: DataFrame, other: DataFrame, group_by=()) -> DataFrame:
    """Surplus rows per group; equal counts are one failure."""
    pairs = _count_pairs(df, other, group_by, "count_our_model", "count_comparison_model")
    ours, theirs = F.col("count_our_model"), F.col("count_comparison_model")
    delta = F.when(ours > theirs, ours - theirs).when(ours == theirs, 1).otherwise(0)
    return pairs.withColumn("row_count_delta", delta.cast("bigint"))


def equality(
    df: DataFrame, other: DataFrame, compare_columns=(), exclude_columns=(), precision: int | None = None
) -> DataFrame:
    """Distinct rows found on one side only, marked ``a_minus_b`` or ``b_minus_a``."""
    if compare_columns and exclude_columns:
        raise ValueError("give compare_columns or exclude_columns, not both")
    excluded = {c.lower() for c in exclude_columns}
    if compare_columns:
        wanted = {c.lower() for c in compare_columns}
        names = [c for c in df.columns if c.lower() in wanted]
    else:
        names = [c for c in df.columns if c.lower() not in excluded]
        theirs = {c.lower() for c in other.columns} - excluded
        if {c.lower() for c in names} != theirs:
            raise ValueError("the two tables do not have the same columns")

    def value(table: DataFrame, name: str) -> Column:
        column = table[name]
        if precision is not None and isinstance(table.schema[column_name(table, name)].dataType, T.FractionalType):
            return F.round(column.cast("decimal(28,6)"), precision)
        return column

    counts = _pair_counts(df, other, [value(df, n) for n in names], [value(other, n) for n in names], names)
    side = F.when(F.col("_b") == 0, "a_minus_b").when(F.col("_a") == 0, "b_minus_a")
    return counts.select(side.alias("which_diff"), *names).where("which_diff is not null")


def column_name(df: DataFrame, name: str) -> str:
    return next(c for c in df.columns if c.lower() == name.lower())


def expression_is_true(df: DataFrame, expression, column: str | None = None) -> DataFrame:
    """Rows for which the expression is false; unknown passes."""
    if isinstance(expression, str):
        expression = F.expr(expression if column is None else f"`{column}` {expression}")
    return df.where(~expression)


_GAPS = {
    "not_allowed": ("equal_to", lambda a, b: a == b),
    "allowed": ("less_than_or_equal_to", lambda a, b: a <= b),
    "required": ("less_than", lambda a, b: a < b),
}


def mutually_exclusive_ranges(
    df: DataFrame,
    lower: str,
    upper: str,
    partition_by: str | None = None,
    gaps: str = "allowed",
    zero_length_range_allowed: bool = False,
    spacing: int = SPACING,
) -> DataFrame:
    """Ranges that are empty, reversed, or clash with the next range of their group."""
    if gaps not in _GAPS:
        raise ValueError("gaps must be one of " + ", ".join(_GAPS))
    gap_words, gap_holds = _GAPS[gaps]
    length_words = "less_than_or_equal_to" if zero_length_range_allowed else "less_than"
    group = ["partition_by_col"] if partition_by else []
    # Equal ranges are kept once with their number, so that no value is too frequent to sort.
    ranges = df.groupBy(
        *([F.col(partition_by).alias("partition_by_col")] if partition_by else []),
        F.col(lower).alias("lower_bound"),
        F.col(upper).alias("upper_bound"),
    ).agg(F.count(_ROWS).alias("_copies"))
    order = ["lower_bound", "upper_bound"]
    follow = {"next_lower_bound": F.col("lower_bound"), "_next": F.lit(True)}
    low, high, following = F.col("lower_bound"), F.col("upper_bound"), F.col("next_lower_bound")
    length_holds = low <= high if zero_length_range_allowed else low < high
    length_name = f"lower_bound_{length_words}_upper_bound"
    gap_name = f"upper_bound_{gap_words}_next_lower_bound"

    def broken(rows: DataFrame) -> DataFrame:
        judged = rows.withColumns(
            {
                length_name: F.coalesce(length_holds, F.lit(False)),
                gap_name: F.coalesce(gap_holds(high, following), F.col("is_last_record"), F.lit(False)),
            }
        )
        return judged.where(~(F.col(length_name) & F.col(gap_name)))

    placed = in_order(ranges, group, order, after=follow, spacing=spacing)
    final = placed.withColumn("is_last_record", F.col("_next").isNull()).drop("_next", "_copies")
    # All but the last copy of a range are followed by the range itself.
    doubled = ranges.where("_copies > 1").withColumns({"next_lower_bound": low, "is_last_record": F.lit(False)})
    copies = repeat_rows(broken(doubled), F.col("_copies") - 1).drop("_copies")
    return broken(final).unionByName(copies)


def not_constant(df: DataFrame, column: str, group_by=()) -> DataFrame:
    """Groups whose column has exactly one value (min and max agree: no distinct shuffle)."""
    ends = df.groupBy(*group_by).agg(F.min(column).alias("_low"), F.max(column).alias("_high"))
    return ends.where("_low = _high").select(*group_by, F.lit(1).cast("bigint").alias("filler_column"))


def not_empty_string(df: DataFrame, column: str, trim_whitespace: bool = True) -> DataFrame:
    value = F.trim(column) if trim_whitespace else F.col(column)
    return df.select(value.alias(column)).where(F.col(column) == "")


def not_null_proportion(df: DataFrame, column: str, at_least: float, at_most: float = 1.0, group_by=()) -> DataFrame:
    share = F.count(column).cast("double") / F.nullif(F.count(_ROWS), F.lit(0))
    shares = df.groupBy(*group_by).agg(share.alias("not_null_proportion"))
    return shares.where((F.col("not_null_proportion") < at_least) | (F.col("not_null_proportion") > at_most))


def recency(
    df: DataFrame,
    field: str,
    part: str,
    interval: int,
    as_of: dt.datetime,
    ignore_time: bool = False,
    group_by=(),
) -> DataFrame:
    """Groups whose newest value is older than ``as_of`` minus the interval, or missing."""
    moment = f"timestampadd({part.upper()}, {-int(interval)}, cast('{as_of.isoformat(sep=' ')}' as timestamp_ntz))"
    threshold, newest = F.expr(moment), F.max(field).cast("timestamp_ntz")
    if ignore_time:
        threshold, newest = threshold.cast("date"), newest.cast("date")
    found = df.groupBy(*group_by).agg(newest.alias("most_recent")).withColumn("threshold", threshold)
    return found.where((F.col("most_recent") < F.col("threshold")) | F.col("most_recent").isNull())


def sequential_values(
    df: DataFrame, column: str, interval: int = 1, part: str | None = None, group_by=(), spacing: int = SPACING
) -> DataFrame:
    """Values that do not follow their predecessor by the interval; the first one passes."""
    previous = f"previous_{slug_name(column)}"
    # Equal values are kept once with their number, so that no value is too frequent to sort.
    values = df.where(F.col(column).isNotNull()).groupBy(*group_by, column).agg(F.count(_ROWS).alias("_copies"))
    ranked = in_order(values, list(group_by), [column], before={previous: F.col(column)}, spacing=spacing)
    if part:
        expected = F.expr(f"timestampadd({part.upper()}, {int(interval)}, cast(`{previous}` as timestamp_ntz))")
        off = F.col(column).cast("timestamp_ntz") != expected
    else:
        off = F.col(column) != F.col(previous) + F.lit(interval)
    first = ranked.where(off).drop("_copies")
    # All but the first copy of a value follow the value itself.
    doubled = values.where("_copies > 1").withColumn(previous, F.col(column)).where(off)
    return first.unionByName(repeat_rows(doubled, F.col("_copies") - 1).drop("_copies"))


def unique_combination_of_columns(df: DataFrame, columns) -> DataFrame:
    """Combinations that occur more than once; nulls are equal."""
    return df.groupBy(*columns).agg(F.count(_ROWS).alias("_n")).where("_n > 1").drop("_n")


def columns_match_set(tables: dict[str, DataFrame], columns, upper: bool = True) -> DataFrame:
    """Columns that a table lacks or has in excess, per table; names compared in one case.

    ``n_rows`` is how many rows that concerns: all of a table that lacks a column, those
    with a value in an excess one. A table is scanned once, if it differs.
    """

    def fold(name: str) -> str:
        return name.upper() if upper else name.lower()

    expected = {fold(c) for c in columns}
    parts = []
    for table, df in tables.items():
        excess = [c for c in df.columns if fold(c) not in expected]
        lacking = sorted(expected - {fold(c) for c in df.columns})
        if not excess and not lacking:
            continue
        counts = df.agg(F.count(_ROWS).alias("_rows"), *[F.count(f"`{c}`").alias(f"_{i}") for i, c in enumerate(excess)])
        found = [(None, c, F.col("_rows")) for c in lacking] + [(fold(c), None, F.col(f"_{i}")) for i, c in enumerate(excess)]
        cells = [
            F.struct(
                F.lit(table).alias("relation"),
                F.lit(own).cast("string").alias("relation_column"),
                F.lit(wanted).cast("string").alias("input_column"),
                n.alias("n_rows"),
            )
            for own, wanted, n in found
        ]
        parts.append(counts.select(F.inline(F.array(*cells))))
    if not parts:
        spark = next(iter(tables.values())).sparkSession
        return spark.createDataFrame([], "relation string, relation_column string, input_column string, n_rows bigint")
    return reduce(DataFrame.unionAll, parts)


def assert_equal(df: DataFrame, actual: str, expected: str) -> DataFrame:
    """Rows where two columns differ; a null on either side passes."""
    return df.where(F.col(actual) != F.col(expected))
