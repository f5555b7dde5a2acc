"""One row per key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_RANK = "_silverloom_rank"


def deduplicate(df: DataFrame, partition_by: list, order_by: list) -> DataFrame:
    """First row per key in ``order_by`` order; nulls are one key.

    The ``rank = 1`` filter lets Spark keep one row per key on the map side
    (``WindowGroupLimit``), so a hot key never reaches one task whole.
    """
    window = Window.partitionBy(*partition_by).orderBy(*order_by)
    ranked = df.withColumn(_RANK, F.row_number().over(window))
    return ranked.where(F.col(_RANK) == 1).drop(_RANK)


def top_per_group(df: DataFrame, partition_by: list, order_by: list, n: int, rank: str) -> DataFrame:
    """First ``n`` rows per key with their rank; the same map-side limit applies."""
    window = Window.partitionBy(*partition_by).orderBy(*order_by)
    return df.withColumn(rank, F.row_number().over(window).cast("bigint")).where(F.col(rank) <= n)


def deduplicate_twice(
    df: DataFrame, first_key: list, second_key: list, order_by: list, keep_null_second: bool = False
) -> DataFrame:
    """One row per first key, then one row per second key in the same priority order.

    Rows with a null second key collapse into one unless ``keep_null_second``.
    """
    once = deduplicate(df, first_key, order_by)
    if not keep_null_second:
        return deduplicate(once, second_key, order_by)
    filled = _all(second_key, lambda c: c.isNotNull())
    return deduplicate(once.where(filled), second_key, order_by).unionByName(once.where(~filled))


def _all(columns: list, test) -> Column:
    result = F.lit(True)
    for c in columns:
        result = result & test(c if isinstance(c, Column) else F.col(c))
    return result


def mutual_best(df: DataFrame, left: str, right: str) -> DataFrame:
    """Pairs whose right is the smallest of their left and whose left is the smallest of their right.

    Two pre-aggregated minima joined to each other: no per-key sort.
    """
    by_left = df.groupBy(left).agg(F.min(right).alias(right))
    by_right = df.groupBy(right).agg(F.min(left).alias(left))
    other = by_right.select(F.col(left).alias("_left"), F.col(right).alias("_right"))
    same = F.col(left).eqNullSafe(F.col("_left")) & F.col(right).eqNullSafe(F.col("_right"))
    return by_left.join(other, same, "left_semi")
