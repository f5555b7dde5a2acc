"""Reusable business rules: weighted credit, cost shares, daily rates, status by evidence."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.safe import safe_divide
from .dedupe import deduplicate, top_per_group

# Tenths of the measure for positions 1.., by number of members (5 = five or more).
POSITION_WEIGHTS = {1: [10], 2: [7, 3], 3: [6, 3, 1], 4: [6, 2, 1, 1], 5: [5, 2, 1, 1, 1]}
CREDITED = max(POSITION_WEIGHTS)


def positional_weights(members: DataFrame, container: list[str], order_by: list, weight: str = "w") -> DataFrame:
    """First five members per container with their weight in tenths.

    Only the first five rows per container leave the map side, and counting them gives
    min(members, 5), which is all the weights depend on.
    """
    top = top_per_group(members, container, order_by, CREDITED, "rn")
    counted = top.withColumn("n_top", F.count(F.lit(1)).over(Window.partitionBy(*container)))
    table = F.array(*[F.array(*[F.lit(w) for w in POSITION_WEIGHTS[n]]) for n in sorted(POSITION_WEIGHTS)])
    row = F.element_at(table, F.col("n_top").cast("int"))
    return counted.withColumn(weight, F.try_element_at(row, F.col("rn").cast("int"))).drop("n_top")


def even_share(costs: DataFrame, members: DataFrame, key: str, shares: Mapping[str, str]) -> DataFrame:
    """Costs of a key split evenly over its members, one row per member (``shares``: new name to cost)."""
    sizes = members.groupBy(key).agg(F.count(F.lit(1)).alias("_members"))
    split = {name: safe_divide(cost, "_members") for name, cost in shares.items()}
    return costs.join(sizes, key).withColumns(split).drop("_members").join(members, key)


def daily_rates(rates: DataFrame, date: str = "record_date", rate: str = "exchange_rate") -> DataFrame:
    """One rate per date (the smallest where a date has several)."""
    return rates.groupBy(date).agg(F.min(rate).alias(rate))


def with_rate(
    df: DataFrame, day: Column, rates: DataFrame, date: str = "record_date", rate: str = "exchange_rate"
) -> DataFrame:
    """Rate of the exact day, null where it is missing."""
    by_day = daily_rates(rates, date, rate).select(F.col(date).alias("_rate_day"), rate)
    return df.join(by_day, day == F.col("_rate_day"), "left").drop("_rate_day")


def latest_per(df: DataFrame, entity: list[str], moment: str, *tie: Column) -> DataFrame:
    """Newest row per entity; a null moment counts as newest."""
    return deduplicate(df, entity, [F.col(moment).desc_nulls_first(), *tie])


def with_fallback_key(df: DataFrame, own: str, alternate: str, lookup: DataFrame, found: str) -> DataFrame:
    """Fill a missing ``own`` key from ``lookup`` (alternate, found); rows without any key drop.

    Only rows without a key of their own are joined; the others stay where they are.
    """
    filled, missing = df.where(F.col(own).isNotNull()), df.where(F.col(own).isNull())
    other = lookup.where(F.col(found).isNotNull()).select(F.col(alternate).alias("_alt"), F.col(found).alias("_found"))
    joined = missing.join(other, F.col(alternate) == F.col("_alt")).withColumn(own, F.col("_found"))
    return filled.unionByName(joined.select(*df.columns))


def usage_status(archived: Column, used: Column, last_used: Column, as_of: Column, names, cold_days: int = 30) -> Column:
    """Archived, unused, cold or in use (``names`` in that order)."""
    shelved, unused, cold, active = names
    return (
        F.when(archived, shelved)
        .when(~used | last_used.isNull(), unused)
        .when(last_used < F.date_sub(as_of, cold_days), cold)
        .otherwise(active)
    )


def first_match_links(df: DataFrame, text: str, pattern: str, code: str) -> DataFrame:
    """Rows whose text holds a code, with the first code found."""
    # Made by a generator, which no filter is pushed through: a text is searched once, not again for each use of its code.
    found = F.array_remove(F.array(F.regexp_extract(text, pattern, 1)), "")
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c != code], F.explode(found).alias(code)).where(F.col(code).isNotNull())


def all_match_links(df: DataFrame, text: str, pattern: str, code: str) -> DataFrame:
    """One row per code found in the text."""
    return df.withColumn(code, F.explode(F.regexp_extract_all(text, F.lit(pattern), F.lit(1))))
