"""Delimited id lists to names."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class IdList:
    """A cell with a delimited id list, and where the names of the ids are."""

    column: str
    lookup: DataFrame
    id_column: str
    name_column: str
    result: str
    separator: str = ","
    joiner: str = ", "


def lists_to_names(df: DataFrame, lists: list[IdList]) -> DataFrame:
    """Add the looked-up names of id list cells, in list order; null when none is known.

    Each distinct combination of cells is split and looked up once, all lists in one join,
    so equal cells (however many) cost one lookup and no group grows beyond the length of
    the cells. Rows whose cells are all null or empty find nothing and are spread by a hash
    of the row instead of meeting under one key.
    """
    cells = [F.coalesce(F.col(f"`{x.column}`"), F.lit("")) for x in lists]
    names = [f"_cell_{i}" for i in range(len(lists))]
    empty = reduce(lambda a, b: a & b, [c == "" for c in cells])
    distinct = df.where(~empty).select(*[c.alias(n) for c, n in zip(cells, names)]).distinct()

    def items(i: int) -> Column:
        parts = F.split(names[i], _literal(lists[i].separator))
        return F.transform(parts, lambda item, at: F.struct(F.lit(i).alias("list"), at.alias("at"), F.trim(item).alias("id")))

    split = [items(i) for i in range(len(lists))]
    ids = distinct.select(*names, F.explode(F.concat(*split)).alias("_item")).select(*names, "_item.list", "_item.at", "_item.id")
    known = [
        x.lookup.select(F.lit(i).alias("_list"), F.col(x.id_column).cast("string").alias("_id"), F.col(x.name_column).alias("_name"))
        for i, x in enumerate(lists)
    ]
    known = reduce(DataFrame.unionAll, known).where(F.col("_name").isNotNull())
    found = ids.join(known, (F.col("id") == F.col("_id")) & (F.col("list") == F.col("_list")))
    per_list = [
        F.array_sort(F.collect_list(F.when(F.col("list") == i, F.struct("at", "_name")))).alias(f"_found_{i}") for i in range(len(lists))
    ]
    joined = found.groupBy(*names).agg(*per_list)
    results = [
        F.when(F.size(f"_found_{i}") > 0, F.array_join(F.col(f"_found_{i}._name"), x.joiner)).alias(x.result) for i, x in enumerate(lists)
    ]
    joined = joined.select(*[F.col(n).alias(f"{n}_") for n in names], F.lit(0).cast("bigint").alias("_spread_"), *results)
    spread = F.when(empty, F.xxhash64(*[F.col("`" + c.replace("`", "``") + "`") for c in df.columns]).bitwiseOR(F.lit(1))).otherwise(0)
    on = reduce(lambda a, b: a & b, [c == F.col(f"{n}_") for c, n in zip(cells, names)]) & (spread == F.col("_spread_"))
    return df.join(joined, on, "left").select(*df.columns, *[x.result for x in lists])


def list_to_names(
    df: DataFrame,
    list_column: str,
    lookup: DataFrame,
    id_column: str,
    name_column: str,
    result: str,
    separator: str = ",",
    joiner: str = ", ",
) -> DataFrame:
    """:func:`lists_to_names` of one cell."""
    return lists_to_names(df, [IdList(list_column, lookup, id_column, name_column, result, separator, joiner)])


def _literal(separator: str) -> str:
    return r"\Q" + separator + r"\E"


def list_items(c: Column, separator: str = ",") -> Column:
    return F.transform(F.split(c, _literal(separator)), lambda x: F.trim(x))
