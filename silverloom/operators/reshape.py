"""Columns to rows, rows to columns, and column selections."""

from __future__ import annotations

import operator
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.keys import as_column
from ..functions.text import slug_name

_COMPARE = {
    "=": operator.eq, "!=": operator.ne, "<>": operator.ne,
    "<": operator.lt, "<=": operator.le, ">": operator.gt, ">=": operator.ge,
}
_AGGREGATES = {
    "sum": (F.sum, F.sum_distinct),
    "count": (F.count, F.count_distinct),
    "min": (F.min, F.min),
    "max": (F.max, F.max),
    "avg": (F.avg, lambda c: F.sum_distinct(c) / F.count_distinct(c)),
}


def _named(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def filtered_columns(df: DataFrame, drop=()) -> list[str]:
    dropped = {name.lower() for name in drop}
    return [c for c in df.columns if c.lower() not in dropped]


def star(df: DataFrame, drop=(), prefix: str = "", suffix: str = "", rename=None, alias: str | None = None):
    """Columns of ``df`` but ``drop``; a rename (any case) beats prefix and suffix."""
    renamed = {k.lower(): v for k, v in (rename or {}).items()}
    out = []
    for c in filtered_columns(df, drop):
        column = F.col(f"{alias}.`{c}`") if alias else _named(c)
        out.append(column.alias(renamed.get(c.lower(), f"{prefix}{c}{suffix}")))
    return out


def unpivot(
    df: DataFrame,
    keep=(),
    remove=(),
    cast_to: str = "string",
    field_name: str = "field_name",
    value_name: str = "value",
) -> DataFrame:
    """One row per kept key and remaining column, nulls included, in a single scan."""
    kept = {c.lower() for c in keep}
    values = [c for c in filtered_columns(df, remove) if c.lower() not in kept]
    ids = [c for c in df.columns if c.lower() in kept]
    cast = df.select(*[_named(c) for c in ids], *[_named(c).cast(cast_to).alias(c) for c in values])
    return cast.unpivot([_named(c) for c in ids], [_named(c) for c in values], field_name, value_name)


def _aggregate(agg) -> tuple:
    """An aggregate and its form over distinct values, where there is one."""
    if callable(agg):
        return agg, agg
    return _AGGREGATES.get(agg.lower(), (lambda c: F.call_function(agg, c), None))


def pivot_columns(
    column,
    values,
    agg: str | Callable[[Column], Column] = "sum",
    cmp: str = "=",
    prefix: str = "",
    suffix: str = "",
    then_value=1,
    else_value=0,
    quote: bool = True,
    distinct: bool = False,
    alias: bool = True,
) -> list[Column]:
    """One aggregate per value, to be used in a single ``groupBy(...).agg(*...)``.

    ``agg`` is the name of any aggregate function of one column, or a function from Column to
    Column. ``quote`` keeps the value as the column name; otherwise its slug is the name.
    """
    plain, unique = _aggregate(agg)
    if distinct and unique is None:
        raise ValueError(f"give {agg!r} over distinct values as a function")
    compare, tested = _COMPARE[cmp], as_column(column)

    def item(v):
        return v if isinstance(v, Column) else F.lit(v)

    out = []
    for value in values:
        cell = F.when(compare(tested, F.lit(value)), item(then_value)).otherwise(item(else_value))
        made = (unique if distinct else plain)(cell)
        name = f"{prefix}{value}{suffix}"
        out.append(made.alias(name if quote else slug_name(name)) if alias else made)
    return out


def column_values(
    df: DataFrame, column: str, max_records: int, order_by=None, default=None, where=None
) -> list:
    """Distinct values, most frequent first (ties by value); ``default`` when there is none.

    The list is meant to become columns or literals, so it is brought to the driver, and
    ``max_records`` says how many values that may be. :func:`column_frequencies` is the
    same as a DataFrame, without a bound.
    """
    rows = column_frequencies(df, column, order_by, max_records, where).select("value").collect()
    return [r["value"] for r in rows] if rows else default


def every_column_value(df: DataFrame, column: str, max_records: int, **options) -> list:
    """:func:`column_values` where all are needed: an error when there are more than ``max_records``."""
    values = column_values(df, column, max_records + 1, **options)
    if values is not None and len(values) > max_records:
        raise ValueError(f"{column} has more than {max_records} values")
    return values


def table_column_values(spark: SparkSession, table: str, column: str, max_records: int, default=None, **options) -> list:
    """:func:`column_values` of a catalogue table; ``default`` when there is no such table."""
    if spark.catalog.tableExists(table):
        return column_values(spark.table(table), column, max_records, default=default, **options)
    if default is None:
        raise LookupError(f"table {table} does not exist and there is no default")
    return default


def column_frequencies(df: DataFrame, column: str, order_by=None, max_records=None, where=None) -> DataFrame:
    chosen = df if where is None else df.where(where)
    counted = chosen.groupBy(F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("n"))
    counted = counted.orderBy(*(order_by or [F.desc("n"), F.asc("value")]))
    return counted if max_records is None else counted.limit(max_records)


def blank_strings_to_null(df: DataFrame, columns=None) -> DataFrame:
    """``''`` to null in every string column (or the given ones)."""
    wanted = None if columns is None else {c.lower() for c in columns}
    out = []
    for field in df.schema.fields:
        column = _named(field.name)
        if isinstance(field.dataType, T.StringType) and (wanted is None or field.name.lower() in wanted):
            column = F.nullif(column, F.lit("")).alias(field.name)
        out.append(column)
    return df.select(*out)


def single_value(df: DataFrame, default=None):
    """First cell of the first row, or ``default`` when there is no row."""
    row = df.first()
    return default if row is None else row[0]
