"""Database and catalogue tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dates import in_month
from .spec import SourceSpec

FETCH_ROWS = 50_000  # rows per round trip


def jdbc_options(
    url: str,
    table: str | None = None,
    query: str | None = None,
    partition_column: str | None = None,
    lower=None,
    upper=None,
    partitions: int | None = None,
    fetch_rows: int = FETCH_ROWS,
    **extra,
) -> dict[str, str]:
    """Options of a JDBC read. With a partition column the table is read by parallel ranges."""
    if (table is None) == (query is None):
        raise ValueError("give a table or a query")
    options = {"url": url, "fetchsize": str(fetch_rows), **{k: str(v) for k, v in extra.items()}}
    bounds = (partition_column, lower, upper, partitions)
    if any(b is not None for b in bounds):
        if any(b is None for b in bounds):
            raise ValueError("a partitioned read needs column, lower, upper and partitions")
        # Spark takes no free query together with a partition column, a derived table is fine.
        options["dbtable"] = table or f"({query}) source_query"
        options["partitionColumn"] = partition_column
        options["lowerBound"], options["upperBound"] = str(lower), str(upper)
        options["numPartitions"] = str(partitions)
    elif table:
        options["dbtable"] = table
    else:
        options["query"] = query
    return options


def read_jdbc(spark: SparkSession, **options) -> DataFrame:
    return spark.read.format("jdbc").options(**jdbc_options(**options)).load()


def quoted_table(schema: str, table: str, dialect: str = "ansi") -> str:
    """``schema."table"``, or ``schema.[table]`` where brackets quote names."""
    return f"{schema}.[{table}]" if dialect == "sqlserver" else f'{schema}."{table}"'


def narrow(df: DataFrame, spec: SourceSpec) -> DataFrame:
    """Static filter, computed columns, projection and month range of a spec.

    All of it is plain filter and select on the scan, so it is pushed to the source.
    """
    if spec.where:
        df = df.where(spec.where)
    if spec.computed:
        df = df.withColumns({n: F.expr(e) if isinstance(e, str) else e for n, e in spec.computed.items()})
    if spec.month and spec.watermark_column:
        df = df.where(in_month(spec.watermark_column, spec.month))
    return df.select(*spec.columns, *[n for n in spec.computed if n not in spec.columns]) if spec.columns else df


def newer_than(df: DataFrame, column: str, last) -> DataFrame:
    """Rows after the last watermark (given as text or value)."""
    if last is None:
        return df
    return df.where(F.col(column) > F.lit(last).cast(df.schema[column].dataType))
