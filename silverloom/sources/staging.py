"""Raw rows to staging rows: clean names, JSON text, technical columns."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .documents import nested_to_json
from .grid import unique_names


def clean_names(df: DataFrame) -> DataFrame:
    return df.toDF(*unique_names(df.columns))


def map_fields(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Only the mapped columns, renamed; mapped columns a source lacks are left out."""
    if not mapping:
        return df
    return df.select(*[F.col(f"`{old}`").alias(new) for old, new in mapping.items() if old in df.columns])


def mark_source(df: DataFrame, source_id: str, connection: str | None = None, sheet: str | None = None) -> DataFrame:
    marks = {"_source_id": F.lit(source_id)}
    if connection:
        marks["_source_connection"] = F.lit(connection)
    if sheet:
        marks["_source_sheet"] = F.lit(sheet)
    return df.withColumns(marks)


def stage(df: DataFrame, batch_id: str, loaded_at: dt.datetime) -> DataFrame:
    """Staging form of a landed batch."""
    rows = nested_to_json(clean_names(df))
    at = F.lit(loaded_at.isoformat(sep=" ")).cast("timestamp_ntz")
    return rows.withColumns({"_batch_id": F.lit(batch_id), "_loaded_at": at})
