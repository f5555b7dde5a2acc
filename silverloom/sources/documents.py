"""Dumps of a document index: JSON lines with ``_id`` and ``_source``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _flat(path: str, name: str, data_type: T.DataType) -> list[Column]:
    if isinstance(data_type, T.StructType):
        out = []
        for child in data_type.fields:
            out += _flat(f"{path}.{_quoted(child.name)}", f"{name}.{child.name}", child.dataType)
        return out
    if isinstance(data_type, (T.ArrayType, T.MapType)):
        return [F.to_json(F.col(path)).alias(name)]
    return [F.col(path).alias(name)]


def flatten(df: DataFrame) -> DataFrame:
    """Nested objects to dotted columns, lists to JSON text."""
    columns = []
    for field in df.schema.fields:
        columns += _flat(_quoted(field.name), field.name, field.dataType)
    return df.select(*columns)


def nested_to_json(df: DataFrame) -> DataFrame:
    """Every struct, list or map column as JSON text."""
    nested = (T.StructType, T.ArrayType, T.MapType)
    return df.select(
        *[
            F.to_json(_quoted(f.name)).alias(f.name) if isinstance(f.dataType, nested) else F.col(_quoted(f.name))
            for f in df.schema.fields
        ]
    )


def _documents(dump: DataFrame, date_field: str | None, date_from: str | None) -> DataFrame:
    if date_from:
        moment = F.col(f"_source.{date_field or 'Date'}")
        dump = dump.where(moment >= F.lit(date_from).cast(dump.select(moment).schema[0].dataType))
    return flatten(dump.select("_source.*", F.col("_id").alias("_es_id")))


def read_documents(
    spark: SparkSession, path: str, source_schema: str, date_field: str | None = None, date_from: str | None = None
) -> DataFrame:
    """Flat documents from ``date_from`` on, with their id as ``_es_id``."""
    return _documents(spark.read.schema(f"_id string, _source struct<{source_schema}>").json(path), date_field, date_from)


def stream_documents(
    spark: SparkSession,
    path: str,
    source_schema: str,
    date_field: str | None = None,
    date_from: str | None = None,
    files_per_trigger: int | None = None,
) -> DataFrame:
    """The same of dumps as they arrive in a folder; ``files_per_trigger`` bounds a micro-batch."""
    reader = spark.readStream.schema(f"_id string, _source struct<{source_schema}>")
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(files_per_trigger))
    return _documents(reader.json(path), date_field, date_from)


def read_rates(docs: DataFrame, start: str, as_of: str, currency: str, base: str = "usd") -> DataFrame:
    """``record_date, exchange_rate`` per day from start to as_of; days without a rate are left out.

    ``docs`` holds one JSON text ``{"usd": {"vnd": n, ...}}`` per day in ``doc``, the day in ``day``.
    """
    day = F.col("day").cast("date")
    rate = F.get_json_object("doc", f"$.{base}.{currency}").try_cast("double")
    rates = docs.where((day >= F.lit(start).cast("date")) & (day <= F.lit(as_of).cast("date")))
    rates = rates.select(F.date_format(day, "yyyy-MM-dd").alias("record_date"), rate.alias("exchange_rate"))
    return rates.where(F.col("exchange_rate") != 0)
