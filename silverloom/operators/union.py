"""Union of tables whose columns differ, and lookup of table families by name."""

from __future__ import annotations

import re
from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sinks.files import plain_path
from .reshape import _named


def union_relations(
    relations: Mapping[str, DataFrame],
    column_override: Mapping[str, str] | None = None,
    include=(),
    exclude=(),
    source_column: str | None = "_source_relation",
    where=None,
    labels: Mapping[str, Column] | None = None,
    hidden=(),
) -> DataFrame:
    """Rows of all relations over their columns in first-seen order, missing ones null.

    ``labels`` has the source column's value for relations that hold rows of several sources;
    columns that only it needs are ``hidden``.
    """
    if include and exclude:
        raise ValueError("give include or exclude, not both")
    included, excluded = {c.lower() for c in include}, {c.lower() for c in exclude}
    override = column_override or {}

    def wanted(name: str) -> bool:
        return name not in hidden and name.lower() not in excluded and (not included or name.lower() in included)

    types: dict[str, str] = {}
    for df in relations.values():
        for field in df.schema.fields:
            if wanted(field.name):
                types.setdefault(field.name, field.dataType.simpleString())
    if not types:
        raise ValueError("no column is left to union for " + ", ".join(relations))

    parts = []
    for name, df in relations.items():
        chosen = df if where is None else df.where(where)
        label = (labels or {}).get(name, F.lit(name))
        columns = [label.alias(source_column)] if source_column else []
        for column, data_type in types.items():
            value = _named(column) if column in df.columns else F.lit(None)
            columns.append(value.cast(override.get(column, data_type)).alias(column))
        parts.append(chosen.select(*columns))
    return reduce(DataFrame.unionAll, parts)


def _like(pattern: str) -> re.Pattern:
    text = "".join(".*" if ch == "%" else "." if ch == "_" else re.escape(ch) for ch in pattern)
    return re.compile(text, re.IGNORECASE | re.DOTALL)


def tables_by_pattern(
    spark: SparkSession, schema_pattern: str, table_pattern: str, exclude: str = ""
) -> list[str]:
    """Catalogue tables and views whose schema and name match LIKE patterns, any case."""
    schemas, tables, unwanted = _like(schema_pattern), _like(table_pattern), _like(exclude)
    found = set()
    for database in spark.catalog.listDatabases():
        for table in spark.catalog.listTables(database.name):
            schema = (table.namespace or [""])[0]
            if (schema and not schemas.fullmatch(schema)) or (not schema and schema_pattern != "%"):
                continue
            if tables.fullmatch(table.name) and not unwanted.fullmatch(table.name):
                found.add(f"{schema}.{table.name}" if schema else table.name)
    return sorted(found)


def tables_by_prefix(spark: SparkSession, schema_pattern: str, prefix: str, exclude: str = "") -> list[str]:
    return tables_by_pattern(spark, schema_pattern, prefix + "%", exclude)


def _stored_as(spark: SparkSession, name: str) -> tuple[str, str] | None:
    """(format, folder) of a table that is a plain folder of files; None for views and partitioned tables."""
    quoted = ".".join("`" + p.replace("`", "``") + "`" for p in name.split("."))
    rows = spark.sql(f"describe table extended {quoted}").collect()
    heads = [i for i, r in enumerate(rows) if r["col_name"].startswith("# Detailed Table Information")]
    if not heads or any(r["col_name"].startswith("# Partition") for r in rows):
        return None
    facts = {r["col_name"]: r["data_type"] for r in rows[heads[0] :]}
    if facts.get("Type") not in ("MANAGED", "EXTERNAL") or facts.get("Provider", "").lower() not in ("parquet", "orc", "json"):
        return None
    return facts["Provider"].lower(), facts["Location"]


def union_tables(spark: SparkSession, names, source_column: str | None = "_source_relation", **options) -> DataFrame:
    """``union_relations`` of catalogue tables, each row with its table's name.

    Tables that are folders of files of one format and schema are one scan of all their
    folders; the name comes from the file a row is read from, by a table of a row per name.
    """
    alike: dict[tuple, list[tuple[str, str]]] = {}
    for name in names:
        found = _stored_as(spark, name)
        schema = spark.table(name).schema
        alike.setdefault((*found, schema.json())[::2] if found else (name,), []).append((name, found[1] if found else ""))
    relations, labels = {}, {}
    for key, some in alike.items():
        first = some[0][0]
        if len(some) == 1:
            relations[first] = spark.table(first)
            continue
        scan = spark.read.format(key[0]).schema(spark.table(first).schema).load([folder for _, folder in some])
        folder = F.regexp_extract(plain_path(F.col("_metadata.file_path")), "^(.*)/[^/]*$", 1)
        known = spark.createDataFrame(some, "_sl_name string, _sl_at string").withColumn("_sl_at", F.regexp_replace("_sl_at", "^([A-Za-z0-9]+):/+", "$1:/"))
        # A row for each of the names that were given.
        relations[first] = scan.withColumn("_sl_folder", folder).join(F.broadcast(known), F.col("_sl_folder") == F.col("_sl_at"))
        labels[first] = F.col("_sl_name")
    hidden = ("_sl_folder", "_sl_name", "_sl_at")
    return union_relations(relations, source_column=source_column, labels=labels, hidden=hidden, **options)
