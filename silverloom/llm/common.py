"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import io
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import AtomicType, StructType

from ..session import scratch_dir
from ..sinks.files import write_bytes

# Fixed value: white space of the text contracts, as a Java character class body.
SPACES = r"\x20\x09-\x0D"
FOLDS = 5


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give this package to the Python workers of an application, wherever they run and start from."""
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    top = Path(__file__).resolve().parents[1]
    packed = io.BytesIO()
    with zipfile.ZipFile(packed, "w", zipfile.ZIP_DEFLATED) as archive:
        for file in sorted(top.rglob("*.py")):
            archive.write(file, file.relative_to(top.parent))
    path = f"{scratch_dir(spark, 'code')}/{top.name}.zip"
    write_bytes(spark, path, packed.getvalue())
    context.addPyFile(path)
    _SHIPPED.add(context.applicationId)


def in_tasks(df: DataFrame, run: Callable, schema: StructType) -> DataFrame:
    """``df.mapInArrow`` with this package at hand in the workers."""
    ship(df.sparkSession)
    return df.mapInArrow(run, schema)


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once below the shared folder and read it back: later steps start there."""
    path = scratch_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def held_out(doc_id: Column) -> Column:
    """True for the fold that no model learns from (crc32 of the id as text, modulo 5, is 0).

    A missing id counts as held out.
    """
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == 0, F.lit(True))


def chosen(doc_id: Column, rows: int, bound: int) -> Column:
    """Keep about ``bound`` of ``rows`` rows, by a hash of the id (all where there are fewer)."""
    if rows <= bound:
        return F.lit(True)
    return F.pmod(F.xxhash64(doc_id, F.lit("sample")), F.lit(1 << 30)) < int((1 << 30) * (bound / rows))


def row_order(df: DataFrame, *first: str) -> list[Column]:
    """A total order of rows: ``first``, then every other column of a type that can be ordered."""
    rest = [f.name for f in df.schema.fields if f.name not in first and isinstance(f.dataType, AtomicType)]
    return [F.col(f"`{c}`") for c in (*first, *rest)]


def map_rows(df: DataFrame, columns: Callable[[pa.RecordBatch], list], schema: StructType) -> DataFrame:
    """Apply ``columns`` (a batch to the lists of the output's columns) to Arrow batches."""
    from pyspark.sql.pandas.types import to_arrow_schema

    target = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = columns(batch)
            yield pa.RecordBatch.from_arrays(
                [x if isinstance(x, pa.Array) else pa.array(x, f.type) for x, f in zip(made, target)], schema=target
            )

    return in_tasks(df, run, schema)
