"""The few file operations that DataFrames lack, on any file system Spark reads."""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F


def _place(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark._jsc.hadoopConfiguration())


def plain_path(path: Column) -> Column:
    """``_metadata.file_path`` as ``data_files`` writes it: not encoded, one slash after the scheme."""
    decoded = F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))
    return F.regexp_replace(decoded, "^([A-Za-z0-9]+):/+", "$1:/")


def exists(spark: SparkSession, path: str) -> bool:
    place, fs = _place(spark, path)
    return fs.exists(place)


def data_files(spark: SparkSession, path: str) -> list[str]:
    """Files of a folder (not of folders in it), or that match a pattern, as Spark would read them."""
    return sorted(file_sizes(spark, path))


def file_sizes(spark: SparkSession, path: str) -> dict[str, int]:
    """Those files with their bytes."""
    place, fs = _place(spark, path)
    found = [s for s in fs.globStatus(place) or []]
    listed = [f for s in found for f in (fs.listStatus(s.getPath()) if s.isDirectory() else [s])]
    return {f.getPath().toString(): f.getLen() for f in listed if not f.isDirectory() and f.getPath().getName()[0] not in "_."}


def folder_names(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders in a folder; none if there is no such folder."""
    place, fs = _place(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(place) if s.isDirectory()] if fs.exists(place) else []


def delete(spark: SparkSession, path: str) -> None:
    place, fs = _place(spark, path)
    fs.delete(place, True)


def write_bytes(spark: SparkSession, path: str, content: bytes) -> None:
    place, fs = _place(spark, path)
    out = fs.create(place, True)
    out.write(bytearray(content))
    out.close()


def create_once(spark: SparkSession, path: str, text: str) -> bool:
    """Write a whole small file unless there is one; False if another writer was first."""
    place, fs = _place(spark, path)
    hadoop = spark._jvm.org.apache.hadoop.fs
    draft = hadoop.Path(place.getParent(), f".{place.getName()}.{uuid.uuid4().hex}")
    out = fs.create(draft, False)
    out.write(bytearray(text.encode()))
    out.close()
    context = hadoop.FileContext.getFileContext(fs.getUri(), spark._jsc.hadoopConfiguration())
    plain = spark.sparkContext._gateway.new_array(hadoop.Options.Rename, 1)
    plain[0] = hadoop.Options.Rename.NONE
    try:
        context.rename(fs.makeQualified(draft), fs.makeQualified(place), plain)
    except Py4JJavaError:
        fs.delete(draft, False)
        if fs.exists(place):
            return False
        raise
    return True
