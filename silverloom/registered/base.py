"""Registry of queries: a name, a function of the tables, and SQL for comparison."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..session import SETTINGS

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


class Tables:
    """Driver tables by attribute: ``t.orders``."""

    def __init__(self, spark: SparkSession, folder: str):
        for key in ("spark.sql.adaptive.enabled", "spark.sql.adaptive.forceOptimizeSkewedJoin"):
            spark.conf.set(key, SETTINGS[key])
        self.spark = spark
        self.folder = folder

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = lambda spark, folder: fn(Tables(spark, folder))
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register
