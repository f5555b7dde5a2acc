"""Registry of the queries of this subpackage, apart from the one of the library."""

from __future__ import annotations

import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..registered.base import Tables

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

MODULES = (
    "secrets", "decontaminate", "line_dedup", "packing", "simhash", "language", "mixing", "order_minhash", "quality", "toxicity", "substrings", "collocations", "alignment",
)


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = lambda spark, folder: fn(Tables(spark, folder))
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def load():
    for name in MODULES:
        importlib.import_module(f"silverloom.llm.{name}")
    return QUERIES, ORACLES
