"""From raw documents to packed token rows, a stage for each step, each written before the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from silverloom.llm.common import stored
from silverloom.llm.decontaminate import keep_clean
from silverloom.llm.language import keep_identified
from silverloom.llm.mixing import repeat_mixed
from silverloom.llm.packing import pack
from silverloom.llm.simhash import keep_one


def identified(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is known; null texts and texts without a letter go."""
    return keep_identified(docs)


def distinct_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return keep_one(docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return keep_clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of their source takes them."""
    return repeat_mixed(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows of token ids."""
    return pack(docs)


STAGES = [
    ("language_id", identified),
    ("simhash_near_dedup", distinct_documents),
    ("decontamination", decontaminated),
    ("mixing", mixed),
    ("token_output", packed),
]

# Models, drawn samples and tokenizers cannot be written in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder; every stage but the last is stored and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
