"""Bounded samples of labelled documents to learn from."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import chosen, held_out, stored

SAMPLE_DOCS = 20_000


def sample(docs: DataFrame, labels: DataFrame, label: str, bound: int = SAMPLE_DOCS) -> DataFrame:
    """(text, label) of about ``bound`` labelled documents outside the held-out fold, all if there are fewer; stored.

    Chosen by a hash of doc_id, so reruns agree. Labels other than 0 and 1 and missing ids
    are left out; a doc_id with several labels has the largest, one with several rows its
    least text, so no id teaches more than another. The chosen ids are bounded, so they are
    broadcast; the texts are written to the shared folder.
    """
    known = labels.where(F.col(label).isin(0, 1) & ~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.max(label).cast("int").alias("label"))
    picked = known.where(chosen(F.col("doc_id"), known.count(), bound))
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    found = texts.join(F.broadcast(picked), "doc_id").groupBy("doc_id").agg(F.min("text").alias("text"), F.max("label").alias("label"))
    return stored(found.select("text", "label"), "labelled")
