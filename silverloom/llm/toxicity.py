"""Toxicity: a weighted lexicon matched in folded text, normalised by length, with exception phrases."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
)

from .common import held_out, in_tasks
from .labelled import SAMPLE_DOCS, sample
from .registry import query

# Common insults and the weight they have unless the labels say otherwise.
GIVEN = ("idiot", "moron", "stupid", "imbecile", "loser", "scum", "trash", "worthless", "pathetic", "disgusting", "clown", "dumbass", "jerk", "retard")
GIVEN_WEIGHT = 3.0
# Phrases in which such a word is harmless.
GIVEN_EXCEPTIONS = ("trash can", "trash bin", "clown fish", "jerk chicken", "knee jerk")
# Letters that look like Latin ones, digits and signs used for letters.
LOOKALIKES = {
    "а": "a", "е": "e", "о": "o", "р": "p", "с": "c", "у": "y", "х": "x", "і": "i", "ј": "j", "ѕ": "s", "к": "k", "м": "m",
    "т": "t", "н": "h", "в": "b", "ԁ": "d", "ɡ": "g", "α": "a", "ο": "o", "ρ": "p", "ν": "v", "ι": "i", "κ": "k", "τ": "t",
    "ı": "i", "ⅼ": "l", "ℓ": "l",
    "0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "9": "g",
}
LEVEL = 2.5
SUPPORT = 4
PREFIXES = range(4, 9)
SHARED = 1.5
EXCEPTION_DOCS = 3
THRESHOLD = 0.5
_WORD = re.compile(r"[^\W_]+")
_SIGN = re.compile(r"(?<=[a-z])[@$](?=[a-z])")
_HIDDEN = "​‌‍⁠﻿­"


def _folds() -> dict[int, str | None]:
    table: dict[int, str | None] = {ord(a): b for a, b in LOOKALIKES.items()}
    table |= {ord(c): None for c in _HIDDEN}
    table |= {0xFF41 + k: chr(97 + k) for k in range(26)}  # wide letters
    table |= {c: "i" for c, to in list(table.items()) if to == "l"}
    return table | {ord("l"): "i"}  # 1 may stand for either, so i and l are one


_FOLDS = _folds()


def folded(text: str | None) -> str:
    """Words of a text, folded and in lower case, with a space around each."""
    low = (text or "").lower().translate(_FOLDS)
    if "@" in low or "$" in low:
        low = _SIGN.sub(lambda m: "a" if m[0] == "@" else "s", low)
    return f" {' '.join(_WORD.findall(low))} "


def grams(text: str) -> set[str]:
    """Whole words (a space on both sides) and beginnings of words (a space before) of a folded text."""
    out = set()
    for word in set(text.split()):
        if len(word) > 2:
            out.add(f" {word} ")
            out.update(f" {word[:k]}" for k in PREFIXES if k < len(word))
    return out


class Lexicon:
    """Weighted entries and exception phrases in one Aho-Corasick machine."""

    def __init__(self, entries: dict[str, float], exceptions: list[str]):
        self.entries, self.exceptions = entries, exceptions
        self.machine = None

    def __getstate__(self):
        return {"entries": self.entries, "exceptions": self.exceptions, "machine": None}

    def hits(self, text: str) -> list[tuple[int, float]]:
        """(place, weight) of each word of a folded text that has an entry, the heaviest if several, none inside an exception."""
        if self.machine is None:
            self.machine = ahocorasick.Automaton()
            for phrase in self.exceptions:
                self.machine.add_word(phrase, (len(phrase), None))
            for entry, weight in self.entries.items():
                self.machine.add_word(entry, (len(entry), weight))
            if len(self.machine):
                self.machine.make_automaton()
        if not len(self.machine):
            return []
        found: dict[int, float] = {}
        spared = []
        for end, (length, weight) in self.machine.iter(text):
            begin = end - length + 1
            if weight is None:
                spared.append((begin, end))
            elif weight > found.get(begin, 0):
                found[begin] = weight
        for a, b in spared:
            for at in [k for k in found if a <= k < b]:
                del found[at]
        return sorted(found.items())

    def features(self, text: str | None) -> list[float]:
        """Summed weight by the root of the number of words and by the number of words, and the heaviest entry."""
        text = folded(text)
        hits = self.hits(text)
        if not hits:
            return [0.0, 0.0, 0.0]
        words, total = text.count(" ") - 1, sum(w for _, w in hits)
        return [total / words**0.5, total / words, max(w for _, w in hits)]


class Scorer:
    """Logistic score of a lexicon's features."""

    def __init__(self, lexicon: Lexicon, weights: np.ndarray):
        self.lexicon, self.weights = lexicon, weights

    def score(self, texts: pa.Array) -> np.ndarray:
        x = np.array([self.lexicon.features(t.as_py()) for t in texts]).reshape(len(texts), 3)
        return logistic(x, self.weights)


def logistic(x: np.ndarray, weights: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(weights[0] + np.log1p(x) @ weights[1:], -30, 30)))


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2) -> np.ndarray:
    """Newton steps for intercept and weights of log1p(features); with no rows, a hit decides."""
    if not len(y) or y.min() == y.max():
        return np.array([-3.0, 0.0, 0.0, 3.0])
    z = np.column_stack([np.ones(len(y)), np.log1p(x)])
    weights = np.zeros(z.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(z @ weights, -30, 30)))
        slope = z.T @ (y - p) - ridge * weights
        curve = (z * (p * (1 - p) + 1e-9)[:, None]).T @ z + ridge * np.eye(z.shape[1])
        step = np.linalg.solve(curve, slope)
        weights += step * min(1.0, 5 / max(np.abs(step).max(), 1e-9))
        if np.abs(step).max() < 1e-8:
            break
    return weights


def _counted(rows: DataFrame, items) -> DataFrame:
    """(gram, toxic, plain): in how many toxic and other texts each item of ``items(text)`` is."""
    schema = StructType([StructField("gram", StringType()), StructField("toxic", LongType()), StructField("plain", LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen = Counter(), Counter()
            for text, label in zip(batch.column(0), batch.column(1)):
                seen[label.as_py()].update(items(text.as_py()))
            names = list(seen[0].keys() | seen[1].keys())
            yield pa.RecordBatch.from_arrays(
                [pa.array(names, pa.string()), *(pa.array([seen[k][g] for g in names], pa.int64()) for k in (1, 0))], names=schema.names
            )

    return in_tasks(rows, run, schema).groupBy("gram").agg(F.sum("toxic").alias("toxic"), F.sum("plain").alias("plain"))


def learn_lexicon(rows: DataFrame) -> Lexicon:
    """Entries and exceptions from stored (text, label) rows.

    An entry is a word or a word's beginning in at least ``SUPPORT`` toxic texts whose smoothed log
    ratio of shares is ``LEVEL`` or more; a beginning must be in ``SHARED`` times as many toxic
    texts as any one word with it, and a longer entry is left out where a shorter one
    weighs nearly as much. The given insults are entries as well. An exception is an entry
    with the word before or after it, seen in ``EXCEPTION_DOCS`` other texts and no toxic one.
    """
    totals = dict(rows.groupBy("label").count().collect())
    toxic, plain = totals.get(1, 0), totals.get(0, 0)
    weight = F.log((F.col("toxic") + 0.5) / (toxic + 1)) - F.log((F.col("plain") + 0.5) / (plain + 1))
    found = _counted(rows, lambda t: grams(folded(t))).withColumn("w", weight).where((F.col("toxic") >= SUPPORT) & (F.col("w") >= LEVEL))
    rows_ = found.select("gram", "w", "toxic").collect()
    learned = {r["gram"]: r["w"] for r in rows_}
    # A word's beginning says more than the word only where several words share it.
    alone: Counter = Counter()
    for r in rows_:
        if r["gram"].endswith(" "):
            for k in PREFIXES:
                alone[r["gram"][: k + 1]] = max(alone[r["gram"][: k + 1]], r["toxic"])
    for r in rows_:
        if not r["gram"].endswith(" ") and r["toxic"] < SHARED * alone[r["gram"]]:
            del learned[r["gram"]]
    entries: dict[str, float] = {}
    for gram in sorted(learned, key=lambda g: (len(g), g)):
        shorter = [entries[gram[:k]] for k in range(2, len(gram)) if gram[:k] in entries]
        if not shorter or learned[gram] > max(shorter) + 0.7:
            entries[gram] = learned[gram]
    for word in GIVEN:
        entries.setdefault(folded(word), max(GIVEN_WEIGHT, learned.get(folded(word), 0)))
    bare = Lexicon(entries, [])

    def contexts(text: str) -> set[str]:
        text = folded(text)
        out = set()
        for at, _ in bare.hits(text):
            end = text.index(" ", at + 1)
            before, after = text.rfind(" ", 0, at), text.find(" ", end + 1)
            if at:
                out.add(text[before : end + 1])
            if after > 0:
                out.add(text[at : after + 1])
        return out

    spared = _counted(rows, contexts).where((F.col("plain") >= EXCEPTION_DOCS) & (F.col("toxic") == 0)).select("gram")
    return Lexicon(entries, sorted({r[0] for r in spared.collect()} | {folded(p) for p in GIVEN_EXCEPTIONS}))


def train(docs: DataFrame, labels: DataFrame, bound: int = SAMPLE_DOCS) -> Scorer:
    """Learn from at most about ``bound`` labelled documents outside the held-out fold."""
    rows = sample(docs, labels, "toxic", bound)
    lexicon = learn_lexicon(rows)
    schema = StructType([StructField("x", ArrayType(DoubleType())), StructField("label", IntegerType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = [lexicon.features(t.as_py()) for t in batch.column(0)]
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.list_(pa.float64())), batch.column(1)], names=["x", "label"])

    table = in_tasks(rows, run, schema).toArrow()
    x = np.array(table.column("x").to_pylist(), float).reshape(table.num_rows, 3)
    y = table.column("label").to_numpy().astype(float)
    order = np.lexsort([y, *x.T])  # sums must not depend on the order of rows
    return Scorer(lexicon, fit_logistic(x[order], y[order]))


def score(docs: DataFrame, scorer: Scorer, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, score, predicted) of every row; null, empty and clean texts get the score of no hit. Other columns are not read."""
    shared = docs.sparkSession.sparkContext.broadcast(scorer)
    schema = StructType([docs.schema["doc_id"], StructField("score", DoubleType()), StructField("predicted", IntegerType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = shared.value.score(batch.column(1))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found), pa.array((found >= threshold).astype(np.int32))], names=schema.names)

    return in_tasks(docs.select("doc_id", "text"), run, schema)


@query("op10_toxicity")
def op10(t):
    found = score(t.documents, train(t.documents, t.labels))
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")
