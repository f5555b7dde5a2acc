"""Quality classifier: an additive model of shape tables, with tables for pairs of features."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from itertools import combinations
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, IntegerType, StructField, StructType

from .common import held_out, in_tasks
from .labelled import SAMPLE_DOCS, sample
from .registry import query

FEATURES = (
    "log_chars", "log_words", "word_chars", "distinct_words", "top_word", "repeats", "upper", "digits", "marks", "symbols",
    "bars", "non_ascii", "breaks", "distinct_lines", "odd_words", "ends",
)
BINS, PAIR_BINS = 32, 8
PAIRS = 6
ROUNDS, PAIR_ROUNDS = 120, 40
RATE = 0.1
RIDGE = 1.0
THRESHOLD = 0.3


def _classes() -> np.ndarray:
    """Byte classes as columns: upper, letters, digits, ! and ?, other marks, bars, non-ASCII, new lines."""
    table = np.zeros((256, 8))
    for c in range(256):
        ch = chr(c) if c < 128 else ""
        table[c] = [ch.isupper(), ch.isalpha(), ch.isdigit(), ch != "" and ch in "!?", ch != "" and ch in "$%&*#@^~=+<>{}[]\\/_", ch == "|", c >= 0xC0, ch == "\n"]
    return table


_CLASSES = _classes()


def features(text: str | None) -> list[float]:
    """``FEATURES`` of a text. Shares are of its words, letters or characters; an empty text has zeros."""
    text = text or ""
    raw = np.frombuffer(text.encode(), np.uint8)
    upper, letters, digits, marks, symbols, bars, wide, breaks = np.bincount(raw, minlength=256) @ _CLASSES
    words = text.split()
    counts = Counter(words)
    chars, n = max(len(text), 1), max(len(words), 1)
    lines = text.split("\n")
    odd = sum(not w.rstrip(".,;:").isalpha() for w in counts)
    return [
        float(np.log1p(len(text))), float(np.log1p(len(words))), (letters + wide) / n, len(counts) / n,
        max(counts.values(), default=0) / n, sum(map(eq, words, words[1:])) / n, upper / max(letters, 1), digits / chars,
        marks / n, symbols / n, bars / n, wide / chars, breaks / n, len(set(lines)) / len(lines), odd / max(len(counts), 1),
        text.count(". ") / n,
    ]


class AdditiveModel:
    """score = sigmoid(base + sum of a table per feature + sum of a table per pair of features), looked up by bin."""

    def __init__(self, edges: list[np.ndarray], coarse: list[np.ndarray]):
        self.edges, self.coarse = edges, coarse
        self.base = 0.0
        self.tables = [np.zeros(len(e) + 1) for e in edges]
        self.pairs: dict[tuple[int, int], np.ndarray] = {}

    def raw(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.base)
        for j, table in enumerate(self.tables):
            out += table[np.searchsorted(self.edges[j], x[:, j], side="right")]
        for (j, k), table in self.pairs.items():
            out += table[np.searchsorted(self.coarse[j], x[:, j], side="right"), np.searchsorted(self.coarse[k], x[:, k], side="right")]
        return out

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.raw(x), -30, 30)))


def _edges(values: np.ndarray, bins: int) -> np.ndarray:
    return np.unique(np.quantile(values, np.linspace(0, 1, bins + 1)[1:-1])) if len(values) else np.zeros(0)


def _gain(g: np.ndarray, h: np.ndarray) -> np.ndarray:
    return g * g / (h + RIDGE)


def _tree(g: np.ndarray, h: np.ndarray, depth: int = 2) -> np.ndarray:
    """Steps for the bins of one feature: a tree over their order, each leaf a Newton step."""
    out = np.full(len(g), g.sum() / (h.sum() + RIDGE))
    if depth and len(g) > 1:
        left_g, left_h = np.cumsum(g)[:-1], np.cumsum(h)[:-1]
        gains = _gain(left_g, left_h) + _gain(g.sum() - left_g, h.sum() - left_h)
        cut = int(gains.argmax()) + 1
        if gains[cut - 1] > _gain(g.sum(), h.sum()) + 1e-9:
            out[:cut], out[cut:] = _tree(g[:cut], h[:cut], depth - 1), _tree(g[cut:], h[cut:], depth - 1)
    return out


def _quarters(g: np.ndarray, h: np.ndarray) -> tuple[float, np.ndarray]:
    """The best cut of a pair's grid into four: its gain over no cut and the steps by cell."""
    sums_g, sums_h = g.cumsum(0).cumsum(1), h.cumsum(0).cumsum(1)
    if min(g.shape) < 2:
        return 0.0, np.zeros(g.shape)
    a_g, a_h = sums_g[:-1, :-1], sums_h[:-1, :-1]
    b_g, b_h = sums_g[:-1, -1:] - a_g, sums_h[:-1, -1:] - a_h
    c_g, c_h = sums_g[-1:, :-1] - a_g, sums_h[-1:, :-1] - a_h
    d_g, d_h = g.sum() - a_g - b_g - c_g, h.sum() - a_h - b_h - c_h
    gains = _gain(a_g, a_h) + _gain(b_g, b_h) + _gain(c_g, c_h) + _gain(d_g, d_h) - _gain(g.sum(), h.sum())
    i, j = np.unravel_index(int(gains.argmax()), gains.shape)
    steps = np.empty(g.shape)
    for rows in (slice(0, i + 1), slice(i + 1, None)):
        for columns in (slice(0, j + 1), slice(j + 1, None)):
            steps[rows, columns] = g[rows, columns].sum() / (h[rows, columns].sum() + RIDGE)
    return float(gains[i, j]), steps


def fit(x: np.ndarray, y: np.ndarray) -> AdditiveModel:
    """Cyclic boosting on a bounded sample: features take turns, each turn adds a shallow tree to its table; then pairs.

    Without rows the model scores 0.5; with one class it scores near that class.
    """
    edges = [_edges(x[:, j], BINS) for j in range(len(FEATURES))]
    model = AdditiveModel(edges, [_edges(x[:, j], PAIR_BINS) for j in range(len(FEATURES))])
    rate = (y.sum() + 1) / (len(y) + 2)
    model.base = float(np.log(rate / (1 - rate)))
    if not len(y):
        return model
    fine = [np.searchsorted(e, x[:, j], side="right") for j, e in enumerate(edges)]
    rough = [np.searchsorted(e, x[:, j], side="right") for j, e in enumerate(model.coarse)]
    raw = np.full(len(y), model.base)

    def slopes() -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-raw))
        return y - p, p * (1 - p)

    for _ in range(ROUNDS):
        for j, bins in enumerate(fine):
            g, h = slopes()
            size = len(model.tables[j])
            step = RATE * _tree(np.bincount(bins, g, size), np.bincount(bins, h, size))
            model.tables[j] += step
            raw += step[bins]

    def grid(j: int, k: int) -> tuple[np.ndarray, tuple[int, int]]:
        shape = len(model.coarse[j]) + 1, len(model.coarse[k]) + 1
        return rough[j] * shape[1] + rough[k], shape

    def quarters(j: int, k: int, g: np.ndarray, h: np.ndarray) -> tuple[float, np.ndarray]:
        cells, shape = grid(j, k)
        return _quarters(*(np.bincount(cells, v, shape[0] * shape[1]).reshape(shape) for v in (g, h)))

    g, h = slopes()
    best = sorted(combinations(range(len(FEATURES)), 2), key=lambda p: (-quarters(*p, g, h)[0], p))[:PAIRS]
    model.pairs = {p: np.zeros(grid(*p)[1]) for p in best}
    for _ in range(PAIR_ROUNDS):
        for p in best:
            step = RATE * quarters(*p, *slopes())[1]
            model.pairs[p] += step
            raw += step.ravel()[grid(*p)[0]]
    return model


def _matrix(texts: pa.Array) -> np.ndarray:
    return np.array([features(t.as_py()) for t in texts]).reshape(len(texts), len(FEATURES))


def train(docs: DataFrame, labels: DataFrame, bound: int = SAMPLE_DOCS) -> AdditiveModel:
    """Fit on the features of at most about ``bound`` labelled documents, which are computed in tasks."""
    rows = sample(docs, labels, "quality", bound)
    schema = StructType([StructField("x", ArrayType(DoubleType())), StructField("label", IntegerType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array(_matrix(batch.column(0)).tolist(), pa.list_(pa.float64())), batch.column(1)], names=["x", "label"])

    table = in_tasks(rows, run, schema).toArrow()
    x = np.array(table.column("x").to_pylist(), float).reshape(table.num_rows, len(FEATURES))
    order = np.lexsort([table.column("label").to_numpy(), *x.T[::-1]])  # sums must not depend on the order of rows
    return fit(x[order], table.column("label").to_numpy()[order].astype(float))


def score(docs: DataFrame, model: AdditiveModel, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, score, predicted) of every row, also of null and empty texts; other columns are not read."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    schema = StructType([docs.schema["doc_id"], StructField("score", DoubleType()), StructField("predicted", IntegerType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = shared.value.score(_matrix(batch.column(1)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found), pa.array((found >= threshold).astype(np.int32))], names=schema.names)

    return in_tasks(docs.select("doc_id", "text"), run, schema)


@query("op9_quality")
def op9(t):
    found = score(t.documents, train(t.documents, t.labels))
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")
