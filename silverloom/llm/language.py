"""Language identification: script ranges, per-word trigram scores, and Viterbi spans."""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

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

from .common import chosen, held_out, in_tasks
from .registry import query

# First and last code point of the letters of each script.
SCRIPTS = {
    "latin": [(0x41, 0x5A), (0x61, 0x7A), (0xAA, 0x24F), (0x1E00, 0x1EFF), (0xFF21, 0xFF5A)],
    "greek": [(0x370, 0x3FF), (0x1F00, 0x1FFF)],
    "cyrillic": [(0x400, 0x52F), (0x1C80, 0x1C8F), (0x2DE0, 0x2DFF)],
    "armenian": [(0x530, 0x58F)],
    "hebrew": [(0x590, 0x5FF)],
    "arabic": [(0x600, 0x6FF), (0x750, 0x77F), (0x8A0, 0x8FF), (0xFB50, 0xFDFF), (0xFE70, 0xFEFF)],
    "devanagari": [(0x900, 0x97F)],
    "bengali": [(0x980, 0x9FF)],
    "tamil": [(0xB80, 0xBFF)],
    "thai": [(0xE00, 0xE7F)],
    "georgian": [(0x10A0, 0x10FF)],
    "hangul": [(0x1100, 0x11FF), (0x3130, 0x318F), (0xAC00, 0xD7AF)],
    "kana": [(0x3040, 0x30FF), (0x31F0, 0x31FF)],
    "han": [(0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0x20000, 0x323AF)],
}
UNKNOWN = "und"
BUCKETS = 1 << 16
SAMPLE_DOCS = 20_000
SWITCH_PENALTY = 15.0
SCRIPT_SHARE = 0.01
SMOOTHING = 0.5
_OTHER = len(SCRIPTS) + 1
_SLICE = 1 << 20
_CHUNK_CHARS = 4 << 20


@cache
def _script_table() -> np.ndarray:
    """Script number by code point; 0 where the code point is no letter."""
    letters = np.fromiter((chr(i).isalpha() for i in range(0x110000)), np.bool_, 0x110000)
    table = np.full(0x110000, _OTHER, np.uint8)
    for number, ranges in enumerate(SCRIPTS.values(), 1):
        for first, last in ranges:
            table[first : last + 1] = number
    table[~letters] = 0
    return table


def _lower(text: str) -> str:
    """Lower case of the same length."""
    low = text.lower()
    return low if len(low) == len(text) else "".join(x if len(x) == 1 else c for c, x in zip(text, map(str.lower, text)))


def _slices(codes: np.ndarray, scripts: np.ndarray) -> Iterator[tuple[int, int]]:
    """Cut the text at places that are no letters, so that no word is cut."""
    at = 0
    while at < len(codes):
        end = min(at + _SLICE, len(codes))
        while end < len(codes) and scripts[end]:
            rest = np.flatnonzero(scripts[end : end + 4096] == 0)
            end = end + int(rest[0]) if len(rest) else min(end + 4096, len(codes))
        yield at, end
        at = end


def _trigrams(codes: np.ndarray, scripts: np.ndarray):
    """For a slice: positions of letters, their trigram's bucket, and where words begin among them."""
    plain = np.full(len(codes) + 2, 32, np.uint32)
    plain[1:-1] = np.where(scripts > 0, codes, 32)
    at = np.flatnonzero(scripts)
    mixed = plain[at] * np.uint32(0x9E3779B1) ^ plain[at + 1] * np.uint32(0x85EBCA6B) ^ plain[at + 2] * np.uint32(0xC2B2AE35)
    buckets = (mixed ^ mixed >> np.uint32(13)) * np.uint32(0x27D4EB2F) >> np.uint32(16)
    begins = np.flatnonzero(plain[at] == 32)
    return at, buckets.astype(np.intp), begins


def _codes(text: str) -> tuple[np.ndarray, np.ndarray]:
    codes = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    return codes, _script_table()[codes]


class Model:
    """Log probability of each trigram bucket by language, and the languages written in each script."""

    def __init__(self, langs: list[str], trigrams: np.ndarray, letters: np.ndarray, penalty: float = SWITCH_PENALTY):
        """``trigrams``: counts, language by bucket; ``letters``: counts, language by script."""
        self.langs, self.penalty = langs, penalty
        total = trigrams.sum(axis=1, keepdims=True)
        logs = np.log((trigrams + SMOOTHING) / (total + SMOOTHING * BUCKETS))
        self.logs = np.ascontiguousarray(logs.T, dtype=np.float32)
        share = letters / np.maximum(letters.sum(axis=1, keepdims=True), 1)
        # Scripts narrow the candidates: a language that does not use a word's script gets a
        # very low score; where no known language uses the script, all get the same score.
        written = (share >= SCRIPT_SHARE).T
        known = written.any(axis=1, keepdims=True)
        self.ruled_out = ~written
        self.penalised = np.where(known, np.float32(-1e4), np.float32(0)) * np.ones_like(written, np.float32)

    def words(self, text: str):
        """(start, end, scores by language) of the words of a text that is in lower case."""
        codes, scripts = _codes(text)
        starts, ends, scores = [], [], []
        for a, b in _slices(codes, scripts):
            at, buckets, begins = _trigrams(codes[a:b], scripts[a:b])
            if not len(at):
                continue
            first = at[begins]
            own = np.add.reduceat(self.logs.take(buckets, axis=0, mode="clip"), begins, axis=0)
            own = np.where(self.ruled_out[scripts[a:b][first]], self.penalised[scripts[a:b][first]], own)
            starts.append(first + a)
            ends.append(at[np.append(begins[1:], len(at)) - 1] + 1 + a)
            scores.append(own)
        if not starts:
            return np.zeros(0, int), np.zeros(0, int), np.zeros((0, len(self.langs)), np.float32)
        return np.concatenate(starts), np.concatenate(ends), np.concatenate(scores)

    def settled(self, scores: np.ndarray) -> int | None:
        """The one language of the best path if no switch can pay, else None."""
        best = int(scores.sum(axis=0, dtype=np.float64).argmax())
        gain = np.cumsum(scores - scores[:, best : best + 1], axis=0, dtype=np.float64)
        low = np.minimum(np.minimum.accumulate(gain, axis=0), 0)
        return best if (gain - low).max() < self.penalty / 2 else None

    def paths(self, texts: list[np.ndarray]) -> list[np.ndarray]:
        """Best path of each matrix of word scores, found for all texts together, a word at a time."""
        if not texts:
            return []
        order = sorted(range(len(texts)), key=lambda i: -len(texts[i]))
        lengths = np.array([len(texts[i]) for i in order])
        flat = np.concatenate([texts[i] for i in order]).astype(np.float64)
        offsets = np.concatenate([[0], np.cumsum(lengths)[:-1]])
        value = flat[offsets]
        own = np.arange(len(self.langs))
        froms = []
        for step in range(1, lengths[0]):
            n = int(np.searchsorted(-lengths, -step, side="left"))  # texts with a word at this step
            before = value[:n]
            top = before.argmax(axis=1)
            switched = before[np.arange(n), top] - self.penalty
            stay = before >= switched[:, None]
            froms.append(np.where(stay, own, top[:, None]).astype(np.uint8 if len(own) < 256 else np.uint16))
            value[:n] = np.where(stay, before, switched[:, None]) + flat[offsets[:n] + step]
        state = value.argmax(axis=1)
        labels = np.zeros(len(flat), np.int64)
        labels[offsets + lengths - 1] = state
        for step in range(len(froms), 0, -1):
            n = len(froms[step - 1])
            state[:n] = froms[step - 1][np.arange(n), state[:n]]
            labels[offsets[:n] + step - 1] = state[:n]
        out: list = [None] * len(order)
        for i, a, k in zip(order, offsets, lengths):
            out[i] = labels[a : a + k]
        return out

    def label(self, texts: list[str | None]) -> list[tuple[str, float, list[dict]]]:
        """(language, score, spans) of each text."""
        found: list = [(UNKNOWN, 0.0, [])] * len(texts)
        words, open_ = {}, []
        for i, text in enumerate(texts):
            starts, ends, scores = self.words(_lower(text)) if text and self.langs else ([], [], [])
            if len(starts):
                one = self.settled(scores)
                words[i] = [starts, ends, scores, None if one is None else np.full(len(starts), one)]
                if one is None:
                    open_.append(i)
        for i, path in zip(open_, self.paths([words[i][2] for i in open_])):
            words[i][3] = path
        for i, (starts, ends, scores, path) in words.items():
            weight = np.bincount(path, ends - starts, len(self.langs))
            total = scores.sum(axis=0, dtype=np.float64)
            best = max(range(len(self.langs)), key=lambda k: (weight[k], total[k], -k))
            rest = np.delete(total, best)
            margin = total[best] - rest.max() if len(rest) else 50.0
            sure = 1 / (1 + np.exp(-np.clip(margin, -50, 50)))
            share = weight[best] / weight.sum()
            cut = np.flatnonzero(np.diff(path)) + 1
            a, b = np.append([0], cut), np.append(cut, len(path)) - 1
            spans = [{"start": int(starts[x]), "end": int(ends[y]), "lang": self.langs[path[x]]} for x, y in zip(a, b)]
            found[i] = (self.langs[best], float(share * sure), spans)
        return found


def train(docs: DataFrame, bound: int = SAMPLE_DOCS, penalty: float = SWITCH_PENALTY) -> Model:
    """Learn from text and lang of rows outside the held-out fold, at most about ``bound`` of them.

    Rows without text or lang teach nothing. Without any row the model knows no language
    and labels everything ``und``. The counts that reach the driver are bounded by the
    languages times ``BUCKETS``.
    """
    rows = docs.select("doc_id", "text", "lang").where(~held_out(F.col("doc_id")) & F.col("lang").isNotNull())
    rows = rows.where(chosen(F.col("doc_id"), rows.count(), bound)).select("text", "lang")
    schema = StructType([StructField("lang", StringType()), StructField("bucket", IntegerType()), StructField("n", LongType())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, np.ndarray] = {}
        for batch in batches:
            for text, lang in zip(batch.column(0), batch.column(1)):
                mine = counts.setdefault(lang.as_py(), np.zeros(BUCKETS + _OTHER + 1, np.int64))
                codes, scripts = _codes(_lower(text.as_py() or ""))
                for a, b in _slices(codes, scripts):
                    at, buckets, _ = _trigrams(codes[a:b], scripts[a:b])
                    mine[:BUCKETS] += np.bincount(buckets, minlength=BUCKETS)
                    mine[BUCKETS:] += np.bincount(scripts[a:b][at], minlength=_OTHER + 1)
        for lang, mine in counts.items():
            used = np.flatnonzero(mine)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(used)), pa.array(used, pa.int32()), pa.array(mine[used], pa.int64())], names=["lang", "bucket", "n"]
            )

    table = in_tasks(rows, count, schema).groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toArrow()
    langs = sorted(set(table.column("lang").to_pylist()))
    number = {x: i for i, x in enumerate(langs)}
    counts = np.zeros((len(langs), BUCKETS + _OTHER + 1))
    if langs:
        which = np.array([number[x] for x in table.column("lang").to_pylist()])
        counts[which, table.column("bucket").to_numpy()] = table.column("n").to_numpy()
    return Model(langs, counts[:, :BUCKETS], counts[:, BUCKETS:], penalty)


_SPAN = StructType([StructField("start", LongType()), StructField("end", LongType()), StructField("lang", StringType())])


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with lang_pred, lang_score and lang_spans (start and end in code points, end exclusive).

    Text that is null or has no letter gets ``und``, score 0 and no span. Columns of those
    names are replaced; all other columns and repeated rows stay as they are.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kept = docs.drop("lang_pred", "lang_score", "lang_spans")
    at = kept.columns.index("text")
    schema = StructType(
        [*kept.schema.fields, StructField("lang_pred", StringType()), StructField("lang_score", DoubleType()), StructField("lang_spans", ArrayType(_SPAN))]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            begin, chars = 0, 0
            texts: list = []
            for k, text in enumerate(batch.column(at)):
                texts.append(text.as_py())
                chars += len(texts[-1] or "")
                if chars >= _CHUNK_CHARS or k + 1 == batch.num_rows:
                    yield _labelled(batch.slice(begin, k + 1 - begin), shared.value.label(texts))
                    begin, chars, texts = k + 1, 0, []

    return in_tasks(kept, run, schema)


def _labelled(batch: pa.RecordBatch, found: list) -> pa.RecordBatch:
    span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("lang", pa.string())]))
    columns = [pa.array([x[0] for x in found], pa.string()), pa.array([x[1] for x in found], pa.float64()), pa.array([x[2] for x in found], span)]
    return pa.RecordBatch.from_arrays([*batch.columns, *columns], names=[*batch.schema.names, "lang_pred", "lang_score", "lang_spans"])


def keep_identified(docs: DataFrame, bound: int = SAMPLE_DOCS) -> DataFrame:
    """The rows whose language is known, with the columns they came with."""
    found = identify(docs, train(docs, bound))
    return found.where(F.col("lang_pred") != UNKNOWN).select(*docs.columns)


@query("op6_language_id")
def op6(t):
    docs = t.documents.select("doc_id", "text", "lang")
    found = identify(docs.select("doc_id", "text"), train(docs))
    return found.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", F.col("lang_score").alias("score"), F.size("lang_spans").cast("long").alias("n_spans")
    )
