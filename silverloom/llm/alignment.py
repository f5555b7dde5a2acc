"""Cross-tokenizer alignment: which tokens of two vocabularies end together, counted over the corpus with minimal perfect hashing."""

from __future__ import annotations

import json
import os
import re
from collections.abc import Callable, Iterator
from itertools import chain
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import sentencepiece
import tiktoken
import tokenizers
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import LongType, StringType, StructField, StructType

from .common import in_tasks, stored
from .packing import PATTERN
from .registry import query

BYTE_BPE = "/opt/tokenizers/byte_bpe_50k.json"
PIECE_BPE = "/opt/tokenizers/piece_bpe_32k.model"
MAX_PAIRS = 1 << 22  # pairs of one table that is broadcast
GAMMA = 2
SLICE = 1 << 16
FAN_IN = 16
_CACHED, _CACHED_CHARS = 500_000, 1 << 23
_QUICK_CHARS = 4096
_HALF = np.uint64(32)
_CHUNK_CHARS = 1 << 20
_SAFE_CUT = re.compile(r"(?<=\S) (?=\S)")
_SPACE_MARK = "▁"


def byte_letters() -> dict[str, int]:
    """Letters that stand for bytes in byte-level vocabularies: visible Latin-1 characters for themselves, others from U+0100 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(0x100 + i): b for i, b in enumerate(hidden)}


class Aligned(NamedTuple):
    """Alignment of some parts: which are made up by both tokenizers, and of these the numbers of tokens and links, all ids, the group of each, and each group's last."""

    good: np.ndarray
    n_a: np.ndarray
    n_b: np.ndarray
    n_links: np.ndarray
    a: np.ndarray
    b: np.ndarray
    group_a: np.ndarray
    group_b: np.ndarray
    last_a: np.ndarray
    last_b: np.ndarray

    def links(self) -> np.ndarray:
        return pair_code(self.a[self.last_a].astype(np.uint64), self.b[self.last_b].astype(np.uint64))

    def texts(self, signs: list[str], shift: int) -> list[str]:
        """Groups of each good part as text; ``signs`` has ids of A from 0 and of B from ``shift`` with the sign after them."""
        ends = np.zeros(len(self.a), np.int64), np.zeros(len(self.b), np.int64)
        ends[0][self.last_a] = ends[1][self.last_b] = 1
        order = np.argsort(np.concatenate([2 * self.group_a, 2 * self.group_b + 1]), kind="stable")
        codes = np.concatenate([2 * self.a + ends[0], shift + 2 * self.b + ends[1]])[order]
        written = list(map(signs.__getitem__, codes.tolist()))
        cuts = np.concatenate([[0], np.cumsum(self.n_a + self.n_b)]).tolist()
        return ["".join(written[x:y])[:-1] for x, y in zip(cuts, cuts[1:])]


class Pair:
    """Two tokenizers, and the alignment of texts cut where neither has a token across.

    A single space between other characters begins a token of the byte-level vocabulary, and
    of a piece vocabulary whose pieces have marks for spaces in front only (or are all marks).
    So texts are aligned word by word, each word once while it is kept; with any other piece
    vocabulary texts are aligned whole.
    """

    def __init__(self, byte_bpe: str, piece_bpe: bytes):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.a = tokenizers.Tokenizer.from_str(byte_bpe)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_proto=piece_bpe)
        letters = byte_letters()
        vocabulary = self.a.get_vocab(with_added_tokens=False)
        self.a_bytes = [b""] * (max(vocabulary.values()) + 1)
        for token, i in vocabulary.items():
            self.a_bytes[i] = bytes(letters.get(c, 0) for c in token)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace(_SPACE_MARK, " ").encode() for i, p in enumerate(pieces)]
        self.by_word = not any(_SPACE_MARK in p[1:] and p.strip(_SPACE_MARK) for p in pieces)
        self.a_sizes, self.b_sizes = (np.array([len(x) for x in y], np.int64) for y in (self.a_bytes, self.b_bytes))
        self.quick = self._quick(json.loads(byte_bpe))

    def _quick(self, spec: dict) -> tiktoken.Encoding | None:
        """The byte-level vocabulary by ranks, if its merges are in the order of ids and it cuts words as usual: the same ids sooner."""
        letters, model, cut = byte_letters(), spec["model"], spec.get("pre_tokenizer") or {}
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        ids = [model["vocab"].get("".join(m), -1) for m in merges]
        plain = not any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges")) and not spec.get("normalizer")
        usual = cut.get("type") == "ByteLevel" and not cut.get("add_prefix_space") and cut.get("use_regex", True)
        if not (plain and usual and ids == sorted(set(ids)) and len(merges) + 256 <= len(model["vocab"])):
            return None
        merged = set(ids)
        ranks = {bytes(letters[c] for c in t): i for t, i in model["vocab"].items() if i in merged or (len(t) == 1 and t in letters)}
        return tiktoken.Encoding("given", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})

    def ids_a(self, text: str) -> list[int]:
        if self.quick is not None and len(text) < _QUICK_CHARS:
            return self.quick.encode_ordinary(text)
        return self.a.encode(text, add_special_tokens=False).ids

    def parts(self, text: str) -> list[str]:
        """``text`` in parts that can be aligned on their own, each with a space before it."""
        if not self.by_word:
            return [text]
        parts = text.split(" ")
        # Where all white space is single spaces between words, these are the safe cuts.
        return parts if parts == text.split() else _SAFE_CUT.split(text)

    def align(self, parts: list[str]) -> Aligned:
        texts = [(" " + p).encode() for p in parts]
        a, b = [self.ids_a(" " + p) for p in parts], self.b.encode(parts, num_threads=1)
        flat_a, flat_b = (np.fromiter(chain.from_iterable(x), np.int64) for x in (a, b))
        whole = b"".join(texts)
        good = np.ones(len(parts), bool)
        if b"".join(map(self.a_bytes.__getitem__, flat_a.tolist())) != whole or b"".join(map(self.b_bytes.__getitem__, flat_b.tolist())) != whole or not all(texts):
            for i, t in enumerate(texts):
                good[i] = all(b"".join(y[k] for k in x) == t for x, y in ((a[i], self.a_bytes), (b[i], self.b_bytes)))
            at = np.flatnonzero(good).tolist()
            a, b, texts = [a[i] for i in at], [b[i] for i in at], [texts[i] for i in at]
            flat_a, flat_b = (np.fromiter(chain.from_iterable(x), np.int64) for x in (a, b))
        n_a, n_b, size = (np.array([len(y) for y in x], np.int64) for x in (a, b, texts))
        # All parts lie one after another on one line of bytes.
        ends_a, ends_b = np.cumsum(self.a_sizes[flat_a]), np.cumsum(self.b_sizes[flat_b])
        cuts = np.intersect1d(ends_a, ends_b, assume_unique=True)
        last_a, last_b = np.searchsorted(ends_a, cuts), np.searchsorted(ends_b, cuts)
        n_links = np.diff(np.concatenate([[0], np.searchsorted(cuts, np.cumsum(size), side="right")]))
        return Aligned(good, n_a, n_b, n_links, flat_a, flat_b, np.searchsorted(cuts, ends_a), np.searchsorted(cuts, ends_b), last_a, last_b)


def pair_code(a, b):
    return a << _HALF | b


def _texts(column: pa.Array) -> Iterator[list[str]]:
    """Texts of a column, missing ones as empty, about ``_CHUNK_CHARS`` characters at a time."""
    held, chars = [], 0
    for text in column:
        held.append(text.as_py() or "")
        chars += len(held[-1])
        if chars >= _CHUNK_CHARS:
            yield held
            held, chars = [], 0
    if held:
        yield held


class _Known:
    """Numbers of parts met, and arrays of what is known of each; all is forgotten when there are too many."""

    def __init__(self, pair: Pair, learned: Callable[[Aligned], dict[str, np.ndarray]]):
        self.pair, self.learned = pair, learned
        self.forget()

    def forget(self) -> None:
        self.number: dict[str, int] = {}
        self.bad = np.zeros(0, bool)
        self.columns: dict[str, np.ndarray] = {}
        self.chars = 0

    def full(self) -> bool:
        return len(self.number) > _CACHED or self.chars > _CACHED_CHARS

    def learn(self, texts: list[list[str]]) -> tuple[np.ndarray, np.ndarray]:
        """(numbers of all parts in turn, number of parts of each text)."""
        new = list(set(chain.from_iterable(texts)).difference(self.number))
        bad, columns = [self.bad], {k: [v] for k, v in self.columns.items()}
        for k in range(0, len(new), 4096):
            some = new[k : k + 4096]
            found = self.pair.align(some)
            bad.append(~found.good)
            for name, values in self.learned(found).items():
                columns.setdefault(name, []).append(self._spread(values, found.good))
        self.number.update(zip(new, range(len(self.number), len(self.number) + len(new))))
        self.chars += sum(map(len, new))
        self.bad = np.concatenate(bad)
        self.columns = {k: np.concatenate(v) for k, v in columns.items()}
        lengths = np.array([len(parts) for parts in texts], np.int64)
        return np.fromiter(map(self.number.__getitem__, chain.from_iterable(texts)), np.int64, int(lengths.sum())), lengths

    @staticmethod
    def _spread(values: np.ndarray, good: np.ndarray) -> np.ndarray:
        out = np.zeros(len(good), values.dtype)
        out[good] = values
        return out

    def bad_texts(self, numbers: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        return np.logical_or.reduceat(self.bad[numbers], np.cumsum(lengths) - lengths) if len(numbers) else np.zeros(0, bool)


def count_pairs(texts: DataFrame, byte_bpe: str, piece_bpe: bytes) -> DataFrame:
    """(pair, n): how often tokens of a task's texts end together, ``pair_code`` of their ids. Not yet summed over tasks."""
    shared = texts.sparkSession.sparkContext.broadcast((byte_bpe, piece_bpe))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair, links = Pair(*shared.value), []

        def learned(found: Aligned) -> dict[str, np.ndarray]:
            links.append(found.links())
            return {"n": found.n_links}

        known, uses = _Known(pair, learned), np.zeros(0, np.int64)

        def counted() -> pa.RecordBatch:
            codes, at = np.unique(np.concatenate(links), return_inverse=True)
            sums = np.bincount(at, weights=np.repeat(uses, known.columns["n"]), minlength=len(codes))  # exact below 2^53
            some = sums > 0
            return pa.RecordBatch.from_arrays([pa.array(codes[some].view(np.int64)), pa.array(sums[some].astype(np.int64))], names=["pair", "n"])

        for rows in batches:
            for some in _texts(rows.column(0)):
                numbers, lengths = known.learn([pair.parts(t) for t in some if t])
                good = np.repeat(~known.bad_texts(numbers, lengths), lengths)
                uses = np.concatenate([uses, np.zeros(len(known.number) - len(uses), np.int64)])
                uses += np.bincount(numbers[good], minlength=len(uses))
                if known.full():
                    yield counted()
                    known.forget()
                    links.clear()
                    uses = np.zeros(0, np.int64)
        if known.number:
            yield counted()

    return in_tasks(texts, run, StructType([StructField("pair", LongType()), StructField("n", LongType())]))


def _mixed(keys: np.ndarray, level: int) -> np.ndarray:
    x = keys ^ np.uint64((level + 1) * 0x9E3779B97F4A7C15 & (1 << 64) - 1)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):  # fixed values of a well-known bit mixer
        x = (x ^ x >> np.uint64(shift)) * np.uint64(factor)
    return x ^ x >> np.uint64(31)


class PerfectHash:
    """Numbers n distinct keys from 0 to n - 1 in a few bits for each.

    A level has ``GAMMA`` bits per key; a key that is alone at its place sets the bit and is
    done, the others go on to the next level. A key's number is the rank of its bit.
    """

    def __init__(self, keys: np.ndarray):
        self.levels: list[tuple[int, int, np.ndarray, np.ndarray]] = []  # places, rank before, bits, rank before each word
        done, left = 0, keys
        while len(left):
            places = max(64, GAMMA * len(left))
            at = _mixed(left, len(self.levels)) % np.uint64(places)
            alone = np.bincount(at.astype(np.int64), minlength=places) == 1
            bits = np.packbits(alone, bitorder="little")
            bits = np.concatenate([bits, np.zeros(-len(bits) % 8, np.uint8)]).view("<u8")
            ranks = np.concatenate([[0], np.cumsum(np.bitwise_count(bits), dtype=np.int64)])
            self.levels.append((places, done, bits, ranks[:-1]))
            done += int(ranks[-1])
            left = left[~alone[at.astype(np.int64)]]
        self.size = done

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        """The number of each key; of others any number, or -1."""
        out = np.full(len(keys), -1, np.int64)
        left = np.arange(len(keys))
        for level, (places, done, bits, ranks) in enumerate(self.levels):
            at = _mixed(keys[left], level) % np.uint64(places)
            word, bit = (at >> np.uint64(6)).astype(np.int64), at & np.uint64(63)
            mine = (bits[word] >> bit & np.uint64(1)).astype(bool)
            below = np.bitwise_count(bits[word] & ((np.uint64(1) << bit) - np.uint64(1)))
            out[left[mine]] = (done + ranks[word] + below)[mine]
            left = left[~mine]
            if not len(left):
                break
        return out


class PairCounts:
    """Counts of pairs by their number, with the pairs themselves to verify a look-up."""

    def __init__(self, keys: np.ndarray):
        self.hash = PerfectHash(keys)
        self.keys = np.empty(len(keys), np.uint64)
        self.keys[self.hash(keys)] = keys
        self.counts = np.zeros(len(keys), np.int64)
        self.best: np.ndarray | None = None

    def fill(self, counts: np.ndarray) -> None:
        """All counts, and with them the highest of each second id."""
        second = (self.keys & np.uint64(0xFFFFFFFF)).astype(np.int64)
        self.counts, self.best = counts, np.zeros(int(second.max(initial=0)) + 1, np.int64)
        np.maximum.at(self.best, second, counts)

    def numbers(self, keys: np.ndarray) -> np.ndarray:
        """Numbers of the keys, -1 for those that are not in the table."""
        if not len(self.keys):
            return np.full(len(keys), -1, np.int64)
        at = self.hash(keys)
        return np.where((at >= 0) & (self.keys[at] == keys), at, -1)

    def look_up(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(count, 1 if it is the highest of the second id) of each key; 0 for others."""
        at = self.numbers(keys)
        found = np.where(at >= 0, self.counts[at], 0) if len(self.counts) else np.zeros(len(keys), np.int64)
        second = (keys & np.uint64(0xFFFFFFFF)).astype(np.int64)
        return found, ((at >= 0) & (found == self.best[np.minimum(second, len(self.best) - 1)])).astype(np.int64)


def tree_sum(partial: DataFrame, table: PairCounts) -> np.ndarray:
    """Counts of the table's pairs: each task adds up a dense vector by number, slices of which are summed in a tree."""
    shared = partial.sparkSession.sparkContext.broadcast(table)
    size = len(table.keys)

    def width(part: int) -> int:
        return min(SLICE, size - part * SLICE)

    def leaf(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            at = shared.value.numbers(batch.column(0).to_numpy().view(np.uint64))
            total = np.zeros(size, np.int64) if total is None else total
            np.add.at(total, at[at >= 0], batch.column(1).to_numpy()[at >= 0])
        for part in range(-(-size // SLICE) if total is not None else 0):
            some = total[part * SLICE : (part + 1) * SLICE]
            if some.any():
                yield pa.RecordBatch.from_pylist([{"part": part, "node": TaskContext.get().partitionId(), "counts": zstandard.compress(some.tobytes())}], schema=target)

    def node(table: pa.Table) -> pa.Table:
        part, number = table.column("part")[0].as_py(), table.column("node")[0].as_py()
        total = np.zeros(width(part), np.int64)
        for counts in table.column("counts"):
            total += np.frombuffer(zstandard.decompress(counts.as_py()), np.int64)
        return pa.Table.from_pylist([{"part": part, "node": number, "counts": zstandard.compress(total.tobytes())}], schema=target)

    schema = "part int, node int, counts binary"
    target = pa.schema([("part", pa.int32()), ("node", pa.int32()), ("counts", pa.binary())])
    nodes = stored(in_tasks(partial, leaf, StructType.fromDDL(schema)), "counts")
    last = nodes.agg(F.max("node")).first()[0] or 0
    while last:
        nodes = nodes.withColumn("node", F.expr(f"node div {FAN_IN}").cast("int")).groupBy("part", "node").applyInArrow(node, schema)
        last //= FAN_IN
    out = np.zeros(size, np.int64)
    for row in nodes.toLocalIterator():  # at most MAX_PAIRS counts in all
        out[row["part"] * SLICE : row["part"] * SLICE + width(row["part"])] = np.frombuffer(zstandard.decompress(bytes(row["counts"])), np.int64)
    return out


def _tables(partial: DataFrame, max_pairs: int) -> Iterator[PairCounts]:
    """Counts of all distinct pairs, in as many tables as it takes for at most ``max_pairs`` each; a second id is in one table."""
    distinct = stored(partial.select("pair").distinct().withColumn("second", F.col("pair").bitwiseAND(F.lit(0xFFFFFFFF).cast("long"))), "pairs")
    parts = 1
    while True:
        dealt = F.pmod(F.xxhash64("second"), F.lit(parts))
        most = distinct.groupBy(dealt.alias("part")).count().agg(F.max("count")).first()[0] or 0
        alone = distinct.agg(F.count_distinct("second")).first()[0] <= 1
        if most <= max_pairs or alone:
            break
        parts *= 2
    for part in range(parts):
        keys = distinct.where(dealt == part).select("pair").toArrow().column(0).to_numpy().view(np.uint64)
        table = PairCounts(np.sort(keys))
        mine = F.pmod(F.xxhash64(F.col("pair").bitwiseAND(F.lit(0xFFFFFFFF).cast("long"))), F.lit(parts)) == part
        table.fill(tree_sum(partial.where(mine), table))
        yield table


_NUMBERS = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")


def _look_up(docs: DataFrame, byte_bpe: str, piece_bpe: bytes, table: PairCounts) -> DataFrame:
    """``docs`` (doc_id, text, numbers, groups) aligned again, with the table's counts added."""
    shared = docs.sparkSession.sparkContext.broadcast((byte_bpe, piece_bpe, table))
    target = to_arrow_schema(docs.schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        *models, table = shared.value
        pair = Pair(*models)
        signs = [f"{i}{x}" for i in range(len(pair.a_bytes)) for x in ",|"] + [f"{i}{x}" for i in range(len(pair.b_bytes)) for x in ",;"]

        def learned(found: Aligned) -> dict[str, np.ndarray]:
            counts, best = table.look_up(found.links())
            starts = np.cumsum(found.n_links) - found.n_links
            sums = [np.add.reduceat(x, starts) if len(starts) else x for x in (best, counts)]
            texts = np.array(found.texts(signs, 2 * len(pair.a_bytes)) + [""], object)[:-1]
            return dict(zip(_NUMBERS, (found.n_a, found.n_b, found.n_links, found.n_links, *sums))) | {"groups": texts}

        known = _Known(pair, learned)
        for batch in batches:
            at, before = 0, [batch.column(c).to_numpy() for c in ("n_best", "count_sum")]
            for some in _texts(batch.column("text")):
                if known.full():
                    known.forget()
                filled = np.array([bool(t) for t in some], bool)
                numbers, lengths = known.learn([pair.parts(t) for t in some if t])
                bad, starts = known.bad_texts(numbers, lengths), np.cumsum(lengths) - lengths
                columns = []
                for name in _NUMBERS:
                    column = np.zeros(len(some), np.int64)
                    if len(numbers):
                        column[filled] = np.where(bad, 0, np.add.reduceat(known.columns[name][numbers], starts))
                    columns.append(column)
                for k in (0, 1):
                    columns[4 + k] += before[k][at : at + len(some)]
                texts = known.columns["groups"][numbers].tolist() if len(numbers) else []
                groups = ["" if b else ";".join(texts[i : i + n]) for b, i, n in zip(bad.tolist(), starts.tolist(), lengths.tolist())]
                whole = iter(groups)
                arrays = [batch.column(0).slice(at, len(some)), batch.column(1).slice(at, len(some)), *[pa.array(c) for c in columns]]
                yield pa.RecordBatch.from_arrays([*arrays, pa.array([next(whole) if f else "" for f in filled], pa.string())], schema=target)
                at += len(some)

    return in_tasks(docs, run, docs.schema)


def align(docs: DataFrame, byte_bpe: str = BYTE_BPE, piece_bpe: str = PIECE_BPE, max_pairs: int = MAX_PAIRS) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups) of every row.

    A text is encoded with a space before it by the byte-level vocabulary (A) and the piece
    vocabulary (B). Where tokens of both end, ``groups`` is cut (``a1,a2|b1;a3|b2,b3``) and the
    two tokens that end there are a link. A pair's count is its number of links in all rows;
    ``n_best`` counts the row's links whose count is the highest of their B id, ``count_sum``
    adds up their counts. Null and empty texts, and texts that the tokens of A or B do not
    make up, have no tokens: zeros and ''. Repeated rows count as often as they occur; other
    columns are not read; an empty table gives an empty result.

    The first pass counts pairs within tasks; distinct pairs get numbers by a minimal perfect
    hash, and dense vectors of counts are summed in a tree. The second pass aligns the texts
    again and looks counts up in the broadcast vector. A vector has at most ``max_pairs``
    counts; if there are more pairs, they are dealt by B id, and a pass is made for each part.
    """
    with open(byte_bpe, encoding="utf-8") as f:
        first = f.read()
    with open(piece_bpe, "rb") as f:
        second = f.read()
    partial = stored(count_pairs(docs.select("text"), first, second), "links")
    rows = docs.select("doc_id", "text", *[F.lit(0).cast("long").alias(c) for c in _NUMBERS], F.lit("").alias("groups"))
    tables = _tables(partial, max_pairs)
    table = next(tables)
    for more in tables:
        rows = stored(_look_up(rows, first, second, table), "aligned")
        table = more
    return _look_up(rows, first, second, table).drop("text")


@query("op13_token_alignment")
def op13(t):
    found = align(t.documents)
    digest = F.when(F.col("n_a") > 0, F.sha2("groups", 256)).otherwise("")
    return found.select("doc_id", *_NUMBERS, digest.alias("groups_sha256"))
