"""Substring dedup: passages of many words that recur are confirmed, compiled into automata and located everywhere."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import compress

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import (
    BinaryType,
    BooleanType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
)

from .common import in_tasks, stored
from .registry import query

WINDOW = 50
ANCHOR = 8  # words of an anchor, the least of a window by hash
TILE = 10  # words of a pattern
PIECE = 128  # windows of a piece
SHARD_CHARS = 8 << 20
BUCKET_CHARS = 32 << 20
HOT_ROWS = 10_000
_CHUNK_CHARS = 1 << 20
_CACHED = 300_000
_ROWS_OUT = 2_000

# Fixed value: an odd factor of the rolling sums, modulo 2^64.
_FACTOR = 0x9E3779B97F4A7C15
_INVERSE = pow(_FACTOR, -1, 1 << 64)


class WordHashes(dict):
    """64-bit hash of a word, kept while there is room."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > _CACHED:
            self.clear()
        found = self[word] = xxhash.xxh64_intdigest(word)
        return found


class Rolling:
    """Hashes of all runs of ``size`` consecutive values, by differences of prefix sums."""

    def __init__(self):
        self.up = self.down = np.ones(1, np.uint64)

    def _powers(self, n: int) -> None:
        if len(self.up) < n:
            n = 1 << n.bit_length()
            self.up, self.down = (np.concatenate([np.ones(1, np.uint64), np.cumprod(np.full(n, x, np.uint64))]) for x in (_FACTOR, _INVERSE))

    def sums(self, values: np.ndarray) -> np.ndarray:
        self._powers(len(values) + 1)
        return np.concatenate([np.zeros(1, np.uint64), np.cumsum(values * self.up[: len(values)], dtype=np.uint64)])

    def runs(self, sums: np.ndarray, size: int) -> np.ndarray:
        n = max(0, len(sums) - size)
        return (sums[size:] - sums[:n]) * self.down[:n]


def least_of(values: np.ndarray, size: int) -> np.ndarray:
    """Least of each ``size`` consecutive values."""
    n, width = max(0, len(values) - size + 1), 1
    while 2 * width <= size:
        values = np.minimum(values[:-width], values[width:])
        width *= 2
    return np.minimum(values[:n], values[size - width : size - width + n])


class Windows:
    """Digest and anchor of every window of some texts."""

    def __init__(self, window: int):
        self.window, self.anchor, self.hashes, self.rolling = window, min(ANCHOR, window), WordHashes(), Rolling()

    def of(self, texts: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(number of the text, first word, digest, anchor) of the windows of texts given as words."""
        lengths = np.array([len(t) for t in texts], np.int64)
        total = int(lengths.sum())
        if total < self.window:
            return (np.zeros(0, np.int64),) * 2 + (np.zeros(0, np.uint64),) * 2
        values = np.fromiter((h for t in texts for h in map(self.hashes.__getitem__, t)), np.uint64, total)
        sums = self.rolling.sums(values)
        digests = self.rolling.runs(sums, self.window)
        anchors = least_of(self.rolling.runs(sums, self.anchor), self.window - self.anchor + 1)
        owner, starts = np.repeat(np.arange(len(texts)), lengths), np.repeat(np.cumsum(lengths) - lengths, lengths)
        whole = np.flatnonzero(owner[: len(digests)] == owner[self.window - 1 :])
        return owner[whole], whole - starts[whole], digests[whole], anchors[whole]


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode().split()  # of bytes, this cuts at \x20 and \x09-\x0D and nowhere else


def _chunks(texts: list[str | None]) -> Iterator[tuple[int, list[str | None]]]:
    """(place of the first, texts) of about ``_CHUNK_CHARS`` characters."""
    begin, held = 0, 0
    for i, text in enumerate(texts):
        held += len(text or "")
        if held >= _CHUNK_CHARS or i + 1 == len(texts):
            yield begin, texts[begin : i + 1]
            begin, held = i + 1, 0


def _segments(*columns: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges of rows in which no column changes."""
    n = len(columns[0])
    if n:
        changed = np.zeros(n, bool)
        for c in columns:
            changed[1:] |= c[1:] != c[:-1]
        cuts = [0, *np.flatnonzero(changed).tolist(), n]
        yield from zip(cuts, cuts[1:])


def ranks(*columns: pa.Array) -> list[np.ndarray]:
    """Places of the values of all columns in one order; equal values share theirs, missing ones come last."""
    both = pa.chunked_array(columns).combine_chunks()
    found = np.asarray(pc.rank(both, sort_keys="ascending", null_placement="at_end", tiebreaker="dense")).astype(np.int64)
    cuts = np.cumsum([0, *[len(c) for c in columns]])
    return [found[a:b] for a, b in zip(cuts, cuts[1:])]


def _anchors(rows: DataFrame, window: int) -> DataFrame:
    """(anchor, shard, doc_id): a row for each run of windows of a text that share their anchor."""
    schema = StructType([StructField("anchor", LongType()), StructField("shard", IntegerType()), rows.schema["doc_id"]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = Windows(window)
        for batch in batches:
            for first, texts in _chunks(batch.column(2).to_pylist()):
                owner, _, _, anchors = found.of([words_of(t) for t in texts])
                begins = np.array([a for a, _ in _segments(owner, anchors)], np.int64)
                at = pa.array(owner[begins] + first)
                yield pa.RecordBatch.from_arrays([pa.array(anchors[begins].view(np.int64)), batch.column(0).take(at), batch.column(1).take(at)], names=schema.names)

    return in_tasks(rows.select("shard", "doc_id", "text"), run, schema)


def _by_shard(first: DataFrame, second: DataFrame) -> DataFrame:
    """Rows of both, all of a shard in one partition and there those of ``first`` before those of ``second``."""
    both = first.withColumn("second", F.lit(False)).unionByName(second.withColumn("second", F.lit(True)), allowMissingColumns=True)
    return both.repartition("shard").sortWithinPartitions("shard", "second")


# What one pass over the shards finds; a row has a text, a piece of a text, or windows.
def _found_schema(doc_id) -> StructType:
    return StructType(
        [
            StructField("shard", IntegerType()),
            StructField("doc_id", doc_id),
            StructField("text", StringType()),  # words with one space between them
            StructField("suspect", BooleanType()),
            StructField("piece", LongType()),
            StructField("words", StringType()),
            StructField("bucket", IntegerType()),
            StructField("anchor", LongType()),
            StructField("last_id", doc_id),
            StructField("digests", BinaryType()),
        ]
    )


class _Shard:
    """The windows of a shard that contain a recurring anchor, and the pieces of text they lie in."""

    def __init__(self, number: int, window: int, buckets: int, target: pa.Schema):
        self.number, self.window, self.buckets, self.target = number, window, buckets, target
        self.anchors, self.hot = [], []
        self.known: np.ndarray | None = None
        self.pieces, self.ids, self.parts = 0, [], []

    def expect(self, anchors: np.ndarray, hot: np.ndarray) -> None:
        self.anchors.append(anchors)
        self.hot.append(anchors[hot])

    def _rows(self, n: int, **columns) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) if f.name in columns else pa.nulls(n, f.type) for f in self.target], schema=self.target)

    def texts(self, windows: Windows, doc_ids: list, texts: list[str | None]) -> Iterator[pa.RecordBatch]:
        if self.known is None:
            self.known = np.unique(np.concatenate(self.anchors)) if self.anchors else np.zeros(0, np.uint64)
        words = [words_of(t) for t in texts]
        owner, at, digests, anchors = windows.of(words)
        place = np.minimum(np.searchsorted(self.known, anchors), max(0, len(self.known) - 1))
        mine = np.flatnonzero(self.known[place] == anchors) if len(self.known) else np.zeros(0, np.int64)
        owner, at, digests, anchors = owner[mine], at[mine], digests[mine], anchors[mine]
        suspects = np.zeros(len(texts), bool)
        suspects[owner] = True
        lines = [b" ".join(w).decode() for w in words]
        yield self._rows(len(texts), shard=[self.number] * len(texts), doc_id=doc_ids, text=lines, suspect=suspects)
        if not len(owner):
            return
        starts = [(int(owner[a]), int(at[a]) // PIECE) for a, _ in _segments(owner, at // PIECE)]
        numbers = (self.number << 32) + self.pieces + np.arange(len(starts))
        self.pieces += len(starts)
        parts = [b" ".join(words[d][j * PIECE : (j + 1) * PIECE + self.window - 1]).decode() for d, j in starts]
        yield self._rows(len(parts), shard=[self.number] * len(parts), doc_id=[doc_ids[d] for d, _ in starts], piece=numbers, words=parts)
        piece = np.repeat(numbers, [b - a for a, b in _segments(owner, at // PIECE)])
        self.parts.append((anchors, digests, piece, owner + len(self.ids)))
        self.ids += doc_ids

    def windows(self) -> Iterator[pa.RecordBatch]:
        """The distinct windows: the piece of the first document that holds one, and the last document."""
        if not self.parts:
            return
        anchors, digests, piece, owner = (np.concatenate(x) for x in zip(*self.parts))
        (rank,) = ranks(pa.array(self.ids, self.target.field("doc_id").type))
        order = np.lexsort((rank[owner], digests, anchors))
        anchors, digests, piece, owner = anchors[order], digests[order], piece[order], owner[order]
        ranges = np.array(list(_segments(anchors, digests)))
        first, last = ranges[:, 0], ranges[:, 1] - 1
        anchors, digests, piece, last, first = anchors[first], digests[first], piece[first], owner[last], owner[first]
        hot = np.isin(anchors, np.concatenate(self.hot))
        dealt = np.where(hot, anchors ^ digests * np.uint64(_FACTOR), anchors) * np.uint64(_FACTOR)
        bucket = ((dealt >> np.uint64(33)) % np.uint64(self.buckets)).astype(np.int64)
        order = np.lexsort((last, piece, anchors, bucket))
        anchors, digests, piece, first, last, bucket = (x[order] for x in (anchors, digests, piece, first, last, bucket))
        cuts = list(_segments(bucket, anchors, piece, last))
        for k in range(0, len(cuts), _ROWS_OUT):
            some = cuts[k : k + _ROWS_OUT]
            at = [a for a, _ in some]
            yield self._rows(
                len(some), shard=[self.number] * len(some), bucket=bucket[at], anchor=anchors[at].view(np.int64), piece=piece[at],
                doc_id=[self.ids[i] for i in first[at]], last_id=[self.ids[i] for i in last[at]], digests=[digests[a:b].tobytes() for a, b in some],
            )


def _suspects(rows: DataFrame, wanted: DataFrame, window: int, buckets: int) -> DataFrame:
    """Texts, pieces and windows (``_found_schema``) of all shards, from (shard, doc_id, text) and (shard, anchor, hot)."""
    schema = _found_schema(rows.schema["doc_id"].dataType)
    target = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        windows, shard = Windows(window), None
        for batch in batches:
            number, second = batch.column("shard").to_numpy(), batch.column("second").to_numpy(zero_copy_only=False)
            for a, b in _segments(number, second):
                if shard is None or shard.number != number[a]:
                    if shard is not None:
                        yield from shard.windows()
                    shard = _Shard(int(number[a]), window, buckets, target)
                part = batch.slice(a, b - a)
                if second[a]:
                    ids = part.column("doc_id").to_pylist()
                    for first, texts in _chunks(part.column("text").to_pylist()):
                        yield from shard.texts(windows, ids[first : first + len(texts)], texts)
                else:
                    shard.expect(part.column("anchor").to_numpy().view(np.uint64), part.column("hot").to_numpy(zero_copy_only=False).astype(bool))
        if shard is not None:
            yield from shard.windows()

    return in_tasks(_by_shard(wanted, rows), run, schema)


def _requests(found: DataFrame) -> DataFrame:
    """(piece, shard): the shard has a document with a window that the piece, of a document with a smaller id, holds too."""

    def confirm(table: pa.Table) -> pa.Table:
        packed = table.column("digests").to_pylist()
        digests = np.frombuffer(b"".join(packed), np.uint64)
        row = np.repeat(np.arange(len(packed)), [len(d) // 8 for d in packed])
        first, last = ranks(*(table.column(c).combine_chunks() for c in ("doc_id", "last_id")))
        anchor, piece, shard = (table.column(c).to_numpy() for c in ("anchor", "piece", "shard"))
        order = np.lexsort((first[row], digests, anchor[row]))
        row, digests = row[order], digests[order]
        ranges = list(_segments(anchor[row], digests))
        lead = np.repeat(np.array([row[a] for a, _ in ranges], np.int64), [b - a for a, b in ranges])
        later = last[row] > first[lead]
        pairs = np.unique(np.stack([piece[lead[later]], shard[row[later]].astype(np.int64)]), axis=1)
        return pa.table({"piece": pa.array(pairs[0], pa.int64()), "shard": pa.array(pairs[1].astype(np.int32), pa.int32())})

    windows = found.where("digests is not null").select("bucket", "anchor", "piece", "shard", "doc_id", "last_id", "digests")
    return windows.groupBy("bucket").applyInArrow(confirm, "piece long, shard int").distinct()


class Automaton:
    """Locates passages, each of ``window`` words or more, in texts given as words with one space between them.

    Of every passage the first ``TILE`` words of each step are a pattern, with steps so short
    that every window holds a whole one; what is found is compared with the passage word by
    word to both sides.
    """

    def __init__(self, passages: list[tuple[object, str]], window: int):
        self.window, tile = window, min(TILE, window)
        self.tile = tile
        self.passages: list[tuple[object, list[str]]] = []
        places: dict[str, list[tuple[int, int]]] = {}
        for k, (doc_id, text) in enumerate(passages):
            words = text.split(" ")
            self.passages.append((doc_id, words))
            for at in range(0, len(words) - tile + 1, window - tile + 1):
                places.setdefault(f" {' '.join(words[at : at + tile])} ", []).append((k, at))
        self.machine = ahocorasick.Automaton()
        for pattern, at in places.items():
            self.machine.add_word(pattern, (len(pattern), at))
        if places:
            self.machine.make_automaton()

    def covered(self, doc_id: object, text: str) -> tuple[list[str], bytearray]:
        """The words of a text, and for each 1 if a window over it is in a passage of a smaller doc_id (a missing one is the largest)."""
        words = text.split(" ") if text else []
        marks = bytearray(len(words))
        if not len(self.machine) or len(words) < self.window:
            return words, marks
        starts, done, n = None, {}, len(words)
        for end, (length, places) in self.machine.iter(f" {text} "):
            if starts is None:
                starts = np.cumsum([0, *[len(w) + 1 for w in words]])
            at = int(np.searchsorted(starts, end - length + 1))
            for k, offset in places:
                other, passage = self.passages[k]
                if other is None or (doc_id is not None and other >= doc_id) or done.get((k, at - offset), -1) > at:
                    continue
                if 0 not in marks[max(0, at - offset) : at - offset + len(passage)]:
                    continue
                a, b, shift = at, at + self.tile, offset - at
                while a > 0 and a + shift > 0 and words[a - 1] == passage[a + shift - 1]:
                    a -= 1
                while b < n and b + shift < len(passage) and words[b] == passage[b + shift]:
                    b += 1
                done[k, at - offset] = b
                if b - a >= self.window:
                    marks[a:b] = b"\x01" * (b - a)
        return words, marks


def _locate(texts: DataFrame, passages: DataFrame, window: int, schema: StructType) -> DataFrame:
    """Stream the texts of each shard through the automaton of its passages."""
    target = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, held, automaton = None, [], None
        for batch in batches:
            number, second = batch.column("shard").to_numpy(), batch.column("second").to_numpy(zero_copy_only=False)
            for a, b in _segments(number, second):
                if number[a] != current:
                    current, held, automaton = number[a], [], None
                part = batch.slice(a, b - a)
                if not second[a]:
                    held += zip(part.column("doc_id").to_pylist(), part.column("words").to_pylist())
                    continue
                if automaton is None:
                    automaton, held = Automaton(held, window), []
                ids, rows = part.column("doc_id").to_pylist(), []
                for doc_id, text in zip(ids, part.column("text")):
                    words, marks = automaton.covered(doc_id, text.as_py())
                    gone = sum(marks)
                    rows.append((len(words), gone, " ".join(compress(words, (not m for m in marks))) if gone else " ".join(words)))
                n, gone, kept = zip(*rows)
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(n, pa.int64()), pa.array(gone, pa.int64()), pa.array(kept, pa.string())], schema=target)

    return in_tasks(_by_shard(passages, texts), run, schema)


def remove_repeats(docs: DataFrame, window: int = WINDOW, shard_chars: int = SHARD_CHARS, bucket_chars: int = BUCKET_CHARS) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_text) of every row; words that a repeated window covers are removed.

    A window is ``window`` consecutive words; it is removed where a row with a smaller doc_id
    has the same words in a row. Rows of one doc_id do not remove each other's words, a
    missing doc_id is larger than all others. Null, empty and white texts have no words;
    ``kept_text`` has one space between words. Repeated rows each get their result; other
    columns are not read; an empty table gives an empty result.

    1. Every window has an anchor, the eight words in it whose hash is least, so equal windows
       have equal anchors, and neighbours mostly share theirs. Anchors of two or more doc_ids recur.
    2. Texts are dealt into shards of about ``shard_chars``. Digests of windows whose anchor
       recurs are compared, a bucket of anchors at a time (those of an anchor in very many
       documents by digest): the piece of text around a window's first holder is a passage.
    3. Each shard compiles an automaton of the passages that it shares a window with and
       streams its texts through it; a match is compared word by word.

    Memory is bounded by shards and buckets, whose number grows with the input; nothing but
    the size of the input comes to the driver.
    """
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    chars = rows.agg(F.sum(F.length("text"))).first()[0] or 0
    shards, buckets = max(1, chars // shard_chars), max(1, chars // bucket_chars)
    rows = rows.withColumn("shard", F.pmod(F.xxhash64("doc_id", "text"), F.lit(shards)).cast("int"))

    anchors = _anchors(rows, window)
    holders = anchors.groupBy("anchor").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high"), F.count("doc_id").alias("known"), F.count(F.lit(1)).alias("n"))
    recurring = holders.where("low < high or (low is not null and known < n)").select("anchor", (F.col("n") > HOT_ROWS).alias("hot"))
    # Stored, so that the join's sides are plain shuffles and an anchor in very many texts can be split.
    wanted = anchors.join(stored(recurring, "anchors"), "anchor").select("shard", "anchor", "hot")

    found = stored(_suspects(rows, wanted, window, buckets), "windows")
    pieces = found.where("words is not null").select("piece", "doc_id", "words")
    passages = stored(_requests(found), "requests").join(pieces, "piece").select("shard", "doc_id", "words")

    schema = StructType([docs.schema["doc_id"], StructField("n_words", LongType()), StructField("n_removed", LongType()), StructField("kept_text", StringType())])
    texts = found.where("suspect is not null")
    clean = texts.where("not suspect")
    n_words = F.when(F.col("text") == "", 0).otherwise(F.regexp_count("text", F.lit(" ")) + 1).cast("long")
    clean = clean.select("doc_id", n_words.alias("n_words"), F.lit(0).cast("long").alias("n_removed"), F.col("text").alias("kept_text"))
    return clean.unionByName(_locate(texts.where("suspect").select("shard", "doc_id", "text"), passages, window, schema))


@query("op11_substring_dedup", sql=r"""
with tokens as (
  select doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') as words from documents
), windows as (
  select doc_id, i, md5(array_to_string(words[i : i + 49], ' ')) as digest
  from (select doc_id, words, unnest(range(1, len(words) - 48)) as i from tokens where len(words) >= 50)
), firsts as (
  select digest, min(doc_id) as first_id from windows group by digest having count(distinct doc_id) > 1
), covered as (
  select distinct doc_id, unnest(range(i, i + 50)) as nth
  from windows join firsts using (digest) where first_id < doc_id
), flat as (
  select doc_id, unnest(range(1, len(words) + 1)) as nth, unnest(words) as word from tokens
), kept as (
  select f.doc_id, count(*) as n_words, cast(count(c.nth) as bigint) as n_removed,
         string_agg(f.word, ' ' order by f.nth) filter (where c.nth is null) as kept_text
  from flat f left join covered c on f.doc_id = c.doc_id and f.nth = c.nth group by f.doc_id
)
select t.doc_id, coalesce(k.n_words, 0) as n_words, coalesce(k.n_removed, 0) as n_removed, sha256(coalesce(k.kept_text, '')) as kept_sha256
from tokens t left join kept k on t.doc_id = k.doc_id
""")
def op11(t):
    found = remove_repeats(t.documents)
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))
