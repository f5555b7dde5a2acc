"""Line dedup: two Bloom filters tell once-seen from twice-seen lines; only suspects are shuffled."""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import md5

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
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

MIN_CHARS = 40
MIN_DOCS = 5
LINES_PER_DOC = 64
LEAST_BITS, MOST_BITS = 1 << 20, 1 << 28
PROBES = 3
_SPACE = b" \t\n\x0b\x0c\r"
_SHARD = 1 << 20


def key_of(line: bytes, min_chars: int = MIN_CHARS) -> bytes | None:
    """The key of a line in UTF-8, None where it has under ``min_chars`` code points."""
    if len(line) < min_chars:
        return None
    key = line.strip(_SPACE).lower()
    if len(key) < min_chars:
        return None
    if len(key) < 4 * min_chars and not key.isascii() and len(key.decode()) < min_chars:
        return None
    return key


def _keys(text: str | None, min_chars: int) -> set[bytes]:
    return {k for line in (text or "").encode().split(b"\n") if (k := key_of(line, min_chars)) is not None}


def filter_bits(rows: int) -> tuple[int, int]:
    """(bits of a filter, rounds) for so many documents: a power of two between fixed bounds, and beyond them several rounds over ranges of hashes."""
    wanted = max(LEAST_BITS, 1 << (rows * LINES_PER_DOC).bit_length())
    return min(MOST_BITS, wanted), max(1, wanted // MOST_BITS)


def _in_round(hashes: np.ndarray, turn: int, rounds: int) -> np.ndarray:
    return (hashes >> np.uint64(40)) % np.uint64(rounds) == turn


def _holds(filter_: np.ndarray, hashes: np.ndarray, bits: int) -> np.ndarray:
    """Which hashes have all their probes in a packed filter."""
    at = _probes(hashes, bits)
    return (filter_[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8) & 1).astype(bool).all(axis=0)


def _set(filter_: np.ndarray, hashes: np.ndarray, bits: int) -> None:
    at = _probes(hashes, bits).ravel()
    np.bitwise_or.at(filter_, at >> np.uint64(3), np.uint8(1) << (at & np.uint64(7)).astype(np.uint8))


def _probes(hashes: np.ndarray, bits: int) -> np.ndarray:
    low, high = hashes & np.uint64(0xFFFFFFFF), hashes >> np.uint64(32) | np.uint64(1)
    return np.stack([(low + np.uint64(i) * high) & np.uint64(bits - 1) for i in range(PROBES)])


def _hashes(texts: pa.Array, min_chars: int) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """(key, row, hash) of every different key of each row."""
    keys, rows = [], []
    for row, text in enumerate(texts):
        mine = _keys(text.as_py(), min_chars)
        keys += mine
        rows += [row] * len(mine)
    return keys, np.array(rows, np.int64), np.array([xxhash.xxh64_intdigest(k) for k in keys], np.uint64)


def twice_seen(docs: DataFrame, bits: int, min_chars: int = MIN_CHARS, turn: int = 0, rounds: int = 1) -> np.ndarray:
    """Packed filter of ``bits`` bits in which every key of the round that at least two rows have has all its probes set.

    Each task fills a once-seen and a twice-seen filter; shards of them are merged by
    twice |= other twice | once & other once. A repeated key is never missed; others may be
    taken for repeated, the more the fuller the filters are.
    """
    size = min(bits, _SHARD) // 8
    schema = StructType([StructField("shard", IntegerType()), StructField("once", BinaryType()), StructField("twice", BinaryType())])

    def packed(part: np.ndarray) -> bytes:
        return zstandard.compress(part.tobytes(), 1)

    def unpacked(value: bytes) -> np.ndarray:
        return np.frombuffer(zstandard.decompress(value), np.uint8)

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        once, twice = np.zeros(bits // 8, np.uint8), np.zeros(bits // 8, np.uint8)
        for batch in batches:
            _, _, hashes = _hashes(batch.column(0), min_chars)
            found, counts = np.unique(hashes[_in_round(hashes, turn, rounds)], return_counts=True)
            _set(twice, found[(counts > 1) | _holds(once, found, bits)], bits)
            _set(once, found, bits)
        for shard in range(bits // 8 // size):
            mine = slice(shard * size, (shard + 1) * size)
            if once[mine].any():
                yield pa.RecordBatch.from_arrays(
                    [pa.array([shard], pa.int32()), pa.array([packed(once[mine])]), pa.array([packed(twice[mine])])], names=schema.names
                )

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[np.ndarray]] = {}
        for batch in batches:
            for shard, once, twice in zip(*(c.to_pylist() for c in batch.columns)):
                new = unpacked(once)
                mine = held.setdefault(shard, [np.zeros(size, np.uint8), np.zeros(size, np.uint8)])
                mine[1] |= unpacked(twice) | (mine[0] & new)
                mine[0] |= new
        for shard, (_, twice) in held.items():
            yield pa.RecordBatch.from_arrays([pa.array([shard], pa.int32()), pa.array([b""]), pa.array([packed(twice)])], names=schema.names)

    out = np.zeros(bits // 8, np.uint8)
    shards = in_tasks(in_tasks(docs.select("text"), fill, schema).repartition("shard"), merge, schema)
    for row in shards.toLocalIterator():  # at most MOST_BITS bits in all
        out[row["shard"] * size : (row["shard"] + 1) * size] = unpacked(bytes(row["twice"]))
    return out


def repeated_lines(docs: DataFrame, min_docs: int = MIN_DOCS, min_chars: int = MIN_CHARS) -> tuple[DataFrame, DataFrame, list]:
    """(suspects, confirmed, filters): (key, doc_id, part, a hash of the text) of suspected lines, (key, last) of keys in ``min_docs`` documents or more, and the filters that made suspects.

    ``key`` is a 128-bit digest of the line's key. Only suspects are shuffled, counted per
    task first, so a line that every document holds is a few rows.
    """
    bits, rounds = filter_bits(docs.count())
    id_field = StructField("doc_id", docs.schema["doc_id"].dataType)
    hashed = docs.select("doc_id", "text", F.xxhash64("text").alias("part"))
    schema = StructType([StructField("key", BinaryType()), id_field, StructField("part", LongType())])
    filters, suspects = [], None
    for turn in range(rounds):
        shared = docs.sparkSession.sparkContext.broadcast(twice_seen(docs, bits, min_chars, turn, rounds))
        filters.append((shared, bits, turn, rounds))

        def suspect(batches: Iterator[pa.RecordBatch], shared=shared, turn=turn) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                keys, rows, hashes = _hashes(batch.column(1), min_chars)
                hit = np.flatnonzero(_in_round(hashes, turn, rounds) & _holds(shared.value, hashes, bits))
                if len(hit):
                    digests = pa.array([md5(keys[i]).digest() for i in hit], pa.binary())
                    at = pa.array(rows[hit])
                    yield pa.RecordBatch.from_arrays([digests, batch.column(0).take(at), batch.column(2).take(at)], names=["key", "doc_id", "part"])

        found = stored(in_tasks(hashed, suspect, schema), "suspects")
        suspects = found if suspects is None else suspects.union(found)
    # Documents are told apart by their id; rows that share one, or have none, are no further documents.
    # Told apart first and counted then, so that a key of very many documents is counted before it is shuffled.
    holders = suspects.select("key", "doc_id").distinct()
    confirmed = holders.groupBy("key").agg(F.count("doc_id").alias("n"), F.max("doc_id").alias("last")).where(F.col("n") >= min_docs)
    # Stored, so that the join's two sides are plain shuffles and a frequent key can be split.
    return suspects, stored(confirmed.select("key", "last"), "confirmed"), filters


def _suspected(docs: DataFrame, filters: list, min_chars: int) -> DataFrame:
    """``docs`` with ``__suspect``: the row has a suspected line. A filter is one more pass in the same stage."""
    at = docs.columns.index("text")
    marked = docs.withColumn("__suspect", F.lit(False))
    schema = StructType([*docs.schema.fields, StructField("__suspect", BooleanType())])
    for shared, bits, turn, rounds in filters:

        def mark(batches: Iterator[pa.RecordBatch], shared=shared, bits=bits, turn=turn, rounds=rounds) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                _, rows, hashes = _hashes(batch.column(at), min_chars)
                found = batch.column(batch.num_columns - 1).to_numpy(zero_copy_only=False).astype(bool)
                found[rows[_in_round(hashes, turn, rounds) & _holds(shared.value, hashes, bits)]] = True
                yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(found)], names=batch.schema.names)

        marked = in_tasks(marked, mark, schema)
    return marked


def dedup_lines(docs: DataFrame, min_docs: int = MIN_DOCS, min_chars: int = MIN_CHARS) -> DataFrame:
    """``docs`` with kept_text, n_lines (before) and n_dropped.

    A line is dropped where its key is in ``min_docs`` documents or more and the row's doc_id
    is not the largest that holds it. Rows that share a doc_id are one document and all keep
    the line if theirs is the largest; rows without a doc_id are no document, and lose the
    line. Null and empty texts are one empty line, which is kept. Columns of the three names
    are replaced, all others stay. Only rows with a suspected line are shuffled.
    """
    docs = docs.drop("kept_text", "n_lines", "n_dropped")
    suspects, confirmed, filters = repeated_lines(docs.select("doc_id", "text"), min_docs, min_chars)
    lost = suspects.join(confirmed, "key").where(~F.col("doc_id").eqNullSafe(F.col("last")))
    # By text as well: a doc_id that many rows share would gather the lines of all of them, and each row would get them all.
    lost = lost.groupBy(F.col("doc_id").alias("__id"), F.col("part").alias("__part")).agg(F.collect_set("key").alias("__lost"))
    mine = F.col("doc_id").eqNullSafe(F.col("__id")) & (F.xxhash64("text") == F.col("__part"))
    marked = _suspected(docs, filters, min_chars)
    lines = F.regexp_count(F.coalesce("text", F.lit("")), F.lit("\n")) + 1
    clean = marked.where("not __suspect").drop("__suspect")
    clean = clean.select("*", F.coalesce("text", F.lit("")).alias("kept_text"), lines.cast("long").alias("n_lines"), F.lit(0).cast("long").alias("n_dropped"))
    joined = marked.where("__suspect").drop("__suspect").join(lost, mine, "left").drop("__id", "__part")
    at = docs.columns.index("text")
    new = [StructField("kept_text", StringType()), StructField("n_lines", LongType()), StructField("n_dropped", LongType())]
    schema = StructType([*docs.schema.fields, *new])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept, lines, dropped = [], [], []
            for text, lost in zip(batch.column(at), batch.column(batch.num_columns - 1)):
                whole = text.as_py() or ""
                lines.append(whole.count("\n") + 1)
                gone = set(lost.as_py() or ())
                if gone:
                    parts = whole.encode().split(b"\n")
                    stay = [p for p in parts if (k := key_of(p, min_chars)) is None or md5(k).digest() not in gone]
                    dropped.append(len(parts) - len(stay))
                    whole = b"\n".join(stay).decode()
                else:
                    dropped.append(0)
                kept.append(whole)
            columns = [pa.array(kept, pa.string()), pa.array(lines, pa.int64()), pa.array(dropped, pa.int64())]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *columns], names=schema.names)

    return clean.union(in_tasks(joined.withColumn("__lost", F.col("__lost").cast(ArrayType(BinaryType()))), cut, schema))


@query("op3_line_dedup", sql=r"""
with lines as (
  select doc_id, unnest(range(1, len(parts) + 1)) as nth, unnest(parts) as line
  from (select doc_id, string_split(coalesce(text, ''), chr(10)) as parts from documents)
), keyed as (
  select *, translate(regexp_replace(regexp_replace(line, '^[\x20\x09-\x0D]+', ''), '[\x20\x09-\x0D]+$', ''),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as key
  from lines
), spread as (
  select key, max(doc_id) as last from keyed where length(key) >= 40 group by key having count(distinct doc_id) >= 5
), judged as (
  select k.*, s.last is not null and k.doc_id is distinct from s.last as gone from keyed k left join spread s on k.key = s.key
)
select doc_id, count(*) as n_lines, cast(sum(gone::int) as bigint) as n_dropped,
       sha256(coalesce(string_agg(line, chr(10) order by nth) filter (where not gone), '')) as kept_sha256
from judged group by doc_id
""")
def op3(t):
    found = dedup_lines(t.documents.select("doc_id", "text"))
    return found.select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))
