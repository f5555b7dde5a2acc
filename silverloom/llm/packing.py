"""Token ids packed into rows of equal length by best fit decreasing."""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, BinaryType, IntegerType, LongType, StructField, StructType

from .common import in_tasks
from .registry import query

TOKENIZER = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# Fixed value: how this vocabulary's texts are cut before merging.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
ROW_TOKENS = 2048
WINDOW_TOKENS = 1 << 21
PAD = 50256
_CACHED = 300_000
_BESIDE_SPACE = re.compile(r" \s|\s ")
# Texts above this are encoded in parts: the tokenizer's search takes a stack as deep as a run is long.
LONGEST_PART = 1 << 14
# Places where the vocabulary's pattern always cuts: before white space, and between words and marks.
_CUT = regex.compile(r"(?<=\S)(?=\s)|(?<=[\p{L}\p{N}])(?=[^\s\p{L}\p{N}'])")


def bounded_parts(text: str, most: int = LONGEST_PART) -> Iterator[str]:
    """``text`` in parts of at most ``most`` characters, cut where the pattern cuts if there is such a place."""
    begin = 0
    while len(text) - begin > most:
        cuts = [m.start() for m in _CUT.finditer(text, begin + most // 2, begin + most + 1) if m.start() <= begin + most]
        end = cuts[-1] if cuts else begin + most
        yield text[begin:end]
        begin = end
    yield text[begin:]


class Tokenizer:
    """Ids of a text as little-endian bytes, 2 or 4 for an id.

    Single spaces between words are places where the vocabulary's pattern always cuts, so
    words can be encoded one by one and kept; other texts are encoded whole, or if they are
    long in parts that end where the pattern cuts. A run of one kind of character (blanks,
    letters, marks) above ``LONGEST_PART`` is cut inside, so no text needs more memory or a
    deeper stack; there alone ids can differ from those of the uncut run.
    """

    def __init__(self, ranks: bytes, pattern: str = PATTERN):
        table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, ranks.splitlines())}
        self.dtype = np.dtype("<u2" if len(table) < 1 << 16 else "<u4")
        self.encoding = tiktoken.Encoding("given", pat_str=pattern, mergeable_ranks=table, special_tokens={})
        self.words = _Words(self)

    def whole(self, text: str) -> bytes:
        if len(text) <= LONGEST_PART:
            return np.array(self.encoding.encode_ordinary(text), self.dtype).tobytes()
        return b"".join(map(self.whole, bounded_parts(text)))

    def encode(self, text: str | None) -> bytes:
        if not text:
            return b""
        if _BESIDE_SPACE.search(text):
            return self.whole(text)
        first, *rest = text.split(" ")
        if len(self.words) > _CACHED:
            self.words.clear()
        return (self.whole(first) if first else b"") + b"".join(map(self.words.__getitem__, rest))


class _Words(dict):
    """Ids of a word with the space before it, encoded when first met."""

    def __init__(self, tokenizer: Tokenizer):
        self.tokenizer = tokenizer

    def __missing__(self, word: str) -> bytes:
        found = self.tokenizer.whole(" " + word)
        if len(word) < 40:
            self[word] = found
        return found


class Capacities:
    """Open rows by free places, in a segment tree that finds the smallest sufficient one."""

    def __init__(self, most: int):
        self.leaves = 1 << most.bit_length()
        self.used = [0] * (2 * self.leaves)
        self.rows: dict[int, list[int]] = {}

    def add(self, free: int, row: int) -> None:
        self.rows.setdefault(free, []).append(row)
        node = free + self.leaves
        while node:
            self.used[node] += 1
            node >>= 1

    def take(self, need: int) -> tuple[int, int] | None:
        """(free places, row) of the fullest row with ``need`` places left, taken out; None if there is none."""
        node = need + self.leaves
        while not self.used[node]:
            while node & 1:  # climb while this is a right child
                node >>= 1
            if node == 0:
                return None
            node += 1
            if node & (node - 1) == 0:  # passed the last leaf of the level
                return None
        while node < self.leaves:
            node = 2 * node if self.used[2 * node] else 2 * node + 1
        free = node - self.leaves
        row = self.rows[free].pop()
        while node:
            self.used[node] -= 1
            node >>= 1
        return free, row


def best_fit(lengths: list[int], size: int) -> list[list[int]]:
    """Rows of at most ``size``, as lists of indexes of ``lengths`` (each 1 to size): longest first, into the fullest row that fits."""
    open_ = Capacities(size)
    rows: list[list[int]] = []
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        found = open_.take(lengths[i])
        if found is None:
            found = size, len(rows)
            rows.append([])
        free, row = found
        rows[row].append(i)
        if free > lengths[i]:
            open_.add(free - lengths[i], row)
    return rows


def packed_schema(doc_id) -> StructType:
    return StructType(
        [
            StructField("pack_id", LongType()),
            StructField("n_tokens", IntegerType()),
            StructField("n_segments", IntegerType()),
            StructField("doc_ids", ArrayType(doc_id)),
            StructField("doc_rows", ArrayType(LongType())),
            StructField("doc_starts", ArrayType(LongType())),
            StructField("cu_seqlens", ArrayType(IntegerType())),
            StructField("input_ids", BinaryType()),
            StructField("position_ids", BinaryType()),
        ]
    )


def pack(
    docs: DataFrame, tokenizer: str = TOKENIZER, row_tokens: int = ROW_TOKENS, window_tokens: int = WINDOW_TOKENS, pad: int = PAD, pattern: str = PATTERN
) -> DataFrame:
    """Rows of ``row_tokens`` ids that hold every token of every text once.

    A text of more tokens is cut into pieces of ``row_tokens`` and a rest. Pieces are packed
    within windows of about ``window_tokens`` tokens of a partition, so that nothing is
    shuffled and memory is bounded; how documents meet in rows therefore follows the
    partitions. Per row: ``cu_seqlens`` (0 and the end of each segment), ``doc_ids``,
    ``doc_rows`` (a number for the document's row, unique in this result), ``doc_starts``
    (place of the segment's first token in its document), ``input_ids`` and
    ``position_ids`` as little-endian binary of row_tokens numbers (2 bytes each, 4 if the
    vocabulary or the row is larger). Positions begin at 0 in every segment; the rest of a
    row is ``pad`` at position 0. A null or empty text has no token and so no segment; an
    empty table gives no row. Repeated rows are packed as often as they occur.
    """
    kind = docs.schema["doc_id"].dataType
    with open(tokenizer, "rb") as f:
        ranks = f.read()
    shared = docs.sparkSession.sparkContext.broadcast(ranks)
    schema = packed_schema(kind)
    from pyspark.sql.pandas.types import to_arrow_schema

    target = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = Tokenizer(shared.value, pattern)
        part = TaskContext.get().partitionId() << 40
        places = np.dtype("<u2" if row_tokens <= 1 << 16 else "<u4")
        pieces, held, packs, nth = [], 0, 0, 0

        def flush() -> pa.RecordBatch:
            width = made.dtype.itemsize
            filling = np.array([pad], made.dtype).tobytes()
            columns = [[] for _ in target]
            for k, row in enumerate(best_fit([len(p[3]) // width for p in pieces], row_tokens)):
                lengths = [len(pieces[i][3]) // width for i in row]
                total = sum(lengths)
                ids = b"".join(pieces[i][3] for i in row) + filling * (row_tokens - total)
                places_ = np.concatenate([*[np.arange(n, dtype=places) for n in lengths], np.zeros(row_tokens - total, places)])
                values = (
                    part + packs + k, total, len(row), *([pieces[i][c] for i in row] for c in range(3)),
                    [0, *np.cumsum(lengths).tolist()], ids, places_.tobytes(),
                )
                for column, value in zip(columns, values):
                    column.append(value)
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, target)], schema=target)

        for batch in batches:
            for doc_id, text in zip(batch.column(0), batch.column(1)):
                ids = made.encode(text.as_py())
                step = row_tokens * made.dtype.itemsize
                for at in range(0, len(ids), step):
                    pieces.append((doc_id.as_py(), part + nth, at // made.dtype.itemsize, ids[at : at + step]))
                    held += min(step, len(ids) - at) // made.dtype.itemsize
                    if held >= window_tokens:
                        out = flush()
                        packs += out.num_rows
                        pieces, held = [], 0
                        yield out
                nth += 1
        if pieces:
            yield flush()

    return in_tasks(docs.select("doc_id", "text"), run, schema)


def write_packed(packed: DataFrame, path: str) -> None:
    """Write the rows as Parquet files of fixed-length binary values."""
    packed.write.mode("overwrite").parquet(path)


def matrix(rows: pa.Table, column: str, row_tokens: int = ROW_TOKENS) -> np.ndarray:
    """``input_ids`` or ``position_ids`` of some rows as a matrix, a row for each."""
    values = rows.column(column).to_pylist()
    width = len(values[0]) // row_tokens if values else 2
    return np.frombuffer(b"".join(values), f"<u{width}").reshape(len(values), row_tokens)


@query("op4_pack_tokens")
def op4(t):
    return pack(t.documents)
