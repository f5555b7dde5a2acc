"""Benchmark decontamination: pieces of test items found exactly, verified by edit distance."""

from __future__ import annotations

import math
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StructField, StructType

from .common import in_tasks, stored
from .registry import query

ERROR_RATE = 0.06
PIECE_CHARS = 16
BLOCK_CHARS = 1 << 20
STAGE_BLOCKS = 4
SHINGLE_WORDS = 5
KEPT_SHINGLES = 0.8


def plain(text: str | None) -> str:
    """Lower case, runs of white space as one space."""
    return " ".join((text or "").lower().split())


def budget(chars: int, rate: float = ERROR_RATE, piece_chars: int = PIECE_CHARS) -> int:
    """Edits allowed in an item: its share of the length, but pieces keep ``piece_chars`` characters."""
    return max(0, min(int(chars * rate), chars // piece_chars - 1))


def pieces(item: str, errors: int) -> list[tuple[int, str]]:
    """(start, piece): ``errors + 1`` pieces; with at most ``errors`` edits one of them stays whole."""
    cut = [len(item) * k // (errors + 1) for k in range(errors + 2)]
    return [(a, item[a:b]) for a, b in zip(cut, cut[1:])]


def cores(item: str) -> list[str]:
    """The shortest beginning and end of ``item`` that keep ``KEPT_SHINGLES`` of its runs of five words, if shorter than it.

    A copy that lost whole words at one end, but keeps that share, has one of them whole.
    """
    words = item.split(" ")
    runs = len(words) - SHINGLE_WORDS + 1
    kept = math.ceil(runs * KEPT_SHINGLES) + SHINGLE_WORDS - 1
    return [" ".join(words[:kept]), " ".join(words[-kept:])] if runs > 1 and kept < len(words) else []


def distance(item: str, text: str) -> tuple[int, int]:
    """Least edit distance of ``item`` to any part of ``text``, and where the first such part ends.

    Myers' bit-parallel search: a column of the distance table is two bit vectors of
    differences, advanced by a character with a few operations on whole numbers.
    """
    size = len(item)
    if not size:
        return 0, 0
    where: dict[str, int] = {}
    for i, c in enumerate(item):
        where[c] = where.get(c, 0) | 1 << i
    every, last = (1 << size) - 1, 1 << (size - 1)
    up, down, score = every, 0, size
    best = size, 0
    for at, c in enumerate(text, 1):
        same = where.get(c, 0)
        diagonal = (((same & up) + up) ^ up) | same | down
        rise = down | (every & ~(diagonal | up))
        fall = up & diagonal
        if rise & last:
            score += 1
        elif fall & last:
            score -= 1
            if score < best[0]:
                best = score, at
        rise = rise << 1
        up = (fall << 1 | (every & ~(diagonal | rise))) & every
        down = rise & diagonal & every
    return best


class Matcher:
    """Finds all items of a block in a text."""

    def __init__(self, items: list[tuple[object, str]], rate: float, piece_chars: int):
        self.items = []
        places: dict[str, list[tuple[int, int]]] = {}
        for item_id, text in items:
            text = plain(text)
            if not text:
                continue
            whole = len(self.items)
            parts = [x for x in cores(text) if len(x) >= piece_chars]
            for part in [text, *parts]:
                errors = budget(len(part), rate, piece_chars)
                for start, piece in pieces(part, errors):
                    places.setdefault(piece, []).append((len(self.items), start))
                self.items.append((item_id, part, errors, whole, len(text) < piece_chars))
        self.machine = ahocorasick.Automaton()
        for piece, at in places.items():
            self.machine.add_word(piece, (len(piece), at))
        if places:
            self.machine.make_automaton()

    def find(self, text: str | None) -> list[tuple[object, int, int]]:
        """(item_id, distance, end) of each item found: its nearest place, the first of equals.

        Where only a core is within its budget, the distance is that of the whole item at that place.
        """
        if not self.items or not text:
            return []
        text = plain(text)
        best: dict[int, tuple[int, int]] = {}
        # Where the item would lie if the piece is in place; overlapping ones become one range.
        ranges: dict[int, list[list[int]]] = {}
        for last, (length, places) in self.machine.iter(text):
            for k, start in places:
                _, item, errors, _, short = self.items[k]
                begin = last - length + 1 - start
                if not errors:
                    apart = not short or not (text[begin - 1 : begin].isalnum() or text[last + 1 : last + 2].isalnum())
                    if apart and k not in best:
                        best[k] = 0, begin + len(item)
                    continue
                low, high = max(0, begin - errors), begin + len(item) + errors
                mine = ranges.setdefault(k, [])
                # Pieces of later places come later, but begin earlier: the new range may meet several.
                while mine and low <= mine[-1][1] and mine[-1][0] <= high:
                    before = mine.pop()
                    low, high = min(low, before[0]), max(high, before[1])
                mine.append([low, high])
        for k, some in ranges.items():
            _, item, errors, _, _ = self.items[k]
            for low, high in some:
                near, end = distance(item, text[low:high])
                if near <= errors and (k not in best or (near, low + end) < best[k]):
                    best[k] = near, low + end
                if near == 0:
                    break
        found: dict[int, tuple[int, int]] = {k: v for k, v in best.items() if self.items[k][3] == k}
        partly: dict[int, tuple[int, int]] = {}
        for k, (_, end) in best.items():
            _, part, errors, whole, _ = self.items[k]
            if whole not in found:
                item = self.items[whole][1]
                low = max(0, end - len(item) - errors)
                near, at = distance(item, text[low : end + len(item) - len(part) + errors])
                partly[whole] = min(partly.get(whole, (near, low + at)), (near, low + at))
        return [(self.items[k][0], near, end) for k, (near, end) in sorted((found | partly).items())]


def mark(docs: DataFrame, benchmark: DataFrame, rate: float = ERROR_RATE, piece_chars: int = PIECE_CHARS, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """``docs`` with ``matches``: item_id, distance and end (in the plain text) of each item found in the row's text.

    An item is found where some part of the text is within its budget of edits. The
    benchmark is the stated query set: it is broadcast in blocks of about ``block_chars``
    characters, one pass over the rows for each. ``STAGE_BLOCKS`` passes share a stage; then
    the rows are stored and these blocks are let go, so neither the driver nor an executor
    ever holds more. An item of which only the
    beginning or the end is found is matched if that keeps 80 % of its runs of five words
    (``cores``); its distance then exceeds the budget. Items shorter than ``piece_chars``
    characters (white space folded), also single words, are found exactly, between
    characters that are no letters or digits. Null and empty items are not searched. Null
    and empty texts match nothing. A column named ``matches`` is replaced; other columns and
    repeated rows stay.
    """
    items = benchmark.select("item_id", "text").where("text is not null")
    chars = items.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = max(1, -(-chars // block_chars))
    kind = benchmark.schema["item_id"].dataType
    match = StructType([StructField("item_id", kind), StructField("distance", IntegerType()), StructField("end", LongType())])
    marked = docs.drop("matches").withColumn("matches", F.array().cast(ArrayType(match)))
    held = []
    for block in range(blocks):
        if len(held) == STAGE_BLOCKS:
            marked = stored(marked, "marked")
            for shared in held:
                shared.destroy()
            held = []
        mine = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block)
        held.append(docs.sparkSession.sparkContext.broadcast(sorted(((r[0], r[1]) for r in mine.collect()), key=repr)))
        marked = _mark_block(marked, held[-1], rate, piece_chars)
    return marked


def _mark_block(docs: DataFrame, shared: Broadcast, rate: float, piece_chars: int) -> DataFrame:
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Matcher(shared.value, rate, piece_chars)
        for batch in batches:
            before = batch.column(batch.num_columns - 1)
            found = []
            for text, old in zip(batch.column(at), before):
                new = [{"item_id": i, "distance": d, "end": e} for i, d, e in matcher.find(text.as_py())]
                found.append(old.as_py() + new if new else old.as_py())
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(found, before.type)], names=batch.schema.names)

    return in_tasks(docs, run, docs.schema)


def keep_clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows in which no benchmark item is found."""
    return mark(docs, benchmark).where(F.size("matches") == 0).select(*docs.columns)


@query("op2_decontaminate")
def op2(t):
    found = mark(t.documents.select("doc_id", "text"), t.benchmark).select("doc_id", F.explode("matches").alias("m"))
    return found.select("doc_id", "m.item_id", "m.distance", "m.end")
