"""Phrase collocation mining: counts of phrases from suffix subtrees that are built a group of prefixes at a time."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import BinaryType, IntegerType, LongType, StringType, StructField, StructType

from .common import in_tasks, stored
from .registry import query

DEPTH = 4  # words of the longest phrase
LEAST = 30  # occurrences of a phrase
COVERED = 80  # per cent of its occurrences that a longer phrase has, to drop it
TOP = 2000
GROUP_SUFFIXES = 1 << 21
_SHARE = 2  # a prefix with more than this part of a group's suffixes is made longer
_HELD_SUFFIXES, _HELD_WORDS = 1 << 20, 1 << 19
_ID_BITS = 21  # bits of a word's number
_CHUNK_CHARS = 1 << 20
_MIX = np.uint64(0x9E3779B97F4A7C15)

# Where texts are cut into pieces, and pieces into words.
PIECE_ENDS = b".,;:!?\n\x0b\x0c\r"
_PLAIN = bytes.maketrans(PIECE_ENDS + b"\t", b"\n" * len(PIECE_ENDS) + b" ")


class _Numbers(dict):
    """Numbers of words in the order they are met, from 1; 0 ends a piece, -1 is no word."""

    def __init__(self):
        super().__init__({b"": -1, b"\n": 0})

    def __missing__(self, word: bytes) -> int:
        found = self[word] = len(self) - 1
        return found


class Words:
    """The words of one language, by number, with a 0 after each piece."""

    def __init__(self, lang: str):
        self.lang, self.number, self.parts, self.size, self.chars = lang, _Numbers(), [], 0, 0

    def add(self, texts: list[str | None]) -> None:
        text = "\n".join([t or "" for t in texts])
        words = text.encode().lower().translate(_PLAIN).replace(b"\n", b" \n ").split(b" ")
        ids = np.fromiter(map(self.number.__getitem__, words), np.int32, len(words))
        self.parts += [ids[ids >= 0], np.zeros(1, np.int32)]
        self.size += len(self.parts[-2])
        self.chars += len(text) + 1 - len(texts)

    def ids(self) -> np.ndarray:
        return np.concatenate([*self.parts, np.zeros(DEPTH, np.int32)])

    def listed(self) -> list[bytes]:
        """Words by number."""
        return [b"\n", *list(self.number)[2:]]


def _buffers(batches: Iterator[pa.RecordBatch]) -> Iterator[list[Words]]:
    """The words of (lang, text) rows by language, as much at a time as memory has room for."""
    held: dict[str, Words] = {}
    for batch in batches:
        langs, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        begin, chars = 0, 0
        for i, text in enumerate(texts):
            chars += len(text or "")
            if chars < _CHUNK_CHARS and i + 1 < len(texts):
                continue
            by_lang: dict[str, list] = {}
            for lang, t in zip(langs[begin : i + 1], texts[begin : i + 1]):
                by_lang.setdefault(lang, []).append(t)
            for lang, some in by_lang.items():
                held.setdefault(lang, Words(lang)).add(some)
            begin, chars = i + 1, 0
            if sum(w.size for w in held.values()) >= _HELD_SUFFIXES or sum(len(w.number) for w in held.values()) >= _HELD_WORDS:
                yield list(held.values())
                held = {}
    if held:
        yield list(held.values())


def _codes(ids: np.ndarray, depth: int, n: int) -> np.ndarray:
    """One number for the first ``depth`` (at most 3) words at each of ``n`` places."""
    code = np.zeros(n, np.uint64)
    for j in range(depth):
        code = code << np.uint64(_ID_BITS) | ids[j : n + j].astype(np.uint64)
    return code


def _holds(words: Words, codes: np.ndarray, depth: int, prefixes: list[str]) -> np.ndarray:
    """Where the first ``depth`` words are one of the ``prefixes``."""
    numbers = [[words.number.get(w.encode(), 0) for w in p.split(" ")] for p in prefixes]
    mine = [_codes(np.array(x), depth, 1)[0] for x in numbers if all(x)]
    return np.isin(codes, np.array(mine, np.uint64)) if mine else np.zeros(len(codes), bool)


def survey(texts: DataFrame, limit: int, chars: int) -> DataFrame:
    """(lang, depth, phrase, f): counts of all words (depth 1), and of longer prefixes that are frequent where they are counted.

    A row of depth 0 has the number of all word occurrences of the language. A prefix of 2
    or 3 words is counted in the parts of the texts in which it has more than its share of
    half of ``limit``, so one with more than ``limit`` occurrences is found with more than half.
    """
    schema = StructType([StructField("lang", StringType()), StructField("depth", IntegerType()), StructField("phrase", StringType()), StructField("f", LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for held in _buffers(batches):
            share = limit / 2 * sum(w.chars for w in held) / max(1, chars)
            for words in held:
                ids, listed = words.ids(), words.listed()
                n = len(ids) - DEPTH
                counts = np.bincount(ids[:n], minlength=len(listed))
                counts[0] = 0
                at = np.flatnonzero(counts)
                depths, phrases, found = [0] + [1] * len(at), [None, *[listed[i].decode() for i in at]], [int(counts.sum()), *counts[at].tolist()]
                inside = (counts > share)[ids[:n]]
                for depth in range(2, DEPTH):
                    places = np.flatnonzero(inside & (ids[depth - 1 : n + depth - 1] > 0))
                    codes, back, sums = np.unique(_codes(ids, depth, n)[places], return_inverse=True, return_counts=True)
                    often = sums > share
                    inside = np.zeros(n, bool)
                    inside[places[often[back]]] = True
                    mask, shifts = (1 << _ID_BITS) - 1, [_ID_BITS * j for j in reversed(range(depth))]
                    some = [b" ".join(listed[c >> s & mask] for s in shifts).decode() for c in codes[often].tolist()]
                    depths, phrases, found = depths + [depth] * len(some), phrases + some, found + sums[often].tolist()
                yield pa.RecordBatch.from_arrays(
                    [pa.array([words.lang] * len(found), pa.string()), pa.array(depths, pa.int32()), pa.array(phrases, pa.string()), pa.array(found, pa.int64())],
                    names=schema.names,
                )

    return in_tasks(texts, run, schema).groupBy("lang", "depth", "phrase").agg(F.sum("f").alias("f"))


def heavy_prefixes(counted: DataFrame, limit: int) -> list[dict[str, list[str]]]:
    """By length, the prefixes with more than ``limit`` occurrences (and some with more than half), by language; at most 2 total / limit of each length."""
    most = F.when(F.col("depth") == 1, limit).otherwise(limit // 2)
    rows = counted.where((F.col("depth") > 0) & (F.col("f") > most)).select("lang", "depth", "phrase").collect()
    found: list[dict[str, list[str]]] = []
    for depth in range(1, DEPTH):
        by_lang: dict[str, list[str]] = {}
        for r in rows:
            if r["depth"] == depth and (depth == 1 or r["phrase"].rsplit(" ", 1)[0] in found[-1].get(r["lang"], ())):
                by_lang.setdefault(r["lang"], []).append(r["phrase"])
        found.append(by_lang)
    return found


def suffixes(texts: DataFrame, heavy: list[dict[str, list[str]]], groups: int) -> DataFrame:
    """(part, lang, leaves): the suffixes of pieces, cut after ``DEPTH`` words, dealt into groups by their prefix.

    A row packs the distinct suffixes that a task holds of one group and language: the words
    they use, and for each suffix its words by number, its count, and the length of the prefix
    that dealt it (one word, or one more than its longest heavy prefix).
    """
    shared = texts.sparkSession.sparkContext.broadcast(heavy)
    schema = StructType([StructField("part", IntegerType()), StructField("lang", StringType()), StructField("leaves", BinaryType())])
    target = to_arrow_schema(schema)

    def packed(words: Words, press: zstandard.ZstdCompressor) -> Iterator[tuple[int, str, bytes]]:
        ids, listed = words.ids(), words.listed()
        n = len(ids) - DEPTH
        columns = [ids[j : n + j].copy() for j in range(DEPTH)]
        for j in range(1, DEPTH):
            columns[j][columns[j - 1] == 0] = 0
        level = np.ones(n, np.uint8)
        for d, by_lang in enumerate(shared.value, 1):
            if by_lang.get(words.lang):
                level[_holds(words, _codes(ids, d, n), d, by_lang[words.lang])] = d + 1
        inside = columns[1] > 0  # one word alone has been counted
        columns, level = [c[inside] for c in columns], level[inside]
        if not len(level):
            return
        hashes = np.fromiter(map(xxhash.xxh64_intdigest, listed), np.uint64, len(listed))
        dealt = (hashes[columns[0]] ^ np.uint64(xxhash.xxh64_intdigest(words.lang.encode()))) * _MIX
        for j in range(1, DEPTH):
            longer = np.flatnonzero(level > j)
            dealt[longer] = (dealt[longer] ^ hashes[columns[j][longer]]) * _MIX
        part = (dealt >> np.uint64(33)) % np.uint64(groups)
        first, rest = (columns[j].astype(np.uint64) << np.uint64(_ID_BITS) | columns[j + 1].astype(np.uint64) for j in (0, 2))
        order = np.lexsort((rest, first | part << np.uint64(2 * _ID_BITS)) if groups < 1 << 22 else (rest, first, part))
        first, rest, part = first[order], rest[order], part[order]
        begins = np.flatnonzero(np.concatenate([[True], (first[1:] != first[:-1]) | (rest[1:] != rest[:-1])]))
        counts = np.diff(np.concatenate([begins, [len(first)]])).astype("<u4")
        at = order[begins]
        columns, level, part = np.stack([c[at] for c in columns]), level[at], part[begins]
        cuts = [0, *(np.flatnonzero(part[1:] != part[:-1]) + 1).tolist(), len(part)]
        own = np.zeros(len(listed), np.int64)
        for a, b in zip(cuts, cuts[1:]):
            some = columns[:, a:b]
            used = np.unique(some)
            own[used] = np.arange(len(used))
            text = b"\n".join([listed[i] if i else b"" for i in used.tolist()])
            body = [own[some].astype("<u4").tobytes(), counts[a:b].tobytes(), level[a:b].tobytes(), text]
            yield int(part[a]), words.lang, press.compress(b"".join([(b - a).to_bytes(8, "little"), *body]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdCompressor(level=1)
        for held in _buffers(batches):
            rows = [r for words in held for r in packed(words, press)]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), target)], schema=target)

    return in_tasks(texts, run, schema)


def _unpacked(leaves: bytes, press: zstandard.ZstdDecompressor) -> tuple[list[bytes], np.ndarray, np.ndarray, np.ndarray]:
    """(words, ids in columns, counts, levels) of a packed row."""
    body = press.decompress(leaves)
    n = int.from_bytes(body[:8], "little")
    ends = np.cumsum([8, 4 * DEPTH * n, 4 * n, n]).tolist()
    ids = np.frombuffer(body, "<u4", DEPTH * n, ends[0]).reshape(DEPTH, n)
    return body[ends[3] :].split(b"\n"), ids, np.frombuffer(body, "<u4", n, ends[1]), np.frombuffer(body, np.uint8, n, ends[2])


def _subtrees(least: int):
    """Counts of the phrases of a group: its suffixes are the leaves of trees of words; a node's count is the sum of its leaves'.

    Nodes that other groups have leaves of as well are given whatever their count.
    """

    def count(table: pa.Table) -> pa.Table:
        number: dict[tuple[str, bytes], int] = {}
        press = zstandard.ZstdDecompressor()
        parts, totals, levels = [], [], []
        for lang, packed in zip(table.column("lang").to_pylist(), table.column("leaves")):
            words, ids, counts, level = _unpacked(packed.as_py(), press)
            own = np.array([number.setdefault((lang, w), len(number) + 1) if w else 0 for w in words], np.int32)
            parts.append(own[ids])
            totals.append(counts)
            levels.append(level)
        leaves, totals, levels = np.concatenate(parts, axis=1), np.concatenate(totals).astype(np.int64), np.concatenate(levels)
        listed = list(number)
        found: list[tuple[str, str, int]] = []
        # From the root down: leaves below a node with too few occurrences go with it.
        node = leaves[0].astype(np.int64)
        for d in range(2, DEPTH + 1):
            inside = np.flatnonzero(leaves[d - 1] > 0)
            leaves, totals, levels, node = leaves[:, inside], totals[inside], levels[inside], node[inside]
            _, first, node = np.unique(node << 32 | leaves[d - 1], return_index=True, return_inverse=True)
            sums = np.bincount(node, weights=totals, minlength=len(first)).astype(np.int64)  # exact below 2^53
            given = (sums >= least) | (levels[first] > d)
            for i in np.flatnonzero(given).tolist():
                words = [listed[w - 1] for w in leaves[:d, first[i]].tolist()]
                found.append((words[0][0], b" ".join([w for _, w in words]).decode(), int(sums[i])))
            stay = np.flatnonzero(given[node])
            leaves, totals, levels, node = leaves[:, stay], totals[stay], levels[stay], node[stay]
        lang, phrase, f = zip(*found) if found else ((), (), ())
        return pa.table({"lang": pa.array(lang, pa.string()), "phrase": pa.array(phrase, pa.string()), "f": pa.array(f, pa.int64())})

    return count


def phrase_counts(docs: DataFrame, least: int = LEAST, group_suffixes: int = GROUP_SUFFIXES) -> tuple[DataFrame, DataFrame]:
    """(phrases, totals): (lang, phrase, f) of all phrases of 1 to ``DEPTH`` words with f >= ``least``, and (lang, n) of all word occurrences.

    Words are counted first. Word prefixes with a part of a group's ``group_suffixes`` are
    dealt to groups as they are, others are made longer by a word until they are small; the
    number of groups follows the number of words. Each group's suffixes are brought to one
    task, which needs no other group. Suffixes are combined before they are shuffled.
    """
    texts = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), "text")
    limit = max(least, group_suffixes // _SHARE)
    chars = texts.agg(F.sum(F.length("text"))).first()[0] or 0
    counted = stored(survey(texts, limit, chars).where((F.col("f") >= least) | (F.col("depth") == 0)), "words")
    totals = counted.where("depth = 0").select("lang", F.col("f").alias("n"))
    total = totals.agg(F.sum("n")).first()[0] or 0
    # Half of what a group may hold is expected in it.
    groups = max(1, -(-2 * total // group_suffixes))
    dealt = suffixes(texts, heavy_prefixes(counted, limit), groups).groupBy("part").applyInArrow(_subtrees(least), "lang string, phrase string, f long")
    # Only phrases that are heavy prefixes come from more than one group.
    longer = dealt.groupBy("lang", "phrase").agg(F.sum("f").alias("f")).where(F.col("f") >= least)
    return stored(longer.unionByName(counted.where("depth = 1").select("lang", "phrase", "f")), "phrases"), totals


def collocations(docs: DataFrame, top: int = TOP, least: int = LEAST, group_suffixes: int = GROUP_SUFFIXES) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's ``top`` phrases of 2 to ``DEPTH`` words.

    A-Z is lowered; pieces end at ``PIECE_ENDS`` and words at spaces and tabs. a is the number
    of a phrase's occurrences, l and r those of its first words and of the rest at the cut
    with the lowest score, 2,000,000 a / (l + r) rounded down (the first of equal cuts). A
    phrase that stands inside a longer one which has ``COVERED`` per cent of its occurrences
    is left out. Null and empty texts have no words, a missing language is ``und``; repeated
    rows count as often as they occur; other columns are not read; an empty table gives none.
    """
    phrases, totals = phrase_counts(docs, least, group_suffixes)
    parts = phrases.withColumn("w", F.split("phrase", " "))
    found = parts.where(F.size("w") > 1)

    def part(first: Column, n: Column) -> Column:
        return F.array_join(F.slice("w", first, n), " ")

    cut = found.select("lang", "phrase", "w", F.col("f").alias("a"), F.explode(F.sequence(F.lit(1), F.size("w") - 1)).alias("k"))
    cut = cut.select("lang", "phrase", "a", "k", part(F.lit(1), F.col("k")).alias("head"), part(F.col("k") + 1, F.size("w") - F.col("k")).alias("tail"))
    heads = phrases.select("lang", F.col("phrase").alias("head"), F.col("f").alias("l"))
    tails = phrases.select("lang", F.col("phrase").alias("tail"), F.col("f").alias("r"))
    scored = cut.join(heads, ["lang", "head"]).join(tails, ["lang", "tail"])
    wide = "decimal(20,0)"
    score = F.expr(f"(cast(2000000 as decimal(8,0)) * cast(a as {wide})) div (cast(l as {wide}) + cast(r as {wide}))")
    lowest = scored.groupBy("lang", "phrase", "a").agg(F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("cut"))

    longer = parts.where(F.size("w") > 2)
    inner = longer.select("lang", "f", "w", F.explode(F.sequence(F.lit(2), F.size("w") - 1)).alias("n"))
    inner = inner.select("lang", "f", "w", "n", F.explode(F.sequence(F.lit(1), F.size("w") - F.col("n") + 1)).alias("i"))
    inner = inner.select("lang", part(F.col("i"), F.col("n")).alias("phrase"), "f").groupBy("lang", "phrase").agg(F.max("f").alias("most"))
    kept = lowest.join(inner, ["lang", "phrase"], "left")
    kept = kept.where(F.expr(f"most is null or cast(most as {wide}) * 100 < cast(a as {wide}) * {COVERED}"))

    by_score = Window.partitionBy("lang").orderBy(F.desc("cut.score"), F.desc("a"), F.asc("phrase"))
    ranked = kept.withColumn("rank", F.row_number().over(by_score)).where(F.col("rank") <= top)
    return ranked.join(totals, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", F.col("cut.l").alias("l"), F.col("cut.r").alias("r"), "n", F.col("cut.score").alias("score")
    )


@query("op12_collocations", sql=r"""
with pieces as (
  select lang, unnest(regexp_split_to_array(text, '[.,;:!?\x0A-\x0D]')) as piece
  from (select coalesce(lang, 'und') as lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as text
        from documents)
), words as (
  select lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda w: w <> '') as ws from pieces
), grams as (
  select lang, k, array_to_string(ws[i : i + k - 1], ' ') as phrase
  from (select lang, ws, k, unnest(range(1, len(ws) - k + 2)) as i from words, (select unnest([1, 2, 3, 4]) as k))
), counts as (
  select lang, k, phrase, count(*) as f from grams group by all
), candidates as (
  select lang, k, phrase, f as a, string_split(phrase, ' ') as ws from counts where k > 1 and f >= 30
), cuts as (
  select c.lang, c.phrase, c.k, c.a, c.nth, h.f as l, t.f as r, cast(c.a as hugeint) * 2000000 // (h.f + t.f) as score
  from (select *, unnest(range(1, k)) as nth from candidates) c
  join counts h on h.lang = c.lang and h.phrase = array_to_string(c.ws[1 : c.nth], ' ')
  join counts t on t.lang = c.lang and t.phrase = array_to_string(c.ws[c.nth + 1 : c.k], ' ')
), lowest as (
  select * from cuts qualify row_number() over (partition by lang, phrase order by score, nth) = 1
), inside as (
  select lang, array_to_string(ws[i : i + m - 1], ' ') as phrase, max(a) as most
  from (select *, unnest(range(1, k - m + 2)) as i from (select *, unnest(range(2, k)) as m from candidates)) group by all
), kept as (
  select x.* from lowest x left join inside i on x.lang = i.lang and x.phrase = i.phrase
  where i.most is null or cast(i.most as hugeint) * 100 < cast(x.a as hugeint) * 80
), totals as (
  select lang, cast(sum(f) as bigint) as n from counts where k = 1 group by lang
)
select lang, row_number() over (partition by lang order by score desc, a desc, phrase) as rank, phrase, a, l, r, n, cast(score as bigint) as score
from kept join totals using (lang)
qualify rank <= 2000
""")
def op12(t):
    return collocations(t.documents)
