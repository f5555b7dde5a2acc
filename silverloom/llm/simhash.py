"""SimHash near-duplicates: fingerprints compared as bit planes inside pigeonhole groups."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate, combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from .common import in_tasks, map_rows, row_order, stored
from .components import components
from .registry import query

BITS = 64
SEED = 42
SHINGLE = 3
RADIUS = 2
GROUP_ROWS = 4096
_CHUNK = 1 << 16


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """Majority bits of the XXH64 of a text's word shingles, as a signed 64-bit number (no words: 0)."""
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle:
        hashes = [xxhash.xxh64_intdigest(joined, SEED)]
    else:
        starts = [0, *accumulate(len(w) + 1 for w in words)]
        digest = xxhash.xxh64_intdigest
        hashes = [digest(joined[a : b - 1], SEED) for a, b in zip(starts, starts[shingle:])]
    counts = np.zeros(BITS, np.int64)
    rows = np.array(hashes, dtype="<u8")
    for at in range(0, len(rows), _CHUNK):
        part = rows[at : at + _CHUNK].view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = (2 * counts > len(rows)).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, fp) of every row."""
    schema = StructType([StructField("doc_id", docs.schema["doc_id"].dataType), StructField("fp", LongType())])

    def columns(batch):
        return [batch.column(0), [fingerprint(x.as_py(), shingle) for x in batch.column(1)]]

    return map_rows(docs.select("doc_id", "text"), columns, schema)


def linked(values: list[int], radius: int = RADIUS, block: int = GROUP_ROWS) -> list[tuple[int, int]]:
    """Spanning links between the values at most ``radius`` bits apart.

    Blocks of values are stored as bit planes: plane p holds bit p of every value. One
    value is compared with a whole block by adding the planes' differences into
    carry-save counters; a block is left as soon as all its values exceed the radius.
    """
    parent = list(range(len(values)))

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    mask = (1 << BITS) - 1
    values = [v & mask for v in values]
    width = (radius + 1).bit_length()
    blocks = []
    varied = 0
    for v in values:
        varied |= v ^ values[0]
    live = [p for p in range(BITS) if varied >> p & 1]
    for at in range(0, len(values), block):
        part = values[at : at + block]
        planes = [int("".join("1" if v >> p & 1 else "0" for v in reversed(part)), 2) for p in live]
        blocks.append((at, (1 << len(part)) - 1, planes))
    for i, v in enumerate(values):
        for at, full, planes in blocks:
            if at + full.bit_length() <= i + 1:
                continue
            near = full if at > i else full >> (i + 1 - at) << (i + 1 - at)
            counters = [0] * width
            for p, plane in zip(live, planes):
                carry = plane ^ full if v >> p & 1 else plane
                for k in range(width):
                    counters[k], carry = counters[k] ^ carry, counters[k] & carry
                over = near
                for k in range(width):
                    over &= counters[k] if radius + 1 >> k & 1 else ~counters[k]
                near &= ~over
                if not near:
                    break
            while near:
                low = near & -near
                a, b = root(i), root(at + low.bit_length() - 1)
                if a != b:
                    parent[max(a, b)] = min(a, b)
                near ^= low
    return [(values[i], values[root(i)]) for i in range(len(values)) if root(i) != i]


def _signed(x: int) -> int:
    return x - (1 << BITS) if x >> (BITS - 1) else x


def _bands(free: list[int], parts: int) -> list[int]:
    """Split bit numbers into ``parts`` masks of nearly equal size."""
    cut = [len(free) * k // parts for k in range(parts + 1)]
    return [sum(1 << b for b in free[a:b_]) for a, b_ in zip(cut, cut[1:])]


def _masks(radius: int, rows: int) -> list[dict[int, list[int]]]:
    """Levels of masks. Values within the radius agree on one mask of each level.

    The first level takes two of ``radius + 2`` bands. Each further level adds one of
    ``radius + 1`` bands of the bits still free, until a mask leaves so few bits free that
    ``rows`` distinct values cannot share it.
    """
    first = [a | b for a, b in combinations(_bands(list(range(BITS)), radius + 2), 2)]
    levels = [{0: first}]
    while 1 << (BITS - min(m.bit_count() for m in sum(levels[-1].values(), []))) > rows:
        finer = {}
        for m in dict.fromkeys(sum(levels[-1].values(), [])):
            free = [p for p in range(BITS) if not m >> p & 1]
            if len(free) <= radius:
                finer[m] = [m]
            else:
                finer[m] = [m | band for band in _bands(free, radius + 1) if band]
        if all(v == [k] for k, v in finer.items()):
            break
        levels.append(finer)
    return levels


def links(values: DataFrame, radius: int = RADIUS, group_rows: int = GROUP_ROWS) -> DataFrame:
    """(a, b): links that connect the distinct values ``fp`` at most ``radius`` bits apart, as a spanning forest per group.

    Values are grouped by masked bits (pigeonhole: no link is missed). A group of over
    ``group_rows`` values is not compared but dealt out again on finer masks, down to masks
    that so many values cannot share; no group is dropped or cut.
    """
    levels = _masks(radius, group_rows)
    keyed = values.select("fp", F.lit(0).cast("long").alias("mask"))
    ready = []
    for depth, level in enumerate(levels):
        finer = F.create_map(*[x for m, to in level.items() for x in (F.lit(_signed(m)), F.array(*[F.lit(_signed(t)) for t in to]))])
        keyed = keyed.select("fp", F.explode(finer[F.col("mask")]).alias("mask"))
        if depth:
            keyed = keyed.distinct()
        keyed = keyed.withColumn("value", F.col("fp").bitwiseAND(F.col("mask")))
        counts = keyed.groupBy("mask", "value").agg(F.count("*").alias("n")).where("n > 1")
        shared = stored(keyed.join(counts, ["mask", "value"]), "shared-bits")
        last = depth == len(levels) - 1
        ready.append(shared if last else shared.where(F.col("n") <= group_rows))
        keyed = shared.where(F.col("n") > group_rows).select("fp", "mask")
        if last or keyed.isEmpty():
            break
    groups = ready[0]
    for more in ready[1:]:
        groups = groups.union(more)
    groups = groups.groupBy("mask", "value").agg(F.sort_array(F.collect_list("fp")).alias("fps")).select("fps")
    schema = StructType([StructField("a", LongType()), StructField("b", LongType())])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for group in batch.column(0):
                found = linked(group.as_py(), radius)
                if found:
                    yield pa.RecordBatch.from_arrays([pa.array([_signed(x[k]) for x in found], pa.int64()) for k in (0, 1)], names=["a", "b"])

    return in_tasks(groups, compare, schema)


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """(doc_id, fp, root, component_id) for every row of ``docs`` (columns doc_id, text).

    ``root`` is the least fingerprint of the component and ``component_id`` the smallest
    doc_id reachable over links (a missing doc_id is passed over; null where no member has
    one). Missing and empty texts have fingerprint 0 and are linked like any other; equal
    texts and repeated rows share a fingerprint. Other columns are not read.
    """
    marked = stored(fingerprints(docs, shingle), "fingerprints")
    values = stored(marked.groupBy("fp").agg(F.min("doc_id").alias("first")), "values")
    found = components(links(values.select("fp"), radius)).select(F.col("node").alias("fp"), "root")
    named = values.join(found, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    named = stored(named, "roots")
    least = named.where("root <> fp").select("root").distinct()
    grouped = named.join(least, "root").groupBy("root").agg(F.min("first").alias("least"))
    ids = named.join(grouped, "root", "left").select("fp", "root", F.when(F.col("least").isNotNull(), F.col("least")).otherwise(F.col("first")).alias("component_id"))
    return marked.join(ids, "fp").select("doc_id", "fp", "root", "component_id")


def keep_one(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """One row of ``docs`` for each component, all columns kept: the one with the smallest doc_id.

    Rows that repeat that doc_id leave one (the least text first). A component without any
    doc_id keeps its least text.
    """
    found = near_duplicates(docs, shingle, radius)
    kept = found.where("doc_id = component_id").select(F.col("doc_id").alias("__kept")).distinct()
    named = docs.where("doc_id is not null").join(kept, F.col("doc_id") == F.col("__kept"), "left_semi")
    first = Window.partitionBy("doc_id").orderBy(*row_order(docs, "text"))
    named = named.withColumn("__nth", F.row_number().over(first)).where("__nth = 1").select(*docs.columns)
    return named.unionByName(_keep_unnamed(docs, found, shingle))


def _keep_unnamed(docs: DataFrame, found: DataFrame, shingle: int) -> DataFrame:
    """One row for each component in which no document has an id."""
    bare = found.where("component_id is null").select(F.col("fp").alias("__fp"), F.col("root").alias("__root")).distinct()
    texts = docs.where("doc_id is null")
    schema = StructType([*texts.schema.fields, StructField("__own", LongType())])
    at = texts.columns.index("text")

    def columns(batch):
        return [*batch.columns, [fingerprint(x.as_py(), shingle) for x in batch.column(at)]]

    marked = map_rows(texts, columns, schema).join(bare, F.col("__own") == F.col("__fp"))
    first = Window.partitionBy("__root").orderBy(*row_order(docs, "text"))
    return marked.withColumn("__nth", F.row_number().over(first)).where("__nth = 1").select(*docs.columns)


@query("op5_simhash_near_dedup")
def op5(t):
    found = near_duplicates(t.documents)
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
