"""Mixing sources to target weights by balanced sampling with the cube method."""

from __future__ import annotations

import math
from decimal import Decimal
from fractions import Fraction
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.ordered import in_order, repeat_rows
from .common import SPACES, row_order, ship, stored
from .registry import query

WEIGHTS = (5, 2, 1)
REPEATS = 3
BLOCK_ROWS = 4096
EXCHANGES = 16


def size_of(text: Column) -> Column:
    """Number of runs of other characters than white space; 0 for a missing text."""
    return F.coalesce(F.regexp_count(text, F.lit(f"[^{SPACES}]+")), F.lit(0)).cast("long")


def targets(sources: DataFrame, weights: tuple[int, ...] = WEIGHTS, repeats: int = REPEATS) -> DataFrame:
    """The rows of ``sources``, one per source (source, source_size), with nth and target.

    Sources in code point order, missing one last, take the weights in turn. A target is
    min(repeats * size, rate * weight), with the rate that makes the targets add up to all
    sizes. It is found as the excess is reshared: sources above their limit at a rate are
    closed, which raises it for the others, until none is above. A round is one sum over the
    sources in whole numbers; neither it nor the numbering brings all sources to one task.
    """
    shares = [Fraction(w) for w in weights]
    scale = math.lcm(*(w.denominator for w in shares))
    choice = F.array(*[F.lit(int(w * scale)).cast("long") for w in shares])
    numbered = in_order(sources, [], ["source"], number="nth").withColumn("nth", F.col("nth").cast("int"))
    limit = (F.col("source_size") * repeats).cast("decimal(38,0)")
    weighed = stored(numbered.select("*", F.element_at(choice, (F.col("nth") - 1) % len(weights) + 1).alias("weight"), limit.alias("limit")), "sources")
    total, heft = weighed.agg(F.sum(F.col("source_size").cast("decimal(38,0)")), F.sum("weight")).first()
    rate, closed = Fraction(int(total or 0), int(heft or 1)), 0
    while closed < (heft or 0):
        # limit < rate * weight, without fractions.
        above = F.col("limit") * F.lit(Decimal(rate.denominator)) < F.col("weight") * F.lit(Decimal(rate.numerator))
        spent, gone = weighed.agg(F.sum(F.when(above, F.col("limit"))), F.sum(F.when(above, F.col("weight")).otherwise(0))).first()
        if gone == closed:
            break
        closed = int(gone)
        rate = Fraction(int(total) - int(spent), int(heft) - closed) if closed < heft else rate
    target = F.least(F.col("limit").cast("double"), F.lit(float(rate)) * F.col("weight"))
    return weighed.select("nth", *sources.columns, target.alias("target"))


def flight(size: np.ndarray, part: np.ndarray, seed: int, land: bool) -> np.ndarray:
    """Move inclusion probabilities ``part`` to 0 or 1, keeping their sum and the sum of sizes.

    Three open units at a time lie in a one-dimensional null space of the two constraints;
    a step along it closes at least one. At most two units stay open (they cannot move
    without changing a total); ``land`` closes these by the outcome nearest to both totals
    and makes up for what is left of the sizes by exchanging taken and untaken units.
    """
    random = np.random.default_rng(seed)
    part = part.astype(float).copy()
    free = np.flatnonzero((part > 0) & (part < 1))
    wanted = float((part * size)[free].sum())
    todo = [int(i) for i in free]
    window: list[int] = []
    while True:
        while todo and len(window) < 3:
            window.append(todo.pop())
        s = [float(size[i]) for i in window]
        if len(window) == 3:
            u = [s[2] - s[1], s[0] - s[2], s[1] - s[0]]
            if not any(u):
                u = [1.0, -1.0, 0.0]
        elif len(window) == 2 and s[0] == s[1]:
            u = [1.0, -1.0]
        else:
            break
        scale = max(map(abs, u))
        u = [x / scale for x in u]
        p = [part[i] for i in window]
        up = min(((1 - q) / x if x > 0 else q / -x) for q, x in zip(p, u) if x)
        down = min((q / x if x > 0 else (1 - q) / -x) for q, x in zip(p, u) if x)
        step = up if random.random() * (up + down) < down else -down
        for i, q, x in zip(window, p, u):
            q += step * x
            part[i] = 0.0 if q < 1e-9 else 1.0 if q > 1 - 1e-9 else q
        window = [i for i in window if 0 < part[i] < 1]
    if land and window:
        mass, words = sum(part[i] for i in window), sum(part[i] * size[i] for i in window)

        def off(outcome):
            return abs(sum(o * size[i] for o, i in zip(outcome, window)) - words), abs(sum(outcome) - mass), outcome

        for i, o in zip(window, min(product((0, 1), repeat=len(window)), key=off)):
            part[i] = float(o)
    if land:
        _exchange(size, part, free, wanted)
    return part


def _exchange(size: np.ndarray, part: np.ndarray, free: np.ndarray, wanted: float) -> None:
    """Exchange a taken for an untaken unit as long as that brings the taken sizes nearer to ``wanted``; their number stays."""
    for _ in range(EXCHANGES):
        taken, rest = free[part[free] == 1], free[part[free] == 0]
        short = wanted - float(size[taken].sum())
        if not len(taken) or not len(rest):
            return
        taken = taken[np.argsort(size[taken], kind="stable")]
        # Taking i for j changes the sum by size[i] - size[j], which should be what is missing.
        at = np.searchsorted(size[taken], size[rest] - short)
        near = np.stack([np.clip(at - 1, 0, len(taken) - 1), np.clip(at, 0, len(taken) - 1)])
        off = np.abs(short - (size[rest] - size[taken][near]))
        side, i = np.unravel_index(int(off.argmin()), off.shape)
        if off[side, i] > abs(short) - 1:
            return
        part[rest[i]], part[taken[near[side, i]]] = 1.0, 0.0


def _fly(table: pa.Table) -> pa.Table:
    table = table.sort_by([("key", "ascending"), ("row", "ascending"), ("size", "ascending")])
    nth, block, blocks, limit = (table.column(c)[0].as_py() for c in ("nth", "block", "blocks", "block_rows"))
    size = table.column("size").to_numpy()
    seed = np.random.SeedSequence([nth, block, int(size.sum())]).generate_state(1)[0]
    part = flight(size, table.column("part").to_numpy(), seed, land=blocks == 1)
    kept = table.drop_columns(["part", "blocks"]).append_column("part", pa.array(part, pa.float64()))
    # At most two rows of each block stay open.
    rest = pa.array([-(-2 * blocks // limit)] * len(table), pa.int64())
    return kept.append_column("blocks", rest).select(_NAMES)


_RUN = 100_000
_NAMES = ["row", "doc_id", "key", "nth", "size", "source_size", "target", "whole", "part", "blocks"]
_OPEN = "part > 0 and part < 1"
_FIELDS = "row long, doc_id {id}, key long, nth int, size long, source_size long, target double, whole int, part double, blocks long"


def _named(docs: DataFrame) -> DataFrame:
    """``docs`` with ``__key``, a hash of all columns that can be ordered; rows with the same are alike."""
    values = row_order(docs)
    gaps = F.concat(*[F.when(c.isNull(), "1").otherwise("0") for c in values])
    return docs.withColumn("__key", F.xxhash64(*values, gaps))


def _alike(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(units, repeated): rows (row, doc_id, source, size), a row for each of ``docs``; and those among them, with their key, that are alike to others.

    Rows that are alike are counted before any shuffle and dealt out again in runs of
    ``_RUN``, so a row repeated very often is spread over tasks.
    """
    sized = _named(docs).select(F.col("__key").alias("key"), "doc_id", "source", size_of(F.col("text")).alias("size"))
    groups = stored(sized.groupBy("key", "doc_id", "source", "size").agg(F.count(F.lit(1)).alias("n")), "groups")
    single, repeated = groups.where("n = 1"), groups.where("n > 1")
    units = single.select(F.col("key").alias("row"), "doc_id", "source", "size")
    runs = repeated.withColumn("run", F.explode(F.expr(f"sequence(0L, (n - 1) div {_RUN})"))).repartition("key", "run")
    nth = F.explode(F.sequence(F.col("run") * _RUN, F.least(F.col("n"), (F.col("run") + 1) * _RUN) - 1))
    again = runs.select("key", "doc_id", "source", "size", nth.alias("nth"))
    again = again.select(F.xxhash64("key", "nth").alias("row"), "doc_id", "source", "size", "key")
    return units.unionByName(again.drop("key")), again


def sizes(docs: DataFrame) -> DataFrame:
    """(row, doc_id, source, size) of every row; ``row`` is a hash that names it."""
    return _alike(docs)[0]


def mix(sized: DataFrame, weights: tuple[int, ...] = WEIGHTS, repeats: int = REPEATS, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(row, doc_id, size, source_size, target, copies) from rows (row, doc_id, source, size).

    A source's rows are taken target / size times on average: the whole part by all rows, the
    rest by a balanced draw that keeps the source's numbers of rows and of words. The draw runs in blocks
    of about ``block_rows`` rows dealt by a hash, also within one source, and again over
    the few rows each block leaves open, until one block per source lands. Random numbers
    come from the block's number and content, so reruns agree. Rows without words are
    never taken; an empty table gives an empty result.
    """
    kind = sized.schema["doc_id"].dataType.simpleString()
    ship(sized.sparkSession)
    sized = stored(sized.select("row", "doc_id", "source", "size"), "sizes")
    totals = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count_if(F.col("size") > 0).alias("filled"))
    goals = targets(totals, weights, repeats)
    goals = stored(goals.withColumnRenamed("source", "goal_source"), "targets")
    rate = F.when(F.col("source_size") > 0, F.least(F.col("target") / F.col("source_size"), F.lit(float(repeats)))).otherwise(0.0)
    units = sized.join(goals, F.col("source").eqNullSafe(F.col("goal_source"))).withColumn("rate", rate)
    near = F.abs(F.col("rate") - F.round("rate")) < 1e-9
    units = units.withColumn("whole", F.when(F.col("size") == 0, 0).when(near, F.round("rate")).otherwise(F.floor("rate")).cast("int"))
    part = F.when(near | (F.col("size") == 0), 0.0).otherwise(F.col("rate") - F.col("whole"))
    key = F.xxhash64("doc_id", "row", "size")
    blocks = F.ceil(F.col("filled") / block_rows).cast("long")
    units = units.select("row", "doc_id", key.alias("key"), "nth", "size", "source_size", "target", "whole", part.alias("part"), blocks.alias("blocks"))
    done = [units.where(f"not ({_OPEN})")]
    open_, turn = units.where(_OPEN), 0
    while True:
        dealt = open_.withColumn("block", F.pmod(F.xxhash64("key", F.lit(turn)), F.col("blocks"))).withColumn("block_rows", F.lit(block_rows))
        flown = stored(dealt.groupBy("nth", "block").applyInArrow(_fly, _FIELDS.format(id=kind)), "flight")
        done.append(flown.where(f"not ({_OPEN})"))
        open_, turn = flown.where(_OPEN), turn + 1
        if open_.isEmpty():
            break
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out.select("row", "doc_id", "size", "source_size", "target", (F.col("whole") + F.col("part").cast("int")).alias("copies"))


def repeat_mixed(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, repeats: int = REPEATS) -> DataFrame:
    """``docs`` with every row as often as the mix takes it, in the columns of ``docs``."""
    units, again = _alike(docs)
    taken = stored(mix(units, weights, repeats).where("copies > 0").select(F.col("row").alias("__row"), F.col("copies").alias("__copies")), "taken")
    named = _named(docs)
    # The key alone is joined on, so that the texts are shuffled once; the same way at every size.
    found = named.join(taken.hint("merge"), F.col("__key") == F.col("__row"))
    out = found.withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("__copies")))).select(*docs.columns)
    total = again.select(F.col("key").alias("__same"), "row").join(taken, F.col("row") == F.col("__row"))
    total = stored(total.groupBy("__same").agg(F.sum("__copies").alias("__copies")), "repeated")
    if total.isEmpty():
        return out
    # Of rows that are alike one stands for all, with the copies of all.
    one = named.join(total, F.col("__key") == F.col("__same")).dropDuplicates(["__key"]).select(*docs.columns, "__copies")
    return out.unionByName(repeat_rows(one, F.col("__copies")).select(*docs.columns))


@query("op7_mix_sources")
def op7(t):
    found = mix(sizes(t.documents.select("doc_id", "source", "text")))
    return found.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))
