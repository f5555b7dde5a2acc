"""Row numbers, neighbours and counts within groups that may be very large.

A window function sorts a whole group in one task. That is right for ordinary groups, but
not for one that holds a third of all rows, nor for a whole table without groups. Here all
rows lie in one order, by group and within it, which marks cut into ranges: rows that a
hash picks, about one in ``SPACING``. Most groups have no mark, or fewer than ``LARGE``, and
lie in one range; a large group is cut into many chunks. A window numbers the rows of each
chunk. Only groups that are cut carry anything from chunk to chunk: a row for each of their
chunks, at most two for a mark, is broadcast. Where no group is large, adaptive execution
drops the pass that counts what chunks carry. It is one lazy plan for groups of every size.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SPACING = 100_000
MARKS = 4096  # most marks of a table
LARGE = 4  # least marks of a group that is cut; with fewer it has hardly ever over 20 times SPACING rows
_PLACE, _CHUNK, _CUT = "_sl_place", "_sl_chunk", "_sl_cut"


def null_safe(left: DataFrame, right: DataFrame, columns: list[str]) -> Column:
    result = F.lit(True)
    for c in columns:
        result = result & left[c].eqNullSafe(right[c])
    return result


def group_counts(df: DataFrame, group: list[str], name: str) -> DataFrame:
    return df.groupBy(*group).agg(F.count(F.lit(1)).alias(name))


def _renamed(df: DataFrame, group: list[str]) -> tuple[DataFrame, Column]:
    """``df`` with its group columns out of the way, and the condition that a row belongs to its group."""
    out, on = df, F.lit(True)
    for i, c in enumerate(group):
        out = out.withColumnRenamed(c, f"_k_{i}")
        on = on & F.col(c).eqNullSafe(F.col(f"_k_{i}"))
    return out, on


def with_group_count(df: DataFrame, group: list[str], name: str) -> DataFrame:
    """``count(*) over (partition by group)`` as a pre-aggregated count joined back."""
    keyed, on = _renamed(group_counts(df, group, name), group)
    return df.join(keyed, on, "inner").select(*df.columns, name)


def _placed(columns: list[str], prefix: str) -> list[Column]:
    """Columns as parts of a place: in ascending order, nulls last."""
    parts = [F.struct(F.col(c).isNull().alias("missing"), F.col(c).alias("value")) for c in columns]
    return [p.alias(f"{prefix}{i}") for i, p in enumerate(parts)]


def _with_chunks(rows: DataFrame, group: list[str], spacing: int) -> DataFrame:
    """Add ``_CUT``: the row's group has ``LARGE`` marks, and ``_CHUNK``: then the number of marks up to the row's place, else 0."""
    return _all_and_cut(rows, {}, group, spacing)[0]


def _all_and_cut(df: DataFrame, made: Mapping[str, Column], group: list[str], spacing: int) -> tuple[DataFrame, DataFrame]:
    """All rows with the columns ``made``, ``_CUT`` and ``_CHUNK``, and those of groups that are cut alone."""
    rows = df.withColumns(dict(made))
    # Of the bare columns: a place is built only for a row that is drawn.
    draw = F.xxhash64(*[F.col(_PLACE)[f.name] if f.name == "tie" else F.col(_PLACE)[f.name]["value"] for f in rows.schema[_PLACE].dataType.fields])
    drawn = rows.select(_PLACE, draw.alias("_draw")).where(F.pmod("_draw", F.lit(spacing)) == 0).distinct()
    # The first by hash are a fair sample of all that were drawn.
    first = drawn.orderBy("_draw").limit(MARKS).agg(F.sort_array(F.collect_list(_PLACE)).alias("all"))
    # One row, drawn once: groups that are cut and the search below both read it.
    marks = rows.sparkSession.range(0, 1, 1, 1).select(first.scalar().alias("_sl_marks"))
    if not group:
        judged = _searched(rows.crossJoin(F.broadcast(marks)).withColumn(_CUT, F.size("_sl_marks") > 0))
        return judged, judged.where(_CUT)
    mark = marks.select(F.explode("_sl_marks").alias("_sl_mark"))
    held = mark.select(*[F.col("_sl_mark")[f"g{i}"]["value"].alias(c) for i, c in enumerate(group)])
    known = group_counts(held, group, "_sl_held").where(F.col("_sl_held") >= LARGE).drop("_sl_held")
    keyed, on = _renamed(known.withColumn("_sl_known", F.lit(True)), group)
    judged = rows.join(F.broadcast(keyed), on, "left").select(*rows.columns, F.col("_sl_known").isNotNull().alias(_CUT))
    # Right above the joins of ``df`` a semi join goes down to the table that has the group: rows of other groups meet none of them.
    cut = df.join(F.broadcast(keyed), on, "left_semi").withColumns({**made, _CUT: F.lit(True)})
    return _searched(judged.crossJoin(F.broadcast(marks))), _searched(cut.crossJoin(F.broadcast(marks)))


def _searched(judged: DataFrame) -> DataFrame:
    # Binary search, a column for each halving: plain columns are compiled and carry no marks from row to row,
    # and a row looks at 13 marks at most, however many there are.
    judged = judged.withColumn(_CHUNK, F.lit(0))
    for step in [1 << i for i in reversed(range(MARKS.bit_length()))]:
        passed = F.col(_CUT) & (F.get("_sl_marks", F.col(_CHUNK) + F.lit(step - 1)) <= F.col(_PLACE))
        judged = judged.withColumn(_CHUNK, F.col(_CHUNK) + F.when(passed, step).otherwise(0))
    return judged.drop("_sl_marks")


def in_order(
    df: DataFrame,
    group: list[str],
    order: list[str],
    number: str | None = None,
    before: Mapping[str, Column] | None = None,
    after: Mapping[str, Column] | None = None,
    spacing: int = SPACING,
    total: str | None = None,
    ties: bool = True,
) -> DataFrame:
    """Add a row number, values of the row before or after, and the number of rows, per group, by ascending ``order``, nulls last.

    Same result as ``row_number``, ``lag``, ``lead`` and ``count`` over a window; ``group``
    may be empty. Rows that tie on the order follow a hash of the row. Where the order tells
    rows apart, ``ties=False`` spares the hash, so that marks are drawn from a scan of the
    group and order columns alone.
    """
    before, after = dict(before or {}), dict(after or {})
    names = [n for n in (number, total, *before, *after) if n]
    spread = F.xxhash64(*[F.col("`" + c.replace("`", "``") + "`") for c in df.columns])
    place = F.struct(*_placed(group, "g"), *_placed(order, "o"), *([spread.alias("tie")] if ties else []))
    earlier = F.struct(F.lit(0).alias("_"), *[v.alias(n) for n, v in before.items()])
    later = F.struct(F.lit(0).alias("_"), *[v.alias(n) for n, v in after.items()])
    rows, cut = _all_and_cut(df, {_PLACE: place, "_sl_earlier": earlier, "_sl_later": later}, group, spacing)

    ends = cut.groupBy(*group, _CHUNK).agg(
        F.count(F.lit(1)).alias("_n"), F.max_by("_sl_earlier", _PLACE).alias("_last"), F.min_by("_sl_later", _PLACE).alias("_first")
    )
    parts = Window.partitionBy(*(group or [F.lit(0)]))
    chunks = parts.orderBy(_CHUNK)
    carried = ends.select(
        *group,
        F.col(_CHUNK).alias("_sl_at"),
        F.coalesce(F.sum("_n").over(chunks.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"),
        F.sum("_n").over(parts).alias("_all"),
        F.lag("_last").over(chunks).alias("_carried_earlier"),
        F.lead("_first").over(chunks).alias("_carried_later"),
    )
    whole = Window.partitionBy(*group, _CHUNK)
    tie = [F.col(_PLACE)["tie"]] if ties else []
    inside = whole.orderBy(*[F.asc_nulls_last(c) for c in order], *tie)
    placed = rows.withColumns(
        {
            **({"_sl_number": F.row_number().over(inside).cast("bigint")} if number else {}),
            **({"_sl_total": F.count(F.lit(1)).over(whole)} if total else {}),
            **({"_sl_earlier": F.lag("_sl_earlier").over(inside)} if before else {}),
            **({"_sl_later": F.lead("_sl_later").over(inside)} if after else {}),
        }
    )
    keyed, on = _renamed(carried, group)
    # At most two rows for a mark.
    joined = placed.join(F.broadcast(keyed), on & (F.col(_CHUNK) == F.col("_sl_at")), "left")
    previous, following = F.coalesce("_sl_earlier", "_carried_earlier"), F.coalesce("_sl_later", "_carried_later")
    columns = [(F.col("_sl_number") + F.coalesce("_before", F.lit(0))).alias(number)] if number else []
    columns += [F.coalesce("_all", "_sl_total").alias(total)] if total else []
    columns += [previous[n].alias(n) for n in before] + [following[n].alias(n) for n in after]
    return joined.select(*df.columns, *columns).select(*df.columns, *names)


def repeat_rows(df: DataFrame, times: Column, chunk: int = 100_000) -> DataFrame:
    """Each row ``times`` times; long runs are made chunk by chunk over all tasks."""
    counted = df.withColumn("_times", times.cast("bigint")).where(F.col("_times") > 0)
    chunks = F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("_times") - 1) / chunk).cast("bigint"))
    parts = counted.withColumn("_chunk", F.explode(chunks))
    spread = parts.repartition(df.sparkSession.sparkContext.defaultParallelism, *df.columns, "_chunk")
    rest = F.least(F.lit(chunk).cast("bigint"), F.col("_times") - F.col("_chunk") * chunk)
    return spread.withColumn("_i", F.explode(F.sequence(F.lit(1).cast("bigint"), rest))).select(*df.columns)
