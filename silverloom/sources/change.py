"""Has a source changed since its last load?"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .tables import newer_than


def row_hash(df: DataFrame) -> Column:
    """64-bit hash of a row, nulls included (xxhash64 alone skips them)."""
    names = [F.col("`" + c.replace("`", "``") + "`") for c in df.columns]
    gaps = F.concat(*[F.when(c.isNull(), "1").otherwise("0") for c in names])
    return F.xxhash64(*names, gaps)


def fingerprint_columns(df: DataFrame) -> Column:
    """Order-free checksum as an aggregate: row count, sum and xor of the row hashes."""
    h = row_hash(df)
    total = F.sum(h.cast("decimal(38,0)"))
    return F.md5(
        F.concat_ws("|", F.count(F.lit(1)).cast("string"), total.cast("string"), F.bit_xor(h).cast("string"))
    )


def fingerprint(df: DataFrame) -> str:
    return df.agg(fingerprint_columns(df).alias("f")).first()["f"]


def has_newer(df: DataFrame, watermark_column: str, last) -> bool:
    """Any row after the last watermark; without one, any row at all."""
    return not newer_than(df, watermark_column, last).select(watermark_column).limit(1).isEmpty()


def next_watermark(df: DataFrame, column: str) -> Column:
    return F.max(column).cast("string")


# Which ranges of keys changed between two versions: a tree of order-free fingerprints.

LEAF_KEYS = 4096
FAN_OUT = 16
_MEASURES = ("n", "total", "mixed")


def _measured(rows: DataFrame) -> list[Column]:
    h = row_hash(rows)
    return [F.count(F.lit(1)).alias("n"), F.sum(h.cast("decimal(38,0)")).alias("total"), F.bit_xor(h).alias("mixed")]


def fingerprint_tree(df: DataFrame, key: str, leaf_keys: int = LEAF_KEYS, fan_out: int = FAN_OUT, levels: int = 4) -> DataFrame:
    """(level, node, n, total, mixed): fingerprints of the rows by range of a whole-number ``key``.

    A node of level 0 has the rows of ``leaf_keys`` keys, ``node * leaf_keys`` and on; one of
    a level above those of ``fan_out`` nodes. Counts, sums and exclusive ors do not depend
    on the order of rows, so a node's are those of its children added up: the leaves are one
    pre-aggregated pass over the rows, the levels above them are sums of a few numbers.
    Rows without a key are in the node ``null`` of each level. The table is small enough to
    be kept with a version, of which nothing else is then needed to tell what changed.
    """
    node = F.floor(F.col(key).cast("decimal(38,0)") / leaf_keys).cast("bigint")
    level = df.groupBy(node.alias("node")).agg(*_measured(df)).select(F.lit(0).alias("level"), "node", *_MEASURES)
    out = level
    for i in range(1, levels):
        above = F.floor(F.col("node") / fan_out).cast("bigint").alias("node")
        sums = [F.sum("n").alias("n"), F.sum("total").alias("total"), F.bit_xor("mixed").alias("mixed")]
        level = level.groupBy(above).agg(*sums).select(F.lit(i).alias("level"), "node", *_MEASURES)
        out = out.unionByName(level)
    return out


def changed_ranges(old: DataFrame, new: DataFrame, leaf_keys: int = LEAF_KEYS, fan_out: int = FAN_OUT, levels: int = 4) -> DataFrame:
    """(low, high, n_old, n_new): ranges of keys, ends included, whose rows differ between two trees; both null for rows without a key.

    From the top down: only children of nodes that differ are compared, so where little
    changed little of the stored trees is read.
    """
    differing = None
    for level in reversed(range(levels)):
        a, b = (t.where(F.col("level") == level).drop("level") for t in (old, new))
        if differing is not None:
            parents = differing.select(F.col("node").alias("_parent"))
            above = F.floor(F.col("node") / fan_out).cast("bigint")
            a, b = (x.join(parents, above.eqNullSafe(F.col("_parent")), "left_semi") for x in (a, b))
        b = b.select(F.col("node").alias("_node"), *[F.col(c).alias(f"_{c}") for c in _MEASURES])
        both = a.join(b, F.col("node").eqNullSafe(F.col("_node")) & (F.coalesce("n", "_n") > 0), "full")
        same = F.lit(True)
        for c in _MEASURES:
            same = same & F.col(c).eqNullSafe(F.col(f"_{c}"))
        # A few rows, kept: the level below asks for them on both sides.
        differing = cut_lineage(both.where(~same).select(F.coalesce("node", "_node").alias("node"), "n", "_n"))
    low = F.col("node") * leaf_keys
    return differing.select(
        low.alias("low"), (low + (leaf_keys - 1)).alias("high"), F.coalesce("n", F.lit(0)).cast("bigint").alias("n_old"), F.coalesce("_n", F.lit(0)).cast("bigint").alias("n_new")
    )


def changed_rows(old: DataFrame, new: DataFrame, key: str, ranges: DataFrame, leaf_keys: int = LEAF_KEYS) -> DataFrame:
    """Rows that only one version has, or has more often, with ``change`` (removed or added) and ``copies``.

    Only rows in the changed ranges are compared; what is equal is counted away first.
    """
    wanted = ranges.select(F.floor(F.col("low") / leaf_keys).cast("bigint").alias("_leaf"))
    leaf = F.floor(F.col(key).cast("decimal(38,0)") / leaf_keys).cast("bigint")
    sides = []
    for df, sign in ((old, -1), (new, 1)):
        sides.append(df.join(wanted, leaf.eqNullSafe(F.col("_leaf")), "left_semi").withColumn("_sign", F.lit(sign)))
    columns = [F.col("`" + c.replace("`", "``") + "`") for c in new.columns]
    counted = sides[0].unionByName(sides[1]).groupBy(*columns).agg(F.sum("_sign").alias("_more")).where("_more <> 0")
    return counted.select(*columns, F.when(F.col("_more") > 0, "added").otherwise("removed").alias("change"), F.abs("_more").cast("bigint").alias("copies"))
