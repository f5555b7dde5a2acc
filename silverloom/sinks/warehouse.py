"""Landed batches and staging tables.

A table is the set of immutable folders its commits name. A load writes new folders and
then one commit, so a reader sees all of a load or nothing of it, and a crashed load
leaves the table as it was. An upsert rewrites only the key buckets the delta touches.
"""

from __future__ import annotations

import datetime as dt
import re
import uuid
from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import AtomicType, BooleanType, StructType

from ..operators.dedupe import deduplicate
from ..sources.change import fingerprint_columns
from . import files
from .commits import Change, CommitLog, State, merged
from .ledger import Ledger

_BUCKET = "_bucket"
BUCKETS = 32
BUCKET_ROWS = 5_000_000
LOOKUP_KEYS = 1000
_PART = "_part"
PARTS = 8  # a first load's draft has so many parts by key
LAYOUT_ROWS = 20_000_000  # most rows of a draft that are laid out at once
# Hashed keys are half of many rows; snappy leaves their hex digits as they are.
CODEC = {"compression": "zstd", "parquet.compression.codec.zstd.level": "1"}


@dataclass(frozen=True)
class Batch:
    """A landed batch. ``newer``: it holds a mark after the one asked about."""

    batch_id: str
    path: str
    rows: int
    watermark: str | None = None
    checksum: str | None = None
    newer: bool = True


def new_batch_id(source_id: str, at: dt.datetime | None = None) -> str:
    """``<source>_<yyyymmdd_hhmmss>`` and a suffix that keeps two batches of one second apart."""
    at = at or dt.datetime.now(dt.timezone.utc)
    return f"{source_id}_{at:%Y%m%d_%H%M%S}_{uuid.uuid4().hex[:8]}"


class Warehouse:
    """``buckets`` is the least number of key buckets; more are made as a table passes ``bucket_rows`` rows for each."""

    def __init__(self, spark: SparkSession, root: str, buckets: int = BUCKETS, bucket_rows: int = BUCKET_ROWS):
        self.spark = spark
        self.root = root.rstrip("/")
        self.buckets = buckets
        self.bucket_rows = bucket_rows
        self.ledger = Ledger(spark, f"{self.root}/ledger")
        self.log = CommitLog(spark, f"{self.root}/commits")

    # -- raw batches

    def land(
        self,
        df: DataFrame,
        kind: str,
        key: str,
        batch_id: str,
        watermark: str | None = None,
        shape: Callable[[DataFrame], DataFrame] | None = None,
        checksum: bool = False,
        after=None,
    ) -> Batch:
        """Write a raw batch, its columns as ``shape`` makes them.

        Row count, highest watermark, whether that is past ``after``, and the checksum come
        from the same pass over the rows as they were read.
        """
        path = f"{self.root}/raw/{kind}/{key}/{batch_id}"
        seen = Observation()
        mark = F.max(F.col(watermark)) if watermark else F.lit(None)
        newer = mark > F.lit(after).cast(df.schema[watermark].dataType) if watermark and after is not None else F.lit(True)
        measures = {
            "rows": F.count(F.lit(1)),
            "mark": F.max(mark.cast("string")) if not watermark else mark.cast("string"),
            "newer": F.coalesce(newer, F.lit(False)) if watermark and after is not None else F.max(F.lit(True)),
            "checksum": fingerprint_columns(df) if checksum else F.max(F.lit(None).cast("string")),
        }
        seen_rows = df.observe(seen, *[m.alias(name) for name, m in measures.items()])
        (shape(seen_rows) if shape else seen_rows).write.options(**CODEC).parquet(path)
        found = seen.get
        return Batch(batch_id, path, found["rows"], found["mark"], found["checksum"], bool(found["newer"]))

    def forget(self, batch: Batch) -> None:
        """Remove a landed batch that is not going to be registered."""
        files.delete(self.spark, batch.path)

    def read_batch(self, path: str) -> DataFrame:
        return self.spark.read.parquet(path)

    # -- tables

    def table(self, name: str, version: int | None = None) -> DataFrame:
        state = self.log.state(name, version)
        if not state.paths:
            raise LookupError(f"table {name} has no load yet")
        return self._read(state.paths, state.schema)

    def exists(self, name: str) -> bool:
        return bool(self.log.state(name).paths)

    def _read(self, paths, schema: StructType) -> DataFrame:
        return self.spark.read.schema(schema).parquet(*paths)

    def _folder(self, table: str) -> str:
        return f"{self.root}/tables/{table}/{uuid.uuid4().hex}"

    def _written(self, table: str, df: DataFrame, cluster_by: str | None = None) -> tuple[str, int]:
        folder, seen = self._folder(table), Observation()
        rows = df.observe(seen, F.count(F.lit(1)).alias("rows"))
        if cluster_by:
            rows = rows.repartitionByRange(cluster_by).sortWithinPartitions(cluster_by)
        rows.write.options(**CODEC).parquet(folder)
        return folder, seen.get["rows"]

    def truncate(self, table: str, df: DataFrame, cluster_by: str | None = None) -> Change:
        """A table replaced by ``df``. With ``cluster_by`` its files have ranges of that column, so a filter on it skips the others."""
        base = self.log.state(table).version
        folder, rows = self._written(table, df, cluster_by)
        return Change(table, base, (folder,), df.schema, rows, reset=True)

    def append(self, table: str, df: DataFrame, cluster_by: str | None = None) -> Change:
        """Rows added; new columns are null in older rows, types widen or the load fails. ``cluster_by`` as in ``truncate``."""
        schema = merged(self.log.state(table).schema, df.schema)
        folder, rows = self._written(table, _conformed(df, schema), cluster_by)
        return Change(table, None, (folder,), df.schema, rows)

    def _bucket(self, key, n: int) -> Column:
        return F.pmod(F.xxhash64(*key), F.lit(n)).cast("int")

    def _buckets_for(self, rows: int) -> int:
        need = -(-rows // self.bucket_rows)
        return max(self.buckets, 1 << max(0, need - 1).bit_length())

    def upsert(self, table: str, delta: DataFrame, key, newest_first: list[Column] | None = None, keep_all: bool = False) -> Change:
        """A table after replacing and adding rows by key.

        A key that occurs twice in the delta keeps its newest row; further columns decide
        between equals, so the same delta always leaves the same row. With ``keep_all`` all rows
        of the delta stay: the table's rows of its keys go, then the delta is added. Buckets
        without a delta row keep their folders; when the table has outgrown its buckets it
        is laid out anew.
        """
        if not key:
            raise ValueError("an upsert needs a key")
        key = list(key)
        state = self.log.state(table)
        if not state.paths:
            return self._first(table, delta, key, newest_first, keep_all, state)
        schema = merged(state.schema, delta.schema)
        delta = _conformed(delta, schema)
        old_key = [f.dataType for f in state.schema.fields if f.name in key]
        same_key = state.buckets is not None and tuple(key) == state.key and old_key == [f.dataType for f in schema.fields if f.name in key]
        n = max(self.buckets, state.buckets or 0)
        touched = self._touched(delta, key, n)
        wanted = self._buckets_for(state.row_bound + sum(touched.values()))
        if wanted > n:
            n, touched = wanted, self._touched(delta, key, wanted)
        if not touched:
            return Change(table, None, (), delta.schema, 0)
        anew = not same_key or n != state.buckets
        numbers = {p: re.search(rf"{_BUCKET}=(\d+)$", p) for p in state.paths}
        stale = [p for p, b in numbers.items() if anew or int(b[1]) in touched]
        latest = delta if keep_all else _newest_rows(delta, key, newest_first)
        result = latest
        if stale:
            base = self._read(stale, state.schema)
            keys = delta.select(*[F.col(c).alias(f"_k_{i}") for i, c in enumerate(key)])
            same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_k_{i}")) for i, c in enumerate(key)])
            result = _conformed(base.join(keys, same, "left_anti"), schema).unionByName(latest, allowMissingColumns=True)
        folder = self._folder(table)
        self._write_buckets(result, folder, key, n, _key_filters(schema, key, max(1, state.row_bound + sum(touched.values())) // n))
        written = set(touched)
        if anew and stale:  # rows of the old layout may fall into any bucket
            written = {r[0] for r in self.spark.read.parquet(folder).select(_BUCKET).distinct().collect()}
        added = tuple(f"{folder}/{_BUCKET}={b}" for b in sorted(written))
        rows = state.row_bound + sum(touched.values())
        return Change(table, state.version, added, schema, rows, tuple(stale), anew, n, tuple(key))

    def _first(self, table: str, delta: DataFrame, key: list[str], newest_first, keep_all: bool, state: State) -> Change:
        """An upsert into a table without rows: they are made once, as a draft.

        The draft tells their number, and with it how many buckets there are. A large one is
        laid out a few parts at a time, so that no more than these are shuffled at once.
        """
        schema = merged(state.schema, delta.schema)
        delta = _conformed(delta, schema)
        drafted, folder = self._folder(table), self._folder(table)
        latest = delta if keep_all else _newest_rows(delta, key, newest_first)
        latest.withColumn(_PART, self._bucket(key, PARTS)).write.options(**CODEC).partitionBy(_PART).parquet(drafted)
        parts = [f"{drafted}/{f}" for f in files.folder_names(self.spark, drafted) if f.startswith(f"{_PART}=")]
        if not parts:
            files.delete(self.spark, drafted)
            return self.truncate(table, delta)
        rows = self._read(parts, schema).count()  # from the files' footers
        n = max(self._buckets_for(rows), state.buckets or 0)
        times = min(len(parts), -(-rows // LAYOUT_ROWS))
        for some in [parts[i::times] for i in range(times)]:
            self._write_buckets(self._read(some, schema), folder, key, n, _key_filters(schema, key, max(1, rows // n)))
            for part in some:
                files.delete(self.spark, part)
        files.delete(self.spark, drafted)
        written = sorted(int(f.rpartition("=")[2]) for f in files.folder_names(self.spark, folder) if f.startswith(f"{_BUCKET}="))
        added = tuple(f"{folder}/{_BUCKET}={b}" for b in written)
        return Change(table, state.version, added, schema, rows, reset=True, buckets=n, key=tuple(key))

    def _write_buckets(self, rows: DataFrame, folder: str, key: list[str], n: int, filters: dict[str, str]) -> None:
        # The rebalance hint gathers a bucket into few files but splits a bucket that is too large.
        bucketed = rows.withColumn(_BUCKET, self._bucket(key, n)).hint("rebalance", _BUCKET)
        bucketed.write.mode("append").options(**CODEC, **filters).partitionBy(_BUCKET).parquet(folder)

    def lookup(self, table: str, keys: list[tuple]) -> DataFrame:
        """The rows of a table that was upserted which have one of the keys (at most ``LOOKUP_KEYS``).

        Only the folders of the keys' buckets are read, and of their files only row groups
        whose Bloom filters may hold a key.
        """
        state = self.log.state(table)
        if not state.buckets:
            raise ValueError(f"table {table} is not laid out by key")
        if len(keys) > LOOKUP_KEYS:
            raise ValueError(f"{len(keys)} keys, at most {LOOKUP_KEYS}; join the table instead")
        wanted = self.spark.createDataFrame(keys, StructType([f for c in state.key for f in state.schema.fields if f.name == c]))
        buckets = {r[0] for r in wanted.select(self._bucket(state.key, state.buckets)).collect()}
        paths = [p for p in state.paths if int(re.search(rf"{_BUCKET}=(\d+)$", p)[1]) in buckets]
        if not paths:
            return self.spark.createDataFrame([], state.schema)
        types = [state.schema[c].dataType for c in state.key]
        same = [reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.lit(v).cast(t)) for c, v, t in zip(state.key, key, types)]) for key in keys]
        return self._read(paths, state.schema).where(reduce(lambda a, b: a | b, same))

    def _touched(self, delta: DataFrame, key, n: int) -> dict[int, int]:
        """Rows of the delta by bucket (as many rows as there are buckets at most)."""
        return dict(delta.groupBy(self._bucket(key, n)).count().collect())

    def load(self, table: str, df: DataFrame, mode: str, key=(), newest_first=None) -> Change:
        if mode == "truncate":
            return self.truncate(table, df)
        if mode == "append":
            return self.append(table, df)
        if mode == "upsert":
            return self.upsert(table, df, key, newest_first)
        if mode == "delete_insert":
            return self.upsert(table, df, key, keep_all=True)
        raise ValueError(f"unknown load mode {mode!r}")

    def commit(self, batch_id: str, table: str, change: Change, at=None, source_id: str | None = None) -> int:
        version = self.log.commit(change, batch_id)
        self.ledger.mark_loaded(batch_id, table, version, at, source_id)
        return version

    def restore(self, table: str, version: int) -> Change:
        """The table as it was at a version; nothing is written but the commit."""
        old: State = self.log.state(table, version)
        return Change(table, self.log.state(table).version, old.paths, old.schema, old.row_bound, reset=True, buckets=old.buckets, key=old.key)

    def drop(self, table: str) -> None:
        """Remove a table with all its versions and rows. Nobody may be reading it; it cannot be restored."""
        self.log.drop(table)
        files.delete(self.spark, f"{self.root}/tables/{table}")

    def compact(self, table: str) -> Change:
        """The same rows in one folder, in place of many small loads."""
        state = self.log.state(table)
        folder, rows = self._written(table, self._read(state.paths, state.schema).hint("rebalance"))
        return Change(table, state.version, (folder,), state.schema, rows, reset=True)


def _newest_rows(delta: DataFrame, key: list[str], newest_first: list[Column] | None) -> DataFrame:
    """One row per key, the newest; all further columns decide between equals."""
    rest = [F.col(f"`{f.name}`").desc_nulls_last() for f in delta.schema.fields if isinstance(f.dataType, AtomicType)]
    return deduplicate(delta, key, [*(newest_first or []), *rest])


def _key_filters(schema: StructType, key, rows: int) -> dict[str, str]:
    """Writer options for Bloom filters on key columns, sized for the rows of a bucket."""
    options = {}
    for c in key:
        if not isinstance(schema[c].dataType, BooleanType):
            options |= {f"parquet.bloom.filter.enabled#{c}": "true", f"parquet.bloom.filter.expected.ndv#{c}": str(max(1024, rows))}
    return options


def _conformed(df: DataFrame, schema: StructType) -> DataFrame:
    """Columns of ``df`` in the types of ``schema``."""
    types = {f.name: f.dataType for f in schema.fields}
    return df.select(*[F.col(f"`{c}`").cast(types[c]).alias(c) for c in df.columns])
