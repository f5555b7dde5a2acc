"""Ways to keep a model's result: view, table, incremental table."""

from __future__ import annotations

import datetime as dt
import threading
from collections.abc import Callable, Iterable
from concurrent.futures import Future, ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import shuffles_removed
from ..sinks.warehouse import Warehouse
from .base import KINDS, MODELS, Found, Models, all_read


def as_view(df: DataFrame, name: str) -> DataFrame:
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)


def as_table(wh: Warehouse, name: str, df: DataFrame) -> DataFrame:
    """Replace a table in one step: the new rows are written first, then named."""
    wh.log.commit(wh.truncate(name, df))
    return wh.table(name)


def as_incremental(wh: Warehouse, name: str, df: DataFrame, key: list[str], newer_by: str | None = None) -> DataFrame:
    """Add rows newer than the table's newest. Rows of the same keys go first; rows that share a key all stay.

    The newest value is read from the folders a load has written and kept in the ledger with
    it, so the next load does not read the stored rows for it. A table that was changed
    otherwise since (restored, replaced) is asked itself.
    """
    if not newer_by:
        wh.log.commit(wh.upsert(name, df, key, keep_all=True))
        return wh.table(name)
    newest = _newest(wh, name, newer_by)
    kind = df.schema[newer_by].dataType
    if newest is not None:
        df = df.where(F.col(newer_by) > F.lit(newest).cast(kind))
    change = wh.upsert(name, df, key, keep_all=True)
    version = wh.log.commit(change)
    source, batch = f"model-{name}", f"model-{name}-{version}"
    if change.added:  # the folders just written have the newest rows
        newest = wh.spark.read.schema(change.schema).parquet(*change.added).agg(F.max(newer_by).cast("string")).first()[0]
    wh.ledger.register(source, batch, name, change.row_bound, source_type="model", watermark_value=newest)
    wh.ledger.mark_loaded(batch, name, version, source_id=source)
    return wh.table(name)


def _newest(wh: Warehouse, name: str, column: str) -> str | None:
    """The largest value of a table's column, as text: from the ledger if its last load is the table's last change."""
    state = wh.log.state(name)
    if not state.paths:
        return None
    last = wh.ledger.last_success(f"model-{name}")
    if last is not None and last["table_version"] == state.version:
        return last["watermark_value"]
    return wh.table(name).agg(F.max(column).cast("string")).first()[0]


def keep(wh: Warehouse, name: str, df: DataFrame) -> DataFrame:
    """Store a model's rows the way its record states and read them back."""
    kind = KINDS[name]
    if kind.kept == "view":
        return as_view(df, name)
    if kind.kept == "incremental":
        return as_incremental(wh, name, df, list(kind.key), kind.newer_by)
    return as_table(wh, name, df)


AT_ONCE = 4  # models stored at the same time


class StoredModels(Models):
    """Builds each model once and stores it; a model that reads another reads what is stored.

    ``build`` stores a few models at the same time, so that one fills the cores that another
    leaves idle while it is planned, ends its last tasks or is committed. With ``temporary``
    tables ``each`` drops a table once it is used and no model that is still to come reads it.
    """

    def __init__(
        self,
        wh: Warehouse,
        staging: Callable[[str], DataFrame],
        as_of: dt.date,
        internal_reviewer: str | None = None,
        temporary: bool = False,
    ):
        super().__init__(staging, as_of, internal_reviewer)
        self.wh = wh
        self.temporary = temporary
        self._claim, self._using = threading.Lock(), threading.Lock()
        self._stored: dict[str, Future[DataFrame]] = {}

    def ref(self, name: str) -> DataFrame:
        """A model's stored rows. The first caller stores them, any other waits for it; models do not read each other in circles."""
        with self._claim:
            stored = self._stored.get(name)
            mine = stored is None
            if mine:
                stored = self._stored[name] = Future()
        if mine:
            try:
                stored.set_result(keep(self.wh, name, MODELS[name](self)))
            except BaseException as error:
                del self._stored[name]  # the next caller tries again
                stored.set_exception(error)
        return stored.result()

    def build(self, names: Iterable[str] | None = None) -> None:
        """Store models (all of them); those they read come first."""
        self._at_once(self.ref, MODELS if names is None else names)

    def each(self, names: Iterable[str], use: Callable[[str, DataFrame], Found]) -> dict[str, Found]:
        """What ``use`` gives for each model's name and stored rows; one model is used at a time, as soon as it is stored."""
        names = list(dict.fromkeys(names))
        left = set(names)

        def one(name: str) -> Found:
            rows = self.ref(name)
            with self._using:
                found = use(name, rows)
            if self.temporary:
                self._finished(name, left)
            return found

        return self._at_once(one, names)

    def _finished(self, name: str, left: set[str]) -> None:
        """Take a model from those that are ``left``, and drop the tables that none of these is or reads."""
        with self._claim:
            left.discard(name)
            wanted = left.union(*map(all_read, left))
            gone = [n for n, stored in self._stored.items() if n not in wanted and stored.done()]
            for n in gone:
                del self._stored[n]
            for n in gone:
                if KINDS[n].kept != "view":
                    self.wh.drop(n)

    def _at_once(self, do: Callable[[str], Found], names: Iterable[str]) -> dict[str, Found]:
        spark = self.wh.spark
        with shuffles_removed(spark), ThreadPoolExecutor(AT_ONCE) as pool:
            started = {name: pool.submit(inheritable_thread_target(spark)(do), name) for name in names}
            try:
                return {name: one.result() for name, one in started.items()}
            finally:
                pool.shutdown(cancel_futures=True)
