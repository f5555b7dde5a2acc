"""Append-only record of batches; the current state is an aggregate over its events.

Events are kept apart by source, so that a question about one source reads its own.
"""

from __future__ import annotations

import datetime as dt
import threading
import time

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import files

ERROR_CHARS = 2000  # fixed value: stored length of an error text
HISTORY_ROWS = 20  # fixed value: default length of a history

_LOG = "log"
_NO_SOURCE = "-"  # log of events that name no source
_TEXT, _COUNT = T.StringType(), T.LongType()
EVENTS = T.StructType(
    [
        T.StructField("event_no", _COUNT),
        T.StructField("event_at", T.TimestampNTZType()),
        *[T.StructField(n, _TEXT) for n in ("source_id", "source_type", "connection_name", "batch_id", "path")],
        *[T.StructField(n, _TEXT) for n in ("checksum", "watermark_value")],
        T.StructField("row_count", _COUNT),
        *[T.StructField(n, _TEXT) for n in ("status", "error_message", "table_name")],
        T.StructField("table_version", _COUNT),
    ]
)


class Ledger:
    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path
        self._last = 0
        self._writing = threading.Lock()  # writers of one folder at the same time would clear each other's drafts

    # -- writing

    def append(self, events: DataFrame) -> None:
        """Add events; columns they lack are null."""
        self._logged(events).write.mode("append").partitionBy(_LOG).parquet(self.path)

    @staticmethod
    def _logged(events: DataFrame) -> DataFrame:
        filled = events.select(
            *[
                (F.col(f.name) if f.name in events.columns else F.lit(None)).cast(f.dataType).alias(f.name)
                for f in EVENTS.fields
            ]
        )
        return filled.withColumn(_LOG, F.coalesce("source_id", F.lit(_NO_SOURCE)))

    def _event(self, at: dt.datetime | None, **values) -> None:
        at = at or dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
        with self._writing:
            self._last = max(time.time_ns(), self._last + 1)
            cells = values | {"event_no": self._last, "event_at": at.isoformat(sep=" ")}
            self.append(self.spark.range(0, 1, 1, 1).select(*[F.lit(value).alias(name) for name, value in cells.items()]))

    def register(self, source_id: str, batch_id: str, path: str, row_count: int, at=None, **details) -> None:
        """A landed batch: path, rows, and its checksum or watermark."""
        self._event(at, source_id=source_id, batch_id=batch_id, path=path, row_count=row_count, status="extracted", **details)

    def mark_loaded(self, batch_id: str, table_name=None, table_version=None, at=None, source_id=None) -> None:
        self._event(at, source_id=source_id, batch_id=batch_id, status="loaded", table_name=table_name, table_version=table_version)

    def mark_failed(self, batch_id: str, error: str, at=None, source_id=None) -> None:
        self._event(at, source_id=source_id, batch_id=batch_id, status="failed", error_message=error[:ERROR_CHARS])

    def mark_restored(self, batch_id: str, table_name: str, table_version: int, at=None, source_id=None) -> None:
        """A table was put back to this batch, which is the source's last success again."""
        self._event(at, source_id=source_id, batch_id=batch_id, status="restored", table_name=table_name, table_version=table_version)

    # -- reading

    def events(self, source_id: str | None = None) -> DataFrame:
        """All events, or those that may belong to a source; none before the first is written."""
        if not files.exists(self.spark, self.path):
            return self.spark.createDataFrame([], EVENTS)
        found = self.spark.read.schema(T.StructType([*EVENTS.fields, T.StructField(_LOG, _TEXT)])).parquet(self.path)
        return (found if source_id is None else found.where(F.col(_LOG).isin(source_id, _NO_SOURCE))).drop(_LOG)

    def batches(self, source_id: str | None = None) -> DataFrame:
        """One row per batch with its current status."""
        status, number = F.col("status"), F.col("event_no")
        landed, loaded, restored = (status == s for s in ("extracted", "loaded", "restored"))
        details = ["source_type", "connection_name", "path", "checksum", "watermark_value", "row_count"]
        grouped = self.events(source_id).groupBy("batch_id").agg(
            F.max("source_id").alias("source_id"),
            F.max_by(F.struct(*details, F.col("event_at").alias("extracted_at"), F.col("event_no").alias("extracted_no")), F.when(landed, number)).alias("d"),
            F.max_by("status", F.when(~restored, number)).alias("status"),
            F.max(F.when(loaded, F.col("event_at"))).alias("loaded_at"),
            F.max_by(F.substring("error_message", 1, ERROR_CHARS), F.when(status == "failed", number)).alias("error_message"),
            F.max_by("table_version", F.when(loaded, number)).alias("table_version"),
            F.max(F.when(loaded | restored, number)).alias("active_no"),
        )
        found = grouped.select("batch_id", "source_id", "d.*", "status", "loaded_at", "error_message", "table_version", "active_no")
        return found if source_id is None else found.where(F.col("source_id") == source_id)

    def last_successes(self, source_id: str | None = None) -> DataFrame:
        """Newest loaded (or restored) batch per source."""
        return self._newest(self._loaded(source_id), "active_no", "extracted_at", "extracted_no", "batch_id")

    def last_success(self, source_id: str) -> Row | None:
        return self.last_successes(source_id).first()

    def as_of(self, date, source_id: str | None = None) -> DataFrame:
        """Newest loaded batch per source extracted on or before a date."""
        until = self._loaded(source_id).where(F.col("extracted_at").cast("date") <= F.lit(date).cast("date"))
        return self._newest(until, "extracted_at", "extracted_no", "batch_id")

    def _loaded(self, source_id: str | None) -> DataFrame:
        return self.batches(source_id).where((F.col("status") == "loaded") & F.col("source_id").isNotNull())

    @staticmethod
    def _newest(batches: DataFrame, *order: str) -> DataFrame:
        newest = F.max_by(F.struct(*batches.columns), F.struct(*order))
        return batches.groupBy("source_id").agg(newest.alias("r")).select("r.*")

    def history(self, source_id: str, limit: int = HISTORY_ROWS) -> DataFrame:
        columns = ["batch_id", "source_type", "connection_name", "row_count", "status", "extracted_at", "loaded_at"]
        rows = self.batches(source_id)
        return rows.orderBy(F.desc("extracted_at"), F.desc("extracted_no"), F.desc("batch_id")).limit(limit).select(*columns)

    def status(self, batch_id: str, source_id: str | None = None) -> str | None:
        row = self.batches(source_id).where(F.col("batch_id") == batch_id).first()
        return row["status"] if row else None
