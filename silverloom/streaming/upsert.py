"""Continuous landing and keyed upsert."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..sinks.warehouse import Warehouse


def drop_redelivered(stream: DataFrame, key: list[str], event_time: str, delay: str) -> DataFrame:
    """Rows delivered again within ``delay`` drop; state older than that is released."""
    return stream.withWatermark(event_time, delay).dropDuplicatesWithinWatermark(key)


def stream_upsert(
    wh: Warehouse,
    stream: DataFrame,
    table: str,
    key: list[str],
    stream_id: str,
    checkpoint: str,
    watermark: str | None = None,
    newest_first: list[Column] | None = None,
) -> StreamingQuery:
    """Each micro-batch lands, is registered and upserted under the id ``<stream>-<epoch>-<checksum>``.

    The checksum of its rows is taken while it lands. A micro-batch that Spark repeats after a
    failure has the same id and is dropped when that is already loaded; one with other rows
    (a stream started over) has another id and is upserted, whatever its epoch.
    """

    def apply(rows: DataFrame, epoch: int) -> None:
        batch = wh.land(rows, "stream", stream_id, f"{stream_id}-{epoch}-{uuid.uuid4().hex[:8]}", watermark, checksum=True)
        batch_id = f"{stream_id}-{epoch}-{batch.checksum[:16]}"
        if wh.ledger.status(batch_id, stream_id) == "loaded":
            wh.forget(batch)
            return
        wh.ledger.register(
            stream_id, batch_id, batch.path, batch.rows, source_type="stream", watermark_value=batch.watermark, checksum=batch.checksum
        )
        if batch.rows:
            order = newest_first or ([F.col(watermark).desc_nulls_last()] if watermark else None)
            wh.commit(batch_id, table, wh.upsert(table, wh.read_batch(batch.path), key, order), source_id=stream_id)
        else:
            wh.ledger.mark_loaded(batch_id, source_id=stream_id)

    writer = stream.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True).start()
