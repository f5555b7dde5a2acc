"""Extract, land, register, load, mark: the life of a batch, and going back to one."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from ..sinks.warehouse import Batch, Warehouse, new_batch_id
from ..sources.spec import SourceSpec
from ..sources.staging import map_fields, mark_source, stage
from ..sources.tables import narrow, newer_than


def _now() -> dt.datetime:
    return dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)


def _finish(wh: Warehouse, spec: SourceSpec) -> None:
    """A load that committed its table but died before its mark is marked now."""
    newest = wh.ledger.batches(spec.source_id).orderBy(F.desc("extracted_no")).first()
    if newest is not None and newest["status"] == "extracted":
        version = wh.log.version_of(spec.table, newest["batch_id"])
        if version is not None:
            wh.ledger.mark_loaded(newest["batch_id"], spec.table, version, source_id=spec.source_id)


def extract(wh: Warehouse, spec: SourceSpec, force: bool = False, at: dt.datetime | None = None) -> Batch | None:
    """Land a batch when the source changed; None when it did not or had no rows.

    The source is read once: rows, checksum and mark are measured while they are landed,
    before columns are chosen, and an unchanged batch is removed again. A source with a
    watermark is read from the last mark on, unless its loads replace the table: then all of
    it is read, when its mark has moved.
    """
    at = at or _now()
    _finish(wh, spec)
    last = wh.ledger.last_success(spec.source_id)
    mark = last["watermark_value"] if last is not None and spec.watermark_column else None
    rows = narrow(spec.read(wh.spark), spec)
    whole = spec.load_mode == "truncate"
    if mark is not None and not whole:
        rows = newer_than(rows, spec.watermark_column, mark)
    batch = wh.land(
        rows,
        spec.kind,
        spec.connection or spec.source_id,
        new_batch_id(spec.source_id, at),
        spec.watermark_column,
        shape=lambda df: mark_source(map_fields(df, spec.field_mapping), spec.source_id, spec.connection, spec.sheet),
        checksum=spec.checksum,
        after=mark,
    )
    same = spec.checksum and last is not None and last["checksum"] == batch.checksum
    if batch.rows == 0 or (not force and (same or not batch.newer)):
        wh.forget(batch)
        return None
    wh.ledger.register(
        spec.source_id,
        batch.batch_id,
        batch.path,
        batch.rows,
        at=at,
        source_type=spec.kind,
        connection_name=spec.connection,
        checksum=batch.checksum,
        watermark_value=batch.watermark,
    )
    return batch


def load(wh: Warehouse, spec: SourceSpec, batch: Batch, at: dt.datetime | None = None) -> None:
    """Load a landed batch; the source itself is not needed any more."""
    at = at or _now()
    try:
        rows = stage(wh.read_batch(batch.path), batch.batch_id, at)
        mode = spec.load_mode
        if mode == "append" and spec.upsert_key and spec.watermark_column:
            mode = "delete_insert"  # rows of the delta's keys go first: a delta that comes twice adds nothing
        newest = [F.col(spec.watermark_column).desc_nulls_last()] if spec.watermark_column in rows.columns else None
        change = wh.load(spec.table, rows, mode, spec.upsert_key, newest)
        wh.commit(batch.batch_id, spec.table, change, at, spec.source_id)
    except Exception as error:
        wh.ledger.mark_failed(batch.batch_id, str(error), at, spec.source_id)
        raise


def run_source(wh: Warehouse, spec: SourceSpec, force: bool = False, at: dt.datetime | None = None) -> Batch | None:
    batch = extract(wh, spec, force, at)
    if batch is not None:
        load(wh, spec, batch, at)
    return batch


def rollback(wh: Warehouse, spec: SourceSpec, date) -> str | None:
    """Put the table back to what it was after the newest batch loaded on or before a date.

    Returns that batch's id, or None if there is none. Only a commit is written; the batch
    becomes the source's last success, so the next run reads on from its mark.
    """
    found = wh.ledger.as_of(date, spec.source_id).first()
    if found is None:
        return None
    version = wh.log.commit(wh.restore(spec.table, found["table_version"]))
    wh.ledger.mark_restored(found["batch_id"], spec.table, version, source_id=spec.source_id)
    return found["batch_id"]
