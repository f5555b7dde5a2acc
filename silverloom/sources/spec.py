"""What to read and how to load it."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class SourceSpec:
    """One source.

    ``read`` gives the source as a DataFrame; the other fields narrow and load it. A
    source with a watermark column is read as a delta from its second load on; one with
    ``checksum`` set is skipped while its fingerprint stays the same.
    """

    source_id: str
    read: Callable[[SparkSession], DataFrame]
    kind: str = "table"
    connection: str | None = None
    sheet: str | None = None
    columns: tuple[str, ...] = ()
    computed: Mapping[str, object] = field(default_factory=dict)
    where: str | None = None
    month: str | None = None
    watermark_column: str | None = None
    checksum: bool = False
    field_mapping: Mapping[str, str] = field(default_factory=dict)
    load_mode: str = "append"
    upsert_key: tuple[str, ...] = ()
    target: str | None = None

    @property
    def table(self) -> str:
        return self.target or self.source_id
