"""Registry of warehouse models and the context they are built in."""

from __future__ import annotations

import datetime as dt
from collections import defaultdict
from collections.abc import Callable, Iterable
from dataclasses import dataclass
from typing import TypeVar

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.keys import surrogate_key
from ..functions.text import blank_to_null

MODELS: dict[str, Callable[[Models], DataFrame]] = {}
READS: dict[str, tuple[str, ...]] = {}  # models that a model asks for with ``ref``; a test holds them against its code
Found = TypeVar("Found")


@dataclass(frozen=True)
class Kind:
    """How a model's rows are kept: ``view``, ``table``, or ``incremental`` by key and date."""

    kept: str = "table"
    key: tuple[str, ...] = ()
    newer_by: str | None = None


KINDS: defaultdict[str, Kind] = defaultdict(Kind)

NUMBER = "decimal(38,6)"  # a number without stated precision
RATIO = "decimal(38,12)"  # a quotient
MONEY = "decimal(18,2)"
MOMENT = "timestamp_ntz"


class Models:
    """Builds models from staging tables.

    ``staging`` gives a staging table by name. ``as_of`` stands for today.
    ``internal_reviewer`` is the user whose rating is the internal score.
    """

    def __init__(self, staging: Callable[[str], DataFrame], as_of: dt.date, internal_reviewer: str | None = None):
        self.staging = staging
        self.as_of = as_of
        self.internal_reviewer = internal_reviewer
        self._built: dict[str, DataFrame] = {}

    def ref(self, name: str) -> DataFrame:
        if name not in self._built:
            self._built[name] = MODELS[name](self)
        return self._built[name]

    def build(self, names: Iterable[str] | None = None) -> None:
        """Build models (all of them)."""
        for name in MODELS if names is None else names:
            self.ref(name)

    def each(self, names: Iterable[str], use: Callable[[str, DataFrame], Found]) -> dict[str, Found]:
        """What ``use`` gives for each model's name and rows."""
        return {name: use(name, self.ref(name)) for name in names}

    @property
    def today(self) -> Column:
        return F.lit(self.as_of.isoformat()).cast("date")


def model(fn):
    """Register a model that is kept as a table."""
    MODELS[fn.__name__] = fn
    return fn


def incremental(key: str, newer_by: str):
    """Register a model that is kept incrementally: later loads add rows after the newest ``newer_by``."""

    def register(fn):
        KINDS[fn.__name__] = Kind("incremental", (key,), newer_by)
        return model(fn)

    return register


def reads(*names: str):
    """State the models that a model reads."""

    def register(fn):
        READS[fn.__name__] = names
        return fn

    return register


def all_read(name: str) -> set[str]:
    """The models that a model reads, itself or through others."""
    found, todo = set(), [name]
    while todo:
        new = set(READS.get(todo.pop(), ())) - found
        found |= new
        todo += new
    return found


def keyed(df: DataFrame, key_name: str, key, fields: dict) -> DataFrame:
    """Hashed key over ``key`` and one output column per field.

    A field is a source column name (made text, blanks to null) or any Column.
    """
    key = [key] if isinstance(key, (str, Column)) else key
    made = [c.alias(n) if isinstance(c, Column) else blank_to_null(c).alias(n) for n, c in fields.items()]
    return df.select(surrogate_key(*key).alias(key_name), *made)
