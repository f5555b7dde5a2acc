"""Queries over the driver tables, each with its SQL counterpart where one exists."""

import importlib

MODULES = ("tables", "scalars", "relational", "patterns", "quality", "ingest", "models")


def load():
    """Import every module of queries; return the queries and their SQL."""
    from .base import ORACLES, QUERIES

    for name in MODULES:
        importlib.import_module(f"{__name__}.{name}")
    return QUERIES, ORACLES
