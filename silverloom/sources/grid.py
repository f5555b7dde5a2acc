"""Spreadsheet cells as a table: ``file, sheet, row_no, cells array<string>`` to typed columns.

Rows of all sheets are handled at once; a sheet's header row is joined back to its rows.
"""

from __future__ import annotations

import itertools
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def select_tabs(grid: DataFrame, name: str | None = None, pattern: str | None = None) -> DataFrame:
    """Tabs by exact name or by a piece of the title, with the year of the title in ``_year``."""
    if (name is None) == (pattern is None):
        raise ValueError("give a name or a pattern")
    chosen = F.col("sheet") == name if pattern is None else F.contains("sheet", F.lit(pattern))
    return grid.where(chosen).withColumn("_year", F.regexp_extract("sheet", r"(20\d{2})", 1))


def _clean(cell: Column) -> Column:
    return F.trim(F.regexp_replace(cell, "\n", " "))


def _cell(cells: Column, position: Column) -> Column:
    """Cell at a 1-based position; '' where there is none."""
    return F.coalesce(F.when(position > 0, F.get(cells, position - 1)), F.lit(""))


def _any_filled(cells: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, [F.trim(c) != "" for c in cells])


def promote_columns(
    grid: DataFrame, columns: list[str], header_row: int, data_start_row: int | None = None, blank_check: int = 5
) -> DataFrame:
    """Fixed columns by header name, '' where a sheet lacks one; rows blank in the first few drop."""
    headers = grid.where(F.col("row_no") == header_row).select(
        F.col("file").alias("_file"), F.col("sheet").alias("_sheet"), F.transform("cells", _clean).alias("_header")
    )
    positions = [F.array_position("_header", c).cast("int").alias(f"_p{i}") for i, c in enumerate(columns)]
    headers = headers.select("_file", "_sheet", *positions)
    start = (data_start_row or header_row + 1)
    rows = grid.where(F.col("row_no") >= start).join(
        headers, F.col("file").eqNullSafe(F.col("_file")) & (F.col("sheet") == F.col("_sheet"))
    )
    extra = [c for c in ("_year",) if c in grid.columns]
    cells = [_cell(F.col("cells"), F.col(f"_p{i}")) for i in range(len(columns))]
    picked = rows.select(*[c.alias(n) for c, n in zip(cells, columns)], *extra)
    return picked.where(_any_filled([F.col(f"`{c}`") for c in columns[:blank_check]]))


def unique_names(names: list[str]) -> list[str]:
    """Blank names become ``col_<i>``, line breaks blanks; a name that is taken gets the first free ``_<k>``."""
    taken: dict[str, None] = {}  # in order
    for i, name in enumerate(names):
        wanted = str(name).replace("\n", " ").strip() or f"col_{i}"
        options = itertools.chain([wanted], (f"{wanted}_{k}" for k in itertools.count(1)))
        taken[next(o for o in options if o not in taken)] = None
    return list(taken)


def promote_header(grid: DataFrame, header_row: int, data_start_row: int | None = None) -> DataFrame:
    """All columns of a sheet, named by its header row; rows are cut or filled to its width."""
    first = grid.where(F.col("row_no") == header_row).orderBy("sheet").select("cells").first()
    if first is None:
        raise ValueError(f"no row {header_row} to take the header from")
    names = unique_names(first["cells"])
    rows = grid.where(F.col("row_no") >= (data_start_row or header_row + 1))
    extra = [c for c in ("_year",) if c in grid.columns]
    return rows.select(
        *[_cell(F.col("cells"), F.lit(i + 1)).alias(name) for i, name in enumerate(names)], *extra
    )


def promote_by_marker(grid: DataFrame, marker: str, columns: list[str], stem: str = "Repository") -> DataFrame:
    """Per sheet of a file: the first row holding the marker is the header; the file name is kept without its ending.

    Cells are trimmed, names compared in lower case; sheets without a marker and rows blank
    in all wanted columns drop. A grid without sheet names has one sheet per file.
    """
    where = [c for c in ("file", "sheet") if c in grid.columns]
    trimmed = grid.select(*where, "row_no", F.transform("cells", lambda c: F.coalesce(F.trim(c), F.lit(""))).alias("cells"))
    lowered = trimmed.withColumn("_lower", F.transform("cells", F.lower))
    marked = lowered.where(F.array_contains("_lower", marker.lower()))
    header = marked.groupBy(*[F.col(c).alias(f"_{c}") for c in where]).agg(
        F.min("row_no").alias("_at"), F.min_by("_lower", "row_no").alias("_header")
    )
    positions = [F.array_position("_header", c.lower()).cast("int").alias(f"_p{i}") for i, c in enumerate(columns)]
    header = header.select(*[f"_{c}" for c in where], "_at", *positions)
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in where])
    rows = trimmed.join(header, same & (F.col("row_no") > F.col("_at")))
    cells = [_cell(F.col("cells"), F.col(f"_p{i}")) for i in range(len(columns))]
    picked = rows.select(
        *[c.alias(n) for c, n in zip(cells, columns)], F.regexp_replace("file", r"\.[^.]*$", "").alias(stem)
    )
    return picked.where(_any_filled([F.col(f"`{c}`") for c in columns]))
