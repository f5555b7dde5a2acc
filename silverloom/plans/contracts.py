"""What must hold for built models: keys unique and filled, references known."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import blank_to_null
from ..quality import checks
from .base import Models

# Models whose ``<name>_sk`` must be unique and filled.
KEYED = [
    "dim_ar", "dim_artist", "dim_channel", "dim_company", "dim_company_stock", "dim_department",
    "dim_distributed_employee", "dim_isrc", "dim_khsx", "dim_net", "dim_order_employee", "dim_po", "dim_project",
    "dim_project_stock", "dim_repository", "dim_resource", "dim_so", "dim_stock", "dim_sub_project",
    "dim_subproject_stock", "fact_artist_assignment", "fact_distribution", "fact_editing", "fact_khsx_detail",
    "fact_label_operation", "fact_po_detail", "fact_so_detail", "fact_youtube_operation",
]

# Model, column, model it points to, column there.
REFERENCES = [
    ("dim_sub_project", "project_id", "dim_project", "project_id"),
    ("dim_repository", "sub_project_id", "dim_sub_project", "sub_project_id"),
    ("dim_resource", "repository_id", "dim_repository", "repository_id"),
    ("dim_order_employee", "department_id", "dim_department", "department_id"),
    ("dim_department", "company_id", "dim_company", "company_id"),
    ("dim_channel", "network_id", "dim_net", "net_id"),
    ("dim_channel", "company_id", "dim_company_stock", "company_id"),
    ("fact_po_detail", "po_id", "dim_po", "po_id"),
    ("fact_khsx_detail", "production_plan_id", "dim_khsx", "production_plan_id"),
    ("fact_artist_assignment", "artist_id", "dim_artist", "platform_id"),
    ("fact_artist_assignment", "production_plan_detail_id", "fact_khsx_detail", "production_plan_detail_id"),
    ("fact_editing", "hg_stock_id", "dim_stock", "hg_stock_id"),
    ("bridge_bt_vid", "video_id", "dim_video", "video_id"),
]

# Staging table, text column, type that a model gives it. Text of another form becomes null.
TYPED = [
    ("resource_before_odoo", "Điểm trung bình", "decimal(18,2)"),
    ("resource_before_odoo", "Chi phí đv: $", "decimal(18,2)"),
    ("x_music_song", "review_score", "decimal(18,2)"),
    ("sale_order_line", "x_expected_score", "decimal(18,2)"),
    ("stream_distro", "reportingDate", "date"),
]


def lost_value_report(m: Models, typed=tuple(TYPED)) -> DataFrame:
    """Filled cells that a model's cast loses, per column; a table is scanned once for all its columns."""
    parts = []
    for table in dict.fromkeys(t for t, _, _ in typed):
        columns = [(c, kind) for t, c, kind in typed if t == table]
        texts = [blank_to_null(F.col(f"`{c}`")) for c, _ in columns]
        lost = [F.count_if(x.isNotNull() & x.try_cast(kind).isNull()) for x, (_, kind) in zip(texts, columns)]
        counts = m.staging(table).agg(*[n.alias(f"_{i}") for i, n in enumerate(lost)])
        cells = [
            F.struct(F.lit(table).alias("staging"), F.lit(c).alias("column_name"), F.col(f"_{i}").alias("failures")) for i, (c, _) in enumerate(columns)
        ]
        parts.append(counts.select(F.inline(F.array(*cells))))
    return reduce(DataFrame.unionAll, parts)


def key_counts(rows: DataFrame, column: str) -> tuple[int, int]:
    """Keys that repeat, and rows without one, both from one grouping of the keys.

    A hashed key is shuffled as the 16 bytes its 32 hex digits stand for, any other as it is.
    """
    key = F.col(column).cast("string")
    packed = F.when((F.length(key) == 32) & (F.lower(key) == key), F.unhex(key))  # null if a sign is no hex digit
    slim = rows.select(packed.alias("_packed"), key.alias("_key"))
    slim = slim.select("_packed", F.when(F.col("_packed").isNull(), F.col("_key")).alias("_other"))
    counts = slim.groupBy("_packed", "_other").agg(F.count(F.lit(1)).alias("n"))
    filled = F.col("_packed").isNotNull() | F.col("_other").isNotNull()
    repeated, missing = F.count_if(filled & (F.col("n") > 1)), F.coalesce(F.sum(F.when(~filled, F.col("n"))), F.lit(0))
    return tuple(counts.agg(repeated, missing.cast("bigint")).first())


def key_report(m: Models, names=tuple(KEYED)) -> DataFrame:
    """Repeated and missing keys per model; two numbers of each reach the driver."""
    found = m.each(names, lambda name, rows: key_counts(rows, f"{name}_sk"))
    cells = [(name, check, n) for name in names for check, n in zip(("unique", "not_null"), found[name])]
    return SparkSession.active().createDataFrame(cells, "model string, check_name string, failures bigint")


def reference_report(m: Models, references=tuple(REFERENCES)) -> DataFrame:
    """Rows whose reference is unknown, per reference."""
    m.build(dict.fromkeys(name for model, _, to, _ in references for name in (model, to)))
    parts = []
    for model, column, to, field in references:
        orphans = checks.orphan_counts(m.ref(model), column, m.ref(to), field)
        n = orphans.agg(F.coalesce(F.sum("n_records"), F.lit(0)).cast("bigint").alias("failures"))
        parts.append(n.select(F.lit(model).alias("model"), F.lit(f"{column}_in_{to}").alias("check_name"), "failures"))
    return reduce(DataFrame.unionAll, parts)
