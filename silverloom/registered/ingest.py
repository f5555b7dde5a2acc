"""Sources, change tests, staging, sinks, ledger and streams on the driver tables.

Queries that write use a fresh folder under the shared scratch folder and return what
they read back.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from ..functions.dates import effective_timestamp, in_month
from ..plans import materialise
from ..plans.workflow import load as load_batch
from ..plans.workflow import rollback, run_source
from ..session import cut_lineage, scratch_dir
from ..sinks.ledger import Ledger
from ..sinks.warehouse import Batch, Warehouse
from ..sources import change, csv, documents, grid, staging
from ..sources.spec import SourceSpec
from ..sources.tables import narrow, newer_than
from ..streaming.upsert import drop_redelivered, stream_upsert
from .base import query

_DAY = dt.datetime(2024, 2, 1, 6)


def _at(text: str):
    return F.lit(text).cast("timestamp_ntz")


# -- sources


@query("src_01_table_scan", "select n_nationkey, n_name from nation where n_regionkey = 1")
def src_01(t):
    spec = SourceSpec("nation", lambda spark: t.nation, where="n_regionkey = 1", columns=("n_nationkey", "n_name"))
    return narrow(spec.read(t.spark), spec)


_WM_SQL = """
    select o_orderkey, case when updated is null or created > updated then created else updated end as _wm from (
        select *, o_orderdate as created, case when o_orderstatus = 'F' then o_orderdate + interval 3 day
                  when o_orderstatus = 'P' then o_orderdate - interval 2 day end as updated from orders)
"""


@query("src_02_custom_projection", _WM_SQL + " where o_totalprice > 100000 and _wm >= timestamp '1997-01-01'")
def src_02(t):
    shifted = {
        "updated": "case o_orderstatus when 'F' then o_orderdate + interval 3 day when 'P' then o_orderdate - interval 2 day end",
    }
    spec = SourceSpec("orders", lambda spark: t.orders, where="o_totalprice > 100000", computed=shifted)
    rows = narrow(spec.read(t.spark), spec).withColumn("_wm", effective_timestamp("o_orderdate", "updated"))
    return rows.where(F.col("_wm") >= _at("1997-01-01")).select("o_orderkey", "_wm")


@query("src_03_effective_watermark", _WM_SQL)
def src_03(t):
    updated = F.expr("case o_orderstatus when 'F' then o_orderdate + interval 3 day when 'P' then o_orderdate - interval 2 day end")
    return t.orders.select("o_orderkey", effective_timestamp("o_orderdate", updated).alias("_wm"))


@query("src_04_month_filter", "select o_orderkey, o_orderdate from orders where strftime(o_orderdate, '%Y-%m') = '1997-12'")
def src_04(t):
    return t.orders.where(in_month("o_orderdate", "1997-12")).select("o_orderkey", "o_orderdate")


@query("src_04_clustered_month", "select o_orderkey, o_orderdate from orders where strftime(o_orderdate, '%Y-%m') = '1997-12'")
def src_04_clustered(t):
    """The month of a table whose files have ranges of the date: the others are not read."""
    wh = _warehouse(t, "clustered")
    wh.log.commit(wh.append("orders", t.orders, cluster_by="o_orderdate"))
    return wh.table("orders").where(in_month("o_orderdate", "1997-12")).select("o_orderkey", "o_orderdate")


@query("snk_04_key_lookup", "select * from customer where c_custkey in (1, 7, 30, 77, 150, 99999999)")
def snk_04_lookup(t):
    """Rows by key, from the keys' buckets and from row groups whose filters may hold them."""
    wh = _warehouse(t, "lookup")
    wh.log.commit(wh.upsert("customer", t.customer, ["c_custkey"]))
    return wh.lookup("customer", [(k,) for k in (1, 7, 30, 77, 150, 99999999)])


@query("src_05_delta_filter", "select event_id, ts from events where ts > timestamp '2024-01-20 12:00:00'")
def src_05(t):
    return newer_than(t.events, "ts", "2024-01-20 12:00:00").select("event_id", "ts")


@query(
    "src_06_csv_read",
    """
    select l_orderkey::varchar as l_orderkey, l_linenumber::varchar as l_linenumber, l_partkey::varchar as l_partkey,
           case when l_returnflag = 'A' then null else '"' || l_linestatus || '", quoted' end as note
    from lineitem where not (l_returnflag = 'R' and l_linestatus = 'F')
    """,
)
def src_06(t):
    """Returned lines get one field too many (an empty one for half of them), 'A' lines one too few."""
    path = scratch_dir(t.spark, "csv")
    keys = [F.col(c).cast("string") for c in ("l_orderkey", "l_linenumber", "l_partkey")]
    note = F.concat(F.lit('"""'), "l_linestatus", F.lit('"", quoted"'))
    line = F.concat_ws(",", *keys, F.when(F.col("l_returnflag") != "A", note))
    too_long = (F.col("l_returnflag") == "R") & (F.col("l_linestatus") == "F")
    line = F.when(too_long, F.concat(line, F.when(F.col("l_linenumber") > 3, ",").otherwise(",extra"))).otherwise(line)
    header = " l_orderkey,l_linenumber , l_partkey,note"
    # A header line per file, as exports have.
    t.lineitem.select(
        F.lit("x").alias(header), line.alias("line")
    ).select(F.col("line").alias(header)).write.option("header", "true").option("quote", "\u0000").option(
        "escapeQuotes", "false"
    ).option("ignoreLeadingWhiteSpace", "false").option("sep", "\u0001").csv(path)
    return csv.read_csv(t.spark, path)


@query("src_06_csv_headers", "select n_nationkey::varchar as n_nationkey, n_name || chr(10) || 'next line' as n_name from nation")
def src_06_headers(t):
    """Files of one folder with their columns in two orders, and line breaks inside quotes."""
    path = scratch_dir(t.spark, "csv")
    rows = t.nation.select(F.col("n_nationkey").cast("string"), F.concat("n_name", F.lit("\nnext line")).alias("n_name"))
    for columns, part in ((["n_nationkey", "n_name"], "n_nationkey < 10"), (["n_name", "n_nationkey"], "n_nationkey >= 10")):
        rows.where(part).select(*columns).coalesce(1).write.mode("append").option("header", "true").option("quoteAll", "true").csv(path)
    return csv.read_csv(t.spark, path)


@query(
    "src_06_csv_split",
    """
    select o_orderkey::varchar as o_orderkey, 'from ' || o_orderstatus || case when o_orderkey % 5 = 0 then chr(10) || '"next", line' || chr(10) else '' end as note,
           nullif(o_orderpriority, '5-LOW') as o_orderpriority
    from orders
    """,
)
def src_06_split(t):
    """One large file with line breaks and quotes inside quotes, read by as many tasks as it has splits."""
    path = scratch_dir(t.spark, "csv")
    broken = F.when(F.col("o_orderkey") % 5 == 0, '\n"next", line\n').otherwise("")
    note = F.concat(F.lit("from "), "o_orderstatus", broken)
    rows = t.orders.select("o_orderkey", note.alias("note"), F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_orderpriority")).otherwise("n/a").alias("o_orderpriority"))
    kept = {"ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
    rows.coalesce(1).write.options(header="true", quoteAll="true", escape='"', **kept).csv(path)
    return csv.read_csv(t.spark, path, split_bytes=1 << 16)


@query(
    "snk_06_csv_stream",
    """
    select o_orderkey::varchar as o_orderkey, o_orderstatus || chr(10) || 'second line' as note from orders where o_orderkey % 7 <> 0
    """,
)
def snk_06_csv(t):
    """A folder of CSV files as a stream: lines with a field too many are left out in the stream, the rest is upserted."""
    path = scratch_dir(t.spark, "csv")
    note = F.concat(F.lit('"'), "o_orderstatus", F.lit('\nsecond line"'))
    line = F.concat_ws(",", F.col("o_orderkey").cast("string"), note, F.when(F.col("o_orderkey") % 7 == 0, "one too many"))
    head = t.spark.range(1).select(F.lit("o_orderkey,note").alias("value"))
    for part in range(3):
        lines = t.orders.where(F.col("o_orderkey") % 3 == part).select(line.alias("value"))
        head.unionAll(lines).coalesce(1).write.mode("append").text(path)
    wh = _warehouse(t, "stream")
    rows = csv.stream_csv(t.spark, path, files_per_trigger=2)
    stream_upsert(wh, rows, "orders", ["o_orderkey"], "orders", scratch_dir(t.spark, "progress")).awaitTermination()
    return wh.table("orders")


@query(
    "snk_06_document_stream",
    """
    select event_id::varchar as "_es_id", ts as "Date", event_type as "action.kind" from events where ts >= timestamp '2024-01-15'
    """,
)
def snk_06_documents(t):
    """Document dumps as a stream, from a day on."""
    path = scratch_dir(t.spark, "documents")
    source = F.struct(F.col("ts").alias("Date"), F.struct(F.col("event_type").alias("kind")).alias("action"))
    t.events.select(F.col("event_id").cast("string").alias("_id"), source.alias("_source")).repartition(3).write.option("timestampNTZFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").json(path)
    shape = "Date timestamp_ntz, action struct<kind: string>"
    rows = documents.stream_documents(t.spark, path, shape, "Date", "2024-01-15", files_per_trigger=2)
    wh = _warehouse(t, "stream")
    stream_upsert(wh, rows, "documents", ["_es_id"], "documents", scratch_dir(t.spark, "progress")).awaitTermination()
    return wh.table("documents")


@query(
    "src_07_document_scan",
    """
    select event_id::varchar as "_es_id", ts as "Date", user_id as "who.user_id", event_type as "who.action.kind",
           '["' || event_type || '",' || (case when value > 10 then '"high"' else '"low"' end) || ']' as tags
    from events where ts >= timestamp '2024-01-15'
    """,
)
def src_07(t):
    path = scratch_dir(t.spark, "documents")
    level = F.when(F.col("value") > 10, "high").otherwise("low")
    who = F.struct("user_id", F.struct(F.col("event_type").alias("kind")).alias("action"))
    source = F.struct(F.col("ts").alias("Date"), who.alias("who"), F.array("event_type", level).alias("tags"))
    t.events.select(F.col("event_id").cast("string").alias("_id"), source.alias("_source")).write.option(
        "timestampNTZFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
    ).json(path)
    shape = "Date timestamp_ntz, who struct<user_id: bigint, action: struct<kind: string>>, tags array<string>"
    return documents.read_documents(t.spark, path, shape, "Date", "2024-01-15")


@query(
    "src_08_daily_rates",
    """
    select strftime(o_orderdate, '%Y-%m-%d') as record_date, min(o_totalprice) as exchange_rate from orders
    where o_orderpriority = '1-URGENT' and o_totalprice > 250000
      and o_orderdate between timestamp '1996-01-01' and timestamp '1999-06-30' group by 1
    """,
)
def src_08(t):
    """One rate document per order day; days without a large urgent order quote no rate."""
    large = (F.col("o_orderpriority") == "1-URGENT") & (F.col("o_totalprice") > 250000)
    rate = F.min(F.when(large, F.col("o_totalprice")))
    days = t.orders.groupBy(F.col("o_orderdate").cast("date").alias("day")).agg(rate.alias("vnd"))
    docs = days.select("day", F.to_json(F.struct(F.struct("vnd").alias("usd"))).alias("doc"))
    return documents.read_rates(docs, "1996-01-01", "1999-06-30", "vnd")


def _nation_grid(t):
    """Nations as sheets per region, titled by year, with two title rows, a header and blank rows."""
    sheet = F.concat(F.lit("Costs "), (F.col("n_regionkey") + 2020).cast("string"))
    rows = t.nation.select(F.lit("book.xlsx").alias("file"), sheet.alias("sheet"), "*")
    body = rows.select(
        "file",
        "sheet",
        (F.col("n_nationkey") * 2 + 10).alias("row_no"),
        F.array(F.col("n_name"), F.lit("junk"), F.col("n_nationkey").cast("string"), F.lit("cut")).alias("cells"),
    )
    blank = body.select("file", "sheet", (F.col("row_no") + 1).alias("row_no"), F.array(F.lit(" "), F.lit("junk")).alias("cells"))
    heads = rows.select("file", "sheet").distinct()
    title = heads.select("file", "sheet", F.lit(1).alias("row_no"), F.array("sheet").alias("cells"))
    header = heads.select(
        "file", "sheet", F.lit(3).alias("row_no"), F.array(F.lit(" nation\nname "), F.lit(""), F.lit("key")).alias("cells")
    )
    return title.unionAll(header).unionAll(body).unionAll(blank)


@query(
    "src_09_tabs_by_title",
    "select 'Costs ' || (n_regionkey + 2020)::varchar as sheet, (n_regionkey + 2020)::varchar as year_text, 2 * count(*) + 2 as n_rows from nation group by n_regionkey",
)
def src_09(t):
    tabs = grid.select_tabs(_nation_grid(t), pattern="Costs")
    return tabs.groupBy("sheet", F.col("_year").alias("year_text")).agg(F.count(F.lit(1)).alias("n_rows"))


@query(
    "src_10_header_promotion",
    "select n_name as \"nation name\", n_nationkey::varchar as key, '' as missing, (n_regionkey + 2020)::varchar as _year from nation",
)
def src_10(t):
    tabs = grid.select_tabs(_nation_grid(t), pattern="Costs")
    return grid.promote_columns(tabs, ["nation name", "key", "missing"], header_row=3)


@query(
    "src_10_full_header",
    """
    select n_name as "nation name", 'junk' as col_1, n_nationkey::varchar as key, (n_regionkey + 2020)::varchar as _year from nation
    union all select ' ', 'junk', '', (n_regionkey + 2020)::varchar from nation
    """,
)
def src_10_full(t):
    return grid.promote_header(grid.select_tabs(_nation_grid(t), pattern="Costs"), header_row=3)


@query(
    "src_11_folder_of_grids",
    """
    select c_custkey::varchar as "Code", c_name as "Title", '' as "Artist", lower(c_mktsegment) as "Repository"
    from customer where c_mktsegment <> 'FURNITURE'
    """,
)
def src_11(t):
    """A workbook per segment: junk above the header, blank rows, one workbook without header."""
    file = F.concat(F.lower("c_mktsegment"), F.lit(".xlsm"))
    rows = t.customer.select(file.alias("file"), "*")
    body = rows.select(
        "file",
        (F.col("c_custkey") * 2 + 10).alias("row_no"),
        F.array(F.lit("x"), F.concat(F.lit(" "), "c_name"), F.col("c_custkey").cast("string")).alias("cells"),
    )
    blank = body.select("file", (F.col("row_no") + 1).alias("row_no"), F.array(F.lit("only junk")).alias("cells"))
    heads = rows.select("file").distinct()
    title = heads.select("file", F.lit(1).cast("bigint").alias("row_no"), F.array(F.lit("Stock list")).alias("cells"))
    header = heads.where("file <> 'furniture.xlsm'").select(
        "file", F.lit(4).cast("bigint").alias("row_no"), F.array(F.lit("no"), F.lit("TITLE "), F.lit("CODE")).alias("cells")
    )
    cells = title.unionAll(header).unionAll(body).unionAll(blank)
    return grid.promote_by_marker(cells, "code", ["Code", "Title", "Artist"])


@query("src_11_two_sheets", "select n_name as \"Name\", n_nationkey::varchar as \"Key\", 'book' as \"Repository\" from nation where n_regionkey < 2")
def src_11_sheets(t):
    """Sheets of one file have their headers in other rows and orders; one has none."""
    region, key = F.col("n_regionkey"), F.col("n_nationkey").cast("string")
    rows = t.nation.select(F.lit("book.xlsx").alias("file"), F.concat(F.lit("s"), region).alias("sheet"), "*")
    body = rows.select("file", "sheet", (F.col("n_nationkey") + 10).cast("bigint").alias("row_no"), F.when(region == 0, F.array("n_name", key)).otherwise(F.array(key, "n_name")).alias("cells"))
    heads = rows.select("file", "sheet", "n_regionkey").distinct().where("n_regionkey < 2")
    header = heads.select(
        "file", "sheet", (F.col("n_regionkey") + 2).cast("bigint").alias("row_no"),
        F.when(F.col("n_regionkey") == 0, F.array(F.lit("name"), F.lit("KEY"))).otherwise(F.array(F.lit("Key"), F.lit(" Name"))).alias("cells"),
    )
    return grid.promote_by_marker(header.unionAll(body), "name", ["Name", "Key"])


# -- change tests


@query(
    "chg_01_fingerprint",
    """
    select 'reordered' as version, false as changed
    union all select 'price_raised', exists (select 1 from orders where o_orderpriority = '1-URGENT')
    union all select 'row_doubled', exists (select 1 from orders where o_totalprice > 100000)
    union all select 'value_blanked', exists (select 1 from orders where o_orderstatus = 'P')
    """,
)
def chg_01(t):
    base = change.fingerprint(t.orders)
    raised = F.when(F.col("o_orderpriority") == "1-URGENT", F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice"))
    blanked = F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus"))
    versions = {
        "reordered": t.orders.repartition("o_custkey"),
        "price_raised": t.orders.withColumn("o_totalprice", raised),
        "row_doubled": t.orders.unionAll(t.orders.where("o_totalprice > 100000")),
        "value_blanked": t.orders.withColumn("o_orderstatus", blanked),
    }
    out = None
    for name, df in versions.items():
        row = df.agg(change.fingerprint_columns(df).alias("f")).select(F.lit(name).alias("version"), (F.col("f") != base).alias("changed"))
        out = row if out is None else out.unionAll(row)
    return out


_NEW_ORDERS = """
    select * replace (case when o_orderkey % 977 = 0 then o_totalprice + 1 else o_totalprice end as o_totalprice) from orders
    where o_orderkey not between 1000 and 1100 union all select * from orders where o_orderkey = 500"""


def _new_orders(t):
    """Some prices raised, a run of orders gone, a row doubled."""
    raised = F.when(F.col("o_orderkey") % 977 == 0, F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice")).alias("o_totalprice")
    changed = t.orders.where("o_orderkey not between 1000 and 1100").select(*[raised if c == "o_totalprice" else F.col(c) for c in t.orders.columns])
    return changed.unionAll(t.orders.where("o_orderkey = 500"))


@query(
    "chg_01_changed_ranges",
    f"""
    with new_orders as ({_NEW_ORDERS}),
    a as (select o_orderkey // 64 as node, count(*) as n from orders group by 1),
    b as (select o_orderkey // 64 as node, count(*) as n from new_orders group by 1),
    touched as (
        select distinct o_orderkey // 64 as node from ((select * from orders except all select * from new_orders)
        union all (select * from new_orders except all select * from orders)))
    select node * 64 as low, node * 64 + 63 as high, coalesce(a.n, 0) as n_old, coalesce(b.n, 0) as n_new
    from touched left join a using (node) left join b using (node)
    """,
)
def chg_01_ranges(t):
    """The fingerprint tree of the loaded version is kept; with that of the new one it names the ranges that changed."""
    path = scratch_dir(t.spark, "tree")
    change.fingerprint_tree(t.orders, "o_orderkey", 64).write.parquet(path)
    return change.changed_ranges(t.spark.read.parquet(path), cut_lineage(change.fingerprint_tree(_new_orders(t), "o_orderkey", 64)), 64)


@query(
    "dq_10_changed_rows",
    f"""
    with new_orders as ({_NEW_ORDERS})
    select o_orderkey, o_totalprice, change, count(*) as copies from (
        select *, 'removed' as change from (select * from orders except all select * from new_orders)
        union all select *, 'added' from (select * from new_orders except all select * from orders)) group by all
    """,
)
def dq_10_rows(t):
    """Rows that differ, looked for in the changed ranges only."""
    new = _new_orders(t)
    trees = [cut_lineage(change.fingerprint_tree(df, "o_orderkey", 64)) for df in (t.orders, new)]
    found = change.changed_rows(t.orders, new, "o_orderkey", change.changed_ranges(*trees, 64), 64)
    return found.select("o_orderkey", "o_totalprice", "change", "copies")


@query(
    "chg_02_watermark_change",
    """
    select last, exists (select 1 from events where last is null or ts > cast(last as timestamp)) as changed
    from (values (null), ('2024-01-15 00:00:00'), ('2024-02-01 00:00:00')) v(last)
    """,
)
def chg_02(t):
    marks = [None, "2024-01-15 00:00:00", "2024-02-01 00:00:00"]
    rows = [(m, change.has_newer(t.events, "ts", m)) for m in marks]
    return t.spark.createDataFrame(rows, "last string, changed boolean")


@query("chg_03_next_watermark", "select event_type, cast(max(ts) as varchar) as watermark from events group by 1")
def chg_03(t):
    return t.events.groupBy("event_type").agg(change.next_watermark(t.events, "ts").alias("watermark"))


# -- staging


@query(
    "stg_01_clean_names",
    'select p_partkey as "key", p_name as "name", p_brand as "name_1", p_type as "col_3", p_size as "name_2" from part',
)
def stg_01(t):
    raw = t.part.select("p_partkey", "p_name", "p_brand", "p_type", "p_size").toDF("key", " name", "name\n", "  ", "name")
    return staging.clean_names(raw)


@query("stg_01_clashing_names", 'select r_regionkey as "a", r_name as "a_1", r_regionkey as "a_1_1" from region')
def stg_01_clash(t):
    return staging.clean_names(t.region.select("r_regionkey", "r_name", F.col("r_regionkey")).toDF("a", "a", "a_1"))


@query("stg_01_field_mapping", "select p_partkey as id, p_name as title from part")
def stg_01_mapping(t):
    return staging.map_fields(t.part, {"p_partkey": "id", "p_name": "title", "absent": "gone"})


@query(
    "stg_02_nested_to_json",
    """
    select c_custkey, '{"name":"' || c_name || '","nation":' || c_nationkey::varchar || '}' as profile,
           '["' || c_mktsegment || '","é"]' as tags from customer
    """,
)
def stg_02(t):
    profile = F.struct(F.col("c_name").alias("name"), F.col("c_nationkey").alias("nation"))
    rows = t.customer.select("c_custkey", profile.alias("profile"), F.array("c_mktsegment", F.lit("é")).alias("tags"))
    return documents.nested_to_json(rows)


@query(
    "stg_02_embeddings_to_json",
    "select vec_id, cast(len(embedding) as bigint) as n, label from embeddings",
)
def stg_02_embeddings(t):
    """Vectors survive the way through JSON text."""
    text = documents.nested_to_json(t.embeddings)
    back = F.from_json("embedding", "array<float>")
    same = text.select("vec_id", back.alias("v"), "label").join(t.embeddings.select("vec_id", "embedding"), "vec_id")
    return same.where(F.col("v") == F.col("embedding")).select("vec_id", F.size("v").cast("bigint").alias("n"), "label")


@query(
    "stg_03_technical_columns",
    """
    select *, 'nation' as _source_id, 'shop' as _source_connection, 'nation_20240201_060000' as _batch_id,
           timestamp '2024-02-01 06:00:00' as _loaded_at from nation
    """,
)
def stg_03(t):
    return staging.stage(staging.mark_source(t.nation, "nation", "shop"), "nation_20240201_060000", _DAY)


# -- sinks


def _warehouse(t, label: str) -> Warehouse:
    return Warehouse(t.spark, scratch_dir(t.spark, label), buckets=8)


@query("snk_01_land_batch", "select *, (select count(*) from orders) as rows, (select max(o_orderdate)::varchar from orders) as mark from orders")
def snk_01(t):
    wh = _warehouse(t, "land")
    batch = wh.land(t.orders, "table", "shop", "orders_20240201_060000", "o_orderdate")
    back = wh.read_batch(batch.path)
    return back.withColumns({"rows": F.lit(batch.rows).cast("bigint"), "mark": F.lit(batch.watermark)})


@query("snk_02_truncate_load", "select * from orders where o_orderstatus = 'O'")
def snk_02(t):
    wh = _warehouse(t, "truncate")
    for i, status in enumerate(("F", "O")):
        wh.commit(f"b{i}", "orders", wh.load("orders", t.orders.where(F.col("o_orderstatus") == status), "truncate"))
    return wh.table("orders")


@query("snk_03_append_load", "select * from orders where o_orderstatus in ('O', 'F')")
def snk_03(t):
    wh = _warehouse(t, "append")
    for i, status in enumerate(("F", "O")):
        wh.commit(f"b{i}", "orders", wh.load("orders", t.orders.where(F.col("o_orderstatus") == status), "append"))
    return wh.table("orders")


@query(
    "snk_04_upsert_load",
    """
    select c_custkey, c_name, c_nationkey, case when c_acctbal < 0 or c_mktsegment = 'MACHINERY' then c_acctbal + 1000 else c_acctbal end as c_acctbal, c_mktsegment
    from customer
    """,
)
def snk_04(t):
    """Machinery customers come only with the delta; indebted ones are replaced; stale copies in the delta lose."""
    wh = _warehouse(t, "upsert")
    base = t.customer.where("c_mktsegment <> 'MACHINERY'").withColumn("version", F.lit(1))
    wh.commit("b0", "customer", wh.load("customer", base, "upsert", ["c_custkey"]))
    changed = t.customer.where("c_acctbal < 0 or c_mktsegment = 'MACHINERY'")
    fresh = changed.withColumn("c_acctbal", F.col("c_acctbal") + 1000).withColumn("version", F.lit(3))
    delta = fresh.unionByName(changed.withColumn("version", F.lit(2)))
    wh.commit("b1", "customer", wh.load("customer", delta, "upsert", ["c_custkey"], [F.desc("version")]))
    return wh.table("customer").drop("version")


@query("snk_05_delta_upsert_twice", "select * from orders")
def snk_05(t):
    """The same delta loaded twice adds nothing."""
    wh = _warehouse(t, "delta")
    wh.commit("b0", "orders", wh.load("orders", t.orders.where("o_orderdate < '1999-01-01'"), "append"))
    delta = t.orders.where("o_orderdate >= '1998-06-01'")
    for i in (1, 2):
        wh.commit(f"b{i}", "orders", wh.load("orders", delta, "upsert", ["o_orderkey"]))
    return wh.table("orders")


@query("snk_06_stream_upsert", "select * from events")
def snk_06(t):
    """Events arrive as files of a folder, half of them twice; the table equals the batch."""
    landing = scratch_dir(t.spark, "arrivals")
    t.events.where("event_type <> 'view'").write.parquet(landing)
    t.events.write.mode("append").parquet(landing)
    stream = t.spark.readStream.schema(t.events.schema).option("maxFilesPerTrigger", 1).parquet(landing)
    wh = _warehouse(t, "stream")
    run = stream_upsert(wh, stream, "events", ["event_id"], "events", scratch_dir(t.spark, "progress"), "ts")
    run.awaitTermination()
    return wh.table("events")


@query("snk_06_stream_redelivered", "select distinct event_id, ts, event_type from events")
def snk_06_redelivered(t):
    """Rows delivered again inside the delay drop in the stream itself."""
    landing = scratch_dir(t.spark, "arrivals")
    slim = t.events.select("event_id", "ts", "event_type").withColumn("ts", F.col("ts").cast("timestamp"))
    slim.unionAll(slim.where("event_type = 'click'")).write.parquet(landing)
    stream = t.spark.readStream.schema(slim.schema).parquet(landing)
    wh = _warehouse(t, "stream")
    once = drop_redelivered(stream, ["event_id"], "ts", "60 days")
    stream_upsert(wh, once, "events", ["event_id"], "events", scratch_dir(t.spark, "progress")).awaitTermination()
    return wh.table("events").withColumn("ts", F.col("ts").cast("timestamp_ntz"))


@query(
    "snk_07_materialise",
    """
    select 'view' as kind, o_orderkey, o_totalprice from orders where o_orderstatus = 'F'
    union all select 'table', o_orderkey, o_totalprice from orders where o_orderstatus = 'O'
    union all select 'incremental', o_orderkey, o_totalprice from orders where o_orderstatus in ('O', 'F')
    """,
)
def snk_07(t):
    wh = _warehouse(t, "materialise")
    by = {s: t.orders.where(F.col("o_orderstatus") == s).select("o_orderkey", "o_totalprice") for s in "FO"}
    view = materialise.as_view(by["F"], "done_orders_view")
    materialise.as_table(wh, "kept", by["F"])
    table = materialise.as_table(wh, "kept", by["O"])
    materialise.as_incremental(wh, "grown", by["F"], ["o_orderkey"])
    grown = materialise.as_incremental(wh, "grown", by["O"], ["o_orderkey"])
    parts = [("view", view), ("table", table), ("incremental", grown)]
    labelled = [df.select(F.lit(kind).alias("kind"), "o_orderkey", "o_totalprice") for kind, df in parts]
    return labelled[0].unionAll(labelled[1]).unionAll(labelled[2])


@query("snk_08_incremental_fact", "select * from orders")
def snk_08(t):
    """Two loads, the second with rows already there: only newer dates count, and the whole is the table."""
    wh = _warehouse(t, "fact")
    materialise.as_incremental(wh, "fact", t.orders.where("o_orderdate < '1998-03-01'"), ["o_orderkey"], "o_orderdate")
    return materialise.as_incremental(wh, "fact", t.orders, ["o_orderkey"], "o_orderdate")


@query("snk_03_new_column", "select c_custkey, case when c_custkey % 2 = 1 then c_mktsegment end as c_mktsegment from customer")
def snk_03_new_column(t):
    """The second append brings a column the first lacks."""
    wh = _warehouse(t, "wider")
    wh.commit("b0", "customer", wh.load("customer", t.customer.where("c_custkey % 2 = 0").select("c_custkey"), "append"))
    wh.commit("b1", "customer", wh.load("customer", t.customer.where("c_custkey % 2 = 1").select("c_mktsegment", "c_custkey"), "append"))
    return wh.table("customer")


@query("snk_03_interleaved", "select o_orderkey, o_orderstatus from orders")
def snk_03_interleaved(t):
    """Appends written at the same time and committed in the other order keep all rows."""
    wh = _warehouse(t, "interleaved")
    rows = t.orders.select("o_orderkey", "o_orderstatus")
    written = [wh.load("orders", rows.where(F.col("o_orderstatus") == s), "append") for s in "FOP"]
    for i, change in enumerate(reversed(written)):
        wh.commit(f"b{i}", "orders", change)
    return wh.table("orders")


@query("snk_04_widened", "select o_orderkey, floor(o_totalprice) + case when o_orderkey % 3 = 0 then 0.75::double else 0 end as price from orders")
def snk_04_widened(t):
    """A delta of doubles into a column of ints widens the column."""
    wh = _warehouse(t, "widened")
    whole = F.floor(F.col("o_totalprice").cast("double")).cast("int")
    wh.commit("b0", "prices", wh.load("prices", t.orders.select("o_orderkey", whole.alias("price")), "upsert", ["o_orderkey"]))
    delta = t.orders.where("o_orderkey % 3 = 0").select("o_orderkey", (whole.cast("double") + 0.75).alias("price"))
    wh.commit("b1", "prices", wh.load("prices", delta, "upsert", ["o_orderkey"]))
    return wh.table("prices")


@query(
    "snk_05_delete_insert",
    """
    with delta as (select l_orderkey, l_linenumber from lineitem where l_orderkey % 5 = 0 and l_linenumber <= 2)
    select l_orderkey, l_linenumber, 'old' as version from lineitem where l_orderkey not in (select l_orderkey from delta)
    union all select *, 'new' from delta
    """,
)
def snk_05_delete_insert(t):
    """Rows of the delta's keys go, then the whole delta is added, equal keys included; twice changes nothing."""
    wh = _warehouse(t, "delete_insert")
    rows = t.lineitem.select("l_orderkey", "l_linenumber")
    wh.commit("b0", "lines", wh.load("lines", rows.withColumn("version", F.lit("old")), "append"))
    delta = rows.where("l_orderkey % 5 = 0 and l_linenumber <= 2").withColumn("version", F.lit("new"))
    for i in (1, 2):
        wh.commit(f"b{i}", "lines", wh.load("lines", delta, "delete_insert", ["l_orderkey"]))
    return wh.table("lines")


@query("snk_06_restart", "select event_id, ts, event_type from events")
def snk_06_restart(t):
    """The stream's progress is lost while its folder grows: the first epoch of the new run holds other rows and counts."""
    landing = scratch_dir(t.spark, "arrivals")
    slim = t.events.select("event_id", "ts", "event_type")
    wh = _warehouse(t, "stream")
    for part in ("event_id % 2 = 0", "event_id % 2 = 1"):
        slim.where(part).write.mode("append").parquet(landing)
        stream = t.spark.readStream.schema(slim.schema).parquet(landing)
        stream_upsert(wh, stream, "events", ["event_id"], "events", scratch_dir(t.spark, "progress"), "ts").awaitTermination()
    return wh.table("events")


# -- ledger


def _month_events(t, status, number: int):
    """One event per priority and month of orders, as batches of a source."""
    month = F.date_format("o_orderdate", "yyyyMM")
    grouped = t.orders.groupBy(F.col("o_orderpriority").alias("source_id"), month.alias("month")).agg(
        F.count(F.lit(1)).alias("row_count"), F.max("o_orderdate").alias("event_at")
    )
    batch_id = F.concat_ws("_", "source_id", "month")
    return grouped.select(
        "source_id",
        F.lit("table").alias("source_type"),
        batch_id.alias("batch_id"),
        F.concat(F.lit("raw/table/"), batch_id).alias("path"),
        F.col("event_at").cast("string").alias("watermark_value"),
        "row_count",
        "event_at",
        F.lit(number).alias("event_no"),
        status.alias("status"),
    )


def _order_ledger(t, label: str, failing: int) -> Ledger:
    """Every batch extracted, then loaded; those with fewer rows than ``failing`` failed."""
    ledger = Ledger(t.spark, scratch_dir(t.spark, label))
    ledger.append(_month_events(t, F.lit("extracted"), 1))
    outcome = F.when(F.col("row_count") < failing, "failed").otherwise("loaded")
    second = _month_events(t, outcome, 2)
    error = F.when(F.col("status") == "failed", F.repeat(F.lit("too few "), 300))
    ledger.append(
        second.withColumn("error_message", error).drop("source_id", "path", "row_count", "watermark_value", "source_type")
    )
    return ledger


_BATCH_SQL = """
    b as (select o_orderpriority as source_id, strftime(o_orderdate, '%Y%m') as month, count(*) as row_count, max(o_orderdate) as extracted_at,
                 o_orderpriority || '_' || strftime(o_orderdate, '%Y%m') as batch_id
          from orders group by all)
"""


@query(
    "led_01_register",
    f"with {_BATCH_SQL} select batch_id, source_id, row_count, extracted_at, extracted_at::varchar as watermark_value, 'extracted' as status from b",
)
def led_01(t):
    ledger = Ledger(t.spark, scratch_dir(t.spark, "ledger"))
    ledger.append(_month_events(t, F.lit("extracted"), 1))
    return ledger.batches().select("batch_id", "source_id", "row_count", "extracted_at", "watermark_value", "status")


@query(
    "led_02_mark",
    f"""
    with {_BATCH_SQL} select batch_id, case when row_count < 30 then 'failed' else 'loaded' end as status,
        case when row_count < 30 then 2000 end as error_chars, case when row_count >= 30 then extracted_at end as loaded_at from b
    """,
)
def led_02(t):
    batches = _order_ledger(t, "ledger", 30).batches()
    return batches.select("batch_id", "status", F.length("error_message").alias("error_chars"), "loaded_at")


@query(
    "led_03_last_success",
    f"with {_BATCH_SQL} select distinct on (source_id) source_id, batch_id, extracted_at::varchar as watermark_value, row_count from b where row_count >= 30 order by source_id, extracted_at desc, batch_id desc",
)
def led_03(t):
    return _order_ledger(t, "ledger", 30).last_successes().select("source_id", "batch_id", "watermark_value", "row_count")


@query(
    "led_04_history",
    f"""
    with {_BATCH_SQL} select batch_id, row_count, case when row_count < 30 then 'failed' else 'loaded' end as status, extracted_at
    from b where source_id = '3-MEDIUM' order by extracted_at desc, batch_id desc limit 20
    """,
)
def led_04(t):
    return _order_ledger(t, "ledger", 30).history("3-MEDIUM").select("batch_id", "row_count", "status", "extracted_at")


@query(
    "led_05_as_of",
    f"with {_BATCH_SQL} select distinct on (source_id) source_id, batch_id, extracted_at from b where row_count >= 30 and extracted_at <= timestamp '1997-05-17' order by source_id, extracted_at desc, batch_id desc",
)
def led_05(t):
    return _order_ledger(t, "ledger", 30).as_of("1997-05-17").select("source_id", "batch_id", "extracted_at")


def _growing(t, until: str) -> SourceSpec:
    return SourceSpec(
        "orders",
        lambda spark: t.orders.where(F.col("o_orderdate") < _at(until)),
        connection="shop",
        watermark_column="o_orderdate",
        upsert_key=("o_orderkey",),
    )


@query(
    "led_06_workflow",
    """
    select *, case when o_orderdate < timestamp '1997-01-01' then 0 when o_orderdate < timestamp '1999-01-01' then 1 else 2 end as run,
           cast(2 as bigint) as skipped from orders where o_orderdate < timestamp '2001-01-01'
    """,
)
def led_06(t):
    """Five runs of a growing source: three load a delta, two find no change."""
    wh = _warehouse(t, "workflow")
    ids = []
    for until in ("1997-01-01", "1997-01-01", "1999-01-01", "2001-01-01", "2001-01-01"):
        batch = run_source(wh, _growing(t, until), at=_DAY)
        ids.append(batch.batch_id if batch else None)
    done = [i for i in ids if i]
    run = F.array_position(F.array(*[F.lit(i) for i in done]), F.col("_batch_id")).cast("int") - 1
    rows = wh.table("orders").withColumn("run", run).withColumn("skipped", F.lit(ids.count(None)).cast("bigint"))
    return rows.drop("_batch_id", "_loaded_at", "_source_id", "_source_connection")


@query("led_06_rollback", "select * from orders where o_orderdate < timestamp '1997-01-01'")
def led_06_rollback(t):
    """Truncate loads on two days, a failed one on a third, then back to the first day."""
    wh = _warehouse(t, "rollback")

    def spec(until):
        return SourceSpec("orders", lambda spark: t.orders.where(F.col("o_orderdate") < _at(until)), load_mode="truncate")

    run_source(wh, spec("1997-01-01"), at=dt.datetime(2024, 1, 1, 6))
    run_source(wh, spec("1999-01-01"), at=dt.datetime(2024, 1, 5, 6))
    try:
        load_batch(wh, spec("2000-01-01"), Batch("orders_lost", f"{wh.root}/nowhere", 1), dt.datetime(2024, 1, 6, 6))
    except Exception:  # noqa: BLE001 - the failure is the point: it must stay invisible
        pass
    rollback(wh, spec("1999-01-01"), "2024-01-03")
    return wh.table("orders").drop("_batch_id", "_loaded_at", "_source_id")


@query("led_06_truncate_watermark", "select *, cast(1 as bigint) as skipped from orders")
def led_06_truncate(t):
    """A source with a mark whose loads replace the table: each load holds all of it, not the delta."""
    wh = _warehouse(t, "replaced")
    skipped = 0
    for until in ("1997-01-01", "1997-01-01", "2003-01-01"):
        spec = SourceSpec(
            "orders",
            lambda spark, until=until: t.orders.where(F.col("o_orderdate") < _at(until)),
            watermark_column="o_orderdate",
            upsert_key=("o_orderkey",),
            load_mode="truncate",
            columns=tuple(c for c in t.orders.columns),
        )
        skipped += run_source(wh, spec, at=_DAY) is None
    rows = wh.table("orders").withColumn("skipped", F.lit(skipped).cast("bigint"))
    return rows.drop("_batch_id", "_loaded_at", "_source_id")


@query("led_06_mark_not_kept", "select o_orderkey as id from orders")
def led_06_mark(t):
    """The mapping leaves out the watermark column: the mark is taken before, and nothing loads twice."""
    wh = _warehouse(t, "mapped")
    for until in ("1997-01-01", "2003-01-01", "2003-01-01"):
        spec = SourceSpec(
            "orders", lambda spark, until=until: t.orders.where(F.col("o_orderdate") < _at(until)),
            watermark_column="o_orderdate", field_mapping={"o_orderkey": "id"},
        )
        run_source(wh, spec, at=_DAY)
    return wh.table("orders").select("id")


@query("led_05_rollback_deltas", "select * from orders")
def led_05_rollback(t):
    """Three deltas, back to the second, one more run: the table is the source again."""
    wh = _warehouse(t, "rollback")
    for day, until in ((1, "1995-01-01"), (2, "1997-01-01"), (3, "1999-01-01")):
        run_source(wh, _growing(t, until), at=dt.datetime(2024, 1, day, 6))
    rollback(wh, _growing(t, "1999-01-01"), "2024-01-02")
    run_source(wh, _growing(t, "2003-01-01"), at=dt.datetime(2024, 1, 4, 6))
    return wh.table("orders").drop("_batch_id", "_loaded_at", "_source_id", "_source_connection")
