"""Table-level transforms on the driver tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from ..functions.keys import NULL_MARK, surrogate_key
from ..operators.dedupe import deduplicate
from ..operators.reshape import (
    blank_strings_to_null,
    column_frequencies,
    every_column_value,
    filtered_columns,
    pivot_columns,
    single_value,
    star,
    unpivot,
)
from ..operators.series import date_spine, number_series
from ..operators.union import tables_by_pattern, tables_by_prefix, union_relations, union_tables
from .base import query

_COUNTS = ", ".join(
    f"cast(sum(case when event_type = '{e}' then 1 else 0 end) as bigint) as \"{e}\""
    for e in ("click", "error", "purchase", "signup", "view")
)


@query(
    "flagship_user_profile",
    f"""
    with latest as (
        select user_id, event_id as last_event_id, ts as last_ts, event_type as last_type
        from (select *, row_number() over (partition by user_id order by ts desc, event_id desc) as n from events)
        where n = 1
    ), counts as (select user_id, {_COUNTS} from events group by user_id)
    select md5(coalesce(cast(user_id as varchar), '{NULL_MARK}') || '-' || coalesce(last_type, '{NULL_MARK}')) as profile_key,
           user_id, last_event_id, last_ts, last_type, click, error, purchase, signup, view
    from latest join counts using (user_id)
    """,
)
def flagship(t):
    latest = deduplicate(t.events, ["user_id"], [F.desc("ts"), F.desc("event_id")])
    latest = latest.select(
        "user_id",
        F.col("event_id").alias("last_event_id"),
        F.col("ts").alias("last_ts"),
        F.col("event_type").alias("last_type"),
    )
    types = sorted(every_column_value(t.events, "event_type", 100, default=[]))
    counts = t.events.groupBy("user_id").agg(*pivot_columns("event_type", types))
    return latest.join(counts, "user_id").select(
        surrogate_key("user_id", "last_type").alias("profile_key"), *latest.columns, *types
    )


@query(
    "tbl_01_deduplicate",
    "select distinct on (user_id) event_id, ts, user_id, event_type, value, props from events "
    "order by user_id, ts desc, event_id desc",
)
def tbl_01(t):
    return deduplicate(t.events, ["user_id"], [F.desc("ts"), F.desc("event_id")])


@query(
    "tbl_02_unpivot",
    """
    select p_partkey, p_name, 'p_size' as measure, cast(p_size as double) as amount from part
    union all
    select p_partkey, p_name, 'p_retailprice', p_retailprice from part
    """,
)
def tbl_02(t):
    return unpivot(
        t.part,
        keep=["P_PARTKEY", "p_name"],
        remove=["p_brand", "P_TYPE"],
        cast_to="double",
        field_name="measure",
        value_name="amount",
    )


@query(
    "tbl_02_unpivot_text",
    """
    select o_orderkey, 'o_custkey' as field_name, cast(o_custkey as varchar) as value from orders
    union all select o_orderkey, 'o_orderstatus', o_orderstatus from orders
    union all select o_orderkey, 'is_large', case when o_totalprice > 250000 then 'true' else 'false' end from orders
    union all select o_orderkey, 'urgent_note', case when o_orderpriority = '1-URGENT' then 'urgent' end from orders
    """,
)
def tbl_02_text(t):
    rows = t.orders.select(
        "o_orderkey",
        "o_custkey",
        "o_orderstatus",
        (F.col("o_totalprice") > 250000).alias("is_large"),
        F.when(F.col("o_orderpriority") == "1-URGENT", "urgent").alias("urgent_note"),
    )
    return unpivot(rows, keep=["o_orderkey"])


@query("tbl_03_pivot", f"select user_id, {_COUNTS} from events group by user_id")
def tbl_03(t):
    types = every_column_value(t.events, "event_type", 100, default=[])
    return t.events.groupBy("user_id").agg(*pivot_columns("event_type", types))


@query(
    "tbl_03_pivot_options",
    """
    select l_suppkey,
           count(distinct case when l_returnflag <> 'A' then l_partkey end) as parts_not_a,
           count(distinct case when l_returnflag <> 'N' then l_partkey end) as parts_not_n,
           cast(sum(case when l_linestatus = 'F' then cast(l_quantity as bigint) else 0 end) as bigint) as qty_f,
           cast(sum(case when l_linestatus = 'O' then cast(l_quantity as bigint) else 0 end) as bigint) as qty_o
    from lineitem group by l_suppkey
    """,
)
def tbl_03_options(t):
    parts = pivot_columns(
        "l_returnflag", ["A", "N"], agg="count", cmp="<>", prefix="Parts not ", quote=False,
        then_value=F.col("l_partkey"), else_value=None, distinct=True,
    )
    quantity = pivot_columns(
        "l_linestatus", ["F", "O"], prefix="qty-", quote=False, then_value=F.col("l_quantity").cast("bigint")
    )
    return t.lineitem.groupBy("l_suppkey").agg(*parts, *quantity)


@query(
    "tbl_03_pivot_any_aggregate",
    """
    select l_suppkey, round(stddev_samp(case when l_returnflag = 'A' then l_quantity end), 6) as sd_a,
           round(stddev_samp(case when l_returnflag = 'N' then l_quantity end), 6) as sd_n,
           max(case when l_linestatus = 'F' then l_shipdate end) as last_f
    from lineitem group by l_suppkey
    """,
)
def tbl_03_any(t):
    def spread(c):
        return F.round(F.stddev(c), 6)

    sd = pivot_columns("l_returnflag", ["A", "N"], agg=spread, prefix="sd ", quote=False, then_value=F.col("l_quantity"), else_value=None)
    last = pivot_columns("l_linestatus", ["F"], agg="max", prefix="last ", quote=False, then_value=F.col("l_shipdate"), else_value=None)
    return t.lineitem.groupBy("l_suppkey").agg(*sd, *last)


@query(
    "tbl_04_column_values",
    "select p_type as value, count(*) as n from part where p_size > 10 group by 1 order by n desc, value limit 3",
)
def tbl_04(t):
    return column_frequencies(t.part, "p_type", max_records=3, where="p_size > 10")


@query(
    "tbl_05_union_relations",
    """
    select 'customer' as source_table, c_name as name, c_nationkey as nationkey, c_acctbal as acctbal,
           c_mktsegment as segment, cast(null as bigint) as suppkey
    from customer where c_acctbal > 0
    union all
    select 'supplier', s_name, cast(s_nationkey as integer), s_acctbal, null, s_suppkey from supplier where s_acctbal > 0
    """,
)
def tbl_05(t):
    customers = t.customer.select(
        F.col("c_custkey").alias("custkey"),
        F.col("c_name").alias("name"),
        F.col("c_nationkey").alias("nationkey"),
        F.col("c_acctbal").alias("acctbal"),
        F.col("c_mktsegment").alias("segment"),
    )
    suppliers = t.supplier.select(
        F.col("s_suppkey").alias("suppkey"),
        F.col("s_name").alias("name"),
        F.col("s_nationkey").alias("nationkey"),
        F.col("s_acctbal").alias("acctbal"),
    )
    return union_relations(
        {"customer": customers, "supplier": suppliers},
        exclude=["CUSTKEY"],
        source_column="source_table",
        where="acctbal > 0",
    )


@query(
    "tbl_05_union_include_override",
    """
    select c_nationkey::varchar as nationkey, c_acctbal as acctbal from customer
    union all select s_nationkey::varchar, s_acctbal from supplier
    """,
)
def tbl_05_include(t):
    customers = t.customer.withColumnsRenamed({"c_nationkey": "nationkey", "c_acctbal": "acctbal"})
    suppliers = t.supplier.withColumnsRenamed({"s_nationkey": "nationkey", "s_acctbal": "acctbal"})
    return union_relations(
        {"customer": customers, "supplier": suppliers},
        include=["nationkey", "ACCTBAL"],
        column_override={"nationkey": "string"},
        source_column=None,
    )


@query(
    "tbl_06_star",
    "select n_nationkey as nation_n_nationkey_id, n_name as label from nation",
)
def tbl_06(t):
    return t.nation.select(*star(t.nation, drop=["N_REGIONKEY"], prefix="nation_", suffix="_id", rename={"N_NAME": "label"}))


@query("tbl_06_filtered_columns", "select o_orderkey, o_custkey, o_orderstatus, o_orderdate from orders")
def tbl_06_filtered(t):
    return t.orders.select(*filtered_columns(t.orders, ["O_TOTALPRICE", "o_orderpriority"]))


@query(
    "tbl_07_number_series",
    """
    select g.n as generated_number, count(o_orderkey) as n_orders
    from (select unnest(range(1, (select max(c_custkey) + 1 from customer))) as n) g
    left join orders on o_custkey = g.n group by g.n
    """,
)
def tbl_07(t):
    upper = single_value(t.customer.agg(F.max("c_custkey")), 1)
    numbers = number_series(t.spark, upper)
    per_customer = t.orders.groupBy("o_custkey").agg(F.count("o_orderkey").alias("n_orders"))
    joined = numbers.join(per_customer, F.col("generated_number") == F.col("o_custkey"), "left")
    return joined.select("generated_number", F.coalesce("n_orders", F.lit(0)).alias("n_orders"))


@query(
    "tbl_08_date_spine",
    """
    with bounds as (select cast(min(o_orderdate) as date) as lo, cast(max(o_orderdate) as date) as hi from orders),
    days as (select cast(unnest(range(lo, hi, interval 1 day)) as date) as date_day from bounds)
    select date_day, count(o_orderkey) as n_large
    from days left join (select * from orders where o_totalprice > 400000) l on cast(l.o_orderdate as date) = date_day
    group by date_day
    """,
)
def tbl_08(t):
    low, high = t.orders.agg(F.min("o_orderdate").cast("date"), F.max("o_orderdate").cast("date")).first()
    large = t.orders.where(F.col("o_totalprice") > 400000)
    per_day = large.groupBy(F.col("o_orderdate").cast("date").alias("date_day")).agg(F.count(F.lit(1)).alias("n"))
    days = date_spine(t.spark, "day", low, high)
    return days.join(per_day, "date_day", "left").select("date_day", F.coalesce("n", F.lit(0)).alias("n_large"))


@query(
    "tbl_08_second_spine",
    """
    with bounds as (select date_trunc('second', min(ts)) as lo from events)
    select lo + to_seconds(i) as date_second, count(event_id) as n_events
    from bounds, unnest(range(0, 90000)) as u(i) left join events on date_trunc('second', ts) = lo + to_seconds(i)
    group by all
    """,
)
def tbl_08_second(t):
    low = t.events.agg(F.date_trunc("second", F.min("ts")).cast("timestamp_ntz")).first()[0]
    per_second = t.events.groupBy(F.date_trunc("second", "ts").cast("timestamp_ntz").alias("_at")).agg(F.count(F.lit(1)).alias("n"))
    seconds = date_spine(t.spark, "second", low, low + dt.timedelta(seconds=90_000))
    joined = seconds.join(per_second, F.col("date_second") == F.col("_at"), "left")
    return joined.select("date_second", F.coalesce("n", F.lit(0)).alias("n_events"))


@query(
    "tbl_08_month_spine",
    """
    with bounds as (select cast(min(o_orderdate) as date) as lo, cast(max(o_orderdate) as date) as hi from orders),
    months as (select cast(lo + to_months(cast(i as integer)) as date) as date_month
               from bounds, unnest(range(0, date_diff('month', lo, hi))) as u(i))
    select date_month, count(o_orderkey) as n_orders
    from months left join orders on o_orderdate >= date_month and o_orderdate < date_month + interval 1 month
    group by date_month
    """,
)
def tbl_08_month(t):
    low, high = t.orders.agg(F.min("o_orderdate").cast("date"), F.max("o_orderdate").cast("date")).first()
    months = date_spine(t.spark, "month", low, high)
    per_month = t.orders.groupBy(F.trunc("o_orderdate", "month").alias("_month")).agg(F.count(F.lit(1)).alias("n"))
    joined = months.join(per_month, F.trunc("date_month", "month") == F.col("_month"), "left")
    return joined.select("date_month", F.coalesce("n", F.lit(0)).alias("n_orders"))


@query(
    "tbl_09_nullcheck",
    """
    select page_id, url, nullif(split_part(url, '?', 2), '') as query_text, nullif(split_part(url, '#', 2), '') as anchor
    from pages
    """,
)
def tbl_09(t):
    rows = t.pages.select(
        "page_id",
        "url",
        F.split_part("url", F.lit("?"), F.lit(2)).alias("query_text"),
        F.split_part("url", F.lit("#"), F.lit(2)).alias("anchor"),
    )
    return blank_strings_to_null(rows)


@query(
    "tbl_10_single_value",
    """
    select o_orderkey, o_totalprice, coalesce((select min(c_custkey) from customer where c_acctbal > 1e12), -1) as fallback
    from orders where o_totalprice >= 0.95 * (select max(o_totalprice) from orders)
    """,
)
def tbl_10(t):
    top = single_value(t.orders.agg(F.max("o_totalprice")), 0.0)
    fallback = single_value(t.customer.where("c_acctbal > 1e12").select("c_custkey"), default=-1)
    large = t.orders.where(F.col("o_totalprice") >= F.lit(0.95) * F.lit(top))
    return large.select("o_orderkey", "o_totalprice", F.lit(fallback).cast("bigint").alias("fallback"))


@query(
    "src_12_sharded_tables",
    """
    select case when o_orderdate < date '1998-01-01' then 'orders_shard_early' else 'orders_shard_late' end as shard,
           o_orderkey, o_totalprice, case when o_orderdate < date '1998-01-01' then o_orderpriority end as o_orderpriority
    from orders
    """,
)
def src_12(t):
    early = F.col("o_orderdate") < F.lit("1998-01-01").cast("timestamp_ntz")
    base = ["o_orderkey", "o_totalprice"]
    t.orders.where(early).select(*base, "o_orderpriority").createOrReplaceTempView("orders_shard_early")
    t.orders.where(~early).select(*base).createOrReplaceTempView("orders_shard_late")
    t.orders.createOrReplaceTempView("orders_shard_old")
    names = tables_by_pattern(t.spark, "%", "ORDERS_shard%", exclude="%_old")
    return union_tables(t.spark, names, source_column="shard")


@query(
    "src_12_prefixed_tables",
    """
    select 'nations_a' as shard, n_nationkey, n_name from nation where n_regionkey < 2
    union all select 'nations_b', n_nationkey, n_name from nation where n_regionkey >= 2
    """,
)
def src_12_prefix(t):
    t.nation.where("n_regionkey < 2").createOrReplaceTempView("nations_a")
    t.nation.where("n_regionkey >= 2").createOrReplaceTempView("nations_b")
    names = tables_by_prefix(t.spark, "%", "nations_")
    return union_tables(t.spark, names, source_column="shard", exclude=["n_regionkey"])
