"""Business patterns on the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.dates import month_end, month_label
from ..functions.safe import safe_divide
from ..operators import business
from ..operators.dedupe import deduplicate, deduplicate_twice
from ..operators.ordered import in_order
from ..operators.reshape import unpivot
from .base import query

_LINE_ORDER = ["l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity", "l_shipdate"]


@query(
    "pat_01_positional_attribution",
    """
    with ranked as (
        select l_orderkey, l_linenumber, l_partkey,
               row_number() over (partition by l_orderkey order by l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_quantity, l_shipdate) as rn,
               count(*) over (partition by l_orderkey) as n
        from lineitem)
    select l_orderkey, l_linenumber, l_partkey, rn,
           cast(o_totalprice::decimal(18,2) * (case when n >= 5 then [5, 2, 1, 1, 1] when n = 4 then [6, 2, 1, 1] when n = 3 then [6, 3, 1]
                when n = 2 then [7, 3] else [10] end)[rn] as double) / 10 as credit
    from ranked join orders on l_orderkey = o_orderkey where rn <= 5
    """,
)
def pat_01(t):
    weighted = business.positional_weights(t.lineitem, ["l_orderkey"], _LINE_ORDER)
    joined = weighted.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
    credit = (F.col("o_totalprice").cast("decimal(18,2)") * F.col("w")).cast("double") / 10
    return joined.select("l_orderkey", "l_linenumber", "l_partkey", "rn", credit.alias("credit"))


@query(
    "pat_02_even_allocation",
    """
    with cost as (select s_nationkey, sum(s_acctbal::decimal(18,2)) as cost from supplier group by 1),
         size as (select c_nationkey, count(*) as n from customer group by 1)
    select c_custkey, s_nationkey as nationkey, cost::double / nullif(n, 0) as share
    from cost join size on s_nationkey = size.c_nationkey join customer c on c.c_nationkey = s_nationkey
    """,
)
def pat_02(t):
    costs = t.supplier.groupBy(F.col("s_nationkey").alias("nationkey")).agg(
        F.sum(F.col("s_acctbal").cast("decimal(18,2)")).cast("double").alias("cost")
    )
    members = t.customer.select("c_custkey", F.col("c_nationkey").alias("nationkey"))
    shared = business.even_share(costs, members, "nationkey", {"share": "cost"})
    return shared.select("c_custkey", "nationkey", "share")


@query(
    "pat_03_months_to_long",
    """
    select o_custkey, year(o_orderdate) as year_no, last_day(o_orderdate) as month_end,
           cast(sum(o_totalprice::decimal(18,2)) as double) as amount
    from orders group by 1, 2, 3
    """,
)
def pat_03(t):
    price, month = F.col("o_totalprice").cast("decimal(18,2)"), F.month("o_orderdate")
    wide = t.orders.groupBy("o_custkey", F.year("o_orderdate").cast("bigint").alias("year_no")).agg(
        *[F.sum(F.when(month == m, price)).alias(f"{m}") for m in range(1, 13)]
    )
    long = unpivot(wide, ["o_custkey", "year_no"], cast_to="double", field_name="month_no", value_name="amount")
    long = long.where("amount is not null")
    return long.select("o_custkey", "year_no", month_end("year_no", "month_no").alias("month_end"), "amount")


_RATES_SQL = """
    rates as (select cast(o_orderdate as date) as record_date, min(o_totalprice) / 1000 as exchange_rate
              from orders where o_orderpriority = '1-URGENT' and o_totalprice > 250000 group by 1)
"""


def _rates(t):
    """A daily rate with days missing: smallest large urgent order of the day."""
    large = t.orders.where((F.col("o_orderpriority") == "1-URGENT") & (F.col("o_totalprice") > 250000))
    return large.select(
        F.col("o_orderdate").cast("date").alias("record_date"), (F.col("o_totalprice") / 1000).alias("exchange_rate")
    )


@query(
    "pat_04_daily_rate_lookup",
    f"""
    with {_RATES_SQL}
    select l_orderkey, l_linenumber, l_partkey, l_suppkey, exchange_rate
    from lineitem left join rates on cast(l_shipdate as date) = record_date
    """,
)
def pat_04(t):
    rated = business.with_rate(t.lineitem, F.col("l_shipdate").cast("date"), _rates(t))
    return rated.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "exchange_rate")


@query(
    "pat_05_first_date_rate",
    f"""
    with {_RATES_SQL}, monthly as (
        select l_suppkey, strftime(l_shipdate, '%Y-%m') as month_label, min(cast(l_shipdate as date)) as first_date,
               cast(sum(l_extendedprice::decimal(18,2)) as double) as amount
        from lineitem group by 1, 2)
    select l_suppkey, month_label, first_date, amount, exchange_rate from monthly left join rates on first_date = record_date
    """,
)
def pat_05(t):
    monthly = t.lineitem.groupBy("l_suppkey", month_label("l_shipdate").alias("month_label")).agg(
        F.min(F.col("l_shipdate").cast("date")).alias("first_date"),
        F.sum(F.col("l_extendedprice").cast("decimal(18,2)")).cast("double").alias("amount"),
    )
    return business.with_rate(monthly, F.col("first_date"), _rates(t))


@query(
    "pat_06_two_stage_dedupe",
    """
    with marked as (select *, case when o_orderpriority <> '5-LOW' then o_orderdate end as second_key from orders),
    once as (select distinct on (o_custkey) * from marked order by o_custkey, o_totalprice desc, o_orderkey)
    select distinct on (second_key) o_orderkey, o_custkey, second_key, o_totalprice from once
    order by second_key nulls last, o_totalprice desc, o_orderkey
    """,
)
def pat_06(t):
    marked = t.orders.withColumn("second_key", F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_orderdate")))
    kept = deduplicate_twice(marked, ["o_custkey"], ["second_key"], [F.desc("o_totalprice"), F.asc("o_orderkey")])
    return kept.select("o_orderkey", "o_custkey", "second_key", "o_totalprice")


@query(
    "pat_07_usage_status",
    """
    with closed as (select distinct o_custkey from orders where o_orderstatus = 'P' and o_totalprice > 480000),
    used as (select distinct o_custkey from orders where o_totalprice > 100000),
    newest as (select o_custkey, max(cast(o_orderdate as date)) as last_day from orders where o_orderstatus = 'O' group by 1)
    select c_custkey, case when c.o_custkey is not null then 'archived' when u.o_custkey is null or n.o_custkey is null then 'unused'
           when last_day < date '2001-08-02' - 30 then 'cold' else 'active' end as status
    from customer left join closed c on c_custkey = c.o_custkey left join used u on c_custkey = u.o_custkey
    left join newest n on c_custkey = n.o_custkey
    """,
)
def pat_07(t):
    # The three evidence sets come from one table, so one pre-aggregated pass holds them all.
    day, price, state = F.col("o_orderdate").cast("date"), F.col("o_totalprice"), F.col("o_orderstatus")
    evidence = t.orders.groupBy("o_custkey").agg(
        F.bool_or((state == "P") & (price > 480000)).alias("closed"),
        F.bool_or(price > 100000).alias("used"),
        F.max(F.when(state == "O", day)).alias("last_day"),
    )
    joined = t.customer.join(evidence, F.col("c_custkey") == F.col("o_custkey"), "left")
    status = business.usage_status(
        F.coalesce("closed", F.lit(False)),
        F.coalesce("used", F.lit(False)),
        F.col("last_day"),
        F.lit("2001-08-02").cast("date"),
        ("archived", "unused", "cold", "active"),
    )
    return joined.select("c_custkey", status.alias("status"))


_CODE = "([A-Z][a-z]{9,})"


@query(
    "pat_09_token_bridge",
    f"select doc_id, regexp_extract(text, '{_CODE}', 1) as code from documents where regexp_matches(text, '{_CODE}')",
)
def pat_09(t):
    return business.first_match_links(t.documents, "text", _CODE, "code").select("doc_id", "code")


@query(
    "pat_09_token_bridge_all",
    f"select doc_id, unnest(regexp_extract_all(text, '{_CODE}', 1)) as code from documents",
)
def pat_09_all(t):
    return business.all_match_links(t.documents.select("doc_id", "text"), "text", _CODE, "code").select("doc_id", "code")


@query(
    "pat_10_membership_filter",
    """
    select l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity from lineitem
    where l_orderkey in (select o_orderkey from orders join customer on o_custkey = c_custkey
                         where o_orderstatus = 'F' and c_acctbal > 0 and c_mktsegment <> 'MACHINERY')
    """,
)
def pat_10(t):
    solvent = t.customer.where("c_acctbal > 0 and c_mktsegment <> 'MACHINERY'")
    members = t.orders.where("o_orderstatus = 'F'").join(solvent, F.col("o_custkey") == F.col("c_custkey"), "left_semi")
    lines = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity")
    return lines.join(members, F.col("l_orderkey") == F.col("o_orderkey"), "left_semi")


@query(
    "pat_11_ratio_per_unit",
    """
    select l_suppkey, cast(sum(l_extendedprice::decimal(18,2)) as double)
                            / nullif(sum(case when l_returnflag = 'R' then cast(l_quantity as bigint) else 0 end), 0)::double as price_per_unit
    from lineitem group by 1
    """,
)
def pat_11(t):
    units = F.sum(F.when(F.col("l_returnflag") == "R", F.col("l_quantity").cast("bigint")).otherwise(0))
    amount = F.sum(F.col("l_extendedprice").cast("decimal(18,2)")).cast("double")
    sums = t.lineitem.groupBy("l_suppkey").agg(amount.alias("amount"), units.alias("units"))
    return sums.select("l_suppkey", safe_divide("amount", "units").alias("price_per_unit"))


@query(
    "pat_12_version_number",
    "select o_orderkey, o_custkey, row_number() over (partition by o_custkey order by o_orderdate, o_orderkey) as version_no from orders",
)
def pat_12(t):
    rows = t.orders.select("o_orderkey", "o_custkey", "o_orderdate")
    return in_order(rows, ["o_custkey"], ["o_orderdate", "o_orderkey"], number="version_no", ties=False).drop("o_orderdate")


@query(
    "pat_13_latest_assignee",
    """
    with visits as (select user_id, event_id, event_type, case when event_type <> 'signup' or value > 20 then ts end as seen_at from events)
    select distinct on (user_id) user_id, event_id, event_type, seen_at from visits order by user_id, seen_at desc nulls first, event_id desc
    """,
)
def pat_13(t):
    known = (F.col("event_type") != "signup") | (F.col("value") > 20)
    visits = t.events.select("user_id", "event_id", "event_type", F.when(known, F.col("ts")).alias("seen_at"))
    return business.latest_per(visits, ["user_id"], "seen_at", F.desc("event_id"))


@query(
    "pat_14_key_fallback",
    """
    with base as (select l_orderkey, l_partkey, l_suppkey, case when l_returnflag <> 'A' then l_suppkey end as own, l_partkey as alt from lineitem),
    filled as (select b.l_orderkey, b.l_partkey, coalesce(own, case when p_size > 25 then p_partkey end) as own
               from base b left join part on alt = p_partkey)
    select distinct on (own) own, l_orderkey, l_partkey from filled where own is not null order by own, l_orderkey, l_partkey
    """,
)
def pat_14(t):
    own = F.when(F.col("l_returnflag") != "A", F.col("l_suppkey"))
    base = t.lineitem.select("l_orderkey", "l_partkey", own.alias("own"), F.col("l_partkey").alias("alt"))
    lookup = t.part.where("p_size > 25").select(F.col("p_partkey").alias("alt"), F.col("p_partkey").alias("code"))
    filled = business.with_fallback_key(base, "own", "alt", lookup, "code")
    return deduplicate(filled, ["own"], ["l_orderkey", "l_partkey"]).select("own", "l_orderkey", "l_partkey")


_TREE_SQL = "select n_nationkey as id, n_name as name, case when n_regionkey > 0 then n_regionkey end as parent_id from nation"


def _tree(t):
    parent = F.when(F.col("n_regionkey") > 0, F.col("n_regionkey"))
    return t.nation.select(F.col("n_nationkey").alias("id"), F.col("n_name").alias("name"), parent.alias("parent_id"))


@query("pat_15_hierarchy_roots", f"select id, name from ({_TREE_SQL}) where parent_id is null")
def pat_15_roots(t):
    return _tree(t).where("parent_id is null").select("id", "name")


@query("pat_15_hierarchy_children", f"select id, name, parent_id from ({_TREE_SQL}) where parent_id is not null")
def pat_15_children(t):
    return _tree(t).where("parent_id is not null")
