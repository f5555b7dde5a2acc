"""Relational operators as the models use them, on the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.dedupe import deduplicate, mutual_best
from ..operators.lists import list_to_names
from ..operators.ordered import in_order
from ..operators.reshape import unpivot
from ..quality import checks
from .base import query


@query(
    "rel_01_filter_project",
    """
    select o_orderkey, o_orderpriority, o_totalprice from orders
    where o_orderstatus not in ('P') and o_totalprice > 1000 and o_orderpriority is not null
      and (o_orderpriority in ('1-URGENT', '2-HIGH') or o_totalprice > 300000)
    """,
)
def rel_01(t):
    urgent = F.col("o_orderpriority").isin("1-URGENT", "2-HIGH")
    return t.orders.where(
        ~F.col("o_orderstatus").isin("P")
        & (F.col("o_totalprice") > 1000)
        & F.col("o_orderpriority").isNotNull()
        & (urgent | (F.col("o_totalprice") > 300000))
    ).select("o_orderkey", "o_orderpriority", "o_totalprice")


@query(
    "rel_02_inner_join",
    """
    select l_orderkey, l_linenumber, l_partkey, l_suppkey, c_name, n_name
    from lineitem join orders on l_orderkey = o_orderkey join customer on o_custkey = c_custkey
    join nation on c_nationkey = n_nationkey where o_orderstatus = 'F'
    """,
)
def rel_02(t):
    done = t.orders.where("o_orderstatus = 'F'").select("o_orderkey", "o_custkey")
    named = done.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
    named = named.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).select("o_orderkey", "c_name", "n_name")
    return t.lineitem.join(named, F.col("l_orderkey") == F.col("o_orderkey")).select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "c_name", "n_name"
    )


@query(
    "rel_03_left_join_chain",
    """
    select c_custkey, n_name, r_name, o_orderkey
    from customer left join nation on c_nationkey = n_nationkey and n_regionkey <> 2
    left join region on n_regionkey = r_regionkey left join orders on c_custkey = o_custkey and o_totalprice > 300000
    """,
)
def rel_03(t):
    nations = t.nation.where("n_regionkey <> 2")
    large = t.orders.where("o_totalprice > 300000").select("o_orderkey", "o_custkey")
    joined = t.customer.join(nations, F.col("c_nationkey") == F.col("n_nationkey"), "left")
    joined = joined.join(t.region, F.col("n_regionkey") == F.col("r_regionkey"), "left")
    joined = joined.join(large, F.col("c_custkey") == F.col("o_custkey"), "left")
    return joined.select("c_custkey", "n_name", "r_name", "o_orderkey")


@query(
    "rel_04_normalised_keys",
    """
    select d.doc_id, l.quality from documents d join labels l on trim(' ' || d.doc_id::varchar) = l.doc_id::varchar
    """,
)
def rel_04(t):
    texts = t.documents.select("doc_id", F.trim(F.concat(F.lit(" "), F.col("doc_id").cast("string"))).alias("doc_key"))
    marks = t.labels.select("quality", F.col("doc_id").cast("string").alias("doc_key"))
    return texts.join(marks, "doc_key").select("doc_id", "quality")


@query(
    "rel_05_full_outer_counts",
    """
    with a as (select c_nationkey as k, count(*) as n_customers from customer where c_acctbal > 9000 group by 1),
         b as (select s_nationkey as k, count(*) as n_suppliers from supplier where s_acctbal > 5000 group by 1)
    select coalesce(a.k, b.k) as nationkey, n_customers, n_suppliers from a full join b on a.k = b.k
    """,
)
def rel_05(t):
    a = t.customer.where("c_acctbal > 9000").groupBy(F.col("c_nationkey").alias("nationkey"))
    b = t.supplier.where("s_acctbal > 5000").groupBy(F.col("s_nationkey").alias("nationkey"))
    return a.agg(F.count(F.lit(1)).alias("n_customers")).join(
        b.agg(F.count(F.lit(1)).alias("n_suppliers")), "nationkey", "full"
    )


@query(
    "rel_06_anti_join",
    "select c_custkey, c_name from customer where not exists (select 1 from orders where o_custkey = c_custkey and o_totalprice > 400000)",
)
def rel_06(t):
    large = t.orders.where("o_totalprice > 400000")
    return t.customer.join(large, F.col("c_custkey") == F.col("o_custkey"), "left_anti").select("c_custkey", "c_name")


@query(
    "rel_07_semi_join",
    "select o_orderkey, o_totalprice from orders join (select distinct l_orderkey from lineitem where l_discount >= 0.09) on o_orderkey = l_orderkey",
)
def rel_07(t):
    cheap = t.lineitem.where("l_discount >= 0.09")
    return t.orders.join(cheap, F.col("o_orderkey") == F.col("l_orderkey"), "left_semi").select("o_orderkey", "o_totalprice")


# A comma list per customer: own nation, a blank, a repeated nation, and an id nobody has.
_LIST_SQL = (
    "case when c_mktsegment = 'MACHINERY' then '' when c_mktsegment = 'BUILDING' then '777, 888' else "
    "concat_ws(',', c_nationkey::varchar, ' ' || ((c_custkey * 7) % 25)::varchar || ' ', '', c_nationkey::varchar, '999') end"
)


def _id_list():
    own = F.col("c_nationkey").cast("string")
    other = F.concat(F.lit(" "), ((F.col("c_custkey") * 7) % 25).cast("string"), F.lit(" "))
    filled = F.concat_ws(",", own, other, F.lit(""), own, F.lit("999"))
    return (
        F.when(F.col("c_mktsegment") == "MACHINERY", "")
        .when(F.col("c_mktsegment") == "BUILDING", "777, 888")
        .otherwise(filled)
    )


_LIST_ORACLE = f"""
    with rows as (select c_custkey, {_LIST_SQL} as ids from customer),
    items as (select c_custkey, trim(u.item) as item, u.place from rows, unnest(string_split(ids, ',')) with ordinality as u(item, place))
    select r.c_custkey, r.ids, n.names from rows r left join (
        select c_custkey, string_agg(n_name, ', ' order by place) as names from items join nation on item = n_nationkey::varchar group by 1
    ) n on r.c_custkey = n.c_custkey
"""


@query(
    "rel_08_lateral_list_lookup",
    """
    with rows as (select o_orderkey, case when o_orderstatus = 'P' then null
                         else concat_ws(',', (o_custkey % 30)::varchar, ' ' || month(o_orderdate)::varchar, '', o_orderpriority) end as ids from orders)
    select o_orderkey, ids, (select string_agg(n_name, ', ' order by place)
        from unnest(string_split(ids, ',')) with ordinality as u(item, place) join nation on trim(item) = n_nationkey::varchar) as names
    from rows
    """,
)
def rel_08(t):
    """A correlated lookup per row becomes a lookup per distinct cell."""
    month = F.concat(F.lit(" "), F.month("o_orderdate").cast("string"))
    cell = F.concat_ws(",", (F.col("o_custkey") % 30).cast("string"), month, F.lit(""), F.col("o_orderpriority"))
    rows = t.orders.select("o_orderkey", F.when(F.col("o_orderstatus") != "P", cell).alias("ids"))
    return list_to_names(rows, "ids", t.nation, "n_nationkey", "n_name", "names")


@query(
    "rel_09_group_having",
    """
    select o_custkey, count(*) as n_orders, count(distinct o_orderpriority) as n_priorities, min(o_orderdate) as first_order,
           max(o_orderdate) as last_order, cast(sum(o_totalprice::decimal(18,2)) as double) as total,
           cast(sum(o_totalprice::decimal(18,2)) as double) / count(*) as mean
    from orders group by 1 having count(*) > 8
    """,
)
def rel_09(t):
    price = F.col("o_totalprice").cast("decimal(18,2)")
    total, n = F.sum(price).cast("double"), F.count(F.lit(1))
    grouped = t.orders.groupBy("o_custkey").agg(
        n.alias("n_orders"),
        F.count_distinct("o_orderpriority").alias("n_priorities"),
        F.min("o_orderdate").alias("first_order"),
        F.max("o_orderdate").alias("last_order"),
        total.alias("total"),
        (total / n).alias("mean"),
    )
    return grouped.where("n_orders > 8")


@query("rel_10_distinct", "select distinct l_returnflag, l_linestatus, l_suppkey from lineitem")
def rel_10(t):
    return t.lineitem.select("l_returnflag", "l_linestatus", "l_suppkey").distinct()


@query("rel_11_group_as_distinct", "select p_brand, p_type from part where nullif(trim(p_brand), '') is not null group by p_brand, p_type")
def rel_11(t):
    return t.part.where(F.trim("p_brand") != "").dropDuplicates(["p_brand", "p_type"]).select("p_brand", "p_type")


@query(
    "rel_12_distinct_on_priority",
    """
    select o_custkey, o_orderkey, o_orderpriority, o_orderdate from (
        select *, row_number() over (partition by o_custkey order by case when o_orderpriority like '1%' then 0 else 1 end,
                                     o_orderdate, o_orderkey) as n from orders) where n = 1
    """,
)
def rel_12(t):
    urgent_first = F.when(F.col("o_orderpriority").like("1%"), 0).otherwise(1)
    return deduplicate(t.orders, ["o_custkey"], [urgent_first, "o_orderdate", "o_orderkey"]).select(
        "o_custkey", "o_orderkey", "o_orderpriority", "o_orderdate"
    )


@query(
    "rel_13_windows",
    """
    select o_orderkey, o_custkey, row_number() over w as order_no, count(*) over (partition by o_custkey) as n_orders,
           lag(o_orderdate) over w as previous_date, lead(o_totalprice) over w as next_price
    from orders window w as (partition by o_custkey order by o_orderdate, o_orderkey)
    """,
)
def rel_13(t):
    rows = in_order(
        t.orders,
        ["o_custkey"],
        ["o_orderdate", "o_orderkey"],
        number="order_no",
        before={"previous_date": F.col("o_orderdate")},
        after={"next_price": F.col("o_totalprice")},
        total="n_orders",
        ties=False,
    )
    return rows.select("o_orderkey", "o_custkey", "order_no", "n_orders", "previous_date", "next_price")


@query(
    "rel_14_mutual_best",
    """
    with pairs as (select distinct l_partkey, l_suppkey from lineitem),
    ranked as (select *, row_number() over (partition by l_partkey order by l_suppkey) as a,
                      row_number() over (partition by l_suppkey order by l_partkey) as b from pairs)
    select l_partkey, l_suppkey from ranked where a = 1 and b = 1
    """,
)
def rel_14(t):
    return mutual_best(t.lineitem, "l_partkey", "l_suppkey")


_MONTHS = range(1, 13)


@query(
    "rel_15_union_all_unroll",
    " union all ".join(
        f"select c_custkey, {m} as month_no, (select count(*) from orders where o_custkey = c_custkey and month(o_orderdate) = {m}) as n_orders from customer"
        for m in _MONTHS
    ),
)
def rel_15(t):
    month = F.month("o_orderdate")
    wide = t.orders.groupBy("o_custkey").agg(*[F.count_if(month == m).alias(str(m)) for m in _MONTHS])
    joined = t.customer.select("c_custkey").join(wide, F.col("c_custkey") == F.col("o_custkey"), "left").drop("o_custkey")
    long = unpivot(joined.na.fill(0), keep=["c_custkey"], cast_to="bigint", field_name="month_no", value_name="n_orders")
    return long.withColumn("month_no", F.col("month_no").cast("int"))


@query(
    "rel_16_except_both_ways",
    """
    (select 'only_customer' as side, k from (select distinct c_nationkey as k from customer where c_acctbal > 9500
       except select s_nationkey from supplier where s_acctbal > 6000))
    union all
    (select 'only_supplier', k from (select distinct s_nationkey as k from supplier where s_acctbal > 6000
       except select c_nationkey from customer where c_acctbal > 9500))
    """,
)
def rel_16(t):
    a = t.customer.where("c_acctbal > 9500").select(F.col("c_nationkey").alias("k"))
    b = t.supplier.where("s_acctbal > 6000").select(F.col("s_nationkey").alias("k"))
    side = F.when(F.col("which_diff") == "a_minus_b", "only_customer").otherwise("only_supplier")
    return checks.equality(a, b).select(side.alias("side"), "k")


@query(
    "rel_17_order_limit",
    "select o_orderkey, o_totalprice, o_orderdate from orders order by o_orderdate desc, o_totalprice desc, o_orderkey limit 20",
)
def rel_17(t):
    newest = t.orders.orderBy(F.desc("o_orderdate"), F.desc("o_totalprice"), "o_orderkey").limit(20)
    return newest.select("o_orderkey", "o_totalprice", "o_orderdate")


@query(
    "rel_18_clock_comparison",
    "select o_orderkey, o_orderdate from orders where cast(o_orderdate as date) < date '2001-08-01' - 30 and o_orderdate >= date '2001-08-01' - interval 90 day",
)
def rel_18(t):
    as_of = F.lit("2001-08-01").cast("date")
    day = F.col("o_orderdate")
    return t.orders.where(
        (day < F.date_sub(as_of, 30).cast("timestamp_ntz")) & (day >= F.date_sub(as_of, 90).cast("timestamp_ntz"))
    ).select("o_orderkey", "o_orderdate")


@query("pat_08_list_to_names", _LIST_ORACLE)
def pat_08(t):
    """Distinct cells are split and looked up once, then joined back."""
    rows = t.customer.select("c_custkey", _id_list().alias("ids"))
    return list_to_names(rows, "ids", t.nation, "n_nationkey", "n_name", "names")
