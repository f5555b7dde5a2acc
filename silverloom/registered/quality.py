"""Data-quality checks on the driver tables, with rules some rows break."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from ..quality import checks, suite
from .base import query


@query("dq_01_unique", "select l_orderkey, count(*) as n_records from lineitem where l_orderkey is not null group by 1 having count(*) > 1")
def dq_01(t):
    return checks.unique(t.lineitem, "l_orderkey")


@query(
    "dq_02_not_null",
    "select page_id, nullif(split_part(url, '?', 2), '') as query_text from pages where nullif(split_part(url, '?', 2), '') is null",
)
def dq_02(t):
    text = F.nullif(F.split_part("url", F.lit("?"), F.lit(2)), F.lit(""))
    return checks.not_null(t.pages.select("page_id", text.alias("query_text")), "query_text")


@query(
    "dq_03_accepted_values",
    "select o_orderstatus as value_field, count(*) as n_records from orders where o_orderstatus not in ('F', 'O') group by 1",
)
def dq_03(t):
    return checks.accepted_values(t.orders, "o_orderstatus", ["F", "O"])


@query("dq_04_relationships", "select doc_id as id from documents where doc_id not in (select doc_id from labels)")
def dq_04(t):
    return checks.relationships(t.documents, "doc_id", t.labels, "doc_id")


@query(
    "dq_05_relationships_where",
    """
    select l_partkey as id from lineitem where l_returnflag = 'R'
       and not exists (select 1 from part where p_partkey = l_partkey and p_size > 5)
    """,
)
def dq_05(t):
    return checks.relationships(t.lineitem, "l_partkey", t.part, "p_partkey", "l_returnflag = 'R'", "p_size > 5")


@query(
    "dq_06_accepted_range",
    "select l_orderkey, l_linenumber, l_partkey, l_discount from lineitem where l_discount < 0.01 or l_discount > 0.09",
)
def dq_06(t):
    rows = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_discount")
    return checks.accepted_range(rows, "l_discount", 0.01, 0.09)


@query(
    "dq_06_accepted_range_exclusive",
    """
    select l_orderkey, l_linenumber, l_partkey, qty from (
        select *, case when l_returnflag <> 'A' then l_quantity end as qty from lineitem) where qty <= 1 or qty >= l_partkey
    """,
)
def dq_06_exclusive(t):
    qty = F.when(F.col("l_returnflag") != "A", F.col("l_quantity"))
    rows = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", qty.alias("qty"))
    return checks.accepted_range(rows, "qty", 1, F.col("l_partkey"), inclusive=False)


@query(
    "dq_07_at_least_one",
    """
    select o_custkey, count(case when o_totalprice > 400000 then 1 end) as filled from orders group by 1
    having count(case when o_totalprice > 400000 then 1 end) = 0
    """,
)
def dq_07(t):
    rows = t.orders.select("o_custkey", F.when(F.col("o_totalprice") > 400000, F.col("o_orderkey")).alias("large"))
    return checks.at_least_one(rows, "large", group_by=["o_custkey"])


@query(
    "dq_07_at_least_one_table",
    "select count(case when o_totalprice > 1e12 then 1 end) as filled from orders",
)
def dq_07_table(t):
    rows = t.orders.select(F.when(F.col("o_totalprice") > 1e12, F.col("o_orderkey")).alias("large"))
    return checks.at_least_one(rows, "large")


@query(
    "dq_08_cardinality_equality",
    """
    with a as (select l_suppkey as k, count(*) as num_rows from lineitem where l_returnflag = 'R' group by 1),
         b as (select l_suppkey as k, count(*) as num_rows from lineitem where l_returnflag = 'A' group by 1)
    select k as l_suppkey, num_rows from (select * from a except select * from b)
    union all select k, num_rows from (select * from b except select * from a)
    """,
)
def dq_08(t):
    lines = t.lineitem
    return checks.cardinality_equality(
        lines.where("l_returnflag = 'R'"), "l_suppkey", lines.where("l_returnflag = 'A'"), "l_suppkey"
    )


@query(
    "dq_09_equal_rowcount",
    """
    with a as (select c_nationkey, count(*) as count_a from customer where c_acctbal > 9000 group by 1),
         b as (select s_nationkey, count(*) as count_b from supplier group by 1)
    select c_nationkey as nationkey_a, s_nationkey as nationkey_b, count_a, count_b, abs(count_a - count_b) as diff_count
    from a full join b on c_nationkey = s_nationkey
    """,
)
def dq_09(t):
    a = t.customer.where("c_acctbal > 9000").withColumnRenamed("c_nationkey", "nationkey")
    return checks.equal_rowcount(a, t.supplier.withColumnRenamed("s_nationkey", "nationkey"), ["nationkey"])


@query(
    "dq_09_equal_rowcount_table",
    """
    select (select count(*) from orders) as count_a, (select count(*) from customer) as count_b,
           (select count(*) from orders) - (select count(*) from customer) as diff_count
    """,
)
def dq_09_table(t):
    return checks.equal_rowcount(t.orders, t.customer)


_EDITED = "select n_nationkey, n_name, case when n_regionkey = 3 then n_nationkey else n_regionkey end as n_regionkey from nation"


@query(
    "dq_10_equality",
    f"""
    select 'a_minus_b' as which_diff, * from (select * from nation except ({_EDITED}))
    union all select 'b_minus_a', * from (({_EDITED}) except select * from nation)
    """,
)
def dq_10(t):
    region = F.when(F.col("n_regionkey") == 3, F.col("n_nationkey")).otherwise(F.col("n_regionkey"))
    return checks.equality(t.nation, t.nation.withColumn("n_regionkey", region))


@query(
    "dq_10_equality_precision",
    """
    with a as (select l_partkey, cast(l_discount * 100 as bigint) as pct from lineitem where l_returnflag = 'R'),
         b as (select l_partkey, cast(l_discount * 100 as bigint) as pct from lineitem where l_returnflag = 'N')
    select 'a_minus_b' as which_diff, l_partkey, pct from (select l_partkey, pct from a except select l_partkey, pct from b)
    union all select 'b_minus_a', l_partkey, pct from (select l_partkey, pct from b except select l_partkey, pct from a)
    """,
)
def dq_10_precision(t):
    """0.05 and 0.05 + 1e-7 are equal at precision 2."""
    noise = F.when(F.col("l_returnflag") == "R", F.lit(1e-7)).otherwise(F.lit(0.0))
    rows = t.lineitem.withColumn("l_discount", F.col("l_discount") + noise)
    found = checks.equality(
        rows.where("l_returnflag = 'R'"), rows.where("l_returnflag = 'N'"), ["l_partkey", "L_DISCOUNT"], precision=2
    )
    return found.select("which_diff", "l_partkey", (F.col("l_discount") * 100).cast("bigint").alias("pct"))


@query(
    "dq_11_expression_is_true",
    "select o_orderkey, o_totalprice from orders where not (o_totalprice / 1000 < 400 or o_orderstatus = 'F')",
)
def dq_11(t):
    rows = checks.expression_is_true(t.orders, "o_totalprice / 1000 < 400 or o_orderstatus = 'F'")
    return rows.select("o_orderkey", "o_totalprice")


@query("dq_11_column_expression_is_true", "select p_partkey, p_size from part where not p_size <= 45")
def dq_11_column(t):
    return checks.expression_is_true(t.part.select("p_partkey", "p_size"), "<= 45", column="p_size")


@query(
    "dq_12_fewer_rows_than",
    """
    with a as (select s_nationkey, count(*) as n from supplier group by 1),
         b as (select c_nationkey, count(*) as m from customer where c_acctbal > 9000 group by 1)
    select s_nationkey as nationkey_a, c_nationkey as nationkey_b, n as count_our_model, m as count_comparison_model,
           cast(case when n > m then n - m when n = m then 1 else 0 end as bigint) as row_count_delta
    from a full join b on s_nationkey = c_nationkey
    """,
)
def dq_12(t):
    ours = t.supplier.withColumnRenamed("s_nationkey", "nationkey")
    other = t.customer.where("c_acctbal > 9000").withColumnRenamed("c_nationkey", "nationkey")
    return checks.fewer_rows_than(ours, other, ["nationkey"])


_RANGES_SQL = "select o_custkey, o_orderdate as valid_from, o_orderdate + (cast(o_totalprice as bigint) % 90) * interval 1 day as valid_to from orders"


def _ranges(t):
    """One validity range per order: from its date for some days."""
    days = F.make_dt_interval(F.col("o_totalprice").cast("bigint").cast("int") % 90)
    return t.orders.select("o_custkey", F.col("o_orderdate").alias("valid_from"), (F.col("o_orderdate") + days).alias("valid_to"))


def _ranges_oracle(operator: str, words: str, length: str, length_words: str, group: bool) -> str:
    partition = "partition by o_custkey" if group else ""
    column = "o_custkey as partition_by_col, " if group else ""
    return f"""
    with r as ({_RANGES_SQL.replace("cast(o_totalprice as bigint)", "cast(trunc(o_totalprice) as bigint)")}),
    n as (select {column}valid_from as lower_bound, valid_to as upper_bound,
                 lead(valid_from) over (w) as next_lower_bound, lead(1) over (w) is null as is_last_record
          from r window w as ({partition} order by valid_from, valid_to)),
    j as (select *, coalesce(lower_bound {length} upper_bound, false) as lower_bound_{length_words}_upper_bound,
                 coalesce(upper_bound {operator} next_lower_bound, is_last_record, false) as upper_bound_{words}_next_lower_bound from n)
    select * from j where not (lower_bound_{length_words}_upper_bound and upper_bound_{words}_next_lower_bound)
    """


@query("dq_13_exclusive_ranges", _ranges_oracle("<=", "less_than_or_equal_to", "<", "less_than", True))
def dq_13(t):
    return checks.mutually_exclusive_ranges(_ranges(t), "valid_from", "valid_to", "o_custkey")


@query("dq_13_exclusive_ranges_no_gaps", _ranges_oracle("=", "equal_to", "<=", "less_than_or_equal_to", True))
def dq_13_no_gaps(t):
    return checks.mutually_exclusive_ranges(
        _ranges(t), "valid_from", "valid_to", "o_custkey", gaps="not_allowed", zero_length_range_allowed=True
    )


@query("dq_13_exclusive_ranges_global", _ranges_oracle("<", "less_than", "<", "less_than", False))
def dq_13_global(t):
    return checks.mutually_exclusive_ranges(_ranges(t), "valid_from", "valid_to", gaps="required")


@query("dq_14_not_accepted_values", "select distinct p_type as value_field from part where p_type in ('SMALL', 'ECONOMY', 'NONE')")
def dq_14(t):
    return checks.not_accepted_values(t.part, "p_type", ["SMALL", "ECONOMY", "NONE"])


@query(
    "dq_15_not_constant",
    "select o_custkey, count(distinct o_orderstatus) as filler_column from orders group by 1 having count(distinct o_orderstatus) = 1",
)
def dq_15(t):
    return checks.not_constant(t.orders, "o_orderstatus", ["o_custkey"])


@query("dq_16_not_empty_string", "select trim(' ' || split_part(url, '#', 2)) as anchor from pages where trim(split_part(url, '#', 2)) = ''")
def dq_16(t):
    anchor = F.concat(F.lit(" "), F.split_part("url", F.lit("#"), F.lit(2)))
    return checks.not_empty_string(t.pages.select(anchor.alias("anchor")), "anchor")


@query(
    "dq_17_not_null_proportion",
    """
    select o_custkey, not_null_proportion from (
        select o_custkey, cast(count(case when o_orderstatus <> 'P' then 1 end) as double) / count(*) as not_null_proportion from orders group by 1)
    where not_null_proportion < 0.5 or not_null_proportion > 0.9
    """,
)
def dq_17(t):
    state = F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus"))
    return checks.not_null_proportion(t.orders.select("o_custkey", state.alias("state")), "state", 0.5, 0.9, ["o_custkey"])


@query(
    "dq_18_recency",
    """
    select user_id, max(ts) as most_recent, timestamp '2024-01-30 18:00:00' as threshold from events group by 1
    having max(ts) < timestamp '2024-01-30 18:00:00' or max(ts) is null
    """,
)
def dq_18(t):
    return checks.recency(t.events, "ts", "hour", 6, dt.datetime(2024, 1, 31), group_by=["user_id"])


@query(
    "dq_18_recency_dates",
    """
    select user_id, event_type, cast(max(ts) as date) as most_recent, date '2024-01-28' as threshold from events group by 1, 2
    having cast(max(ts) as date) < date '2024-01-28'
    """,
)
def dq_18_dates(t):
    as_of = dt.datetime(2024, 1, 31, 12)
    return checks.recency(t.events, "ts", "day", 3, as_of, ignore_time=True, group_by=["user_id", "event_type"])


@query(
    "dq_19_sequential_values",
    """
    select o_orderkey, previous_o_orderkey from (
        select o_orderkey, lag(o_orderkey) over (order by o_orderkey) as previous_o_orderkey from orders where o_totalprice > 20000)
    where o_orderkey <> previous_o_orderkey + 1
    """,
)
def dq_19(t):
    return checks.sequential_values(t.orders.where("o_totalprice > 20000"), "o_orderkey")


@query(
    "dq_19_sequential_dates",
    """
    select o_custkey, o_orderdate, previous_o_orderdate from (
        select o_custkey, o_orderdate, lag(o_orderdate) over (partition by o_custkey order by o_orderdate) as previous_o_orderdate from orders)
    where o_orderdate <> previous_o_orderdate + interval 1 day
    """,
)
def dq_19_dates(t):
    return checks.sequential_values(t.orders, "o_orderdate", 1, "day", ["o_custkey"])


@query(
    "dq_20_unique_combination",
    "select l_orderkey, l_linenumber from lineitem group by all having count(*) > 1",
)
def dq_20(t):
    return checks.unique_combination_of_columns(t.lineitem, ["l_orderkey", "l_linenumber"])


@query(
    "dq_21_columns_match_set",
    """
    with wanted(c) as (values ('O_ORDERKEY'), ('O_CUSTKEY'), ('O_TOTALPRICE'), ('O_CLERK')),
    found(relation, c) as (select 'orders', upper(column_name) from (describe orders)
                           union all select 'customer', upper(column_name) from (describe customer))
    select relation, c as relation_column, cast(null as varchar) as input_column,
           case relation when 'orders' then (select count(*) from orders) else (select count(*) from customer) end as n_rows
    from found where c not in (select c from wanted)
    union all
    select r.relation, null, w.c, case r.relation when 'orders' then (select count(*) from orders) else (select count(*) from customer) end
    from (values ('orders'), ('customer')) r(relation), wanted w
    where not exists (select 1 from found f where f.relation = r.relation and f.c = w.c)
    """,
)
def dq_21(t):
    wanted = ["o_orderkey", "o_custkey", "o_totalprice", "o_clerk"]
    return checks.columns_match_set({"orders": t.orders, "customer": t.customer}, wanted)


@query(
    "dq_22_assert_equal",
    "select o_orderkey, year(o_orderdate)::integer as actual, 1998 as expected from orders where year(o_orderdate) <> 1998 and o_orderstatus <> 'P'",
)
def dq_22(t):
    expected = F.when(F.col("o_orderstatus") != "P", F.lit(1998))
    rows = t.orders.select("o_orderkey", F.year("o_orderdate").alias("actual"), expected.alias("expected"))
    return checks.assert_equal(rows, "actual", "expected")


@query(
    "dq_23_suite",
    """
    with counts as (
        select 'not_null_state' as check_name, count(*) filter (o_orderstatus = 'P') as failures from orders
        union all select 'accepted_range_o_totalprice', count(*) filter (o_totalprice < 1000 or o_totalprice > 499000) from orders
        union all select 'price_is_positive', count(*) filter (not o_totalprice > 0 and o_orderstatus = 'F') from orders
        union all select 'not_empty_string_o_orderpriority', count(*) filter (trim(o_orderpriority) = '') from orders
        union all select 'unique_o_custkey', (select count(*) from (select o_custkey from orders group by 1 having count(*) > 1))
        union all select 'same_as_customers', (select cast(n + abs(a - b) as bigint) from (
            select count(*) as n, count(*) filter (side = 1) as a, count(*) filter (side = 2) as b from (
                select 1 as side, o_custkey from (select o_custkey from orders except select c_custkey from customer)
                union all select 2, c_custkey from (select c_custkey from customer except select o_custkey from orders)))))
    select check_name, failures, case
        when check_name = 'not_null_state' then case when failures > 0 then 'warn' else 'pass' end
        when check_name = 'accepted_range_o_totalprice' then case when failures > 1000000 then 'error' when failures > 0 then 'warn' else 'pass' end
        else case when failures <> 0 then 'error' else 'pass' end end as status
    from counts
    """,
)
def dq_23(t):
    rows = t.orders.withColumn("state", F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus")))
    customers = t.customer.select(F.col("c_custkey").alias("o_custkey"))
    return suite.run_suite(
        rows,
        [
            suite.not_null("state", severity="warn"),
            suite.in_range("o_totalprice", 1000, 499000, error_if="failures > 1000000"),
            suite.is_true("price_is_positive", "o_totalprice > 0", where="o_orderstatus = 'F'"),
            suite.filled_text("o_orderpriority"),
            suite.Check("unique_o_custkey", rows=lambda df: checks.unique(df, "o_custkey")),
            suite.Check(
                "same_as_customers",
                rows=lambda df: checks.equality(df.select("o_custkey"), customers),
                fail_calc=suite.failures_of_equality(),
            ),
        ],
    )
