"""Scalar helpers on the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import dates, geo, safe, text, url
from ..functions.keys import NULL_MARK, surrogate_key
from .base import query


def money(c: str):
    return F.col(c).cast("decimal(18,2)")


@query(
    "scl_01_surrogate_key",
    f"""
    select l_orderkey, l_linenumber,
           md5(concat_ws('-', cast(l_orderkey as varchar), cast(l_linenumber as varchar), l_returnflag)) as line_key,
           md5(concat_ws('-', coalesce(case when l_returnflag <> 'A' then l_linestatus end, '{NULL_MARK}'), l_suppkey::varchar)) as null_key,
           md5(concat_ws('-', coalesce(case when l_returnflag <> 'A' then l_linestatus end, ''), l_suppkey::varchar)) as empty_key
    from lineitem
    """,
)
def scl_01(t):
    maybe = F.when(F.col("l_returnflag") != "A", F.col("l_linestatus"))
    return t.lineitem.select(
        "l_orderkey",
        "l_linenumber",
        surrogate_key("l_orderkey", "l_linenumber", "l_returnflag").alias("line_key"),
        surrogate_key(maybe, "l_suppkey").alias("null_key"),
        surrogate_key(maybe, "l_suppkey", nulls_as_empty=True).alias("empty_key"),
    )


@query(
    "scl_02_safe_add",
    """
    select p_partkey, coalesce(case when p_type = 'ECONOMY' then p_size end, 0) + p_size + 5 as total from part
    """,
)
def scl_02(t):
    maybe = F.when(F.col("p_type") == "ECONOMY", F.col("p_size"))
    return t.part.select("p_partkey", safe.safe_add(maybe, "p_size", F.lit(5)).alias("total"))


@query(
    "scl_03_safe_subtract",
    """
    select p_partkey, p_size - coalesce(case when p_type = 'ECONOMY' then p_size end, 0) - 5 as rest from part
    """,
)
def scl_03(t):
    maybe = F.when(F.col("p_type") == "ECONOMY", F.col("p_size"))
    return t.part.select("p_partkey", safe.safe_subtract("p_size", maybe, F.lit(5)).alias("rest"))


@query(
    "scl_04_safe_divide",
    """
    select l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice / nullif(l_discount, 0) as ratio
    from lineitem
    """,
)
def scl_04(t):
    ratio = safe.safe_divide("l_extendedprice", "l_discount")
    return t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", ratio.alias("ratio"))


@query(
    "scl_05_width_bucket",
    """
    select l_orderkey, l_linenumber, l_partkey, l_suppkey,
           cast(case when cast(l_quantity as decimal(28,6)) % cast(8 as decimal(28,6)) = 0 then 1 else 0 end
                + least(ceil((l_quantity - 8) / 8.0::double), 6) as bigint) as bucket,
           cast(case when l_quantity < 8 then 0 when l_quantity >= 48 then 6
                     else floor((l_quantity - 8) / 8.0::double) + 1 end as bigint) as native_bucket
    from lineitem
    """,
)
def scl_05(t):
    return t.lineitem.select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        "l_suppkey",
        safe.width_bucket("l_quantity", 8, 48, 5).cast("bigint").alias("bucket"),
        safe.width_bucket("l_quantity", 8, 48, 5, native=True).cast("bigint").alias("native_bucket"),
    )


_HAVERSINE = (
    "2 * 3961 * asin(sqrt(power(sin(radians((lat2 - lat1) / 2)), 2) + cos(radians(lat1)) * cos(radians(lat2)) "
    "* power(sin(radians((lon2 - lon1) / 2)), 2)))"
)


@query(
    "scl_06_haversine",
    f"""
    with places as (
        select c_custkey, (c_custkey % 170) - 85.0::double as lat1, (c_custkey % 350) - 175.0::double as lon1,
               c_nationkey * 3.0::double - 36 as lat2, c_nationkey * 7.0::double - 84 as lon2 from customer)
    select c_custkey, round({_HAVERSINE}, 4) as miles, round({_HAVERSINE} * 1.60934::double, 4) as km from places
    """,
)
def scl_06(t):
    places = t.customer.select(
        "c_custkey",
        ((F.col("c_custkey") % 170) - F.lit(85.0)).alias("lat1"),
        ((F.col("c_custkey") % 350) - F.lit(175.0)).alias("lon1"),
        (F.col("c_nationkey") * F.lit(3.0) - 36).alias("lat2"),
        (F.col("c_nationkey") * F.lit(7.0) - 84).alias("lon2"),
    )
    ends = ("lat1", "lon1", "lat2", "lon2")
    return places.select(
        "c_custkey",
        F.round(geo.haversine(*ends), 4).alias("miles"),
        F.round(geo.haversine(*ends, unit="km"), 4).alias("km"),
    )


@query(
    "scl_07_url_host",
    "select page_id, split_part(split_part(regexp_replace(url, '(android-app|https?)://', '', 'g'), '/', 1), '?', 1) as host from pages",
)
def scl_07(t):
    return t.pages.select("page_id", url.url_host("url").alias("host"))


@query(
    "scl_08_url_path",
    """
    with bare as (select page_id, regexp_replace(url, 'https?://', '', 'g') as u from pages)
    select page_id, split_part(case when position('/' in u) > 0 then u[position('/' in u) + 1:]
                                    when position('?' in u) > 0 then u[position('?' in u):] else u end, '?', 1) as path
    from bare
    """,
)
def scl_08(t):
    return t.pages.select("page_id", url.url_path("url").alias("path"))


@query(
    "scl_09_url_parameter",
    """
    select page_id, nullif(split_part(split_part(url, 'page=', 2), '&', 1), '') as page_no,
           nullif(split_part(split_part(url, 'ref=', 2), '&', 1), '') as ref
    from pages
    """,
)
def scl_09(t):
    return t.pages.select(
        "page_id", url.url_parameter("url", "page").alias("page_no"), url.url_parameter("url", "ref").alias("ref")
    )


@query(
    "scl_10_slugify",
    """
    with named as (select p_partkey, p_size::varchar || ' ' || p_name || ' - ' || p_brand || '!' as full_name from part)
    select p_partkey, '_' || regexp_replace(regexp_replace(lower(full_name), '[ -]+', '_', 'g'), '[^a-z0-9_]+', '', 'g') as slug
    from named
    """,
)
def scl_10(t):
    full = F.concat(F.col("p_size").cast("string"), F.lit(" "), "p_name", F.lit(" - "), "p_brand", F.lit("!"))
    return t.part.select("p_partkey", text.slug(full).alias("slug"))


@query(
    "scl_11_blank_to_null",
    "select page_id, nullif(trim('  ' || split_part(url, '?', 2) || ' '), '') as query_text, nullif(trim(page_id::varchar), '') as page_text from pages",
)
def scl_11(t):
    padded = F.concat(F.lit("  "), F.split_part("url", F.lit("?"), F.lit(2)), F.lit(" "))
    return t.pages.select(
        "page_id", text.blank_to_null(padded).alias("query_text"), text.blank_to_null("page_id").alias("page_text")
    )


@query(
    "scl_12_typed_values",
    """
    select o_orderkey,
           cast(try_cast(case when o_orderstatus = 'F' then ' ' || o_totalprice::decimal(18,2)::varchar || ' ' when o_orderstatus = 'O' then '  ' else 'n/a' end as decimal(18,2)) as double) as amount,
           cast(o_orderdate as date) as day, o_orderdate as moment
    from orders
    """,
)
def scl_12(t):
    amount = F.when(F.col("o_orderstatus") == "F", F.concat(F.lit(" "), money("o_totalprice").cast("string"), F.lit(" ")))
    amount = amount.when(F.col("o_orderstatus") == "O", "  ").otherwise("n/a")
    return t.orders.select(
        "o_orderkey",
        text.typed(amount, "decimal(18,2)").cast("double").alias("amount"),
        text.typed(F.date_format("o_orderdate", "yyyy-MM-dd"), "date", strict=True).alias("day"),
        text.typed("o_orderdate", "timestamp_ntz").alias("moment"),
    )


@query("scl_13_grouped_number", "select o_orderkey, cast(o_totalprice::decimal(18,2) as double) as price from orders")
def scl_13(t):
    shown = F.format_number("o_totalprice", 2)  # 112,946.26
    return t.orders.select("o_orderkey", text.grouped_number(shown, "decimal(18,2)").cast("double").alias("price"))


@query(
    "scl_14_digits_only",
    """
    select p_partkey, cast(nullif(regexp_replace(p_brand, '[^0-9]', '', 'g'), '') as bigint) as brand_no,
           cast(nullif(regexp_replace(p_name, '[^0-9]', '', 'g'), '') as bigint) as name_no from part
    """,
)
def scl_14(t):
    return t.part.select(
        "p_partkey",
        text.digits_number("p_brand").cast("bigint").alias("brand_no"),
        text.digits_number("p_name").cast("bigint").alias("name_no"),
    )


@query(
    "scl_15_capture",
    """
    select doc_id, nullif(regexp_extract(text, '([A-Z][a-z]{9,})', 1), '') as first_long, regexp_matches(text, '[0-9]{4}') as has_number,
           cast(len(regexp_extract_all(text, '([A-Z][a-z]{9,})', 1)) as bigint) as n_long
    from documents
    """,
)
def scl_15(t):
    pattern = "([A-Z][a-z]{9,})"
    return t.documents.select(
        "doc_id",
        text.capture("text", pattern).alias("first_long"),
        F.col("text").rlike("[0-9]{4}").alias("has_number"),
        F.size(text.capture_all("text", pattern)).cast("bigint").alias("n_long"),
    )


@query(
    "scl_16_like_flags",
    """
    select p_partkey, p_name like 'small%' as is_small,
           case when (case when p_type <> 'SMALL' then p_name end) not ilike '%RING' then 0 else 1 end as flag from part
    """,
)
def scl_16(t):
    maybe = F.when(F.col("p_type") != "SMALL", F.col("p_name"))
    return t.part.select(
        "p_partkey", F.col("p_name").like("small%").alias("is_small"), text.prefer_unlike(maybe, "%RING").alias("flag")
    )


@query(
    "scl_17_localised_json",
    "select event_id, coalesce(props ->> '$.vi_VN', props ->> '$.k') as picked from events",
)
def scl_17(t):
    return t.events.select("event_id", text.localised("props", "vi_VN", "k").alias("picked"))


@query(
    "scl_18_json_or_text",
    "select event_id, case when event_type = 'click' then event_type else props ->> '$.k' end as note from events",
)
def scl_18(t):
    mixed = F.when(F.col("event_type") == "click", F.col("event_type")).otherwise(F.col("props"))
    return t.events.select("event_id", text.json_or_text(mixed, "k").alias("note"))


@query(
    "scl_19_dates",
    """
    select o_orderkey, strftime(o_orderdate, '%Y-%m') as month_label, last_day(o_orderdate) as month_end,
           date_diff('day', cast(o_orderdate as date), date '2002-01-01') as age_days
    from orders
    """,
)
def scl_19(t):
    return t.orders.select(
        "o_orderkey",
        dates.month_label("o_orderdate").alias("month_label"),
        dates.month_end(F.year("o_orderdate"), F.month("o_orderdate")).alias("month_end"),
        dates.age_days("o_orderdate", "2002-01-01").cast("bigint").alias("age_days"),
    )


@query(
    "scl_20_prefix_concat",
    "select o_orderkey, 'https://shop.example/order?id=' || (case when o_orderstatus <> 'P' then o_orderkey end)::varchar as link from orders",
)
def scl_20(t):
    known = F.when(F.col("o_orderstatus") != "P", F.col("o_orderkey")).cast("string")
    return t.orders.select("o_orderkey", F.concat(F.lit("https://shop.example/order?id="), known).alias("link"))


@query(
    "scl_21_array_subscript",
    "select l_orderkey, l_linenumber, l_partkey, l_suppkey, [5, 2, 1, 1, 1][l_linenumber] as weight from lineitem",
)
def scl_21(t):
    weights = F.array(*[F.lit(w) for w in (5, 2, 1, 1, 1)])
    return t.lineitem.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.try_element_at(weights, F.col("l_linenumber")).alias("weight")
    )


@query(
    "scl_22_status_class",
    """
    select o_orderkey, case when o_orderstatus = 'F' and o_orderpriority = '5-LOW' then 'late'
                            when o_orderstatus = 'F' then 'done' when o_orderstatus = 'O' then 'open' end as status
    from orders
    """,
)
def scl_22(t):
    done, low = F.col("o_orderstatus") == "F", F.col("o_orderpriority") == "5-LOW"
    status = F.when(done & low, "late").when(done, "done").when(F.col("o_orderstatus") == "O", "open")
    return t.orders.select("o_orderkey", status.alias("status"))
