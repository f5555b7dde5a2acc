import datetime as dt
import re

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from silverloom.operators import business, dedupe, lists, ordered, reshape, series, union


def test_deduplicate_keeps_rows_with_nulls(spark, rows):
    df = spark.createDataFrame([(1, 1, "a"), (1, 2, None), (2, 5, "c"), (None, 1, "d"), (None, 3, "e")], "k int, v int, p string")
    assert rows(dedupe.deduplicate(df, ["k"], [F.desc("v")])) == [(1, 2, None), (2, 5, "c"), (None, 3, "e")]


def test_deduplicate_drops_rows_on_the_map_side(spark):
    df = spark.range(1000).withColumn("k", F.col("id") % 3)
    plan = dedupe.deduplicate(df, ["k"], ["id"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_deduplicate_twice_collapses_missing_second_keys(spark, rows):
    df = spark.createDataFrame([("s1", None, 1), ("s2", None, 2), ("s3", "x", 3), ("s3", "y", 1), ("s4", "y", 0)], "a string, b string, t int")
    assert rows(dedupe.deduplicate_twice(df, ["a"], ["b"], ["t"])) == [("s1", None, 1), ("s4", "y", 0)]
    kept = dedupe.deduplicate_twice(df, ["a"], ["b"], ["t"], keep_null_second=True)
    assert rows(kept) == [("s1", None, 1), ("s2", None, 2), ("s4", "y", 0)]


def test_mutual_best(spark, rows):
    df = spark.createDataFrame([("a", "1"), ("a", "2"), ("b", "1"), ("b", "3"), ("c", "3"), ("c", "3"), (None, "9")], "l string, r string")
    assert rows(dedupe.mutual_best(df, "l", "r")) == [(None, "9"), ("a", "1")] or rows(dedupe.mutual_best(df, "l", "r")) == [
        ("a", "1"),
        (None, "9"),
    ]


def test_unpivot_keeps_nulls_and_words_booleans(spark, rows):
    df = spark.createDataFrame([(1, "x", True, None)], "id int, name string, flag boolean, n int")
    got = reshape.unpivot(df, keep=["ID"], remove=["Name"])
    assert rows(got) == [(1, "flag", "true"), (1, "n", None)]


def test_unpivot_reads_the_table_once(spark):
    df = spark.range(5).select("id", F.lit(1).alias("a"), F.lit(2).alias("b"))
    plan = reshape.unpivot(df, ["id"])._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Range") == 1


def test_pivot(spark, rows):
    df = spark.createDataFrame([("S", "red"), ("S", "blue"), ("S", "red"), ("M", "red"), ("M", "it's")], "size string, color string")
    values = reshape.column_values(df, "color", 10)
    assert values == ["red", "blue", "it's"]
    got = df.groupBy("size").agg(*reshape.pivot_columns("color", values, prefix="n "))
    assert got.columns == ["size", "n red", "n blue", "n it's"]
    assert rows(got) == [("M", 1, 0, 1), ("S", 2, 1, 0)]


def test_column_values(spark):
    df = spark.createDataFrame([("a", 1), ("b", 1), ("b", 0), ("c", 0)], "f string, c int")
    assert reshape.column_values(df, "f", 10) == ["b", "a", "c"]
    assert reshape.column_values(df, "f", 1, where="c = 1", order_by=[F.desc("value")]) == ["b"]
    assert reshape.column_values(df, "f", 10, where="c = 9", default=["z"]) == ["z"]
    df.createOrReplaceTempView("valued")
    assert reshape.table_column_values(spark, "valued", "f", 10, where="c = 1") == ["a", "b"]
    assert reshape.table_column_values(spark, "no_such_table", "f", 10, default=["z"]) == ["z"]
    with pytest.raises(LookupError):
        reshape.table_column_values(spark, "no_such_table", "f", 10)


def test_star(spark):
    df = spark.createDataFrame([(1, 2, 3)], "Field_1 int, field_2 int, field_3 int")
    got = df.alias("t").select(*reshape.star(df, drop=["FIELD_3"], prefix="p_", suffix="_s", rename={"FIELD_2": "two"}, alias="t"))
    assert got.columns == ["p_Field_1_s", "two"]
    assert reshape.star(df, drop=df.columns) == []


def test_blank_strings_to_null(spark, rows):
    df = spark.createDataFrame([("", "", 1), ("a", " ", 2)], "x string, y string, n int")
    assert rows(reshape.blank_strings_to_null(df)) == [("a", " ", 2), (None, None, 1)]
    assert rows(reshape.blank_strings_to_null(df, ["Y"])) == [("", None, 1), ("a", " ", 2)]


def test_single_value(spark):
    assert reshape.single_value(spark.sql("select 5 as a, 6 as b")) == 5
    assert reshape.single_value(spark.sql("select 5 as a").where("a > 9"), default="none") == "none"


def test_union_relations(spark, rows):
    a = spark.createDataFrame([(1, "x", "red")], "id int, name string, favorite_color string")
    b = spark.createDataFrame([(2, "y", 7)], "id int, name string, favorite_number int")
    both = union.union_relations({"a": a, "b": b})
    assert both.columns == ["_source_relation", "id", "name", "favorite_color", "favorite_number"]
    assert rows(both) == [("a", 1, "x", "red", None), ("b", 2, "y", None, 7)]
    some = union.union_relations({"a": a, "b": b}, exclude=["NAME"], where="id > 1", source_column=None, column_override={"id": "string"})
    assert rows(some) == [("2", None, 7)]
    with pytest.raises(ValueError):
        union.union_relations({"a": a}, include=["id"], exclude=["name"])
    with pytest.raises(ValueError):
        union.union_relations({"a": a, "b": b}, include=["nothing"])


def test_tables_by_pattern(spark):
    for name in ("ev_20180101", "ev_20180102", "ev_old", "other"):
        spark.range(1).createOrReplaceTempView(name)
    assert union.tables_by_pattern(spark, "%", "EV_%", exclude="%old") == ["ev_20180101", "ev_20180102"]
    assert union.tables_by_prefix(spark, "%", "ev_2018") == ["ev_20180101", "ev_20180102"]


def test_union_tables_in_one_scan(spark, rows, tmp_path):
    """Tables of one schema are one scan; views, partitioned tables and other schemas keep their branches."""
    names = []
    spark.sql("create database if not exists shards")
    try:
        for i in range(40):
            name = f"shards.part_{i}"
            spark.range(i, i + 3).select("id", F.lit(f"v{i}").alias("v")).coalesce(1).write.saveAsTable(name, path=str(tmp_path / f"t {i}"))
            names.append(name)
        spark.range(2).select("id", F.lit(1.5).alias("price")).write.saveAsTable("shards.priced", path=str(tmp_path / "priced"))
        spark.range(4).select((F.col("id") % 2).alias("day"), F.lit("p").alias("v"), "id").write.partitionBy("day").saveAsTable("shards.daily", path=str(tmp_path / "daily"))
        spark.range(90, 92).withColumn("v", F.lit("view")).createOrReplaceTempView("viewed")
        every = [*names, "shards.priced", "shards.daily", "viewed"]
        got = union.union_tables(spark, every, source_column="shard", where="id >= 0")
        assert got.columns == ["shard", "id", "v", "price", "day"]
        want = [(n, i + k, f"v{i}", None, None) for i, n in enumerate(names) for k in range(3)]
        want += [("shards.priced", k, None, 1.5, None) for k in range(2)] + [("shards.daily", k, "p", None, k % 2) for k in range(4)]
        want += [("viewed", 90 + k, "view", None, None) for k in range(2)]
        assert rows(got) == sorted(want, key=repr)
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert plan.split("Initial Plan")[-1].count("FileScan") == 3
        assert rows(union.union_tables(spark, names[:2], source_column=None, exclude=["v"])) == sorted((i + k,) for i in range(2) for k in range(3))
    finally:
        spark.sql("drop database shards cascade")


def test_series(spark, rows):
    assert [r[0] for r in series.number_series(spark, 10).collect()] == list(range(1, 11))
    with pytest.raises(ValueError):
        series.number_series(spark, 0)
    days = [r[0] for r in series.date_spine(spark, "day", dt.date(2018, 1, 1), dt.date(2018, 1, 10)).collect()]
    assert days == [dt.date(2018, 1, d) for d in range(1, 10)]
    months = [r[0] for r in series.date_spine(spark, "month", dt.date(2020, 1, 31), dt.date(2020, 4, 1)).collect()]
    assert months == [dt.date(2020, 1, 31), dt.date(2020, 2, 29), dt.date(2020, 3, 31)]
    hours = series.date_spine(spark, "hour", dt.datetime(2020, 1, 1, 22, 30), dt.datetime(2020, 1, 2, 1)).collect()
    assert [r[0] for r in hours] == [dt.datetime(2020, 1, 1, 22, 30), dt.datetime(2020, 1, 1, 23, 30), dt.datetime(2020, 1, 2, 0, 30)]
    with pytest.raises(ValueError):
        series.date_spine(spark, "day", dt.date(2020, 1, 1), dt.date(2020, 1, 1))


@pytest.mark.parametrize(
    "part, start, end, n",
    [
        ("week", dt.date(2024, 1, 6), dt.date(2024, 1, 7), 1),  # Saturday to Sunday
        ("week", dt.date(2024, 1, 7), dt.date(2024, 1, 13), 0),
        ("quarter", dt.date(2023, 12, 31), dt.date(2024, 1, 1), 1),
        ("year", dt.date(2023, 12, 31), dt.date(2024, 1, 1), 1),
        ("minute", dt.datetime(2024, 1, 1, 23, 59), dt.datetime(2024, 1, 2, 0, 1), 2),
    ],
)
def test_periods_between(part, start, end, n):
    assert series.periods_between(start, end, part) == n


def _skewed(spark):
    """One key holds most rows; nulls in key and order; ties."""
    data = [("hot", i % 40, i) for i in range(120)] + [(f"k{i % 5}", i % 3, 1000 + i) for i in range(20)]
    data += [(None, i, 2000 + i) for i in range(12)] + [("hot", None, 3000 + i) for i in range(3)]
    return spark.createDataFrame(data, "k string, v int, id int").repartition(5)


@pytest.mark.parametrize("spacing", [1, 3, 20, ordered.SPACING])
def test_in_order_equals_window(spark, rows, spacing):
    df = _skewed(spark)
    order = [F.asc_nulls_last("v"), F.asc("id")]
    got = ordered.in_order(df, ["k"], ["v", "id"], "n", before={"p": F.col("id")}, after={"f": F.col("v")}, spacing=spacing)
    w = Window.partitionBy("k").orderBy(*order)
    want = df.select("*", F.row_number().over(w).alias("n"), F.lag("id").over(w).alias("p"), F.lead("v").over(w).alias("f"))
    assert rows(got) == rows(want)


@pytest.mark.parametrize("spacing", [1, 7, ordered.SPACING])
def test_in_order_without_groups(spark, rows, spacing):
    df = _skewed(spark).withColumn("k", F.coalesce("k", F.lit("-")))
    got = ordered.in_order(df, [], ["id"], "n", before={"p": F.col("id")}, spacing=spacing)
    w = Window.orderBy("id")
    assert rows(got) == rows(df.select("*", F.row_number().over(w).alias("n"), F.lag("id").over(w).alias("p")))


def test_in_order_cuts_a_large_group(spark, rows, monkeypatch):
    """Also with more marks than are kept and equal order values, the rows of one group meet in many chunks."""
    df = spark.range(4000).select(F.lit(1).alias("g"), (F.col("id") % 7).alias("v"), "id")
    place = F.struct(*ordered._placed(["g"], "g"), *ordered._placed(["v"], "o"), F.xxhash64("id").alias("tie"))
    chunks = ordered._with_chunks(df.withColumn(ordered._PLACE, place), ["g"], 20)
    assert chunks.where(ordered._CUT).count() == 4000
    sizes = chunks.groupBy(ordered._CHUNK).count()
    assert sizes.count() > 100 and sizes.agg(F.max("count")).first()[0] < 200
    monkeypatch.setattr(ordered, "MARKS", 8)
    got = ordered.in_order(df, ["g"], ["v"], "n", before={"p": F.col("v")}, spacing=20)
    assert sorted(r["n"] for r in got.collect()) == list(range(1, 4001))
    assert all(r["p"] is None or r["p"] <= r["v"] for r in got.collect())
    assert [tuple(r) for r in got.groupBy("v").agg(F.min("n"), F.max("n")).orderBy("v").collect()][0] == (0, 1, 572)


def test_in_order_marks_cut_few_groups(spark, rows):
    """Groups without a mark carry nothing; the others at most two rows for a mark. Order and totals are right in both."""
    df = spark.range(20_000).select(F.when(F.col("id") < 7000, "hot").otherwise((F.col("id") % 900).cast("string")).alias("g"), F.pmod(F.col("id") * 7919, F.lit(20_011)).alias("v"))
    place = F.struct(*ordered._placed(["g"], "g"), *ordered._placed(["v"], "o"))
    chunks = ordered._with_chunks(df.withColumn(ordered._PLACE, place), ["g"], 500)
    cut = chunks.where(ordered._CUT).groupBy("g", ordered._CHUNK).count()
    marks = chunks.agg(F.max(ordered._CHUNK)).first()[0]
    assert 20 < marks < 80 and cut.count() <= 2 * marks and cut.where("g = 'hot'").count() > 8
    w = Window.partitionBy("g").orderBy("v")
    got = ordered.in_order(df, ["g"], ["v"], "n", before={"p": F.col("v")}, after={"f": F.col("v")}, spacing=500, total="all", ties=False)
    want = df.select("*", F.row_number().over(w).alias("n"), F.count("*").over(Window.partitionBy("g")).alias("all"), F.lag("v").over(w).alias("p"), F.lead("v").over(w).alias("f"))
    assert rows(got) == rows(want)


def test_in_order_plan(spark):
    """At most four shuffles, and a draw of marks that reads the group and order columns only."""
    orders = spark.read.parquet("/root/testdata/sf0.001/orders.parquet")
    got = ordered.in_order(orders, ["o_custkey"], ["o_orderdate", "o_orderkey"], "n", ties=False)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert len(set(re.findall(r"Exchange (?:hash|range|Single)\w+.*?plan_id=(\d+)", plan))) <= 4
    assert plan.count("ReadSchema: struct<o_custkey:bigint,o_orderkey:bigint,o_orderdate") >= 1 or plan.count("ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint,o_orderdate") >= 1


@pytest.mark.parametrize("group", [["o_custkey"], []])
def test_in_order_looks_at_few_marks(spark, group):
    """A row finds its chunk by compiled steps, not by going through arrays of marks, which cost more the larger the table was."""
    orders = spark.read.parquet("/root/testdata/sf0.001/orders.parquet")
    got = ordered.in_order(orders, group, ["o_orderdate", "o_orderkey"], "n", spacing=10)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "lambdafunction" not in plan and "slice(" not in plan


@pytest.mark.parametrize("group", [["g"], []])
def test_in_order_with_a_thousand_marks(spark, rows, group):
    """Chunks of one to a few rows, in groups of every size, of none and without a key."""
    data = [(None if i % 11 == 0 else f"g{i % 3 if i % 2 else i % 400}", None if i % 7 == 0 else (i * 7919) % 501, i) for i in range(4000)]
    df = spark.createDataFrame(data, "g string, v int, id int").repartition(7)
    chunks = ordered._with_chunks(df.withColumn(ordered._PLACE, F.struct(*ordered._placed(group, "g"), *ordered._placed(["v", "id"], "o"))), group, 3)
    assert chunks.agg(F.max(ordered._CHUNK)).first()[0] > 1000
    w = Window.partitionBy(*group).orderBy(F.asc_nulls_last("v"), "id")
    got = ordered.in_order(df, group, ["v", "id"], "n", before={"p": F.col("id")}, after={"f": F.col("v")}, spacing=3, total="all", ties=False)
    want = df.select("*", F.row_number().over(w).alias("n"), F.count("*").over(Window.partitionBy(*group)).alias("all"), F.lag("id").over(w).alias("p"), F.lead("v").over(w).alias("f"))
    assert rows(got) == rows(want)


def test_in_order_joins_only_cut_groups_for_what_is_carried(spark, rows):
    """What chunks carry is counted from rows that were held against the groups with a mark before they are joined."""
    lines = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet").select("l_orderkey", "l_linenumber", "l_partkey")
    parts = spark.read.parquet("/root/testdata/sf0.001/part.parquet").select("p_partkey", "p_name")
    joined = lines.join(parts, F.col("l_partkey") == F.col("p_partkey"))
    order = ["l_linenumber", "l_partkey"]
    got = ordered.in_order(joined, ["l_orderkey"], order, "n", before={"p": F.col("l_partkey")}, total="all", spacing=40)
    plan = got._jdf.queryExecution().optimizedPlan().toString().split("\n")
    depth = [len(x) - len(x.lstrip(" :+-")) for x in plan]
    semi = next(i for i, x in enumerate(plan) if "Join LeftSemi" in x)
    above = max(i for i in range(semi) if depth[i] < depth[semi] and "Join" in plan[i])
    assert "Join Inner" in plan[above] and "l_partkey" in plan[above]
    w = Window.partitionBy("l_orderkey")
    ranked = w.orderBy(*order)
    want = joined.select("*", F.row_number().over(ranked).alias("n"), F.count("*").over(w).alias("all"), F.lag("l_partkey").over(ranked).alias("p"))
    columns = ["l_orderkey", "l_linenumber", "l_partkey", "p_name", "n", "all", "p"]
    assert rows(got.select(*columns)) == rows(want.select(*columns))


def test_in_order_cuts_no_small_group(spark, rows):
    """Groups with a few marks only lie in one chunk each, and without a large group nothing is counted to be carried."""
    df = spark.range(6000).select((F.col("id") % 300).cast("string").alias("g"), F.pmod(F.col("id") * 7919, F.lit(6007)).alias("v"))
    place = F.struct(*ordered._placed(["g"], "g"), *ordered._placed(["v"], "o"))
    chunks = ordered._with_chunks(df.withColumn(ordered._PLACE, place), ["g"], 400)
    assert chunks.where(ordered._CUT).count() == 0 and chunks.agg(F.max(ordered._CHUNK)).first()[0] == 0
    w = Window.partitionBy("g").orderBy("v")
    got = ordered.in_order(df, ["g"], ["v"], "n", before={"p": F.col("v")}, after={"f": F.col("v")}, spacing=400, total="all", ties=False)
    want = df.select("*", F.row_number().over(w).alias("n"), F.count("*").over(Window.partitionBy("g")).alias("all"), F.lag("v").over(w).alias("p"), F.lead("v").over(w).alias("f"))
    assert rows(got) == rows(want)
    got.collect()
    final = got._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert "LeftSemi" not in final and "max_by" not in final


def test_first_match_links_searches_a_text_once(spark, rows):
    """The search is in the plan once, however often the code is used after it; no code, no text, no row."""
    texts = [(1, "a X12 b X34"), (2, "none"), (3, None), (4, "X56"), (5, "")]
    df = spark.createDataFrame(texts, "id int, text string").repartition(2)
    links = business.first_match_links(df, "text", "(X[0-9]{2})", "code")
    used = links.where(F.length("code") == 3).select("id", "code", F.upper("code").alias("u"), F.concat("code", "code").alias("w"))
    assert used._jdf.queryExecution().optimizedPlan().toString().count("regexp_extract(") == 1
    assert rows(used) == [(1, "X12", "X12", "X12X12"), (4, "X56", "X56", "X56X56")]
    assert links.columns == ["id", "text", "code"]


def test_in_order_runs_no_job_before_the_action(spark):
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("planning", "planning")
    ordered.in_order(_skewed(spark), ["k"], ["v", "id"], "n", before={"p": F.col("id")})
    assert tracker.getJobIdsForGroup("planning") == []
    spark.sparkContext.setJobGroup("", "")


def test_with_group_count(spark, rows):
    df = _skewed(spark)
    want = df.withColumn("n", F.count(F.lit(1)).over(Window.partitionBy("k")))
    assert rows(ordered.with_group_count(df, ["k"], "n")) == rows(want)


def test_repeat_rows(spark, rows):
    df = spark.createDataFrame([("a", 7), ("b", 0), ("c", 1)], "k string, n int")
    assert [r[0] for r in rows(ordered.repeat_rows(df, F.col("n"), chunk=3))] == ["a"] * 7 + ["c"]


def test_list_to_names(spark, rows):
    df = spark.createDataFrame([(1, "2, 1,,9"), (2, ""), (3, None), (4, "9"), (5, "1,1"), (6, "2, 1,,9")], "id int, ids string")
    names = spark.createDataFrame([(1, "one"), (2, "two"), (2, "zwei"), (3, None)], "key int, name string")
    got = lists.list_to_names(df, "ids", names, "key", "name", "names")
    assert rows(got, "id", "names") == [
        (1, "two, zwei, one"),
        (2, None),
        (3, None),
        (4, None),
        (5, "one, one"),
        (6, "two, zwei, one"),
    ]


def test_positional_weights(spark, rows):
    data = [(c, p) for c, n in (("one", 1), ("two", 2), ("three", 3), ("four", 4), ("five", 5), ("seven", 7)) for p in range(1, n + 1)]
    got = business.positional_weights(spark.createDataFrame(data, "c string, p int"), ["c"], ["p"])
    by = {}
    for c, p, w in rows(got, "c", "p", "w"):
        by.setdefault(c, []).append(w)
    assert by == {
        "one": [10], "two": [7, 3], "three": [6, 3, 1], "four": [6, 2, 1, 1], "five": [5, 2, 1, 1, 1], "seven": [5, 2, 1, 1, 1],
    }


def test_positional_weights_limit_rows_before_the_shuffle(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("c"), "id")
    plan = business.positional_weights(df, ["c"], ["id"])._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and plan.count("hashpartitioning") == 1


def test_even_share(spark, rows):
    costs = spark.createDataFrame([("a", 10.0), ("b", 5.0), ("c", None)], "k string, cost double")
    members = spark.createDataFrame([("a", 1), ("a", 2), ("c", 3)], "k string, m int")
    assert rows(business.even_share(costs, members, "k", {"share": "cost"}), "k", "m", "share") == [("a", 1, 5.0), ("a", 2, 5.0), ("c", 3, None)]


def test_with_rate_uses_one_rate_per_day(spark, rows):
    rates = spark.sql("select * from values (date'2024-01-01', 3D), (date'2024-01-01', 2D), (date'2024-01-03', 5D) t(record_date, exchange_rate)")
    days = spark.sql("select * from values (1, date'2024-01-01'), (2, date'2024-01-02'), (3, cast(null as date)) t(id, d)")
    assert rows(business.with_rate(days, F.col("d"), rates), "id", "exchange_rate") == [(1, 2.0), (2, None), (3, None)]


def test_latest_per_counts_a_missing_time_as_newest(spark, rows):
    df = spark.createDataFrame([("e", 1, "a"), ("e", None, "b"), ("f", 1, "c"), ("f", 2, "d")], "e string, t int, who string")
    assert rows(business.latest_per(df, ["e"], "t"), "who") == [("b",), ("d",)]


def test_with_fallback_key(spark, rows):
    df = spark.createDataFrame([("k1", "x"), (None, "x"), (None, "y"), (None, None)], "own string, alt string")
    lookup = spark.createDataFrame([("x", "found"), ("y", None), (None, "never")], "alt string, code string")
    assert rows(business.with_fallback_key(df, "own", "alt", lookup, "code")) == [("found", "x"), ("k1", "x")]
