import datetime as dt

import pytest
from pyspark.sql import functions as F

from silverloom.operators.ordered import SPACING
from silverloom.quality import checks, suite


def frame(spark, schema, *values):
    return spark.createDataFrame(list(values), schema)


def test_simple_checks(spark, rows):
    df = frame(spark, "a int, s string", (1, "x"), (1, ""), (None, "  "), (None, None), (2, "y"))
    assert rows(checks.unique(df, "a")) == [(1, 2)]
    assert checks.not_null(df, "a").count() == 2
    assert rows(checks.accepted_values(df, "a", [1])) == [(2, 1)]
    assert rows(checks.not_accepted_values(df, "s", ["x", "z"])) == [("x",)]
    assert checks.not_empty_string(df, "s").count() == 2
    assert checks.not_empty_string(df, "s", trim_whitespace=False).count() == 1
    assert rows(checks.unique_combination_of_columns(df.select("a"), ["a"])) == [(1,), (None,)]
    assert rows(checks.expression_is_true(df, "a = 1")) == [(2, "y")]
    assert rows(checks.expression_is_true(df, "<> 2", column="a")) == [(2, "y")]


def test_relationships(spark, rows):
    df = frame(spark, "id int, kind string", (1, "a"), (5, "a"), (5, "a"), (6, "b"), (None, "a"))
    to = frame(spark, "key int, live boolean", (1, True), (6, False), (None, True))
    assert rows(checks.relationships(df, "id", to, "key")) == [(5,), (5,)]
    assert rows(checks.relationships(df, "id", to, "key", "kind = 'b'", "live")) == [(6,)]


def test_accepted_range(spark, rows):
    df = frame(spark, "id int", *[(i,) for i in range(-1, 12)], (None,))
    assert rows(checks.accepted_range(df, "id", 0, 10)) == [(-1,), (11,)]
    assert rows(checks.accepted_range(df, "id", 0, 10, inclusive=False)) == [(-1,), (0,), (10,), (11,)]
    assert checks.accepted_range(df, "id").count() == 0


def test_at_least_one_not_constant_and_proportion(spark, rows):
    df = frame(spark, "g string, v int", ("a", None), ("a", None), ("b", 1), ("b", None), ("c", 1), ("c", 2))
    assert rows(checks.at_least_one(df, "v", ["g"]), "g") == [("a",)]
    assert checks.at_least_one(df, "v").count() == 0
    assert checks.at_least_one(df.where("g = 'a'"), "v").count() == 1
    assert rows(checks.not_constant(df, "v", ["g"]), "g") == [("b",)]
    assert checks.not_constant(df, "v").count() == 0
    assert rows(checks.not_null_proportion(df, "v", 0.4, 0.9, ["g"])) == [("a", 0.0), ("c", 1.0)]
    assert checks.not_null_proportion(df, "v", 0.5).count() == 0


def test_cardinality_equality(spark, rows):
    a = frame(spark, "x int", (1,), (1,), (2,), (None,))
    b = frame(spark, "y int", (1,), (2,), (2,), (3,), (None,))
    assert rows(checks.cardinality_equality(a, "x", b, "y")) == [(1, 1), (1, 2), (2, 1), (2, 2), (3, 1)]
    assert checks.cardinality_equality(a, "x", a, "x").count() == 0


def test_row_counts(spark, rows):
    a = frame(spark, "g int", (1,), (1,), (2,), (None,))
    b = frame(spark, "g int", (1,), (3,), (None,))
    got = rows(checks.equal_rowcount(a, b, ["g"]))
    # A group missing on one side and a null group have no partner, and do not count as failures.
    assert got == sorted([(1, 1, 2, 1, 1), (2, None, 1, None, None), (None, 3, None, 1, None), (None, None, 1, None, None), (None, None, None, 1, None)], key=repr)
    failures = checks.equal_rowcount(a, b, ["g"]).agg(suite.failures_of_rowcount()).first()[0]
    assert failures == 1
    assert rows(checks.fewer_rows_than(a, b)) == [(4, 3, 1)]
    assert rows(checks.fewer_rows_than(b, b)) == [(3, 3, 1)]
    assert rows(checks.fewer_rows_than(b, a)) == [(3, 4, 0)]


def test_equality(spark, rows):
    a = frame(spark, "id int, f double, note string", (1, 1.00001, "x"), (2, 2.0, None), (2, 2.0, None))
    b = frame(spark, "ID int, F double, note string", (1, 1.00002, "x"), (2, 2.0, None))
    assert checks.equality(a, b, precision=4).count() == 0
    assert checks.equality(a, b, precision=6).count() == 2
    assert checks.equality(a, b, exclude_columns=["f"]).count() == 0
    assert rows(checks.equality(a, b, compare_columns=["f"])) == [("a_minus_b", 1.00001), ("b_minus_a", 1.00002)]
    failures = checks.equality(a, b.where("id = 1")).agg(suite.failures_of_equality()).first()[0]
    assert failures == 3 + 1
    with pytest.raises(ValueError):
        checks.equality(a, b.drop("note"))
    with pytest.raises(ValueError):
        checks.equality(a, b, ["f"], ["id"])


RANGES = [("a", 1, 3), ("a", 3, 5), ("a", 7, 9), ("b", 1, 1), ("b", 2, 1), ("c", 1, 5), ("c", 4, 6), ("d", None, 3), ("d", 5, None)]


@pytest.mark.parametrize("spacing", [SPACING, 1])
@pytest.mark.parametrize(
    "gaps, zero, bad",
    [
        ("allowed", False, {("b", 1, 1), ("b", 2, 1), ("c", 1, 5), ("d", None, 3), ("d", 5, None)}),
        ("not_allowed", True, {("a", 3, 5), ("b", 1, 1), ("b", 2, 1), ("c", 1, 5), ("d", None, 3), ("d", 5, None)}),
        ("required", True, {("a", 1, 3), ("b", 2, 1), ("c", 1, 5), ("d", None, 3), ("d", 5, None)}),
    ],
)
def test_mutually_exclusive_ranges(spark, rows, gaps, zero, bad, spacing):
    df = frame(spark, "k string, lo int, hi int", *RANGES)
    got = checks.mutually_exclusive_ranges(df, "lo", "hi", "k", gaps, zero, spacing)
    assert set(rows(got, "partition_by_col", "lower_bound", "upper_bound")) == bad


def test_repeated_ranges_each_break_the_rule(spark, rows):
    df = frame(spark, "lo int, hi int", (1, 2), (1, 2), (1, 2), (5, 6))
    got = checks.mutually_exclusive_ranges(df, "lo", "hi")
    assert rows(got, "lower_bound", "next_lower_bound", "is_last_record") == [(1, 1, False), (1, 1, False)]
    with pytest.raises(ValueError):
        checks.mutually_exclusive_ranges(df, "lo", "hi", gaps="maybe")


@pytest.mark.parametrize("spacing", [SPACING, 1])
def test_sequential_values(spark, rows, spacing):
    df = frame(spark, "g string, n int", ("a", 2), ("a", 4), ("a", 8), ("b", 4), ("b", 4), ("b", 4), ("b", None))
    got = checks.sequential_values(df, "n", 2, group_by=["g"], spacing=spacing)
    assert rows(got) == [("a", 8, 4), ("b", 4, 4), ("b", 4, 4)]
    assert rows(checks.sequential_values(df.where("g = 'a'").select("n"), "n", 2)) == [(8, 4)]


def test_sequential_moments(spark, rows):
    df = spark.sql("select explode(array(timestamp_ntz'2024-01-01 00:00:00', timestamp_ntz'2024-01-01 01:00:00', timestamp_ntz'2024-01-01 03:00:00')) t")
    got = checks.sequential_values(df, "t", 1, "hour")
    assert rows(got) == [(dt.datetime(2024, 1, 1, 3), dt.datetime(2024, 1, 1, 1))]


def test_recency(spark, rows):
    df = spark.sql(
        "select * from values ('a', timestamp_ntz'2024-01-01 01:00:00'), ('b', timestamp_ntz'2024-01-01 00:00:00'), ('c', cast(null as timestamp_ntz)) t(g, at)"
    )
    as_of = dt.datetime(2024, 1, 2, 0, 30)
    assert rows(checks.recency(df, "at", "hour", 24, as_of, group_by=["g"]), "g") == [("b",), ("c",)]
    assert rows(checks.recency(df, "at", "day", 1, as_of, ignore_time=True, group_by=["g"]), "g") == [("c",)]
    assert checks.recency(df, "at", "day", 1, as_of).count() == 0


def test_columns_match_set(spark, rows):
    tables = {"x": spark.sql("select 1 as A, 2 as b"), "y": spark.sql("select 1 as a")}
    assert rows(checks.columns_match_set(tables, ["a", "B"])) == [("y", None, "B", 1)]
    assert rows(checks.columns_match_set(tables, ["a"], upper=False)) == [("x", "b", None, 1)]


def test_assert_equal(spark, rows):
    df = frame(spark, "actual int, expected int", (1, 1), (1, 2), (None, 1), (1, None))
    assert rows(checks.assert_equal(df, "actual", "expected")) == [(1, 2)]


def test_suite(spark, rows):
    df = frame(spark, "a int, s string", (1, "x"), (1, ""), (None, "y"), (20, "z"))
    got = suite.run_suite(
        df,
        [
            suite.not_null("a", severity="warn"),
            suite.in_range("a", 0, 10, where="s <> 'z'"),
            suite.filled_text("s", error_if="failures > 5"),
            suite.Check("inverted", violation=F.col("a") == 1, error_if="failures < 1", warn_if="failures < 1"),
            suite.Check("unique_a", rows=lambda t: checks.unique(t, "a")),
        ],
    )
    assert rows(got) == [
        ("accepted_range_a", 0, "pass"),
        ("inverted", 2, "pass"),
        ("not_empty_string_s", 1, "warn"),
        ("not_null_a", 1, "warn"),
        ("unique_a", 1, "error"),
    ]


def test_row_checks_share_one_scan(spark):
    df = spark.range(10).withColumnRenamed("id", "a")
    plan = suite.run_suite(df, [suite.not_null("a"), suite.in_range("a", 0, 5)])._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Range (") == 1
