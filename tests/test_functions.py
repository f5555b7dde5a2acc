import hashlib
import math

import pytest
from pyspark.sql import functions as F

from silverloom.functions import dates, geo, safe, text, url
from silverloom.functions.keys import NULL_MARK, surrogate_key


def one(spark, column, **values):
    """Value of a column expression over one row of typed literals."""
    df = spark.range(1).select(*[F.lit(v).alias(n) for n, v in values.items()]) if values else spark.range(1)
    return df.select(column).first()[0]


def test_surrogate_key(spark):
    df = spark.createDataFrame([(1, "a"), (1, ""), (1, None)], "n int, s string")
    plain = [r[0] for r in df.select(surrogate_key("n", "s")).collect()]
    assert plain[0] == hashlib.md5(b"1-a").hexdigest()
    assert plain[1] == hashlib.md5(b"1-").hexdigest()
    assert plain[2] == hashlib.md5(f"1-{NULL_MARK}".encode()).hexdigest()
    legacy = [r[0] for r in df.select(surrogate_key("n", "s", nulls_as_empty=True)).collect()]
    assert legacy[1] == legacy[2] != plain[2]


def test_safe_arithmetic(spark):
    df = spark.createDataFrame([(1, 2, None), (None, None, None), (5, 2, 1)], "a int, b int, c int")
    got = df.select(safe.safe_add("a", "b", "c"), safe.safe_subtract("a", "b", "c")).collect()
    assert [tuple(r) for r in got] == [(3, -1), (0, 0), (8, 2)]
    ratio = spark.createDataFrame([(6.0, 3.0), (6.0, 0.0), (6.0, None), (None, 3.0)], "a double, b double")
    assert [r[0] for r in ratio.select(safe.safe_divide("a", "b")).collect()] == [2.0, None, None, None]
    with pytest.raises(ValueError):
        safe.safe_add()


def test_width_bucket(spark):
    df = spark.createDataFrame([(v,) for v in (0.5, 2.0, 5.0, 10.0, 11.0, -1.0)], "x double")
    native = [r[0] for r in df.select(safe.width_bucket("x", 0, 10, 5, native=True)).collect()]
    assert native == [1, 2, 3, 6, 6, 0]
    # The portable formula: edges go up, below the range 0 or less, above it n + 1.
    portable = [r[0] for r in df.select(safe.width_bucket("x", 0, 10, 5)).collect()]
    assert portable == [1, 2, 3, 6, 6, 0]


def test_width_bucket_formula_deviates_from_native(spark):
    # low = 1 is no multiple of the width 2: 4 is a multiple of it but no edge.
    df = spark.createDataFrame([(4.0,), (12.0,), (-9.0,)], "x double")
    both = df.select(safe.width_bucket("x", 1, 11, 5), safe.width_bucket("x", 1, 11, 5, native=True)).collect()
    assert [tuple(r) for r in both] == [(3, 2), (7, 6), (-5, 0)]


def test_haversine(spark):
    df = spark.createDataFrame([(48.864716, 2.349014, 52.379189, 4.899431)], "a double, b double, c double, d double")
    miles = df.select(geo.haversine("a", "b", "c", "d")).first()[0]
    km = df.select(geo.haversine("a", "b", "c", "d", unit="km")).first()[0]
    assert 265 < miles < 268 and math.isclose(km, miles * 1.60934)
    with pytest.raises(ValueError):
        geo.haversine("a", "b", "c", "d", unit="m")


@pytest.mark.parametrize(
    "address, host, path, source",
    [
        ("https://a.com/x/y?utm_source=g&b=1", "a.com", "x/y", "g"),
        ("http://a.com:80?utm_source=", "a.com:80", "", None),
        ("android-app://com.shop/path", "com.shop", "/com.shop/path", None),
        ("a.com/p", "a.com", "p", None),
        ("a.com", "a.com", "a.com", None),
        ("a.com/p?xutm_source=near", "a.com", "p", "near"),
        (None, None, None, None),
    ],
)
def test_url_parts(spark, address, host, path, source):
    df = spark.createDataFrame([(address,)], "u string")
    got = df.select(url.url_host("u"), url.url_path("u"), url.url_parameter("u", "utm_source")).first()
    assert tuple(got) == (host, path, source)


@pytest.mark.parametrize(
    "raw, clean", [("!Hell0 world-hi", "hell0_world_hi"), ("0Hell0 world-hi", "_0hell0_world_hi"), ("a  - b", "a_b"), ("", "")]
)
def test_slug(spark, raw, clean):
    assert text.slug_name(raw) == clean
    assert one(spark, text.slug("s"), s=raw) == clean


def test_text_normalisation(spark):
    df = spark.createDataFrame([("  a ",), ("   ",), ("",), (None,)], "s string")
    assert [r[0] for r in df.select(text.blank_to_null("s")).collect()] == ["a", None, None, None]
    numbers = spark.createDataFrame([("1,234.5",), (" 7 ",), ("x",), ("-12 usd",)], "s string")
    grouped = [r[0] for r in numbers.select(text.grouped_number("s").cast("double")).collect()]
    assert grouped == [1234.5, 7.0, None, None]
    digits = [r[0] for r in numbers.select(text.digits_number("s").cast("bigint")).collect()]
    assert digits == [12345, 7, None, 12]
    typed = [r[0] for r in numbers.select(text.typed("s", "decimal(18,2)").cast("double")).collect()]
    assert typed == [None, 7.0, None, None]
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        numbers.select(text.typed("s", "decimal(18,2)", strict=True)).collect()


def test_numbers_beyond_the_type_are_an_error_when_strict(spark):
    df = spark.createDataFrame([("9" * 36,)], "s string")
    assert df.select(text.grouped_number("s")).first()[0] is None
    with pytest.raises(Exception, match="NUMERIC_VALUE_OUT_OF_RANGE|out of range"):
        df.select(text.grouped_number("s", strict=True)).collect()


def test_json_picks(spark):
    df = spark.createDataFrame([('{"vi_VN": "a", "en_US": "b"}',), ('{"en_US": "b"}',), ("plain",), ("{broken",), (None,)], "j string")
    assert [r[0] for r in df.select(text.localised("j", "vi_VN", "en_US")).collect()] == ["a", "b", None, None, None]
    assert [r[0] for r in df.select(text.json_or_text("j", "en_US")).collect()] == ["b", "b", "plain", None, None]


def test_prefer_unlike_counts_null_last(spark):
    df = spark.createDataFrame([("a.mp3",), ("b.WAV",), (None,)], "s string")
    assert [r[0] for r in df.select(text.prefer_unlike("s", "%.wav")).collect()] == [0, 1, 1]


def test_capture(spark):
    df = spark.createDataFrame([("x AB12 CD34",), ("none",), (None,)], "s string")
    assert [r[0] for r in df.select(text.capture("s", "([A-Z]{2}[0-9]{2})")).collect()] == ["AB12", None, None]


def test_dates(spark):
    df = spark.sql("select timestamp_ntz'2024-02-28 10:00:00' as a, cast(null as timestamp_ntz) as b")
    got = df.select(
        dates.effective_timestamp("a", "b").cast("string"),
        dates.effective_timestamp("b", "b"),
        dates.month_label("a"),
        dates.month_end(F.year("a"), F.month("a")).cast("string"),
        dates.age_days("a", "2024-03-02"),
        dates.in_month("a", "2024-02"),
        dates.in_month("a", "2023-12"),
    ).first()
    assert tuple(got) == ("2024-02-28 10:00:00", None, "2024-02", "2024-02-29", 3, True, False)
