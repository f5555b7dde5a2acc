"""Every registered query against its SQL on the smallest driver tables."""

import os

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from silverloom.registered import load
from tools.compare import TABLES, rows_of

FOLDER = "/root/testdata/sf0.001"
QUERIES, ORACLES = load()

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="driver tables are absent")


@pytest.fixture(scope="module")
def sql():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{FOLDER}/{t}.parquet')")
    return con


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sql, name):
    df = QUERIES[name](spark, FOLDER)
    cursor = sql.execute(ORACLES[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == sorted(df.columns)
    assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == rows_of(names, cursor.fetchall())


@pytest.mark.parametrize("name", ["tbl_03_pivot", "flagship_user_profile"])
def test_pivot_needs_every_type(spark, tmp_path, name):
    events = spark.read.parquet(f"{FOLDER}/events.parquet").limit(300).withColumn("n", F.monotonically_increasing_id())
    for kinds in (100, 101):
        folder = str(tmp_path / str(kinds))
        typed = events.withColumn("event_type", F.concat(F.lit("kind"), (F.col("n") % kinds).cast("string"))).drop("n")
        typed.coalesce(1).write.parquet(f"{folder}/events.parquet")
        if kinds > 100:
            with pytest.raises(ValueError, match="more than 100"):
                QUERIES[name](spark, folder)
        else:
            assert {f"kind{k}" for k in range(100)} <= set(QUERIES[name](spark, folder).columns)
