import datetime as dt

import pytest
from pyspark.sql import functions as F

from silverloom.plans import materialise
from silverloom.plans.workflow import extract, rollback, run_source
from silverloom.sinks import commits, files
from silverloom.sinks.commits import ConflictError
from silverloom.sinks.ledger import Ledger
from silverloom.sinks.warehouse import Warehouse, new_batch_id
from silverloom.sources.spec import SourceSpec
from silverloom.streaming.upsert import stream_upsert

DAY = dt.datetime(2024, 1, 1, 6)


@pytest.fixture
def wh(spark, tmp_path):
    return Warehouse(spark, str(tmp_path / "wh"), buckets=4)


def put(wh, name, df, mode, *args):
    wh.commit(f"{name}-{mode}", name, wh.load(name, df, mode, *args))


def test_batch_ids_of_one_second_differ():
    assert new_batch_id("s", DAY).startswith("s_20240101_060000_")
    assert new_batch_id("s", DAY) != new_batch_id("s", DAY)


def test_ledger_states(spark, tmp_path, rows):
    ledger = Ledger(spark, str(tmp_path / "ledger"))
    assert ledger.last_success("s") is None and ledger.history("s").count() == 0
    ledger.register("s", "b1", "p1", 10, at=DAY, watermark_value="w1")
    ledger.register("s", "b2", "p2", 20, at=DAY + dt.timedelta(days=1), watermark_value="w2")
    ledger.register("s", "b3", "p3", 30, at=DAY + dt.timedelta(days=2))
    assert ledger.status("b1") == "extracted"
    ledger.mark_loaded("b1", at=DAY)
    ledger.mark_loaded("b2", at=DAY)
    ledger.mark_failed("b3", "x" * 5000)
    assert rows(ledger.batches(), "batch_id", "status", F.length("error_message")) == [("b1", "loaded", None), ("b2", "loaded", None), ("b3", "failed", 2000)]
    assert ledger.last_success("s")["watermark_value"] == "w2"
    assert ledger.as_of("2024-01-01").first()["batch_id"] == "b1"
    assert ledger.as_of("2023-12-31").count() == 0
    assert [r["batch_id"] for r in ledger.history("s", 2).collect()] == ["b3", "b2"]
    Ledger(spark, str(tmp_path / "ledger"))  # opening it again keeps what is there
    assert ledger.batches().count() == 3


def test_land_measures_in_one_pass(spark, wh):
    df = spark.sql("select id, cast('2024-01-01' as timestamp_ntz) + make_dt_interval(cast(id as int)) as at from range(5)")
    batch = wh.land(df, "table", "src", "b1", "at")
    assert (batch.rows, batch.watermark) == (5, "2024-01-05 00:00:00")
    assert wh.read_batch(batch.path).count() == 5
    assert wh.land(df.where("id > 9"), "table", "src", "b2", "at").watermark is None


def test_truncate_and_append(spark, wh, rows):
    one, two = spark.sql("select 1 as a, 'x' as b"), spark.sql("select 'y' as b, 2 as a")
    with pytest.raises(LookupError):
        wh.table("t")
    put(wh, "t", one, "append")
    put(wh, "t", two, "append")
    assert rows(wh.table("t")) == [(1, "x"), (2, "y")]
    put(wh, "t", two, "truncate")
    assert rows(wh.table("t")) == [("y", 2)]
    with pytest.raises(ValueError):
        wh.load("t", one, "merge")


def test_upsert(spark, wh, rows):
    base = spark.range(100).select(F.col("id").cast("int").alias("k"), F.lit(0).alias("v"))
    put(wh, "t", base, "truncate")  # not laid out by key yet
    delta = spark.createDataFrame([(5, 1), (5, 2), (200, 1), (None, 1)], "k bigint, v int")
    put(wh, "t", delta, "upsert", ["k"], [F.desc("v")])
    got = dict(rows(wh.table("t")))
    assert len(got) == 102 and got[5] == 2 and got[200] == 1 and got[None] == 1 and got[6] == 0
    put(wh, "t", delta, "upsert", ["k"], [F.desc("v")])
    assert dict(rows(wh.table("t"))) == got and wh.table("t").count() == 102
    with pytest.raises(ValueError):
        wh.load("t", delta, "upsert")


def test_upsert_rewrites_only_touched_buckets(spark, wh):
    put(wh, "t", spark.range(100), "upsert", ["id"])
    before = wh.log.state("t").paths
    put(wh, "t", spark.range(1), "upsert", ["id"])
    after = wh.log.state("t").paths
    assert len(before) == 4 and len(set(before) & set(after)) == 3 and len(after) == 4
    put(wh, "t", spark.range(0), "upsert", ["id"])
    assert wh.log.state("t").paths == after
    wider = Warehouse(spark, wh.root, buckets=7)  # another layout: everything is laid out anew
    put(wider, "t", spark.range(150), "upsert", ["id"])
    assert wider.table("t").count() == 150 and not set(wider.log.state("t").paths) & set(after)


def test_buckets_follow_the_table(spark, wh):
    grown = Warehouse(spark, wh.root, buckets=2, bucket_rows=10)
    put(grown, "t", spark.range(15), "upsert", ["id"])
    assert grown.log.state("t").buckets == 2
    put(grown, "t", spark.range(10, 75), "upsert", ["id"])
    assert grown.log.state("t").buckets == 8 and grown.table("t").count() == 75


def test_commits(spark, wh, rows):
    one, two = wh.load("t", spark.range(2), "append"), wh.load("t", spark.range(2, 5), "append")
    put_two, put_one = (wh.commit(n, "t", c) for n, c in (("two", two), ("one", one)))
    assert (put_two, put_one) == (1, 2) and wh.table("t").count() == 5
    stale = wh.load("t", spark.range(1), "truncate")
    put(wh, "t", spark.range(5, 6), "append")
    with pytest.raises(ConflictError):
        wh.commit("late", "t", stale)
    assert wh.table("t").count() == 6 and wh.table("t", 1).count() == 3
    before = wh.log.state("t")
    wh.commit("small", "t", wh.compact("t"))
    assert len(before.paths) == 3 and len(wh.log.state("t").paths) == 1 and wh.table("t").count() == 6
    wh.commit("back", "t", wh.restore("t", 2))
    assert sorted(r[0] for r in wh.table("t").collect()) == [0, 1, 2, 3, 4]


def test_many_commits_read_few(spark, wh, monkeypatch):
    monkeypatch.setattr(commits, "SNAPSHOT", 4)
    for i in range(10):
        put(wh, "t", spark.range(i, i + 1), "append")
    assert sorted(r[0] for r in wh.table("t").collect()) == list(range(10))
    assert wh.table("t", 6).count() == 6 and wh.log.state("t").row_bound == 10
    for version in (3, 4, 6, 8, 10, None):  # as read by another session, which has seen no commit
        again = commits.CommitLog(spark, f"{wh.root}/commits").state("t", version)
        mine = wh.log.state("t", version)
        assert sorted(again.paths) == sorted(mine.paths) and (again.version, again.row_bound, again.schema) == (mine.version, mine.row_bound, mine.schema)
    assert not files.create_once(spark, f"{wh.root}/commits/t/claims/2/{10:012d}.json", "{}")
    monkeypatch.setattr(files, "folder_names", lambda *a: [])  # a writer that does not see the others' commits
    assert wh.log.state("t").version == 0


def test_commit_that_died_before_its_claim(spark, wh, monkeypatch):
    """Events without a claimed version count for nothing, also for those who take the version after."""
    put(wh, "t", spark.range(3), "append")
    lost = wh.load("t", spark.range(100, 200), "append")
    with monkeypatch.context() as m:
        m.setattr(files, "create_once", lambda *a: (_ for _ in ()).throw(RuntimeError("died")))
        with pytest.raises(RuntimeError):
            wh.log.commit(lost)
    put(wh, "t", spark.range(3, 5), "append")
    for log in (wh.log, commits.CommitLog(spark, f"{wh.root}/commits")):
        assert log.state("t").version == 2 and len(log.state("t").paths) == 2
    assert wh.table("t").count() == 5 and wh.log.version_of("t", "nobody") is None


def test_racing_appends(spark, wh):
    """Writers that all saw the same version: every one gets its own, none is lost."""
    from concurrent.futures import ThreadPoolExecutor

    changes = [wh.load("t", spark.range(i, i + 1), "append") for i in range(6)]
    logs = [commits.CommitLog(spark, f"{wh.root}/commits") for _ in changes]
    with ThreadPoolExecutor(6) as pool:
        versions = list(pool.map(lambda x: x[0].commit(x[1]), zip(logs, changes)))
    assert sorted(versions) == [1, 2, 3, 4, 5, 6]
    assert sorted(r[0] for r in wh.table("t").collect()) == list(range(6))


def test_ledger_events_of_threads(spark, wh):
    """Events that are written at the same time all stay and have numbers of their own."""
    from concurrent.futures import ThreadPoolExecutor

    with ThreadPoolExecutor(6) as pool:
        list(pool.map(lambda i: wh.ledger.register(f"s{i % 2}", f"b{i}", "p", i), range(12)))
    found = wh.ledger.events().select("batch_id", "event_no").collect()
    assert sorted(r["batch_id"] for r in found) == sorted(f"b{i}" for i in range(12)) and len({r["event_no"] for r in found}) == 12


def test_incremental_reads_no_stored_fact(spark, wh, rows, monkeypatch):
    """The newest value comes from the ledger; a table that was put back is asked itself."""
    df = spark.sql("select id, date_add(date'2024-01-01', cast(id as int)) as day from range(9)")
    for n in (3, 5):
        materialise.as_incremental(wh, "f", df.where(f"id < {n}"), ["id"], "day")
    asked = []
    table = wh.table
    monkeypatch.setattr(wh, "table", lambda name, *a: (asked.append(name), table(name, *a))[1])
    assert materialise._newest(wh, "f", "day") == "2024-01-05" and asked == []
    assert materialise.as_incremental(wh, "f", df.where("id < 5"), ["id"], "day").count() == 5  # nothing new
    assert materialise._newest(wh, "f", "day") == "2024-01-05"
    wh.log.commit(wh.restore("f", 1))
    asked.clear()
    assert materialise._newest(wh, "f", "day") == "2024-01-03" and asked == ["f"]
    assert materialise.as_incremental(wh, "f", df, ["id"], "day").count() == 9


def test_schema_change(spark, wh, rows):
    put(wh, "t", spark.createDataFrame([(1, 5)], "k int, v int"), "append")
    put(wh, "t", spark.createDataFrame([(2, 10.75, "x")], "k int, v double, w string"), "append")
    put(wh, "t", spark.createDataFrame([(3, 2)], "k int, v int"), "upsert", ["k"])
    assert rows(wh.table("t"), "k", "v", "w") == [(1, 5.0, None), (2, 10.75, "x"), (3, 2.0, None)]
    with pytest.raises(TypeError):
        wh.load("t", spark.createDataFrame([("a",)], "v string"), "append")
    put(wh, "t", spark.createDataFrame([(1, 7.5)], "k bigint, v double"), "upsert", ["k"])  # the key widens: laid out anew
    assert rows(wh.table("t"), "k", "v") == [(1, 7.5), (2, 10.75), (3, 2.0)]


def test_ties_have_one_winner(spark, wh, rows):
    delta = [(1, "2024-01-01", v) for v in "bca"]
    for order in (delta, delta[::-1]):
        put(wh, "t", spark.createDataFrame(order, "k int, at string, v string"), "upsert", ["k"], [F.desc("at")])
        assert rows(wh.table("t"), "v") == [("c",)]


def test_delete_insert_keeps_equal_keys(spark, wh, rows):
    put(wh, "t", spark.createDataFrame([(1, "a"), (1, "b"), (2, "c")], "k int, v string"), "append")
    for _ in range(2):
        put(wh, "t", spark.createDataFrame([(1, "d"), (1, "d"), (None, "e")], "k int, v string"), "delete_insert", ["k"])
        assert rows(wh.table("t"), "v") == [("c",), ("d",), ("d",), ("e",)]


def test_uncommitted_load_is_invisible(spark, wh):
    put(wh, "t", spark.range(3), "truncate")
    wh.load("t", spark.range(9), "truncate")  # the event that names it is never written
    assert wh.table("t").count() == 3


def source(spark, values, **options):
    df = spark.createDataFrame(values, "id int, at string").withColumn("at", F.col("at").cast("timestamp_ntz"))
    options = {"watermark_column": "at", "upsert_key": ("id",)} | options
    return SourceSpec("s", lambda _: df, connection="db", **options)


def test_workflow_is_incremental_and_idempotent(spark, wh, rows):
    first = [(1, "2024-01-01"), (2, "2024-01-02")]
    assert run_source(wh, source(spark, first), at=DAY).rows == 2
    assert run_source(wh, source(spark, first), at=DAY) is None
    grown = [*first, (2, "2024-01-03"), (3, "2024-01-04")]
    assert run_source(wh, source(spark, grown), at=DAY).rows == 2
    assert rows(wh.table("s"), "id", F.col("at").cast("string")) == [
        (1, "2024-01-01 00:00:00"),
        (2, "2024-01-03 00:00:00"),
        (3, "2024-01-04 00:00:00"),
    ]
    assert run_source(wh, source(spark, grown), force=True, at=DAY) is None  # nothing newer to load


def test_workflow_by_checksum(spark, wh):
    spec = source(spark, [(1, "2024-01-01")], watermark_column=None, upsert_key=(), checksum=True, load_mode="truncate")
    assert run_source(wh, spec, at=DAY).rows == 1
    assert run_source(wh, spec, at=DAY) is None
    assert run_source(wh, spec, force=True, at=DAY).rows == 1


def test_failed_load_is_recorded_and_retried(spark, wh):
    bad = source(spark, [(1, "2024-01-01")], load_mode="upsert", upsert_key=())
    with pytest.raises(ValueError):
        run_source(wh, bad, at=DAY)
    assert [r["status"] for r in wh.ledger.batches().collect()] == ["failed"]
    assert run_source(wh, source(spark, [(1, "2024-01-01")]), at=DAY).rows == 1


def test_rollback(spark, wh, rows):
    for day in (1, 2, 3):
        spec = source(spark, [(day, "2024-01-01")], watermark_column=None, upsert_key=(), load_mode="truncate")
        run_source(wh, spec, at=DAY + dt.timedelta(days=day))
    assert rollback(wh, spec, "2024-01-03").startswith("s_20240103")
    assert rows(wh.table("s"), "id") == [(2,)]
    assert rollback(wh, spec, "2023-01-01") is None
    assert [r["status"] for r in wh.ledger.batches().collect()] == ["loaded"] * 3


def test_rollback_of_deltas(spark, wh, rows):
    grown = [(1, "2024-01-01"), (2, "2024-01-02"), (3, "2024-01-03")]
    for n in (1, 2, 3):
        run_source(wh, source(spark, grown[:n]), at=DAY + dt.timedelta(days=n))
    written = wh.log.state("s")
    assert rollback(wh, source(spark, grown), "2024-01-03").startswith("s_20240103")
    assert rows(wh.table("s"), "id") == [(1,), (2,)] and set(wh.log.state("s").paths) <= set(wh.log.state("s", 2).paths)
    assert wh.ledger.last_success("s")["watermark_value"].startswith("2024-01-02")
    run_source(wh, source(spark, [*grown, (4, "2024-01-04")]), at=DAY + dt.timedelta(days=9))
    assert rows(wh.table("s"), "id") == [(1,), (2,), (3,), (4,)] and written.version == 3


def test_truncate_with_watermark_holds_all(spark, wh, rows):
    grown = [(i, f"2024-01-{i:02d}") for i in range(1, 12)]
    for values in (grown[:10], grown):
        assert run_source(wh, source(spark, values, load_mode="truncate"), at=DAY).rows == len(values)
    assert run_source(wh, source(spark, grown, load_mode="truncate"), at=DAY) is None
    assert wh.table("s").count() == 11


def test_mark_outlives_the_mapping(spark, wh):
    for _ in range(2):
        run_source(wh, source(spark, [(1, "2024-01-01")], field_mapping={"id": "key"}, upsert_key=()), at=DAY)
    assert wh.table("s").count() == 1 and wh.table("s").columns[0] == "key"


def test_load_that_died_before_its_mark(spark, wh):
    spec = source(spark, [(1, "2024-01-01")], upsert_key=())
    batch = extract(wh, spec, at=DAY)
    wh.log.commit(wh.load("s", wh.read_batch(batch.path), "append"), batch.batch_id)  # the ledger is not told
    assert run_source(wh, spec, at=DAY) is None
    assert wh.table("s").count() == 1 and wh.ledger.status(batch.batch_id, "s") == "loaded"


def test_materialise(spark, wh, rows):
    df = spark.sql("select id, date_add(date'2024-01-01', cast(id as int)) as day from range(4)")
    assert materialise.as_view(df, "some_view").count() == 4
    materialise.as_table(wh, "t", df)
    assert materialise.as_table(wh, "t", df.where("id = 1")).count() == 1
    materialise.as_incremental(wh, "f", df.where("id < 3"), ["id"], "day")
    changed = df.withColumn("id", F.when(F.col("id") == 3, 0).otherwise(F.col("id")))
    got = materialise.as_incremental(wh, "f", changed, ["id"], "day")
    assert rows(got, "id", F.dayofmonth("day")) == [(0, 4), (1, 2), (2, 3)]


def test_stream_equals_batch_and_resumes(spark, wh, tmp_path, rows):
    landing, progress = str(tmp_path / "in"), str(tmp_path / "progress")
    events = spark.sql("select id, id % 7 as k, timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, 0, cast(id as int)) as at from range(50)")

    def run():
        stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(landing)
        stream_upsert(wh, stream, "latest", ["k"], "events", progress, "at").awaitTermination()

    events.where("id < 20").repartition(2).write.parquet(landing)
    run()
    events.where("id >= 20").repartition(2, "id").sortWithinPartitions("at").write.mode("append").parquet(landing)
    run()
    run()  # nothing new
    keys = {r["k"] for r in wh.table("latest").collect()}
    assert keys == set(range(7)) and wh.table("latest").count() == 7
    assert wh.ledger.batches().where("status = 'loaded'").count() == 4


def test_restarted_stream(spark, wh, tmp_path):
    """The stream's progress is lost, the ledger is not: equal batches add nothing, grown ones do."""
    landing = str(tmp_path / "in")
    for attempt, grown, batches in (("a", 10, 1), ("b", 10, 1), ("c", 15, 2)):
        if attempt != "b":
            spark.range(grown - 5 if attempt == "c" else 0, grown).write.mode("append").parquet(landing)
        stream = spark.readStream.schema("id bigint").parquet(landing)
        stream_upsert(wh, stream, "t", ["id"], "s", str(tmp_path / attempt)).awaitTermination()
        assert wh.table("t").count() == grown and wh.ledger.batches().count() == batches


def rows_read(df):
    """Rows that the scans of a plan without shuffles gave, and the rows of the result."""
    found = df.collect()
    leaves = df._jdf.queryExecution().executedPlan().collectLeaves()
    return sum(leaves.apply(i).metrics().apply("numOutputRows").value() for i in range(leaves.size())), len(found)


def test_lookup_skips_by_key(spark, wh, rows):
    """Keys inside the range of every file that are not there are told by the filters: no row is read for them."""
    table = spark.range(0, 40_000, 2).withColumn("v", F.col("id") * 3)
    put(wh, "t", table, "upsert", ["id"])
    read, found = rows_read(wh.lookup("t", [(20_001,), (777,), (39_999,)]))
    assert (read, found) == (0, 0)
    read, found = rows_read(wh.lookup("t", [(20_000,), (777,)]))
    assert found == 1 and read < 20_000 / 3
    put(wh, "t", spark.range(1, 40_000, 4000).withColumn("v", F.lit(-1).cast("long")), "upsert", ["id"])
    assert rows(wh.lookup("t", [(4001,), (4000,), (5,)])) == [(4000, 12000), (4001, -1)]
    assert wh.lookup("t", [(3,)]).count() == 0
    with pytest.raises(ValueError):
        wh.lookup("t", [(i,) for i in range(2000)])
    put(wh, "a", table, "append")
    with pytest.raises(ValueError):
        wh.lookup("a", [(1,)])


def test_lookup_by_two_keys_with_nulls(spark, wh, rows):
    df = spark.createDataFrame([(1, "a", 10), (1, None, 11), (None, "a", 12), (2, "b", 13)], "k int, s string, v int")
    put(wh, "t", df, "upsert", ["k", "s"])
    assert rows(wh.lookup("t", [(1, None), (None, "a"), (2, "c")])) == [(1, None, 11), (None, "a", 12)]


def test_clustered_rows_are_skipped(spark, wh, tmp_path):
    """A filter on the clustered column reads a fraction of the rows, of spread rows all of them."""
    spread = spark.range(0, 60_000, 1, 12).withColumn("day", F.expr("date_add(date'2024-01-01', cast(pmod(id * 7919, 360) as int))"))
    wanted = (F.col("day") >= F.lit("2024-05-01").cast("date")) & (F.col("day") < F.lit("2024-06-01").cast("date"))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "12")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        wh.log.commit(wh.append("clustered", spread, cluster_by="day"))
        wh.log.commit(wh.append("spread", spread))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    read, found = rows_read(wh.table("clustered").where(wanted))
    assert rows_read(wh.table("spread").where(wanted)) == (60_000, found)
    assert found > 5000 and read < 60_000 / 4


def test_first_upsert_makes_its_rows_once(spark, wh, rows):
    made = spark.sparkContext.accumulator(0)

    def seen(k):
        made.add(1)
        return k

    delta = spark.range(0, 100, 1, 4).select(F.udf(seen, "bigint")("id").alias("k"), F.lit("x").alias("v"))
    change = wh.load("t", delta, "delete_insert", ["k"])
    assert made.value == 100 and change.row_bound == 100
    wh.log.commit(change)
    assert rows(wh.table("t")) == [(i, "x") for i in sorted(range(100), key=lambda i: repr((i, "x")))]


@pytest.mark.parametrize("how", ["read", "known"])
def test_first_upsert_without_rows(spark, wh, tmp_path, rows, how):
    spark.range(4).select(F.col("id").alias("k"), F.lit("x").alias("v")).write.parquet(str(tmp_path / "in"))
    none = spark.read.parquet(str(tmp_path / "in")).where(F.col("k") > 9 if how == "read" else F.lit(False))
    wh.log.commit(wh.load("t", none, "upsert", ["k"]))
    assert wh.exists("t") and rows(wh.table("t")) == []
    wh.log.commit(wh.load("t", spark.createDataFrame([(1, "y"), (1, "z")], none.schema), "upsert", ["k"]))
    assert rows(wh.table("t")) == [(1, "z")]


def test_first_upsert_outgrows_its_buckets(spark, tmp_path, rows):
    wh = Warehouse(spark, str(tmp_path / "wh"), buckets=2, bucket_rows=10)
    wh.log.commit(wh.load("t", spark.range(100).withColumnRenamed("id", "k"), "upsert", ["k"]))
    state = wh.log.state("t")
    assert state.buckets == 16 and len({p.rpartition("/")[0] for p in state.paths}) == 1
    assert len(files.folder_names(spark, f"{wh.root}/tables/t")) == 1  # the draft is gone
    assert rows(wh.table("t")) == sorted([(i,) for i in range(100)], key=repr)
    assert rows(wh.lookup("t", [(7,), (200,)])) == [(7,)]


def test_large_first_upsert_is_laid_out_in_parts(spark, wh, rows, monkeypatch):
    """No more than a part of a large draft is shuffled at once; the table is the same."""
    from silverloom.sinks import warehouse

    monkeypatch.setattr(warehouse, "LAYOUT_ROWS", 300)
    laid, plain = [], Warehouse._write_buckets

    def write(self, some, *rest):
        laid.append(some.count())
        plain(self, some, *rest)

    monkeypatch.setattr(Warehouse, "_write_buckets", write)
    table = spark.range(1000).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    wh.log.commit(wh.load("t", table, "delete_insert", ["k"]))
    assert len(laid) == 4 and sum(laid) == 1000 and max(laid) < 400
    assert rows(wh.table("t")) == rows(table) and wh.log.state("t").row_bound == 1000
    assert len(wh.log.state("t").paths) == wh.buckets and len(files.folder_names(spark, f"{wh.root}/tables/t")) == 1
    assert rows(wh.lookup("t", [(7,), (2000,)])) == [(7, 14)]


def test_drop(spark, wh, rows):
    put(wh, "t", spark.range(5), "append")
    put(wh, "u", spark.range(2), "append")
    wh.drop("t")
    assert not wh.exists("t") and not files.exists(spark, f"{wh.root}/tables/t") and rows(wh.table("u")) == [(0,), (1,)]
    put(wh, "t", spark.range(1).withColumnRenamed("id", "k"), "append")
    assert wh.log.state("t").version == 1 and rows(wh.table("t")) == [(0,)]
