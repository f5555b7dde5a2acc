import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from silverloom.functions.keys import surrogate_key
from silverloom.plans import dims, facts  # noqa: F401
from silverloom.plans.base import MODELS, Models
from silverloom.plans.contracts import KEYED, REFERENCES

AS_OF = dt.date(2024, 3, 1)


@pytest.fixture
def build(spark):
    """A model over staging tables given as ``name=(schema, rows)``."""

    def make(model, **tables):
        def staging(name):
            schema, values = tables[name]
            return spark.createDataFrame(values, schema)

        return Models(staging, AS_OF, "boss").ref(model)

    return make


def ts(text):
    return dt.datetime.fromisoformat(text)


FILES = "Id string, ResourceFileId string, Title string, ISRC string, CreatedDate timestamp_ntz"
VIDEO = "YoutubeVideoId string, YoutubeChannelId string, Title string, Description string, PublishedAt string"
CODE = {n: "HG" + n * 32 for n in "ABCD"}


def test_all_models_are_there():
    assert len(MODELS) == 45
    assert len([m for m in MODELS if m.startswith("dim_")]) == 28
    assert set(KEYED) <= set(MODELS) and {r[0] for r in REFERENCES} | {r[2] for r in REFERENCES} <= set(MODELS)


def editing_tables():
    return {
        "editings": ("Id string, EditingFileId string", [("e1", CODE["A"]), ("e2", CODE["B"]), ("e3", CODE["C"])]),
        "resource": (
            "Id string, ResourceFileId string, ResourceType int",
            [("r1", "HGFA1", 0), ("r2", "HGFA2", 0), ("r3", "XX3", 0), ("r4", "HGFA4", 1), ("r5", "HGFA5", 0)],
        ),
        "resource_editings": (
            "Id string, EditingId string, ResourcesId string, StartTime double, EndTime double",
            [
                ("x1", "e1", "r3", 0.0, 1.0),  # filtered out before numbering
                ("x2", "e1", "r2", 2.0, 5.5),
                ("x3", "e1", "r1", 1.0, 2.0),
                ("x4", "e1", "r4", 0.5, 2.0),
                ("x5", "e2", "r1", 9.0, None),
                ("x6", "e3", "r5", 1.0, 2.0),
                ("x7", "gone", "r1", 1.0, 2.0),
            ],
        ),
    }


def test_fact_editing_numbers_after_the_filter(build, rows):
    got = build("fact_editing", **editing_tables())
    assert rows(got, "editing_id", "hg_stock_id", "position", F.col("duration").cast("double")) == [
        ("e1", "HGFA1", 1, 1.0),
        ("e1", "HGFA2", 2, 3.5),
        ("e2", "HGFA1", 1, None),
        ("e3", "HGFA5", 1, 1.0),
    ]


def test_bridge_takes_the_first_code(build, rows):
    text = f"x {CODE['A']} y {CODE['B']}"
    got = build(
        "bridge_bt_vid",
        channel_video_info=(VIDEO, [("v1", "c", "t", text, None), (" ", "c", "t", CODE["A"], None), ("v3", "c", "t", "HGSHORT", None), ("v4", "c", "t", None, None)]),
    )
    assert rows(got, "video_id", "editing_code") == [("v1", CODE["A"]), (None, CODE["A"])]


def test_dim_stock(build, rows):
    created = ts("2024-01-31 10:00:00")
    files = [
        ("1", " HGFA1 ", "a.mp3", "I1", created),
        ("2", "HGFA1", "a.wav", "I9", ts("2020-01-01")),  # wav loses though older
        ("3", "HGFA2", "b.WAV", " ", created),
        ("4", "HGFA5", None, None, created),  # null code: one of HGFA2/HGFA5 stays
        ("5", "HGFA6", "c.mp3", "I1", ts("2024-02-15")),  # same code as HGFA1, later
        ("6", "HGFA7", "d.mp3", "I7", created),
        ("7", " ", "e.mp3", "I8", created),
    ]
    got = build(
        "dim_stock",
        **editing_tables(),
        resource_file_info=(FILES, files),
        channel_video_info=(
            VIDEO,
            [("v1", "c", "t", CODE["A"], "2024-01-01 00:00:00"), ("v2", "c", "t", CODE["A"], "2024-02-20 00:00:00"), ("v3", "c", "t", CODE["C"], "2020-01-01 00:00:00")],
        ),
        resource_storage_history=("ResourceFileInfoId string, ToStatus string", [("HGFA7", "Archived"), ("HGFA7", "Archived"), ("HGFA1", "Back")]),
    )
    assert rows(got, "hg_stock_id", "name", "isrc", "resource_age_days", "status") == [
        ("HGFA1", "a.mp3", "I1", 30, "Sử dụng"),
        ("HGFA2", "b.WAV", None, 30, "Sử dụng"),
        ("HGFA7", "d.mp3", "I7", 30, "Lưu kho"),
    ]


def test_dim_stock_cold(build, rows):
    got = build(
        "dim_stock",
        **editing_tables(),
        resource_file_info=(FILES, [("4", "HGFA5", "x", "I5", ts("2024-01-01")), ("5", "HGFA1", "x", "I1", ts("2024-01-01"))]),
        channel_video_info=(VIDEO, [("v3", "c", "t", CODE["C"], "2024-01-30 23:00:00"), ("v4", "c", "t", CODE["A"], "2024-01-31 00:00:00")]),
        resource_storage_history=("ResourceFileInfoId string, ToStatus string", []),
    )
    assert rows(got, "hg_stock_id", "status") == [("HGFA1", "Sử dụng"), ("HGFA5", "Hàng nguội")]


def test_dim_stock_shuffles_uses_once(build):
    """Uses are not made distinct before their newest date is taken."""
    got = build(
        "dim_stock",
        **editing_tables(),
        resource_file_info=(FILES, [("4", "HGFA5", "x", "I5", ts("2024-01-01"))]),
        channel_video_info=(VIDEO, [("v3", "c", "t", CODE["C"], "2024-01-30 23:00:00")]),
        resource_storage_history=("ResourceFileInfoId string, ToStatus string", []),
    )
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert not [x for x in plan.split("\n") if re.search(r"Aggregate \[hg_stock_id#\d+, editing_code#\d+\]", x)]


def test_dim_isrc(build, rows):
    sale = "retailer string, iSRC string, artist string, reportingPeriod string, earnings string"
    got = build(
        "dim_isrc",
        resource_file_info=(FILES, [(str(i), f, "t", c, None) for i, (f, c) in enumerate([("s1", "A"), ("s1", "B"), ("s2", "A"), ("s2", "C"), ("s3", "D"), ("s4", " ")])]),
        sale=(sale, [("shop", c, "x", "2024-01-01", "1") for c in ("A", "C", "A")]),
        usd_rate=("record_date string, exchange_rate double", []),
    )
    assert rows(got, "hg_stock_id", "isrc") == [("s1", "A")]


def test_fact_distribution(build, rows):
    schema = "Id string, ResourceFileInfoId string, CreatedByUserId string, DepartmentData string, GroupData string, UserData string, CreatedDate timestamp_ntz"
    got = build(
        "fact_distribution",
        distribution_media_history=(schema, [("d1", "f1", "u", "1, 2,9", "", None, ts("2024-01-01")), ("d2", "f9", "u", "2", "7", "5,5", None)]),
        resource_file_info=(FILES, [("f1", "HGFA1", "t", None, None)]),
        department=("Id int, Name string", [(1, "sales"), (2, "art")]),
        groups=("Id int, Name string", [(7, "red")]),
        users=("Id int, DisplayName string", [(5, "eve")]),
    )
    assert rows(got, "distribution_id", "hg_stock_id", "department", "team", "employee") == [
        ("d1", "HGFA1", "sales, art", None, None),
        ("d2", None, "art", "red", "eve, eve"),
    ]


def test_fact_purchase_cost(build, rows):
    months = {n: None for n in range(1, 13)} | {2: "1,000 usd", 12: "-", 4: "9"}
    cost = "`Tên đối tác` string, " + ", ".join(f"`CP tháng {n}` string" for n in months) + ", `Total năm` string, _year string"
    got = build(
        "fact_purchase_cost",
        purchase_cost=(cost, [(" P ", *months.values(), "2.400", "2024"), ("Q", *months.values(), "1", "2024")]),
        partners=(
            "`Tên đối tác` string, `Tên kho trên HG Stock` string, `Ngày ký HĐ` string, `Cách tính giá` string",
            [("P", " store", "d", "m"), ("P", "store ", "d", "m"), ("P", " ", "d", "m")],
        ),
        purchased_resource=(
            "`Mã` string, `Tiêu đề` string, `Nghệ sĩ bài hát` string, Repository string",
            [("HG1", "t", "a", "store"), ("HG2", "t", "a", "store "), ("HG2", "u", "a", "store "), ("bad", "t", "a", "store")],
        ),
    )
    money = [F.col(c).cast("double") for c in ("total_cost", "additional_cost")]
    assert rows(got, "resource_id", *money, F.col("incurred_datetime").cast("string")) == [
        ("HG1", 1200.0, 4.5, "2024-04-30"),
        ("HG1", 1200.0, 500.0, "2024-02-29"),
        ("HG2", 1200.0, 4.5, "2024-04-30"),
        ("HG2", 1200.0, 500.0, "2024-02-29"),
    ]
    expected = got.where("resource_id = 'HG1'").select("cost_id", surrogate_key(F.lit("HG1"), F.lit("2024"), F.lit("4")))
    assert any(r[0] == r[1] for r in expected.collect())


def channels():
    ids = ["ok", "left", "out", "deleted", "late", "typed", "closed"]
    return {
        "channel": (
            "Id string, YoutubeChannelId string, Title string, Description string, SuspendedTimeUtc timestamp_ntz",
            [(i, "y" + i, " t ", "link", ts("2020-01-01") if i == "closed" else None) for i in ids],
        ),
        "channel_deal": (
            "Id string, ChannelId string, CmsId string, IsDeleted boolean, IsOutNet boolean, ReceiveTimeUtc timestamp_ntz, OutNetTimeUtc timestamp_ntz",
            [
                ("1", "ok", "c1", False, False, ts("2020-01-01"), None),
                ("2", "ok", "c1", False, False, ts("2021-01-01"), None),
                ("3", "left", "c2", False, False, ts("2020-01-01"), ts("2022-01-01")),
                ("4", "out", "c1", False, True, ts("2020-01-01"), None),
                ("5", "deleted", "c1", True, False, ts("2020-01-01"), None),
                ("6", "late", "c9", False, False, None, None),
                ("7", "typed", "c1", False, False, ts("2020-01-01"), None),
                ("8", "closed", "c1", False, False, ts("2020-01-01"), None),
            ],
        ),
        "channel_company": ("ChannelId string, Type int", [(i, 1 if i == "typed" else None) for i in [*ids, "ok"]]),
    }


def test_member_channels(spark, rows):
    tables = channels()
    m = Models(lambda name: spark.createDataFrame(tables[name][1], tables[name][0]), AS_OF)
    assert rows(facts.member_channels(m, "received")) == [("yleft",), ("yok",)]
    assert rows(facts.member_channels(m, "not_left")) == [("ylate",), ("yok",)]


METRIC = "YoutubeVideoId string, Date string, Views string, EstimatedRevenue string"


def test_views_and_revenue(build, rows):
    tables = channels() | {
        "channel_video_info": (VIDEO, [("v1", "yok", "t", "", None), ("v2", "yout", "t", "", None), (" ", "yok", "t", "", None)]),
        "channel_video_metric": (
            METRIC,
            [("v1", "2024-01-01", "0", "5"), ("v1", "2024-01-02", "4", "5"), ("v1", None, "4", "5"), ("v2", "2024-01-01", "4", "5"), (" ", "2024-01-01", "4", "5"), (None, "2024-01-01", "4", "5")],
        ),
        "usd_rate": ("record_date string, exchange_rate double", [("2024-01-01", 25.0), ("2024-01-01", 24.0)]),
    }
    views = build("fact_view_yt", **tables)
    assert rows(views, "video_id", F.col("view_count").cast("int"), F.col("rpm").cast("double")) == [("v1", 0, None), ("v1", 4, 1.25)]
    revenue = build("fact_revenue_yt", **tables)
    assert rows(revenue, F.col("revenue_date").cast("string"), "exchange_rate") == [("2024-01-01 00:00:00", 24.0), ("2024-01-02 00:00:00", None)]


def test_revenue_by_resources(build, rows):
    got = build(
        "fact_revenue_by_resources",
        **editing_tables(),
        **channels(),
        channel_video_info=(VIDEO, [("v1", "yok", "t", CODE["A"], None), ("v2", "yok", "t", CODE["B"], None), ("v3", "yout", "t", CODE["A"], None)]),
        channel_video_metric=(METRIC, [("v1", "2024-01-01", "100", "10"), ("v2", "2024-01-02", "7", "3.5"), ("v3", "2024-01-01", "1", "1")]),
        usd_rate=("record_date string, exchange_rate double", [("2024-01-01", 24.0)]),
    )
    money = [F.col(c).cast("double") for c in ("revenue_amount", "view")]
    assert rows(got, "video_id", "resource_id", *money, "exchange_rate") == [
        ("v1", "HGFA1", 7.0, 70.0, 24.0),
        ("v1", "HGFA2", 3.0, 30.0, 24.0),
        ("v2", "HGFA1", 3.5, 7.0, None),
    ]


def test_music_evaluation(build, rows):
    got = build(
        "fact_music_evaluation",
        review=(
            "Id string, CreatedByUserId string, RecordingSoundVersionId string, Concluding string, Rating string, Comment string, CreatedDate timestamp_ntz",
            [("r1", "boss", "v2", "ok", "8.5", '{"Comment": "good"}', None), ("r2", "eve", "v1", "no", "3", "plain", None), ("r3", "eve", "v9", "no", "3", None, None)],
        ),
        recording_sound_version=(
            "Id string, RecordingSoundId string, CreatedDate timestamp_ntz",
            [("v1", "s", ts("2024-01-02")), ("v2", "s", ts("2024-01-01")), ("v3", "s", None)],
        ),
        recording_sound=("Id string, SongCode string", [("s", "SONG")]),
        version_needs_comment=("Id string, RecordingSoundVersionId string", [("n1", "v2"), ("n2", "v2")]),
        user_comment_version=("VersionNeedsCommentId string, Rating int", [("n1", 1), ("n2", 2), ("n2", None), ("n9", 5)]),
    )
    scores = [F.col(c).cast("double") for c in ("internal_score", "marketing_score")]
    assert rows(got, "resource_id", "version", *scores, "comment") == [
        ("SONG", 1, 8.5, 1.5, "good"),
        ("SONG", 2, None, None, "plain"),
        (None, None, None, None, None),
    ]


def test_dim_channel(build, rows):
    got = build(
        "dim_channel",
        **channels(),
        channel_user=(
            "ChannelId string, UserId string, IsDeleted boolean, CreatedTimeUtc timestamp_ntz",
            [("ok", "u1", False, ts("2024-01-01")), ("ok", "u2", False, None), ("left", "u1", False, ts("2024-01-01")), ("left", "u2", True, ts("2024-05-01"))],
        ),
        user=("Id string, FullName string", [("u1", "Ann"), ("u2", "Bo")]),
        cms=("Id string, NetworkId string", [("c1", "n1"), ("c2", "n9")]),
        network=("Id string, Name string", [("n1", "net")]),
        channel_project=("ChannelId string, ProjectId string", [("ok", "p1"), ("ok", "p2")]),
        project=("Id string, CompanyId string, ParentId string, ProjectName string", [("p1", "co", None, "x"), ("p2", "co", "p1", "y")]),
    )
    assert got.count() == 7
    assert rows(got.where("channel_id in ('yok', 'yleft', 'yout')"), "channel_id", "channel_name", "employee_name", "project_id", "network_id") == [
        ("yleft", "t", "Ann", None, None),
        ("yok", "t", "Bo", "p1", "n1"),
        ("yout", "t", None, None, None),
    ]


def test_dim_resource_key_is_the_song(build, rows):
    schema = (
        "id long, _source_id string, subgenre_id long, song_name string, name string, review_score string, review_price string, review_date string, "
        "detail_line_id long, state string, produce_state int, sale_order_id long, purchase_order_line_id long"
    )
    songs = [(i, "x_music_song", 1, "n", "c", "7.456", "bad", "2024-01-01", None, s, p, None, None) for i, (s, p) in enumerate([("approved", 6), ("approved", 1), ("approved", None), ("draft", 1), ("x", 6)])]
    got = build("dim_resource", x_music_song=(schema, songs))
    assert got.select("dim_resource_sk").distinct().count() == 5
    assert rows(got, "resource_id", "status", F.col("acceptance_score").cast("double"), "acceptance_cost") == [
        ("0", "Không nghiệm thu", 7.46, None),
        ("1", "Đã nghiệm thu", 7.46, None),
        ("2", None, 7.46, None),
        ("3", "Đang sản xuất", 7.46, None),
        ("4", None, 7.46, None),
    ]


def test_stored_models_are_built_once_and_read_back(spark, tmp_path):
    """A model that reads others reads their tables, not their staging tables."""
    from silverloom.plans.materialise import StoredModels
    from silverloom.registered.base import Tables
    from silverloom.registered.models import AS_OF as DAY
    from silverloom.registered.models import REVIEWER, models_over
    from silverloom.sinks.warehouse import Warehouse

    over = models_over(Tables(spark, "/root/testdata/sf0.001"))
    read = []

    def staging(name):
        read.append(name)
        return over.staging(name)

    m = StoredModels(Warehouse(spark, str(tmp_path / "wh"), buckets=2), staging, DAY, REVIEWER)
    m.build(["dim_video", "bridge_bt_vid", "fact_editing", "dim_usd"])
    m.build(["fact_editing"])
    assert read.count("resource_editings") == 1
    own = {
        "dim_stock": {"resource_file_info", "resource_storage_history"},
        "fact_revenue_by_resources": {"channel", "channel_company", "channel_deal", "channel_video_info", "channel_video_metric"},
    }
    for name, tables in own.items():
        read.clear()
        MODELS[name](m)
        assert set(read) == tables
    assert m.ref("fact_editing").inputFiles()[0].count("/tables/fact_editing/") == 1


def test_stored_models_are_stored_several_at_a_time(spark, tmp_path, monkeypatch):
    """Two models of one list meet while they are stored; each is stored once, also one that others read; after an error a model can be tried again."""
    import threading

    from silverloom.plans import materialise
    from silverloom.registered.base import Tables
    from silverloom.registered.models import AS_OF as DAY
    from silverloom.registered.models import REVIEWER, models_over
    from silverloom.sinks.warehouse import Warehouse

    over = models_over(Tables(spark, "/root/testdata/sf0.001"))
    both, kept, plain_keep = threading.Barrier(2, timeout=60), [], materialise.keep

    def keep(wh, name, df):
        kept.append(name)
        if name in ("dim_usd", "dim_ar"):
            both.wait()
        if name == "dim_net" and kept.count(name) == 1:
            raise RuntimeError("once")
        return plain_keep(wh, name, df)

    monkeypatch.setattr(materialise, "keep", keep)
    m = materialise.StoredModels(Warehouse(spark, str(tmp_path / "wh"), buckets=2), over.staging, DAY, REVIEWER)
    names = ["dim_stock", "fact_editing", "dim_usd", "dim_ar", "dim_video", "fact_distribution", "fact_label_operation"]
    m.build(names)
    assert sorted(kept) == sorted([*names, "bridge_bt_vid"])
    for name in names:
        assert m.ref(name).count() == over.ref(name).count()
    assert sorted(r[0] for r in m.wh.ledger.last_successes().select("source_id").collect()) == ["model-fact_distribution", "model-fact_label_operation"]
    with pytest.raises(RuntimeError, match="once"):
        m.build(["dim_net"])
    assert m.ref("dim_net").count() == over.ref("dim_net").count()


def test_kinds_of_facts():
    from silverloom.plans.base import KINDS

    assert KINDS["dim_ar"].kept == KINDS["fact_po_detail"].kept == KINDS["fact_revenue_yt"].kept == "table"
    assert KINDS["fact_revenue_distro"].kept == "incremental" and KINDS["fact_revenue_distro"].newer_by == "revenue_month"


def test_fact_distribution_shuffles(spark):
    from silverloom.registered.base import Tables
    from silverloom.registered.models import models_over

    small = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = models_over(Tables(spark, "/root/testdata/sf0.001")).ref("fact_distribution")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", small)
    assert plan.count("Exchange hashpartitioning") <= 8


def test_models_state_what_they_read(spark):
    from silverloom.plans.base import READS
    from silverloom.registered.base import Tables
    from silverloom.registered.models import models_over

    t, asked = Tables(spark, "/root/testdata/sf0.001"), set()
    asking, plain = models_over(t), models_over(t)
    asking.ref = lambda name: asked.add(name) or plain.ref(name)
    for name, made in MODELS.items():
        asked.clear()
        made(asking)
        assert asked == set(READS.get(name, ())), name


def test_key_counts(spark):
    from silverloom.plans.contracts import key_counts

    a, b = "0123456789abcdef" * 2, "f" * 32
    keys = [a, a, a.upper(), a[:-1], a + "0", b, "g" * 32, "g" * 32, "", "", "ÿ" * 16, None, None, None]
    assert key_counts(spark.createDataFrame([(k,) for k in keys], "k string"), "k") == (3, 3)
    assert key_counts(spark.createDataFrame([], "k string"), "k") == (0, 0)
    assert key_counts(spark.createDataFrame([(1,), (1,), (2,)], "k int"), "k") == (1, 0)


def test_temporary_tables_go_after_their_last_use(spark, tmp_path, monkeypatch):
    """The key report keeps a stored model only until it is counted and those that read it are stored."""
    import os
    import re

    from silverloom.plans import contracts, materialise
    from silverloom.plans.materialise import StoredModels
    from silverloom.registered.base import Tables
    from silverloom.registered.models import AS_OF as DAY
    from silverloom.registered.models import REVIEWER, models_over
    from silverloom.sinks.warehouse import Warehouse

    monkeypatch.setattr(materialise, "AT_ONCE", 1)
    over = models_over(Tables(spark, "/root/testdata/sf0.001"))
    names = ["fact_editing", "dim_stock", "fact_distribution", "dim_video", "dim_isrc", "dim_ar"]
    whole = sorted(map(tuple, contracts.key_report(over, names).collect()))
    place = tmp_path / "wh"
    m = StoredModels(Warehouse(spark, str(place), buckets=2), over.staging, DAY, REVIEWER, temporary=True)
    there, kept, stored = {}, [], m.ref

    def ref(name):
        kept.append(name)
        return stored(name)

    def use(name, rows):
        assert re.search(f"/tables/{name}/", rows.inputFiles()[0])
        there[name] = set(os.listdir(place / "tables"))
        return contracts.key_counts(rows, f"{name}_sk")

    m.ref = ref
    found = m.each(names, use)
    assert sorted((n, c, f) for n in names for c, f in zip(("unique", "not_null"), found[n])) == whole
    assert set(kept) == {*names, "bridge_bt_vid", "fact_revenue_distro", "dim_usd"}
    assert not os.listdir(place / "tables") and not os.listdir(place / "commits")
    assert there["dim_stock"] == {"fact_editing", "bridge_bt_vid", "dim_video", "dim_stock"}
    assert there["fact_distribution"] == {"fact_distribution", "dim_video"} and there["dim_ar"] == {"dim_ar"}
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"
    assert m.ref("dim_isrc").count() == over.ref("dim_isrc").count()  # stored again


def test_shuffles_go_with_their_query(spark, tmp_path):
    import time

    from silverloom.session import shuffles_removed

    blocks = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def held():
        found = blocks.getAllFiles()
        return {f.getName() for f in map(found.apply, range(found.size())) if f.getName().startswith("shuffle_")}

    def store(name):
        before = held()
        spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count().write.parquet(str(tmp_path / name))
        return before

    before = store("kept")
    assert held() - before
    with shuffles_removed(spark):
        before = store("removed")
    for _ in range(50):
        if not held() - before:
            break
        time.sleep(0.1)
    assert not held() - before
