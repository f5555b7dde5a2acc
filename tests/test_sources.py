import json

import pytest
from pyspark.sql import functions as F

from silverloom.sources import change, csv, documents, grid, staging, tables
from silverloom.sources.spec import SourceSpec


def test_csv_lines(spark, tmp_path, rows):
    path = tmp_path / "in.csv"
    path.write_text(
        'a, b ,c\n1,2,3\n4,5\n6,7,8,9\n10,11,12,\n"x,y","q ""z""",NA\n"a,b,c,d,e",,\n"only, short"\n', encoding="utf-8"
    )
    got = csv.read_csv(spark, str(path))
    assert got.columns == ["a", "b", "c"]
    assert rows(got) == sorted(
        [("1", "2", "3"), ("4", "5", None), ("x,y", 'q "z"', None), ("a,b,c,d,e", None, None), ("only, short", None, None)], key=repr
    )


def test_csv_separator(spark, tmp_path, rows):
    path = tmp_path / "in.csv"
    path.write_text("a|b\n1,5|2\n1|2|3\n", encoding="utf-8")
    assert rows(csv.read_csv(spark, str(path), sep="|")) == [("1,5", "2")]


def _csv_text(seed, n, breaks=True, end="\n"):
    """Lines with quoted separators, quotes and line breaks, empty lines, damaged lines, words for no value."""
    import random

    draw, out = random.Random(seed), [" id , note,other"]
    for i in range(n):
        note = draw.choice(["plain", "", "NA", 'say ""so""', "a, b", "é" * draw.randint(1, 30), " padded "])
        if breaks and draw.random() < 0.2:
            note += draw.choice([f"{end}", f"{end}{end}", f' x{end}, ""y""{end}', f"{end},,{end}"])
        note = f'"{note}"' if draw.random() < 0.9 or any(c in note for c in ',"\n\r') else note
        line = f"{i},{note},{draw.choice(['1', '', 'null', 'z'])}"
        out.append(line + draw.choice(["", "", "", ",extra", ",", f"{end}"]) if draw.random() < 0.3 else line)
    return end.join(out) + draw.choice(["", end])


@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_csv_in_splits_equals_one_task(spark, tmp_path, rows, end):
    """Line breaks in quotes, at any place of a split: the same rows as a parser that starts at the top of the file."""
    for seed in range(4):
        path = tmp_path / f"{seed}{len(end)}.csv"
        path.write_bytes(_csv_text(seed, 400, end=end).encode())
        want = rows(csv.read_csv(spark, str(path), split_bytes=1 << 30))
        before = spark.conf.get("spark.sql.files.maxPartitionBytes")
        try:
            for size in (97, 1000):
                spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
                got = csv.read_csv(spark, str(path), split_bytes=1)
                assert csv._numbered_lines(spark, [str(path)]).rdd.getNumPartitions() > 5
                assert rows(got) == want and got.columns == ["id", "note", "other"]
        finally:
            spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_csv_split_kinds(spark, tmp_path, rows, monkeypatch):
    """No line breaks in quotes: plain lines; a quote inside a field or an open one: the file in one task."""
    texts = {
        "lines": _csv_text(1, 50, breaks=False),
        "joined": _csv_text(2, 50),
        "stray": 'id,note,other\n1,5" pipe,x\n2,"a\nb",y\n3,c" d" e,z\n',
        "stray2": 'id,note,other\n1,"a\nb" c,x\n2,d,"e\nf"\n',
        "open": 'id,note,other\n1,a,b\n2,"never closed,c\n3,d,e\n',
    }
    whole = []
    plain = csv._read_alike
    monkeypatch.setattr(csv, "_read_alike", lambda s, paths, h, o, n: (whole.extend(paths if o["multiLine"] == "true" else []), plain(s, paths, h, o, n))[1])
    for name, text in texts.items():
        path = tmp_path / f"{name}.csv"
        path.write_text(text, encoding="utf-8")
        want = rows(plain(spark, [str(path)], ["id", "note", "other"], {"header": "true", "sep": ",", "quote": '"', "escape": '"', "multiLine": "true"}, csv.NULL_WORDS))
        whole.clear()
        assert rows(csv.read_csv(spark, str(path), split_bytes=1)) == want, name
        assert bool(whole) == (name in ("stray", "stray2", "open")), name


def test_csv_headers_of_many_files(spark, tmp_path, rows, monkeypatch):
    """First lines of many files come from one scan; two orders of columns and an empty file among them."""
    monkeypatch.setattr(csv, "_HEADERS_ONE_BY_ONE", 4)
    (tmp_path / "in put").mkdir()
    for i in range(12):
        text = f'a,b\n{i},"x\ny"\n' if i % 3 else f"\n b , a\nz,{i}\n"
        (tmp_path / "in put" / f"{i}.csv").write_text(text if i != 5 else "", encoding="utf-8")
    read = []
    plain = type(spark.read).csv
    monkeypatch.setattr(type(spark.read), "csv", lambda self, path, *a, **k: (read.append(path), plain(self, path, *a, **k))[1])
    got = csv.read_csv(spark, str(tmp_path / "in put"))
    assert got.columns == ["b", "a"]
    assert rows(got, "a", "b") == sorted([(str(i), "x\ny") if i % 3 else (str(i), "z") for i in range(12) if i != 5], key=repr)
    assert len([p for p in read if isinstance(p, str)]) == 2


def test_csv_stream_equals_batch(spark, tmp_path, rows):
    (tmp_path / "in").mkdir()
    for i in range(5):
        (tmp_path / "in" / f"{i}.csv").write_text(_csv_text(i, 40), encoding="utf-8")
    stream = csv.stream_csv(spark, str(tmp_path / "in"), files_per_trigger=2)
    assert stream.isStreaming
    sizes = []
    run = stream.writeStream.foreachBatch(lambda df, n: (sizes.append(n), df.write.mode("append").parquet(str(tmp_path / "out")))).option(
        "checkpointLocation", str(tmp_path / "progress")).trigger(availableNow=True).start()
    run.awaitTermination()
    assert len(sizes) == 3
    assert rows(spark.read.parquet(str(tmp_path / "out"))) == rows(csv.read_csv(spark, str(tmp_path / "in")))
    (tmp_path / "in" / "9.csv").write_text("other,note,id\n", encoding="utf-8")
    with pytest.raises(ValueError, match="2 headers"):
        csv.stream_csv(spark, str(tmp_path / "in"))


def test_document_stream_equals_batch(spark, tmp_path, rows):
    (tmp_path / "in").mkdir()
    for i in range(4):
        lines = [{"_id": f"{i}-{k}", "_source": {"Date": f"2024-01-{10 + k:02d}", "who": {"name": "x"}, "tags": ["a", str(k)]}} for k in range(6)]
        bad = '{"_id": "broken", "_source": {"Date"'
        (tmp_path / "in" / f"{i}.json").write_text("\n".join([*map(json.dumps, lines), bad]), encoding="utf-8")
    shape = "Date date, who struct<name: string>, tags array<string>"
    stream = documents.stream_documents(spark, str(tmp_path / "in"), shape, "Date", "2024-01-12", files_per_trigger=1)
    stream.writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "c")).trigger(
        availableNow=True).start().awaitTermination()
    want = documents.read_documents(spark, str(tmp_path / "in"), shape, "Date", "2024-01-12")
    assert rows(spark.read.schema(want.schema).parquet(str(tmp_path / "out"))) == rows(want) and want.count() == 16


def test_csv_folder(spark, tmp_path, rows):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "1.csv").write_text('a,b\n1,"two\nlines"\n', encoding="utf-8")
    (tmp_path / "in" / "2.csv").write_text(" b , a\nx,2\n", encoding="utf-8")
    (tmp_path / "in" / "_ignored.csv").write_text("z\n1\n", encoding="utf-8")
    assert rows(csv.read_csv(spark, str(tmp_path / "in"))) == [("1", "two\nlines"), ("2", "x")]
    (tmp_path / "in" / "3.csv").write_text("a,c\n1,2\n", encoding="utf-8")
    with pytest.raises(ValueError, match="3.csv"):
        csv.read_csv(spark, str(tmp_path / "in"))
    with pytest.raises(FileNotFoundError):
        csv.read_csv(spark, str(tmp_path / "none*"))


def test_unique_names():
    assert grid.unique_names(["a", "a", "a_1", "", "col_3", "a"]) == ["a", "a_1", "a_1_1", "col_3", "col_3_1", "a_2"]


def test_documents(spark, tmp_path, rows):
    docs = [
        {"_id": "a", "_source": {"Date": "2024-01-01T00:00:00", "x": {"y": 1}, "tags": ["é", "b"]}},
        {"_id": "b", "_source": {"Date": "2023-01-01T00:00:00", "x": {"y": 2}, "tags": []}},
        {"_id": "c", "_source": {"Date": "2024-05-01T00:00:00", "tags": None}},
    ]
    path = tmp_path / "dump.jsonl"
    path.write_text("\n".join(json.dumps(d, ensure_ascii=False) for d in docs), encoding="utf-8")
    shape = "Date timestamp_ntz, x struct<y: bigint>, tags array<string>"
    got = documents.read_documents(spark, str(path), shape, "Date", "2024-01-01")
    assert got.columns == ["Date", "x.y", "tags", "_es_id"]
    assert rows(got, "`x.y`", "tags", "_es_id") == [(1, '["é","b"]', "a"), (None, None, "c")]


def test_rates(spark, rows):
    docs = spark.createDataFrame(
        [("2024-01-01", '{"usd": {"vnd": 24000.5}}'), ("2024-01-02", '{"usd": {}}'), ("2024-01-03", "broken"), ("2024-01-04", '{"usd": {"vnd": 0}}'), ("2023-12-31", '{"usd": {"vnd": 1}}')],
        "day string, doc string",
    )
    assert rows(documents.read_rates(docs, "2024-01-01", "2024-02-01", "vnd")) == [("2024-01-01", 24000.5)]


GRID = "file string, sheet string, row_no int, cells array<string>"


def test_fixed_columns(spark, rows):
    df = spark.createDataFrame(
        [
            ("f", "Cost 2023", 1, ["title"]),
            ("f", "Cost 2023", 2, ["x", " a\nb ", "c", "c"]),
            ("f", "Cost 2023", 3, ["1", "2", "3", "4"]),
            ("f", "Cost 2023", 4, ["9", " ", "", "9"]),
            ("f", "Cost 2023", 5, ["1", "5"]),
            ("f", "Cost none", 2, ["c"]),
            ("f", "Cost none", 3, ["7", "8"]),
            ("f", "Cost short", 1, ["c"]),
            ("f", "Other 2023", 2, ["c"]),
            ("f", "Other 2023", 3, ["z"]),
        ],
        GRID,
    )
    got = grid.promote_columns(grid.select_tabs(df, pattern="Cost"), ["a b", "c", "no"], header_row=2)
    assert rows(got) == [("", "7", "", ""), ("2", "3", "", "2023"), ("5", "", "", "2023")]
    with pytest.raises(ValueError):
        grid.select_tabs(df)


def test_full_header(spark, rows):
    df = spark.createDataFrame([("f", "T", 2, ["a", "", "a", "b\nc"]), ("f", "T", 3, ["1"]), ("f", "T", 4, list("12345"))], GRID)
    got = grid.promote_header(grid.select_tabs(df, name="T").drop("_year"), header_row=2)
    assert got.columns == ["a", "col_1", "a_1", "b c"]
    assert rows(got) == [("1", "", "", ""), ("1", "2", "3", "4")]


def test_marker_header(spark, rows):
    df = spark.createDataFrame(
        [
            ("one.v2.xlsx", "s", 1, ["junk", "Mã phụ"]),
            ("one.v2.xlsx", "s", 3, ["TIÊU ĐỀ", None, " MÃ "]),
            ("one.v2.xlsx", "s", 4, [" t ", "x", "m1"]),
            ("one.v2.xlsx", "s", 5, [" ", "x"]),
            ("one.v2.xlsx", "s", 6, ["mã", "x", "again"]),
            ("two.xlsx", "s", 1, ["nothing"]),
            ("two.xlsx", "s", 2, ["a", "b"]),
        ],
        GRID,
    )
    got = grid.promote_by_marker(df, "mã", ["Mã", "Tiêu đề", "Nghệ sĩ"])
    assert rows(got) == [("again", "mã", "", "one.v2"), ("m1", "t", "", "one.v2")]


def test_jdbc_options():
    got = tables.jdbc_options("jdbc:x", query="select 1", partition_column="id", lower=0, upper=9, partitions=3, user="u")
    assert got["dbtable"] == "(select 1) source_query" and got["numPartitions"] == "3" and got["user"] == "u"
    assert tables.jdbc_options("jdbc:x", table="t") == {"url": "jdbc:x", "fetchsize": "50000", "dbtable": "t"}
    assert tables.jdbc_options("jdbc:x", query="select 1")["query"] == "select 1"
    for wrong in ({}, {"table": "t", "query": "q"}, {"table": "t", "partitions": 3}):
        with pytest.raises(ValueError):
            tables.jdbc_options("jdbc:x", **wrong)
    assert tables.quoted_table("dbo", "T", "sqlserver") == "dbo.[T]" and tables.quoted_table("public", "t") == 'public."t"'


def test_filters_reach_the_scan(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.sql("select id, cast('2024-01-01' as timestamp_ntz) as at, 'x' as wide from range(5)").write.parquet(path)
    spec = SourceSpec("t", lambda s: s.read.parquet(path), columns=("id", "at"), where="id > 2", month="2024-01", watermark_column="at")
    df = tables.newer_than(tables.narrow(spec.read(spark), spec), "at", "2023-06-01 00:00:00")
    plan = df._jdf.queryExecution().executedPlan().toString()
    pushed = plan.split("PushedFilters: [")[1]
    assert "GreaterThan(id,2)" in pushed and "GreaterThanOrEqual(at," in pushed and "LessThan(at," in pushed
    assert "wide" not in plan.split("ReadSchema")[1]


def test_fingerprint(spark):
    a = spark.createDataFrame([(1, "x"), (2, None), (None, "2")], "n int, s string")
    assert change.fingerprint(a) == change.fingerprint(a.orderBy(F.desc("n")).repartition(3))
    moved = spark.createDataFrame([(1, "x"), (None, "2"), (2, "")], "n int, s string")
    assert change.fingerprint(a) != change.fingerprint(moved)
    assert change.fingerprint(a) != change.fingerprint(a.unionAll(a))
    assert change.fingerprint(a.limit(0)) == change.fingerprint(a.limit(0))


def test_watermark_change(spark):
    df = spark.sql("select timestamp_ntz'2024-01-02 00:00:00' as at")
    assert change.has_newer(df, "at", None) and change.has_newer(df, "at", "2024-01-01")
    assert not change.has_newer(df, "at", "2024-01-02 00:00:00")
    assert not change.has_newer(df.where("at is null"), "at", None)


def test_staging_projection(spark):
    raw = spark.createDataFrame([(1, 2, 3, (4, "é"), [5])], "a int, b int, c int, d struct<x: int, y: string>, e array<int>").toDF(
        "n", " n", "\n", "d", "e"
    )
    import datetime as dt

    got = staging.stage(staging.mark_source(raw, "src", "db", "sheet"), "b1", dt.datetime(2024, 1, 1))
    assert got.columns == ["n", "n_1", "col_2", "d", "e", "_source_id", "_source_connection", "_source_sheet", "_batch_id", "_loaded_at"]
    assert got.select("d", "e").first() == ('{"x":4,"y":"é"}', "[5]")
    assert staging.map_fields(raw, {"d": "doc", "zz": "none"}).columns == ["doc"]


def _versions(spark, seed=5):
    import random

    draw = random.Random(seed)
    old = [(draw.choice([None, *range(-300, 5000)]), draw.choice("abc")) for _ in range(1500)]
    new = [r for r in old if draw.random() > 0.01] + [(draw.randint(0, 90), "new"), (None, "new"), (9000, "far"), old[0]]
    return old, new, [spark.createDataFrame(x, "k long, v string") for x in (old, new)]


@pytest.mark.parametrize("leaf, fan, levels", [(1, 2, 3), (64, 16, 4), (64, 4, 1), (10_000, 16, 2)])
def test_changed_ranges(spark, rows, leaf, fan, levels):
    """Exactly the leaves whose rows differ; the rows that differ, with their copies."""
    from collections import Counter

    old, new, (a, b) = _versions(spark)
    trees = [change.fingerprint_tree(df, "k", leaf, fan, levels) for df in (a, b)]
    assert trees[0].where("level = 0").agg(F.sum("n")).first()[0] == trees[0].where(f"level = {levels - 1}").agg(F.sum("n")).first()[0] == 1500
    ranges = change.changed_ranges(*trees, leaf, fan, levels)
    leaf_of = lambda k: None if k is None else k // leaf
    less, more = Counter(old) - Counter(new), Counter(new) - Counter(old)
    count = lambda side, n: sum(leaf_of(k) == n for k, _ in side)
    touched = {leaf_of(k) for k, _ in less | more}
    want = [(None if n is None else n * leaf, None if n is None else n * leaf + leaf - 1, count(old, n), count(new, n)) for n in touched]
    assert rows(ranges) == sorted(want, key=repr)
    found = change.changed_rows(a, b, "k", ranges, leaf)
    want = [(*r, "removed", n) for r, n in less.items()] + [(*r, "added", n) for r, n in more.items()]
    assert rows(found) == sorted(want, key=repr)


def test_no_changed_ranges(spark):
    _, _, (a, _) = _versions(spark)
    same = [change.fingerprint_tree(df, "k") for df in (a, a.repartition(7))]
    assert change.changed_ranges(*same).count() == 0
    empty = change.fingerprint_tree(a.limit(0), "k")
    assert change.changed_ranges(empty, empty).count() == 0 and change.changed_ranges(empty, same[0]).count() == same[0].where("level = 0").count()
