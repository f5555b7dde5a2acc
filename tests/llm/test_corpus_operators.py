"""Operators over whole tables: near duplicates, mixing, packing and the pipeline."""

import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from silverloom.llm import components, mixing, packing, simhash
from silverloom.llm.registry import load

from .cases import FOLDER, ROWS, documents, empty, odd

QUERIES, ORACLES = load()


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_against_sql(spark, name):
    from tools.compare import rows_of

    con = duckdb.connect()
    for t in ("documents", "benchmark", "labels"):
        con.execute(f"create view {t} as select * from read_parquet('{FOLDER}/{t}.parquet')")
    cursor = con.execute(ORACLES[name])
    names = [d[0] for d in cursor.description]
    df = QUERIES[name](spark, FOLDER)
    assert sorted(names) == sorted(df.columns)
    assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == rows_of(names, cursor.fetchall())


# Near duplicates


def classes(marks, radius):
    """Component number of each fingerprint, by comparing all."""
    marks = sorted(set(marks))
    parent = {m: m for m in marks}

    def root(m):
        while parent[m] != m:
            m = parent[m]
        return m

    full = (1 << 64) - 1
    for i, a in enumerate(marks):
        for b in marks[i + 1 :]:
            if ((a ^ b) & full).bit_count() <= radius:
                parent[max(root(a), root(b))] = min(root(a), root(b))
    return {m: root(m) for m in marks}


def test_linked_values():
    rng = np.random.default_rng(5)
    for radius in (0, 1, 2, 3):
        base = [int(x) for x in rng.integers(-(2**63), 2**63 - 1, 12)]
        values = sorted({b ^ int(sum(1 << int(p) for p in rng.integers(0, 63, rng.integers(0, 5)))) for b in base for _ in range(12)})
        want = classes(values, radius)
        for block in (1, 7, 64, 4096):
            got = {v: v for v in values}
            links = [(simhash._signed(a), simhash._signed(b)) for a, b in simhash.linked(values, radius, block)]
            groups = defaultdict(set)
            for v in values:
                groups[next((b for a, b in links if a == v), v)].add(v)
            assert sorted(map(sorted, groups.values())) == sorted(map(sorted, _by(want).values())), (radius, block, got)


def _by(roots):
    out = defaultdict(set)
    for v, r in roots.items():
        out[r].add(v)
    return out


@pytest.mark.parametrize("group_rows", [4096, 8])
def test_links_with_crowded_groups(spark, group_rows):
    """Many values in one group are dealt out again on finer masks and lose no link."""
    rng = np.random.default_rng(6)
    values = sorted({int(sum(1 << int(p) for p in rng.integers(0, 62, k % 6))) for k in range(400)})
    df = spark.createDataFrame([(v,) for v in values], "fp long")
    found = components.components(simhash.links(df, 2, group_rows)).collect()
    got = {v: v for v in values} | {r["node"]: r["root"] for r in found}
    assert sorted(map(sorted, _by(got).values())) == sorted(map(sorted, _by(classes(values, 2)).values()))


def test_components_of_chain_and_star(spark):
    links = [(i, i + 1) for i in range(60)] + [(100, 200 + i) for i in range(50)] + [(7, 7), (900, 900)]
    got = dict(components.components(spark.createDataFrame(links, "a long, b long")).collect())
    assert all(got[i] == 0 for i in range(61)) and all(got[200 + i] == 100 for i in range(50)) and got[900] == 900
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


def expected_components(rows):
    marks = [simhash.fingerprint(t) for _, t in rows]
    roots = classes(marks, simhash.RADIUS)
    least = {}
    for (i, _), m in zip(rows, marks):
        r = roots[m]
        least[r] = i if least.get(r) is None else least[r] if i is None else min(i, least[r])
    return sorted(((i, m, least[roots[m]]) for (i, _), m in zip(rows, marks)), key=repr)


def test_near_duplicates(spark):
    for docs in (documents(spark), odd(spark)):
        got = simhash.near_duplicates(docs).select("doc_id", "fp", "component_id").collect()
        assert sorted((tuple(r) for r in got), key=repr) == expected_components([(r["doc_id"], r["text"]) for r in docs.collect()])
    assert simhash.near_duplicates(empty(spark)).count() == 0


def test_fingerprint_by_hand():
    import xxhash

    text = "A b\tC  d\nb C"
    words = ["a", "b", "c", "d", "b", "c"]
    hashes = [xxhash.xxh64_intdigest(" ".join(words[i : i + 3]), 42) for i in range(4)]
    want = sum(1 << p for p in range(64) if 2 * sum(h >> p & 1 for h in hashes) > 4)
    assert simhash.fingerprint(text) & (1 << 64) - 1 == want
    assert simhash.fingerprint(None) == simhash.fingerprint(" \n") == 0
    assert simhash.fingerprint("Two words") & (1 << 64) - 1 == xxhash.xxh64_intdigest("two words", 42)


def test_keep_one(spark):
    docs = odd(spark)
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    rows = [(r["doc_id"], r["text"]) for r in kept.collect()]
    marks = [simhash.fingerprint(t) for _, t in rows]
    assert len(set(classes(marks, 2).values())) == len(rows) == len(set(classes([simhash.fingerprint(r[1]) for r in ROWS], 2).values()))
    assert simhash.keep_one(empty(spark)).count() == 0


# Mixing


def goal(sizes, weights=(5, 2, 1), repeats=3):
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    fixed, total = {}, sum(sizes.values())
    while True:
        rest = [s for s in names if s not in fixed]
        left = total - sum(fixed.values())
        share = {s: left * weight[s] / sum(weight[x] for x in rest) for s in rest}
        over = [s for s in rest if share[s] > repeats * sizes[s]]
        if not over:
            return fixed | share
        fixed |= {s: float(repeats * sizes[s]) for s in over}


def test_targets(spark):
    rng = np.random.default_rng(7)
    for _ in range(4):
        sizes = {f"s{i}": int(x) for i, x in enumerate(10 ** rng.uniform(0, 5, rng.integers(1, 12)))} | {None: 5, "": 0, "é": 70, "Z": 1}
        got = mixing.targets(spark.createDataFrame(list(sizes.items()), "source string, source_size long"))
        assert {r["source"]: r["target"] for r in got.collect()} == pytest.approx(goal(sizes))


def test_flight_keeps_totals():
    rng = np.random.default_rng(8)
    for n in (1, 2, 3, 50, 400):
        size, part = rng.integers(1, 500, n), np.full(n, 0.37)
        moved = mixing.flight(size, part, 1, land=False)
        open_ = (moved > 0) & (moved < 1)
        assert open_.sum() <= 2 and (moved >= 0).all() and (moved <= 1).all()
        assert moved.sum() == pytest.approx(part.sum()) and (moved * size).sum() == pytest.approx((part * size).sum())
        landed = mixing.flight(size, part, 1, land=True)
        assert set(landed) <= {0.0, 1.0}
    assert set(mixing.flight(np.full(9, 4), np.full(9, 1 / 3), 5, land=True)) <= {0.0, 1.0}
    sizes = np.append(rng.integers(1, 300, 200), [9000, 12000])
    for seed in range(5):
        landed = mixing.flight(sizes, np.full(202, 0.4), seed, land=True)
        assert abs((landed * sizes).sum() - 0.4 * sizes.sum()) <= 2 and abs(landed.sum() - 0.4 * 202) <= 1


def test_flight_follows_probabilities():
    size, drawn = np.array([1, 2, 3, 4, 5, 6]), np.zeros(6)
    for seed in range(800):
        drawn += mixing.flight(size, np.full(6, 0.5), seed, land=False)  # landing takes the nearest outcome instead
    assert np.abs(drawn / 800 - 0.5).max() < 0.06


@pytest.mark.parametrize("block_rows", [4096, 10])
def test_mix(spark, block_rows):
    docs = documents(spark).withColumn("source", F.when(F.col("doc_id") % 3 == 0, "src0").otherwise(F.col("source")))
    rows = mixing.mix(mixing.sizes(docs), block_rows=block_rows).collect()
    size = {r["doc_id"]: len(r["text"].split()) for r in docs.collect()}
    source = {r["doc_id"]: r["source"] for r in docs.collect()}
    totals = Counter()
    for i, s in source.items():
        totals[s] += size[i]
    want, taken, most = goal(totals), Counter(), Counter()
    assert len(rows) == len(size)
    for r in rows:
        s = source[r["doc_id"]]
        assert r["size"] == size[r["doc_id"]] and r["source_size"] == totals[s] and r["target"] == pytest.approx(want[s])
        assert 0 <= r["copies"] <= 3
        taken[s] += r["copies"] * r["size"]
        most[s] = max(most[s], r["size"])
    assert all(abs(taken[s] - want[s]) <= most[s] for s in want)
    again = mixing.mix(mixing.sizes(docs.repartition(5)), block_rows=block_rows).collect()
    assert sorted(map(tuple, rows)) == sorted(map(tuple, again))


def test_mix_of_rows_that_are_alike(spark, monkeypatch):
    """One row very often, one id in many rows: no window, rows that are alike are dealt out one by one; the numbers add up."""
    monkeypatch.setattr(mixing, "_RUN", 7)
    rows = [(1, "one two three", "s", "x")] * 300 + [(1, f"text {i} of the same id", "s", "x") for i in range(100)] + [(i, f"other {i} words", "t", "y") for i in range(200)]
    rows += [(None, "no id", None, "z")] * 50 + [(1, "one two three", "s", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, row string")
    sized = mixing.sizes(docs)
    assert sized.count() == len(rows) == sized.select("row").distinct().count()
    assert "Window" not in sized._jdf.queryExecution().optimizedPlan().toString()
    total = Counter()
    for _, text, source, _ in rows:
        total[source] += len(text.split())
    taken = mixing.mix(sized).groupBy("source_size").agg(F.sum(F.col("size") * F.col("copies")).alias("n"), F.first("target").alias("t"), F.max("size").alias("most")).collect()
    again = mixing.repeat_mixed(docs)
    assert again.columns == docs.columns
    words = Counter()
    for r in again.collect():
        words[r["source"]] += len(r["text"].split())
    assert {total[s]: n for s, n in words.items()} == {r["source_size"]: r["n"] for r in taken} and all(abs(r["n"] - r["t"]) <= r["most"] for r in taken)
    assert set(map(tuple, again.distinct().collect())) <= set(rows)


def test_targets_of_many_sources(spark):
    """Numbering and rate of many sources, with ties and empty ones, equal plain code."""
    rng = np.random.default_rng(11)
    sizes = {f"src{i:05d}": int(x) for i, x in enumerate(10 ** rng.uniform(0, 4, 3000))} | {None: 7, "": 0, "zero": 0}
    found = {r["source"]: (r["nth"], r["target"]) for r in mixing.targets(spark.createDataFrame(list(sizes.items()), "source string, source_size long")).collect()}
    assert {s: t for s, (_, t) in found.items()} == pytest.approx(goal(sizes))
    assert [s for s, _ in sorted(found.items(), key=lambda x: x[1][0])] == sorted(sizes, key=lambda s: (s is None, s or ""))
    assert mixing.targets(spark.createDataFrame([], "source string, source_size long")).count() == 0
    assert [r["target"] for r in mixing.targets(spark.createDataFrame([("a", 0)], "source string, source_size long")).collect()] == [0.0]


def test_mix_odd(spark):
    docs = odd(spark)
    rows = mixing.mix(mixing.sizes(docs)).collect()
    assert len(rows) == len(ROWS) and all(r["copies"] == 0 for r in rows if r["size"] == 0)
    again = mixing.repeat_mixed(docs)
    assert again.columns == docs.columns
    assert again.count() == sum(r["copies"] for r in rows)
    assert sum(len(r["text"].split()) for r in again.select("text").collect()) == sum(r["copies"] * r["size"] for r in rows)
    assert mixing.repeat_mixed(empty(spark)).count() == 0


# Packing


def unpacked(rows, made):
    """Token bytes of each document row, and checks of every packed row."""
    out, ids = defaultdict(dict), {}
    for r in rows:
        tokens = np.frombuffer(r["input_ids"], made.dtype)
        places = np.frombuffer(r["position_ids"], "<u2")
        assert len(tokens) == len(places) == 128 and r["cu_seqlens"][0] == 0 and r["cu_seqlens"][-1] == r["n_tokens"]
        assert r["n_segments"] == len(r["doc_ids"]) == len(r["cu_seqlens"]) - 1
        assert (tokens[r["n_tokens"] :] == packing.PAD).all()
        for i, (a, b) in enumerate(zip(r["cu_seqlens"], r["cu_seqlens"][1:])):
            assert b > a and list(places[a:b]) == list(range(b - a))
            out[r["doc_rows"][i]][r["doc_starts"][i]] = tokens[a:b]
            ids[r["doc_rows"][i]] = r["doc_ids"][i]
    texts = []
    for k, parts in out.items():
        at = 0
        for start in sorted(parts):
            assert start == at
            at += len(parts[start])
        texts.append((ids[k], made.encoding.decode(np.concatenate([parts[s] for s in sorted(parts)]).tolist())))
    return sorted(texts, key=repr)


def test_pack_round_trip(spark, tmp_path):
    with open(packing.TOKENIZER, "rb") as f:
        made = packing.Tokenizer(f.read())
    for docs in (documents(spark), odd(spark)):
        found = packing.pack(docs, row_tokens=128, window_tokens=5000)
        packing.write_packed(found, str(tmp_path / "packed"))
        rows = spark.read.parquet(str(tmp_path / "packed"))
        texts = [(r["doc_id"], r["text"]) for r in docs.collect() if r["text"]]
        assert unpacked(rows.collect(), made) == sorted(texts, key=repr)
        assert packing.matrix(rows.toArrow(), "input_ids", 128).shape == (rows.count(), 128)
        assert rows.select("pack_id").distinct().count() == rows.count()
    assert packing.pack(empty(spark)).count() == 0


def test_words_encode_as_in_the_text():
    with open(packing.TOKENIZER, "rb") as f:
        made = packing.Tokenizer(f.read())
    for text in ["a b", " a", "a ", "a  b", "a \nb", "it's 12 o'clock, né?\nyes | no\t x", "   ", "\n\na b\n", "漢字 かな", "a b", "x's y're 12ab!? --"]:
        assert made.encode(text) == made.whole(text), text
    assert made.encode(None) == made.encode("") == b""


@pytest.mark.parametrize("kind", [" ", "\n", "a", "ab", "!", "1", "\u3000", "é ", "x\n"])
def test_very_long_runs(kind):
    with open(packing.TOKENIZER, "rb") as f:
        made = packing.Tokenizer(f.read())
    ids = lambda b: np.frombuffer(b, made.dtype).tolist()
    for n in (1000, packing.LONGEST_PART - 10):
        text = ("x" + kind * n)[: packing.LONGEST_PART - 1] + "y"
        assert ids(made.encode(text)) == made.encoding.encode_ordinary(text)
    text = "x" + kind * (1_000_000 // len(kind)) + "y"
    assert made.encoding.decode(ids(made.encode(text))) == text


def test_ten_million_blanks(spark):
    for kind in (" ", "\n", "z"):
        docs = spark.createDataFrame([(1, "x" + kind * 10_000_000 + "y"), (2, "plain")], "doc_id long, text string")
        rows = packing.pack(docs).collect()
        with open(packing.TOKENIZER, "rb") as f:
            made = packing.Tokenizer(f.read())
        parts = sorted((r["doc_ids"][i], r["doc_starts"][i], np.frombuffer(r["input_ids"], made.dtype)[a:b].tolist())
                       for r in rows for i, (a, b) in enumerate(zip(r["cu_seqlens"], r["cu_seqlens"][1:])))
        text = b"".join(made.encoding.decode_bytes(p[2]) for p in parts if p[0] == 1).decode()
        assert text == "x" + kind * 10_000_000 + "y"


def test_long_texts_have_the_ids_of_whole_texts(spark):
    with open(packing.TOKENIZER, "rb") as f:
        made = packing.Tokenizer(f.read())
    for r in documents(spark).orderBy(F.length("text").desc()).limit(20).collect():
        text = r["text"] + "\n" + r["text"].replace(" ", "\n \t") + "don't 12ab, c! 東京は" * 2000
        assert np.frombuffer(made.encode(text), made.dtype).tolist() == made.encoding.encode_ordinary(text)


def test_best_fit():
    rng = np.random.default_rng(9)
    for size in (1, 7, 10, 64):
        lengths = [int(x) for x in rng.integers(1, size + 1, 200)]
        rows = packing.best_fit(lengths, size)
        assert sorted(i for r in rows for i in r) == list(range(200)) and all(sum(lengths[i] for i in r) <= size for r in rows)
        free, want = [], []
        for i in sorted(range(200), key=lambda i: -lengths[i]):
            fits = [f for f in free if f >= lengths[i]]
            if fits:
                free.remove(min(fits))
                free.append(min(fits) - lengths[i])
            else:
                free.append(size - lengths[i])
        want = sorted(free)
        assert sorted(size - sum(lengths[i] for i in r) for r in rows) == want


# Pipeline


def test_pipeline(spark):
    docs = documents(spark)
    columns = docs.columns
    stages = corpus_pipeline.STAGES
    assert [n for n, _ in stages] == ["language_id", "simhash_near_dedup", "decontamination", "mixing", "token_output"]
    kept = [docs]
    for _, stage in stages[:-1]:
        out = stage(spark, kept[-1], FOLDER).persist()
        assert out.columns == columns
        kept.append(out)
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    first, second, third, fourth = ([r["doc_id"] for r in x.collect()] for x in kept[1:])
    assert set(first) == {i for i, t in texts.items() if t and any(c.isalpha() for c in t)}
    want = {c for _, _, c in expected_components([(i, texts[i]) for i in first])}
    assert sorted(second) == sorted(want)
    assert set(third) <= set(second) and set(fourth) <= set(third)
    assert max(Counter(fourth).values()) <= 3
    packed = corpus_pipeline.run(spark, FOLDER).collect()
    assert Counter(i for r in packed for i, s in zip(r["doc_ids"], r["doc_starts"]) if s == 0) == Counter(fourth)


def test_pipeline_odd(spark):
    docs = odd(spark)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, FOLDER)
        assert docs.columns == odd(spark).columns
    assert 0 < corpus_pipeline.STAGES[-1][1](spark, docs, FOLDER).count()
    nothing = empty(spark)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, nothing, FOLDER).count() == 0


def test_held_out_fold(spark):
    from silverloom.llm.common import held_out

    got = spark.range(50).select("id", held_out(F.col("id"))).collect()
    assert all(r[1] == (zlib.crc32(str(r[0]).encode()) % 5 == 0) for r in got)
