"""Operators on single texts and lines, against brute force."""

import hashlib
import math
import re
import time
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from silverloom.llm import decontaminate, language, line_dedup, native, order_minhash, quality, secrets, toxicity
from silverloom.llm.registry import load

from .cases import FOLDER, ROWS, documents, empty, odd

QUERIES, ORACLES = load()


def held(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 5 == 0


# Secrets


def base_spans(text):
    found = []
    rules = [
        (r"""((?:(?i:password|passwd|secret|token|api_?key)))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", lambda m: len(m[2]) >= 8),
        (r"AKIA[A-Z0-9]+", lambda m: len(m[0]) >= 16),
        (r"[0-9a-f]+", lambda m: len(m[0]) >= 32),
    ]
    for kind, (pattern, keep) in enumerate(rules):
        found += [(m.start(), kind, m.end()) for m in re.finditer(pattern, text) if keep(m)]
    return sorted(found)


def test_secret_base(spark):
    for docs in (documents(spark), odd(spark)):
        got = secrets.find_secrets(docs).select("doc_id", "spans", "n_assign", "n_access", "n_hex").collect()
        want = [(r["doc_id"], base_spans(r["text"] or "")) for r in docs.select("doc_id", "text").collect()]
        mine = [(r["doc_id"], [tuple(s) for s in r["spans"] if s["kind"] < 3]) for r in got]
        assert sorted(mine, key=repr) == sorted(want, key=repr)
        assert [sum(r[f"n_{k}"] for r in got) for k in ("assign", "access", "hex")] == [sum(s[1] == k for _, w in want for s in w) for k in range(3)]
    assert secrets.find_secrets(empty(spark)).count() == 0


def test_sums_before(spark):
    rows = [([],), ([5],), (list(range(1, 200)),), ([3] * 64,), ([2] * 65,)]
    got = spark.createDataFrame(rows, "v array<long>").select("v", native.sums_before(F.col("v")).alias("s")).collect()
    for r in got:
        assert list(r["s"]) == [sum(r["v"][:i]) for i in range(len(r["v"]))]


def test_many_spans_in_one_text(spark):
    text = " ".join(f"é token={'0123456789abcdef' * 2}{i:08x}" for i in range(300))
    got = secrets.find_secrets(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert [tuple(s) for s in got["spans"] if s["kind"] < 3] == base_spans(text)


def plain_battery(body):
    """Battery of a token, in plain Python."""
    from math import erfc, sqrt

    tail = lambda z: erfc(z / sqrt(2)) / 2
    symbols, agree = next((s, a) for p, s, a in secrets.ENCODINGS if re.fullmatch(p, body))
    n, kinds = len(body), len(symbols)
    chi = kinds / n * sum(c * c for c in Counter(body).values()) - n
    free = kinds - 1
    z_chi = ((chi / free) ** (1 / 3) - (1 - 2 / (9 * free))) / (2 / (9 * free)) ** 0.5
    v = [symbols.index(c) + 1 for c in body]
    up = [x > (kinds + 1) / 2 for x in v]
    high, low = sum(up), n - sum(up)
    mean = 2 * high * low / n + 1
    spread = (mean - 1) * (mean - 2) / (n - 1)
    z_runs = (1 + sum(a != b for a, b in zip(up, up[1:])) - mean) / spread**0.5 if spread > 0 else -40
    centre = sum(v) / n
    power = sum((x - centre) ** 2 for x in v)
    z_serial = (sum((a - centre) * (b - centre) for a, b in zip(v, v[1:])) / power + 1 / n) * n**0.5 if power else 40
    least = min(tail(z_chi), 2 * tail(abs(z_runs)), 2 * tail(abs(z_serial)))
    shift = (n - 1) * (kinds * agree - 1)
    return 1 - (1 - min(least, 1)) ** 3, tail(-(chi - free - shift) / (2 * (free + 2 * shift)) ** 0.5)


def test_one_very_long_token(spark):
    token = "".join(np.random.default_rng(1).choice(list("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/"), 1_000_000))
    docs = spark.createDataFrame([(1, f"data {token} end"), (2, "xy" * 500_000)], "doc_id long, text string")
    started = time.perf_counter()
    found = {r["doc_id"]: [tuple(s) for s in r["spans"]] for r in secrets.find_secrets(docs).collect()}
    assert found == {1: [(5, 3, 1_000_005)], 2: []}
    assert time.perf_counter() - started < 60


def test_random_tokens(spark):
    rng = np.random.default_rng(1)
    letters = np.array(list("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"))
    strong = ["".join(rng.choice(letters, n)) for n in (24, 32, 40, 64) * 5]
    weak = ["internationalisationalities", "aaaaaaaaaaaaaaaaaaaaaaaaaaaa", "thethethethethethethethe", "0000000000000000000000000001"]
    rows = [(i, f"see {t} here") for i, t in enumerate(strong + weak)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r for r in secrets.find_secrets(docs).collect()}
    assert sum(got[i]["n_random"] for i in range(len(strong))) >= len(strong) - 1
    assert all(got[len(strong) + i]["n_random"] == 0 for i in range(len(weak)))
    assert all((s["start"], s["end"]) == (4, 4 + len(strong[i])) for i in range(len(strong)) for s in got[i]["spans"])
    scanned = {r["doc_id"]: r["tokens"][0] for r in secrets.scan(docs).collect()}
    for i, t in enumerate(strong + weak):
        assert (scanned[i]["p_random"], scanned[i]["p_plain"]) == pytest.approx(plain_battery(t), rel=1e-4, abs=1e-9)


# Decontamination


def table_distance(item, text):
    row, best = list(range(len(item) + 1)), (len(item), 0)
    for at, c in enumerate(text, 1):
        new = [0]
        for i, x in enumerate(item, 1):
            new.append(min(row[i] + 1, new[-1] + 1, row[i - 1] + (x != c)))
        row = new
        if row[-1] < best[0]:
            best = row[-1], at
    return best


def test_bit_parallel_distance():
    rng = np.random.default_rng(2)
    for _ in range(300):
        a, b = ("".join(rng.choice(list("abc"), rng.integers(0, 12))) for _ in range(2))
        assert decontaminate.distance(a, b) == table_distance(a, b)
    assert decontaminate.distance("ab" * 100, "xx" + "ab" * 99 + "ax")[0] == 1


def test_decontaminate(spark):
    bench = spark.read.parquet(f"{FOLDER}/benchmark.parquet")
    items = [(r["item_id"], decontaminate.plain(r["text"])) for r in bench.collect()][:12]
    some = bench.where(F.col("item_id").isin([i for i, _ in items]))
    docs = documents(spark)
    planted = []
    for k, (i, t) in enumerate(items):
        e = decontaminate.budget(len(t))
        within = t[: len(t) // 2] + "#" * e + t[len(t) // 2 + e :]
        beyond = "".join("#" if j % 13 == 0 else c for j, c in enumerate(t))
        planted += [(10_000 + k, f"before {within.upper()} after"), (20_000 + k, beyond)]
    docs = docs.select("doc_id", "text").union(spark.createDataFrame(planted, "doc_id long, text string"))
    got = {(r[0], m["item_id"]): m["distance"] for r in decontaminate.mark(docs, some, block_chars=500).collect() for m in r["matches"]}
    want = {}
    for r in docs.collect():
        text = decontaminate.plain(r["text"])[:6000]
        for i, t in items:
            near = 0 if t in text else table_distance(t, text)[0] if r["doc_id"] >= 10_000 else 99
            if near <= decontaminate.budget(len(t)):
                want[r["doc_id"], i] = near
    assert {k: v for k, v in got.items() if k in want} == want
    assert all(k[0] >= 10_000 or k in want or v > 0 for k, v in got.items())
    assert {d for d, _ in got if 20_000 <= d} == {d for d, _ in want if 20_000 <= d}


def test_decontaminate_lost_ends(spark):
    """Every way to cut whole words off an end that leaves 80 % of the runs of five words is found."""
    items = [(r["item_id"], decontaminate.plain(r["text"])) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    matcher = decontaminate.Matcher(items, decontaminate.ERROR_RATE, decontaminate.PIECE_CHARS)
    tried = beyond = 0
    for i, text in items:
        words = text.split(" ")
        for lost in range(1, len(words)):
            if len(words) - lost - 4 < 0.8 * (len(words) - 4):
                break
            for left in (words[:-lost], words[lost:]):
                found = {m[0]: m[1] for m in matcher.find("zzz qqq " + " ".join(left) + " xxx yyy")}
                assert i in found and found[i] <= len(text)
                tried, beyond = tried + 1, beyond + (found[i] > decontaminate.budget(len(text)))
    assert tried > 100 and beyond > 50


def test_decontaminate_short_items():
    matcher = decontaminate.Matcher([(1, "Short  item"), (2, "")], decontaminate.ERROR_RATE, decontaminate.PIECE_CHARS)
    assert matcher.find("a short item, here") == [(1, 0, 12)]
    assert matcher.find("short item") == [(1, 0, 10)]
    assert matcher.find("ashort item") == matcher.find("short items") == matcher.find("shirt item") == []
    assert [m[0] for m in matcher.find("short items and a short item")] == [1]


def test_decontaminate_single_words():
    matcher = decontaminate.Matcher([(1, "otorhinolaryngo"), (2, "Ab")], decontaminate.ERROR_RATE, decontaminate.PIECE_CHARS)
    assert matcher.find("the word is otorhinolaryngo here") == [(1, 0, 27)]
    assert matcher.find("otorhinolaryngology, abc") == [] and [m[0] for m in matcher.find("(ab)")] == [2]


def test_decontaminate_repeated_piece():
    """One verification for a range, however often a piece is found in it."""
    item = "sixteen letters " * 20
    matcher = decontaminate.Matcher([(1, item)], decontaminate.ERROR_RATE, decontaminate.PIECE_CHARS)
    started = time.perf_counter()
    assert matcher.find("zz " + "sixteen letters " * 2000)[0][:2] == (1, 0)
    assert matcher.find("zz " + "sixteen letters, " * 1300) == []
    assert time.perf_counter() - started < 5


def test_decontaminate_ranges():
    """Ranges of pieces found out of order give the nearest place, as all places tried one by one do."""
    rng = np.random.default_rng(4)
    for _ in range(60):
        words = [f"{x:05d}" for x in rng.integers(0, 30, 40)]
        item = " ".join(words)
        errors = decontaminate.budget(len(item))
        text = []
        for _ in range(4):
            copy = list(item)
            for at in rng.integers(0, len(copy), rng.integers(0, errors + 4)):
                copy[at] = "#"
            text += ["".join(copy), " ".join(f"{x:05d}" for x in rng.integers(0, 30, 10))]
        text = decontaminate.plain(" ".join(text))
        near, end = table_distance(item, text)
        found = {m[0]: m for m in decontaminate.Matcher([(1, item)], decontaminate.ERROR_RATE, decontaminate.PIECE_CHARS).find(text)}
        if near <= errors:
            assert found[1] == (1, near, end)


def test_decontaminate_blocks(spark, monkeypatch):
    """A benchmark of many blocks gives the matches of one block; blocks are let go after each stage."""
    monkeypatch.setattr(decontaminate, "STAGE_BLOCKS", 2)
    bench = spark.read.parquet(f"{FOLDER}/benchmark.parquet")
    key = lambda df: sorted((r["doc_id"], *m) for r in df.collect() for m in r["matches"])
    docs = documents(spark).select("doc_id", "text")
    assert key(decontaminate.mark(docs, bench, block_chars=6000)) == key(decontaminate.mark(docs, bench))


def test_decontaminate_odd(spark):
    bench = spark.createDataFrame([(1, "quick brown fox jumps over the lazy dog and"), (1, None), (None, "short"), (2, "")], "item_id long, text string")
    got = decontaminate.mark(odd(spark), bench)
    assert got.count() == len(ROWS) and got.columns.count("matches") == 1
    assert sorted((r["doc_id"] or 0 for r in got.where(F.size("matches") > 0).collect())) == [0, 1, 1, 2, 8]  # 8 has the word
    assert decontaminate.keep_clean(odd(spark), bench).count() == len(ROWS) - 5
    assert decontaminate.mark(empty(spark), bench).count() == 0
    assert decontaminate.keep_clean(odd(spark), bench.limit(0)).count() == len(ROWS)


# Lines


def kept_lines(rows, min_docs=5):
    key = lambda s: s.strip(" \t\n\x0b\x0c\r").translate({c: c + 32 for c in range(65, 91)})
    holders = defaultdict(set)
    for i, t in rows:
        for k in {key(x) for x in (t or "").split("\n")}:
            if len(k) >= 40 and i is not None:
                holders[k].add(i)
    docs, last = Counter({k: len(v) for k, v in holders.items()}), {k: max(v) for k, v in holders.items()}
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        stay = [x for x in lines if not (len(key(x)) >= 40 and docs[key(x)] >= min_docs and last[key(x)] != i)]
        out.append((i, "\n".join(stay), len(lines), len(lines) - len(stay)))
    return sorted(out, key=repr)


def test_line_dedup_shared_id(spark, monkeypatch):
    """Rows that share a doc_id, or have none, carry the lines that they lose themselves, not those of all."""
    pair = lambda k: (f"a line number {k} that two rows hold", f"another line {k} of the same two rows")
    rows = [(i, "\n".join([*pair(k), f"and one of its own {k} {i}"])) for k in range(60) for i in (None if k % 2 else 1, 1000 + k, 2000 + k)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    carried = []
    plain = line_dedup.in_tasks
    monkeypatch.setattr(line_dedup, "in_tasks", lambda df, run, schema: (carried.append(df), plain(df, run, schema))[1])
    got = line_dedup.dedup_lines(docs, min_docs=2, min_chars=5).collect()
    joined = next(df for df in carried if df.columns[-1] == "__lost")
    assert joined.columns[-1] == "__lost" and joined.agg(F.max(F.size("__lost"))).first()[0] == 2
    for r in got:
        lines = r["text"].split("\n")
        assert r["kept_text"] == ("\n".join(lines) if (r["doc_id"] or 0) >= 2000 else lines[2])


def test_line_dedup_repeated_ids_as_sql(spark, tmp_path):
    """One id in several rows is one document, here and in the SQL; so is a missing one none."""
    import duckdb

    line = "one and the same line of forty characters or more"
    rows = [(1, line)] * 3 + [(2, line)] * 2 + [(i, line + " again") for i in (1, 2, 3, 4, 5, 5)] + [(None, line + " again"), (9, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r["n"] for r in line_dedup.dedup_lines(docs).groupBy("doc_id").agg(F.sum("n_dropped").alias("n")).collect()}
    assert got == {1: 1, 2: 1, 3: 1, 4: 1, 5: 0, None: 1, 9: 0}
    con = duckdb.connect()
    docs.write.parquet(str(tmp_path / "d"))
    con.execute(f"create view documents as select * from read_parquet('{tmp_path}/d/*.parquet')")
    assert {r[0]: r[2] for r in con.execute(ORACLES["op3_line_dedup"]).fetchall()} == got


def test_filter_rounds():
    assert line_dedup.filter_bits(0) == (1 << 20, 1) and line_dedup.filter_bits(1 << 24) == (1 << 28, 8)


@pytest.mark.parametrize("bits, rounds", [(1 << 20, 1), (1 << 6, 1), (1 << 12, 3)])
def test_line_dedup(spark, monkeypatch, bits, rounds):
    """Also with filters so full that every line is suspected, and in several rounds."""
    monkeypatch.setattr(line_dedup, "filter_bits", lambda rows: (bits, rounds))
    line = "  The Same Line That Many Documents Hold, É forty characters.\r"
    extra = [(100 + i, f"{line}\nown line of document {i} that nobody else has at all, long\n{line.upper()}") for i in range(7)]
    for docs in (documents(spark), odd(spark)):
        docs = docs.select("doc_id", "text").union(spark.createDataFrame(extra + [(None, line)], "doc_id long, text string"))
        got = line_dedup.dedup_lines(docs).select("doc_id", "kept_text", "n_lines", "n_dropped").collect()
        assert sorted((tuple(r) for r in got), key=repr) == kept_lines([tuple(r) for r in docs.collect()])
    assert line_dedup.dedup_lines(empty(spark)).count() == 0
    assert line_dedup.dedup_lines(odd(spark)).columns.count("kept_text") == 1


# Languages


def test_language(spark):
    docs = documents(spark)
    model = language.train(docs)
    got = {r["doc_id"]: r for r in language.identify(docs, model).collect()}
    rows = [r for r in docs.collect() if held(r["doc_id"])]
    assert sum(got[r["doc_id"]]["lang_pred"] == r["lang"] for r in rows) >= 0.95 * len(rows)
    assert all(0 <= r["lang_score"] <= 1 for r in got.values())
    by = defaultdict(list)
    for r in docs.collect():
        by[r["lang"]].append(" ".join(r["text"].split()[:60]))
    mixed = by["en"][0] + " . " + by["fr"][0] + " . " + by["en"][1]
    _, _, spans = model.label([mixed])[0]
    assert [s["lang"] for s in spans] == ["en", "fr", "en"]
    assert abs(spans[1]["start"] - len(by["en"][0])) < 40 and spans[0]["start"] == 0
    assert model.label(["Это русский текст"])[0][0] in model.langs


def test_language_paths_are_best():
    rng = np.random.default_rng(3)
    model = language.Model(["a", "b", "c"], np.ones((3, language.BUCKETS)), np.ones((3, 16)), penalty=3.0)
    texts = [rng.normal(size=(n, 3)) * 2 for n in (1, 2, 5, 5, 9, 30)]
    worth = lambda s, p: sum(s[i][k] for i, k in enumerate(p)) - 3 * sum(x != y for x, y in zip(p, p[1:]))
    for scores, path in zip(texts, model.paths(texts)):
        best = {k: (scores[0][k], [k]) for k in range(3)}
        for row in scores[1:]:
            best = {k: max((v - 3 * (j != k) + row[k], p + [k]) for j, (v, p) in best.items()) for k in range(3)}
        assert worth(scores, list(path)) == pytest.approx(max(best.values())[0])
        one = model.settled(scores)
        assert one is None or worth(scores, [one] * len(scores)) == pytest.approx(max(best.values())[0])


def test_language_odd(spark):
    docs = odd(spark)
    found = language.identify(docs, language.train(docs))
    assert found.columns.count("lang_pred") == 1
    rows = found.select("doc_id", "lang_pred", "lang_spans").collect()
    assert len(rows) == len(ROWS)
    assert {r["doc_id"] for r in rows if r["lang_pred"] == "und"} == {3, 4, 5, 7}
    assert language.keep_identified(docs).columns == docs.columns and language.keep_identified(docs).count() == len(ROWS) - 4
    assert language.identify(docs, language.train(empty(spark))).where("lang_pred <> 'und'").count() == 0
    assert language.identify(empty(spark), language.train(docs)).count() == 0


# Order MinHash


def xx(*values):
    """Spark's xxhash64 of longs, ints and strings in turn."""
    seed = 42
    for kind, v in values:
        if v is None:
            continue
        data = v.encode() if kind == "s" else int(v).to_bytes(8 if kind == "l" else 4, "little", signed=True)
        seed = xxhash.xxh64_intdigest(data, seed)
    return seed - (1 << 64) if seed >> 63 else seed


def test_order_minhash(spark):
    for docs in (documents(spark).where("length(text) < 3000"), odd(spark)):
        got = order_minhash.fingerprint(docs.select("doc_id", "text")).collect()
        for r in got:
            assert list(r["signature"]) == plain_orders(r["text"] or "")


def plain_numbered(text, words=2):
    """k-mer hashes of a text, and hash of k-mer and occurrence number for each place."""
    spaced = re.sub("([\u4e00-\u9fff])", r" \1 ", text)
    units = re.split(r"[\x20\x09-\x0D]+", spaced.strip(" \t\n\x0b\x0c\r"))
    hashes = [xx(*[("s", units[i + k] if i + k < len(units) else None) for k in range(words)]) for i in range(len(units))]
    seen, dealt = Counter(), []
    for h in hashes:
        key = (h & (1 << 64) - 1) >> 28
        dealt.append(xx(("l", key), ("i", seen[key])) & (1 << 64) - 1)
        seen[key] += 1
    return hashes, dealt


def plain_orders(text, orders=64, size=2):
    hashes, dealt = plain_numbered(text)
    out = []
    for b in range(orders):
        ranks = [(g >> 58 != b, g >> 28 if g >> 58 == b else xx(("l", g >> 28), ("l", b)) >> 28, p) for p, g in enumerate(dealt)]
        code = xx(*[("l", hashes[p]) for p in sorted(r[2] for r in sorted(ranks)[:size])]) & 0xFFFFFFFF
        out.append(code - (1 << 32) if code >> 31 else code)
    return out


def textbook_orders(text, orders=64, size=2):
    hashes, dealt = plain_numbered(text)
    least = [sorted(sorted(range(len(dealt)), key=lambda p: xx(("l", dealt[p] >> 1), ("i", -k)))[:size]) for k in range(1, orders + 1)]
    return [(k, *[hashes[p] for p in places]) for k, places in enumerate(least)]


@pytest.mark.parametrize("words", [10, 50, 150])
def test_order_minhash_moved_blocks(spark, words):
    """A text and the same with its four quarters in reverse order are as alike as with 64 textbook orders."""
    rng = np.random.default_rng(words)
    rows = []
    for _ in range(40):
        units = [f"w{x}" for x in rng.integers(0, 5000, words)]
        cut = [words * k // 4 for k in range(5)]
        rows.append((" ".join(units), " ".join(x for k in (3, 2, 1, 0) for x in units[cut[k] : cut[k + 1]])))
    moved = spark.createDataFrame(rows, "a string, b string")
    mine = moved.select(order_minhash.likeness(order_minhash.signature(F.col("a")), order_minhash.signature(F.col("b")))).collect()
    want = [len(set(textbook_orders(a)) & set(textbook_orders(b))) / 64 for a, b in rows]
    assert abs(np.mean([r[0] for r in mine]) - np.mean(want)) < 0.03


def test_order_minhash_query(spark):
    got = {r["doc_id"]: r for r in QUERIES["op8_order_minhash"](spark, FOLDER).collect()}
    rows = sorted(((r["doc_id"], r["text"] or "") for r in documents(spark).collect()), reverse=True)
    assert len(got) == len(rows)
    likeness = lambda a, b: sum(x == y for x, y in zip(a, b)) / 64
    hexed = lambda a: "".join(f"{x & 0xFFFFFFFF:08x}" for x in a)
    for k, (i, text) in enumerate(rows):
        other = rows[(k + 1) % len(rows)][1]
        third = len(text) // 3
        edited = text[: len(text) - third] + other[:third]
        mine = got[i]
        assert mine["n_chars"] == len(text) and mine["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        if len(text) > 5000:
            continue
        a, b, c = plain_orders(text), plain_orders(edited), plain_orders(other)
        assert (mine["fingerprint"], mine["edited_fingerprint"]) == (hexed(a), hexed(b))
        assert mine["near_edited"] == pytest.approx(likeness(a, b)) and mine["near_next"] == pytest.approx(likeness(a, c))
    near = np.array([(r["near_edited"], r["near_next"]) for r in got.values()])
    assert near[:, 0].mean() > near[:, 1].mean() + 0.2


def test_order_minhash_long_words(spark):
    """Two characters more do not change what the units are."""
    text = " ".join(f"{i:039d}" for i in range(60))
    found = spark.createDataFrame([(text, text + " xy")], "a string, b string")
    assert found.select(order_minhash.likeness(order_minhash.signature(F.col("a")), order_minhash.signature(F.col("b")))).first()[0] > 0.8


def test_order_minhash_signs_a_text_once(spark):
    """The plan makes signatures in two places: before the one shuffle of the texts, and for the edited text."""
    plan = QUERIES["op8_order_minhash"](spark, FOLDER)
    plan.collect()
    assert plan._jdf.queryExecution().executedPlan().toString().count("ReusedExchange") >= 1


def test_order_minhash_odd(spark):
    found = order_minhash.with_next(odd(spark)).collect()
    assert len(found) == len(ROWS)
    ids = sorted({r[0] for r in ROWS if r[0] is not None}, reverse=True) + [None]
    texts = defaultdict(list)
    for r in ROWS:
        texts[r[0]].append(r[1] or "")
    for r in found:
        after = ids[(ids.index(r["doc_id"]) + 1) % len(ids)]
        assert r["lead"] in {t[: len(r["text"]) // 3] for t in texts[after]}
    assert order_minhash.with_next(empty(spark)).count() == 0
    moved = spark.createDataFrame([("a b c d e f g h " * 5 + "x y z", "x y z " + "a b c d e f g h " * 5)], "a string, b string")
    same = moved.select(order_minhash.likeness(order_minhash.signature(F.col("a")), order_minhash.signature(F.col("a"))), order_minhash.likeness(order_minhash.signature(F.col("a")), order_minhash.signature(F.col("b")))).first()
    assert same[0] == 1 and same[1] < 1


# Classifiers


def rates(found, truth):
    hit = sum(found[i] == 1 and y == 1 for i, y in truth.items())
    return hit / max(1, sum(truth.values())), hit / max(1, sum(found[i] for i in truth))


@pytest.mark.parametrize("name, label", [("op9_quality", "quality"), ("op10_toxicity", "toxic")])
def test_classifier(spark, name, label):
    folder = FOLDER.replace("0.001", "0.01")
    got = QUERIES[name](spark, folder).collect()
    labels = {r["doc_id"]: r[label] for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    assert len(got) == spark.read.parquet(f"{folder}/documents.parquet").count()
    assert all(0 <= r["score"] <= 1 and r["held_out"] == held(r["doc_id"]) for r in got)
    assert all(r["predicted"] == (r["score"] >= (0.3 if label == "quality" else 0.5)) for r in got)
    truth = {i: y for i, y in labels.items() if held(i)}
    recall, precision = rates({r["doc_id"]: r["predicted"] for r in got}, truth)
    assert precision >= 0.9 and recall >= (0.95 if label == "quality" else 0.5)


def test_classifiers_odd(spark):
    labels = spark.createDataFrame([(1, 1, 0), (2, 0, 1), (2, None, 0), (None, 1, 1), (99, 1, 1), (6, 1, None), (9, 5, 0)], "doc_id long, quality int, toxic int")
    for module in (quality, toxicity):
        for learnt in (labels, labels.limit(0)):
            model = module.train(odd(spark), learnt)
            rows = module.score(odd(spark), model).collect()
            assert len(rows) == len(ROWS) and all(0 <= r["score"] <= 1 for r in rows)
        assert module.score(empty(spark), module.train(empty(spark), labels)).count() == 0


def plain_step(g, h, depth=2):
    """Steps of a tree over ordered bins: every cut tried, leaf by leaf."""
    gain = lambda a, b: a * a / (b + quality.RIDGE)
    whole_g, whole_h = sum(g), sum(h)
    best = None
    for cut in range(1, len(g)) if depth else ():
        value = gain(sum(g[:cut]), sum(h[:cut])) + gain(sum(g[cut:]), sum(h[cut:]))
        if best is None or value > best[0] + 1e-12:
            best = value, cut
    if best and best[0] > gain(whole_g, whole_h) + 1e-9:
        cut = best[1]
        return plain_step(g[:cut], h[:cut], depth - 1) + plain_step(g[cut:], h[cut:], depth - 1)
    return [whole_g / (whole_h + quality.RIDGE)] * len(g)


def test_additive_model_as_plain_boosting(monkeypatch):
    """Features take turns; each adds a shallow tree, fitted by trying every cut, to its table."""
    monkeypatch.setattr(quality, "ROUNDS", 5)
    monkeypatch.setattr(quality, "PAIR_ROUNDS", 2)
    rng = np.random.default_rng(3)
    n, width = 150, len(quality.FEATURES)
    x = np.round(rng.normal(size=(n, width)), 1)
    y = ((x[:, 0] + x[:, 1] * x[:, 2] + rng.normal(size=n)) > 0).astype(float)
    model = quality.fit(x, y)
    binned = [[sum(v >= e for e in model.edges[j]) for v in x[:, j]] for j in range(width)]
    rate = (sum(y) + 1) / (n + 2)
    raw, tables = [math.log(rate / (1 - rate))] * n, [[0.0] * (len(e) + 1) for e in model.edges]
    for _ in range(5):
        for j in range(width):
            p = [1 / (1 + math.exp(-r)) for r in raw]
            g, h = [0.0] * len(tables[j]), [0.0] * len(tables[j])
            for i in range(n):
                g[binned[j][i]] += y[i] - p[i]
                h[binned[j][i]] += p[i] * (1 - p[i])
            step = [quality.RATE * s for s in plain_step(g, h)]
            tables[j] = [a + b for a, b in zip(tables[j], step)]
            raw = [r + step[binned[j][i]] for i, r in enumerate(raw)]
    for mine, want in zip(model.tables, tables):
        assert list(mine) == pytest.approx(want, abs=1e-9)
    assert len(model.pairs) == quality.PAIRS
    # A pair's table is a sum of grids of four values, and the score the sum of all look-ups.
    for i in range(0, n, 17):
        total = model.base + sum(t[b[i]] for t, b in zip(tables, binned))
        for (j, k), grid in model.pairs.items():
            total += grid[sum(x[i, j] >= e for e in model.coarse[j]), sum(x[i, k] >= e for e in model.coarse[k])]
        assert model.score(x[i : i + 1])[0] == pytest.approx(1 / (1 + math.exp(-total)), abs=1e-9)


def test_pair_grid_as_plain_search():
    rng = np.random.default_rng(5)
    g, h = rng.normal(size=(5, 4)), rng.uniform(0.1, 1, (5, 4))
    gain = lambda a, b: a.sum() ** 2 / (b.sum() + quality.RIDGE)
    best = max(
        (sum(gain(g[r, c], h[r, c]) for r in (slice(0, i), slice(i, 5)) for c in (slice(0, j), slice(j, 4))) - gain(g, h), -i, -j)
        for i in range(1, 5) for j in range(1, 4)
    )
    found, steps = quality._quarters(g, h)
    assert found == pytest.approx(best[0])
    i, j = -best[1], -best[2]
    assert steps[0, 0] == pytest.approx(g[:i, :j].sum() / (h[:i, :j].sum() + quality.RIDGE)) and len(np.unique(steps.round(12))) == 4


def plain_entries(rows):
    """Weighted entries of a lexicon, counted text by text."""
    with_, without = Counter(), Counter()
    for text, label in rows:
        (with_ if label else without).update(toxicity.grams(toxicity.folded(text)))
    toxic, plain = sum(x for _, x in rows), sum(not x for _, x in rows)
    weight = {k: math.log((with_[k] + 0.5) / (toxic + 1)) - math.log((without[k] + 0.5) / (plain + 1)) for k in with_}
    found = {k: w for k, w in weight.items() if with_[k] >= toxicity.SUPPORT and w >= toxicity.LEVEL}
    for k in [k for k in found if not k.endswith(" ")]:
        if with_[k] < toxicity.SHARED * max([with_[w] for w in found if w.endswith(" ") and w.startswith(k) and len(k) - 1 in toxicity.PREFIXES], default=0):
            found[k] = None
    found = {k: w for k, w in found.items() if w is not None}
    kept = {}
    for k in sorted(found, key=lambda k: (len(k), k)):
        if all(found[k] > w + 0.7 for s, w in kept.items() if k.startswith(s)):
            kept[k] = found[k]
    for word in toxicity.GIVEN:
        kept.setdefault(toxicity.folded(word), max(toxicity.GIVEN_WEIGHT, found.get(toxicity.folded(word), 0)))
    return kept


def test_lexicon_as_plain_count(spark):
    """Entries and scores equal those of a plain counter and of a search place by place."""
    docs = documents(spark).join(spark.read.parquet(f"{FOLDER}/labels.parquet"), "doc_id").where("toxic is not null and text is not null")
    rows = [(r["text"], r["toxic"]) for r in docs.select("text", "toxic").collect()]
    rows += [(f"you are a zorbl {w} thing", 1) for w in ("red", "blue", "green")] * 8 + [(f"zorbling {i} is zorblish", 1) for i in range(9)]
    learned = toxicity.learn_lexicon(spark.createDataFrame(rows, "text string, label int"))
    assert {k: round(w, 9) for k, w in learned.entries.items()} == {k: round(w, 9) for k, w in plain_entries(rows).items()}
    for text, _ in rows[::7]:
        folded = toxicity.folded(text)
        places = {}
        for at in range(len(folded)):
            weights = [w for e, w in learned.entries.items() if folded.startswith(e, at)]
            if weights and not any(folded.startswith(x, s) for x in learned.exceptions for s in range(max(0, at - len(x) + 2), at + 1) if s + len(x) - 1 > at):
                places[at] = max(weights)
        assert dict(learned.hits(folded)) == pytest.approx(places)
        words, total = folded.count(" ") - 1, sum(places.values())
        assert learned.features(text) == pytest.approx([total / words**0.5, total / words, max(places.values())] if places else [0.0, 0.0, 0.0])


def test_sample_is_bounded_by_rows(spark):
    """One id in very many rows teaches as one; the least of its texts."""
    from silverloom.llm.labelled import sample

    ids = [i for i in range(400) if not held(i)]
    docs = spark.createDataFrame([(ids[0], f"text {k}") for k in range(3000)] + [(i, f"doc {i}") for i in ids[1:]] + [(ids[1], None)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in ids], "doc_id long, quality int")
    found = sample(docs, labels, "quality").collect()
    assert len(found) == len(ids) and [r["text"] for r in found if r["text"].startswith("text")] == ["text 0"] and "" in {r["text"] for r in found}


def test_additive_model_finds_interaction():
    rng = np.random.default_rng(4)
    x = rng.random((4000, len(quality.FEATURES)))
    y = ((x[:, 3] > 0.5) ^ (x[:, 7] > 0.5)).astype(float)
    model = quality.fit(x, y)
    assert (3, 7) in model.pairs
    assert ((model.score(x) > 0.5) == y).mean() > 0.95


def test_folding_and_exceptions():
    same = {toxicity.folded(t) for t in ("You IDIOT", "you id10t", "yоu іdiоt", "y0u 1di0t", "you ｉｄｉｏｔ", "you id​iot")}
    assert len(same) == 1
    lexicon = toxicity.Lexicon({toxicity.folded("trash"): 3.0, toxicity.folded("clown"): 2.0, " pre": 1.5}, [toxicity.folded("trash can")])
    assert lexicon.hits(toxicity.folded("the trash can")) == []
    assert [w for _, w in lexicon.hits(toxicity.folded("TR4SH, c1own premier! trashy"))] == [3.0, 2.0, 1.5]
    short, long = (lexicon.features(t) for t in ("trash", "trash " + "word " * 99))
    assert short[1] == pytest.approx(100 * long[1]) and lexicon.features(None) == [0, 0, 0]
