"""Substring dedup, collocations and token alignment against brute force."""

import random
import re
from collections import Counter, defaultdict
from hashlib import sha256

import numpy as np
import pytest
from .cases import LONG, documents, empty, odd

from silverloom.llm import alignment, collocations, substrings

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def small(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, lang string")


# --- substring dedup


def repeats_removed(rows, window):
    """(doc_id, n_words, n_removed, kept_text) by a table of all windows."""
    words = [WORD.findall(t or "") for _, t in rows]
    place = lambda d: (d is None, d or 0)
    least = {}
    for (d, _), w in zip(rows, words):
        for i in range(len(w) - window + 1):
            key = tuple(w[i : i + window])
            least[key] = min(least.get(key, place(d)), place(d))
    out = []
    for (d, _), w in zip(rows, words):
        gone = set()
        for i in range(len(w) - window + 1):
            if least[tuple(w[i : i + window])] < place(d):
                gone.update(range(i, i + window))
        out.append((d, len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone)))
    return sorted(out, key=repr)


def removed(df, window, **options):
    found = substrings.remove_repeats(df, window, **options)
    assert found.columns == ["doc_id", "n_words", "n_removed", "kept_text"]
    return sorted((tuple(r) for r in found.collect()), key=repr)


@pytest.mark.parametrize("window", [5, 12])
def test_repeats_as_brute_force(spark, window):
    draw = random.Random(window)
    passages = [" ".join(draw.choice("abcdefgh") for _ in range(draw.randint(3, 40))) for _ in range(12)]
    rows = []
    for i in range(150):
        parts = [draw.choice(passages) if draw.random() < 0.5 else " ".join(f"w{draw.randint(0, 500)}" for _ in range(draw.randint(0, 25))) for _ in range(5)]
        rows.append((draw.choice([i, i, i // 2, None]), draw.choice([" ", "\n", "\t \x0b"]).join(parts)))
    rows += [(500, "a " * 300), (501, "a " * 80), (502, "a b " * 100), (503, "b a " * 30), (504, "x\xa0y " * 40), (505, "x\xa0y " * 20)]
    df = small(spark, [(d, t, "en") for d, t in rows])
    wanted = repeats_removed(rows, window)
    assert any(r[2] for r in wanted)
    assert removed(df, window) == wanted
    assert removed(df, window, shard_chars=1000, bucket_chars=2000) == wanted


def test_repeats_hot_anchor(spark, monkeypatch):
    monkeypatch.setattr(substrings, "HOT_ROWS", 3)
    shared = " ".join(f"s{i}" for i in range(60))
    rows = [(i, f"{'own%d ' % i * 30}{shared} {'end%d ' % (i // 2) * 40}") for i in range(40)]
    assert removed(small(spark, [(d, t, "en") for d, t in rows]), 50, shard_chars=2000, bucket_chars=2000) == repeats_removed(rows, 50)


def test_repeats_odd_rows(spark):
    df = odd(spark)
    rows = [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]
    found = removed(df, 50)
    assert found == repeats_removed(rows, 50)
    assert (10, len(LONG.split()), len(LONG.split()), "") in found
    assert removed(empty(spark), 50) == []


def test_repeats_of_text_ids(spark):
    text = " ".join(f"w{i}" for i in range(70))
    df = spark.createDataFrame([("b", text), ("a", text), (None, text)], "doc_id string, text string")
    assert {r["doc_id"]: r["n_removed"] for r in substrings.remove_repeats(df).collect()} == {"a": 0, "b": 70, None: 70}


def test_window_digests():
    words = [[b"a", b"b", b"c", b"d", b"e", b"f"], [], [b"x"], [b"b", b"c", b"d", b"e", b"f", b"g"]]
    owner, at, digests, anchors = substrings.Windows(4).of(words)
    found = {(int(o), int(i)): (d, a) for o, i, d, a in zip(owner, at, digests, anchors)}
    assert sorted(found) == [(0, 0), (0, 1), (0, 2), (3, 0), (3, 1), (3, 2)]
    assert found[0, 1] == found[3, 0] and found[0, 2] == found[3, 1] and found[0, 0][0] != found[0, 1][0]
    values = np.array([5, 3, 8, 1, 9, 2], np.uint64)
    assert substrings.least_of(values, 3).tolist() == [3, 1, 1, 1] and substrings.least_of(values, 9).tolist() == []


# --- collocations


def phrases_ranked(rows, top, least):
    counts, totals = defaultdict(Counter), Counter()
    for text, lang in rows:
        text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", text):
            words = re.findall(r"[^\x20\x09]+", piece)
            totals[lang or "und"] += len(words)
            for k in range(1, 5):
                for i in range(len(words) - k + 1):
                    counts[lang or "und"][tuple(words[i : i + k])] += 1
    out = []
    for lang, f in counts.items():
        kept = []
        common = {p: a for p, a in f.items() if a >= least and len(p) > 1}
        covered = {p[i : i + n] for p, a in common.items() for n in range(2, len(p)) for i in range(len(p) - n + 1) if p[i : i + n] in common and 100 * a >= 80 * common[p[i : i + n]]}
        for p, a in common.items():
            if p not in covered:
                score, k = min((2_000_000 * a // (f[p[:k]] + f[p[k:]]), k) for k in range(1, len(p)))
                kept.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for nth, (score, a, phrase, left, right) in enumerate(sorted(kept)[:top], 1):
            out.append((lang, nth, phrase.decode(), -a, left, right, totals[lang], -score))
    return sorted(out)


def mined(df, **options):
    found = collocations.collocations(df, **options)
    assert found.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    return sorted(tuple(r) for r in found.collect())


@pytest.mark.parametrize("group_suffixes", [1 << 21, 200, 20])
def test_collocations_as_brute_force(spark, group_suffixes):
    draw = random.Random(3)
    stock = ["the", "The", "of", "new", "york", "é", "東", "a", "b", "c\x00", "ÀB"]
    rows = []
    for i in range(200):
        words = [draw.choice(stock) if draw.random() < 0.8 else f"r{draw.randint(0, 90)}" for _ in range(draw.randint(0, 30))]
        rows.append(("".join(w + draw.choice([" ", " ", " ", "\t ", ". ", "\n", ",", "\x85 "]) for w in words), draw.choice(["en", "en", "fr", None, "und"])))
    rows += [("new york city hall " * 30, "en"), ("a " * 200, "fr"), (None, "en"), ("", "xx")]
    df = small(spark, [(i, t, lang) for i, (t, lang) in enumerate(rows)]).repartition(3)
    assert mined(df, top=40, least=10, group_suffixes=group_suffixes) == phrases_ranked(rows, 40, 10)


def test_collocations_small_memory(spark, monkeypatch):
    monkeypatch.setattr(collocations, "_HELD_SUFFIXES", 50)
    monkeypatch.setattr(collocations, "_CHUNK_CHARS", 20)
    rows = [("One two three, one two", "en")] * 20 + [("three one two three", "en")] * 15
    df = small(spark, [(1, t, lang) for t, lang in rows])
    assert mined(df) == phrases_ranked(rows, 2000, 30)


def test_collocations_odd_rows(spark):
    df = odd(spark)
    rows = [(r["text"], r["lang"]) for r in df.select("text", "lang").collect()]
    assert mined(df) == phrases_ranked(rows, 2000, 30)
    assert mined(empty(spark)) == []


# --- token alignment


@pytest.fixture(scope="module")
def pair():
    with open(alignment.BYTE_BPE, encoding="utf-8") as f, open(alignment.PIECE_BPE, "rb") as g:
        return alignment.Pair(f.read(), g.read())


def aligned_plainly(pair, rows):
    """The contract's columns: whole texts, sets of ends, a dictionary of counts."""
    each = []
    for doc_id, text in rows:
        groups = []
        if text:
            a, b = pair.a.encode(" " + text, add_special_tokens=False).ids, pair.b.encode(text)
            ours, theirs = [pair.a_bytes[i] for i in a], [pair.b_bytes[i] for i in b]
            if b"".join(ours) == b"".join(theirs) == (" " + text).encode():
                ends_a, ends_b = np.cumsum([len(x) for x in ours]).tolist(), np.cumsum([len(x) for x in theirs]).tolist()
                at, before = {e: j for j, e in enumerate(ends_b, 1)}, (0, 0)
                for i, e in enumerate(ends_a, 1):
                    if e in at:
                        groups.append((a[before[0] : i], b[before[1] : at[e]]))
                        before = i, at[e]
        each.append((doc_id, groups))
    counts = Counter((a[-1], b[-1]) for _, groups in each for a, b in groups)
    best = defaultdict(int)
    for (_, b), n in counts.items():
        best[b] = max(best[b], n)
    out = []
    for doc_id, groups in each:
        links = [(a[-1], b[-1]) for a, b in groups]
        text = ";".join(f"{','.join(map(str, a))}|{','.join(map(str, b))}" for a, b in groups)
        n_best, total = sum(counts[x] == best[x[1]] for x in links), sum(counts[x] for x in links)
        out.append((doc_id, sum(len(a) for a, _ in groups), sum(len(b) for _, b in groups), len(groups), len(links), n_best, total, text))
    return sorted(out, key=repr)


TEXTS = [
    " lead", "trail ", "a  b", "x▁y", "fox  jumps over\nand runs", "a\nb \n c", "\t", " ", "  ", "café café", "東京 is 한국", "<|endoftext|> <s> </s> <unk> <0x41>", "\x00 \x01",
    "a b 　 c", "don't we'll I'm", "1234567 89", "\U0001f600\U0001f600 ok", "ﬁ x", "word", "-", "a \u0085 b", " x",
]


@pytest.mark.parametrize("max_pairs", [1 << 22, 700])
def test_alignment_as_brute_force(spark, pair, max_pairs):
    rows = [(r["doc_id"], r["text"]) for r in documents(spark).select("doc_id", "text").limit(60).collect()]
    rows += [(None, None), (1000, ""), (1000, "")] + [(2000 + i, t) for i, t in enumerate(TEXTS)]
    df = spark.createDataFrame([(d, t, "x") for d, t in rows], "doc_id long, text string, groups string").repartition(5)
    found = alignment.align(df, max_pairs=max_pairs)
    assert found.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups"]
    assert sorted((tuple(r) for r in found.collect()), key=repr) == aligned_plainly(pair, rows)


def test_alignment_odd_rows(spark, pair):
    df = odd(spark)
    rows = [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]
    assert sorted((tuple(r) for r in alignment.align(df).collect()), key=repr) == aligned_plainly(pair, rows)
    assert alignment.align(empty(spark)).collect() == []


def groups_of(pair, text, whole=False):
    """Groups as text, None where the tokens do not make up the text."""
    signs = [f"{i}{x}" for i in range(len(pair.a_bytes)) for x in ",|"] + [f"{i}{x}" for i in range(len(pair.b_bytes)) for x in ",;"]
    found = pair.align([text] if whole else pair.parts(text))
    return ";".join(found.texts(signs, 2 * len(pair.a_bytes))) if found.good.all() else None


def test_parts_have_the_ids_of_whole_texts(pair):
    for text in [*TEXTS, "x" + " " * 5000 + "y z", "\n" * 3000, "é" * 500 + " b"]:
        assert groups_of(pair, text) == groups_of(pair, text, whole=True)


def test_ranks_give_the_ids_of_the_vocabulary(pair, spark):
    assert pair.quick is not None
    for text in [*TEXTS, *(r["text"] for r in documents(spark).select("text").collect() if r["text"])]:
        for part in pair.parts(text):
            assert pair.ids_a(" " + part) == pair.a.encode(" " + part, add_special_tokens=False).ids


@pytest.mark.parametrize("text", ["x" + " " * 1_000_000 + "y", "\n" * 1_000_000, "ab" * 500_000, "!" * 1_000_000])
def test_very_long_parts(pair, text):
    found = pair.align(pair.parts(text))
    assert found.good.all() == (b"".join(pair.b_bytes[i] for i in pair.b.encode(text)) == (" " + text).encode())
    if found.good.all():
        assert b"".join(pair.a_bytes[i] for i in found.a) == (" " + text).encode() and found.n_links.sum() >= 1


def test_perfect_hash():
    for n in (0, 1, 2, 100, 50_000):
        keys = np.unique(np.random.default_rng(n).integers(0, 1 << 48, n).astype(np.uint64))
        numbers = alignment.PerfectHash(keys)(keys)
        assert sorted(numbers.tolist()) == list(range(len(keys)))
    table = alignment.PairCounts(keys)
    others = np.setdiff1d(np.arange(1000, dtype=np.uint64), keys)
    assert (table.numbers(keys) >= 0).all() and (table.numbers(others) == -1).all()


def test_queries_of_new_operators(spark, pair):
    rows = [(r["doc_id"], r["text"]) for r in documents(spark).select("doc_id", "text").collect()]
    from silverloom.llm.registry import load

    queries, sql = load()
    found = {r["doc_id"]: r for r in queries["op13_token_alignment"](spark, "/root/testdata/sf0.001").collect()}
    for doc_id, n_a, *_, groups in aligned_plainly(pair, rows):
        assert found[doc_id]["n_a"] == n_a and found[doc_id]["groups_sha256"] == (sha256(groups.encode()).hexdigest() if n_a else "")
    kept = {r["doc_id"]: r["kept_sha256"] for r in queries["op11_substring_dedup"](spark, "/root/testdata/sf0.001").collect()}
    assert kept == {d: sha256(t.encode()).hexdigest() for d, _, _, t in repeats_removed(rows, 50)}
    assert "op12_collocations" in sql and "op11_substring_dedup" in sql
