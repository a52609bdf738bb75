"""Collocations, spot signatures and the Merkle manifest against plain versions, and on odd rows."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from leptide.llm import collocations, merkle, queries, spotsigs
from tests.llm.conftest import prose

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


# ---- 11 collocations -------------------------------------------------------


def plain_collocations(rows, min_count, top=2000):
    f, n = {}, Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        own = f.setdefault(lang, Counter())
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOW)):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for k in range(1, 6):
                own.update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang, own in f.items():
        many = {p: a for p, a in own.items() if len(p) > 1 and a >= min_count}
        gone = set()
        for p, a in many.items():
            for k in range(2, len(p)):
                for i in range(len(p) - k + 1):
                    if a >= own[p[i : i + k]]:
                        gone.add(p[i : i + k])
        ranked = []
        for p, a in many.items():
            if p in gone:
                continue
            score, k = min((1000 * a * n[lang] // (own[p[:k]] * own[p[k:]]), k) for k in range(1, len(p)))
            ranked.append((-score, -a, " ".join(p).encode(), own[p[:k]], own[p[k:]]))
        for r, (score, a, p, left, right) in enumerate(sorted(ranked)[:top], 1):
            out.append((lang, r, p.decode(), -a, left, right, n[lang], -score))
    return sorted(out)


def talk(seed, n):
    rng = random.Random(seed)
    words = [f"w{int(rng.paretovariate(0.9))}" for _ in range(n)]
    for _ in range(n // 12):
        i = rng.randrange(len(words))
        words[i:i] = rng.choice(["in the light of", "New York City", "as well as the other", "é è"]).split()
    return "".join(w + rng.choice([" ", " ", " ", " ", "  ", "\t", ", ", ".\n"]) for w in words)


@pytest.mark.parametrize("budget", [1 << 22, 40, 3])
def test_phrases_as_counted_plainly(spark, budget):
    """Whole groups, packed cells, and cells divided many times over; batches of a few texts."""
    rows = [(["en", "fr", None, "und"][i % 4], talk(i, 30 + 40 * (i % 7))) for i in range(60)] + [("en", talk(1, 900))] * 3 + [("en", ""), ("fr", None)]
    df = spark.createDataFrame(rows, "lang string, text string").repartition(5)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        got = [tuple(r) for r in collocations.collocations(df, min_count=5, budget=budget).collect()]
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert sorted(got) == plain_collocations(rows, 5) and len(got) > 100


def test_top_of_each_language(spark):
    rows = [("a", talk(i, 200)) for i in range(12)] + [("b", talk(99, 400))]
    df = spark.createDataFrame(rows, "lang string, text string")
    got = sorted(tuple(r) for r in collocations.collocations(df, min_count=3, top=7, slices=3).collect())
    assert got == plain_collocations(rows, 3, top=7)


def test_division_keeps_the_budget():
    load = np.array([3, 4, 0, 30, 2, 9, 1, 10, 0, 5])
    d = collocations.Division.of(load, 10)
    held = Counter()
    for g, p, n in zip(d.group.tolist(), d.parts.tolist(), load.tolist()):
        for k in range(p):
            held[g + k] += n / p
    assert max(held.values()) <= 10 and d.parts[3] == 3 and sum(held.values()) == load.sum()


def test_two_words_with_one_number_are_noticed(spark, monkeypatch):
    """Numbers that meet are found by counting, and others are tried."""
    tried, real = [], collocations.count_words

    def narrow(docs, seed):
        tried.append(seed)
        found = real(docs, seed)
        return found if seed else found.withColumn("w1", F.when(F.col("w1") != 0, F.pmod("w1", F.lit(3)) + 1).otherwise(0))

    rows = [("en", talk(5, 300))]
    df = spark.createDataFrame(rows, "lang string, text string")
    monkeypatch.setattr(collocations, "count_words", narrow)
    got = sorted(tuple(r) for r in collocations.collocations(df, min_count=3).collect())
    assert tried == [0, 1] and got == plain_collocations(rows, 3)


def test_slices_divide_no_piece(monkeypatch):
    texts = [talk(i, n) for i, n in enumerate([3, 900, 0, 40, 2000])] + ["x " * 3000, None]
    batch = pa.RecordBatch.from_pydict({"lang": ["en", "fr", "en", None, "fr", "en", "en"], "text": texts})

    def pieces():
        return [
            [bytes(w.raw[s:e]).decode() for s, e, p in zip(w.start, w.end, w.piece) if p == at]
            for w in collocations.batch_words(batch, 0) for at in np.unique(w.piece)
        ]

    whole = pieces()
    monkeypatch.setattr(collocations, "SLICE", 100)
    assert pieces() == whole and len(list(collocations._slices(batch))) > 50
    want = [re.findall(r"[^\x20\x09]+", p) for t in texts for p in re.split(r"[.,;:!?\x0A-\x0D]", (t or "").translate(LOW))]
    assert whole == [p for p in want if p]


def test_collocations_of_odd_rows(spark, odd, none):
    assert collocations.collocations(none, min_count=2).collect() == []
    rows = [(r["lang"], r["text"]) for r in odd.select("lang", "text").collect()]
    assert sorted(tuple(r) for r in collocations.collocations(odd, min_count=3).collect()) == plain_collocations(rows, 3)
    with pytest.raises(ValueError):
        collocations.frequent_phrases(none, min_count=2, longest=6)


# ---- 12 spot signatures ----------------------------------------------------


def plain_signature(text, chain=spotsigs.CHAIN):
    import regex

    words = [regex.sub(spotsigs.EDGES, "", w) for w in re.split(r"[\x20\x09-\x0D]+", (text or "").lower())]
    words = [w for w in words if w]
    spots = []
    for i, w in enumerate(words):
        behind = [x for x in words[i + 1 :] if x not in spotsigs.ANCHORS][:chain] if w in spotsigs.ANCHORS else []
        if len(behind) == chain:
            spots.append([w, *behind])
    if not spots and words:
        spots = [words[i : i + chain + 1] for i in range(max(1, len(words) - chain))]
    return {hashlib.md5(" ".join(s).encode()).hexdigest()[:8] for s in spots}


def plain_likeness(a, b):
    return 1.0 if not a | b else len(a & b) / len(a | b)


def spoken(seed, n):
    rng = random.Random(seed)
    return " ".join(rng.choice(["the", "of", "and", "is", "der"]) if rng.random() < 0.4 else w for w in prose(seed, n).split())


def test_signatures_of_odd_rows(spark, odd, none):
    out = odd.select("text", spotsigs.fingerprint(spotsigs.signature(F.col("text"))).alias("f")).collect()
    for r in out:
        assert r["f"] == "".join(sorted(plain_signature(r["text"]))), (r["text"] or "")[:40]
    assert spotsigs.with_edited(none).collect() == []


def test_likeness_is_pruned_by_length(spark):
    sets = [[], [1], [1, 2, 3], [2, 3, 4], list(range(10)), list(range(1, 11))]
    df = spark.createDataFrame([(a, b) for a in sets for b in sets], "a array<int>, b array<int>")
    for r in df.select("a", "b", spotsigs.likeness(F.col("a"), F.col("b")).alias("all"), spotsigs.likeness(F.col("a"), F.col("b"), at_least=0.6).alias("near")).collect():
        want = plain_likeness(set(r["a"]), set(r["b"]))
        assert r["all"] == want
        short, long = sorted([len(r["a"]), len(r["b"])])
        assert r["near"] == (0.0 if short < 0.6 * long else want)


@pytest.mark.parametrize("ranges", [1, 2, 7])
def test_next_and_edited_text(spark, odd, ranges):
    rows = [(i * i - 50, spoken(i, 5 + i % 60)) for i in range(80)] + [(r["doc_id"], r["text"]) for r in odd.collect() if r["doc_id"] is None or r["doc_id"] > 12]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    out = spotsigs.with_next(df, order="doc_id", value="text", ranges=ranges).collect()
    assert len(out) == len(rows)
    known = [r for r in rows if r[0] is not None]
    for a, b in zip(sorted(known, reverse=True), sorted(known, reverse=True)[1:]):
        if Counter(k for k, _ in known)[a[0]] == 1 and Counter(k for k, _ in known)[b[0]] == 1:
            assert [r["next"] for r in out if r["doc_id"] == a[0]] == [b[1]]
    # each row is the next of one
    assert Counter(r["next"] for r in out) == Counter(t for _, t in rows)
    one = spark.createDataFrame([(3, "the one only text")], "doc_id long, text string")
    r = spotsigs.with_edited(one).first()
    assert (r["doc_id"], r["n_chars"], r["edited"]) == (3, 17, "the one only text"[:9] + "the one ")


def test_near_pairs(spark, odd, none):
    rng, texts = random.Random(4), []
    for k in range(40):
        words = spoken(k, rng.choice([12, 60, 300])).split()
        for _ in range(rng.choice([1, 3])):
            for _ in range(rng.randrange(4)):
                words[rng.randrange(len(words))] = f"new{rng.randrange(10**6)}"
            texts.append(" ".join(words))
    rows = [*enumerate(texts), *((100 + i, t) for i, t in enumerate(texts[::5]))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for at_least in (0.5, 0.8, 1.0):
        members, pairs = spotsigs.near_pairs(df, at_least=at_least)
        sets = {i: frozenset(plain_signature(t)) for i, t in rows}
        want = {i: min(j for j in sets if sets[j] == sets[i]) for i in sets}
        assert {r["doc_id"]: r["class"] for r in members.collect()} == want
        reps = sorted(set(want.values()))
        alike = {(a, b) for a in reps for b in reps if a < b and plain_likeness(sets[a], sets[b]) >= at_least}
        assert {(r["a"], r["b"]) for r in pairs.collect()} == alike and (alike or at_least == 1.0)
    assert spotsigs.near_pairs(none)[1].collect() == []
    assert {r["class"] for r in spotsigs.near_pairs(odd)[0].where("doc_id in (1, 2, 12)").collect()} == {1}


# ---- 13 Merkle manifest ----------------------------------------------------


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def plain_manifest(rows, fan=16):
    """rows: (doc_id, source, lang, n_chars, text)."""

    def leaf(r, text):
        return sha(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in (*r[:4], text)])

    def tree(digests):
        levels = [digests]
        while len(levels[-1]) > 1:
            low = levels[-1]
            levels.append([sha(*low[i : i + fan]) for i in range(0, len(low), fan)])
        return levels

    def path(levels, i):
        steps = []
        for low in levels[:-1]:
            a = i // fan * fan
            steps.append(("".join(low[a:i]), "".join(low[i + 1 : a + fan])))
            i //= fan
        return steps

    groups = {}
    for r in rows:
        groups.setdefault(r[1], []).append(r)
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = []
    for s in names:
        groups[s].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r, r[4])))
        trees.append(tree([leaf(r, r[4]) for r in groups[s]]))
    top = tree([t[-1][0] for t in trees])
    out = []
    for k, s in enumerate(names):
        for i, r in enumerate(groups[s]):
            steps = path(trees[k], i) + path(top, k)
            hit = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0
            h = leaf(r, r[4].translate(LOW) if hit and r[4] is not None else r[4])
            for a, b in steps:
                h = sha(a, h, b)
            out.append((r[0], leaf(r, r[4]), trees[k][-1][0], top[-1][0], sha(*[a + b for a, b in steps]), h, h == top[-1][0]))
    return out


def given(spark, rows, path):
    df = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")
    df.write.mode("overwrite").parquet(f"{path}/documents.parquet")
    return [tuple(r) for r in queries.QUERIES["op13_merkle_manifest"](spark, str(path)).collect()]


@pytest.mark.parametrize("case", ["many", "hot", "sources", "one", "two", "none"])
def test_manifest(spark, tmp_path, case):
    row = lambda i, s: (i, s, "en", i % 9, f"Text {i} é\nOf Rows" if i % 7 else None)
    rows = {
        "many": [row(i, ["a", "b", None, "é", "", "a"][i % 6]) for i in range(400)] + [(None, "b", None, None, ""), (None, "b", None, None, ""), (7, "b", "x", None, "Again"), (7, "b", "x", None, "Again")],
        "hot": [row(i * 3, "big" if i % 3 else f"s{i}") for i in range(900)],
        "sources": [row(i, f"s{i}") for i in range(300)],
        "one": [row(5, "a")],
        "two": [row(5, "a"), row(10, None)],
        "none": [],
    }[case]
    assert sorted(given(spark, rows, tmp_path), key=repr) == sorted(plain_manifest(rows), key=repr)


def test_manifest_of_odd_rows(spark, odd):
    """Columns that clash with those of the result are left out unless carried."""
    rows = odd.withColumn("leaf", F.sha2(F.coalesce("text", F.lit("")), 256))
    out = merkle.manifest(rows, group="lang", order="doc_id", leaf="leaf", carry=["score", "row"], fan=3)
    assert out.columns == ["doc_id", "leaf", "score", "row", "subroot", "root", "steps"]
    got = out.withColumn("back", merkle.fold(F.col("leaf"), F.col("steps"))).collect()
    assert len(got) == odd.count() and all(r["back"] == r["root"] for r in got)
    assert len({r["root"] for r in got}) == 1 and len({r["subroot"] for r in got}) == 2


def test_a_task_splits_texts_into_words_in_little_memory():
    import tracemalloc

    from leptide.llm import common

    batch = pa.RecordBatch.from_pydict({"lang": ["en"] * 400, "text": ["some words here " * 1250 + "."] * 400})
    common._powers.cache_clear()
    tracemalloc.start()
    for _ in collocations.batch_words(batch, 0):
        pass
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 150_000_000
