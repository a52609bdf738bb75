"""Every operator against a plain version, and on odd rows."""

import hashlib
import itertools
import random
import re
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from leptide.llm import bpe, decontaminate, line_dedup, near_dup, perplexity, pii, queries, rule_classifier, sharding, token_count, url_filter
from leptide.llm.common import components, shingles, word_hashes
from tests.llm.conftest import prose

WORD = r"[^\x20\x09-\x0D]+"


# ---- 1 sharding ----------------------------------------------------------


def plain_capacity(sizes, shards):
    def fits(c):
        used, room = 1, c
        for s in sizes:
            if s > c:
                return False
            if s > room:
                used, room = used + 1, c
            room -= s
        return used <= shards

    low, high = 0, sum(sizes)
    while high - low > 1:
        mid = (low + high) // 2
        low, high = (low, mid) if fits(mid) else (mid, high)
    return high


@pytest.mark.parametrize("seed", range(12))
def test_capacity_is_the_smallest(seed):
    rng = random.Random(seed)
    sizes = [rng.choice([1, 16, rng.randrange(1, 100), rng.randrange(1, 9000)]) for _ in range(rng.choice([1, 3, 60, 900]))]
    shards, ends = rng.choice([1, 2, 5]), np.cumsum(sizes)
    known = sharding.Ends(int(ends[-1]))
    while True:
        low, high = known.bounds(shards)
        doubt = known.doubtful(low, high, shards) if high - low > 1 else []
        if not doubt:
            break
        width, cells = max(1, sum(b - a for a, b in doubt) // 1600), {}
        for e in map(int, ends):
            if any(a < e < b for a, b in doubt):
                c = cells.setdefault(e // width, [e, e, 0])
                c[:] = min(c[0], e), max(c[1], e), c[2] + 1
        known.learn(doubt, np.array(list(cells.values()), np.int64).reshape(-1, 3))
    cuts = [0, *known.even_cuts(high, shards)]
    assert max(b - a for a, b in itertools.pairwise(cuts)) == plain_capacity(sizes, shards)
    assert set(cuts) <= {0, *ends.tolist()}


def test_shards(spark, odd, none):
    out = [r.asDict() for r in sharding.minimax_shards(odd, shards=4).collect()]
    assert len(out) == odd.count()
    assert len({(r["group"], r["shard"]) for r in out}) == len({r["group"] for r in out})
    for s in {r["shard"] for r in out}:
        assert sorted(r["slot"] for r in out if r["shard"] == s) == list(range(sum(r["shard"] == s for r in out)))
    assert {r["size"] for r in out if r["doc_id"] == 5} == {16}
    assert sharding.minimax_shards(none, shards=4).count() == 0


def test_equal_sized_groups_are_even(spark):
    df = spark.createDataFrame([(i, f"text {i:06d}") for i in range(4000)], "doc_id long, text string")
    n = [r["count"] for r in sharding.minimax_shards(df, shards=40).groupBy("shard").count().collect()]
    assert len(n) == 40 and max(n) - min(n) <= 1


# ---- 2 URL rules ---------------------------------------------------------


def plain_rule(url):
    host = path = ""
    if url and "://" in url:
        m = re.match(r"([^/?#]*)([^?#]*)", url.split("://", 1)[1])
        host, path = "".join(c.lower() if "A" <= c <= "Z" else c for c in m[1]), m[2]
    best = None
    for what, rule in queries.URL_RULES:
        h, p = rule[: rule.index("/")], rule[rule.index("/") :]
        if (host == h or host.endswith("." + h)) and path.startswith(p) and (best is None or len(rule) > len(best[1])):
            best = (what, rule)
    return host, path, best


def test_urls(spark):
    urls = ["http://A.example.COM/en/x", "http://www.example.com/en/x?q=/net/", "https://b.net/es/", "https://b.net", "b.net/es/", "", None, "x://y://z.com/", "http://notcom/", "http://n.com", "http://xnet/es/", "ftp://q.NET/fr/a#b", "http://É.com/x"]
    urls += ["http://shop%d.org/casino/deal-%d.html?ref=a" % (k, k) for k in range(60)] + ["http://shop%d.org/books/deal-%d.html" % (k, k) for k in range(60)]
    pages = spark.createDataFrame([(i, u, "x") for i, u in enumerate(urls)] + [(None, None, None), (0, urls[0], "y")], "page_id long, url string, rule string")
    labels = spark.createDataFrame([(u, "casino" in u) for u in urls if u and ".org" in u] + [("http://a", None)], "url string, bad boolean")
    out = url_filter.judge_urls(pages, labels, queries.URL_RULES).collect()
    assert len(out) == len(urls) + 2
    for r in out:
        host, path, best = plain_rule(r["url"])
        assert (r["host"], r["path"], r["rule"]) == (host, path, best and best[1])
        assert r["verdict"] == (best[0] if best else "block" if r["url"] and "casino" in r["url"] else "allow")
    assert url_filter.judge_urls(pages.limit(0), labels.limit(0), queries.URL_RULES).count() == 0


# ---- 3 decontamination ---------------------------------------------------


def test_seeds_survive_substitutions(spark, odd, none):
    rng = random.Random(5)
    items = [(k, prose(100 + k, 40)) for k in range(20)] + [(50, None), (51, ""), (52, "too short"), (None, prose(200, 30))]
    docs, want = [(1000, prose(300, 200)), (1001, None), (1002, ""), (None, "x " + items[3][1])], set()
    for k in range(20):
        words = items[k][1].split()
        for at in rng.sample(range(40), 5):  # an eighth substituted
            words[at] = "other%d" % at
        docs.append((k, prose(400 + k, 50) + " " + ", ".join(words).title() + ". " + prose(500 + k, 50)))
        want.add((k, k))
    df = spark.createDataFrame([(i, t, 1) for i, t in docs] + [(0, docs[4][1], 1)], "doc_id long, text string, item_id int")
    bench = spark.createDataFrame([(i, t, "x") for i, t in items], "item_id long, text string, doc_id string")
    out = decontaminate.contaminated(df, bench).collect()
    assert {(r["doc_id"], r["item_id"]) for r in out} == want | {(None, 3)}
    assert all(r["matched"] >= 30 and 0 <= r["doc_from"] < r["doc_to"] for r in out)
    assert decontaminate.contaminated(odd, bench).count() == 0
    assert decontaminate.contaminated(none, bench).count() == 0
    assert decontaminate.contaminated(df, bench.limit(0)).count() == 0


def test_windows_are_looked_up_as_rows(spark, monkeypatch):
    """The bit maps are asked in compiled filters, not inside a lambda, and only documents with a diagonal travel on."""
    held = {}

    def saved(df, name):
        held[name] = df
        return saved_as_it_is(df, name)

    saved_as_it_is = decontaminate.saved
    monkeypatch.setattr(decontaminate, "saved", saved)
    docs = spark.createDataFrame([(k, prose(k, 200)) for k in range(30)], "doc_id long, text string")
    items = spark.createDataFrame([(1, " ".join(prose(7, 200).split()[50:90]))], "item_id long, text string")
    found = decontaminate.contaminated(docs, items)
    lines = [x for x in held["diagonals"]._jdf.queryExecution().optimizedPlan().toString().split("\n") if "getbit" in x]
    assert len(lines) == 2 and not any("lambda" in x for x in lines)
    assert "windows" not in held and held["diagonals"].select("row").distinct().count() == 1
    assert [(r["doc_id"], r["matched"], r["doc_from"], r["doc_to"]) for r in found.collect()] == [(7, 40, 50, 90)]


def test_short_items_survive_substitutions(spark):
    rng = random.Random(8)
    items = [(k, prose(1000 + k, 15 + k % 11)) for k in range(60)]
    docs = []
    for k, text in items:
        words = text.split()
        at = (5, 11) if k == 0 else rng.sample(range(len(words)), len(words) * (10 + k % 11) // 100)
        for x in at:
            words[x] = "other%d" % x
        docs.append((k, prose(2000 + k, 40) + " " + " ".join(words) + " " + prose(3000 + k, 40)))
    docs += [(500 + k, prose(4000 + k, 200)) for k in range(20)] + [(600, items[5][1])]
    out = decontaminate.contaminated(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")).collect()
    got = {(r["doc_id"], r["item_id"]) for r in out}
    assert got == {(k, k) for k in range(60)} | {(600, 5)}
    assert all(10 * r["matched"] >= 8 * min(12, len(items[r["item_id"]][1].split())) for r in out)


# ---- 4 near duplicates ---------------------------------------------------


def plain_sets(text, width):
    words = re.findall(WORD, re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return frozenset()
    width = min(width, len(words))
    return frozenset(tuple(words[i : i + width]) for i in range(len(words) - width + 1))


def plain_components(rows, width):
    sets = {i: plain_sets(t, width) for i, t in rows if i is not None}
    up = {i: i for i in sets}

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for a, b in itertools.combinations(sets, 2):
        if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
            x, y = root(a), root(b)
            up[max(x, y)] = min(x, y)
    return {i: root(i) for i in sets}, {i: len(s) for i, s in sets.items()}


@pytest.mark.parametrize("width", [2, 5])
def test_near_duplicates_equal_all_pairs(spark, odd, none, width):
    rng = random.Random(width)
    rows = [(r["doc_id"], r["text"]) for r in odd.select("doc_id", "text").collect()]
    for g in range(6):  # groups around the limit, one of them large
        words = prose(900 + g, 60).split()
        for k in range(80 if g == 0 else 8):
            w = list(words)
            for at in rng.sample(range(60), rng.choice([0, 1, 2, 3, 5])):
                w[at] = "w%d" % rng.randrange(10**6)
            rows.append((1000 + 100 * g + k, " ".join(w)))
    df = spark.createDataFrame([(i, t, 7) for i, t in rows], "doc_id long, text string, component_id int")
    out = near_dup.near_duplicates(df, width=width).collect()
    want, n = plain_components(rows, width)
    assert len(out) == len(rows)
    for r in out:
        if r["doc_id"] is None:
            assert r["component_id"] is None and not r["kept"]
        else:
            assert (r["component_id"], r["n_shingles"], r["kept"]) == (want[r["doc_id"]], n[r["doc_id"]], want[r["doc_id"]] == r["doc_id"])
    assert near_dup.near_duplicates(none, width=width).count() == 0


def test_components_of_chains(spark):
    links = [(k, k + 1) for k in range(0, 300)] + [(1000, 1002), (1002, 1001), (2000, 2000), (2001, 2000)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {k: 0 for k in range(301)} | {1000: 1000, 1001: 1000, 1002: 1000, 2000: 2000, 2001: 2000}


def test_word_hashes_depend_on_the_word_alone():
    a, b = word_hashes("Alpha beta\u00a0x\n\tgamma alpha"), word_hashes("gamma zzz ALPHA beta\u00a0x")
    assert len(a) == 4 and a[0] == a[3] == b[2] and a[1] == b[3] and a[2] == b[0]
    assert len(shingles(a, 2)) == 3 and len(shingles(word_hashes("one"), 2)) == 1 and len(shingles(word_hashes(" \n"), 2)) == 0


# ---- 5 perplexity --------------------------------------------------------


def plain_counts(text):
    text = text or ""
    w = re.findall(WORD, text)
    often, covered = Counter(zip(w, w[1:], w[2:])), set()
    for i in range(len(w) - 2):
        if often[tuple(w[i : i + 3])] > 1:
            covered |= {i, i + 1, i + 2}
    seen, dup = set(), 0
    for line in text.split("\n"):
        dup += line in seen and bool(re.search(WORD, line))
        seen.add(line)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered)


def test_model_is_a_distribution():
    text = " ".join(prose(k, 50) for k in range(30))
    codes, n = np.unique(perplexity.ngrams(text), return_counts=True)
    model = perplexity.Model(codes.astype(np.int64), n)
    c = perplexity.CLASSES
    for context in [0, *(codes[:: len(codes) // 20] // c).tolist(), c**3 - 1]:
        assert np.exp(model.log_prob(np.arange(c, dtype=np.int64) + context * c)).sum() == pytest.approx(1, abs=1e-4)


def test_perplexity_rules(spark, odd, none):
    rows = [(r["doc_id"], r["text"], r["lang"]) for r in odd.collect()]
    rows += [(100 + k, prose(k, 150), "en") for k in range(60)] + [(300, " ".join(w + "".join(random.Random(k).choices("#*$%&|<>", k=4)) for k, w in enumerate(prose(3, 120).split())), "en"), (301, prose(9, 120), "xx"), (302, prose(8, 120), None)]
    out = perplexity.perplexity_rules(spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, lang string, kept int")).collect()
    assert len(out) == len(rows)
    texts = {i: t for i, t, _ in rows}
    for r in out:
        if r["doc_id"] is not None:
            counts = plain_counts(texts[r["doc_id"]])
            assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == counts
            assert r["base_failed"] == (counts[0] < 50 or 100 * counts[4] > 50 * counts[0])
            assert not (r["base_failed"] and r["kept"])
    assert all(r["kept"] for r in out if r["doc_id"] and 100 <= r["doc_id"] < 200) and not any(r["kept"] for r in out if r["doc_id"] == 300)
    assert perplexity.perplexity_rules(none).count() == 0


def test_models_of_every_language(spark):
    """Texts without a language have a model; a language that has only empty texts needs none, and its rows stay."""
    rows = [(k, prose(k, 80), "en") for k in range(5)] + [(10, prose(10, 80), None), (11, "", "es"), (12, None, "es"), (13, "", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    models = perplexity.fit_models(docs)
    assert set(models) == {"en", None} and models[None].cost(prose(10, 80)) < models["en"].cost(prose(10, 80))
    every = Counter(c for _, text, lang in rows if lang == "en" for c in perplexity.ngrams(text).tolist())
    counted = perplexity.count_ngrams(docs).where("lang = 'en'").collect()
    assert {r["code"]: r["n"] for r in counted} == every and models["en"].levels[-1][0].tolist() == sorted(every)
    out = {r["doc_id"]: r for r in perplexity.perplexity_rules(docs).collect()}
    assert len(out) == len(rows) and not any(out[k]["kept"] for k in (11, 12, 13)) and out[11]["log_perplexity"] == 0.0


# ---- 6 line chunks -------------------------------------------------------


def test_line_chunks(spark, odd, none):
    passage = "\n".join(prose(40 + k, 6) for k in range(12))
    long = prose(77, 60)
    docs = [(k, prose(600 + k, 9) + "\n" + passage + "\n" + prose(700 + k, 9)) for k in range(3)] + [(10, long), (11, "a\n" + long + "\nb"), (12, "short line\nonce"), (13, "")]
    docs += [(r["doc_id"], r["text"]) for r in odd.where("doc_id is null or doc_id in (5, 9)").collect()]
    df = spark.createDataFrame([(i, t, 3) for i, t in docs], "doc_id long, text string, place int")
    out = {r["doc_id"]: r for r in line_dedup.dedup_lines(df).collect()}
    assert line_dedup.dedup_lines(df).count() == len(docs)
    assert out[0]["text"] == docs[0][1] and out[10]["text"] == long and out[11]["text"] == "a\nb" and out[12]["n_removed"] == 0
    for k in (1, 2):  # shifted by nothing but the passage's own lines: only its edges may stay
        left = out[k]["text"].split("\n")
        assert left[0] == prose(600 + k, 9) and left[-1] == prose(700 + k, 9) and out[k]["n_removed"] > 0 and len(left) < 10
    assert out[5]["text"] is None and out[13]["text"] == "" and len(out[9]["text"]) == 200_000
    assert line_dedup.dedup_lines(none).count() == 0


def test_one_id_with_several_texts_keeps_its_own_lines(spark):
    """An id, or a missing one, that stands twice with different texts: only what occurred before goes."""
    same = "\n".join(prose(k, 9) for k in range(30))
    rare = "\n".join(prose(100 + k, 9) for k in range(30))
    rows = [(1, same), (2, same), (2, rare), (None, rare + "\nend"), (None, "\n".join(prose(200 + k, 9) for k in range(20))), (2, rare)]
    got = {(r["doc_id"], r["text"]) for r in line_dedup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    texts = [t for i, t in got if i is not None]
    assert (1, same) not in got or (2, same) not in got
    whole = [t for i, t in got if t in (same, rare, rows[3][1], rows[4][1])]
    # null ids come first: there the rare lines stand whole, the second text of id 2 loses them, and no other row loses any
    assert (None, rows[3][1]) in got and (None, rows[4][1]) in got and (1, same) in got
    assert len(whole) == 3 and all(len(t) < 700 for t in texts if t != same)


# ---- 7 rule ensemble -----------------------------------------------------


def test_rule_ensemble(spark, odd, none):
    good = [(k, prose(k, 60) + ".", 1) for k in range(150)]
    bad = [(1000 + k, " | ".join(prose(k, 60).upper().split()), 0) for k in range(80)]
    df = spark.createDataFrame([(i, t) for i, t, _ in good + bad], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in good + bad] + [(None, 1), (5000, None), (1, 0)], "doc_id long, label int")
    model = rule_classifier.fit_rules(df, labels)
    assert 1 <= len(model.rules) < 60
    out = {r["doc_id"]: r for r in rule_classifier.score_documents(df, model).collect()}
    assert sum(out[i]["predicted"] == y for i, _, y in good + bad) >= 0.98 * len(out)
    scored = rule_classifier.score_documents(odd, model).collect()
    assert len(scored) == odd.count() and all(0 <= r["score"] <= 1 for r in scored)
    assert rule_classifier.score_documents(none, model).count() == 0
    empty = rule_classifier.fit_rules(none, labels.limit(0))
    assert empty.rules == [] and rule_classifier.score_documents(odd, empty).first()["score"] == pytest.approx(0.5)


def plain_statistics(text):
    words, lines = [w for w in re.split(r"[\x20\x09-\x0D]+", text) if w], text.split("\n")
    n, count = len(words), lambda chars: sum(c in chars for c in text)
    symbols, upper = "#*$%&|<>", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    of_words = [n, len(text), len(words) / max(1, len(lines)), *[count(c) / max(1, n) for c in (symbols, "|", "!?", ".;:")]]
    of_words[1] /= max(1, n)
    return [*of_words, count(upper) / max(1, len(text)), count("0123456789") / max(1, len(text)), (len(text.encode()) - len(text)) / max(1, len(text)), len(set(words)) / max(1, n), len(set(lines)) / max(1, len(lines))]


def test_statistics_are_worked_out_once(spark):
    """The numbers as counted plainly; a text is split into words at one place of the plan, not at one a number."""
    texts = [*strange_texts(150), None, " a  B ", "\t#&|<>!?.;:09AZ\n\n&&||", "x\x0b\x0c\ry\u00a0z [^] - \\ É"]
    df = spark.createDataFrame([(k, x) for k, x in enumerate(texts)], "doc_id long, text string")
    out = df.select("doc_id", rule_classifier.stats_struct(F.col("text")).alias("s")).select("doc_id", "s.*")
    for row in out.collect():
        assert list(row[1:]) == pytest.approx(plain_statistics(texts[row[0]] or ""), abs=1e-12), texts[row[0]]
    model = rule_classifier.RuleModel(0.0, [(1.0, [rule_classifier.Condition(k, True, 0.5)]) for k in rule_classifier.statistic_names()])
    plan = rule_classifier.score_documents(df, model)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("split(") == 2 and plan.count("regexp_replace(") == 1


# ---- 8, 9 tokens ---------------------------------------------------------


def strange_texts(n):
    rng = random.Random(11)
    pick = lambda: rng.choice([rng.randrange(32, 127), rng.randrange(0xA0, 0x250), rng.randrange(0x4E00, 0x9FFF), 0x1F600 + rng.randrange(50), 32, 10, 9, 0xA0, 0x1C, 0x85])
    texts = ["".join(chr(pick()) for _ in range(rng.randrange(60))) for _ in range(n)]
    return texts + ["", "a" * 3000, "   \n\n  x", "1234567890" * 30, "don't WE'LL it's", "<|endoftext|> hi <|endoftext|>", prose(4, 300)]


def test_bpe_round_trip(spark, odd, none):
    tokens = queries.byte_bpe()
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks={t: i for i, t in enumerate(tokens)}, special_tokens={})
    texts = [(k, t) for k, t in enumerate(strange_texts(600))] + [(None, None), (1, "x")]
    out = bpe.encode_documents(spark.createDataFrame(texts, "doc_id long, text string"), tokens, public_tokenizers.PATTERN).collect()
    got = Counter((r["doc_id"], bytes(r["ids"]), r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in out)
    want = Counter()
    for i, t in texts:
        ids = np.array(library.encode_ordinary(t or ""), "<u4").tobytes()
        want[(i, ids, len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest())] += 1
    assert got == want
    assert bpe.encode_documents(odd, tokens, public_tokenizers.PATTERN).count() == odd.count()
    assert bpe.encode_documents(none, tokens, public_tokenizers.PATTERN).count() == 0


def test_prefix_appends_and_edits():
    coder, rng = bpe.PrefixEncoder(queries.byte_bpe()), random.Random(2)
    for _ in range(200):
        piece = bytes(rng.choice(b"abcdeinorst") for _ in range(rng.randrange(1, 25)))
        last = coder.extend(piece, [])
        more = bytes(rng.choice(b"abcdeinorst") for _ in range(5))
        assert coder.walk(piece + more, coder.extend(piece + more, last.copy())) == coder.encode(piece + more)
        at = rng.randrange(len(piece))
        new, now = coder.edit(piece, last, at, 1, b"xy")
        assert new == piece[:at] + b"xy" + piece[at + 1 :] and coder.walk(new, now) == coder.encode(new) == [coder.ranks[p] for p in bpe.merge(new, coder.ranks)]


def test_token_counts(spark, odd, none):
    path = public_tokenizers.path("byte_bpe_50k.json")
    library = Tokenizer.from_file(path)
    texts = [(k, t) for k, t in enumerate(strange_texts(600))] + [(None, None), (1, "x")]
    out = token_count.count_tokens(spark.createDataFrame(texts, "doc_id long, text string"), path, public_tokenizers.PATTERN).collect()
    got = Counter(tuple(r) for r in out)
    want = Counter()
    for i, t in texts:
        n = len(library.encode(t or "", add_special_tokens=False).ids)
        want[(i, len((t or "").encode()), n, n > 1024)] += 1
    assert got == want
    assert token_count.count_tokens(odd, path, public_tokenizers.PATTERN).count() == odd.count()
    assert token_count.count_tokens(none, path, public_tokenizers.PATTERN).count() == 0


def test_long_pretokens_merge_alike():
    merges = token_count.Vocabulary(public_tokenizers.path("byte_bpe_50k.json")).merges
    for text in ("a" * 200, prose(3, 20).replace(" ", ""), "=-" * 100):
        assert token_count._merged_length_heap(text, merges) == token_count.merged_length(text[:256], merges) or len(text) > 256


# ---- 10 personal data ----------------------------------------------------

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    return sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(reversed(digits))) % 10 == 0


def plain_spans(text):
    out = []
    for kind, pattern in PLAIN.items():
        for m in re.finditer(pattern, text or ""):
            d = re.sub("[^0-9]", "", m[0])
            ok = {"email": True, "ip": kind == "ip" and all(int(x) <= 255 for x in m[0].split(".")), "card": 16 <= len(d) <= 19 and luhn(d), "phone": 8 <= len(d) <= 15}[kind]
            if ok:
                out.append((kind, *m.span()))
    return out


def test_pii_spans(spark, odd, none):
    rng = random.Random(9)
    alphabet = ["a", "B", "@", ".", "-", "_", "+", " ", "(", ")", "1", "22", "0", "255", "4111111111111111", "x@y.z", "1.2.3.4", "+49 30 1234567", "é", "漢", "\n", "😀"]
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randrange(40))) for _ in range(1500)]
    texts += ["a@b.c_x@d.e", "a" * 50_000, "1" * 50_000, "a@b" + ".c" * 20_000, "+1" + " (" * 20_000, "0000000000000000", None, "", "999.1.1.1.1", "01.002.0003.4"]
    df = spark.createDataFrame([(k, t, "x") for k, t in enumerate(texts)], "doc_id long, text string, told string")
    out = pii.sanitise(df).collect()
    assert len(out) == len(texts)
    for r in out:
        assert [(s["kind"], s["start"], s["end"]) for s in r["base"]] == plain_spans(texts[r["doc_id"]])
        assert r["base"] or r["text"] == (texts[r["doc_id"]] or "")
    assert pii.sanitise(odd).count() == odd.count() and pii.sanitise(none).count() == 0


def test_revealing_terms(spark):
    rows = [(k, f"{prose(k, 8)} write to Quentin at q.smith@corp.example now\n{prose(k + 50, 8)}") for k in range(6)]
    rows += [(100 + k, f"{prose(k + 200, 12)} write to at now") for k in range(60)] + [(200, "Quentin alone")]
    out = {r["doc_id"]: r for r in pii.sanitise(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for k in range(6):
        terms = {s["value"].lower() for s in out[k]["spans"] if s["kind"] == "term"}
        assert "quentin" in terms and not terms & {"write", "to", "at", "now"}
        assert "[EMAIL]" in out[k]["text"] and "Quentin" not in out[k]["text"] and "write to" in out[k]["text"]
        assert [s["kind"] for s in out[k]["base"]] == ["email"]
    assert out[200]["text"] == "Quentin alone" and not out[200]["spans"]  # the entity isn't there


def test_copied_lines_reveal_terms(spark):
    """One line in many documents, and three lines in many copies each: copies count on both sides of the fraction."""
    rows = [(k, f"{prose(k, 8)}\nwrite to Quentin at q.smith@corp.example now") for k in range(40)]
    rows += [(100 + k, f"{prose(k % 3 + 900, 4)} ask Ottilie or o.lang@corp.example now") for k in range(300)]
    rows += [(1000 + k, f"{prose(k + 200, 12)} write ask or to at now") for k in range(600)]
    out = {r["doc_id"]: r for r in pii.sanitise(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for i, name in ((3, "quentin"), (150, "ottilie")):
        terms = {s["value"].lower() for s in out[i]["spans"] if s["kind"] == "term"}
        assert name in terms and not terms & {"write", "ask", "or", "to", "at", "now"}


def test_revealing_terms_everywhere(spark, odd, none):
    rows = [(k, f"{prose(k, 8)} write to Quentin at q.smith@corp.example now\n{prose(k + 50, 8)}") for k in range(6)]
    rows += [(100 + k, f"{prose(k + 200, 12)} write to at now") for k in range(60)] + [(200, "Quentin alone, quentin"), (201, None), (None, "QUENTIN")] + [(202, "by Quentin")] * 2
    df = spark.createDataFrame(rows, "doc_id long, text string")
    out = pii.sanitise(df, everywhere=True).collect()
    assert len(out) == len(rows)
    for r in out:
        terms = [(s["start"], s["end"]) for s in r["spans"] if s["kind"] == "term"]
        text = next(t for i, t in rows if i == r["doc_id"]) or ""
        assert [p for p in terms if text[slice(*p)].lower() == "quentin"] == [m.span() for m in re.finditer("(?i)quentin", text)]
        assert "quentin" not in r["text"].lower()
    joined = pii.sanitise(df, everywhere=True, few=0).collect()
    assert sorted(str((r["doc_id"], r["base"], r["spans"], r["text"])) for r in joined) == sorted(str((r["doc_id"], r["base"], r["spans"], r["text"])) for r in out)
    lean = pii.sanitise(df, everywhere=True, with_text=False).collect()
    assert sorted(str((r["doc_id"], r["spans"])) for r in lean) == sorted(str((r["doc_id"], r["spans"])) for r in out)
    assert pii.sanitise(odd, everywhere=True).count() == odd.count() and pii.sanitise(none, everywhere=True).count() == 0


def test_one_id_with_several_texts_is_linked_by_each(spark):
    """(1, a), (5, a), (5, b): the copy goes, the text that stands once stays."""
    import corpus_pipeline

    a, b = prose(1, 90), prose(2, 90)
    rows = [(1, a), (5, a), (5, b), (7, b + " tail"), (8, prose(3, 50)), (8, prose(4, 50)), (8, prose(4, 50)), (None, a), (9, None), (9, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = [(r["doc_id"], r["component_id"], r["kept"]) for r in near_dup.near_duplicates(df).collect()]
    assert sorted(found, key=repr) == sorted(
        [(1, 1, True), (5, 1, False), (5, 5, True), (7, 5, False), (8, 8, True), (8, 8, True), (8, 8, True), (None, None, False), (9, 9, True), (9, 9, True)], key=repr
    )
    left = [tuple(r) for r in corpus_pipeline.near_dup_stage(spark, df, "").collect()]
    assert sorted(left, key=repr) == sorted([r for r in rows if r not in ((5, a), (7, b + " tail"))], key=repr)


def test_common_counts():
    rng = np.random.default_rng(3)
    for n, most in ((1, 5), (7, 40), (30, 3000)):
        sets = [np.unique(rng.integers(0, most, rng.integers(1, most), dtype=np.uint64)) for _ in range(n)]
        got = near_dup.common_counts(sets)
        assert all(got[i, j] == len(np.intersect1d(sets[i], sets[j])) for i in range(n) for j in range(n) if i != j)
