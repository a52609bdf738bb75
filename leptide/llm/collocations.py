"""Phrases that occur together, counted in suffix trees built group by group.

Suffixes of the word sequences, cut off after `longest` words, are divided
vertically: by a hash of their first two words into cells, and whole cells are
packed into groups up to a budget of rows; a cell above the budget is divided
by what follows the first two words. Each group is sorted on its own and read
in one pass as a truncated suffix tree: a node is a run of equal prefixes, its
count the sum over its leaves. Nodes of depth one and two are known from the
division itself.

Only what can be a phrase is carried along: a suffix ends before a word or a
pair of words that is too rare. This is looked up in bit maps whose size
follows the number of entries up to a fixed limit; they let too much through,
never too little. Words travel as 64-bit numbers; two words with one number are
found by counting, and other numbers are tried then, so counts are exact.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import _BASE, _INVERSE, _LOWER, _VALUE, _powers, mix, saved, union_all

#: Bytes that are looked at together; a piece of text is never divided.
SLICE = 1 << 20
#: Words after which a task counts up what it holds.
HELD = 1 << 19
CELLS = 1 << 16
#: Bit maps hold between 2**16 and 2**MAP_BITS bits: 16 MB at most.
MAP_BITS = 27

_BREAK = np.zeros(256, bool)
_BREAK[[ord(c) for c in ".,;:!?"] + list(range(0x0A, 0x0E))] = True
_GAP = _BREAK.copy()
_GAP[[0x20, 0x09]] = True
WORDS = [f"w{i}" for i in range(1, 6)]
KEY = ", ".join(f"{w} long" for w in WORDS)


# ---- words of a batch ----------------------------------------------------


@dataclass
class Words:
    """Words of a slice in order: number, piece, and place in `raw` (lower-cased bytes)."""

    raw: np.ndarray
    start: np.ndarray
    end: np.ndarray
    number: np.ndarray
    piece: np.ndarray
    doc: np.ndarray


def _slices(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Bytes of some documents, a line break after each, and the document of each byte."""
    parts, docs, size = [], [], 0
    for k, text in enumerate(batch.column("text")):
        raw = np.frombuffer((text.as_py() or "").encode() + b"\n", np.uint8)
        while len(raw):
            # a long text is cut behind a break between pieces
            cut = len(raw)
            if cut > SLICE:
                near = np.flatnonzero(_BREAK[raw[SLICE - 1 :]])
                cut = SLICE + int(near[0])
            parts.append(raw[:cut])
            docs.append((k, cut))
            size, raw = size + cut, raw[cut:]
            if size >= SLICE:
                yield np.concatenate(parts), np.repeat([d for d, _ in docs], [n for _, n in docs])
                parts, docs, size = [], [], 0
    if parts:
        yield np.concatenate(parts), np.repeat([d for d, _ in docs], [n for _, n in docs])


def batch_words(batch: pa.RecordBatch, seed: int) -> Iterator[Words]:
    """Words of a batch (lang, text): runs without gaps, A-Z folded; their number depends on the language too."""
    langs = batch.column("lang").to_pylist()
    known = {x: int.from_bytes(hashlib.blake2b(f"{seed}:{x}".encode(), digest_size=8).digest(), "little") for x in set(langs)}
    salt = np.array([known[x] for x in langs], np.uint64)
    for raw, doc in _slices(batch):
        raw = _LOWER[raw]
        inside = ~_GAP[raw]
        edge = np.diff(inside.astype(np.int8), prepend=0, append=0)
        start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        power, inverse = _powers(max(21, int(len(raw)).bit_length()))
        total = np.zeros(len(raw) + 1, np.uint64)
        np.cumsum(_VALUE[raw] * power[: len(raw)], out=total[1:])
        number = mix((total[end] - total[start]) * inverse[start] + (end - start).astype(np.uint64))
        number = mix(number ^ salt[doc[start]])
        number[number == 0] = 1
        yield Words(raw, start, end, number, np.cumsum(_BREAK[raw])[start], doc[start])


class BitMap:
    """Bits of some 64-bit keys; sent to tasks as a whole, its size is bounded."""

    def __init__(self, keys: DataFrame, n: int):
        """keys: column `key`; n of them."""
        self.bits = min(MAP_BITS, max(16, int(16 * max(n, 1)).bit_length()))
        words = 1 << (self.bits - 6)
        at = F.col("key").bitwiseAND((1 << self.bits) - 1)
        rows = keys.select(F.shiftright(at, 6).alias("cell"), F.expr("shiftleft(1L, cast(key & 63 as int))").alias("bit")).groupBy("cell").agg(F.bit_or("bit").alias("bits"))
        table = np.zeros(words, np.int64)
        got = rows.toArrow()  # at most `words` rows
        table[got["cell"].to_numpy()] = got["bits"].to_numpy()
        self.table = keys.sparkSession.sparkContext.broadcast(table.view(np.uint64))

    def has(self, keys: np.ndarray) -> np.ndarray:
        at = keys & np.uint64((1 << self.bits) - 1)
        return (self.table.value[at >> np.uint64(6)] >> (at & np.uint64(63))) & np.uint64(1) == 1


def pair_key(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """One number for two words, for maps and cells only."""
    return mix(a * np.uint64(_BASE) + b)


def _held(slices: Iterator[np.ndarray]) -> Iterator[np.ndarray]:
    """Rows of numbers (one array a column) of several slices together, some HELD of them at a time."""
    kept, size = [], 0
    for rows in slices:
        kept.append(rows)
        size += rows.shape[1]
        if size >= HELD:
            yield np.concatenate(kept, axis=1)
            kept, size = [], 0
    if size:
        yield np.concatenate(kept, axis=1)


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))


# ---- depth one: words ----------------------------------------------------


def count_words(docs: DataFrame, seed: int) -> DataFrame:
    """(w1, lang, word, f) of all words, and (0, lang, null, n), the number of all occurrences."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs = batch.column("lang").to_pylist()
            totals: dict[str, int] = {}
            for w in batch_words(batch, seed):
                number, first, n = np.unique(w.number, return_index=True, return_counts=True)
                raw = w.raw.tobytes()
                words = [raw[a:b].decode() for a, b in zip(w.start[first].tolist(), w.end[first].tolist())]
                lang = [langs[k] for k in w.doc[first].tolist()]
                yield pa.RecordBatch.from_pydict({"w1": _signed(number), "lang": lang, "word": pa.array(words, pa.string()), "f": n}, schema)
                for k, c in zip(*(x.tolist() for x in np.unique(w.doc, return_counts=True))):
                    totals[langs[k]] = totals.get(langs[k], 0) + c
            yield pa.RecordBatch.from_pydict({"w1": [0] * len(totals), "lang": list(totals), "word": pa.nulls(len(totals), pa.string()), "f": list(totals.values())}, schema)

    schema = pa.schema([("w1", pa.int64()), ("lang", pa.string()), ("word", pa.string()), ("f", pa.int64())])
    rows = docs.select("lang", "text").mapInArrow(run, "w1 long, lang string, word string, f long")
    return rows.groupBy("w1", "lang", "word").agg(F.sum("f").alias("f"))


# ---- depth two: pairs, the vertical division ------------------------------


def _dense(*columns: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first place, group of each row, size of each group) of the distinct rows over several columns of numbers."""
    group = np.zeros(len(columns[0]), np.int64)
    for c in columns:
        values, code = np.unique(c, return_inverse=True)
        _, group = np.unique(group * len(values) + code, return_inverse=True)
    _, first, n = np.unique(group, return_index=True, return_counts=True)
    return first, group, n


def count_pairs(docs: DataFrame, seed: int, words: BitMap) -> DataFrame:
    """(w1, w2, f) of neighbours in a piece of which both may be frequent words."""

    def neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
        for batch in batches:
            for w in batch_words(batch, seed):
                good = words.has(w.number)
                both = np.flatnonzero(good[:-1] & good[1:] & (w.piece[:-1] == w.piece[1:]))
                yield np.stack([w.number[both], w.number[both + 1]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for a, b in _held(neighbours(batches)):
            first, _, n = _dense(a, b)
            for i in range(0, len(first), 100_000):
                at = first[i : i + 100_000]
                yield pa.RecordBatch.from_pydict({"w1": _signed(a[at]), "w2": _signed(b[at]), "f": n[i : i + 100_000]})

    rows = docs.select("lang", "text").mapInArrow(run, "w1 long, w2 long, f long")
    return rows.groupBy("w1", "w2").agg(F.sum("f").alias("f"))


@dataclass
class Division:
    """Group of each cell; a cell above the budget has `parts` groups from there on."""

    group: np.ndarray
    parts: np.ndarray

    @classmethod
    def of(cls, load: np.ndarray, budget: int) -> "Division":
        """Pack cells in order, so that a group of several cells stays within the budget."""
        group, parts = np.zeros(len(load), np.int64), np.maximum(1, -(-load // budget))
        at, room = 0, budget
        for i, n in enumerate(load.tolist()):
            if n > room:
                at, room = at + 1, budget
            group[i], room = at, room - n
            if parts[i] > 1:
                at, room = at + int(parts[i]) - 1, 0
        return cls(group, parts)


def divide(pairs: DataFrame, budget: int) -> Division:
    """From the counts of frequent pairs: their suffixes are at most as many."""
    load = np.zeros(CELLS, np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = (batch.column(c).to_numpy().view(np.uint64) for c in ("w1", "w2"))
            yield pa.RecordBatch.from_pydict({"cell": pa.array((pair_key(a, b) >> np.uint64(48)).astype(np.int64)), "f": batch.column("f")})

    got = pairs.mapInArrow(run, "cell long, f long").groupBy("cell").agg(F.sum("f").alias("f")).toArrow()  # at most CELLS rows
    load[got["cell"].to_numpy()] = got["f"].to_numpy()
    return Division.of(load, budget)


# ---- depth three and more: a subtree for each group ------------------------


def suffixes(docs: DataFrame, seed: int, pairs: BitMap, division: Division, longest: int) -> DataFrame:
    """(group, split, w1..w5, f): suffixes of three words or more, cut off at `longest` and before rare pairs; 0 where a word is missing."""
    sent = docs.sparkSession.sparkContext.broadcast((division.group, division.parts))

    def cut_off(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
        for batch in batches:
            for w in batch_words(batch, seed):
                n = len(w.number)
                linked = np.zeros(n, bool)  # with the next word
                linked[:-1] = (w.piece[:-1] == w.piece[1:]) & pairs.has(pair_key(w.number[:-1], w.number[1:]))
                cols, on = [w.number], np.ones(n, bool)
                for k in range(1, longest):
                    m = max(0, n - k)  # places with k words behind them in this slice
                    on, nxt = np.append(on[:m], np.zeros(n - m, bool)), np.zeros(n, np.uint64)
                    on[:m] &= linked[k - 1 : k - 1 + m]
                    nxt[:m] = np.where(on[:m], w.number[k:], 0)
                    cols.append(nxt)
                yield np.stack([c[cols[2] != 0] for c in cols])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group_of, parts_of = sent.value
        for rows in _held(cut_off(batches)):
            first, _, n = _dense(*rows)
            rows = rows[:, first]
            cell = (pair_key(rows[0], rows[1]) >> np.uint64(48)).astype(np.int64)
            rest = rows[2]
            for c in rows[3:]:
                rest = pair_key(rest, c)
            parts = parts_of[cell]
            group = group_of[cell] + (rest % parts.astype(np.uint64)).astype(np.int64)
            rows = np.concatenate([rows, np.zeros((5 - len(rows), rows.shape[1]), np.uint64)])
            for i in range(0, rows.shape[1], 100_000):
                at = slice(i, i + 100_000)
                cols = {"group": pa.array(group[at]), "split": pa.array(parts[at] > 1)} | {w: _signed(rows[k, at]) for k, w in enumerate(WORDS)}
                yield pa.RecordBatch.from_pydict(cols | {"f": pa.array(n[at])})

    return docs.select("lang", "text").mapInArrow(run, f"group long, split boolean, {KEY}, f long")


def read_trees(sorted_rows: DataFrame, min_count: int, longest: int) -> DataFrame:
    """(w1..w5, f) of the nodes of depth three and more of sorted groups.

    A node is a run of rows with equal prefixes. Runs at the edge of a batch,
    and those of divided cells, may be parts of a node: all are given, to be
    added up. Other nodes below min_count end here.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            cols = [batch.column(w).to_numpy() for w in WORDS]
            f, split = batch.column("f").to_numpy(), batch.column("split").to_numpy(zero_copy_only=False)
            new = np.zeros(len(f), bool)
            new[0] = True
            for c in cols[:2]:
                new[1:] |= c[1:] != c[:-1]
            for depth in range(3, longest + 1):
                c = cols[depth - 1]
                new[1:] |= c[1:] != c[:-1]
                at = np.flatnonzero(new)
                total = np.add.reduceat(f, at)
                keep = (total >= min_count) | split[at]
                keep[[0, -1]] = True
                keep &= c[at] != 0
                at = at[keep]
                out = {w: pa.array(cols[k][at] if k < depth else np.zeros(len(at), np.int64)) for k, w in enumerate(WORDS)}
                yield pa.RecordBatch.from_pydict(out | {"f": pa.array(total[keep])})

    return sorted_rows.select("split", *WORDS, "f").mapInArrow(run, f"{KEY}, f long")


def frequent_phrases(docs: DataFrame, *, min_count: int, longest: int = 5, budget: int = 1 << 22) -> tuple[DataFrame, DataFrame]:
    """All phrases of 1 to `longest` words that occur min_count times: (w1..w5, f), and the words behind the numbers.

    docs: (lang, text), neither null. `budget` bounds the rows of a group. The
    second table is (w1, lang, word, f), with (0, lang, null, n) for each
    language.
    """
    if not 3 <= longest <= 5:
        raise ValueError("phrases of three to five words")
    for seed in range(16):
        words = saved(count_words(docs, seed), "words")
        if words.where("w1 <> 0").groupBy("w1").count().where("count > 1").isEmpty():
            break
    else:
        raise RuntimeError("no numbering without two words of one number")
    words = saved(words.where(f"w1 = 0 or f >= {min_count}"), "frequent-words")
    single = words.where("w1 <> 0")
    word_map = BitMap(single.select(F.col("w1").alias("key")), single.count())
    pairs = saved(count_pairs(docs, seed, word_map).where(f"f >= {min_count}"), "pairs")

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = (batch.column(c).to_numpy().view(np.uint64) for c in ("w1", "w2"))
            yield pa.RecordBatch.from_pydict({"key": _signed(pair_key(a, b))})

    pair_map = BitMap(pairs.select("w1", "w2").mapInArrow(keyed, "key long"), pairs.count())
    found = suffixes(docs, seed, pair_map, divide(pairs, budget), longest)
    groups = found.repartition("group").sortWithinPartitions("group", *WORDS)
    deep = read_trees(groups, min_count, longest).groupBy(*WORDS).agg(F.sum("f").alias("f")).where(f"f >= {min_count}")
    none = lambda have: [F.lit(0).cast("long").alias(w) for w in WORDS[have:]]
    all_ = [single.select("w1", *none(1), "f"), pairs.select("w1", "w2", *none(2), "f"), deep.select(*WORDS, "f")]
    return saved(union_all(all_), "phrases"), words


def collocations(docs: DataFrame, *, min_count: int = 100, longest: int = 5, top: int = 2000, budget: int = 1 << 22, slices: int = 64) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the `top` phrases of each language.

    docs: (lang, text). Languages are apart; a null one is `und`. A-Z is
    folded, pieces end at `.,;:!?` and line breaks, words at spaces and tabs.
    Null and empty texts have no words; repeated rows count again; an empty
    table gives no rows. A phrase of 2 words or more that occurs a >= min_count
    times is a candidate; of its cuts into two, with l and r occurrences of the
    parts, the one with the lowest floor(1000 * a * n / (l * r)) counts, of
    equal ones that with the shortest first part. A candidate goes if a longer
    one that contains it occurs as often. Ranks follow score, then a, both
    descending, then the phrase by its bytes. Numbers are exact up to 10**16
    words a language.
    """
    docs = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), F.coalesce("text", F.lit("")).alias("text"))
    phrases, words = frequent_phrases(docs, min_count=min_count, longest=longest, budget=budget)
    candidates = phrases.where("w2 <> 0")

    # f of a longer phrase is at most f of any part: one word more is enough to look at
    w = [F.col(c) for c in WORDS]
    zero = F.lit(0).cast("long")
    longer = phrases.where("w3 <> 0")
    size = sum((c != 0).cast("int") for c in w)
    head = [F.when(F.lit(k) < size - 1, c).otherwise(zero).alias(f"p{k}") for k, c in enumerate(w)]
    tail = [c.alias(f"p{k}") for k, c in enumerate([*w[1:], zero])]
    parts = longer.select(*head, "f").unionByName(longer.select(*tail, "f")).groupBy(*[f"p{k}" for k in range(5)]).agg(F.max("f").alias("cover"))
    same = [F.col(c) == F.col(f"p{k}") for k, c in enumerate(WORDS)]
    left_over = candidates.join(parts, same, "left").where("cover is null or cover < f").select(*WORDS, F.col("f").alias("a"))

    def cut(k: int):
        """Cut after k words: both parts, filled up with 0."""
        first = F.struct(*[(c if i < k else zero).alias(f"x{i}") for i, c in enumerate(w)])
        rest = F.struct(*[(w[i + k] if i + k < 5 else zero).alias(f"x{i}") for i in range(5)])
        return F.when(w[k] != 0, F.struct(F.lit(k).alias("k"), first.alias("first"), rest.alias("rest")))

    cuts = left_over.withColumn("cut", F.explode(F.array_compact(F.array(*[cut(k) for k in range(1, 5)]))))
    part = lambda name: phrases.select(*[F.col(c).alias(f"{name}{i}") for i, c in enumerate(WORDS)], F.col("f").alias(name))
    on = lambda field, name: [F.col(f"cut.{field}.x{i}") == F.col(f"{name}{i}") for i in range(5)]
    both = cuts.join(part("l"), on("first", "l")).join(part("r"), on("rest", "r")).select(*WORDS, "a", "cut.k", "l", "r")

    # the language follows from the first word
    names = words.where("w1 <> 0").select(F.col("w1").alias("number"), "lang", "word")
    totals = words.where("w1 = 0").select(F.col("lang").alias("its"), F.col("f").alias("n"))
    spelled = left_over.select(*WORDS, F.posexplode(F.array(*w)).alias("i", "number")).where("number <> 0").join(names, "number")
    spelled = spelled.groupBy(*WORDS).agg(F.min("lang").alias("lang"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("i", "word"))), lambda s: s["word"]), " ").alias("phrase"))
    rows = both.join(spelled, WORDS).join(totals, F.col("lang") == F.col("its"))
    wide = lambda c: f"cast({c} as decimal(16,0))"
    # 38 digits hold 1000 * a * n; the quotient is at most 10 n
    rows = rows.withColumn("score", F.expr(f"cast(({wide('a')} * {wide('n')} * cast(1000 as decimal(4,0))) div ({wide('l')} * {wide('r')}) as long)"))
    best = rows.groupBy(*WORDS).agg(F.min(F.struct("score", "k", "a", "l", "r", "n", "lang", "phrase")).alias("b")).select("b.*")

    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    some = best.withColumn("slice", F.pmod(F.xxhash64("phrase"), F.lit(slices)))
    some = some.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "slice").orderBy(*order))).where(F.col("rank") <= top)
    ranked = some.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).where(F.col("rank") <= top)
    return ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


#: Every run of one to five words counted as it stands, in another engine's SQL.
SQL = r"""
with d as (select coalesce(lang, 'und') as lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) as piece from documents),
w as (select lang, regexp_extract_all(piece, '[^\x20\x09]+') as w from d),
g as (select lang, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i + k - 1], ' '))) as phrase from w, (select unnest([1, 2, 3, 4, 5]) as k) where len(w) >= k),
f as (select lang, phrase, k, count(*) as f from g group by all),
t as (select lang, sum(f)::bigint as n from f where k = 1 group by lang),
c as (select lang, phrase, string_split(phrase, ' ') as w, k, f as a from f where k >= 2 and f >= 100),
u as (select lang, unnest([array_to_string(w[1:k - 1], ' '), array_to_string(w[2:k], ' ')]) as phrase, a from c where k >= 3),
v as (select lang, phrase, max(a) as cover from u group by all),
o as (select c.* from c left join v using (lang, phrase) where cover is null or cover < a),
x as (select lang, phrase, a, j, array_to_string(w[1:j], ' ') as p, array_to_string(w[j + 1:k], ' ') as q from o, (select unnest([1, 2, 3, 4]) as j) where j < k),
s as (select x.lang, x.phrase, a, j, l.f as l, r.f as r, n, ((1000::hugeint * a * n) // (l.f::hugeint * r.f))::bigint as score
  from x join f l on l.lang = x.lang and l.phrase = p join f r on r.lang = x.lang and r.phrase = q join t on t.lang = x.lang),
b as (select *, row_number() over (partition by lang, phrase order by score, j) as nth from s),
e as (select lang, row_number() over (partition by lang order by score desc, a desc, phrase) as rank, phrase, a, l, r, n, score from b where nth = 1)
select lang, rank, phrase, a, l, r, n, score from e where rank <= 2000
"""
