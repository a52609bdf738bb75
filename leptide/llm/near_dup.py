"""Near-duplicates by an inverted join over MinHash coordinates, confirmed on full shingle sets.

A document is posted under each (coordinate, value) pair of its signature. Two
documents that agree in at least `matches` of the `coordinates` share one of
their `coordinates - matches + 1` rarest pairs, so only that prefix is kept,
and pairs that occur once are skipped altogether. The number of collisions of
two posted documents is estimated with a one-bit sketch of more coordinates, in
a column expression; what may reach the threshold is compared on whole sets.
Copies share a set and are one node from the start.

Big lists are first linked as chains: neighbours in a list, by set size, are
compared, not all pairs. What is then one component needs no further
comparison. For the exact rest, pairs of different components in one list, the
shingles that no other of these documents has bound the similarity from above:
copies with a few edits of their own are then told apart without comparing
them one by one.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import components, mix, saved, shingles, word_hashes
from .decontaminate import _bit_map, _in_map

SKETCH = ("s0", "s1", "s2", "s3")
BITS = 64 * len(SKETCH)
#: A longer sketch, made only of the documents that are left after the chains.
LONG = tuple(f"t{i}" for i in range(48))


@lru_cache(maxsize=4)
def _functions(coordinates: int) -> tuple[np.ndarray, np.ndarray]:
    seeds = np.random.default_rng(64).integers(1, 1 << 63, (2, coordinates), dtype=np.uint64)
    return seeds[0], seeds[1] | np.uint64(1)


def signature(hashes: np.ndarray, coordinates: int) -> np.ndarray:
    """Smallest value of each of `coordinates` hash functions over a set of shingle hashes."""
    seed, factor = _functions(coordinates)
    best = np.full(coordinates, ~np.uint64(0))
    rows = max(64, (1 << 19) // coordinates)  # a few MB at a time, however long the text
    for i in range(0, len(hashes), rows):
        np.minimum(best, (((hashes[i : i + rows, None] ^ seed) * factor) ^ (seed >> np.uint64(1))).min(axis=0), out=best)
    return best


@lru_cache(maxsize=4)
def _narrow_functions(bits: int) -> tuple[np.ndarray, np.ndarray]:
    seeds = np.random.default_rng(65).integers(0, 1 << 32, (2, bits), dtype=np.uint32)
    return seeds[0], seeds[1] | np.uint32(1)


def sketch(hashes: np.ndarray, bits: int) -> list[int]:
    """One bit of the smallest value of each of `bits` 32-bit hash functions, in longs."""
    seed, factor = _narrow_functions(bits)
    part = (hashes >> np.uint64(32)).astype(np.uint32)
    best, rows = np.full(bits, ~np.uint32(0)), max(16, (1 << 19) // bits)  # 2 MB at a time
    held = np.empty((min(rows, len(part)), bits), np.uint32)
    for i in range(0, len(part), rows):
        x = part[i : i + rows, None]
        out = held[: len(x)]
        np.multiply(np.bitwise_xor(x, seed, out=out), factor, out=out)
        np.minimum(best, out.min(axis=0), out=best)
    return np.packbits(mix(best.astype(np.uint64)) & np.uint64(1) != 0).view(np.int64).tolist()


def describe(docs: DataFrame, *, width: int, coordinates: int) -> DataFrame:
    """(doc_id, text_key, n_shingles, set_key, pairs, s0..s3); without words: 0 and nulls.

    The coordinates give the pairs; the sketch has functions of its own.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        salt = mix(np.arange(1, coordinates + 1, dtype=np.uint64))
        for batch in batches:
            n, keys, pairs, sketches = [], [], [], []
            for text in batch.column("text"):
                s = shingles(word_hashes(text.as_py()), width)
                n.append(len(s))
                if not len(s):
                    keys.append(None), pairs.append(None), sketches.append((None,) * len(SKETCH))
                    continue
                low = signature(s, coordinates)
                keys.append(_set_key(s))
                pairs.append(mix(low ^ salt).view(np.int64))
                sketches.append(tuple(sketch(s, BITS)))
            cols = {"doc_id": batch.column("doc_id"), "text_key": batch.column("text_key"), "n_shingles": pa.array(n, pa.int64()), "set_key": pa.array(keys, pa.binary()), "pairs": pa.array(pairs, pa.list_(pa.int64()))}
            yield pa.RecordBatch.from_pydict(cols | {c: pa.array([x[i] for x in sketches], pa.int64()) for i, c in enumerate(SKETCH)})

    return docs.select("doc_id", F.xxhash64("text").alias("text_key"), "text").mapInArrow(run, "doc_id long, text_key long, n_shingles long, set_key binary, pairs array<long>, " + ", ".join(f"{c} long" for c in SKETCH))


def agreeing(a: str, b: str, words: tuple[str, ...], percent: int) -> Column:
    """Do the sketch bits agree as often as they do at the similarity, less 4.5 standard deviations?"""
    bits, rate = 64 * len(words), (1 + percent / 100) / 2
    most = bits - int(bits * rate - 4.5 * (bits * rate * (1 - rate)) ** 0.5)
    return F.expr(" + ".join(f"bit_count({a}.{c} ^ {b}.{c})" for c in words) + f" <= {most}")


def likely(a: str, b: str, percent: int) -> Column:
    """May two sets reach the similarity, by their sizes and sketches?"""
    return F.expr(f"100 * least({a}.n, {b}.n) >= {percent} * greatest({a}.n, {b}.n)") & agreeing(a, b, SKETCH, percent)


#: Sets that one side of a block holds.
BLOCK = 64


def texts_of(docs: DataFrame, nodes: DataFrame) -> DataFrame:
    """(node, set_key, text) of the `nodes` (node, rep, set_key), by doc_id.

    Only texts of ids in a bit map are moved. An id may stand with several
    texts: who reads them compares the key of the set.
    """
    ids = _bit_map(nodes.select(F.xxhash64("rep").alias("x")))
    some = docs.where(_in_map(ids, F.xxhash64("doc_id"))).select("doc_id", "text")
    return some.join(nodes.select("node", "rep", "set_key"), F.col("doc_id") == F.col("rep")).select("node", "set_key", "text")


def set_of(text: str | None, key: bytes, width: int) -> np.ndarray | None:
    """Shingles of a text if they are the set of that key."""
    s = shingles(word_hashes(text), width)
    return s if _set_key(s) == key else None


def _set_key(s: np.ndarray) -> bytes:
    return hashlib.blake2b(s.tobytes(), digest_size=16).digest()


def common_counts(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of any two of some sets; the diagonal means nothing."""
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    _, at, n = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = n[at] > 1  # others are in no intersection
    owner, at = owner[shared], np.unique(at[shared], return_inverse=True)[1]
    order = np.argsort(at, kind="stable")
    owner, at = owner[order], at[order]
    out = np.zeros((len(sets), len(sets)), np.float64)
    for start in range(0, int(at[-1]) + 1 if len(at) else 0, 8192):
        some = slice(*np.searchsorted(at, [start, start + 8192]))
        has = np.zeros((len(sets), 8192), np.float32)
        has[owner[some], at[some] - start] = 1
        out += has @ has.T
    return out.astype(np.int64)


def confirm(pairs: DataFrame, docs: DataFrame, nodes: DataFrame, *, width: int, percent: int) -> DataFrame:
    """Pairs (a, b) of nodes whose whole shingle sets have 100 * intersection >= percent * union.

    Nodes that are asked about together lie in one block; the texts of two
    blocks meet once for all pairs between them, and their sets are
    intersected by a product of small matrices.
    """
    ends = pairs.select(F.col("a").alias("node"), F.col("b").alias("other")).unionByName(pairs.select(F.col("b").alias("node"), F.col("a").alias("other")))
    family = ends.groupBy("node").agg(F.least("node", F.min("other")).alias("family"))
    sizes = family.groupBy("family").agg(F.ceil(F.count("*") / BLOCK).alias("parts"))
    block = saved(family.join(sizes, "family").select("node", F.xxhash64("family", F.pmod(F.xxhash64("node"), F.col("parts"))).alias("block")), "blocks")
    one = lambda k: block.select(F.col("node").alias(k), F.col("block").alias(f"block_{k}"))
    asked = pairs.select("a", "b").join(one("a"), "a").join(one("b"), "b")
    key = F.xxhash64(F.least("block_a", "block_b"), F.greatest("block_a", "block_b")).alias("key")
    asked = saved(asked.select(key, "a", "b"), "asked")
    meets = asked.select("key", F.explode(F.array("a", "b")).alias("node")).distinct()
    held = texts_of(docs, nodes.join(block.select("node"), "node", "left_semi"))
    rows = meets.join(held, "node").select("key", F.lit(False).alias("pair"), F.col("node").alias("a"), F.lit(0).cast("long").alias("b"), "set_key", "text")
    rows = rows.unionByName(asked.select("key", F.lit(True).alias("pair"), "a", "b", F.lit(None).cast("binary").alias("set_key"), F.lit(None).cast("string").alias("text")))

    def judged(sets: dict[int, np.ndarray], asked: list[tuple[int, int]]) -> pa.RecordBatch:
        place = {n: i for i, n in enumerate(sets)}
        common = common_counts(list(sets.values())) if sets else None
        links = []
        for a, b in asked:
            both = int(common[place[a], place[b]])
            if both and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                links.append((a, b))
        return pa.RecordBatch.from_pydict({"a": pa.array([x for x, _ in links], pa.int64()), "b": pa.array([x for _, x in links], pa.int64())})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, sets, asked = None, {}, []
        for batch in batches:
            for key, pair, a, b, want, text in zip(*(batch.column(c) for c in ("key", "pair", "a", "b", "set_key", "text"))):
                if last is not None and key != last:
                    yield judged(sets, asked)
                    sets, asked = {}, []
                last = key
                a = a.as_py()
                if pair.as_py():
                    asked.append((a, b.as_py()))
                elif a not in sets:
                    s = set_of(text.as_py(), want.as_py(), width)
                    if s is not None:
                        sets[a] = s
        if last is not None:
            yield judged(sets, asked)

    # two blocks with one key only share a table
    return rows.repartition("key").sortWithinPartitions("key", "pair").mapInArrow(run, "a long, b long").distinct()


def details(docs: DataFrame, nodes: DataFrame, *, width: int) -> DataFrame:
    """(node, own, t0..) of the `nodes` (node, rep, set_key): shingles that no other of them has, and the long sketch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [(n, set_of(t.as_py(), k.as_py(), width)) for n, k, t in zip(batch.column("node"), batch.column("set_key"), batch.column("text"))]
            found = [(n, s) for n, s in found if s is not None]
            longs = [sketch(s, 64 * len(LONG)) for _, s in found]
            cols = {"node": pa.array([n.as_py() for n, _ in found], pa.int64()), "set": pa.array([s.view(np.int64) for _, s in found], pa.list_(pa.int64()))}
            yield pa.RecordBatch.from_pydict(cols | {c: pa.array([x[i] for x in longs], pa.int64()) for i, c in enumerate(LONG)})

    rows = texts_of(docs, nodes).mapInArrow(run, "node long, set array<long>, " + ", ".join(f"{c} long" for c in LONG))
    rows = saved(rows.dropDuplicates(["node"]), "sets")
    single = rows.select("node", F.explode("set").alias("shingle")).groupBy("shingle").agg(F.min("node").alias("node"), F.max("node").alias("other")).where("node = other")
    own = single.groupBy("node").agg(F.count("*").alias("own"))
    return rows.drop("set").join(own, "node", "left").withColumn("own", F.coalesce("own", F.lit(0)))


def across_components(lists: DataFrame, placed: DataFrame, docs: DataFrame, nodes: DataFrame, *, width: int, percent: int) -> DataFrame:
    """(a, b): likely pairs of one list in different components, once each, by sketches and by own shingles."""
    rows = lists.join(placed, "node", "left").select("pair", "node", "n", F.coalesce("component", "node").alias("c"), *SKETCH)
    rows = saved(rows, "placed")
    mixed = saved(rows.groupBy("pair").agg(F.min("c").alias("low"), F.max("c").alias("high")).where("low <> high").select("pair"), "mixed")
    rest = saved(rows.join(mixed, "pair", "left_semi"), "mixed-lists")
    # only what has a likely partner in another component is looked at closely; a row stops at its first
    p, q = rest.alias("p"), rest.alias("q")
    likely_one = F.expr("p.pair = q.pair and p.c <> q.c") & likely("p", "q", percent)
    met = p.join(q, likely_one, "left_semi").select("node").distinct()
    rest = saved(rest.join(met, "node", "left_semi"), "met")
    its_lists = rest.groupBy("node").agg(F.collect_set("pair").alias("lists"))  # a prefix at most
    more = details(docs, nodes.join(its_lists.select("node"), "node", "left_semi"), width=width).join(its_lists, "node")
    # one that has too many shingles of its own for any partner goes
    rest = saved(rest.join(more, "node").where(f"100 * (n - own) >= {percent} * n"), "mixed-lists")
    side = lambda name: rest.select("pair", F.struct("node", "n", "c", "own", "lists", *SKETCH, *LONG).alias(name))
    # at most n - own shingles are common, at least n + the other's own are in the union
    bound = F.expr(f"100 * least(p.n - p.own, q.n - q.own) >= {percent} * greatest(p.n + q.own, q.n + p.own)")
    both = side("p").join(side("q"), "pair").where(
        F.expr("p.node < q.node and p.c <> q.c") & bound & likely("p", "q", percent) & agreeing("p", "q", LONG, percent)
        & (F.col("pair") == F.array_min(F.array_intersect("p.lists", "q.lists")))
    )
    return both.select(F.col("p.node").alias("a"), F.col("q.node").alias("b")).distinct()


def near_duplicates(docs: DataFrame, *, width: int = 5, percent: int = 80, coordinates: int = 64, matches: int = 36) -> DataFrame:
    """(doc_id, text_key, n_shingles, component_id, kept) for every row of docs (doc_id long, text).

    text_key is the xxhash64 of the text: it tells the rows of one id apart.
    A-Z is folded; words are runs of anything but ASCII white space; a text
    with fewer words than `width` is one shingle; without words it has none
    and is linked with nothing. What is linked are sets: rows of one id with
    different texts are linked as their texts are, each on its own. The
    component of a row is the smallest id reachable from its set over links of
    at least `percent` hundredths; kept marks the row of that id whose set is
    in the component (of several such sets the one with the smallest key; equal
    rows are all kept). A null id is linked with nothing and has a null
    component. An empty table gives no rows. Other columns are ignored. A pair
    at the very limit is missed with a chance of about one in a hundred
    thousand (fewer than 36 of 64 coordinates agree, or too few sketch bits);
    closer pairs far more rarely.
    """
    docs = docs.select("doc_id", "text")
    known = saved(describe(docs, width=width, coordinates=coordinates), "signatures")
    linked = known.where("n_shingles > 0 and doc_id is not null")
    # the numbers are written with the table and stay
    classes = saved(linked.groupBy("set_key").agg(F.min("doc_id").alias("rep")).withColumn("node", F.monotonically_increasing_id()), "classes")
    first = classes.select("node", "rep", F.col("set_key").alias("its_key"))
    reps = linked.join(first, (F.col("doc_id") == F.col("rep")) & (F.col("set_key") == F.col("its_key"))).select("node", F.col("n_shingles").alias("n"), "pairs", *SKETCH)
    reps = saved(reps.dropDuplicates(["node"]), "representatives")

    posts = reps.select("node", F.explode("pairs").alias("pair"))
    often = saved(posts.groupBy("pair").agg(F.count("*").alias("often")).where("often > 1"), "pairs")
    by_node = Window.partitionBy("node")
    prefix = coordinates - matches + 1
    lists = posts.join(often, "pair").withColumn("rank", F.row_number().over(by_node.orderBy("often", "pair"))).withColumn(
        "single", coordinates - F.count("*").over(by_node)
    )
    lists = lists.where(F.col("rank") + F.col("single") <= prefix).select("pair", "node", "often")
    lists = saved(lists.join(reps.select("node", "n", *SKETCH), "node"), "lists")

    me = F.struct("node", "n", *SKETCH)
    # parts of about the root of a list's length, chained inside by size and from part to part
    spread = lists.withColumn("turn", F.xxhash64("node", F.col("pair") % 3)).withColumn("part", F.pmod("turn", F.ceil(F.sqrt("often"))))
    inside = spread.select(me.alias("q"), F.lag(me).over(Window.partitionBy("pair", "part").orderBy("n", "turn", "node")).alias("p"))
    heads = spread.groupBy("pair", "part").agg(F.min(F.struct("turn", "node", "n", *SKETCH)).alias("h")).select("pair", "part", "h.*")
    across = heads.select(me.alias("q"), F.lag(me).over(Window.partitionBy("pair").orderBy("n", "part")).alias("p"))
    near = inside.unionByName(across).where("p is not null and p.node <> q.node").where(likely("p", "q", percent))
    tried = saved(near.select(F.least("p.node", "q.node").alias("a"), F.greatest("p.node", "q.node").alias("b")).distinct(), "candidates")
    nodes = classes.select("node", "rep", "set_key")
    links = saved(confirm(tried, docs, nodes, width=width, percent=percent), "confirmed")
    final = components(links)

    open_ = across_components(lists, final, docs, nodes, width=width, percent=percent).join(tried, ["a", "b"], "left_anti")
    more = saved(confirm(saved(open_, "candidates"), docs, nodes, width=width, percent=percent), "confirmed")
    if not more.isEmpty():
        final = components(final.select(F.col("component").alias("a"), F.col("node").alias("b")).unionByName(more))
    placed = classes.join(final, "node", "left").select("set_key", "rep", F.coalesce("component", "node").alias("component"))
    lowest = placed.groupBy("component").agg(F.min(F.struct("rep", "set_key")).alias("low"))
    found = saved(placed.join(lowest, "component").select("set_key", "low"), "found")
    out = known.select("doc_id", "text_key", "n_shingles", "set_key").join(found, "set_key", "left")
    linkable = F.col("doc_id").isNotNull()
    component = F.when(linkable, F.coalesce("low.rep", "doc_id"))
    kept = linkable & (F.col("low").isNull() | ((F.col("doc_id") == F.col("low.rep")) & (F.col("set_key") == F.col("low.set_key"))))
    return out.select("doc_id", "text_key", "n_shingles", component.alias("component_id"), F.coalesce(kept, F.lit(False)).alias("kept"))


#: Two-word sets compared pair by pair in another engine's SQL.
SQL = r"""
with recursive w as (select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as w from documents),
s as (select doc_id, unnest(list_distinct(case when len(w) >= 2 then list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) else w end)) as g from w),
n as (select doc_id, count(*) as n from s group by 1),
p as (select a.doc_id as a, b.doc_id as b, count(*) as c from s a join s b on a.g = b.g and a.doc_id < b.doc_id group by 1, 2),
e as (select a, b from p join n x on x.doc_id = a join n y on y.doc_id = b where 100 * c >= 80 * (x.n + y.n - c)),
l as (select a, b from e union all select b, a from e),
r as (select doc_id as x, doc_id as y from documents where doc_id is not null union select r.x, l.b from r join l on r.y = l.a),
m as (select x, min(y) as c from r group by 1)
select d.doc_id, coalesce(n.n, 0) as n_shingles, m.c as component_id, coalesce(d.doc_id = m.c, false) as kept
from documents d left join n on n.doc_id = d.doc_id left join m on m.x = d.doc_id
"""
