"""Benchmark decontamination by spaced seeds.

Fixed masks pick some words of a window and ignore the others, so a seed still
agrees where an ignored word was substituted. Seeds of all documents meet those
of the benchmark in a join on their hashes; around each hit the texts are
compared word by word along the diagonal, and a stretch that scores enough
(+1 for an equal word, -2 for another) is an overlap. So is a diagonal on
which most words of the item stand, whatever their score: short items get
lighter masks as well, since few substitutions leave them no other seed.

Two bit maps, one of the benchmark's word pairs and one of its seeds, drop
document windows that can't hit before anything is shuffled. Their size follows
the number of entries up to a limit. They may let too many through, never too
few.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import saved

#: Word offsets each mask looks at; all begin with two neighbours.
MASKS = ((0, 1, 2, 4, 5, 7), (0, 1, 3, 4, 6, 7), (0, 1, 2, 3, 5, 6))
SPAN = 8
#: Looked at as well for items of at most SHORT words.
LIGHT_MASKS = ((0, 1, 2, 3), (0, 1, 3, 4), (0, 1, 4, 5), (0, 1, 2, 5))
SHORT = 25
MOST_BITS = 25  # of a bit map: 4 MB


def word_keys(text: Column) -> Column:
    """64-bit hash of each word: runs of letters and digits, lower-cased."""
    words = F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), lambda w: w != "")
    return F.transform(words, lambda w: F.xxhash64(w))


def _at(h: Column, i: Column, k: int) -> Column:
    return F.get(h, i + k)


def _pair(h: Column, i: Column) -> Column:
    return F.xxhash64(_at(h, i, 0), _at(h, i, 1))


def _seed(h: Column, i: Column, mask: int) -> Column:
    return F.xxhash64(F.lit(mask), *[_at(h, i, k) for k in (*MASKS, *LIGHT_MASKS)[mask]])


def _fits(h: Column, i: Column, mask: int) -> Column:
    return i + (*MASKS, *LIGHT_MASKS)[mask][-1] < F.size(h)


def _places(h: Column) -> Column:
    """Starts of the windows of a text, as far as the shortest mask fits."""
    least = min(m[-1] for m in LIGHT_MASKS) + 1
    return F.when(F.size(h) >= least, F.sequence(F.lit(0), F.size(h) - least)).otherwise(F.array().cast("array<int>"))


def _seeds(h: Column, i: Column, masks: range) -> Column:
    """Seeds of the masks that fit at a place."""
    return F.array_compact(F.array(*[F.when(_fits(h, i, m), _seed(h, i, m)) for m in masks]))


@dataclass(frozen=True)
class BitMap:
    """One row holding an array of longs, looked up as a scalar; the plan does not spell its bits out."""

    words: Column
    bits: int


def _bit_map(hashes: DataFrame) -> BitMap:
    """Bits set for the hashes in column `x`: 128 for each, between 2**16 and 2**MOST_BITS."""
    bits = min(MOST_BITS, max(16, (128 * hashes.count()).bit_length()))
    size = (1 << bits) // 64
    cell = F.shiftrightunsigned("x", 6).bitwiseAND(size - 1)
    rows = hashes.select(cell.alias("cell"), F.expr("shiftleft(1L, cast(x & 63 as int))").alias("bit")).groupBy("cell").agg(F.bit_or("bit").alias("bits"))
    words = [0] * size
    for r in rows.collect():  # at most `size` rows
        words[r["cell"]] = r["bits"]
    table = hashes.sparkSession.createDataFrame([(words,)], "words array<long>")
    return BitMap(saved(table, "bits").scalar(), bits)


def _in_map(held: BitMap, x: Column, words: Column | None = None) -> Column:
    """Is the bit of x set? Inside a lambda, where no scalar can stand, `words` hands in the array."""
    word = F.get(held.words if words is None else words, F.shiftrightunsigned(x, 6).bitwiseAND((1 << held.bits) // 64 - 1).cast("int"))
    return F.getbit(word, x.bitwiseAND(63).cast("int")) == 1


def contaminated(docs: DataFrame, benchmark: DataFrame, *, min_score: int = 12, min_percent: int = 80) -> DataFrame:
    """(row, doc_id, item_id, score, matched, doc_from, doc_to) of the best overlap of each document and item.

    docs has (doc_id, text), benchmark (item_id, text). `row` is a hash of id
    and text: repeated rows share it and give one result, null ids work as any
    other. doc_from and doc_to are word positions, the end exclusive. Null and
    empty texts overlap with nothing, nor do items of fewer than SPAN words,
    which can't be told from ordinary phrases. An item of fewer than
    `min_score` words must occur with no substitution. Others overlap too if
    `min_percent` of all their words stand at their place on the diagonal: where
    only that holds, `matched`, doc_from and doc_to are those of the whole
    diagonal, and `score` is its best stretch's. Other columns are ignored.
    """
    items = saved(
        benchmark.select("item_id", word_keys(F.col("text")).alias("g")).where(F.size("g") >= SPAN).distinct(), "items"
    )
    spots = items.select("item_id", "g", F.explode(_places(F.col("g"))).alias("j"))
    g, j = F.col("g"), F.col("j")
    heavy, every = range(len(MASKS)), range(len(MASKS) + len(LIGHT_MASKS))
    seeds = saved(
        spots.select("item_id", "j", F.size("g").alias("length"), F.explode(F.when(F.size("g") <= SHORT, _seeds(g, j, every)).otherwise(_seeds(g, j, heavy))).alias("seed")), "seeds"
    )
    pair_map = _bit_map(spots.select(_pair(g, j).alias("x")))
    seed_map = _bit_map(seeds.select(F.col("seed").alias("x")))
    h, i = F.col("h"), F.col("i")
    hashed = docs.select(F.xxhash64("doc_id", "text").alias("row"), "doc_id", word_keys(F.col("text")).alias("h"))
    # places as rows: lookups are compiled, and few rows pass the first. The outer form keeps Spark from hashing the words twice
    spots = hashed.select("row", "h", F.explode_outer(_places(h)).alias("i")).where(_in_map(pair_map, _pair(h, i)))
    # the words of a window as columns: seven seeds of array elements would make a method too long for the JVM to compile
    spots = spots.select("row", "i", *[_at(h, i, k).alias(f"w{k}") for k in range(SPAN)])
    fitting = [F.when(F.col(f"w{mask[-1]}").isNotNull(), F.xxhash64(F.lit(m), *[F.col(f"w{k}") for k in mask])) for m, mask in enumerate((*MASKS, *LIGHT_MASKS))]
    asked = spots.select("row", "i", F.explode_outer(F.array(*fitting)).alias("seed")).where(_in_map(seed_map, F.col("seed")))
    diagonals = saved(asked.join(seeds, "seed").select("row", "item_id", "length", (F.col("i") - F.col("j")).alias("shift")).distinct(), "diagonals")
    # documents with a diagonal are few: they are read once more, and only their words travel
    row_map = _bit_map(diagonals.select(F.col("row").alias("x")).distinct())
    met = docs.where(_in_map(row_map, F.xxhash64("doc_id", "text"))).select(F.xxhash64("doc_id", "text").alias("row"), "doc_id", word_keys(F.col("text")).alias("h"))
    # only the words that an item covers travel on
    first = F.greatest(F.col("shift"), F.lit(0))
    covered = (
        diagonals.join(met.dropDuplicates(["row"]), "row")
        .select("row", "doc_id", "item_id", "shift", "length", first.alias("start"), F.slice("h", first + 1, F.col("length") + F.least(F.col("shift"), F.lit(0))).alias("h"))
        .join(items, "item_id")
        .select("row", "doc_id", "item_id", "length", "start", F.zip_with("h", F.slice("g", F.greatest(-F.col("shift"), F.lit(0)) + 1, F.size("h")), lambda a, b: a == b).alias("same"))
    )
    zero = F.struct(*[F.lit(0).alias(k) for k in ("at", "sum", "from", "equal", "best", "best_from", "best_to", "best_equal")])

    def step(s: Column, same: Column) -> Column:
        fresh = s["sum"] <= 0
        total = F.when(fresh, 0).otherwise(s["sum"]) + F.when(same, 1).otherwise(-2)
        start, equal = F.when(fresh, s["at"]).otherwise(s["from"]), F.when(fresh, 0).otherwise(s["equal"]) + same.cast("int")
        better = total > s["best"]
        return F.struct(
            (s["at"] + 1).alias("at"), total.alias("sum"), start.alias("from"), equal.alias("equal"), F.when(better, total).otherwise(s["best"]).alias("best"),
            F.when(better, start).otherwise(s["best_from"]).alias("best_from"), F.when(better, s["at"] + 1).otherwise(s["best_to"]).alias("best_to"),
            F.when(better, equal).otherwise(s["best_equal"]).alias("best_equal"),
        )

    scored = covered.select("row", "doc_id", "item_id", "length", "start", F.aggregate(F.transform("same", lambda x: F.coalesce(x, F.lit(False))), zero, step).alias("s"), F.size(F.filter("same", lambda x: x)).alias("total"))
    stretch = F.col("s.best") >= F.least(F.lit(min_score), F.col("length"))
    share = (F.col("length") >= min_score) & (100 * F.col("total") >= min_percent * F.col("length"))
    scored = scored.where(stretch | share).select(
        "row", "doc_id", "item_id", F.col("s.best").alias("score"), F.when(stretch, F.col("s.best_equal")).otherwise(F.col("total")).alias("matched"),
        (F.col("start") + F.when(stretch, F.col("s.best_from")).otherwise(0)).alias("from"), (F.col("start") + F.when(stretch, F.col("s.best_to")).otherwise(F.col("s.at"))).alias("to"),
    )
    best = scored.groupBy("row", "item_id").agg(
        F.first("doc_id").alias("doc_id"),
        F.max(F.struct("score", "matched", (-F.col("from")).alias("from"), "to")).alias("o"),
    )
    return best.select("row", "doc_id", "item_id", "o.score", "o.matched", (-F.col("o.from")).alias("doc_from"), F.col("o.to").alias("doc_to"))
