"""Sharding by minimax contiguous partition over ordered atomic groups.

Groups (equal texts) stand in the order of their SHA-256. The smallest shard
capacity for which a greedy fill needs no more than n shards is found by
binary search, and the cuts are made within it, as near to equal shares as
it allows. The search runs on the driver over
a bounded summary of the group ends: at most `cells` marks a round. A probe
that falls between two marks with unknown ends in between is undecided; only
the stretches such probes can touch are looked at again, more finely, until
the capacity is decided exactly.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import saved

#: Runs of groups summed on their own; the key is uniform, so they are even.
BUCKETS_HEX = 3


class Ends:
    """What is known of the sorted group ends; solid[i]: no end between marks i and i + 1."""

    def __init__(self, total: int):
        self.marks = np.array([0, total], np.int64)
        self.solid = np.array([False])

    def greedy(self, capacity: int, shards: int, hopeful: bool) -> tuple[bool, list[int], list[int]]:
        """Feasible?, cuts, targets. Hopeful: unknown stretches may end anywhere; else only at marks."""
        at, cuts, targets, total = 0, [], [], int(self.marks[-1])
        for _ in range(shards):
            target = min(at + capacity, total)
            targets.append(target)
            i = int(np.searchsorted(self.marks, target, "right")) - 1
            end = int(self.marks[i])
            if hopeful and end < target and not self.solid[i]:
                end = target
            if end <= at:
                return False, cuts, targets
            at = end
            cuts.append(at)
            if at >= total:
                return True, cuts, targets
        return False, cuts, targets

    def even_cuts(self, capacity: int, shards: int) -> list[int]:
        """Cuts that keep to a feasible capacity and lie as near to equal shares as it lets them."""
        total, marks = int(self.marks[-1]), self.marks
        latest = self.greedy(capacity, shards, False)[1]
        latest += [total] * (shards - len(latest))
        earliest = [total]
        for _ in range(shards - 1):
            earliest.append(int(marks[np.searchsorted(marks, max(0, earliest[-1] - capacity), "left")]))
        cuts, at = [], 0
        for k in range(1, shards):
            low, high = max(earliest[shards - k], at), min(latest[k - 1], at + capacity)
            j = int(np.searchsorted(marks, k * total // shards, "left"))
            near = min((int(m) for m in marks[max(0, j - 1) : j + 1]), key=lambda m: abs(m * shards - k * total))
            high = int(marks[np.searchsorted(marks, high, "right") - 1])
            at = min(max(near, low), high)
            cuts.append(at)
        return [*cuts, total]

    def bounds(self, shards: int) -> tuple[int, int]:
        """Largest capacity surely too small, smallest surely enough."""
        total = int(self.marks[-1])
        out = []
        for hopeful in (True, False):
            low, high = 0, total
            while high - low > 1:
                mid = (low + high) // 2
                low, high = (low, mid) if self.greedy(mid, shards, hopeful)[0] else (mid, high)
            out.append((low, high))
        return out[0][0], out[1][1]

    def doubtful(self, low: int, high: int, shards: int) -> list[tuple[int, int]]:
        """Stretches between marks that a greedy fill with a capacity in (low, high] can touch."""
        first, last = self.greedy(low + 1, shards, False)[2], self.greedy(high, shards, True)[2]
        first += [int(self.marks[-1])] * (len(last) - len(first)) if len(first) < len(last) and first[-1] >= self.marks[-1] else [first[-1]] * max(0, len(last) - len(first))
        last += [int(self.marks[-1])] * (len(first) - len(last))
        stretches: list[list[int]] = []
        for a, b in sorted((min(x, y), max(x, y)) for x, y in zip(first, last)):
            i = max(0, int(np.searchsorted(self.marks, a, "right")) - 1)
            j = min(len(self.marks) - 1, int(np.searchsorted(self.marks, b, "right")))
            a, b = int(self.marks[i]), int(self.marks[j])
            if stretches and a <= stretches[-1][1]:
                stretches[-1][1] = max(b, stretches[-1][1])
            else:
                stretches.append([a, b])
        return [(a, b) for a, b in stretches if not self.solid[(self.marks[:-1] >= a) & (self.marks[:-1] < b)].all()]

    def learn(self, stretches: list[tuple[int, int]], found: np.ndarray) -> None:
        """found: rows (first end, last end, ends) of cells that cover the stretches."""
        inside = np.zeros(len(self.marks) - 1, bool)
        drop = np.zeros(len(self.marks), bool)
        for a, b in stretches:
            inside |= (self.marks[:-1] >= a) & (self.marks[:-1] < b)
            drop |= (self.marks > a) & (self.marks < b)
        open_from = set(self.marks[:-1][~inside & ~self.solid].tolist()) | set(found[found[:, 2] > 2][:, 0].tolist())
        self.marks = np.unique(np.concatenate([self.marks[~drop], found[:, 0], found[:, 1]]))
        self.solid = ~np.isin(self.marks[:-1], np.fromiter(open_from, np.int64, len(open_from)))


def find_cuts(ends: DataFrame, total: int, shards: int, cells: int) -> list[int]:
    """Cut positions of the smallest feasible capacity; `ends` has one long column `end`."""
    if total == 0:
        return []
    known, cells = Ends(total), max(cells, 64 * shards * shards)  # a coarser summary could stay undecided
    while True:
        low, high = known.bounds(shards)
        stretches = known.doubtful(low, high, shards) if high - low > 1 else []
        if not stretches:
            return known.even_cuts(high, shards)
        width = max(1, -(-sum(b - a for a, b in stretches) // cells))
        inside = F.lit(False)
        for a, b in stretches:
            inside = inside | ((F.col("end") > a) & (F.col("end") < b))
        rows = ends.where(inside).groupBy(F.floor(F.col("end") / F.lit(width)).alias("cell")).agg(
            F.min("end").alias("a"), F.max("end").alias("b"), F.count("*").alias("n")
        ).select("a", "b", "n").collect()  # at most `cells` rows and two more a stretch
        known.learn(stretches, np.array([tuple(x) for x in rows], np.int64).reshape(-1, 3))


def minimax_shards(df: DataFrame, *, shards: int, overhead: int = 16, cells: int = 1 << 16, cell_rows: int = 100_000) -> DataFrame:
    """Rows of (doc_id, text) with size, text_crc32, group, shard and slot.

    Equal texts share a shard (null texts are one group of their own, apart
    from empty ones). A group above the mean of what is left gets a shard to
    itself, as no partition can even it out; the other groups are cut
    contiguously. Slots count from 0 without gaps in each shard, in an order
    that depends on the ids only up to ties. Repeated rows each keep a row,
    null ids too. An empty table gives no rows. Other columns are ignored.
    """
    rows = saved(
        df.select(
            F.col("doc_id"),
            (F.coalesce(F.octet_length("text"), F.lit(0)) + overhead).cast("long").alias("size"),
            F.coalesce(F.crc32(F.col("text").cast("binary")), F.lit(0)).cast("long").alias("text_crc32"),
            F.coalesce(F.sha2("text", 256), F.lit("")).alias("group"),
        ),
        "rows",
    )
    # hex digits sort as their numbers do; '' (no text) comes first
    groups = saved(rows.groupBy("group").agg(F.sum("size").alias("size")).withColumn("bucket", F.substring("group", 1, BUCKETS_HEX)), "groups")
    count, total = groups.agg(F.count("*"), F.coalesce(F.sum("size"), F.lit(0))).first()
    giants: list[str] = []
    rest, left = total, shards
    for g in groups.orderBy(F.desc("size"), "group").limit(shards - 1).collect():
        if left > 1 and g["size"] * left > rest:
            giants.append(g["group"])
            rest, left = rest - g["size"], left - 1
    ordinary = groups.where(~F.col("group").isin(giants)) if giants else groups
    # a running sum inside each of the fixed number of buckets, and over their totals
    sums = ordinary.groupBy("bucket").agg(F.sum("size").alias("bytes"))
    earlier = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select("bucket", F.coalesce(F.sum("bytes").over(earlier), F.lit(0)).alias("before"))
    inside = Window.partitionBy("bucket").orderBy("group").rowsBetween(Window.unboundedPreceding, 0)
    ends = saved(
        ordinary.withColumn("own", F.sum("size").over(inside)).join(F.broadcast(offsets), "bucket").select("group", (F.col("own") + F.col("before")).alias("end")),
        "ends",
    )
    cuts = find_cuts(ends.select("end"), rest, left, cells)
    last = [r["group"] for r in ends.where(F.col("end").isin(cuts[:-1])).orderBy("end").collect()] if len(cuts) > 1 else []
    shard = sum((F.when(F.col("group") > g, 1).otherwise(0) for g in last), F.lit(0))
    for i, g in enumerate(giants):
        shard = F.when(F.col("group") == g, left + i).otherwise(shard)
    # slots: ranks inside cells of bounded size, on top of the sizes of earlier cells
    per_shard = max(1, -(-rows.count() // (shards * cell_rows)))
    placed = rows.withColumn("shard", shard.cast("int")).withColumn(
        "cell", F.pmod(F.xxhash64("doc_id", F.spark_partition_id(), F.monotonically_increasing_id() % 64), F.lit(max(16, per_shard))).cast("int")
    )
    placed = saved(placed, "placed")
    sizes = placed.groupBy("shard", "cell").agg(F.count("*").alias("rows"))
    before = Window.partitionBy("shard").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("shard", "cell", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("start"))
    rank = F.row_number().over(Window.partitionBy("shard", "cell").orderBy("doc_id", "group", "size"))
    return placed.withColumn("at", rank - 1).join(starts, ["shard", "cell"]).select(
        "doc_id", "size", "text_crc32", "group", "shard", (F.col("start") + F.col("at")).cast("long").alias("slot")
    )
