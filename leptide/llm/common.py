"""Shared pieces: materialised tables, word hashing inside tasks, connected components."""

from __future__ import annotations

from functools import lru_cache, reduce

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import scratch_path

#: A word is a run of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def saved(df: DataFrame, name: str) -> DataFrame:
    """Write once to the shared folder and read back: lineage ends there, a lost executor costs no recompute."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def union_all(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


# ---- words inside a task -------------------------------------------------

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32
_BASE, _INVERSE = 0x9E3779B97F4A7C15, pow(0x9E3779B97F4A7C15, -1, 1 << 64)
_VALUE = np.random.default_rng(20260902).integers(1, 1 << 63, 256, dtype=np.uint64)


@lru_cache(maxsize=2)
def _powers(bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the hash base and of its inverse, for texts of up to 2**bits bytes."""
    n = 1 << bits
    out = []
    for x in (_BASE, _INVERSE):
        p = np.full(n, x, np.uint64)
        p[0] = 1
        out.append(np.multiply.accumulate(p))
    return out[0], out[1]


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over the 64 output bits."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(text: str | None, lower: bool = True) -> np.ndarray:
    """64-bit hash of each word of a whole text, in order (A-Z folded if asked)."""
    raw = np.frombuffer((text or "").encode(), np.uint8)
    if not len(raw):
        return np.empty(0, np.uint64)
    inside = ~_SPACE[raw]
    edge = np.diff(inside.astype(np.int8), prepend=0, append=0)
    start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    power, inverse = _powers(max(16, int(len(raw)).bit_length()))
    total = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum(_VALUE[_LOWER[raw] if lower else raw] * power[: len(raw)], out=total[1:])
    return mix((total[end] - total[start]) * inverse[start] + (end - start).astype(np.uint64))


def shingles(words: np.ndarray, width: int) -> np.ndarray:
    """Sorted distinct hashes of the runs of `width` words; a shorter text is one run."""
    if not len(words):
        return words
    width = min(width, len(words))
    out = np.zeros(len(words) - width + 1, np.uint64)
    for k in range(width):
        out = mix(out * np.uint64(_BASE) + words[k : len(words) - width + 1 + k])
    return np.unique(out)


# ---- connected components ------------------------------------------------


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, component) for every node of `edges` (a, b); component = smallest node reachable.

    Alternating star contraction: each round hangs neighbours on the smallest
    node they know, so long chains shrink by a factor each round. Every step
    is a map-side-combined minimum and a join; no group meets in one task.
    Reaching max_rounds raises: nothing is cut off silently.
    """
    e = edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a <> b").distinct()
    e = saved(e, "links")
    for _ in range(max_rounds):
        both = e.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(e.select(F.col("b").alias("u"), F.col("a").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("m").alias("a"), F.col("v").alias("b")).where("a <> b").distinct()
        # now each b hangs on smaller nodes only: hang those on the smallest of them
        least = large.groupBy("b").agg(F.min("a").alias("m"))
        small = large.join(least, "b").select(F.col("m").alias("a"), F.when(F.col("a") == F.col("m"), F.col("b")).otherwise(F.col("a")).alias("b"))
        e = saved(small.where("a <> b").distinct(), "links")
        # done when all are stars: no node hangs on two, no centre hangs itself
        roles = e.select(F.col("b").alias("node"), F.lit(1).alias("hangs"), F.lit(0).alias("holds")).unionByName(
            e.select(F.col("a").alias("node"), F.lit(0).alias("hangs"), F.lit(1).alias("holds"))
        )
        if roles.groupBy("node").agg(F.sum("hangs").alias("hangs"), F.max("holds").alias("holds")).where("hangs > 1 or (hangs = 1 and holds = 1)").isEmpty():
            return e.select(F.col("b").alias("node"), F.col("a").alias("component")).unionByName(
                e.select(F.col("a").alias("node"), F.col("a").alias("component")).distinct()
            )
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")
