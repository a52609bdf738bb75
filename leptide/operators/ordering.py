"""Ranks and neighbours inside a group, without one task per group.

A window partitioned by a job alone sorts the whole job in one task. Here the
integer order column is cut into ranges: rows are ranked inside a range, and a
running total over the (few) range counts supplies the offset. A job holding
a large share of all rows is then spread over as many tasks as it has ranges.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

RANGE_WIDTH = 1 << 16


def with_rank(
    df: DataFrame, keys: Sequence[str], order: str, *, name: str = "ordinal",
    width: int = RANGE_WIDTH,
) -> DataFrame:
    """0-based position of each row inside its group, by ascending `order`."""
    cut = df.withColumn("_range", F.floor(F.col(order) / width))
    counts = cut.groupBy(*keys, "_range").agg(F.count("*").alias("_rows"))
    earlier = Window.partitionBy(*keys).orderBy("_range").rowsBetween(
        Window.unboundedPreceding, -1
    )
    offsets = counts.select(
        *keys, "_range", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_before")
    )
    inside = Window.partitionBy(*keys, "_range").orderBy(order)
    return (
        cut.withColumn("_at", F.row_number().over(inside) - 1)
        .join(offsets, [*keys, "_range"])
        .withColumn(name, F.col("_before") + F.col("_at"))
        .drop("_range", "_at", "_before")
    )


def with_previous(
    df: DataFrame, keys: Sequence[str], order: str, value: str, *, name: str = "previous",
    width: int = RANGE_WIDTH,
) -> DataFrame:
    """`value` of the preceding row of the group (NULL for the first row)."""
    cut = df.withColumn("_range", F.floor(F.col(order) / width))
    edges = cut.groupBy(*keys, "_range").agg(F.max_by(value, order).alias("_last"))
    across = Window.partitionBy(*keys).orderBy("_range")
    edges = edges.select(*keys, "_range", F.lag("_last").over(across).alias("_carried"))
    inside = Window.partitionBy(*keys, "_range").orderBy(order)
    return (
        cut.withColumn("_at", F.row_number().over(inside))
        .withColumn("_prev", F.lag(value).over(inside))
        .join(edges, [*keys, "_range"])
        .withColumn(name, F.when(F.col("_at") == 1, F.col("_carried")).otherwise(F.col("_prev")))
        .drop("_range", "_at", "_prev", "_carried")
    )


#: Ranges are numbered from -2**(RANGE_LEVELS - 2); halves of halves of all of them.
RANGE_LEVELS = 48


def with_earlier_max(df: DataFrame, order: str, value: str, *, tie: str, name: str = "earlier_max", width: int = RANGE_WIDTH) -> DataFrame:
    """Largest `value` of all rows before each row by (`order`, `tie`), NULL for the first.

    Rows are scanned inside ranges of the order. What lies before a range is
    made up of aligned blocks of ranges, one for each bit of its number, whose
    maxima are aggregated map-side: no task sees all ranges, no key all rows.
    """
    cut = df.withColumn("_range", F.floor(F.col(order) / width))
    top = cut.select((F.col("_range") + (1 << (RANGE_LEVELS - 2))).alias("_at"), "_range", F.col(value).alias("_value")).groupBy("_at", "_range").agg(F.max("_value").alias("_value"))
    levels = F.sequence(F.lit(0), F.lit(RANGE_LEVELS - 1))
    block = lambda k, at: F.call_function("shiftright", at, k)
    blocks = top.select("_value", F.explode(F.transform(levels, lambda k: F.struct(k.alias("level"), block(k, F.col("_at")).alias("block")))).alias("_b"))
    blocks = blocks.groupBy("_b.level", "_b.block").agg(F.max("_value").alias("_most"))
    before = F.filter(levels, lambda k: block(k, F.col("_at")) % 2 == 1)
    needed = top.select("_range", F.explode(F.transform(before, lambda k: F.struct(k.alias("level"), (block(k, F.col("_at")) - 1).alias("block")))).alias("_b"))
    carried = needed.select("_range", "_b.level", "_b.block").join(blocks, ["level", "block"]).groupBy("_range").agg(F.max("_most").alias("_carried"))
    inside = Window.partitionBy("_range").orderBy(order, tie).rowsBetween(Window.unboundedPreceding, -1)
    return (
        cut.withColumn("_inside", F.max(value).over(inside)).join(carried, "_range", "left")
        .withColumn(name, F.greatest("_inside", "_carried")).drop("_range", "_inside", "_carried")
    )


def renumber(
    df: DataFrame, keys: Sequence[str], order: str, first_event: str = "first_event",
    *, width: int = RANGE_WIDTH,
) -> DataFrame:
    """Contiguous ordinals from 0 and event numbers from the job's first event."""
    return with_rank(df, keys, order, width=width).withColumn(
        "event_number", F.col(first_event) + F.col("ordinal")
    )


def not_increasing(
    df: DataFrame, keys: Sequence[str], order: str, value: str, *, width: int = RANGE_WIDTH
) -> DataFrame:
    """Rows whose value does not exceed the value of the preceding row."""
    return with_previous(df, keys, order, value, width=width).where(
        F.col(value) <= F.col("previous")
    )


def not_contiguous(
    df: DataFrame, keys: Sequence[str], order: str, columns: Sequence[str],
    *, start: str | None = None, width: int = RANGE_WIDTH,
) -> DataFrame:
    """Rows where a stored ordinal differs from the recomputed position.

    With `start`, the columns count from that column instead of from zero.
    """
    base = F.col(start) if start else F.lit(0)
    bad = F.lit(False)
    for c in columns:
        bad = bad | (F.col(c) != base + F.col("_position"))
    ranked = with_rank(df, keys, order, name="_position", width=width)
    return ranked.where(bad).withColumnRenamed("_position", "position")
