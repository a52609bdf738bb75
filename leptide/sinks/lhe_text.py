"""Text form of matched generator events."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.lhe import CLOSE_ROOT

RANGE = 1 << 14


def event_text(
    weight: str = "weight", particles: str = "particles", weights: str = "weights"
) -> str:
    """Render a parsed event as an event element."""
    p = (
        f"transform({particles}, p -> concat_ws(' ', p.pdg, p.status, p.m1, p.m2, p.c1, p.c2, "
        "p.px, p.py, p.pz, p.e, p.mass, p.lifetime, p.spin))"
    )
    w = (
        f"transform(array_sort(map_keys({weights})), k -> concat('<wgt id=\\'', k, '\\'> ', "
        f"element_at({weights}, k), ' </wgt>'))"
    )
    return (
        f"concat('<event>\\n', size({particles}), ' 1 ', {weight}, ' 0 0 0\\n', array_join({p}, '\\n'), "
        f"'\\n <rwgt>\\n', array_join({w}, '\\n'), '\\n </rwgt>\\n</event>')"
    )


def write_lhe_text(
    events: DataFrame, preamble: str, path: str, *, job: str = "job_id", order: str = "source_event_id",
    text: str = "text", part_rows: int = RANGE,
) -> None:
    """One directory per job with complete documents in event order.

    A job is cut into documents of `part_rows` consecutive order values, each a
    well-formed document of its own, so no job has to pass through one task.
    """
    part = (F.col(order) / part_rows).cast("bigint")
    body = events.select(F.col(job), part.alias("part"), F.col(order).alias("o"), F.col(text).alias("value"))
    frame = body.groupBy(job, "part").agg(F.lit(1).alias("_x")).select(
        job, "part",
        F.explode(
            F.array(
                F.struct(F.lit(-1).cast("bigint").alias("o"), F.lit(preamble.rstrip("\n")).alias("value")),
                F.struct(F.lit((1 << 62)).cast("bigint").alias("o"), F.lit(CLOSE_ROOT).alias("value")),
            )
        ).alias("s"),
    ).select(job, "part", "s.o", "s.value")
    (
        body.select(job, "part", F.col("o").cast("bigint").alias("o"), "value")
        .unionByName(frame)
        .repartition(job, "part")
        .sortWithinPartitions(job, "part", "o")
        .drop("o")
        .write.mode("errorifexists")
        .partitionBy(job, "part")
        .text(path)
    )
