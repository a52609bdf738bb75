"""Key-based matching of event streams; no stream is walked in lockstep."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..conventions import IDENTITY
from .audit import Findings, findings

PAIR_KEY = ("job_id", "source_event_id")


def select_requested(
    events: DataFrame, requested: DataFrame, keys: Sequence[str] = PAIR_KEY
) -> tuple[DataFrame, DataFrame]:
    """(events asked for, requested keys that do not exist)."""
    wanted = requested.select(*keys).distinct()
    return events.join(wanted, list(keys), "left_semi"), wanted.join(
        events.select(*keys), list(keys), "left_anti"
    )


def match_streams(
    left: DataFrame, right: DataFrame, keys: Sequence[str] = PAIR_KEY
) -> DataFrame:
    """Full-outer pairing with `match`: both, left_only or right_only.

    Apart from the keys, column names must not overlap. Keys are unique per
    side in clean data; `duplicate_keys` reports where they are not.
    """
    l = left.withColumn("_left", F.lit(True))
    r = right.withColumn("_right", F.lit(True))
    both = l.join(r, list(keys), "full_outer")
    label = (
        F.when(F.col("_left").isNotNull() & F.col("_right").isNotNull(), "both")
        .when(F.col("_left").isNotNull(), "left_only")
        .otherwise("right_only")
    )
    return both.withColumn("match", label).drop("_left", "_right")


def match_findings(
    matched: DataFrame, left_ordinal: str, right_ordinal: str, keys: Sequence[str] = PAIR_KEY
) -> Findings:
    """Violations: unmatched rows and rows whose two ordinals disagree."""
    unmatched = findings(
        matched.where("match <> 'both'"), "match.unmatched", keys, "match", "'both'"
    )
    shifted = findings(
        matched.where(f"match = 'both' and {left_ordinal} <> {right_ordinal}"),
        "match.ordinal", keys, left_ordinal, right_ordinal,
    )
    return unmatched.unionByName(shifted)


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their count."""
    return df.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")


def aligned_weights(events: DataFrame, weights: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(joined rows, events without weights, weights without events)."""
    keys = [k for k in IDENTITY if k in events.columns and k in weights.columns]
    joined = events.join(weights, keys)
    return (
        joined,
        events.select(*keys).join(weights.select(*keys), keys, "left_anti"),
        weights.select(*keys).join(events.select(*keys), keys, "left_anti"),
    )


def with_run_columns(
    events: DataFrame, runs: DataFrame, keys: Sequence[str], columns: Sequence[str]
) -> DataFrame:
    """Attach columns of the job row to its events.

    Runs hold one row per job. Spark broadcasts them when their measured size
    is below the broadcast threshold and hashes both sides otherwise.
    """
    return events.join(runs.select(*keys, *columns), list(keys), "left")
