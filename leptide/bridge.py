"""Deterministic collision-event view over the plain test tables.

The test tables hold no collision events. `event_view_sql` derives four
leptons and a signed weight per row of `events`, using only integer
arithmetic, + - * / and sqrt, so that any SQL engine produces bit-equal
momenta. The same text runs in Spark and in the checking engine.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

JOB_SIZE = 250  # events per synthetic job

_KEYS = "em ep mm mp".split()
_NAMES = {
    "em": "electron_minus",
    "ep": "electron_plus",
    "mm": "muon_minus",
    "mp": "muon_plus",
}


def _h(s: int, n: int) -> str:
    """Hash of the row number into 0..n-1 (exact in 64-bit integers)."""
    return f"(((i % 10007) * (i % 10007) % 10007) * {s} + i * {s % 97 + 1} + {s}) % {n}"


def _u(s: int) -> str:
    return f"(({_h(s, 2001)}) - 1000) / 1e3"


def event_view_sql(source: str = "events") -> str:
    """SELECT text: one row per event with identity, weight and raw momenta."""
    mom = []
    for k in _KEYS:
        mom.append(
            f"{k}x as lhe_raw_{_NAMES[k]}_px, {k}y as lhe_raw_{_NAMES[k]}_py, "
            f"{k}z as lhe_raw_{_NAMES[k]}_pz, "
            f"sqrt({k}x*{k}x + {k}y*{k}y + {k}z*{k}z) as lhe_raw_{_NAMES[k]}_E"
        )
    return f"""
select cast(20260902 as bigint) as campaign_id, cast(0 as bigint) as sample_code,
       cast((i - i % {JOB_SIZE}) / {JOB_SIZE} as bigint) as job_id, i,
       i + 1 as source_event_id, i % 4 as channel_code, w,
       i % 5 <> 0 as reco_present,
       {", ".join(mom)}
from (
  select i, w,
    mx + d as mmx, my as mmy, mz + bz as mmz,
    d - mx as mpx, 0e0 - my as mpy, bz - mz as mpz,
    ex - d + r as emx, ey as emy, ez + bz as emz,
    r - ex - d as epx, 0e0 - ey as epy, bz - ez as epz
  from (
    select i, w, 3e1 + ({_h(811, 61)}) as d, {_u(907)} * 15e0 as r, {_u(991)} * 6e1 as bz,
      {_u(1009)} * 38e0 as mx, {_u(1110)} * 38e0 as my, {_u(1220)} * 38e0 as mz,
      {_u(2003)} * 38e0 as ex, {_u(2104)} * 38e0 as ey, {_u(2214)} * 38e0 as ez
    from (
      select event_id as i,
             case when event_type = 'error' then 0e0 - value else value end as w
      from {source}
    ) base
  ) angles
) momenta
"""


def tables(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def event_view(spark: SparkSession, sf_dir: str, *, parts: int | None = None, whole_jobs: bool = False) -> DataFrame:
    """The bridge view as a DataFrame (column `lhe_topology_valid` added).

    With `parts` the narrow rows are dealt out first, for work that is heavy a
    row: a small table has few splits. With `whole_jobs` the rows of a job go
    to one part together.
    """
    narrow = tables(spark, sf_dir, "events").select("event_id", "event_type", "value")
    if parts is not None:
        narrow = narrow.repartition(parts, F.expr(f"event_id div {JOB_SIZE}") if whole_jobs else F.col("event_id"))
    return from_events(spark, narrow)


def from_events(spark: SparkSession, events: DataFrame) -> DataFrame:
    df = spark.sql(event_view_sql("{events}"), events=events)
    return df.withColumn("lhe_topology_valid", F.lit(True))


def with_levels(df: DataFrame) -> DataFrame:
    """Append dressed and RECO raw momenta: rescaled copies of the generator ones.

    Every fifth row has no RECO candidate.
    """
    from .conventions import momentum_columns
    from .functions.numeric import NAN

    dressed = "(1e0 - (i * 31 % 7) / 1e3)"
    reco = "(1e0 + ((i * 17 % 11) - 5) / 1e3)"
    names = momentum_columns("lhe", "raw")
    return df.selectExpr(
        "*",
        "true as dressed_topology_valid",
        *[f"{c} * {dressed} as {c.replace('lhe_', 'dressed_', 1)}" for c in names],
        "reco_present as reco_topology_valid",
        *[f"if(reco_present, {c} * {reco}, {NAN}) as {c.replace('lhe_', 'reco_', 1)}" for c in names],
    )


def analysis_events(spark: SparkSession, sf_dir: str, *, parts: int | None = None, whole_jobs: bool = False) -> DataFrame:
    """Bridge events with all level records, selection, nominal and truth weights.

    The nominal weight is the table weight itself, so sums can be checked
    against it directly.
    """
    from .plans.build_events import kinematic_columns
    from .plans.merge_campaign import truth_columns

    df = kinematic_columns(with_levels(event_view(spark, sf_dir, parts=parts, whole_jobs=whole_jobs)))
    df = df.selectExpr("*", "w as weight_nominal_pb", "w as weight_lhe", "312000D as lumi")
    return truth_columns(df)
