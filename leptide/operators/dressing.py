"""Photon dressing: each photon joins its nearest lepton inside a cone.

The cone is found through a grid in (eta, phi), four radii wide: a lepton is
entered in every cell its cone touches (on average 2.25, one to four), and a photon looks
up its own, so only nearby pairs are ever formed, also in events with very
many particles.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import num
from ..functions.vectors import P4, delta_r, eta, phi, pt


def with_directions(df: DataFrame) -> DataFrame:
    """Append pt, eta, phi to rows that hold px, py, pz, e."""
    v = P4("px", "py", "pz", "e")
    return df.selectExpr("*", f"{pt(v)} as pt", f"{eta(v)} as eta", f"{phi(v)} as phi")


def entered(leptons: DataFrame, photons: DataFrame, max_delta_r: float) -> tuple[DataFrame, DataFrame]:
    """Leptons in each cell their cone touches, and photons in their own cell."""
    size = 4 * max_delta_r
    cells = max(int(math.floor(2 * math.pi / size)), 1)
    width = 2 * math.pi / cells
    reach = num(max_delta_r * (1 + 1e-6))  # roundoff cannot hide a cell
    row = lambda x: f"cast(floor(({x}) / {num(size)}) as bigint)"
    column = lambda x: f"cast(floor(({x} + {num(math.pi)}) / {num(width)}) as bigint)"
    rows = f"sequence({row(f'eta - {reach}')}, {row(f'eta + {reach}')})"
    columns = f"array_distinct(transform(sequence({column(f'phi - {reach}')}, {column(f'phi + {reach}')}), c -> pmod(c, {cells})))"
    placed = leptons.selectExpr(
        "event_id", "lepton_id", "eta as l_eta", "phi as l_phi", f"{columns} as cs", f"explode({rows}) as cell_r"
    ).selectExpr("event_id", "lepton_id", "l_eta", "l_phi", "cell_r", "explode(cs) as cell_c")
    asked = photons.selectExpr(
        "event_id", "photon_id", "eta", "phi", f"{row('eta')} as cell_r", f"pmod({column('phi')}, {cells}) as cell_c"
    )
    return placed, asked


def nearest_lepton(leptons: DataFrame, photons: DataFrame, max_delta_r: float) -> DataFrame:
    """(event_id, photon_id, lepton_id, delta_r) for photons inside a cone.

    Both sides hold event_id, their own id, eta and phi. Ties go to the lepton
    with the smaller id. The nearest one is kept by a map-side-combined minimum.
    """
    placed, asked = entered(leptons, photons, max_delta_r)
    pairs = asked.join(placed, ["event_id", "cell_r", "cell_c"]).selectExpr(
        "event_id", "photon_id", "lepton_id", f"{delta_r('l_eta', 'l_phi', 'eta', 'phi')} as delta_r"
    )
    return (
        pairs.where(f"delta_r < {num(max_delta_r)}")
        .groupBy("event_id", "photon_id")
        .agg(F.min(F.struct("delta_r", "lepton_id")).alias("best"))
        .select("event_id", "photon_id", F.col("best.lepton_id").alias("lepton_id"), F.col("best.delta_r").alias("delta_r"))
    )


def dress(
    leptons: DataFrame, photons: DataFrame, *, max_delta_r: float = 0.1, min_photon_pt: float = 0.1
) -> DataFrame:
    """Leptons with the momenta of their photons added; bare ones are kept.

    Leptons: event_id, lepton_id, px, py, pz, e. Photons: event_id, photon_id
    and momenta, already restricted to eligible final-state photons.
    """
    l = with_directions(leptons)
    p = with_directions(photons).where(f"pt > {num(min_photon_pt)} and not isnan(eta)")
    owner = nearest_lepton(l.where("not isnan(eta)"), p, max_delta_r).select("event_id", "photon_id", "lepton_id")
    added = (
        p.join(owner, ["event_id", "photon_id"])
        .groupBy("event_id", "lepton_id")
        .agg(F.count("*").alias("n"), *[F.sum(c).alias(f"g_{c}") for c in ("px", "py", "pz", "e")])
    )
    return leptons.join(added, ["event_id", "lepton_id"], "left").selectExpr(
        *[c for c in leptons.columns if c not in ("px", "py", "pz", "e")],
        *[f"{c} + coalesce(g_{c}, 0D) as {c}" for c in ("px", "py", "pz", "e")],
        "coalesce(n, 0) as n_photons",
    )
