"""Report datasets: kinematic spectra with acceptance, and angular closure."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import audit, closure
from ..operators import histograms as h
from ..session import cut


class KinematicReport(NamedTuple):
    histograms: DataFrame
    counters: DataFrame
    totals: DataFrame
    acceptance: DataFrame
    findings: DataFrame


class ClosureReport(NamedTuple):
    moments: DataFrame
    coefficients: DataFrame
    closure: DataFrame
    findings: DataFrame


def _luminosity(events: DataFrame, lumi_pb: float | None) -> float:
    if lumi_pb is not None:
        if not (math.isfinite(lumi_pb) and lumi_pb > 0):
            raise ValueError("lumi_pb must be finite and positive")
        return float(lumi_pb)
    if "lumi" not in events.columns:
        raise ValueError("no lumi column; give lumi_pb in pb^-1")
    row = events.select("lumi").first()  # that it is constant is an audit rule
    if row is None or row.lumi is None:
        raise ValueError("there are no events")
    return float(row.lumi)


def input_findings(events: DataFrame) -> DataFrame:
    """Weights finite, one sample, one positive luminosity."""
    constants, positive = ["sample_code"], []
    if "lumi" in events.columns:
        constants.append("lumi")
        positive.append("lumi")
    return audit.combine(
        audit.weight_rules(events, [], ["weight_nominal_pb"]),
        audit.constant_rules(events, constants, positive),
    )


def kinematic_report(
    events: DataFrame, *, lumi_pb: float | None = None, bin_edges: Mapping[str, Sequence[float]] | None = None,
    variables: Sequence[str] | None = None, check: bool = True,
) -> KinematicReport:
    """Histograms, counters, totals and acceptance of merged events.

    The event table is read once; the filled slots, bounded by the number of
    bins, are kept and everything else derives from them.
    """
    specs = h.observable_table(bin_edges, variables)
    lumi = _luminosity(events, lumi_pb)
    found = input_findings(events)
    if check:
        audit.enforce(found)
    slots = cut(h.fill(events, specs))
    hist = h.yields(h.histograms(slots, specs), lumi)
    label = events.limit(1).select(F.expr(h.sample_label()).alias("s")).scalar()
    return KinematicReport(
        hist,
        h.counters(slots, specs),
        h.global_ratio(h.totals(slots, specs)).withColumns({"sample_label": label, "lumi_pb": F.lit(lumi)}),
        h.acceptance(hist),
        found,
    )


def closure_report(
    events: DataFrame, *, bins: int = 24, map_bins: int = 12, variables: Sequence[str] | None = None,
    components: Sequence[str] | None = None, lumi_pb: float | None = None, check: bool = True,
) -> ClosureReport:
    """Moments, normalized coefficients and density closure of merged events."""
    binning = closure.Binning(bins, map_bins)
    _luminosity(events, lumi_pb)
    found = audit.combine(
        input_findings(events), audit.truth_weight_rules(events, ["job_id", "source_event_id"])
    )
    if check:
        audit.enforce(found)
    acc = cut(closure.accumulate(events, binning=binning, projections=variables))
    kw = dict(binning=binning, projections=variables)
    m = closure.moments(acc, **kw)
    return ClosureReport(
        m,
        closure.normalized_coefficients(m),
        closure.evaluate(acc, components=components, **kw),
        found,
    )
