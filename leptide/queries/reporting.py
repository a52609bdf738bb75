"""Histograms, acceptance, moments and closure."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import bridge
from ..conventions import HARMONIC_SLUGS, LEVELS
from ..operators import closure, levels, selection
from ..operators import histograms as h
from ..plans import build_events, merge_campaign, reports
from ..session import cut
from . import d, events, query, r, wrap_sql
from .derivations import _CUT, _F, _SEL, EV, H

_PASS = "(reco_present and " + " and ".join(f"({c})" for c in _CUT.values()) + ")"
# short spectrum list: name -> (checking expression, low, high, bins)
_SPECTRA = {
    "m_Z1": ("m1", 40, 200, 80),
    "m_ZZ": ("m4", 150, 1500, 54),
    "cos_theta1": ("c1", -1, 1, 40),
    "cos_theta_star": ("cstar", -1, 1, 40),
    "raw_muon_minus_px": ("mmx", -300, 300, 60),
    "electron_plus_pt_for_selection": ("pt_ep", 0, 300, 60),
    "ordered_pt2": ("pts[2]", 0, 300, 60),
}


def _bin_sql(x: str, lo: float, hi: float, n: int) -> str:
    """Index by comparison with every edge, folded at both ends."""
    step = (hi - lo) / n
    return (
        f"cast(least(greatest(len([e for e in range({n + 1}) if cast(e as double)*{step!r}e0 + {float(lo)!r}e0 <= {x}]) - 1, 0), {n - 1}) as bigint)"
    )


def _long_sql() -> str:
    parts = [
        f"select '{n}' as observable, round({x}, 6) as x, {_bin_sql(f'round({x}, 6)', lo, hi, k)} as bin, "
        f"round({x}, 6) < {float(lo)!r}e0 as under, round({x}, 6) > {float(hi)!r}e0 as over, w, {_PASS} as sel from s2"
        for n, (x, lo, hi, k) in _SPECTRA.items()
    ]
    return _SEL + ", long as (" + " union all ".join(parts) + ")"


def spectrum_events(spark, sf, level="lhe"):
    """Bridge events with the generator record, the selection on it, and rounded spectra."""
    ev = selection.add_selection(levels.derive_level(events(spark, sf), "lhe"), "lhe")
    ev = ev.withColumn("reconstructed", F.expr("reco_present and lhe_pass_selection"))
    return ev.withColumns({f"lhe_{n}": F.expr(f"round(lhe_{n}, 6)") for n in _SPECTRA})


def _spectra(spark, sf, names=None):
    specs = h.observable_table(variables=list(names or _SPECTRA))
    slots = h.fill(spectrum_events(spark, sf), specs, weight="w", levels=("lhe",))
    return slots, specs


@query(
    "A12_weighted_histograms",
    _long_sql() + " select 'all' as selection, observable, bin, count(*) as n, " + d("sum(w)", "sumw", 4) + ", " + d("sum(w*w)", "sumw2", 4)
    + " from long group by observable, bin union all select 'selected', observable, bin, count(*), " + d("sum(w)", "sumw", 4) + ", "
    + d("sum(w*w)", "sumw2", 4) + " from long where sel group by observable, bin",
)
def weighted_histograms(spark, sf):
    slots, specs = _spectra(spark, sf)
    hist = h.histograms(slots, specs, ("lhe",))
    return hist.where("n > 0").selectExpr(
        "selection", "observable", "bigint(bin) as bin", "n", r("sumw", "sumw", 4), r("sumw2", "sumw2", 4)
    )


@query(
    "A13_histogram_counters",
    _long_sql() + " select observable, count(*) as total, count(*) as filled, cast(0 as bigint) as invalid, count(*) filter (where under) as underflow, "
    "count(*) filter (where over) as overflow, " + d("sum(w)", "sumw", 4) + ", " + d("coalesce(sum(w) filter (where under), 0e0)", "underflow_sumw", 4)
    + " from long group by observable",
)
def histogram_counters(spark, sf):
    slots, specs = _spectra(spark, sf)
    c = h.counters(slots, specs, ("lhe",))
    return c.where("selection = 'all'").selectExpr(
        "observable", "total", "filled", "invalid", "underflow", "overflow", r("sumw", "sumw", 4), r("underflow_sumw", "underflow_sumw", 4)
    )


_T = _SEL + f", t as (select count(*) as entries, count(*) filter (where {_PASS}) as sel_n, sum(w) as s, sum(w*w) as q, sum(abs(w)) as a, sum(w) filter (where {_PASS}) as ss from s2)"


@query(
    "A14_A16_report_totals",
    _T + " select entries, sel_n as selected_entries, " + ", ".join([d("s", "sumw", 4), d("q", "sumw2", 4), d("a", "sumabsw", 4), d("ss/s", "ratio")]) + " from t",
)
def report_totals(spark, sf):
    slots, specs = _spectra(spark, sf, ["m_Z1"])
    return h.global_ratio(h.totals(slots, specs, ("lhe",))).selectExpr(
        "entries", "selected_entries", r("sumw", "sumw", 4), r("sumw2", "sumw2", 4), r("sumabsw", "sumabsw", 4), r("ratio", "ratio")
    )


_ACC = (
    _long_sql() + ", b as (select observable, bin, sum(w) as D, sum(w*w) as VD, coalesce(sum(w) filter (where sel), 0e0) as N, "
    "coalesce(sum(w*w) filter (where sel), 0e0) as VN from long group by 1, 2), rr as (select *, N/nullif(D,0e0) as rt from b where abs(D) > 32e0*2.220446049250313e-16*sqrt(VD))"
)


@query(
    "A12_A15_mass_spectrum_acceptance",
    _ACC + " select bin, " + d("N", "selected", 4) + ", " + d("D", "total", 4) + ", " + d("rt", "acceptance") + ", "
    + d("(VN*(1e0-rt)*(1e0-rt) + (VD-VN)*rt*rt)/(D*D)", "variance") + " from rr where observable = 'm_Z1'",
)
def mass_spectrum_acceptance(spark, sf):
    slots, specs = _spectra(spark, sf, ["m_Z1"])
    slots = cut(slots)  # at most one row per bin
    hist = h.histograms(slots, specs, ("lhe",))
    wide = hist.groupBy("bin").agg(
        F.expr("sum(if(selection='selected', sumw, 0D)) as s"), F.expr("sum(if(selection='all', sumw, 0D)) as t")
    )
    acc = h.acceptance(hist).where("valid")
    return acc.join(F.broadcast(wide), "bin").selectExpr(
        "bigint(bin) as bin", r("s", "selected", 4), r("t", "total", 4), r("ratio", "acceptance"), r("ratio_variance", "variance")
    )


@query(
    "P39_R02_yields",
    _long_sql() + " select bin, " + d("sum(w)*312000e0/25e0", "yield_density", 1) + ", " + d("sqrt(sum(w*w))*312000e0/25e0", "yield_error", 1)
    + " from long where observable = 'm_ZZ' and sel group by bin",
)
def expected_yields(spark, sf):
    slots, specs = _spectra(spark, sf, ["m_ZZ"])
    y = h.yields(h.histograms(slots, specs, ("lhe",)), 312000.0)
    return y.where("selection = 'selected' and n > 0").selectExpr(
        "bigint(bin) as bin", r("yield_density", "yield_density", 1), r("yield_density_error", "yield_error", 1)
    )


@query(
    "A12_A15_line_price_spectrum",
    "with x as (select case when l_returnflag = 'R' then -l_quantity else l_quantity end as w, l_extendedprice as p, l_linestatus = 'O' as sel from lineitem), "
    "b as (select cast(greatest(least(floor(p/1000e0), 49), 0) as bigint) as bin, sum(w) as d, sum(w*w) as vd, coalesce(sum(w) filter (where sel),0e0) as n, "
    "coalesce(sum(w*w) filter (where sel),0e0) as vn from x group by 1) select bin, " + d("n/d", "ratio") + ", "
    + d("(vn*(1e0-n/d)*(1e0-n/d) + (vd-vn)*(n/d)*(n/d))/(d*d)", "variance") + " from b where abs(d) > 1e-6",
)
def line_price_spectrum(spark, sf):
    """The same accumulation on signed line quantities over price."""
    from ..functions.statistics import subset_ratio

    li = bridge.tables(spark, sf, "lineitem").selectExpr(
        "if(l_returnflag = 'R', -l_quantity, l_quantity) as w", "l_linestatus = 'O' as sel",
        f"bigint({h.uniform_bin('l_extendedprice', '0D', '50000D', '1000D', '50')}) as bin",
    )
    b = li.groupBy("bin").agg(
        F.expr("sum(w) as d"), F.expr("sum(w*w) as vd"), F.expr("sum(if(sel, w, 0D)) as n"), F.expr("sum(if(sel, w*w, 0D)) as vn")
    )
    q = subset_ratio("n", "d", "vn", "vd")
    return b.where("abs(d) > 1e-6D").selectExpr("bin", r(q.value, "ratio"), r(q.variance, "variance"))


_ALL_OBSERVABLES = [o.name for o in h.observable_table()]


@query(
    "A12_R02_full_kinematic_report",
    EV + ", t as (select count(*) as n, sum(w) as s, sum(w*w) as q from ev) select level, observable, n, n as in_bins, cast(0 as bigint) as invalid, "
    + ", ".join([d("s", "sumw", 4), d("q", "sumw2", 3), d("s * 312000e0", "expected_events", 0)])
    + f" from t, (values ('lhe'), ('dressed')) l(level), (select unnest({_ALL_OBSERVABLES!r}) as observable) o",
)
def full_report(spark, sf):
    """The report over all 77 observables at all levels, 385 histograms in one pass: what its bins hold of all events."""
    report = reports.kinematic_report(bridge.analysis_events(spark, sf), check=False)
    bins = report.histograms.where("selection = 'all'").groupBy("level", "observable").agg(
        F.sum("n").alias("in_bins"), F.sum(F.expr("yield_density * (high - low)")).alias("expected_events")
    )
    held = report.counters.where("selection = 'all'").join(bins, ["level", "observable"])
    return held.selectExpr(
        "level", "observable", "total as n", "in_bins", "invalid", r("sumw", "sumw", 4), r("sumw2", "sumw2", 3), r("expected_events", "expected_events", 0)
    )


_CATEGORY = {
    "m_Z1": "kinematics", "m_ZZ": "kinematics", "cos_theta1": "kinematics", "cos_theta_star": "kinematics",
    "raw_muon_minus_px": "momenta", "electron_plus_pt_for_selection": "selection", "ordered_pt2": "selection",
}


@query(
    "R01_observable_table",
    "select observable, category, bins::bigint as bins, n from (values " + ", ".join(
        f"('{n}', '{_CATEGORY[n]}', {k})" for n, (_, _, _, k) in _SPECTRA.items()) + ") t(observable, category, bins), "
    "(select count(*) as n from events) c",
)
def observable_table(spark, sf):
    """The observable dimension joined to the filled bins."""
    slots, specs = _spectra(spark, sf)
    hist = h.histograms(slots, specs, ("lhe",)).where("selection = 'all'").select("observable", "bin", "n")
    dim = h.observable_dimension(spark, specs)
    return hist.join(F.broadcast(dim), ["observable", "bin"]).groupBy("observable", "category").agg(
        F.count("*").alias("bins"), F.sum("n").alias("n")
    )


# -- moments and closure -----------------------------------------------------------
def _closure_events(spark, sf):
    ev = levels.derive_level(events(spark, sf), "lhe")
    ev = ev.withColumns({f"lhe_{a}": F.expr(f"round(lhe_{a}, 6)") for a in ("theta1", "phi1", "theta2", "phi2")})
    ev = merge_campaign.truth_columns(ev.withColumnRenamed("w", "weight_nominal_pb"))
    return ev.withColumn("reconstructed", F.col("reco_present"))


def _acc(spark, sf, **kw):
    return closure.accumulate(_closure_events(spark, sf), levels=("lhe",), **kw)


# the same rounded angles in the checking engine
_R = H + (
    ", r1 as (select i, w, reco_present as sel, round(acos(c1), 6) as t1, round(p1, 6) as p1, round(acos(c2), 6) as t2, round(p2, 6) as p2 from h), "
    "r2 as (select *, cos(t1) as c1, cos(t2) as c2, sin(t1) as s1, sin(t2) as s2 from r1), "
    "f as (select *, " + ", ".join(f"{_F[s]} as f{k}" for k, s in enumerate(HARMONIC_SLUGS, 1)) + " from r2)"
)
_M = [f"w*f{a}" for a in range(1, 5)]


@query(
    "A17_A21_moments_and_covariance",
    _R + ", cx as (select 'all' as selection, * from f union all select 'selected', * from f where sel) select selection, count(*) as total, count(*) as kept, "
    + ", ".join([d("sum(w)", "s0", 3)] + [d(f"sum({m})", f"s{a}", 3) for a, m in enumerate(_M, 1)] + [d("sum(w*w)", "v00", 4)]
                + [d(f"sum(w*{m})", f"v0{a}", 2) for a, m in enumerate(_M, 1)]
                + [d(f"sum({_M[a - 1]}*{_M[b - 1]})", f"v{a}{b}", 2) for a in range(1, 5) for b in range(a, 5)]) + " from cx group by selection",
)
def moments_and_covariance(spark, sf):
    m = closure.moments(_acc(spark, sf), levels=("lhe",))
    return m.selectExpr(
        "selection", "total", "kept", *[r(f"s{a}", f"s{a}", 3) for a in range(5)],
        *[r(f"v{a}{b}", f"v{a}{b}", 2 if b else 4) for a in range(5) for b in range(a, 5)],
    )


@query(
    "A19_normalized_coefficients",
    _R + ", q as (select sum(w) as d, sum(w*w) as vd, " + ", ".join(
        f"sum({m}) as n{a}, sum({m}*{m}) as vn{a}, sum(w*{m}) as c{a}" for a, m in enumerate(_M, 1)) + " from f) "
    + " union all ".join(
        f"select '{s}' as component, " + d(f"n{a}/d", "ratio") + ", " + d(f"(vn{a} + (n{a}/d)*(n{a}/d)*vd - 2e0*(n{a}/d)*c{a})/(d*d)", "variance", 8) + " from q"
        for a, s in enumerate(HARMONIC_SLUGS, 1)),
)
def normalized_coefficients(spark, sf):
    m = closure.moments(_acc(spark, sf), levels=("lhe",))
    return closure.normalized_coefficients(m).where("selection = 'all' and component <> '00_00'").selectExpr(
        "component", r("ratio", "ratio"), r("ratio_variance", "variance", 8)
    )


def _proj_sql(name: str, x: str, lo: float, hi: float, n: int = 24) -> str:
    return (
        f"select '{name}' as projection, {_bin_sql(x, lo, hi, n)} as bin, count(*) as n, " + d("sum(w)", "nominal", 4) + ", "
        + d("sum(w*w)", "nominal_variance", 4) + ", " + d("sum(w*w*f1)", "x1", 2) + " from f group by 2"
    )


_PI = 3.141592653589793


@query(
    "A18_binned_cross_covariance",
    _R + " " + " union all ".join([
        _proj_sql("theta1", "t1", 0.0, _PI), _proj_sql("phi2", wrap_sql("p2"), -_PI, _PI), _proj_sql("cos_theta2", "c2", -1.0, 1.0),
        f"select 'cos_theta1_vs_cos_theta2', {_bin_sql('c1', -1.0, 1.0, 12)}*12 + {_bin_sql('c2', -1.0, 1.0, 12)} as bin, count(*), "
        + d("sum(w)", "nominal", 4) + ", " + d("sum(w*w)", "nominal_variance", 4) + ", " + d("sum(w*w*f1)", "x1", 2) + " from f group by 2",
    ]),
)
def binned_cross_covariance(spark, sf):
    names = ("theta1", "phi2", "cos_theta2", closure.MAP)
    b = closure.bins(_acc(spark, sf, projections=names), projections=names, levels=("lhe",))
    return b.where("selection = 'all' and n > 0").selectExpr(
        "projection", "bigint(bin) as bin", "n", r("nominal", "nominal", 4), r("nominal_variance", "nominal_variance", 4), r("x1", "x1", 2)
    )


@query(
    "A20_R03_R04_closure_evaluation",
    _R + ", q as (select sum(w) as s0, sum(w*f1) as s1, sum(w*w) as v00, sum(w*w*f1) as v01, sum(w*w*f1*f1) as v11 from f), "
    "e as (select cast(b as bigint) as bin, -1e0 + b/12e0 as lo, -1e0 + (b+1)/12e0 as hi from range(24) t(b)), "
    "t as (select bin, (hi-lo)/2e0 as t0, sqrt(2.5e0)*((hi*hi*hi-hi)-(lo*lo*lo-lo))/4e0 as t1 from e), "
    f"n as (select {_bin_sql('c1', -1.0, 1.0, 24)} as bin, sum(w) as nominal, sum(w*w) as vn, sum(w*w*f1) as x1 from f group by 1), "
    "m as (select bin, t0*s0 + t1*s1 as model, t0*t0*v00 + 2e0*t0*t1*v01 + t1*t1*v11 as mv, coalesce(nominal,0e0) as nominal, coalesce(vn,0e0) as vn, "
    "t0*coalesce(vn,0e0) + t1*coalesce(x1,0e0) as cov from t cross join q left join n using (bin)) select bin, "
    + ", ".join([d("model", "model", 4), d("mv", "model_variance", 2), d("model - nominal", "residual", 4), d("mv + vn - 2e0*cov", "residual_variance", 2)]) + " from m",
)
def closure_evaluation(spark, sf):
    acc = cut(_acc(spark, sf, projections=["cos_theta1"]))
    e = closure.evaluate(acc, projections=["cos_theta1"], levels=("lhe",))
    return e.where("selection = 'all'").selectExpr(
        "bigint(bin) as bin", r("model", "model", 4), r("model_variance", "model_variance", 2), r("residual", "residual", 4),
        r("residual_variance", "residual_variance", 2),
    )


def _report_events(spark, sf):
    """All levels, angles rounded as in the checking engine; dressed and RECO momenta are multiples of the generator's."""
    ev = build_events.kinematic_columns(bridge.with_levels(events(spark, sf)))
    angles = [f"{level}_{a}" for level in LEVELS for a in ("theta1", "phi1", "theta2", "phi2")]
    ev = ev.withColumns({a: F.expr(f"if(isnan({a}), {a}, round({a}, 6))") for a in angles})
    ev = merge_campaign.truth_columns(ev.withColumnRenamed("w", "weight_nominal_pb"))
    return ev.withColumns({"reconstructed": F.col("reco_present"), "lumi": F.lit(312000.0)})


_CONTEXTS = (
    ", cx as (select level, 'all' as selection, f.* from f, (values ('lhe'), ('dressed')) l(level) "
    "union all select level, 'selected', f.* from f, (values ('lhe'), ('dressed'), ('reco')) l(level) where sel)"
)


@query(
    "R04_closure_report",
    _R + _CONTEXTS + " select level, selection, count(*) as total, count(*) as kept, "
    + ", ".join([d("sum(w)", "s0", 3)] + [d(f"sum({m})", f"s{a}", 3) for a, m in enumerate(_M, 1)] + [d("sum(w*w)", "v00", 3)]
                + [d(f"sum(w*{m})", f"v0{a}", 2) for a, m in enumerate(_M, 1)]
                + [d(f"sum({_M[a - 1]}*{_M[b - 1]})", f"v{a}{b}", 1) for a in range(1, 5) for b in range(a, 5)]) + " from cx group by level, selection",
)
def closure_report(spark, sf):
    """The report's moments and covariance in all five contexts."""
    report = reports.closure_report(_report_events(spark, sf), variables=["cos_theta1"], check=False)
    return report.moments.selectExpr(
        "level", "selection", "total", "kept", *[r(f"s{a}", f"s{a}", 3) for a in range(5)],
        *[r(f"v{a}{b}", f"v{a}{b}", 1 if a else 2 if b else 3) for a in range(5) for b in range(a, 5)],
    )
