"""Per-event derivations: buckets, composites, projection, angles, selection."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import bridge
from ..conventions import COMPONENTS, HARMONIC_SLUGS, LEPTON_PAIRS, LEPTONS, momentum_columns
from ..functions import harmonics, identity, numeric, response, vectors
from ..operators import levels, moments, selection
from ..plans import compose_channels, merge_campaign
from . import SHORT, angle_sql, d, d_angle, decoded_sql, events, lhe_level, query, r, r_angle, view_sql, wrap_sql

V = f"with {view_sql()}"
G = f"with {angle_sql()}"
EV = f"with ev as ({bridge.event_view_sql('events')})"


# -- buckets ----------------------------------------------------------------
def _particles(names=LEPTONS) -> str:
    """Particle array with decoys: a wrong status, a neutrino, and duplicates."""
    p = lambda pdg, status, k: (
        f"named_struct('pdg', {pdg}, 'status', {status}, 'px', lhe_raw_{k}_px, 'py', lhe_raw_{k}_py, "
        f"'pz', lhe_raw_{k}_pz, 'e', lhe_raw_{k}_E)"
    )
    codes = dict(zip(LEPTONS, (11, -11, 13, -13)))
    rows = [p(f"int({codes[k]})", "int(1)", k) for k in names]
    rows += [p("int(11)", "int(2)", "electron_minus"), p("int(12)", "int(1)", "muon_minus")]
    base = f"array({', '.join(rows)})"
    extra = p("int(13)", "int(1)", "muon_minus")
    return f"if(i % 7 = 0, array_append({base}, {extra}), {base})"


@query(
    "P01_lhe_buckets_and_candidate",
    V + ", z as (select *, i % 7 <> 0 as ok from v) select i, cast(1 as bigint) as n_em, "
    "cast(case when ok then 1 else 2 end as bigint) as n_mm, ok as candidate, "
    "cast(case when ok then 2 else 3 end as bigint) as n_muons, "
    + d("case when ok then mmx end", "mm_px") + " from z",
)
def lhe_buckets(spark, sf):
    df = events(spark, sf).drop("lhe_topology_valid", *momentum_columns("lhe", "raw"))
    raw = events(spark, sf).selectExpr("i", f"{_particles()} as particles")
    del df
    out = levels.attach_candidate(raw, "lhe", levels.buckets_from_lhe())
    return out.selectExpr(
        "i", "bigint(lhe_n_electron_minus) as n_em", "bigint(lhe_n_muon_minus) as n_mm",
        "lhe_topology_valid as candidate", "bigint(lhe_n_muons) as n_muons",
        r("lhe_raw_muon_minus_px", "mm_px"),
    )


def _dressed(spark, sf):
    p = lambda pid, k: (
        f"named_struct('pid', int({pid}), 'e', lhe_raw_{k}_E, 'px', lhe_raw_{k}_px, "
        f"'py', lhe_raw_{k}_py, 'pz', lhe_raw_{k}_pz)"
    )
    e, m = [p(11, "electron_minus"), p(-11, "electron_plus")], [p(13, "muon_minus"), p(-13, "muon_plus")]
    return events(spark, sf).selectExpr(
        "i", "job_id", "source_event_id",
        f"if(i % 3 = 0, array({e[0]}), array({', '.join(e)})) as dressed_electron",
        f"array({', '.join(m)}) as dressed_muon",
    )


@query(
    "P02_dressed_buckets",
    V + " select i, cast(case when i % 3 = 0 then 0 else 1 end as bigint) as n_ep, "
    "cast(case when i % 3 = 0 then 1 else 2 end as bigint) as n_electrons, i % 3 <> 0 as candidate, "
    + d("case when i % 3 <> 0 then epz end", "ep_pz") + " from v",
)
def dressed_buckets(spark, sf):
    out = levels.attach_candidate(_dressed(spark, sf), "dressed", levels.buckets_from_dressed())
    return out.selectExpr(
        "i", "bigint(dressed_n_electron_plus) as n_ep", "bigint(dressed_n_electrons) as n_electrons",
        "dressed_topology_valid as candidate", r("dressed_raw_electron_plus_pz", "ep_pz"),
    )


def _reco(spark, sf):
    ev = events(spark, sf)
    dirs = {k: vectors.p4(f"lhe_raw_{k}") for k in LEPTONS}
    p = lambda k, q: (
        f"named_struct('pt', {vectors.pt(dirs[k])}, 'eta', {vectors.eta(dirs[k])}, "
        f"'phi', {vectors.phi(dirs[k])}, 'charge', {q})"
    )
    return ev.selectExpr(
        "i",
        f"array({p('electron_minus', 'if(i % 9 = 0, 0D, -1D)')}, {p('electron_plus', '1D')}) as reco_electron",
        f"array({p('muon_minus', '-1D')}, {p('muon_plus', '1D')}) as reco_muon",
    )


@query(
    "P03_reco_buckets_from_pt_eta_phi",
    V + ", z as (select *, i % 9 <> 0 as ok from v) select i, cast(case when ok then 1 else 0 end as bigint) as n_em, ok as candidate, "
    + d("case when ok then mpx end", "mp_px", 5) + ", " + d("case when ok then mpz end", "mp_pz", 5) + ", "
    + d("case when ok then sqrt(mpx*mpx+mpy*mpy+mpz*mpz+0.1056583755e0*0.1056583755e0) end", "mp_e", 5) + " from z",
)
def reco_buckets(spark, sf):
    out = levels.attach_candidate(_reco(spark, sf), "reco", levels.buckets_from_reco())
    return out.selectExpr(
        "i", "bigint(reco_n_electron_minus) as n_em", "reco_topology_valid as candidate",
        r("reco_raw_muon_plus_px", "mp_px", 5), r("reco_raw_muon_plus_pz", "mp_pz", 5),
        r("reco_raw_muon_plus_E", "mp_e", 5),
    )


@query(
    "P04_P05_order_candidates",
    "select l_orderkey, count(*) filter (where l_returnflag='A') as n_a, count(*) filter (where l_returnflag='N') as n_n, "
    "count(*) filter (where l_returnflag='R') as n_r, count(*) filter (where l_linestatus='O') as n_o, "
    "(count(*) filter (where l_returnflag='A')=1 and count(*) filter (where l_returnflag='N')=1 and "
    "count(*) filter (where l_returnflag='R')=1 and count(*) filter (where l_linestatus='O')=1) as candidate "
    "from lineitem group by l_orderkey",
)
def order_candidates(spark, sf):
    n = bridge.tables(spark, sf, "lineitem").groupBy("l_orderkey").agg(
        F.expr("count_if(l_returnflag='A') as n_a"), F.expr("count_if(l_returnflag='N') as n_n"),
        F.expr("count_if(l_returnflag='R') as n_r"), F.expr("count_if(l_linestatus='O') as n_o"),
    )
    sizes = dict(zip(LEPTONS, ("n_a", "n_n", "n_r", "n_o")))
    return n.selectExpr("*", f"{levels.is_unique(sizes)} as candidate")


# -- composites, boosts, projection -----------------------------------------
@query(
    "P06_P07_composite_kinematics",
    V + " select i, " + ", ".join([
        d("m1", "m_z1"), d("m2", "m_z2"), d("m4", "m_4l"), d("sqrt(ax*ax+ay*ay)", "pt_z1"),
        d("asinh(mmz/sqrt(mmx*mmx+mmy*mmy))", "eta_mm"), d("atan2(mmy, mmx)", "phi_mm"),
        d("0.5e0*ln((te+tz)/(te-tz))", "y_4l"),
    ]) + " from v",
)
def composite_kinematics(spark, sf):
    c = levels.composites("lhe")
    mm = vectors.p4("lhe_raw_muon_minus")
    return events(spark, sf).selectExpr(
        "i", r(vectors.mass(c["Z1"]), "m_z1"), r(vectors.mass(c["Z2"]), "m_z2"), r(vectors.mass(c["X"]), "m_4l"),
        r(vectors.pt(c["Z1"]), "pt_z1"), r(vectors.eta(mm), "eta_mm"), r(vectors.phi(mm), "phi_mm"),
        r(vectors.rapidity(c["X"]), "y_4l"),
    )


@query(
    "P08_boost_to_rest_frame",
    V + " select i, " + ", ".join(
        d(f"({s}e*te-{s}x*tx-{s}y*ty-{s}z*tz)/m4", f"e_rest_{s}") for s in SHORT.values()
    ) + " from v",
)
def boost_to_rest(spark, sf):
    x = levels.composites("lhe")["X"]
    names = ("px", "py", "pz", "E")
    ev = events(spark, sf).selectExpr("*", *[f"{c} as x_{n}" for n, c in zip(names, x)])
    x = vectors.p4("x")
    ev = ev.selectExpr("*", *[f"{c} as b{n}" for n, c in zip("xyz", vectors.velocity(x))])
    b = vectors.P3("bx", "by", "bz")
    ev = ev.selectExpr("*", f"{vectors.gamma(vectors.dot(b, b))} as g")
    return ev.selectExpr(
        "i",
        *[
            r(vectors.to_rest_of_beta(vectors.p4(f"lhe_raw_{k}"), b, "g").e, f"e_rest_{s}")
            for k, s in SHORT.items()
        ],
    )


@query(
    "P09_P10_born_projection",
    G + " select i, true as projection_valid, " + ", ".join([
        d("m4", "raw_m4l"), d("m4", "born_m4l"), d("0.5e0*ln((te+tz)/(te-tz))", "raw_y4l"),
        d("0.5e0*ln((te+tz)/(te-tz))", "born_y4l"), d("sqrt(tx*tx+ty*ty)", "raw_pt4l"), d("0e0", "born_pt4l"),
        d("mprx", "mp_px"), d("gl*(mpzl+bl*mpre)", "mp_pz"), d("gl*(epre+bl*epzl)", "ep_e"),
    ]) + " from g",
)
def born_projection(spark, sf):
    f = "lhe_"
    return lhe_level(spark, sf).selectExpr(
        "i", "lhe_projection_valid as projection_valid",
        *[r(f + n, n) for n in ("raw_m4l", "born_m4l", "raw_y4l", "born_y4l", "raw_pt4l", "born_pt4l")],
        r("lhe_born_muon_plus_px", "mp_px"), r("lhe_born_muon_plus_pz", "mp_pz"), r("lhe_born_electron_plus_E", "ep_e"),
    )


@query(
    "P11_P12_decay_angles",
    G + " select i, " + ", ".join([
        d("acos(c1)", "theta1"), d("p1", "phi1"), d("c1", "cos_theta1"), d("acos(c2)", "theta2"),
        d("p2", "phi2"), d("c2", "cos_theta2"),
    ]) + ", false as frame_degenerate from g",
)
def decay_angles(spark, sf):
    names = ("theta1", "phi1", "cos_theta1", "theta2", "phi2", "cos_theta2")
    return lhe_level(spark, sf).selectExpr(
        "i", *[r(f"lhe_{n}", n) for n in names], "lhe_frame_degenerate as frame_degenerate"
    )


@query(
    "P13_P14_standard_angles",
    G + " select i, " + ", ".join([
        d("cstar", "cos_theta_star"), d("abs(cstar)", "abs_cos_theta_star"), d("acos(0e0-c1)", "theta1_standard"),
        d("acos(0e0-c2)", "theta2_standard"), d(wrap_sql("p1+p2"), "Phi_standard"), d("case when abs(p1) >= 3.141592653589793e0 then 3.141592653589793e0 else 0e0-p1 end", "Phi1_standard"),
        d(wrap_sql(f"{wrap_sql('p1+p2')}/2e0 - p1"), "Psi_standard"), d("m1", "m_Z1"), d("m4", "m_ZZ"),
    ]) + " from g",
)
def standard_angles(spark, sf):
    names = ("cos_theta_star", "abs_cos_theta_star", "theta1_standard", "theta2_standard",
             "Phi_standard", "Phi1_standard", "Psi_standard", "m_Z1", "m_ZZ")
    return lhe_level(spark, sf).selectExpr("i", *[r(f"lhe_{n}", n) for n in names])


@query(
    "P15_P16_masks_and_status",
    V + ", z as (select *, i % 7 <> 0 as topo, (i % 7 <> 0 and i % 11 <> 0) as ok from v) select i, topo, ok as projection_valid, "
    "cast(case when not topo then 1 when not ok then 2 else 0 end as bigint) as status, "
    + d("case when topo then mmx end", "mm_px") + ", " + d("case when ok then m4 end", "m_ZZ") + ", "
    + d("case when ok then c1 end", "cos_theta1") + " from z",
)
def masks_and_status(spark, sf):
    ev = events(spark, sf).withColumn("lhe_topology_valid", F.expr("i % 7 <> 0"))
    # an unphysical energy makes the projection fail but keeps the raw momenta
    ev = ev.withColumn("lhe_raw_muon_plus_E", F.expr("if(i % 11 = 0, double('NaN'), lhe_raw_muon_plus_E)"))
    out = levels.derive_level(ev, "lhe")
    return out.selectExpr(
        "i", "lhe_topology_valid as topo", "lhe_projection_valid as projection_valid",
        f"bigint({levels.lhe_status()}) as status", r("lhe_raw_muon_minus_px", "mm_px"),
        r("lhe_m_ZZ", "m_ZZ"), r("lhe_cos_theta1", "cos_theta1"),
    )


@query(
    "P17_wrapping_and_clipping",
    "select event_id, " + ", ".join([
        d(wrap_sql("value"), "wrapped"), d(wrap_sql("0e0-value"), "wrapped_negative"),
        d("acos(least(greatest(value/250e0-1e0, -1e0), 1e0))", "angle"),
        d("case when event_type='error' then -1e0 else 1e0 end * acos(least(value/100e0, 1e0))", "signed_angle"),
        d("asinh(1e2 - value)", "asinh_value"),
    ]) + " from events",
)
def wrapping(spark, sf):
    return bridge.tables(spark, sf, "events").selectExpr(
        "event_id", r(numeric.wrap_pi("value"), "wrapped"), r(numeric.wrap_pi("-value"), "wrapped_negative"),
        r(numeric.acos_clipped("value/250D-1D"), "angle"),
        r(numeric.signed_acos("value/100D", "if(event_type='error', -1D, 1D)"), "signed_angle"),
        r(numeric.asinh("(1e2D - value)"), "asinh_value"),
    )


# -- identity ------------------------------------------------------------------
_PAIR = (
    "select event_id, case when event_id % 13 = 0 then 0e0 else value end as u, "
    "case when event_id % 17 = 0 then (event_id + 1.5e0) * value when event_id % 19 = 0 then -3e0 * value "
    "else (event_id + 1) * value end as n from {t}"
)


@query(
    "P18_decode_source_id",
    f"with p as ({_PAIR.format(t='events')}), q as (select *, n/nullif(u, 0e0) as ratio from p), "
    "f as (select *, case when u = 0e0 then 'zero unit marker' "
    "when greatest(1e-7, abs(ratio)*5e-8) >= 0.25 then 'ratio too large' "
    "when abs(ratio-round_even(ratio,0)) > greatest(1e-7, abs(ratio)*5e-8) then 'not integral' "
    "when round_even(ratio,0) < 1 or round_even(ratio,0) > 1000000 then 'out of range' end as fault from q) "
    "select event_id, case when fault is null then cast(round_even(ratio,0) as bigint) end as source_event_id, fault from f",
)
def decode_ids(spark, sf):
    df = spark.sql(_PAIR.format(t="{t}"), t=bridge.tables(spark, sf, "events"))
    return df.selectExpr(
        "event_id", f"{identity.decode_source_id('n', 'u')} as source_event_id",
        f"{identity.decode_fault('n', 'u')} as fault",
    )


@query("P19_event_uid")
def event_uid(spark, sf):
    """128-bit identities (no SQL twin: the hash is not in the checking engine)."""
    return identity.add_event_uid(events(spark, sf), b"leptide.events.v1\0").select(
        "job_id", "source_event_id", "event_uid_hi", "event_uid_lo"
    )


def _weights_map(spark, sf):
    return events(spark, sf).selectExpr(
        "i", "w", "source_event_id",
        "map('2001', 1.1D*w, '1001', 0.9D*w, 'AUX_OAP_EVENT_ID', double(i+1)*3D, 'AUX_OAP_EVENT_UNIT', 3D) as weights",
    )


@query(
    "P21_T02_alternative_weights",
    EV + " select i, '1001,2001' as ids, cast(2 as bigint) as n, "
    + d("0.9e0*w", "first") + ", " + d("1.1e0*w", "second") + f", {decoded_sql('(i+1)*3e0', '3e0')} as source_id from ev",
)
def alternative_weights(spark, sf):
    ratio = identity.decode_source_id("weights['AUX_OAP_EVENT_ID']", "weights['AUX_OAP_EVENT_UNIT']")
    return _weights_map(spark, sf).selectExpr(
        "i", f"array_join({identity.weight_ids()}, ',') as ids", f"bigint(size({identity.weight_ids()})) as n",
        r(f"get({identity.weight_values()}, 0)", "first"), r(f"get({identity.weight_values()}, 1)", "second"),
        f"{ratio} as source_id",
    )


# -- weights, truth, composition -----------------------------------------------
@query(
    "P26_P31_truth_mask",
    V + " select i, (i % 7 <> 0) as truth_lhe_valid, (i % 7 <> 0) as finite_angles from v",
)
def truth_mask(spark, sf):
    ev = events(spark, sf).withColumn("lhe_topology_valid", F.expr("i % 7 <> 0"))
    out = merge_campaign.truth_columns(levels.derive_level(ev, "lhe").withColumnRenamed("w", "weight_nominal_pb"))
    angles = [f"lhe_{a}" for a in harmonics.ANGLES]
    return out.selectExpr("i", "truth_lhe_valid", f"{harmonics.finite_angles(*angles)} as finite_angles")


_F = {
    "00_20": "sqrt(5e0/8e0)*((3e0*c1*c1-1e0)+(3e0*c2*c2-1e0))",
    "20_20": "1.25e0*(3e0*c1*c1-1e0)*(3e0*c2*c2-1e0)",
    "2m1_2p1": "-15e0*sqrt(2e0)/2e0*s1*c1*s2*c2*cos(p2-p1)",
    "2m2_2p2": "15e0*sqrt(2e0)/8e0*s1*s1*s2*s2*cos(2e0*(p2-p1))",
}
H = G + ", h as (select *, sqrt(1e0-c1*c1) as s1, sqrt(1e0-c2*c2) as s2 from g)"


@query(
    "P27_P35_projectors",
    H + " select i, cast(1 as bigint) as one, " + ", ".join(d(_F[s], f"f_{s}") for s in HARMONIC_SLUGS) + " from h",
)
def projectors(spark, sf):
    f = harmonics.projectors(*[f"lhe_{a}" for a in harmonics.ANGLES])
    return lhe_level(spark, sf).selectExpr("i", "bigint(1) as one", *[r(f[s], f"f_{s}") for s in HARMONIC_SLUGS])


@query(
    "P29_P30_projected_weights",
    H + " select i, " + ", ".join(
        x for s in HARMONIC_SLUGS for x in (
            d(f"({_F[s]})/(4e0*3.141592653589793e0)", f"truth_h_{s}"), d(f"w*({_F[s]})", f"weight_truth_{s}", 4))
    ) + " from h",
)
def projected_weights(spark, sf):
    out = merge_campaign.truth_columns(lhe_level(spark, sf).withColumnRenamed("w", "weight_nominal_pb"))
    return out.selectExpr(
        "i", *[x for s in HARMONIC_SLUGS for x in (r(f"truth_h_{s}", f"truth_h_{s}"), r(f"weight_truth_{s}_pb", f"weight_truth_{s}", 4))]
    )


_COEF = {
    "00_20": ("0e0-sqrt(0.4e0)", "1e0/sqrt(10e0)", "-0.5e0/sqrt(10e0)", "-0.5e0/sqrt(10e0)"),
    "20_20": ("0.2e0", "0.05e0", "-0.1e0", "-0.1e0"),
    "mixed_incoherent": ("0e0", "0e0", "1e0", "1e0"),
}


def coefficient_sql(s: str) -> str:
    return "case channel_code " + " ".join(f"when {i} then {c}" for i, c in enumerate(_COEF[s])) + " end"


@query(
    "P32_component_weights",
    EV + " select i, channel_code, " + ", ".join(d(f"w*({coefficient_sql(s)})", f"w_{s}") for s in COMPONENTS) + " from ev",
)
def component_weights(spark, sf):
    ev = events(spark, sf).withColumn("source_polarization_code", F.col("channel_code"))
    out = compose_channels.component_columns(ev, "w")
    from ..conventions import COMPONENT_WEIGHT_COLUMNS as C

    return out.selectExpr("i", "channel_code", *[r(C[s], f"w_{s}") for s in COMPONENTS])


@query(
    "P34_harmonic_coordinates",
    H + " select i, " + ", ".join([
        d_angle(wrap_sql("p1"), "phi1"), d("c1", "cos_theta1"), d_angle(wrap_sql("p2-p1"), "delta_phi"),
        d_angle(wrap_sql(f"{wrap_sql('p2-p1')} + case when c1*c2 < -1e-12 then 3.141592653589793e0 else 0e0 end"), "folded_delta_phi"),
    ]) + " from h",
)
def harmonic_coordinates(spark, sf):
    c = harmonics.coordinates(*[f"lhe_{a}" for a in harmonics.ANGLES], zero=1e-12)
    return lhe_level(spark, sf).selectExpr(
        "i", r_angle(c["phi1"], "phi1"), r(c["cos_theta1"], "cos_theta1"), *[r_angle(c[n], n) for n in ("delta_phi", "folded_delta_phi")]
    )


@query("P36_multiplicity_marker", V + " select i, i % 4 <> 0 as marker from v")
def multiplicity_marker(spark, sf):
    ev = events(spark, sf).selectExpr(
        "i", "if(i % 4 = 0, array(1), array(1, 2, 3)) as reco_electron", "array(1, 2) as reco_muon"
    )
    return ev.selectExpr("i", f"{selection.multiplicity_marker()} as marker")


# -- selection -------------------------------------------------------------------
_SEL = V + ", s as (select *, " + ", ".join(
    f"sqrt({k}x*{k}x+{k}y*{k}y) as pt_{k}, abs(asinh({k}z/sqrt({k}x*{k}x+{k}y*{k}y))) as ae_{k}, "
    f"asinh({k}z/sqrt({k}x*{k}x+{k}y*{k}y)) as eta_{k}, atan2({k}y,{k}x) as phi_{k}"
    for k in SHORT.values()
) + " from v), s2 as (select *, list_reverse_sort([pt_em, pt_ep, pt_mm, pt_mp]) as pts, " + ", ".join(
    f"sqrt((eta_{SHORT[a]}-eta_{SHORT[b]})*(eta_{SHORT[a]}-eta_{SHORT[b]}) + "
    f"{wrap_sql(f'phi_{SHORT[a]}-phi_{SHORT[b]}')}*{wrap_sql(f'phi_{SHORT[a]}-phi_{SHORT[b]}')}) as dr_{SHORT[a]}_{SHORT[b]}"
    for a, b in LEPTON_PAIRS
) + " from s)"
_DRS = [f"dr_{SHORT[a]}_{SHORT[b]}" for a, b in LEPTON_PAIRS]
_CUT = {
    "all_lepton_pt": " and ".join(f"pt_{k} > 5e0" for k in SHORT.values()),
    "all_lepton_eta": " and ".join(f"ae_{k} < 2.5e0" for k in SHORT.values()),
    "ordered_pt1": "pts[1] > 20e0",
    "ordered_pt2": "pts[2] > 15e0",
    "ordered_pt3": "pts[3] > 10e0",
    "Z1_mass_window": "m1 > 50e0 and m1 < 106e0",
    "Z2_mass_window": "m2 > 50e0 and m2 < 106e0",
    "all_pair_delta_r": " and ".join(f"{x} > 0.1e0" for x in _DRS),
    "m4l_lower": "m4 > 180e0",
}


@query(
    "F02_F04_reco_selection",
    _SEL + " select i, " + ", ".join(f"(reco_present and ({c})) as cut_{n}" for n, c in _CUT.items())
    + ", (reco_present and " + " and ".join(f"({c})" for c in _CUT.values()) + ") as passed, "
    + d("case when reco_present then m4 end", "m4l") + " from s2",
)
def reco_selection(spark, sf):
    ev = events(spark, sf).withColumn("lhe_topology_valid", F.col("reco_present"))
    out = selection.add_selection(ev, "lhe")
    return out.selectExpr(
        "i", *[f"lhe_cut_{n} as cut_{n}" for n in _CUT], "lhe_pass_selection as passed", r("lhe_m4l_for_selection", "m4l")
    )


@query(
    "P33_T01_selection_observables",
    _SEL + " select i, " + ", ".join(
        [d("m4", "m4l"), d("m1", "m_Z1"), d("m2", "m_Z2")]
        + [d(f"pt_{k}", f"pt_{k}") for k in SHORT.values()] + [d(f"ae_{k}", f"abs_eta_{k}") for k in SHORT.values()]
        + [d(f"pts[{j}]", f"ordered_pt{j}") for j in range(1, 5)] + [d(x, x) for x in _DRS]
    ) + " from s2",
)
def selection_observables(spark, sf):
    out = selection.selection_observables(events(spark, sf), "lhe")
    return out.selectExpr(
        "i", r("lhe_m4l_for_selection", "m4l"), r("lhe_m_Z1_for_selection", "m_Z1"), r("lhe_m_Z2_for_selection", "m_Z2"),
        *[r(f"lhe_{k}_pt_for_selection", f"pt_{s}") for k, s in SHORT.items()],
        *[r(f"lhe_{k}_abs_eta_for_selection", f"abs_eta_{s}") for k, s in SHORT.items()],
        *[r(f"lhe_ordered_pt{j}", f"ordered_pt{j}") for j in range(1, 5)],
        *[r(f"lhe_delta_r_{a}_{b}", f"dr_{SHORT[a]}_{SHORT[b]}") for a, b in LEPTON_PAIRS],
    )


@query(
    "F01_phase_space_labels",
    V + " select i, case when m4 < 150e0 then 'below' when m4 > 300e0 then 'above' else 'accepted' end as label from v",
)
def phase_space(spark, sf):
    m, _ = moments.four_lepton_mass_checked("lhe")
    return events(spark, sf).selectExpr("i", f"{m} as m4l").selectExpr(
        "i", f"{moments.phase_space_label('m4l', 150.0, 300.0)} as label"
    )


@query(
    "F05_F06_validity_masks",
    V + " select i, (i % 7 <> 0) as report_valid, (i % 7 <> 0) as closure_valid from v",
)
def validity_masks(spark, sf):
    from ..operators.closure import level_is_valid

    ev = events(spark, sf).withColumn("lhe_topology_valid", F.expr("i % 7 <> 0"))
    out = merge_campaign.truth_columns(levels.derive_level(ev, "lhe").withColumnRenamed("w", "weight_nominal_pb"))
    report = f"lhe_projection_valid and {numeric.is_finite('lhe_phi1')} and not lhe_frame_degenerate"
    return out.selectExpr("i", f"({report}) as report_valid", f"{level_is_valid('lhe')} as closure_valid")


@query("F07_exact_dressed", V + " select 'dressed.exact_2e2mu' as rule, count(*) as n from v where i % 3 = 0")
def exact_dressed(spark, sf):
    from ..operators.audit import exact_dressed as rule

    return rule(_dressed(spark, sf), ["i"]).groupBy("rule").agg(F.count("*").alias("n"))


# -- detector response -------------------------------------------------------------
def _knots(curve, x: str) -> str:
    out = [f"when {x} <= {curve[0][0]}e0 then 0e0"]
    for (p0, e0), (p1, e1) in zip(curve, curve[1:]):
        out.append(f"when {x} <= {p1}e0 then {e0}e0 + ({e1}e0-{e0}e0)*({x}-{p0}e0)/{p1 - p0}e0")
    return "case " + " ".join(out) + f" else {curve[-1][1]}e0 end"


_E_ID = ((4.0, 0.0), (5.0, 0.85), (7.0, 0.90), (10.0, 0.92), (15.0, 0.95), (30.0, 0.96))
_M_ISO = ((4.0, 0.0), (5.0, 0.72), (6.0, 0.80), (8.0, 0.88), (10.0, 0.92), (15.0, 0.96), (20.0, 0.985), (30.0, 0.995))


@query(
    "P37_efficiencies",
    _SEL + " select i, " + d(
        f"({_knots(_E_ID, 'pt_em')}) * case when ae_em <= 0.8e0 then 1.02e0 when ae_em <= 1.37e0 then 1e0 "
        "when ae_em <= 1.52e0 then 0.94e0 when ae_em <= 2e0 then 0.99e0 when ae_em < 2.5e0 then 0.96e0 else 0e0 end",
        "electron_reco_id") + ", " + d(
        f"({_knots(_M_ISO, 'pt_mp')}) * case when ae_mp < 2.5e0 then 1e0 else 0e0 end", "muon_isolation") + " from s2",
)
def efficiencies(spark, sf):
    out = selection.selection_observables(events(spark, sf), "lhe")
    e, m = "lhe_electron_minus", "lhe_muon_plus"
    return out.selectExpr(
        "i",
        r(response.efficiency("electron", "reco_id", f"{e}_pt_for_selection", f"{e}_abs_eta_for_selection"), "electron_reco_id"),
        r(response.efficiency("muon", "isolation", f"{m}_pt_for_selection", f"{m}_abs_eta_for_selection"), "muon_isolation"),
    )


@query(
    "P38_resolutions",
    _SEL + ", t as (select *, greatest(eme/cosh(ae_em), 1e0) as et from s2) select i, " + d(
        "case when ae_em <= 0.8e0 then sqrt(0.0081e0/et + (0.09e0+0.3025e0)/(et*et) + 0.000016e0+0.000049e0) "
        "when ae_em <= 1.37e0 then sqrt(0.0144e0/et + (0.7056e0+0.3025e0)/(et*et) + 0.000016e0+0.000081e0) "
        "when ae_em <= 1.52e0 then sqrt(0.0225e0/et + (1.44e0+0.49e0)/(et*et) + 0.0001e0+0.000625e0) "
        "when ae_em <= 2e0 then sqrt(0.01e0/et + (0.3025e0+0.36e0)/(et*et) + 0.000016e0+0.000225e0) "
        "when ae_em < 2.5e0 then sqrt(0.0064e0/et + (0.25e0+0.36e0)/(et*et) + 0.000016e0+0.000289e0) else 0e0 end",
        "electron_sigma") + ", " + d(
        "case when ae_mp <= 0.5e0 then sqrt(0.0001e0+pt_mp*pt_mp*1e-8) when ae_mp <= 1.5e0 then sqrt(0.000225e0+pt_mp*pt_mp*2.25e-8) "
        "when ae_mp < 2.5e0 then sqrt(0.000625e0+pt_mp*pt_mp*1.225e-7) else 0e0 end", "muon_sigma") + " from t",
)
def resolutions(spark, sf):
    out = selection.selection_observables(events(spark, sf), "lhe")
    e, m = "lhe_electron_minus", "lhe_muon_plus"
    return out.selectExpr(
        "i",
        r(response.relative_resolution("electron", f"{e}_pt_for_selection", f"{e}_abs_eta_for_selection", "lhe_raw_electron_minus_E"), "electron_sigma"),
        r(response.relative_resolution("muon", f"{m}_pt_for_selection", f"{m}_abs_eta_for_selection", "lhe_raw_muon_plus_E"), "muon_sigma"),
    )
