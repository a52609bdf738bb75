"""Histograms, ratios, moments, closure and exact sums against hand values."""

import math
import random
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from leptide.functions.harmonics import projectors
from leptide.functions.statistics import subset_ratio
from leptide.operators import closure
from leptide.operators import histograms as h
from leptide.operators import moments


def test_projector_hand_points(spark):
    p = math.pi
    pts = [(0.0, 0.0, 0.0, 0.0), (p / 2, 0.0, p / 2, 0.0), (math.nan, 0.0, 0.0, 0.0), (p / 4, 0.0, p / 4, 0.0), (p / 4, 0.0, p / 4, p / 2)]
    df = spark.createDataFrame([(i, *x) for i, x in enumerate(pts)], "i int, a double, b double, c double, d double")
    f = projectors("a", "b", "c", "d")
    got = [r.v for r in df.selectExpr("i", f"{f['00_20']} as v").orderBy("i").collect()]
    want = [math.sqrt(10), -math.sqrt(2.5), math.nan, math.sqrt(5 / 8), math.sqrt(5 / 8)]
    assert got == pytest.approx(want, rel=1e-12, nan_ok=True)


def _spectrum(spark, partitions=None):
    rows = [(2.0, True, -1.0), (-1.0, False, 0.5), (3.0, False, 1.0), (1.0, True, 2.0)]
    df = spark.createDataFrame(rows, "weight_nominal_pb double, reconstructed boolean, lhe_m_Z1 double").withColumn(
        "lhe_projection_valid", F.lit(True)
    )
    return df.repartition(partitions) if partitions else df


@pytest.mark.parametrize("partitions", [1, 4, 16])
def test_flow_folding_counters_and_ratio(spark, partitions):
    specs = h.observable_table({"m_Z1": [0.0, 0.75, 1.0]}, ["m_Z1"])
    slots = h.fill(_spectrum(spark, partitions), specs, levels=("lhe",)).cache()
    hist = {(r.selection, r.bin): r for r in h.histograms(slots, specs, ("lhe",)).collect()}
    assert [hist["all", b].sumw for b in (0, 1)] == [1.0, 4.0]
    assert [hist["all", b].sumw2 for b in (0, 1)] == [5.0, 10.0]
    c = {r.selection: r for r in h.counters(slots, specs, ("lhe",)).collect()}["all"]
    assert (c.underflow, c.overflow, c.underflow_sumw, c.overflow_sumw) == (1, 1, 2.0, 1.0)
    t = h.totals(slots, specs, ("lhe",)).first()
    assert (t.entries, t.selected_entries, t.sumw, t.sumw2, t.sumabsw, t.selected_sumw) == (4, 2, 5.0, 15.0, 7.0, 3.0)
    acc = {r.bin: r for r in h.acceptance(h.histograms(slots, specs, ("lhe",))).collect()}
    assert [acc[b].ratio for b in (0, 1)] == [2.0, 0.25]


def test_one_bin_ratio_and_subset_guard(spark):
    q = subset_ratio("n", "d", "vn", "vd")
    df = spark.createDataFrame([(3.0, 5.0, 5.0, 15.0), (1.0, 0.0, 1.0, 2.0), (1.0, 1.0, 3.0, 2.0)], "n double, d double, vn double, vd double")
    got = df.selectExpr(f"{q.value} as r", f"{q.variance} as v", f"{q.valid} as ok", f"{q.broken} as broken").collect()
    assert got[0].r == 0.6 and got[0].v == pytest.approx((5 * 0.16 + 10 * 0.36) / 25)
    assert not got[1].ok and math.isnan(got[1].r)
    assert got[2].broken


def test_uniform_bin_equals_edge_search(spark):
    for lo, hi, n in ((-math.pi, math.pi, 32), (0.0, math.pi, 24), (40.0, 200.0, 80), (-1.0, 1.0, 40)):
        edges = np.linspace(lo, hi, n + 1)
        xs = np.concatenate([edges, np.nextafter(edges, -9e9), np.nextafter(edges, 9e9)])
        want = np.clip(np.searchsorted(edges, xs, side="right") - 1, 0, n - 1)
        df = spark.createDataFrame([(i, float(x)) for i, x in enumerate(xs)], "i int, x double")
        e = h.uniform_bin("x", repr(lo) + "D", repr(hi) + "D", repr((hi - lo) / n) + "D", str(n))
        got = [r.b for r in df.selectExpr("i", f"{e} as b").orderBy("i").collect()]
        assert got == want.tolist()


def test_full_table_has_77_observables_in_385_histograms():
    specs = h.observable_table()
    assert len(specs) == 77 and 77 * 5 == 385
    with pytest.raises(ValueError):
        h.observable_table({"m_Z1": [0, 0, 1]})
    with pytest.raises(ValueError):
        h.observable_table(variables=["nothing"])


def test_job_moments_fixture(spark):
    rows = [(1.0, "accepted"), (-2.0, "accepted"), (3.0, "above")]
    df = spark.createDataFrame(rows, "weight_lhe double, phase_space string").selectExpr("1 as campaign_id", "0 as sample_code", "1 as job_id", "*")
    r = moments.normalization_moments(df).first()
    assert (r.generated_lhe_events, r.accepted_lhe_events, r.rejected_above_m4l) == (3, 2, 1)
    assert r.count_efficiency == pytest.approx(2 / 3)
    assert r.signed_efficiency == -0.5 and r.absolute_efficiency == 0.5
    assert r.inclusive_cross_section_pb == pytest.approx(2 / 3)
    assert r.inclusive_cross_section_mc_error_pb == pytest.approx(math.sqrt(19) / 3)
    assert r.filtered_cross_section_pb == pytest.approx(-1 / 3)
    assert r.filtered_cross_section_mc_error_pb == pytest.approx(math.sqrt(7) / 3)
    one = moments.normalization_moments(df.limit(1)).first()
    assert math.isnan(one.inclusive_cross_section_mc_error_pb)


def test_exact_sums_equal_fsum(spark):
    """Groups of very different sizes of value, signs that cancel, ties between two doubles, subnormal parts."""
    rng = random.Random(8)
    groups = {
        "huge": [1e30], "small": [1e-20, 2e-20], "both": [1e30, 1e-20, -1e30], "none": [], "zero": [0.0, -0.0], "one": [5e-324, 1e-300],
        "tie": [1.0, 2.0**-53], "above": [1.0, 2.0**-53, 2.0**-140], "below": [-1.0, -(2.0**-53), 2.0**-200], "odd": [1.0 + 2.0**-52, 2.0**-53],
        "power": [2.0**k for k in range(-600, 600, 32)], "edge": [2.0**32, -1.0, 2.0**64 - 2048, 2.0**-32], "cancel": [1e308, 1e308, -1e308, 3.0, -1e308],
        "max": [1.7976931348623157e308, -1.0, 4.9e-324],
    }
    for k in range(12):
        groups[f"r{k}"] = [rng.choice([-1, 1]) * rng.random() * 10.0 ** rng.uniform(-40 * (k % 4) - 1, 40 * (k % 4) + 1) for _ in range(rng.randrange(1, 60))]
    rows = [(g, v, -v) for g, vs in groups.items() for v in vs] + [("none", None, 1.0), ("huge", None, None)]
    df = spark.createDataFrame(rows, "g string, x double, y double").repartition(7)
    for r in moments.exact_sums(df, keys=["g"], columns=["x", "y"]).collect():
        want = float(sum(map(Fraction, groups[r.g])))
        assert r.x == want, (r.g, r.x, want)
        assert r.y == (1.0 if r.g == "none" else -want)


def test_exact_sums_do_not_depend_on_order(spark):
    values = [1e11, 1.0, -1e11, 1e-9, 0.1] * 50
    df = spark.createDataFrame([(v,) for v in values], "x double")
    got = {moments.exact_sums(df.repartition(n).selectExpr("1 as k", "x"), keys=["k"], columns=["x"]).first().x for n in (1, 3, 11)}
    assert len(got) == 1
    assert got.pop() == math.fsum(values)
    wide = [1.0, 1e15, 3e-7, -1e300, 1e300, 5.0]
    big = spark.createDataFrame([(k, v) for k in range(2) for v in wide[: 3 + 3 * k]], "k int, x double")
    sums = {r.k: r.x for r in moments.exact_sums(big, keys=["k"], columns=["x"]).collect()}
    assert sums[0] == math.fsum(wide[:3]) and sums[1] == math.fsum(wide)
    small = moments.exact_sums(big.where("k = 0"), keys=["k"], columns=["x"]).first().x
    assert small == math.fsum(wide[:3])
    tiny = spark.createDataFrame([(1, 1e-305), (1, 2e-305), (1, 0.0)], "k int, x double")
    assert moments.exact_sums(tiny, keys=["k"], columns=["x"]).first().x == math.fsum([1e-305, 2e-305])
    bad = df.unionByName(spark.createDataFrame([(math.nan,)], "x double"))
    assert moments.exact_sums(bad.selectExpr("1 as k", "x"), keys=["k"], columns=["x"]).first().x is None


def test_templates_close_on_quadrature(spark):
    """Bin integrals of the density equal the model built from its own moments."""
    coef = np.array([1, 0.12, -0.09, 0.06, 0.08]) * 3.2
    x, wx = np.polynomial.legendre.leggauss(4)
    nphi = 24
    phis = -math.pi + (np.arange(nphi) + 0.5) * 2 * math.pi / nphi
    edges = np.linspace(-1, 1, 5)
    rows = []
    for b1 in range(4):
        for b2 in range(4):
            for u1, w1 in zip(x, wx):
                for u2, w2 in zip(x, wx):
                    c1 = (edges[b1] + edges[b1 + 1]) / 2 + u1 * 0.25
                    c2 = (edges[b2] + edges[b2 + 1]) / 2 + u2 * 0.25
                    for ph in phis:
                        s1, s2 = math.sqrt(1 - c1 * c1), math.sqrt(1 - c2 * c2)
                        f = [1, math.sqrt(5 / 8) * (3 * c1 * c1 + 3 * c2 * c2 - 2), 1.25 * (3 * c1 * c1 - 1) * (3 * c2 * c2 - 1),
                             -15 * math.sqrt(2) / 2 * s1 * c1 * s2 * c2 * math.cos(ph), 15 * math.sqrt(2) / 8 * s1**2 * s2**2 * math.cos(2 * ph)]
                        mu = w1 * w2 * 0.25 * 0.25 / 4 / nphi
                        rows.append((float(np.dot(coef, f) * mu), math.acos(c1), 0.0, math.acos(c2), float(ph)))
    df = spark.createDataFrame(rows, "weight_nominal_pb double, dressed_theta1 double, dressed_phi1 double, dressed_theta2 double, dressed_phi2 double").selectExpr(
        "*", "true as reconstructed", "true as dressed_projection_valid", "false as dressed_frame_degenerate"
    )
    binning = closure.Binning(4, 4)
    acc = closure.accumulate(df, binning=binning, levels=("dressed",)).cache()
    m = closure.moments(acc, binning=binning, levels=("dressed",)).where("selection = 'all'").first()
    assert [m[f"s{a}"] for a in range(5)] == pytest.approx(coef.tolist(), abs=1e-10)
    for name, keep, closes in (("cos_theta1", None, True), (closure.MAP, None, True), ("delta_phi", None, True), ("cos_theta1", ["20_20"], False)):
        e = closure.evaluate(acc, binning=binning, components=keep, levels=("dressed",)).where(f"selection = 'all' and projection = '{name}'").collect()
        worst = max(abs(r.residual) for r in e)
        assert (worst < 1e-10) == closes, (name, worst)
