"""Projection, angles, masks and selection on hand-made events."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from leptide.conventions import LEPTONS, MOMENTUM, momentum_columns
from leptide.operators.levels import derive_level, lhe_status
from leptide.operators.selection import CUTS, Thresholds, add_selection


def boost(p, b):
    b = np.asarray(b, float)
    b2 = b @ b
    if b2 == 0:
        return p
    g = 1 / math.sqrt(1 - b2)
    bp = b @ p[:3]
    out = p.copy()
    out[:3] = p[:3] + ((g - 1) / b2 * bp + g * p[3]) * b
    out[3] = g * (p[3] + bp)
    return out


def decay(parent, m1, m2, cos1, phi1, cos2, phi2, recoil):
    """Two-body cascade with given positive-lepton angles, then a recoil boost."""
    q = math.sqrt((parent**2 - (m1 + m2) ** 2) * (parent**2 - (m1 - m2) ** 2)) / (2 * parent)
    axis = np.array([math.sin(1.1), 0, math.cos(1.1)])
    out = {}
    for sign, m, c, f, names in ((1, m1, cos1, phi1, ("muon_plus", "muon_minus")), (-1, m2, cos2, phi2, ("electron_plus", "electron_minus"))):
        z = sign * axis
        y = np.cross([0, 0, 1], z)
        y /= np.linalg.norm(y)
        x = np.cross(y, z)
        s = math.sqrt(1 - c * c)
        d = s * math.cos(f) * x + s * math.sin(f) * y + c * z
        e = math.sqrt(q * q + m * m)
        for name, k in zip(names, (1, -1)):
            p = np.append(k * m / 2 * d, m / 2)
            out[name] = boost(boost(p, q / e * z), recoil)
    return out


def frame(spark, rows):
    data = []
    for i, leptons in enumerate(rows):
        ok = leptons is not None
        values = [float(leptons[k][j]) if ok else math.nan for k in LEPTONS for j in range(4)]
        data.append((i, ok, *values))
    cols = ", ".join(f"{c} double" for c in momentum_columns("lhe", "raw"))
    return spark.createDataFrame(data, f"i int, lhe_topology_valid boolean, {cols}")


EVENT = decay(350, 90, 60, 0.25, 0.8, -0.4, -1.2, (0, 0, 0.35))


def test_known_decay_angles(spark):
    row = derive_level(frame(spark, [EVENT]), "lhe").first()
    assert row.lhe_projection_valid and not row.lhe_frame_degenerate
    assert row.lhe_m_Z1 == pytest.approx(90, rel=1e-12)
    assert row.lhe_m_Z2 == pytest.approx(60, rel=1e-12)
    assert row.lhe_cos_theta1 == pytest.approx(0.25, abs=1e-12)
    assert row.lhe_cos_theta2 == pytest.approx(-0.4, abs=1e-12)
    assert row.lhe_phi1 == pytest.approx(0.8, abs=1e-12)
    assert row.lhe_phi2 == pytest.approx(-1.2, abs=1e-12)
    assert row.lhe_cos_theta_star == pytest.approx(math.cos(1.1), abs=1e-12)


def test_projection_removes_recoil_and_keeps_mass_and_rapidity(spark):
    ev = decay(350, 90, 60, 0.25, 0.8, -0.4, -1.2, (0.12, -0.08, 0.35))
    row = derive_level(frame(spark, [ev]), "lhe").first()
    assert row.lhe_raw_pt4l > 10
    assert row.lhe_born_pt4l < 1e-10
    assert row.lhe_born_m4l == pytest.approx(row.lhe_raw_m4l, rel=1e-12)
    assert row.lhe_born_y4l == pytest.approx(row.lhe_raw_y4l, rel=1e-12)
    for c in MOMENTUM:
        assert math.isfinite(row[f"lhe_born_muon_plus_{c}"])
    assert row.lhe_raw_muon_plus_px == ev["muon_plus"][0]
    # azimuth sum and reversed polar angles tie the two conventions together
    wrap = (row.lhe_phi1 + row.lhe_phi2 - row.lhe_Phi_standard + math.pi) % (2 * math.pi) - math.pi
    assert abs(wrap) < 1e-9
    assert math.cos(row.lhe_theta1_standard) == pytest.approx(-row.lhe_cos_theta1, abs=1e-12)


def test_rows_are_kept_with_masks(spark):
    spacelike = {k: v.copy() for k, v in EVENT.items()}
    for k in spacelike:
        spacelike[k][3] = 0.01
    along = decay(350, 90, 60, 0.25, 0.8, -0.4, -1.2, (0, 0, 0))
    out = derive_level(frame(spark, [EVENT, None, spacelike, along]), "lhe").withColumn("status", F.expr(lhe_status()))
    rows = {r.i: r for r in out.collect()}
    assert [rows[i].status for i in range(4)] == [0, 1, 2, 0]
    assert math.isnan(rows[1].lhe_m_Z1) and math.isnan(rows[1].lhe_raw_muon_plus_px)
    assert math.isnan(rows[2].lhe_m_Z1) and rows[2].lhe_raw_muon_plus_E == 0.01
    assert rows[2].lhe_topology_valid and not rows[2].lhe_projection_valid


def test_beam_along_z_is_degenerate_but_finite(spark):
    rot = {}
    for k, p in decay(350, 90, 60, 0.25, 0.8, -0.4, -1.2, (0, 0, 0)).items():
        c, s = math.cos(-1.1), math.sin(-1.1)
        rot[k] = np.array([c * p[0] + s * p[2], p[1], -s * p[0] + c * p[2], p[3]])
    beam = tuple(rot["muon_minus"][:3] + rot["muon_plus"][:3])
    row = derive_level(frame(spark, [rot]), "lhe", beam_direction=beam).first()
    assert row.lhe_projection_valid and row.lhe_frame_degenerate and row.lhe_standard_angles_degenerate
    assert math.isfinite(row.lhe_phi1) and math.isnan(row.lhe_Phi1_standard)
    assert row.lhe_cos_theta1 == pytest.approx(0.25, abs=1e-9)


def test_filter_on_derived_column_plans_quickly(spark):
    df = derive_level(frame(spark, [EVENT]), "lhe").where("lhe_m_Z1 > 80 and lhe_cos_theta1 < 1")
    assert df.count() == 1


def test_selection_is_strict_and_keeps_rows(spark):
    ev = decay(250, 80, 80, 0.2, 1.0, -0.3, -2.0, (0, 0, 0))
    out = add_selection(frame(spark, [ev, None]), "lhe").collect()
    good, absent = sorted(out, key=lambda r: r.i)
    assert good.lhe_pass_selection and all(good[f"lhe_cut_{c}"] for c in CUTS)
    assert not absent.lhe_pass_selection and math.isnan(absent.lhe_ordered_pt1)
    pts = [good[f"lhe_ordered_pt{i}"] for i in range(1, 5)]
    assert pts == sorted(pts, reverse=True)
    # each threshold set exactly at the event's own value must fail
    edge = {
        "m4l_lower": Thresholds(min_m4l=good.lhe_m4l_for_selection),
        "Z1_mass_window": Thresholds(min_dilepton_mass=good.lhe_m_Z1_for_selection),
        "ordered_pt1": Thresholds(ordered_pt=(pts[0], 15.0, 10.0)),
        "all_lepton_pt": Thresholds(min_lepton_pt=pts[3]),
    }
    for cut, cfg in edge.items():
        row = add_selection(frame(spark, [ev]), "lhe", cfg).first()
        assert not row[f"lhe_cut_{cut}"], cut


def test_thresholds_are_validated():
    for bad in (dict(min_m4l=-1.0), dict(min_dilepton_mass=120.0), dict(max_m4l=10.0), dict(ordered_pt=(1.0, 2.0, 3.0))):
        with pytest.raises(ValueError):
            Thresholds(**bad)


def test_filters_reach_the_scan_through_all_levels(spark, tmp_path):
    """A filter on a partition column and on another input column prunes the files; one on a derived value stays above."""
    import time

    from leptide import bridge

    raw = bridge.with_levels(bridge.event_view(spark, "/root/testdata/sf0.001"))
    raw.write.partitionBy("job_id").parquet(str(tmp_path / "events"))
    df = spark.read.parquet(str(tmp_path / "events"))
    for level in ("lhe", "dressed", "reco"):
        df = derive_level(df, level)
    df = add_selection(df, "reco").where("job_id = 3 and w > 0D and lhe_m_ZZ > 100D").select("i", "lhe_m_ZZ", "reco_pass_selection")
    began = time.time()
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert time.time() - began < 30
    assert "= 3)" in plan.split("PartitionFilters: [")[1].split("]")[0] and "GreaterThan(w,0.0)" in plan
    assert df.count() == raw.where("job_id = 3 and w > 0D").join(df.select("i"), "i", "left_semi").count() > 0
