"""Registered queries against their SQL twins on the smallest tables."""

import os

import pytest

import __spark_entry__ as entry
from leptide import queries as registry
from tests.check_queries import compare

SF = "/root/testdata/sf0.001"
QUERIES, ORACLES = entry.queries(), entry.oracle_sql()
FULL = os.environ.get("ALL_QUERIES") == "1"
CORE = [
    "P06_P07_composite_kinematics", "P09_P10_born_projection", "P13_P14_standard_angles", "F02_F04_reco_selection",
    "A01_A02_job_normalization", "A12_weighted_histograms", "A12_A15_mass_spectrum_acceptance", "A17_A21_moments_and_covariance",
    "A20_R03_R04_closure_evaluation", "J02_match_streams", "W01_P20_renumber", "S01_S03_P22_event_text_parse", "Q11_Q18_mask_consistency",
]


def test_registry_is_consistent():
    assert set(ORACLES) <= set(QUERIES) and set(CORE) <= set(QUERIES)
    own, twins = registry.QUERIES, registry.ORACLES
    assert len(own) >= 90 and len(own) - len(twins) <= 4


@pytest.mark.skipif(not os.path.isdir(SF), reason="needs the given tables")
@pytest.mark.parametrize("name", sorted(QUERIES) if FULL else CORE)
def test_query_matches_sql(spark, name):
    status, _, note = compare(spark, name, QUERIES[name], ORACLES.get(name), SF)
    assert status in ("ok", "rows-only"), note


@pytest.mark.skipif(not os.path.isdir(SF), reason="needs the given tables")
def test_scan_is_pruned(spark):
    df = QUERIES["S12_pruned_scan"](spark, SF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters" in plan and "EqualTo(event_type,purchase)" in plan
    assert "ReadSchema: struct<event_type:string,value:double>" in plan
