"""Merge, composition, job building and publishing end to end."""

import math

import pytest
from pyspark.sql import functions as F

from leptide.conventions import COMPONENTS, LEVELS
from leptide.operators import audit, moments
from leptide.plans import compose_channels, merge_campaign
from leptide.plans.build_events import build_events
from leptide.session import scratch_path
from leptide.sinks.publish import publish
from leptide.sinks.tables import composed_event_schema, event_schema, merged_event_schema
from leptide.sources.listing import content_fingerprints

P = math.pi
EVENTS = [
    (11, 101, 2.0, 0.0, 0.0, 0.0, 0.0), (11, 102, -0.5, P / 2, 0.0, P / 2, 0.0), (11, 103, 0.0, math.nan, 0.0, 0.0, 0.0),
    (12, 201, 1.25, P / 4, 0.0, P / 4, 0.0), (12, 202, -0.25, P / 4, 0.0, P / 4, P / 2),
]
NORM = {11: (6, 5, 4.0, 8.0, 7.0, 3.0, 6.0, 5.0), 12: (4, 3, 2.0, 3.0, 3.0, 1.0, 2.0, 2.0)}


def campaign(spark):
    ev = spark.createDataFrame(EVENTS, "job_id bigint, source_event_id bigint, weight_lhe double, t1 double, p1 double, t2 double, p2 double")
    cols = ["bigint(7) as campaign_id", "bigint(0) as sample_code", "job_id", "source_event_id", "weight_lhe",
            "source_event_id % 100 - 1 as lhe_event_index", "source_event_id as hepmc_event_number"]
    for level in LEVELS:
        ok = "not isnan(t1)"
        cols += [f"{ok} as {level}_candidate", f"{ok} as {level}_projection_valid",
                 f"t1 as {level}_theta1", f"p1 as {level}_phi1", f"t2 as {level}_theta2", f"p2 as {level}_phi2"]
    ev = ev.selectExpr(*cols, "true as reconstructed", "true as reco_pass_selection", "false as lhe_frame_degenerate")
    norm = spark.createDataFrame(
        [(7, 0, j, *v) for j, v in NORM.items()],
        "campaign_id bigint, sample_code bigint, job_id bigint, generated_lhe_events bigint, accepted_lhe_events bigint, sumw_generated double, "
        "sumw2_generated double, sumabsw_generated double, sumw_accepted double, sumw2_accepted double, sumabsw_accepted double",
    )
    norm = moments.derived_normalization(norm)
    names = {**merge_campaign.NORMALIZATION, **merge_campaign.EFFECTIVE}
    runs = moments.run_summary(ev).join(
        norm.selectExpr("campaign_id", "sample_code", "job_id", *[f"{v} as {k}" for k, v in names.items()]),
        ["campaign_id", "sample_code", "job_id"],
    ).withColumns({"generation_seed": F.col("job_id") + 1, "delphes_seed": F.col("job_id") + 100})
    return ev, runs


def test_merge_reference_values(spark):
    ev, runs = campaign(spark)
    out = merge_campaign.merge_campaign(ev, runs)
    s = out.summary.first()
    assert s.effective_filtered_cross_section_pb == pytest.approx(0.4)
    assert s.inclusive_lhe_cross_section_pb == pytest.approx(0.6)
    assert s.effective_filtered_cross_section_mc_error_pb == pytest.approx(math.sqrt((8 - 1.6) / 90))
    assert s.retained_raw_sumw_pb == 2.5 and s.merged_weight_scale == pytest.approx(0.16)
    assert (s.positive_weight_count, s.negative_weight_count, s.zero_weight_count, s.truth_lhe_valid_count) == (2, 2, 1, 4)
    rows = {r.source_event_id: r for r in out.events.collect()}
    assert sum(r.weight for r in rows.values()) == pytest.approx(124800)
    want = {101: math.sqrt(10), 102: -math.sqrt(2.5), 103: math.nan, 201: math.sqrt(5 / 8), 202: math.sqrt(5 / 8)}
    for k, v in want.items():
        assert rows[k].truth_factor_00_20 == pytest.approx(v, nan_ok=True)
        assert rows[k].truth_h_00_20 == pytest.approx(v / (4 * P), nan_ok=True)
    assert out.findings.count() == 0


def test_merge_rejections(spark):
    ev, runs = campaign(spark)
    cases = {
        "seed": runs.withColumn("generation_seed", F.lit(5)),
        "job.unique": runs.withColumn("job_id", F.lit(11)),
        "sample.single": runs.withColumn("sample_code", F.col("job_id") - 11),
        "runs.sumw": runs.withColumn("sumw", F.col("sumw") + 1),
        "contract.filtered": runs.withColumn("effective_filtered_cross_section_pb", F.lit(9.0)),
    }
    for needle, bad in cases.items():
        with pytest.raises(audit.AuditError) as e:
            merge_campaign.merge_campaign(ev, bad)
        rules = {r.rule for r in merge_campaign.job_findings(moments.run_summary(ev), bad).collect()}
        assert any(needle in r for r in rules), (needle, rules, e)
    flat = spark.createDataFrame([(1e-20, 1.0, 0.4)], "retained_raw_sumw_pb double, retained_raw_sumabsw_pb double, filtered_cross_section_pb double")
    assert {r.rule for r in audit.signed_sum_rules(flat).collect()} == {"sum.resolved"}


def test_publish_merge_verifies_and_refuses_overwrite(spark):
    ev, runs = campaign(spark)
    target = scratch_path(spark, "campaign")
    out = merge_campaign.merge_campaign(ev, runs)
    merge_campaign.publish_merge(spark, out, target)
    assert spark.read.parquet(f"{target}/Events").count() == 5
    with pytest.raises(FileExistsError):
        merge_campaign.publish_merge(spark, out, target)
    # an input that changes between reading and publishing stops it
    inputs = scratch_path(spark, "inputs")
    spark.range(3).write.parquet(inputs)
    before = spark.createDataFrame(content_fingerprints(spark, inputs).collect(), "path string, length long, content_sha256 string")
    spark.range(1).write.mode("append").parquet(inputs)
    with pytest.raises(audit.AuditError, match="input.unchanged"):
        merge_campaign.publish_merge(spark, out, scratch_path(spark, "campaign"), inputs_before=before, inputs=inputs)
    bad = out._replace(events=out.events.withColumn("weight", F.col("weight") * 2))
    other = scratch_path(spark, "campaign")
    with pytest.raises(audit.AuditError):
        merge_campaign.publish_merge(spark, bad, other)
    with pytest.raises(Exception):
        spark.read.parquet(f"{other}/Events")


def test_publish_keeps_existing_target_on_failure(spark):
    target = scratch_path(spark, "t")
    df = spark.range(3)
    publish(spark, {"a": df}, target)
    fail = lambda t: audit.row_count(t["a"], 99)
    with pytest.raises(audit.AuditError):
        publish(spark, {"a": spark.range(5)}, target, fail, overwrite=True)
    assert spark.read.parquet(f"{target}/a").count() == 3
    publish(spark, {"a": spark.range(5)}, target, overwrite=True)
    assert spark.read.parquet(f"{target}/a").count() == 5


def test_composition_integrals(spark):
    xs = {"LL": 10.0, "TT": 20.0, "TL": 30.0, "LT": 40.0}
    samples, summaries = {}, {}
    for k, (name, x) in enumerate(xs.items()):
        w = [2.0, -1.0, 2.0, -1.0]
        rows = [(k, i, v * x / sum(w)) for i, v in enumerate(w)]
        samples[name] = spark.createDataFrame(rows, "job_id int, source_event_id int, weight_nominal_pb double")
        summaries[name] = spark.createDataFrame([(1, 10 + k, 4, 2, x, 0.1)], "campaign_id int, sample_code int, event_count int, source_job_count int, effective_filtered_cross_section_pb double, effective_filtered_cross_section_mc_error_pb double")
    out = compose_channels.compose_channels(samples, summaries)
    s = out.summary.first()
    assert s.expected_integral_20_20_pb == pytest.approx(-4.0)
    assert s.sumw_mixed_incoherent_pb == pytest.approx(70.0)
    assert s.event_count == 16 and out.findings.count() == 0
    written = {"Events": out.events, "PolarizationSources": out.sources, "PolarizationCombinationSummary": out.summary}
    assert compose_channels.verify_composed(written).count() == 0
    with pytest.raises(ValueError):
        compose_channels.union_channels({"LL": samples["LL"]})
    assert len(COMPONENTS) == 3


def test_schemas_have_the_expected_width():
    assert len(event_schema()) == 255
    assert len(merged_event_schema()) == 271
    assert len(composed_event_schema()) == 278


LEPTONS = ((11, 70, -60, 0, math.sqrt(1300)), (-11, 50, -30, 10, -math.sqrt(1500)), (13, 80, 70, 0, math.sqrt(1500)), (-13, 50, 22, 0, -math.sqrt(2016)))


def _job(spark, ids=(2, 7), numbers=(1, 3), names=("1001", "2001")):
    part = "array<struct<pdg:int,status:int,px:double,py:double,pz:double,e:double>>"
    lhe = spark.createDataFrame(
        [(1, i, w, [(p, 1, float(x), float(y), z, float(e)) for p, e, x, y, z in LEPTONS],
          {names[0]: 0.9 * w, names[1]: 1.1 * w, "AUX_OAP_EVENT_ID": float(i), "AUX_OAP_EVENT_UNIT": 1.0}) for i, w in zip((2, 7), (-2.5, 1.5))],
        f"job_id bigint, source_event_id bigint, weight double, particles {part}, weights map<string,double>",
    )
    d = "array<struct<pid:int,e:double,px:double,py:double,pz:double>>"
    r = "array<struct<pt:double,eta:double,phi:double,charge:int>>"
    dressed = [(p, float(e), float(x), float(y), z) for p, e, x, y, z in LEPTONS]
    reco = [(math.hypot(x, y), math.asinh(z / math.hypot(x, y)), math.atan2(y, x), -1 if p > 0 else 1) for p, e, x, y, z in LEPTONS]
    det = spark.createDataFrame(
        [(1, i, n, 1.0, 0.4, 0.01, dressed[:2], dressed[2:], reco[:2] if k == 0 else [], reco[2:] if k == 0 else []) for k, (i, n) in enumerate(zip(ids, numbers))],
        f"job_id bigint, source_event_id bigint, event_number bigint, event_weight double, cross_section_pb double, cross_section_error_pb double, "
        f"dressed_electron {d}, dressed_muon {d}, reco_electron {r}, reco_muon {r}",
    )
    jobs = spark.createDataFrame([(1, 9, 0, 41)], "job_id bigint, campaign_id bigint, sample_code int, first_event bigint")
    return lhe, det, jobs


def test_build_events_end_to_end(spark):
    out = build_events(*_job(spark), uid_tag=b"t\0")
    assert out.events.schema.simpleString() == event_schema().simpleString()
    rows = {r.source_event_id: r for r in out.events.collect()}
    assert sorted(rows) == [2, 7] and rows[2].weight_lhe == -2.5
    assert [rows[i].hepmc_event_number for i in (2, 7)] == [41, 42]
    assert rows[2].lhe_projection_valid and rows[2].dressed_projection_valid and rows[2].reco_candidate
    assert not rows[7].reco_candidate and rows[7].reco_n_muons == 0 and math.isnan(rows[7].reco_m_Z1)
    assert rows[2].lhe_m_Z1 == pytest.approx(rows[2].dressed_m_Z1)
    w = {r.source_event_id: r for r in out.weights.collect()}
    assert w[2]["values"] == pytest.approx([0.9 * -2.5, 1.1 * -2.5])
    assert out.weight_ids.first().ids == ["1001", "2001"]
    assert audit.uid_rules(out.events, b"t\0").count() == 0


def test_build_events_finds_a_shifted_stream(spark):
    """IDs intact, positions not."""
    lhe, det, jobs = _job(spark)
    lhe = lhe.withColumn("ordinal", F.expr("dense_rank() over (partition by job_id order by source_event_id)"))
    good = det.withColumn("ordinal", F.expr("dense_rank() over (partition by job_id order by source_event_id)"))
    assert build_events(lhe, good, jobs, uid_tag=b"t\0").events.count() == 2
    bad = good.withColumn("ordinal", F.col("ordinal") + F.expr("if(source_event_id > 2, 1, 0)"))
    found = build_events(lhe, bad, jobs, uid_tag=b"t\0", check=False).findings.collect()
    assert [(r.rule, r.subject) for r in found] == [("match.ordinal", "1/7")]


def test_build_events_rejects_bad_streams(spark):
    for kw, needle in ((dict(ids=(2, 8)), "match.unmatched"), (dict(numbers=(3, 3)), "detector.number"), (dict(ids=(2, 2)), "detector.unique")):
        with pytest.raises(audit.AuditError, match="match|detector"):
            build_events(*_job(spark, **kw), uid_tag=b"t\0")
        rules = {r.rule for r in build_events(*_job(spark, **kw), uid_tag=b"t\0", check=False).findings.collect()}
        assert needle in rules


def test_documents_as_paths(spark):
    from leptide.operators import job_documents

    docs = [
        (1, '{"a": 1, "b": {"c": "x", "d": null, "e": [1.5, {"f": true}]}, "g": {}}'), (2, "[1]"), (3, "no json"), (4, None), (5, '{"a": 1e400, "a b": "é"}'),
    ]
    df = spark.createDataFrame(docs, "job_id long, document string")
    leaves, found = job_documents.typed_paths(df, keys=["job_id"])
    got = {(r.job_id, r.path): (r.kind.split("(")[0], r.text) for r in leaves.where("job_id = 1").collect()}
    assert got == {
        (1, "a"): ("BIGINT", "1"), (1, "b.c"): ("STRING", "x"), (1, "b.d"): ("VOID", None), (1, "b.e[0]"): ("DECIMAL", "1.5"), (1, "b.e[1].f"): ("BOOLEAN", "true"),
    }
    assert ("a b", "é") in {(r.path, r.text) for r in leaves.where("job_id = 5").collect()}
    assert {(r.rule, r.subject) for r in found.collect()} >= {("document.object", "2"), ("document.object", "3"), ("document.object", "4")}
    _, deep = job_documents.typed_paths(df.where("job_id = 1"), keys=["job_id"], depth=2)
    assert [(r.rule, r.subject) for r in deep.collect()] == [("document.depth", "1/b.e")]


def test_rules_against_documents(spark):
    from leptide.operators.job_documents import Rule, against_rules, typed_paths

    runs = spark.createDataFrame([(1, 5, 2.0, float("nan")), (2, 6, 3.0, 1.0), (3, 7, 4.0, float("nan"))], "job_id long, n long, x double, e double")
    docs = spark.createDataFrame(
        [(1, '{"p": {"n": 5, "x": 2.00000000000001, "e": null}, "u": "pb"}'), (2, '{"p": {"n": "6", "x": 3.1, "e": 1}, "u": "fb"}'), (3, '{"p": {"n": 7.5, "x": "nan", "e": 0}}')],
        "job_id long, document string",
    )
    rules = [Rule("p.n", "n"), Rule("p.x", "x", "close"), Rule("p.e", "e", "close or none"), Rule("u", kind="text", fixed="pb")]
    found = against_rules(runs, typed_paths(docs, keys=["job_id"])[0], rules, keys=["job_id"])
    assert {(r.rule, r.subject) for r in found.collect()} == {
        ("document.p.x", "2"), ("document.u", "2"), ("document.p.n", "3"), ("document.p.x", "3"), ("document.p.e", "3"), ("document.u", "3"),
    }


def test_digest_of_a_schema(spark):
    from leptide.sinks import tables

    assert len(tables.event_schema()) == 255 and len(tables.run_schema()) == 53
    a, b = (spark.createDataFrame([], s).schema for s in ("a long, b string", "b string, a long"))
    assert tables.schema_digest(a) != tables.schema_digest(b) and tables.schema_digest(a) == tables.schema_digest(spark.range(1).selectExpr("id as a", "'x' as b").schema)


def test_broken_rules_are_counted_in_the_summary_pass(spark):

    checks = {"a": ("x > 0", "x", "'positive'"), "b": ("y", "y", "true")}
    df = spark.createDataFrame([(1, 1.0, True), (1, None, False), (2, -1.0, True), (3, 2.0, None)], "j int, x double, y boolean")
    got = {r.j: r.n for r in df.groupBy("j").agg(F.expr(f"sum({audit.broken(checks)}) as n")).collect()}
    assert got == {1: 2, 2: 1, 3: 1} and audit.rules(df, ["j"], checks).count() == sum(got.values())
