"""Moments, pooling, merging and composition."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import bridge
from ..conventions import COMPONENTS, COMPONENT_WEIGHT_COLUMNS, COUNT_FIELDS, LEVELS, NOMINAL_UNITS, NORMALIZATION_CONTRACT, WEIGHTING_STRATEGY
from ..functions import identity
from ..functions.statistics import mean_error
from ..operators import moments, ordering
from ..operators.job_documents import PLAIN_BACKEND, RELEASED_BACKEND
from ..plans import compose_channels, merge_campaign
from . import d, d_settled, events, query, r, r_settled, view_sql
from .derivations import coefficient_sql

EV = f"with ev as ({bridge.event_view_sql('events')})"
V = f"with {view_sql()}"
LOW, HIGH = 150.0, 300.0

LAB = V + (
    ", lab as (select *, case when m4 < 150e0 then 'below' when m4 > 300e0 then 'above' else 'accepted' end as label from v)"
)
_MOM = (
    "count(*) as n, count(*) filter (where label='accepted') as acc, count(*) filter (where label='below') as below, "
    "count(*) filter (where label='above') as above, sum(w) as s, sum(w*w) as q, sum(abs(w)) as a, "
    "coalesce(sum(w) filter (where label='accepted'),0e0) as sa, coalesce(sum(w*w) filter (where label='accepted'),0e0) as qa, "
    "coalesce(sum(abs(w)) filter (where label='accepted'),0e0) as aa"
)
JOBS = LAB + f", job as (select job_id, {_MOM} from lab group by job_id)"
POOL = JOBS + (
    ", pool as (select sum(n)::bigint as n, sum(acc)::bigint as acc, sum(s) as s, sum(q) as q, sum(a) as a, "
    "sum(sa) as sa, sum(qa) as qa, sum(aa) as aa from job)"
)


def err(s: str, q: str) -> str:
    return f"case when n >= 2 then sqrt(greatest({q}-{s}*{s}/n,0e0)/(n*1e0*(n-1))) end"


def labelled(spark, sf):
    m, _ = moments.four_lepton_mass_checked("lhe")
    return (
        events(spark, sf)
        .selectExpr("*", f"{m} as m4l")
        .selectExpr("*", f"{moments.phase_space_label('m4l', LOW, HIGH)} as phase_space", "w as weight_lhe")
    )


def job_moments(spark, sf):
    return moments.normalization_moments(labelled(spark, sf))


_DERIVED = [
    d("acc*1e0/n", "count_efficiency"), d("sa/nullif(s,0e0)", "signed_efficiency"), d("aa/nullif(a,0e0)", "absolute_efficiency"),
    d("s/n", "inclusive"), d(err("s", "q"), "inclusive_error"), d("sa/n", "filtered"), d(err("sa", "qa"), "filtered_error"),
]
_RENAMED = [
    r("count_efficiency", "count_efficiency"), r("signed_efficiency", "signed_efficiency"),
    r("absolute_efficiency", "absolute_efficiency"), r("inclusive_cross_section_pb", "inclusive"),
    r("inclusive_cross_section_mc_error_pb", "inclusive_error"), r("filtered_cross_section_pb", "filtered"),
    r("filtered_cross_section_mc_error_pb", "filtered_error"),
]


@query(
    "A01_A02_job_normalization",
    JOBS + " select job_id, n as generated, acc as accepted, below, above, "
    + ", ".join([d("s", "sumw", 4), d("q", "sumw2", 4), d("aa", "sumabsw_accepted", 4), *_DERIVED]) + " from job",
)
def job_normalization(spark, sf):
    return job_moments(spark, sf).selectExpr(
        "job_id", "generated_lhe_events as generated", "accepted_lhe_events as accepted",
        "rejected_below_m4l as below", "rejected_above_m4l as above", r("sumw_generated", "sumw", 4),
        r("sumw2_generated", "sumw2", 4), r("sumabsw_accepted", "sumabsw_accepted", 4), *_RENAMED,
    )


@query("A05_pooled_normalization", POOL + " select n as generated, acc as accepted, " + ", ".join(_DERIVED) + " from pool")
def pooled(spark, sf):
    return moments.pool(job_moments(spark, sf)).selectExpr(
        "generated_lhe_events as generated", "accepted_lhe_events as accepted", *_RENAMED
    )


def merged_totals(spark, sf):
    """Pooled scale of the bridge campaign: accepted events are the retained ones."""
    kept = labelled(spark, sf).where("phase_space = 'accepted'")
    jobs = moments.weight_totals(kept, keys=["campaign_id", "sample_code", "job_id"])
    sums = jobs.groupBy("campaign_id", "sample_code").agg(
        F.sum("sumw").alias("retained_raw_sumw_pb"), F.sum("sumabsw").alias("retained_raw_sumabsw_pb")
    )
    pooled_rows = moments.pool(job_moments(spark, sf))
    return pooled_rows.join(sums, ["campaign_id", "sample_code"]).withColumn(
        "merged_weight_scale", F.expr("try_divide(filtered_cross_section_pb, retained_raw_sumw_pb)")
    )


@query(
    "A06_common_scale",
    POOL + " select " + d("sa/n/sa", "scale", 10) + ", " + d("sa", "retained", 4) + " from pool",
)
def common_scale(spark, sf):
    return merged_totals(spark, sf).selectExpr(r("merged_weight_scale", "scale", 10), r("retained_raw_sumw_pb", "retained", 4))


@query(
    "J07_P24_P25_nominal_weights",
    POOL + " select i, " + d_settled("w*(pool.sa/pool.n/pool.sa)", "weight_nominal_pb", 8) + ", " + d_settled("w*(pool.sa/pool.n/pool.sa)*312000e0", "weight", 4)
    + " from lab, pool where label='accepted'",
)
def nominal_weights(spark, sf):
    kept = labelled(spark, sf).where("phase_space = 'accepted'")
    scale = merged_totals(spark, sf).select("merged_weight_scale").scalar()
    return kept.withColumn("n", F.col("weight_lhe") * scale).selectExpr(
        "i", r_settled("n", "weight_nominal_pb", 8), r_settled("n * 312000D", "weight", 4)
    )


@query(
    "A03_W05_run_summary",
    EV + ", u as (select *, w*0.5e0+1e0 as xs from ev) select job_id, count(*) as event_count, "
    "min(source_event_id) as id_min, max(source_event_id) as id_max, "
    "count(*) filter (where w>0) as positive, count(*) filter (where w<0) as negative, count(*) filter (where w=0) as zero, "
    + ", ".join([d("sum(w)", "sumw", 4), d("sum(w*w)", "sumw2", 4), d("sum(abs(w))", "sumabsw", 4),
                 d("arg_min(xs, i)", "xs_first"), d("min(xs)", "xs_min"), d("max(xs)", "xs_max"), d("arg_max(xs, i)", "xs_final")])
    + ", count(*) filter (where i % 7 <> 0) as candidates from u group by job_id",
)
def run_summary(spark, sf):
    ev = events(spark, sf).selectExpr(
        "*", "w as weight_lhe", "i as lhe_event_index", "i as hepmc_event_number", "w*0.5D+1D as cross_section_pb_delphes",
        "i % 7 <> 0 as lhe_candidate", "i % 7 <> 0 as lhe_projection_valid",
    )
    return moments.run_summary(ev, levels=("lhe",)).selectExpr(
        "job_id", "event_count", "source_event_id_min as id_min", "source_event_id_max as id_max",
        "positive_weight_count as positive", "negative_weight_count as negative", "zero_weight_count as zero",
        r("sumw", "sumw", 4), r("sumw2", "sumw2", 4), r("sumabsw", "sumabsw", 4),
        r("cross_section_first_pb_delphes", "xs_first"), r("cross_section_min_pb_delphes", "xs_min"),
        r("cross_section_max_pb_delphes", "xs_max"), r("cross_section_final_pb_delphes", "xs_final"),
        "lhe_candidate_count as candidates",
    )


@query(
    "A07_exact_sums",
    "select event_type, " + d("sum(value::decimal(18,2))::double", "total", 4)
    + ", " + d("sum((value*1000000000)::decimal(38,3))::double", "shifted", 0) + " from events group by event_type",
)
def exact_sums(spark, sf):
    df = bridge.tables(spark, sf, "events").selectExpr("event_type", "value as total", "value * 1e9D as shifted")
    return moments.exact_sums(df, keys=["event_type"], columns=["total", "shifted"]).selectExpr(
        "event_type", r("total", "total", 4), r("shifted", "shifted", 0)
    )


def component_events(spark, sf):
    ev = events(spark, sf).withColumn("source_polarization_code", F.col("channel_code"))
    return compose_channels.component_columns(ev, "w")


@query(
    "A08_component_totals",
    EV + " select count(*) as n, " + ", ".join(
        x for s in COMPONENTS for c in [f"w*({coefficient_sql(s)})"] for x in (
            d(f"sum({c})", f"sumw_{s}", 3), d(f"sum(abs({c}))", f"sumabsw_{s}", 3),
            f"count(*) filter (where {c} > 0) as pos_{s}", f"count(*) filter (where {c} = 0) as zero_{s}")
    ) + " from ev",
)
def component_totals(spark, sf):
    t = compose_channels.component_totals(component_events(spark, sf))
    return t.selectExpr(
        "event_count as n",
        *[x for s in COMPONENTS for x in (
            r(f"sumw_{s}_pb", f"sumw_{s}", 3), r(f"sumabsw_{s}_pb", f"sumabsw_{s}", 3),
            f"positive_weight_count_{s} as pos_{s}", f"zero_weight_count_{s} as zero_{s}")],
    )


def channel_summaries(spark, sf):
    """Merge-summary-like rows of the four bridge channels."""
    per = events(spark, sf).groupBy("channel_code", "campaign_id").agg(
        F.expr("count(*) as event_count"), F.expr("count(distinct job_id) as source_job_count"),
        F.expr("sum(w) as effective_filtered_cross_section_pb"), F.expr("sum(w*w) as q"),
    )
    return per.selectExpr(
        "channel_code as source_polarization_code", "campaign_id", "channel_code + 10 as sample_code", "event_count",
        "source_job_count", "effective_filtered_cross_section_pb",
        f"{mean_error('effective_filtered_cross_section_pb', 'q', 'event_count')} as effective_filtered_cross_section_mc_error_pb",
    )


_CH = EV + ", ch as (select channel_code, count(*) as n, count(distinct job_id) as jobs, sum(w) as x from ev group by channel_code)"


@query(
    "A11_channel_contributions",
    _CH + " select channel_code as code, n as event_count, jobs as source_job_count, " + ", ".join(
        d(f"x*({coefficient_sql(s)})", f"contribution_{s}", 3) for s in COMPONENTS) + " from ch",
)
def channel_contributions(spark, sf):
    return compose_channels.source_rows(channel_summaries(spark, sf)).selectExpr(
        "source_polarization_code as code", "event_count", "source_job_count",
        *[r(f"contribution_{s}_pb", f"contribution_{s}", 3) for s in COMPONENTS],
    )


@query(
    "A09_A10_Q15_composition_closure",
    _CH + " select sum(n)::bigint as event_count, " + ", ".join(
        x for s in COMPONENTS for x in (d(f"sum(x*({coefficient_sql(s)}))", f"expected_{s}", 3), f"true as closed_{s}")
    ) + " from ch",
)
def composition_closure(spark, sf):
    sources = compose_channels.source_rows(channel_summaries(spark, sf))
    totals = compose_channels.component_totals(component_events(spark, sf))
    s = compose_channels.composition_summary(totals, sources)
    return s.selectExpr(
        "event_count",
        *[x for c in COMPONENTS for x in (
            r(f"expected_integral_{c}_pb", f"expected_{c}", 3),
            f"abs(closure_residual_{c}_pb) <= closure_tolerance_{c}_pb as closed_{c}")],
    )


@query(
    "A09_Q15_sources_repooled",
    _CH + " select distinct rule, '1' as code from ch, (values ('source.events')) t(rule) where channel_code = 1 "
    "union all select rule, '2' from (values ('source.nominal'), ('source.scale'), ('repool.filtered_cross_section_pb')) t(rule) "
    "union all select rule, '3' from (values ('repool.sumw_accepted'), ('repool.filtered_cross_section_pb'), ('repool.filtered_cross_section_mc_error_pb'), ('repool.signed_efficiency')) t(rule)",
)
def sources_repooled(spark, sf):
    """Four merged sources from their run rows against events and summaries; one of each kind of table is damaged."""
    from ..session import cut

    ev = events(spark, sf).selectExpr("*", "channel_code as source_polarization_code", "w as weight_lhe", "w as weight_nominal_pb")
    key = ["source_polarization_code", "job_id"]
    sums = moments.normalization_moments(ev.selectExpr("*", "'accepted' as phase_space"), keys=key)
    runs = sums.join(moments.weight_totals(ev, keys=key).join(ev.groupBy(*key).agg(F.count("*").alias("event_count")), key), key)
    runs = cut(runs.withColumnsRenamed({v: k for k, v in {**merge_campaign.NORMALIZATION, **merge_campaign.EFFECTIVE}.items()}))
    pooled = moments.pool(runs.withColumnsRenamed(merge_campaign.NORMALIZATION), keys=key[:1])
    names = {v: k for k, v in {**merge_campaign.NORMALIZATION, **merge_campaign.EFFECTIVE}.items()}
    whole = ["event_count", "positive_weight_count", "negative_weight_count", "zero_weight_count"]
    kept = runs.groupBy(*key[:1]).agg(F.sum("sumw").alias("_sumw"), *[F.sum(c).alias(c) for c in whole])
    summaries = pooled.withColumnsRenamed(names).join(kept, key[:1]).withColumn("merged_weight_scale", F.expr("effective_filtered_cross_section_pb / _sumw"))
    # what is compared is a mean, events carry sums: the nominal weight is scaled
    ev = ev.join(F.broadcast(summaries.select(key[0], "merged_weight_scale")), key[:1]).withColumn("weight_nominal_pb", F.col("weight_lhe") * F.col("merged_weight_scale"))
    bad_runs = runs.withColumns({
        "event_count": F.expr("if(source_polarization_code = 1 and job_id = 0, event_count + 1, event_count)"),
        "normalization_sumw_accepted_pb": F.expr("normalization_sumw_accepted_pb + if(source_polarization_code = 3 and job_id = 1, 5D, 0D)"),
    })
    wrong = "effective_filtered_cross_section_pb"
    bad_summaries = summaries.withColumn(wrong, F.expr(f"{wrong} * if(source_polarization_code = 2, 1.001D, 1D)")).drop("_sumw")
    found = compose_channels.sources_repooled(ev, bad_runs, bad_summaries)
    return found.selectExpr("rule", "subject as code").distinct()


@query(
    "U02_T03_composed_events",
    EV + " select i, channel_code as code, " + ", ".join(d(f"w*({coefficient_sql(s)})", s if s[0] == 'm' else f"w_{s}") for s in COMPONENTS)
    + " from ev where channel_code < 4",
)
def composed_events(spark, sf):
    ev = events(spark, sf).withColumnRenamed("w", "weight_nominal_pb")
    samples = {c: ev.where(f"channel_code = {k}") for k, c in enumerate(("LL", "TT", "TL", "LT"))}
    out = compose_channels.component_columns(compose_channels.union_channels(samples))
    return out.selectExpr(
        "i", "bigint(source_polarization_code) as code",
        *[r(COMPONENT_WEIGHT_COLUMNS[s], s if s[0] == "m" else f"w_{s}") for s in COMPONENTS],
    )


@query(
    "A22_source_id_digest",
    EV + " select job_id, count(*) as n, "
    "sha256(unhex(string_agg(lpad(to_hex(source_event_id), 16, '0'), '' order by source_event_id))) as sequence_sha256 "
    "from ev group by job_id",
)
def id_digest(spark, sf):
    return identity.sequence_digest_groups(
        events(spark, sf), keys=["job_id"], value="source_event_id"
    ).select("job_id", "n", "sequence_sha256")


# the weights here lie between 2**-32 and 2**32, so their rung is 0 or -1
@query(
    "A23_weight_payload_digest",
    EV + ", x as (select job_id, source_event_id, channel_code, w, case when abs(w) >= 1 then 0 else -1 end as k, "
    "case when abs(w) >= 1 then w else w * 4294967296e0 end as v from ev), "
    "y as (select job_id, sha256(concat_ws('|', strlen(source_event_id::varchar) || ':' || source_event_id::varchar, "
    "case when w = 0 then '0/0/0/0' else concat_ws('/', k, trunc(v)::bigint, trunc((v - trunc(v)) * 4294967296e0)::bigint, "
    "(((v - trunc(v)) * 4294967296e0 - trunc((v - trunc(v)) * 4294967296e0)) * 4294967296e0)::bigint) end, "
    "strlen(channel_code::varchar) || ':' || channel_code::varchar)) as h from x) select job_id, count(*) as n, "
    + ", ".join(f"(sum(('0x' || substr(h, {16 * i + 1}, 16))::ubigint) % 18446744073709551616::hugeint)::varchar as digest_{i}" for i in range(4))
    + " from y group by job_id",
)
def payload_digest(spark, sf):
    """Order-free fingerprint of each job's rows."""
    out = identity.payload_digest(events(spark, sf), keys=["job_id"], columns=["source_event_id", "w", "channel_code"])
    return out.select("job_id", "n", *[F.col(f"digest_{i}").cast("string").alias(f"digest_{i}") for i in range(4)])


@query(
    "A24_pattern_counts",
    "select source, count(*) filter (where contains(line, 'the')) as with_the, "
    "count(*) filter (where contains(line, '0')) as with_zero from "
    "(select source, unnest(string_split(text, chr(10))) as line from documents) t group by source",
)
def pattern_counts(spark, sf):
    from ..sources.metadata import count_patterns

    lines = bridge.tables(spark, sf, "documents").selectExpr("source", "explode(split(text, '\\n')) as value")
    return count_patterns(lines, {"with_the": "the", "with_zero": "0"}, keys=["source"])


@query(
    "A25_distinct_rules",
    "select count(*) as n, count(distinct user_id) as users, count(distinct event_type) as types, "
    "count(*) = count(distinct event_id) as ids_unique from events",
)
def distinct_rules(spark, sf):
    return bridge.tables(spark, sf, "events").agg(
        F.expr("count(*) as n"), F.expr("count(distinct user_id) as users"),
        F.expr("count(distinct event_type) as types"), F.expr("count(*) = count(distinct event_id) as ids_unique"),
    )


@query(
    "S13_first_events_per_job",
    EV + " select job_id, i, ordinal from (select job_id, i, row_number() over (partition by job_id order by source_event_id) - 1 as ordinal from ev) t where ordinal < 10",
)
def first_events(spark, sf):
    ranked = ordering.with_rank(events(spark, sf).select("job_id", "i", "source_event_id"), ["job_id"], "source_event_id", width=64)
    return ranked.where("ordinal < 10").select("job_id", "i", "ordinal")


def _campaign(spark, sf):
    """Two merged tables of the bridge campaign: analysis events and run rows."""
    ev = bridge.analysis_events(spark, sf).drop("weight_nominal_pb", "lumi", "truth_lhe_valid")
    keep = ["campaign_id", "sample_code", "job_id", "source_event_id", "weight_lhe", "reconstructed", "reco_pass_selection"]
    keep += [f"{l}_{c}" for l in ("lhe", "dressed", "reco") for c in ("candidate", "projection_valid", "theta1", "phi1", "theta2", "phi2")]
    ev = ev.selectExpr(*keep, "i as lhe_event_index", "i as hepmc_event_number")
    return ev


def _runs(spark, sf, ev=None):
    """Run rows of the bridge campaign with the columns that documents repeat."""
    ev = _campaign(spark, sf) if ev is None else ev
    norm = moments.normalization_moments(ev.selectExpr("*", "'accepted' as phase_space"))
    names = {**merge_campaign.NORMALIZATION, **merge_campaign.EFFECTIVE}
    runs = moments.run_summary(ev).join(norm.selectExpr(*JOB, *[f"{v} as {k}" for k, v in names.items()]), list(JOB))
    return runs.selectExpr(
        "*", "1 as schema_version", "1 as alignment_contract_code", "job_id + 1 as generation_seed", "job_id + 1000001 as delphes_seed", "job_id + 7 as run_number", "13600D as ecm_energy_gev",
        "if(job_id % 2 = 0, 23, 0) as athgeneration_release_major", "0 as athgeneration_release_minor", "if(job_id % 2 = 0, 53, 0) as athgeneration_release_patch",
    )


JOB = ("campaign_id", "sample_code", "job_id")
#: Damage of a job's document by job_id % 13.
_DAMAGE = {
    1: "document.provenance.lhe_contract.sumw_generated", 2: "document.provenance.generation.seed", 3: "document.provenance.lhe_contract.lhe_init.idwtup",
    4: "document.provenance.simulation.random_seed", 5: "document.release", 6: "document.release", 7: "document.object", 8: "document.absolute_sums",
    9: "document.provenance.generation.events", 10: "document.one_a_run", 11: "document.provenance.lhe_contract.normalization_contract",
}


def _document(damaged: bool) -> str:
    """A job's metadata document as a struct of run columns."""
    at = lambda k, bad, good: f"if(job_id % 13 = {k}, {bad}, {good})" if damaged else good
    contract = {
        "normalization_contract": at(11, "'other'", f"'{NORMALIZATION_CONTRACT}'"), "nominal_weight_units": f"'{NOMINAL_UNITS}'",
        "lhe_weighting_strategy": str(WEIGHTING_STRATEGY), "lhe_init": f"named_struct('idwtup', {at(3, '3', str(WEIGHTING_STRATEGY))})",
        "generated_lhe_events": "normalization_generated_lhe_events", "accepted_lhe_events": "normalization_accepted_lhe_events",
        "sumw_generated": at(1, "normalization_sumw_generated_pb + 1", "normalization_sumw_generated_pb"), "sumw2_generated": "normalization_sumw2_generated_pb2",
        "sumw_accepted": "normalization_sumw_accepted_pb", "sumw2_accepted": "normalization_sumw2_accepted_pb2",
        "sumabsw_generated": "normalization_sumabsw_generated_pb", "sumabsw_accepted": at(8, "normalization_sumabsw_accepted_pb * 2", "normalization_sumabsw_accepted_pb"),
        "inclusive_cross_section_pb": at(12, "inclusive_lhe_cross_section_pb * (1 + 1e-9)", "inclusive_lhe_cross_section_pb"),
        "filtered_cross_section_pb": "effective_filtered_cross_section_pb",
    }
    generation = {
        "seed": at(2, "null", "generation_seed"), "events": at(9, "event_count + 1", "event_count"), "first_event": "event_number_start", "run_number": "run_number",
        "ecm_energy_gev": "ecm_energy_gev", "generator_backend": at(5, "'unknown'", f"if(job_id % 2 = 0, '{RELEASED_BACKEND}', '{PLAIN_BACKEND}')"),
        "athgeneration_release": at(6, "'23.0.x'", "if(job_id % 2 = 0, '23.0.53', null)"),
    }
    struct = lambda d: "named_struct(" + ", ".join(f"'{k}', {v}" for k, v in d.items()) + ")"
    return struct({"provenance": struct({"lhe_contract": struct(contract), "generation": struct(generation), "simulation": struct({"random_seed": at(4, "'x'", "cast(delphes_seed as string)")})})})


@query(
    "J05_Q04_runs_against_documents",
    EV + ", j as (select distinct job_id from ev), f as (select job_id, case job_id % 13 "
    + " ".join(f"when {k} then '{v}'" for k, v in _DAMAGE.items()) + " end as rule from j) "
    "select rule, '20260902/0/' || job_id as subject from f where rule is not null "
    "union all select 'document.provenance.lhe_contract.inclusive_cross_section_pb', '20260902/0/' || job_id from j where job_id % 13 = 12",
)
def runs_documents(spark, sf):
    """Documents of every job, some damaged by a rule of the job number, against the run rows."""
    from ..operators import job_documents
    from ..session import cut

    runs = cut(_runs(spark, sf))
    document = _document(True)
    docs = runs.selectExpr(*JOB, f"if(job_id % 13 = 7, '[1, 2', to_json({document})) as document")
    docs = docs.unionByName(docs.where("job_id % 13 = 10"))
    found = job_documents.runs_against_documents(runs, docs)
    return found.select("rule", "subject").distinct()


def _job_events(spark, sf):
    """All 255 columns of the jobs' Events; a partition holds whole jobs, few enough to be sorted in memory."""
    from ..operators.levels import lhe_status

    parts = max(4 * spark.sparkContext.defaultParallelism, bridge.tables(spark, sf, "events").count() // 100_000)
    ev = bridge.analysis_events(spark, sf, parts=parts, whole_jobs=True).selectExpr(
        "*", "i % 250 as lhe_event_index", "i as hepmc_event_number", "i as delphes_event_number", "i % 250 as hepmc_entry", "i % 250 as delphes_entry", "w * 0.5D as weight_delphes",
        "abs(w) as cross_section_pb_delphes", "abs(w) / 10D as cross_section_error_pb_delphes", "true as has_lhe", "true as has_hepmc", "true as has_delphes",
        "0 as lhe_n_alternative_weights",
        *[f"int({l}_topology_valid) * {2 if c.endswith('s') and c[-2] != 'u' else 1} as {l}_{c}" for l in LEVELS for c in COUNT_FIELDS],
    )
    return identity.add_event_uid(ev.withColumn("lhe_status", F.expr(lhe_status())), b"leptide.events.v1\0")


@query(
    "U01_K01_K03_K04_jobs_to_campaign",
    EV + ", j as (select *, job_id % 13 as m from ev), g as (select * from j where m not in (3, 5, 7)), "
    "b as (select count(distinct job_id) filter (where m = 3) as c, count(distinct job_id) filter (where m = 5) as d, count(distinct job_id) filter (where m = 7) as e from j) "
    "select count(distinct job_id) as jobs, count(*) as n, cast(255 as bigint) as event_columns, cast(53 as bigint) as run_columns, " + d("sum(w)/count(*)", "cross_section")
    + ", cast(any_value(2 * b.c + 3 * b.d + b.e) as bigint) as findings, true as document_holds from g, b",
)
def jobs_to_campaign(spark, sf):
    """Write the outputs of all jobs, some faulty, read them back by path and merge what is whole."""
    from ..plans import campaign_jobs
    from ..session import cut, scratch_path
    from ..sinks.tables import conform, event_schema, run_schema

    folder = scratch_path(spark, "jobs")
    ev = _job_events(spark, sf)
    # job_id % 13: 3 names columns of its own, 5 has no document, 7 has no events
    campaign_jobs.write_job_events(ev.where("job_id % 13 <> 7"), folder, together=True)
    # the wide rows are not kept beside what is written: a run sums up its job's written events
    summed = [*JOB, "source_event_id", "lhe_event_index", "hepmc_event_number", "weight_lhe", "weight_delphes", "cross_section_pb_delphes", "cross_section_error_pb_delphes"]
    summed += [f"{l}_{c}" for l in LEVELS for c in ("candidate", "projection_valid")] + ["reconstructed"]
    written = spark.read.schema(event_schema()).parquet(f"{folder}/Events").select(summed)
    unwritten = cut(conform(ev.where("job_id % 13 = 7"), event_schema()).select(summed))
    runs = cut(_runs(spark, sf, written.unionByName(unwritten)))
    docs = runs.selectExpr(*JOB, f"to_json({_document(False)}) as document")
    campaign_jobs.write_job_records(runs, docs.where("job_id % 13 not in (3, 5)"), folder)
    other = docs.where("job_id % 13 = 3").select(
        F.expr("""concat(rtrim('}', document), '}}, "tables": {"Events": "other", "Runs": "other"}}')""").alias("value"), campaign_jobs.place().alias(campaign_jobs.DIRECTORY)
    )
    other.repartition(4 * spark.sparkContext.defaultParallelism, campaign_jobs.DIRECTORY).write.mode("append").partitionBy(campaign_jobs.DIRECTORY).text(f"{folder}/Metadata")
    merged, document = campaign_jobs.merge_jobs(spark, folder, check=False)
    found, text = merged.findings.agg(F.count("*")).scalar(), document.scalar()
    held = "from_json(doc, 'event_count bigint, source_job_count bigint, source_documents bigint, created_utc string')"
    return merged.summary.withColumns({"found": found, "doc": text}).withColumn("held", F.expr(held)).selectExpr(
        "source_job_count as jobs", "event_count as n", f"bigint({len(event_schema())}) as event_columns", f"bigint({len(run_schema())}) as run_columns",
        r("effective_filtered_cross_section_pb", "cross_section"), "found as findings",
        "held.event_count = event_count and held.source_job_count = source_job_count and held.source_documents = source_job_count "
        "and held.created_utc rlike '^[0-9-]{10}T[0-9:]{8}Z$' as document_holds",
    )


@query(
    "A04_U01_Q03_campaign_merge",
    POOL.replace("label='accepted'", "true") + " select " + d("s/n", "cross_section") + ", n as event_count, n as truth_valid, "
    + d("s", "retained", 4) + ", cast(0 as bigint) as findings from pool",
)
def campaign_merge(spark, sf):
    from ..session import cut

    ev = cut(_campaign(spark, sf))
    jobs = moments.run_summary(ev)
    norm = moments.normalization_moments(ev.selectExpr("*", "'accepted' as phase_space"))
    names = {**merge_campaign.NORMALIZATION, **merge_campaign.EFFECTIVE}
    runs = cut(jobs.join(
        norm.selectExpr("campaign_id", "sample_code", "job_id", *[f"{v} as {k}" for k, v in names.items()]),
        ["campaign_id", "sample_code", "job_id"],
    ).withColumns({"generation_seed": F.col("job_id") + 1, "delphes_seed": F.col("job_id") + 1000001}))
    out = merge_campaign.merge_campaign(ev, runs)
    found = out.findings.agg(F.count("*").alias("n"))
    return out.summary.withColumn("findings", found.scalar()).selectExpr(
        r("effective_filtered_cross_section_pb", "cross_section"), "event_count",
        "truth_lhe_valid_count as truth_valid", r("retained_raw_sumw_pb", "retained", 4), "findings",
    )
