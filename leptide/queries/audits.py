"""Data-quality rules on deliberately damaged views of the tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import bridge
from ..conventions import COMPONENTS, COMPONENT_WEIGHT_COLUMNS, HARMONIC_SLUGS
from ..fingerprint_paths import OPTIONAL_PATHS, REQUIRED_PATHS
from ..functions import identity
from ..operators import audit, levels
from ..plans import compose_channels, merge_campaign
from . import d, events, query, r
from .aggregates import JOBS, POOL, job_moments, labelled, merged_totals
from .derivations import V, coefficient_sql

EV = f"with ev as ({bridge.event_view_sql('events')})"


def per_rule(found):
    return found.groupBy("rule").agg(F.count("*").alias("n"))


def counted(rules: dict[str, str], source: str) -> str:
    """Oracle text: violations per rule, rules without any are absent."""
    parts = [f"select '{n}' as rule, count(*) as n from {source} where {c} having count(*) > 0" for n, c in rules.items()]
    return " union all ".join(parts)


@query(
    "Q01_declared_values",
    "with s as (select user_id as job_id, event_type as key, count(*) as n from events group by 1, 2) "
    "select 'stage.equal' as rule, count(*) as n from s where n % 3 = 0",
)
def declared_values(spark, sf):
    s = bridge.tables(spark, sf, "events").groupBy(F.col("user_id").alias("job_id"), F.col("event_type").alias("key")).agg(F.count("*").alias("n"))
    long = s.selectExpr(
        "job_id", "key", "inline(array(named_struct('stage', 'generation', 'value', string(n)), "
        "named_struct('stage', 'alignment', 'value', string(n)), named_struct('stage', 'simulation', 'value', if(n % 3 = 0, 'changed', string(n)))))",
    )
    return per_rule(audit.declared_equal(long))


@query(
    "Q02_Q04_contract_closure",
    JOBS + " select rule, n from (select 'contract.count_efficiency' as rule, count(*) filter (where job_id % 5 = 0) as n from job "
    "union all select 'contract.filtered', count(*) filter (where job_id % 3 = 0 and sa <> 0) from job "
    "union all select 'contract.counts', count(*) filter (where job_id % 7 = 0) from job) t where n > 0",
)
def contract_closure(spark, sf):
    c = job_moments(spark, sf).withColumns({
        "count_efficiency": F.expr("if(job_id % 5 = 0, count_efficiency + 1e-6D, count_efficiency)"),
        "filtered_cross_section_pb": F.expr("if(job_id % 3 = 0, filtered_cross_section_pb * (1D + 1e-9D), filtered_cross_section_pb)"),
        "rejected_below_m4l": F.expr("if(job_id % 7 = 0, rejected_below_m4l + 1, rejected_below_m4l)"),
    })
    return per_rule(audit.contract_rules(c))


@query(
    "Q03_run_summary_recomputed",
    EV + ", j as (select distinct job_id from ev) " + counted(
        {"runs.event_count": "job_id % 4 = 0", "runs.sumw": "job_id % 6 = 0", "runs.present": "job_id % 9 = 0"}, "j"
    ).replace("'runs.event_count' as rule, count(*) as n from j where job_id % 4 = 0", "'runs.event_count' as rule, count(*) as n from j where job_id % 4 = 0 and job_id % 9 <> 0")
    .replace("'runs.sumw' as rule, count(*) as n from j where job_id % 6 = 0", "'runs.sumw' as rule, count(*) as n from j where job_id % 6 = 0 and job_id % 9 <> 0"),
)
def run_summary_recomputed(spark, sf):
    got = events(spark, sf).groupBy("job_id").agg(F.count("*").alias("event_count"), F.sum("w").alias("sumw"))
    said = got.where("job_id % 9 <> 0").selectExpr(
        "job_id", "event_count + if(job_id % 4 = 0, 1, 0) as event_count", "sumw + if(job_id % 6 = 0, 1D, 0D) as sumw"
    )
    return per_rule(audit.summary_rules(got, said, keys=["job_id"], exact=["event_count"], close_columns=["sumw"]))


@query(
    "Q05_nominal_closure",
    POOL + ", x as (select sum(w * (sa/n)/sa) as got, sum(abs(w)) as size from lab cross join pool where label = 'accepted') select "
    + d("got", "nominal_sum", 4) + ", " + d("sa/n", "filtered", 4)
    + ", abs(got - sa/n) <= 1e-9*greatest(abs(sa/n), 1e-12) as closes, abs(sa) > 1e-12*aa as resolved from x cross join pool",
)
def nominal_closure(spark, sf):
    totals = merged_totals(spark, sf)
    kept = labelled(spark, sf).where("phase_space = 'accepted'")
    scale = totals.select("merged_weight_scale").scalar()
    got = kept.withColumn("n", F.col("weight_lhe") * scale).agg(F.sum("n").alias("s"))
    tol = audit.nominal_tolerance("filtered_cross_section_pb", "merged_weight_scale", "retained_raw_sumabsw_pb")
    return totals.withColumn("got", got.scalar()).selectExpr(
        r("got", "nominal_sum", 4), r("filtered_cross_section_pb", "filtered", 4),
        f"abs(got - filtered_cross_section_pb) <= {tol} as closes",
        "abs(retained_raw_sumw_pb) > 1e-12D * retained_raw_sumabsw_pb as resolved",
    )


@query(
    "Q06_campaign_uniqueness",
    "select rule, n from (select 'job.unique' as rule, count(*) as n from (select 1 from customer group by c_custkey // 2 having count(*) > 1) a "
    "union all select 'generation_seed.unique', count(*) from (select c_nationkey from customer group by 1 having count(*) > 1) b "
    "union all select 'generation_seed.positive', count(*) from customer where c_nationkey <= 0 "
    "union all select 'sample.single', 1) t where n > 0",
)
def campaign_uniqueness(spark, sf):
    runs = bridge.tables(spark, sf, "customer").selectExpr(
        "bigint(1) as campaign_id", "if(c_custkey div 2 = 3, 1, 0) as s", "c_custkey div 2 as job_id", "c_nationkey as generation_seed"
    )
    base = runs.selectExpr("campaign_id", "0 as sample_code", "job_id", "generation_seed")
    found = audit.campaign_rules(base)
    mixed = audit.campaign_rules(runs.selectExpr("campaign_id", "s as sample_code", "job_id", "generation_seed")).where("rule = 'sample.single'")
    return per_rule(audit.combine(found, mixed))


@query(
    "Q07_signed_sum_usable",
    EV + ", t as (select sum(w) as s, sum(abs(w)) as a from ev) select 'sum.sign' as rule, count(*) as n from t where s > 0 having count(*) > 0",
)
def signed_sum(spark, sf):
    t = events(spark, sf).agg(
        F.expr("sum(w) as retained_raw_sumw_pb"), F.expr("sum(abs(w)) as retained_raw_sumabsw_pb"), F.expr("-sum(w) as filtered_cross_section_pb")
    )
    return per_rule(audit.signed_sum_rules(t.withColumn("filtered_cross_section_pb", F.expr("-abs(filtered_cross_section_pb)"))))


@query(
    "Q08_physics_fingerprint",
    "with j as (select event_id, event_type, user_id % 3 as u, value > 5e1 as hot from events), n as (select "
    "count(distinct event_type) as types, count(distinct hot) as shapes, count(*) filter (where u = 0) as lost, min(u) as lo, max(u) as hi from j) "
    f"select rule, k::bigint as n from (select 'fingerprint.missing' as rule, lost as k from n union all select 'fingerprint.differs', "
    "(types > 1)::int + (lo <> hi and lo = 0)::int + (shapes > 1)::int from n) t where k > 0",
)
def physics_fingerprint(spark, sf):
    """The whole path lists over a document per event row: one path varies, one is missing at times, an optional one comes and goes."""
    paths = {p: "'1'" for p in (*REQUIRED_PATHS, *OPTIONAL_PATHS)}
    paths["sample"] = "event_type"
    lost, optional = "provenance.generation.run_number", OPTIONAL_PATHS[0]
    tree: dict = {}
    for path in paths:
        *up, leaf = path.split(".")
        node = tree
        for k in up:
            node = node.setdefault(k, {})
        node[leaf] = path

    def text(node) -> str:
        if isinstance(node, str):
            whole = f"string({paths[node]})"
            return f"if(user_id % 3 = 0, null, {whole})" if node == lost else f"if(value > 50D, null, {whole})" if node == optional else whole
        return "named_struct(" + ", ".join(f"'{k}', {text(v)}" for k, v in node.items()) + ")"

    # a few bytes a row become a document of kilobytes: the table is dealt out before, however few row groups it has
    few = bridge.tables(spark, sf, "events").select("event_id", "event_type", "user_id", "value")
    few = few.repartition(8 * spark.sparkContext.defaultParallelism, "event_id")
    docs = few.selectExpr("event_id as job_id", f"to_json({text(tree)}) as document")
    _, found = audit.fingerprint(docs, REQUIRED_PATHS, OPTIONAL_PATHS)
    return per_rule(found)


@query(
    "Q10_Q21_schema_and_retention",
    "select rule, n from (values ('retention', 2), ('schema', 3)) t(rule, n) "
    "union all select 'retention.count', count(*) from (select count(*) as n from events) c where n <> 1",
)
def schema_rules(spark, sf):
    from pyspark.sql import types as T

    ev = bridge.tables(spark, sf, "events")
    want = T.StructType.fromDDL("event_id bigint, ts timestamp_ntz, user_id int, event_type string, amount double, props string")
    nested = ev.selectExpr("named_struct('px', value) as Particle", "event_id")
    return per_rule(audit.combine(
        audit.schema_findings(ev, want, "events"),
        audit.required_columns(nested, ["Particle.px", "Particle.py", "Weight"], "Delphes"),
        audit.row_count(nested, 1),
    ))


@query(
    "Q11_Q18_mask_consistency",
    V + ", x as (select i from v) " + counted({
        "mask.lhe.candidate": "i % 7 = 0", "mask.lhe.angles": "i % 7 = 0 or i % 13 = 0", "weight.w": "i % 17 = 0",
    }, "x"),
)
def mask_consistency(spark, sf):
    ev = events(spark, sf).withColumn("lhe_topology_valid", F.expr("i % 7 <> 0"))
    lv = levels.derive_level(ev, "lhe").withColumns({
        "lhe_projection_valid": F.lit(True),
        "lhe_theta1": F.expr("if(i % 13 = 0, double('NaN'), lhe_theta1)"),
        "w": F.expr("if(i % 17 = 0, 1e200D, w)"),
    })
    return per_rule(audit.combine(audit.mask_rules(lv, ["i"], levels=("lhe",)), audit.weight_rules(lv, ["i"], ["w"])))


@query("Q12_uid_recomputed", EV + " select 'uid.stored' as rule, count(*) as n from ev where i % 100 = 0")
def uid_recomputed(spark, sf):
    tag = b"leptide.events.v1\0"
    ev = identity.add_event_uid(events(spark, sf).select("campaign_id", "sample_code", "job_id", "source_event_id", "i"), tag)
    bad = ev.withColumn("event_uid_lo", F.expr("if(i % 100 = 0, event_uid_lo + 1, event_uid_lo)"))
    return per_rule(audit.uid_rules(bad, tag))


def _truth(spark, sf):
    lv = levels.derive_level(events(spark, sf), "lhe").withColumnRenamed("w", "weight_nominal_pb")
    return merge_campaign.truth_columns(lv)


@query(
    "Q13_Q16_truth_weights",
    EV + ", x as (select i, w from ev) " + counted({f"truth.{s}": f"i % {n} = 0" for s, n in zip(HARMONIC_SLUGS, (10, 20, 30, 40))}, "x"),
)
def truth_weights(spark, sf):
    df = _truth(spark, sf)
    for s, n in zip(HARMONIC_SLUGS, (10, 20, 30, 40)):
        c = f"weight_truth_{s}_pb"
        df = df.withColumn(c, F.expr(f"if(i % {n} = 0, {c} + 1e-3D * greatest(abs(weight_nominal_pb), 1D), {c})"))
    return per_rule(audit.truth_weight_rules(df, ["i"]))


@query(
    "Q14_source_contracts",
    EV + ", c as (select channel_code, sum(case when w > 5e1 then 1 else 0 end) as busy, max(job_id) % 2 as odd, min(i) as seed from ev group by 1), "
    "m as (select *, sum(busy) over () as total from c), f as (select 'source.frame' as rule, count(*) as n from m where busy * 4 > total "
    "union all select 'source.interference', count(*) from m where odd = 1 and channel_code >= 2 "
    "union all select 'source.cards', (count(distinct seed % 3) <> count(*))::int from m "
    "union all select 'source.complete', (count(*) <> 4)::int from m) select rule, n::bigint as n from f where n > 0",
)
def source_contracts(spark, sf):
    """Four channel declarations built from the channels present in the events."""
    ch = events(spark, sf).groupBy("channel_code", "campaign_id").agg(
        F.expr("count_if(w > 50D) as busy"), F.expr("max(job_id) % 2 as odd"), F.expr("min(i) as seed")
    ).selectExpr(
        "element_at(array('LL', 'TT', 'TL', 'LT'), int(channel_code) + 1) as channel", "campaign_id", "channel_code", "odd", "seed",
        "busy * 4 > sum(busy) over (partition by campaign_id) as damaged",
    )  # one row a channel
    md = ch.selectExpr(
        "channel", "campaign_id", "channel_code + 10 as sample_code", "if(damaged, 'lab_frame', 'four_lepton_rest_frame') as frame",
        "'mu+mu-' as z1_decay", "'e+e-' as z2_decay", "if(odd = 1, 'not_applicable', 'none') as interference", "'[3, 4, 5, 6]' as me_frame",
        "'idwtup-minus4-sample-mean-v1' as normalization_contract", "-4 as idwtup",
        "sha2(string(seed % 3), 256) as process_card_sha256", "'same' as common_fingerprint",
    )
    return per_rule(compose_channels.source_contract(md))


@query(
    "Q17_constant_columns",
    "with c as (select count(distinct event_type) as types, count(distinct user_id // 1000000) as users, min(value) - 1e0 as lo, count(distinct value) as vals from events) "
    "select rule, 1::bigint as n from (select 'constant.event_type' as rule, types > 1 as bad from c union all select 'constant.lumi', users > 1 from c "
    "union all select 'constant.signed', vals > 1 from c union all select 'positive.signed', lo <= 0 from c) t where bad",
)
def constant_columns(spark, sf):
    ev = bridge.tables(spark, sf, "events").selectExpr("event_type", "312000D + user_id div 1000000 as lumi", "value - 1D as signed")
    return per_rule(audit.constant_rules(ev, ["event_type", "lumi", "signed"], positive=["lumi", "signed"]))


@query(
    "Q19_topology_floor",
    EV + ", j as (select job_id, count(*) filter (where i % 250 < 100 and job_id % 3 <> 0) as c from ev group by 1) "
    "select 'floor.' || l || '.' || k as rule, count(*) as n from j, (values ('lhe'), ('dressed')) a(l), (values ('candidate'), ('projection_valid')) b(k) where c = 0 group by 1",
)
def topology_floor(spark, sf):
    j = events(spark, sf).groupBy("job_id").agg(F.expr("count_if(i % 250 < 100 and job_id % 3 <> 0) as c"))
    return per_rule(audit.topology_floor(j.selectExpr(
        "job_id", *[f"c as {l}_{k}_count" for l in ("lhe", "dressed") for k in ("candidate", "projection_valid")]
    ), ["job_id"]))


@query(
    "Q22_campaign_ledger",
    "with j as (select o_orderkey as job_id, o_orderkey * 100 + 1 as first_event, case when o_orderkey % 50 = 0 then 150 when o_orderkey % 333 = 1 then 900 else 100 end as events, o_custkey + 1 as seed from orders) "
    "select rule, n from (select 'ledger.overlap' as rule, count(*) as n from (select *, max(first_event + events - 1) over (order by first_event, job_id rows between unbounded preceding and 1 preceding) as prev from j) t where prev >= first_event "
    "union all select 'ledger.seed', count(*) from (select seed from j group by 1 having count(*) > 1) u "
    "union all select 'ledger.events_range', count(*) from j where events > 120) w where n > 0",
)
def campaign_ledger(spark, sf):
    j = bridge.tables(spark, sf, "orders").selectExpr(
        "o_orderkey as job_id", "o_orderkey * 100 + 1 as first_event", "case when o_orderkey % 50 = 0 then 150 when o_orderkey % 333 = 1 then 900 else 100 end as events", "o_custkey + 1 as seed"
    )
    top = 1 << 60
    return per_rule(audit.ledger_rules(j, max_job_id=top, max_seed=top, max_event=top, max_events_per_job=120))


@query(
    "Q23_composed_output",
    EV + f", k as (select i, w, {coefficient_sql('20_20')} as c from ev), x as (select i, w, w*c + case when i % 10 = 0 then 1e0 else 0e0 end as written, "
    "c + case when i % 15 = 0 then 1e0 else 0e0 end as factor from k) "
    # an event of weight 0 has product 0 with any coefficient
    + counted({"written.weight.20_20": "written <> w*factor", "written.coefficient.20_20": "i % 15 = 0"}, "x")
    + " union all select 'written.20_20', 1::bigint",
)
def composed_output(spark, sf):
    """The rules on the written tables, with weights and coefficients of one component damaged."""
    from .aggregates import channel_summaries, component_events

    sources = compose_channels.source_rows(channel_summaries(spark, sf))
    out = component_events(spark, sf).withColumnRenamed("w", "weight_nominal_pb")
    summary = compose_channels.composition_summary(compose_channels.component_totals(out), sources)
    w, c = COMPONENT_WEIGHT_COLUMNS["20_20"], "polarization_coefficient_20_20"
    out = out.withColumns({
        w: F.expr(f"if(i % 10 = 0, {w} + 1D, {w})"), c: F.expr(f"if(i % 15 = 0, {c} + 1D, {c})"),
    })
    return per_rule(compose_channels.verify_composed({"Events": out, "PolarizationSources": sources, "PolarizationCombinationSummary": summary}))
