"""Stream matching, ordering, dressing, ancestry and set operations.

All queries read whole tables. Where a copy leaves rows out, the gaps are the
point: unmatched events, missing IDs, ordinals that have to be renumbered.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import bridge
from ..operators import ancestry, audit, dressing, matching, ordering
from ..operators.histograms import edge_bin, uniform_bin
from . import d, events, query, r, wrap_sql

EV = f"with ev as ({bridge.event_view_sql('events')})"
_THIN = "select job_id, source_event_id, case when i % 23 = 0 then w + 1e0 else w end as weight_right, i as right_ordinal from {t} where i % 10 <> 0"


def _right(spark, sf):
    """A thinned, partly altered copy of the event stream plus strangers."""
    return spark.sql(_THIN.format(t="{t}"), t=events(spark, sf))


@query(
    "J01_F09_select_requested",
    EV + f", rq as ({_THIN.format(t='ev')}) select 'found' as kind, count(*) as n from ev semi join rq using (job_id, source_event_id) "
    "union all select 'missing', count(*) from (select job_id, source_event_id from ev where i % 10 = 0) m",
)
def select_requested(spark, sf):
    ev, right = events(spark, sf), _right(spark, sf)
    found, _ = matching.select_requested(ev, right)
    _, missing = matching.select_requested(right, ev)
    return found.agg(F.lit("found").alias("kind"), F.count("*").alias("n")).unionByName(
        missing.agg(F.lit("missing").alias("kind"), F.count("*").alias("n"))
    )


@query(
    "J02_match_streams",
    EV + f", rq as ({_THIN.format(t='ev')}) select job_id, source_event_id, case when rq.weight_right is null then 'left_only' else 'both' end as match, "
    + d("coalesce(weight_right, 0e0) - w", "gap") + " from ev left join rq using (job_id, source_event_id)",
)
def match_streams(spark, sf):
    left = events(spark, sf).select("job_id", "source_event_id", "w")
    m = matching.match_streams(left, _right(spark, sf))
    return m.selectExpr("job_id", "source_event_id", "match", r("coalesce(weight_right, 0D) - w", "gap"))


@query(
    "J02_order_line_match",
    "select coalesce(o_orderkey, l_orderkey) as order_key, case when l_orderkey is null then 'left_only' when o_orderkey is null then 'right_only' else 'both' end as match, "
    "coalesce(n, 0) as n_lines from orders full join (select l_orderkey, count(*) as n from lineitem group by l_orderkey) l on o_orderkey = l_orderkey",
)
def order_line_match(spark, sf):
    o = bridge.tables(spark, sf, "orders").selectExpr("o_orderkey as order_key", "o_totalprice")
    l = bridge.tables(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("order_key")).agg(F.count("*").alias("n"))
    return matching.match_streams(o, l, ["order_key"]).selectExpr("order_key", "match", "coalesce(n, 0) as n_lines")


@query(
    "J03_Q09_aligned_weights",
    EV + " select 'joined' as kind, count(*) as n from ev where i % 10 <> 0 union all "
    "select 'events_without_weights', count(*) from ev where i % 10 = 0 union all select 'weights_without_events', 0",
)
def aligned_weights(spark, sf):
    ev = events(spark, sf).selectExpr("campaign_id", "sample_code", "job_id", "source_event_id", "w")
    wt = ev.where("(source_event_id - 1) % 10 <> 0").selectExpr(
        "campaign_id", "sample_code", "job_id", "source_event_id", "array(0.9D*w, 1.1D*w) as values"
    )
    joined, a, b = matching.aligned_weights(ev, wt)
    count = lambda df, k: df.agg(F.lit(k).alias("kind"), F.count("*").alias("n"))
    return count(joined, "joined").unionByName(count(a, "events_without_weights")).unionByName(
        count(b, "weights_without_events")
    )


@query(
    "Q09_alternative_weight_rules",
    EV + " select rule, n from (select 'weights.missing' as rule, count(*) as n from ev where i % 10 = 0 union all "
    "select 'weights.orphan', count(*) from ev where i % 14 = 3 and i % 10 <> 0 union all "
    "select 'weights.unique', count(*) from ev where i % 22 = 5 and i % 10 <> 0 and i % 14 <> 3 union all "
    "select 'weights.size', sum(case when i % 22 = 5 and i % 14 <> 3 then 2 else 1 end) from ev where i % 6 = 1 and i % 10 <> 0) t where n > 0",
)
def weight_rules(spark, sf):
    """Weights lost, without event, twice, and of the wrong size, all counted by the rule itself."""
    ev = events(spark, sf).selectExpr("campaign_id", "sample_code", "job_id", "source_event_id", "w", "i")
    wt = ev.where("i % 10 <> 0").selectExpr(
        "campaign_id", "sample_code", "job_id", "if(i % 14 = 3, -source_event_id, source_event_id) as source_event_id",
        "if(i % 6 = 1, array(w), array(0.9D*w, 1.1D*w)) as values", "explode(sequence(1, if(i % 22 = 5 and i % 14 <> 3, 2, 1))) as copy",
    ).drop("copy")
    found = audit.aligned_weight_rules(ev.drop("i").withColumn("_", F.lit(0)).drop("_"), wt, 2)
    # an orphan's event has no weights either: only what was never written counts as missing here
    lost = F.expr("rule <> 'weights.missing' or (bigint(split_part(subject, '/', 2)) - 1) % 10 = 0")
    return found.where(lost).groupBy("rule").agg(F.count("*").alias("n"))


@query(
    "J02_match_ordinals",
    EV + ", l as (select job_id, i, row_number() over (partition by job_id order by i) as k from ev), "
    "g as (select l.*, case when job_id % 3 = 0 and i % 5 <> 0 then k + 1 else k end as k2 from l where i % 17 <> 0) "
    "select rule, n from (select 'match.unmatched' as rule, count(*) as n from l where i % 17 = 0 union all select 'match.ordinal', count(*) from g where k <> k2) t where n > 0",
)
def match_ordinals(spark, sf):
    """A stream with intact ids but shifted places is found by the ordinals."""
    ev = events(spark, sf).select("job_id", "i", "source_event_id")
    left = ordering.with_rank(ev, ["job_id"], "source_event_id", name="left_at").select("job_id", "source_event_id", "left_at")
    right = ordering.with_rank(ev, ["job_id"], "source_event_id", name="at").where("i % 17 <> 0").selectExpr(
        "job_id", "source_event_id", "if(job_id % 3 = 0 and i % 5 <> 0, at + 1, at) as right_at"
    )
    both = matching.match_streams(left, right, ["job_id", "source_event_id"])
    return matching.match_findings(both, "left_at", "right_at", ["job_id", "source_event_id"]).groupBy("rule").agg(F.count("*").alias("n"))


@query(
    "J04_J05_events_with_run_columns",
    EV + ", runs as (select job_id, sum(w) as sumw, count(*) as n from ev group by job_id) "
    "select i, n, " + d("w/nullif(sumw,0e0)", "share") + " from ev join runs using (job_id)",
)
def with_run_columns(spark, sf):
    ev = events(spark, sf)
    runs = ev.groupBy("job_id").agg(F.sum("w").alias("sumw"), F.count("*").alias("n"))
    return matching.with_run_columns(ev, runs, ["job_id"], ["sumw", "n"]).selectExpr(
        "i", "n", r("try_divide(w, sumw)", "share")
    )


@query(
    "J06_stage_metadata_self_check",
    "with m as (select event_id // 50 as job_id, 'generation' as stage, event_type as key, cast(count(*) as varchar) as value from events group by 1, 3 "
    "union all select event_id // 50, 'simulation', event_type, cast(count(*) + case when event_type = 'view' then 1 else 0 end as varchar) from events group by 1, 3) "
    "select 'stage.equal' as rule, count(*) as n from (select job_id, key from m group by job_id, key having count(distinct value) > 1) t",
)
def stage_metadata(spark, sf):
    from ..operators.audit import declared_equal

    per = bridge.tables(spark, sf, "events").groupBy(F.expr("event_id div 50 as job_id"), F.col("event_type").alias("key")).agg(F.count("*").alias("n"))
    long = per.selectExpr(
        "job_id", "key",
        "inline(array(named_struct('stage', 'generation', 'value', string(n)), "
        "named_struct('stage', 'simulation', 'value', string(n + if(key = 'view', 1, 0)))))",
    )
    return declared_equal(long).groupBy("rule").agg(F.count("*").alias("n"))




@query(
    "J08_W06_nearest_lepton",
    "with p as (select vec_id, cast(label as bigint) as event_id, cast(embedding[1] as double)*8e0 as eta, cast(embedding[2] as double)*8e0 as phi from embeddings), "
    "c as (select g.event_id, g.vec_id as photon_id, l.vec_id as lepton_id, sqrt((l.eta-g.eta)*(l.eta-g.eta)+pow(" + wrap_sql("l.phi-g.phi") + ", 2)) as dr "
    "from p g join p l on g.event_id = l.event_id and g.vec_id % 3 = 0 and l.vec_id % 3 <> 0), "
    "b as (select *, row_number() over (partition by photon_id order by dr, lepton_id) as k from c where dr < 0.4e0) "
    "select event_id, photon_id, lepton_id, " + d("dr", "delta_r") + " from b where k = 1",
)
def nearest_lepton(spark, sf):
    p = bridge.tables(spark, sf, "embeddings").selectExpr(
        "vec_id", "bigint(label) as event_id", "double(embedding[0])*8D as eta", "double(embedding[1])*8D as phi"
    )
    leptons = p.where("vec_id % 3 <> 0").withColumnRenamed("vec_id", "lepton_id")
    photons = p.where("vec_id % 3 = 0").withColumnRenamed("vec_id", "photon_id")
    return dressing.nearest_lepton(leptons, photons, 0.4).selectExpr(
        "event_id", "photon_id", "lepton_id", r("delta_r", "delta_r")
    )


@query(
    "J08_photon_dressing",
    EV + ", p as (select *, i % 2 = 0 and 0.25e0*sqrt(lhe_raw_muon_minus_px*lhe_raw_muon_minus_px + lhe_raw_muon_minus_py*lhe_raw_muon_minus_py) > 0.1e0 as radiates from ev) "
    "select i, " + d("lhe_raw_muon_minus_px*(1e0 + case when radiates then 0.25e0 else 0e0 end)", "mm_px") + ", "
    + d("lhe_raw_electron_plus_E", "ep_e") + ", cast(case when radiates then 1 else 0 end as bigint) as mm_photons from p",
)
def photon_dressing(spark, sf):
    """Even events radiate a quarter of the mu- momentum exactly along it; below the threshold it isn't added."""
    ev = events(spark, sf)
    names = ("px", "py", "pz", "E")
    item = lambda k, n: f"named_struct('lepton_id', {n}, " + ", ".join(
        f"'{c.lower()}', lhe_raw_{k}_{c}" for c in names) + ")"
    leptons = ev.selectExpr("i as event_id", f"inline(array({item('muon_minus', 1)}, {item('electron_plus', 2)}))")
    photons = ev.where("i % 2 = 0").selectExpr(
        "i as event_id", "1 as photon_id", *[f"0.25D*lhe_raw_muon_minus_{c} as {c.lower()}" for c in names]
    )
    out = dressing.dress(leptons, photons)
    return out.groupBy(F.col("event_id").alias("i")).agg(
        F.expr("max(if(lepton_id = 1, px, null)) as a"), F.expr("max(if(lepton_id = 2, e, null)) as b"),
        F.expr("max(if(lepton_id = 1, n_photons, 0)) as mm_photons"),
    ).selectExpr("i", r("a", "mm_px"), r("b", "ep_e"), "mm_photons")


@query(
    "J09_bin_lookup",
    "select event_id, cast(case when value < 0 then 0 when value >= 100 then 24 else floor(value/4e0) end as bigint) as uniform, "
    "cast(greatest(least(len([e for e in [0e0, 5e0, 7.5e0, 20e0, 80e0] if e <= value]) - 1, 3), 0) as bigint) as custom from events",
)
def bin_lookup(spark, sf):
    return bridge.tables(spark, sf, "events").selectExpr(
        "event_id", f"bigint({uniform_bin('value', '0D', '100D', '4D', '25')}) as uniform",
        f"bigint({edge_bin('value', 'array(0D, 5D, 7.5D, 20D, 80D)')}) as custom",
    )


# -- ordering ---------------------------------------------------------------------
@query(
    "W01_P20_renumber",
    EV + " select job_id, source_event_id, ordinal, ordinal + job_id*1000 + 1 as event_number from "
    "(select job_id, source_event_id, row_number() over (partition by job_id order by source_event_id) - 1 as ordinal from ev where i % 3 <> 0) t",
)
def renumber(spark, sf):
    ev = events(spark, sf).where("i % 3 <> 0").selectExpr("job_id", "source_event_id", "job_id*1000 + 1 as first_event")
    return ordering.renumber(ev, ["job_id"], "source_event_id", width=64).select(
        "job_id", "source_event_id", "ordinal", "event_number"
    )


_SEQ = "select job_id, i, case when i % 50 = 49 then source_event_id - 30 else source_event_id end as id from {t}"


@query(
    "W02_W03_not_increasing",
    EV + f", s as ({_SEQ.format(t='ev')}) select job_id, i, id, previous from (select *, lag(id) over (partition by job_id order by i) as previous from s) t where id <= previous",
)
def not_increasing(spark, sf):
    s = spark.sql(_SEQ.format(t="{t}"), t=events(spark, sf))
    return ordering.not_increasing(s, ["job_id"], "i", "id", width=64).select("job_id", "i", "id", "previous")


@query(
    "W04_not_contiguous",
    EV + " select job_id, i, stored, position from (select job_id, i, case when i % 40 = 0 then -1 else i % 250 end as stored, "
    "row_number() over (partition by job_id order by i) - 1 as position from ev) t where stored <> position",
)
def not_contiguous(spark, sf):
    ev = events(spark, sf).selectExpr("job_id", "i", "if(i % 40 = 0, -1, i % 250) as stored")
    return ordering.not_contiguous(ev, ["job_id"], "i", ["stored"], width=64).select("job_id", "i", "stored", "position")


@query(
    "U03_set_differences",
    EV + " select count(*) as missing from (select source_event_id from ev except all select source_event_id from ev where i % 10 <> 0) t",
)
def set_differences(spark, sf):
    ev = events(spark, sf)
    return ev.select("source_event_id").exceptAll(ev.where("i % 10 <> 0").select("source_event_id")).agg(
        F.count("*").alias("missing")
    )


@query(
    "U04_duplicate_line_keys",
    "select l_orderkey, l_linenumber, count(*) as n from lineitem group by 1, 2 having count(*) > 1",
)
def duplicate_lines(spark, sf):
    return matching.duplicate_keys(bridge.tables(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


# -- ancestry ----------------------------------------------------------------------
_TREE = """
select event_id // 64 as event_id, event_id % 64 as idx,
  case when event_id % 64 = 0 then 21 when event_id % 64 = 1 then 21
       when event_id % 64 >= 32 then case event_id % 4 when 0 then 11 when 1 then -13 when 2 then 13 else 22 end
       when (event_id * 7) % 11 = 0 then 511 when (event_id * 7) % 5 = 0 then 23
       when (event_id * 7) % 3 = 0 then 11 when (event_id * 7) % 3 = 1 then 13 else 4 end as pid,
  case when event_id % 64 < 2 then 21 when event_id % 64 >= 32 then 1 else 23 end as status,
  case when event_id % 64 < 2 then -1 when event_id % 64 < 4 then 0 else (event_id % 64) // 2 end as m1,
  case when event_id % 64 < 2 then -1 when event_id % 64 < 4 then 1 else -1 end as m2,
  0e0 as mass from events
"""
_LINKS = f"""with recursive p as ({_TREE}),
l as (select c.event_id, c.idx as child, c.pid as cpid, m.idx as mother, m.pid as mpid, m.status as mstatus
      from p c join p m on c.event_id = m.event_id and m.idx in (c.m1, c.m2) and m.idx >= 0)"""


def _tree(spark, sf):
    text = _TREE.replace("event_id // 64 as", "bigint(event_id div 64) as").replace("(event_id % 64) // 2", "(event_id % 64) div 2")
    return spark.sql(text.replace("from events", "from {events}"), events=bridge.tables(spark, sf, "events"))


@query(
    "G01_hadron_ancestry",
    _LINKS + ", f as (select event_id, child as idx from l where abs(mpid) between 100 and 999999 union "
    "select l.event_id, l.child from l join f on l.event_id = f.event_id and l.mother = f.idx where not (abs(mpid) <= 6 or abs(mpid) = 21)) "
    "select distinct event_id, idx from f",
)
def hadron_ancestry(spark, sf):
    return ancestry.hadron_descendants(ancestry.mother_links(_tree(spark, sf)))


@query(
    "G02_boson_ancestry",
    _LINKS + ", fl as (select 11 as flavor union all select 13), f as (select event_id, flavor, child as idx from l, fl where mpid in (23, -23, 24, -24) and abs(cpid) = flavor union "
    "select l.event_id, f.flavor, l.child from l join f on l.event_id = f.event_id and l.mother = f.idx where abs(mpid) = f.flavor and abs(cpid) = f.flavor) "
    "select distinct event_id, flavor, idx from f",
)
def boson_ancestry(spark, sf):
    return ancestry.boson_descendants(ancestry.mother_links(_tree(spark, sf)))


@query(
    "G03_hard_process_ancestry",
    _LINKS + ", s as (select l.event_id, l.child as idx from l join p on p.event_id = l.event_id and p.idx = l.child and p.status in (1, 23) and abs(p.pid) in (11, 13) "
    "group by 1, 2 having count(distinct l.mother) = 2 and count(*) filter (where mpid = 21 and mstatus = 21) = 2), "
    "f as (select event_id, idx from s union select l.event_id, l.child from l join f on l.event_id = f.event_id and l.mother = f.idx where mpid = cpid) "
    "select distinct event_id, idx from f",
)
def hard_ancestry(spark, sf):
    p = _tree(spark, sf)
    return ancestry.hard_process_descendants(p, ancestry.mother_links(p))


@query(
    "F08_origin_eligibility",
    _LINKS + ", h as (select event_id, child as idx from l where abs(mpid) between 100 and 999999 union "
    "select l.event_id, l.child from l join h on l.event_id = h.event_id and l.mother = h.idx where not (abs(mpid) <= 6 or abs(mpid) = 21)), "
    "b as (select event_id, abs(cpid) as flavor, child as idx from l where mpid in (23, -23, 24, -24) and abs(cpid) in (11, 13) union "
    "select l.event_id, b.flavor, l.child from l join b on l.event_id = b.event_id and l.mother = b.idx where abs(mpid) = b.flavor and abs(cpid) = b.flavor) "
    "select count(*) as leptons, count(*) filter (where h.idx is null and b.idx is not null) as eligible from p "
    "left join (select distinct event_id, idx from h) h on p.event_id = h.event_id and p.idx = h.idx "
    "left join (select distinct event_id, idx from b) b on p.event_id = b.event_id and p.idx = b.idx where abs(pid) in (11, 13)",
)
def origin_eligibility(spark, sf):
    flags = ancestry.origin_flags(_tree(spark, sf))
    return flags.agg(
        F.count("*").alias("leptons"), F.expr(f"count_if({ancestry.eligible(boson=True)}) as eligible")
    )


