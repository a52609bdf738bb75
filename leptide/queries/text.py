"""Text listings, metadata, listings and sinks, on text derived from the tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import bridge
from ..conventions import LEPTONS
from ..functions import identity
from ..session import scratch_path
from ..sinks import lhe_text
from ..sinks import publish as sink
from ..sinks.tables import json_safe
from ..sources import detector, hepmc, lhe, listing, metadata
from . import d, decoded_sql, events, fault_sql, query, r

EV = f"with ev as ({bridge.event_view_sql('events')})"
_CODES = dict(zip(LEPTONS, (11, -11, 13, -13)))
PREAMBLE = (
    "<LesHouchesEvents version=\"3.0\">\n<header>\n</header>\n<init>\n"
    "2212 2212 6.8e3 6.8e3 0 0 0 0 -4 1\n1.5D+01 2.5e-1 1.0 1\n</init>\n"
)


def event_elements(spark, sf):
    """(i, job_id, source_event_id, w, text): each bridge event as an element."""
    p = ", ".join(
        f"named_struct('pdg', {_CODES[k]}, 'status', 1, 'm1', 1, 'm2', 2, 'c1', 0, 'c2', 0, 'px', lhe_raw_{k}_px, "
        f"'py', lhe_raw_{k}_py, 'pz', lhe_raw_{k}_pz, 'e', lhe_raw_{k}_E, 'mass', 0D, 'lifetime', 0D, 'spin', 9D)"
        for k in LEPTONS
    )
    base = events(spark, sf).selectExpr(
        "i", "i % 8 as job_id", "source_event_id", "w", f"array({p}) as particles", "map('1001', 0.9D*w) as weights"
    )
    return base.selectExpr("i", "job_id", "source_event_id", "w", f"{lhe_text.event_text('w')} as text")


@query(
    "S01_S03_P22_event_text_parse",
    EV + " select i, " + d("w", "weight") + ", cast(4 as bigint) as n, source_event_id as comment_id, "
    + decoded_sql("source_event_id*1e0", "1e0") + " as marker_id, "
    + d("0.9e0*w", "alternative") + ", " + d("lhe_raw_electron_minus_px", "em_px") + ", " + d("lhe_raw_muon_plus_E", "mp_e")
    + ", cast(null as varchar) as fault from ev",
)
def event_text(spark, sf):
    tagged = event_elements(spark, sf).selectExpr("i", f"{lhe.tag_event_text()} as text")
    out = lhe.parse_events(tagged)
    return out.selectExpr(
        "i", r("weight", "weight"), "bigint(size(particles)) as n", "source_comment_id as comment_id",
        f"{identity.decode_source_id('weights.AUX_OAP_EVENT_ID', 'weights.AUX_OAP_EVENT_UNIT')} as marker_id",
        r("weights['1001']", "alternative"), r("particles[0].px", "em_px"), r("particles[3].e", "mp_e"), "fault",
    )


@query(
    "S02_K07_lhe_documents",
    EV + " select i % 8 as job, count(*) as n, " + d("sum(w)", "sumw", 4) + ", min(source_event_id) as id_min, max(source_event_id) as id_max from ev group by 1",
)
def lhe_documents(spark, sf):
    """Write complete documents per job and part, read them back event by event."""
    path = scratch_path(spark, "lhe")
    lhe_text.write_lhe_text(
        event_elements(spark, sf).selectExpr("job_id", "source_event_id", f"{lhe.tag_event_text()} as text"), PREAMBLE, path
    )
    parsed = lhe.parse_events(lhe.read_documents(spark, f"{path}/*/*")[0])
    return parsed.selectExpr("bigint(regexp_extract(file, 'job_id=([0-9]+)', 1)) as job", "weight", "source_comment_id as id").groupBy("job").agg(
        F.count("*").alias("n"), F.expr(r("sum(weight)", "sumw", 4)), F.min("id").alias("id_min"), F.max("id").alias("id_max")
    )


@query(
    "S04_init_block",
    "select event_type, cast(-4 as bigint) as idwtup, cast(2 as bigint) as processes, " + d("round(sum(value), 2) + round(sum(value*value), 2)", "cross_section", 2)
    + ", " + d("sqrt(count(*)*count(*)*1e0 + 9e0)", "error") + ", cast(null as varchar) as fault from events group by event_type",
)
def init_block(spark, sf):
    per = bridge.tables(spark, sf, "events").groupBy("event_type").agg(
        F.expr("round(sum(value), 2) as x1"), F.expr("round(sum(value*value), 2) as x2"), F.count("*").alias("n")
    )
    text = (
        "concat('<LesHouchesEvents>\\n<init>\\n2212 2212 6800 6800 0 0 0 0 -4 2\\n', "
        "replace(string(x1), 'E', 'D'), ' ', n, ' 1 1\\n', replace(string(x2), 'E', 'D'), ' 3.0D0 1 2 # second\\n</init>\\n')"
    )
    out = lhe.parse_init(per.selectExpr("event_type", f"{text} as preamble"))
    return out.selectExpr(
        "event_type", "bigint(idwtup) as idwtup", "bigint(size(processes)) as processes",
        r("inclusive_cross_section_pb", "cross_section", 2), r("inclusive_cross_section_error_pb", "error"), "fault",
    )


def _listing(spark, sf):
    """Write one listing per job part and return the path."""
    path = scratch_path(spark, "hepmc")
    names = "'N 4 \"Default\" \"id=1001 scale\" \"id=AUX_AUX_OAP_EVENT_ID_MERGING=0.000\" \"AUX_OAP_EVENT_UNIT_MERGING=0.000\"'"
    ev = events(spark, sf).selectExpr(
        "i % 8 as job_id", "bigint(source_event_id div 16384) as part", "source_event_id as o",
        "concat('E ', source_event_id * 2, ' 0 -1 -1 -1 0 0 1 1 2 2 7 8 4 ', w, ' ', 0.9D*w, ' ', "
        f"double(source_event_id) * (3 + i), ' ', double(3 + i), '\\n', {names}, '\\nU GEV MM') as value",
    )
    head = "HepMC::Version 2.06.09\\nHepMC::IO_GenEvent-START_EVENT_LISTING"
    frame = ev.select("job_id", "part").distinct().selectExpr(
        "job_id", "part",
        f"inline(array(named_struct('o', bigint(-1), 'value', '{head}'), "
        "named_struct('o', bigint(1) << 62, 'value', 'HepMC::IO_GenEvent-END_EVENT_LISTING')))",
    )
    ev.unionByName(frame).repartition("job_id", "part").sortWithinPartitions("job_id", "part", "o").drop("o").write.partitionBy(
        "job_id", "part"
    ).text(path)
    return path


_PAIR = ("source_event_id*1e0*(3+i)", "(3+i)*1e0")  # the markers of a listing


@query(
    "S05_P23_hepmc_listing",
    EV + " select i % 8 as job_id, " + decoded_sql(*_PAIR) + " as source_event_id, cast(null as varchar) as name_fault, " + fault_sql(*_PAIR) + " as id_fault, "
    + d("w", "nominal") + ", 41 + row_number() over (partition by i % 8, source_event_id // 16384 order by source_event_id) - 1 as event_number from ev",
)
def hepmc_listing(spark, sf):
    """Read listings, rename the marker weights, renumber from 41, decode the IDs."""
    ev, _ = hepmc.read_hepmc(spark, f"{_listing(spark, sf)}/*/*")
    out = hepmc.with_source_ids(hepmc.canonicalize(ev, 41))
    return out.selectExpr(
        "bigint(regexp_extract(file, 'job_id=([0-9]+)', 1)) as job_id", "source_event_id", "name_fault", "id_fault",
        r("values[0]", "nominal"), "event_number",
    )


@query(
    "S06_Q21_detector_leaves",
    EV + " select i, " + decoded_sql("source_event_id*1e0*w", "w") + " as source_event_id, " + fault_sql("source_event_id*1e0*w", "w") + " as id_fault, "
    "cast(case when i % 3 = 0 then 1 else 2 end as bigint) as n_electrons, "
    + d("lhe_raw_muon_minus_px", "mm_px") + ", cast(case when i % 31 = 0 then 1 else 0 end as bigint) as bad_leaves from ev",
)
def detector_leaves(spark, sf):
    arr = lambda ks, c: f"array({', '.join(f'lhe_raw_{k}_{c}' for k in ks)})"
    e, m = ("electron_minus", "electron_plus"), ("muon_minus", "muon_plus")
    cut = lambda x: f"if(i % 3 = 0, slice({x}, 1, 1), {x})"
    cols = [
        "array(source_event_id) as `Event.Number`", "array(w) as `Event.Weight`", "array(1D) as `Event.CrossSection`",
        "array(0.1D) as `Event.CrossSectionError`", "array(w, double(source_event_id)*w, w) as `Weight.Weight`",
        f"{cut('array(11, -11)')} as `DressedElectron.PID`",
        *[f"{cut(arr(e, c))} as `DressedElectron.{n}`" for c, n in (("E", "E"), ("px", "Px"), ("py", "Py"), ("pz", "Pz"))],
        "array(13, -13) as `DressedMuon.PID`",
        *[f"{arr(m, c)} as `DressedMuon.{n}`" for c, n in (("E", "E"), ("px", "Px"), ("py", "Py"))],
        f"if(i % 31 = 0, array(0D), {arr(m, 'pz')}) as `DressedMuon.Pz`",
    ]
    for name, q in (("RecoElectron", "array(-1, 1)"), ("RecoMuon", "array(-1, 1)")):
        cols += [f"array(10D, 11D) as `{name}.PT`", f"array(0.5D, -0.5D) as `{name}.Eta`", f"array(1D, 2D) as `{name}.Phi`", f"{q} as `{name}.Charge`"]
    flat = events(spark, sf).selectExpr("job_id", "i", *cols)
    nested, bad = detector.assemble_leaves(flat, keep=("job_id", "i"))
    bad_ids = bad.selectExpr("bigint(split_part(subject, '/', 2)) as i").groupBy("i").agg(F.count("*").alias("bad"))
    out = detector.with_source_ids(nested, 1, 2).join(bad_ids, "i", "left")
    return out.selectExpr(
        "i", "source_event_id", "id_fault", "bigint(size(dressed_electron)) as n_electrons", r("dressed_muon[0].px", "mm_px"),
        "coalesce(bad, 0) as bad_leaves",
    )




@query(
    "S07_S08_key_value_metadata",
    "select event_id // 100 as file, 'k' || (event_id % 100) as key, 'v=' || event_type as value, cast(0 as bigint) as findings from events where event_id % 100 <> 7",
)
def key_value(spark, sf):
    ev = bridge.tables(spark, sf, "events")
    lines = ev.selectExpr(
        "event_id div 100 as file",
        "if(event_id % 100 = 7, '  # a comment', concat(' k', event_id % 100, ' = v=', event_type, ' ')) as value",
    )
    good, bad = metadata.parse_key_value(lines)
    return good.withColumn("findings", bad.agg(F.count("*")).scalar()).select("file", "key", "value", "findings")


@query(
    "S08_typed_values",
    "select event_id, case event_id % 5 when 0 then 'int' when 1 then 'float' when 2 then 'bool' when 3 then 'null' else 'text' end as kind, "
    "case when event_id % 5 = 0 then event_id end as int_value, " + d("case when event_id % 5 = 1 then value end", "float_value")
    + ", case when event_id % 5 = 2 then event_id % 2 = 0 end as bool_value, case when event_id % 5 = 4 then event_type end as text_value from events",
)
def typed_values(spark, sf):
    long = bridge.tables(spark, sf, "events").selectExpr(
        "event_id", "case event_id % 5 when 0 then 'n' when 1 then 'x' else 'other' end as key",
        "case event_id % 5 when 0 then string(event_id) when 1 then string(value) when 2 then if(event_id % 2 = 0, 'True', 'false') "
        "when 3 then 'None' else event_type end as value",
    )
    out, _ = metadata.typed_values(long, integers=["n"], floats=["x"])
    return out.selectExpr("event_id", "kind", "int_value", r("float_value", "float_value"), "bool_value", "text_value")


@query(
    "S09_json_documents",
    "select event_id, cast(json_extract_string(props, '$.k') as bigint) as k, json_extract_string(props, '$.missing') as missing from events",
)
def json_documents(spark, sf):
    return bridge.tables(spark, sf, "events").selectExpr(
        "event_id", f"{metadata.nested('props', 'k', 'bigint')} as k", f"{metadata.nested('props', 'missing')} as missing"
    )


@query(
    "S10_completed_jobs",
    "with f as (select cast(o_custkey as varchar) as directory, case o_orderstatus when 'F' then 'SUCCESS' when 'O' then 'analysis.parquet' else 'log.txt' end as name, o_totalprice from orders), "
    "g as (select directory, count(*) filter (where name='SUCCESS') > 0 as ok, count(*) filter (where name='analysis.parquet') as outputs from f group by 1) "
    "select directory, case when not ok then 'no success marker' when outputs <> 1 then 'needs exactly one output' else 'usable' end as state from g",
)
def completed_jobs(spark, sf):
    files = bridge.tables(spark, sf, "orders").selectExpr(
        "string(o_custkey) as directory", "case o_orderstatus when 'F' then 'SUCCESS' when 'O' then 'analysis.parquet' else 'log.txt' end as name",
        "bigint(o_totalprice) as length", "string(o_orderkey) as path",
    )
    usable, bad = listing.completed_jobs(files, "analysis.parquet")
    return usable.selectExpr("directory", "'usable' as state").unionByName(bad.selectExpr("subject as directory", "observed as state"))


@query("S11_content_fingerprints")
def content_fingerprints(spark, sf):
    """SHA-256 of the given files, hashed on the executors."""
    return listing.content_fingerprints(spark, f"{sf}/*.parquet").selectExpr(
        "regexp_extract(path, '([^/]*)$', 1) as name", "length", "content_sha256"
    )


@query(
    "S12_pruned_scan",
    "select count(*) as n, " + d("sum(value)", "total", 4) + " from events where event_type = 'purchase'",
)
def pruned_scan(spark, sf):
    return bridge.tables(spark, sf, "events").where("event_type = 'purchase'").agg(
        F.count("*").alias("n"), F.expr(r("sum(value)", "total", 4))
    )


@query(
    "K04_json_safe_rows",
    "select job_id, case when x is null then '{\"job_id\":' || job_id || ',\"x\":null}' else '{\"job_id\":' || job_id || ',\"x\":1.5}' end as document from "
    "(select event_id // 100 as job_id, case when (event_id // 100) % 2 = 0 then 1.5e0 end as x from events group by 1, 2) t",
)
def json_rows(spark, sf):
    rows = bridge.tables(spark, sf, "events").selectExpr("event_id div 100 as job_id").distinct().selectExpr(
        "job_id", "if(job_id % 2 = 0, 1.5D, double('NaN')) as x"
    )
    return json_safe(rows).selectExpr("bigint(get_json_object(document, '$.job_id')) as job_id", "document")


@query(
    "K01_K02_K03_K05_publish_and_reread",
    EV + " select job_id, count(*) as n, " + d("sum(w)", "sumw", 4) + ", count(*) as n_weights, " + d("sum(1.1e0*w)", "alt", 4) + " from ev group by job_id",
)
def publish_and_reread(spark, sf):
    """Stage three tables, verify them as read back, publish, read the result."""
    from ..operators import audit

    ev = events(spark, sf).select("sample_code", "job_id", "source_event_id", "w")
    wt = ev.selectExpr("job_id", "source_event_id", "array(0.9D*w, 1.1D*w) as values")
    runs = ev.groupBy("job_id").agg(F.count("*").alias("n"), F.sum("w").alias("sumw"))
    target = scratch_path(spark, "published")

    def verify(t):
        return audit.combine(
            audit.unique(t["Events"], ["job_id", "source_event_id"], "events.unique"),
            audit.aligned_weight_rules(t["Events"], t["LHEWeights"], 2),
            audit.unique(t["Runs"], ["job_id"], "runs.unique"),
        )

    sink.publish(spark, {"Events": ev, "LHEWeights": wt, "Runs": runs}, target, verify)
    back = spark.read.parquet(f"{target}/Runs")
    weights = spark.read.parquet(f"{target}/LHEWeights").groupBy("job_id").agg(
        F.count("*").alias("n_weights"), F.expr("sum(values[1]) as alt")
    )
    return back.join(weights, "job_id").selectExpr("job_id", "n", r("sumw", "sumw", 4), "n_weights", r("alt", "alt", 4))


