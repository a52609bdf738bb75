"""Data-quality rules as DataFrames.

A rule yields one row per violation: (rule, subject, observed, expected).
Rules can be unioned, stored, inspected, or enforced with `enforce`.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..conventions import (
    EPS,
    JOB_KEY,
    NOMINAL_UNITS,
    NORMALIZATION_CONTRACT,
    WEIGHTING_STRATEGY,
)
from ..functions.numeric import Sql, close, num
from ..functions.statistics import mean_error, moments_consistent
from ..session import cut

Findings = DataFrame
SCHEMA = "rule string, subject string, observed string, expected string"


class AuditError(ValueError):
    """Raised by `enforce` when at least one rule is violated."""


def findings(
    bad: DataFrame, rule: str, keys: Sequence[str], observed: Sql, expected: Sql
) -> Findings:
    """Turn violating rows into findings; the subject renders the key columns."""
    subject = "concat_ws('/', " + ", ".join(f"cast({k} as string)" for k in keys) + ")" if keys else "'*'"
    return bad.selectExpr(
        f"'{rule}' as rule",
        f"{subject} as subject",
        f"cast({observed} as string) as observed",
        f"cast({expected} as string) as expected",
    )


def rules(
    df: DataFrame, keys: Sequence[str], checks: Mapping[str, tuple[Sql, Sql, Sql]]
) -> Findings:
    """Many row rules in one pass: name -> (must hold, observed, expected).

    A condition that is NULL counts as violated.
    """
    subject = "concat_ws('/', " + ", ".join(f"cast({k} as string)" for k in keys) + ")" if keys else "'*'"
    packed = ", ".join(
        f"if(coalesce({ok}, false), null, named_struct('rule', '{name}', "
        f"'observed', cast({seen} as string), 'expected', cast({want} as string)))"
        for name, (ok, seen, want) in checks.items()
    )
    return (
        df.selectExpr(f"{subject} as subject", f"explode(array({packed})) as v")
        .where("v is not null")
        .selectExpr("v.rule as rule", "subject", "v.observed as observed", "v.expected as expected")
    )


def combine(*parts: Findings) -> Findings:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def enforce(found: Findings, limit: int = 5) -> None:
    """Raise with a few examples if there is any finding."""
    sample = found.take(limit)
    if sample:
        text = "; ".join(
            f"{r.rule} [{r.subject}]: observed {r.observed}, expected {r.expected}" for r in sample
        )
        raise AuditError(text)


# --------------------------------------------------------------------------
# schema and uniqueness
# --------------------------------------------------------------------------
def schema_differences(actual: T.StructType, expected: T.StructType) -> list[tuple[str, str, str]]:
    """(column, observed type, expected type); order differences show as '#position'."""
    have = {f.name: f.dataType.simpleString() for f in actual}
    want = {f.name: f.dataType.simpleString() for f in expected}
    out = [(n, "absent", t) for n, t in want.items() if n not in have]
    out += [(n, t, "absent") for n, t in have.items() if n not in want]
    out += [(n, have[n], want[n]) for n in want if n in have and have[n] != want[n]]
    if not out and list(have) != list(want):
        out = [
            (f"#{i}", a, b) for i, (a, b) in enumerate(zip(have, want)) if a != b
        ]
    return out


def schema_findings(df: DataFrame, expected: T.StructType, label: str) -> Findings:
    rows = [("schema", f"{label}.{n}", a, b) for n, a, b in schema_differences(df.schema, expected)]
    return df.sparkSession.createDataFrame(rows, SCHEMA)


def required_columns(df: DataFrame, required: Sequence[str], label: str) -> Findings:
    """Retention rule: collections and leaves that must be present."""
    have = set(leaf_names(df.schema))
    rows = [("retention", f"{label}.{c}", "absent", "present") for c in required if c not in have]
    return df.sparkSession.createDataFrame(rows, SCHEMA)


def leaf_names(schema: T.StructType, prefix: str = "") -> list[str]:
    out = []
    for f in schema:
        name = f"{prefix}{f.name}"
        out.append(name)
        kind = f.dataType
        if isinstance(kind, T.ArrayType):
            kind = kind.elementType
        if isinstance(kind, T.StructType):
            out += leaf_names(kind, f"{name}.")
    return out


def unique(df: DataFrame, keys: Sequence[str], rule: str) -> Findings:
    dup = df.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")
    return findings(dup, rule, keys, "n", "1")


def row_count(df: DataFrame, expected: int, rule: str = "retention.count") -> Findings:
    return rules(df.agg(F.count("*").alias("n")), [], {rule: (f"n = {int(expected)}", "n", str(int(expected)))})


# --------------------------------------------------------------------------
# declared values across stages
# --------------------------------------------------------------------------
def declared_equal(
    long: DataFrame, keys: Sequence[str] = ("job_id",), *, among: Sequence[str] | None = None
) -> Findings:
    """One job must declare one value per metadata key in all its stages.

    `long` has the columns job, stage, key, value. Distinct values are removed
    per key before anything is gathered, so a finding lists a handful of
    strings whatever the number of rows.
    """
    df = long if among is None else long.where(F.col("key").isin(list(among)))
    spread = (
        df.groupBy(*keys, "key", "value")
        .agg(F.min("stage").alias("stage"))
        .groupBy(*keys, "key")
        .agg(
            F.count("*").alias("n"),
            F.min(F.struct("value", "stage")).alias("lo"),
            F.max(F.struct("value", "stage")).alias("hi"),
        )
        .where("n > 1")
    )
    return findings(
        spread, "stage.equal", [*keys, "key"],
        "concat(hi.stage, '=', hi.value)", "concat(lo.stage, '=', lo.value)",
    )


def expected_values(long: DataFrame, wanted: Mapping[tuple[str, str], str]) -> Findings:
    """Required constants: every job's (stage, key) must equal the given text."""
    asked_text = ", ".join(
        f"named_struct('stage', '{s}', 'key', '{k}', 'want', '{v}')" for (s, k), v in wanted.items()
    )
    asked = long.select("job_id").distinct().selectExpr("job_id", f"inline(array({asked_text}))")
    seen = asked.join(long, ["job_id", "stage", "key"], "left")
    return findings(
        seen.where("value is null or value <> want"), "stage.constant",
        ["job_id", "stage", "key"], "coalesce(value, 'absent')", "want",
    )


def _field_tree(paths: Sequence[str]) -> dict | None:
    """Dotted paths as nested names; None if one is no plain path or lies inside another."""
    tree: dict = {}
    for path in dict.fromkeys(paths):
        *up, leaf = path.split(".")
        if not all(re.fullmatch("[A-Za-z_][A-Za-z0-9_]*", name) for name in (*up, leaf)):
            return None
        node = tree
        for name in up:
            node = node.setdefault(name, {})
            if node is None:
                return None
        if leaf in node:
            return None
        node[leaf] = None
    return tree


def _path_values(document: str, paths: Sequence[str]) -> tuple[Sql, Sql]:
    """(what is to stand as `_v`, expression over it: the JSON texts at the paths, null where absent).

    A lookup in a variant searches the names on every level again, for every
    path. Where all paths are plain, one pass over the text picks up all of
    them; documents that do not fit the tree of paths are looked up path by
    path, and broken ones raise as `parse_json` does.
    """
    looked_up = "array(" + ", ".join(f"to_json(try_variant_get(_d, '$.{p}', 'variant'))" for p in paths) + ")"
    slow = f"transform(array(parse_json({document})), _d -> {looked_up})[0]"
    tree = _field_tree(paths)
    if not tree:
        return "null", slow

    def kind(node: dict | None) -> str:
        return "variant" if node is None else "struct<" + ", ".join(f"`{k}`: {kind(v)}" for k, v in node.items()) + ">"

    misfit = "_misfit"
    while misfit in tree:
        misfit += "_"
    schema = kind(tree)[:-1] + f", `{misfit}`: string>"
    strict = f"map('columnNameOfCorruptRecord', '{misfit}', 'allowSingleQuotes', 'false', 'allowNonNumericNumbers', 'false')"
    read = "array(" + ", ".join(f"to_json(_v.{p})" for p in paths) + ")"
    fits = f"{document} is null or (_v is not null and _v.{misfit} is null)"
    return f"from_json({document}, '{schema}', {strict})", f"if({fits}, {read}, {slow})"


def fingerprint(
    metadata: DataFrame, required: Sequence[str], optional: Sequence[str], *,
    document: str = "document", job: str = "job_id",
) -> tuple[DataFrame, Findings]:
    """Long fingerprint (job, path, present, value) and its violations.

    Presence is part of the fingerprint: an absent optional path differs from
    one that holds null. Documents are read once. Jobs should agree, so any one
    document is read ahead, and the others leave only what they hold otherwise
    and the required paths they lack.
    """
    paths = [*required, *optional]
    parsed, values = _path_values(document, paths)
    read = metadata.selectExpr(job, document, f"{parsed} as _v").selectExpr(job, f"{values} as _values")
    names = F.array(*[F.struct(F.lit(p).alias("path"), F.lit(k < len(required)).alias("required")) for k, p in enumerate(paths)])
    named = [F.get(names, F.col("_k"))["path"].alias("path"), F.get(names, F.col("_k"))["required"].alias("required"), F.col("value").isNotNull().alias("present"), "value"]
    long = read.select(job, F.posexplode("_values").alias("_k", "value")).select(job, *named)

    ahead = read.select("_values").first()
    held = F.array(*[F.lit(v).cast("string") for v in (ahead[0] if ahead else [None] * len(paths))])
    lacks = lambda c: (c["k"] < len(required)) & c["value"].isNull()
    cells = F.transform("_values", lambda v, k: F.struct(k.alias("k"), v.alias("value")))
    other = F.filter(cells, lambda c: ~c["value"].eqNullSafe(F.get(held, c["k"])) | lacks(c))
    left = read.select(job, F.explode(other).alias("c")).select(job, F.col("c.k").alias("_k"), F.col("c.value").alias("value")).select(job, *named)
    lost = F.col("required") & ~F.col("present")
    seen = cut(left.groupBy("path", "present", "value", lost.alias("lost"), F.when(lost, F.col(job)).alias(job)).agg(F.count("*").alias("times")))
    # a job that comes twice misses its path twice
    missing = findings(
        seen.where("lost").selectExpr(job, "path", "explode(array_repeat(0, int(times)))"),
        "fingerprint.missing", [job, "path"], "'absent'", "'present'",
    )
    first = metadata.sparkSession.range(1 if ahead else 0).select(F.posexplode(held).alias("_k", "value")).select(*named)
    spread = (
        seen.select("path", "present", "value").unionByName(first.select("path", "present", "value")).distinct()
        .groupBy("path")
        .agg(
            F.count("*").alias("n"),
            F.min(F.struct(F.expr("coalesce(value, 'absent') as v"))).alias("lo"),
            F.max(F.struct(F.expr("coalesce(value, 'absent') as v"))).alias("hi"),
        )
        .where("n > 1")
    )
    return long, missing.unionByName(
        findings(spread, "fingerprint.differs", ["path"], "hi.v", "lo.v")
    )


# --------------------------------------------------------------------------
# normalization
# --------------------------------------------------------------------------
def contract_rules(contract: DataFrame, keys: Sequence[str] = JOB_KEY, rtol: float = 1e-12) -> Findings:
    """Recompute everything a normalization contract row declares."""
    n, a = "generated_lhe_events", "accepted_lhe_events"

    def same(c: Sql, want: Sql) -> tuple[Sql, Sql, Sql]:
        # NULL and NaN both stand for "undefined"
        u = f"({want})"
        undefined = f"({u} is null or isnan({u}))"
        ok = f"if({undefined}, {c} is null or isnan({c}), {close(c, u, rtol, rtol)})"
        return ok, c, u

    error = lambda which: mean_error(f"sumw_{which}", f"sumw2_{which}", n)
    # job rows carry no rejected counts, contract documents do
    rejected = [c for c in ("rejected_below_m4l", "rejected_above_m4l") if c in contract.columns]
    relation = f"{n} = {' + '.join([a, *rejected])}" if rejected else f"{n} >= {a}"
    return rules(
        contract,
        keys,
        {
            "contract.counts": (
                f"{relation} and {n} > 0 and {a} >= 0", f"concat_ws('+', {', '.join([a, *rejected])})", n,
            ),
            "contract.moments.generated": (
                f"sumw2_generated >= 0D and {moments_consistent('sumw_generated', 'sumw2_generated', n)}",
                "sumw2_generated", f"sumw_generated * sumw_generated / {n}",
            ),
            "contract.moments.accepted": (
                f"sumw2_accepted >= 0D and sumw2_accepted <= sumw2_generated + 1e-12D * greatest(sumw2_generated, 1D) "
                f"and {moments_consistent('sumw_accepted', 'sumw2_accepted', n)}",
                "sumw2_accepted", "sumw2_generated",
            ),
            "contract.absolute": (
                "sumabsw_generated >= 0D and sumabsw_accepted between 0D and sumabsw_generated "
                "and abs(sumw_generated) <= sumabsw_generated * (1D + 1e-12D)",
                "sumabsw_accepted", "sumabsw_generated",
            ),
            "contract.count_efficiency": same("count_efficiency", f"try_divide(double({a}), double({n}))"),
            "contract.signed_efficiency": same("signed_efficiency", "try_divide(sumw_accepted, sumw_generated)"),
            "contract.absolute_efficiency": same(
                "absolute_efficiency", "try_divide(sumabsw_accepted, sumabsw_generated)"
            ),
            "contract.inclusive": same("inclusive_cross_section_pb", f"try_divide(sumw_generated, double({n}))"),
            "contract.inclusive_error": same("inclusive_cross_section_mc_error_pb", error("generated")),
            "contract.filtered": same("filtered_cross_section_pb", f"try_divide(sumw_accepted, double({n}))"),
            "contract.filtered_error": same("filtered_cross_section_mc_error_pb", error("accepted")),
        },
    )


def contract_constants(long: DataFrame) -> Findings:
    """The declared normalization contract must be the supported one."""
    return expected_values(
        long,
        {
            ("lhe_contract", "normalization_contract"): NORMALIZATION_CONTRACT,
            ("lhe_contract", "nominal_weight_units"): NOMINAL_UNITS,
            ("lhe_contract", "lhe_weighting_strategy"): str(WEIGHTING_STRATEGY),
        },
    )


def summary_rules(
    recomputed: DataFrame, declared: DataFrame, *, keys: Sequence[str] = JOB_KEY,
    exact: Sequence[str], close_columns: Sequence[str], rtol: float = 1e-11, atol: float = 1e-13,
) -> Findings:
    """Declared job rows against values recomputed from the events.

    Counts must agree exactly, sums within tolerance; jobs present on one side
    only are findings too.
    """
    names = [*exact, *close_columns]
    want = declared.select(*keys, *[F.col(c).alias(f"_want_{c}") for c in names], F.lit(True).alias("_d"))
    have = recomputed.select(*keys, *names, F.lit(True).alias("_r"))
    both = have.join(want, list(keys), "full_outer")
    checks = {"runs.present": ("_d and _r", "if(_r, 'events', 'no events')", "if(_d, 'run row', 'no run row')")}
    for c in exact:
        checks[f"runs.{c}"] = (f"_d is null or _r is null or {c} = _want_{c}", c, f"_want_{c}")
    for c in close_columns:
        checks[f"runs.{c}"] = (
            f"_d is null or _r is null or {close(c, f'_want_{c}', rtol, atol)}", c, f"_want_{c}",
        )
    return rules(both, keys, checks)


def campaign_rules(runs: DataFrame) -> Findings:
    """One campaign and sample, unique job keys, positive and unique seeds."""
    one = runs.agg(
        F.expr("min(campaign_id) as c0"), F.expr("max(campaign_id) as c1"),
        F.expr("min(sample_code) as s0"), F.expr("max(sample_code) as s1"),
    )
    parts = [
        rules(one, [], {
            "campaign.single": ("c0 = c1", "c1", "c0"),
            "sample.single": ("s0 = s1", "s1", "s0"),
        }),
        unique(runs, JOB_KEY, "job.unique"),
    ]
    for seed in ("generation_seed", "delphes_seed"):
        if seed in runs.columns:
            parts.append(findings(runs.where(f"not ({seed} > 0)"), f"{seed}.positive", JOB_KEY, seed, "'positive'"))
            parts.append(unique(runs, [seed], f"{seed}.unique"))
    if "content_sha256" in runs.columns:
        parts.append(unique(runs, ["content_sha256"], "input.distinct"))
    return combine(*parts)


def signed_sum_rules(sums: DataFrame) -> Findings:
    """A pooled scale exists: the signed sum is resolved and has the right sign.

    Reads retained_raw_sumw_pb, retained_raw_sumabsw_pb and
    filtered_cross_section_pb.
    """
    s, a, x = "retained_raw_sumw_pb", "retained_raw_sumabsw_pb", "filtered_cross_section_pb"
    return rules(sums, [], {
        "sum.finite": (f"{s} - {s} = 0D and {s} <> 0D", s, "'finite and nonzero'"),
        "sum.absolute": (f"{a} - {a} = 0D and {a} > 0D", a, "'finite and positive'"),
        "sum.resolved": (f"abs({s}) > 1e-12D * {a}", s, f"1e-12D * {a}"),
        "sum.sign": (f"{x} * {s} >= 0D", s, x),
        "scale.usable": (
            f"try_divide({x}, {s}) - try_divide({x}, {s}) = 0D and try_divide({x}, {s}) <> 0D",
            f"try_divide({x}, {s})", "'finite and nonzero'",
        ),
    })


def nominal_tolerance(expected: Sql, scale: Sql, sumabsw: Sql) -> Sql:
    """Cancellation-aware closure tolerance of the scaled signed sum."""
    return (
        f"greatest(1e-11D * greatest(abs({expected}), 1D), {num(16 * EPS)} * abs({scale}) * {sumabsw})"
    )


def component_tolerance(expected: Sql, sumabsw: Sql) -> Sql:
    return (
        f"greatest(1e-11D * greatest(abs({expected}), 1D), {num(32 * EPS)} * greatest({sumabsw}, 1D))"
    )


# --------------------------------------------------------------------------
# event tables
# --------------------------------------------------------------------------
def mask_rules(events: DataFrame, keys: Sequence[str], levels: Sequence[str] = ("lhe", "dressed", "reco")) -> Findings:
    """Masks agree with each other and with the values they describe."""
    return rules(events, keys, mask_checks(events.columns, levels))


def mask_checks(columns: Sequence[str], levels: Sequence[str] = ("lhe", "dressed", "reco")) -> dict[str, tuple[Sql, Sql, Sql]]:
    checks: dict[str, tuple[Sql, Sql, Sql]] = {}
    for level in levels:
        p, c = f"{level}_projection_valid", f"{level}_candidate"
        angles = " + ".join(f"({level}_{a} - {level}_{a})" for a in ("theta1", "phi1", "theta2", "phi2"))
        checks[f"mask.{level}.candidate"] = (f"not {p} or {c}", p, c)
        checks[f"mask.{level}.angles"] = (f"not {p} or {angles} = 0D", f"{level}_theta1", "'finite'")
    if "reconstructed" in columns:
        checks["mask.reconstructed"] = (
            "reconstructed = reco_pass_selection", "reconstructed", "reco_pass_selection",
        )
    for c in ("has_lhe", "has_hepmc", "has_delphes"):
        if c in columns:
            checks[f"mask.{c}"] = (c, c, "true")
    return checks


def weight_rules(events: DataFrame, keys: Sequence[str], weights: Sequence[str]) -> Findings:
    """Weights are finite and their squares do not overflow."""
    return rules(events, keys, weight_checks(weights))


def weight_checks(weights: Sequence[str]) -> dict[str, tuple[Sql, Sql, Sql]]:
    return {f"weight.{w}": (f"{w} * {w} - {w} * {w} = 0D", w, "'finite square'") for w in weights}


def broken(checks: Mapping[str, tuple[Sql, Sql, Sql]]) -> Sql:
    """Number of rules a row breaks: summed up in a pass that is made anyway, it says which groups need a closer look."""
    return " + ".join(f"int(not coalesce({ok}, false))" for ok, _, _ in checks.values())


def constant_rules(events: DataFrame, columns: Sequence[str], positive: Sequence[str] = ()) -> Findings:
    """Columns that must hold one value over the whole table."""
    one = events.agg(*[
        F.expr(e) for c in columns for e in (f"min({c}) as lo_{c}", f"max({c}) as hi_{c}")
    ])
    checks = {f"constant.{c}": (f"lo_{c} = hi_{c}", f"hi_{c}", f"lo_{c}") for c in columns}
    for c in positive:
        checks[f"positive.{c}"] = (
            f"lo_{c} > 0D and hi_{c} - hi_{c} = 0D", f"lo_{c}", "'finite and positive'",
        )
    return rules(one, [], checks)


def topology_floor(summary: DataFrame, keys: Sequence[str] = JOB_KEY) -> Findings:
    """Each job needs at least one valid generator and dressed candidate and projection."""
    return rules(summary, keys, {
        f"floor.{level}.{kind}": (f"{level}_{kind}_count > 0", f"{level}_{kind}_count", "'at least 1'")
        for level in ("lhe", "dressed") for kind in ("candidate", "projection_valid")
    })


def exact_dressed(df: DataFrame, keys: Sequence[str], electrons: str = "dressed_electron", muons: str = "dressed_muon") -> Findings:
    """Exactly e- e+ mu- mu+ among the dressed leptons of every event."""
    n = lambda c, pid: f"size(filter({c}, p -> p.pid = {pid}))"
    ok = (
        f"size({electrons}) = 2 and size({muons}) = 2 and {n(electrons, 11)} = 1 and "
        f"{n(electrons, -11)} = 1 and {n(muons, 13)} = 1 and {n(muons, -13)} = 1"
    )
    seen = f"concat_ws(',', size({electrons}), size({muons}))"
    return rules(df, keys, {"dressed.exact_2e2mu": (ok, seen, "'e- e+ mu- mu+'")})


def uid_rules(events: DataFrame, tag: bytes) -> Findings:
    """Stored identities equal the ones recomputed from the logical key."""
    from ..functions.identity import uid_function

    fn = uid_function(tag)
    again = events.withColumn("_uid", fn("campaign_id", "sample_code", "job_id", "source_event_id"))
    return rules(again, ["job_id", "source_event_id"], {
        "uid.stored": (
            "event_uid_hi = _uid.hi and event_uid_lo = _uid.lo",
            "concat_ws(':', event_uid_hi, event_uid_lo)", "concat_ws(':', _uid.hi, _uid.lo)",
        )
    })


def truth_weight_rules(events: DataFrame, keys: Sequence[str], weight: str = "weight_nominal_pb") -> Findings:
    """Stored projector weights equal weight times projector on valid rows."""
    from ..functions.harmonics import ANGLES, projectors
    from .closure import level_is_valid

    factors = projectors(*[f"lhe_{a}" for a in ANGLES])
    checks = {}
    for slug, f in factors.items():
        c = f"weight_truth_{slug}_pb"
        want = f"({weight} * {f})"
        gap = f"abs({c} - {want})"
        checks[f"truth.{slug}"] = (
            f"{gap} <= 1e-9D * greatest(abs({weight}), abs({want})) and not isnan({gap})", c, want,
        )
    return rules(events.where(level_is_valid("lhe")), keys, checks)


def aligned_weight_rules(events: DataFrame, weights: DataFrame, size: int) -> Findings:
    """Alternative weights are one-to-one with events, of fixed size and finite."""
    from .matching import aligned_weights

    _, no_weight, no_event = aligned_weights(events, weights)
    subject = ["job_id", "source_event_id"]
    shape = rules(weights, subject, {
        "weights.size": (f"size(values) = {int(size)}", "size(values)", str(int(size))),
        "weights.finite": ("forall(values, v -> v - v = 0D)", "values[0]", "'finite'"),
    })
    return combine(
        findings(no_weight, "weights.missing", subject, "'no weights'", "'one row'"),
        findings(no_event, "weights.orphan", subject, "'no event'", "'one event'"),
        unique(weights, subject, "weights.unique"),
        shape,
    )


def ledger_rules(jobs: DataFrame, *, max_job_id: int, max_seed: int, max_event: int, max_events_per_job: int) -> Findings:
    """Campaign ledger: IDs and seeds unique and in range, event intervals disjoint.

    Reads job_id, seed, first_event and events. An interval is compared with
    the furthest end of all that begin before it, or with it under a smaller
    job_id: nested intervals are found as well.
    """
    from .ordering import with_earlier_max

    last = jobs.withColumn("last_event", F.expr("first_event + events - 1"))
    chained = with_earlier_max(last, "first_event", "last_event", tie="job_id", name="previous", width=max(1, max_events_per_job) * 1024)
    return combine(
        unique(jobs, ["job_id"], "ledger.job_id"),
        unique(jobs, ["seed"], "ledger.seed"),
        rules(last, ["job_id"], {
            "ledger.job_range": (f"job_id between 0 and {max_job_id}", "job_id", f"'<= {max_job_id}'"),
            "ledger.seed_range": (f"seed between 1 and {max_seed}", "seed", f"'<= {max_seed}'"),
            "ledger.events_range": (
                f"events between 1 and {max_events_per_job}", "events", f"'<= {max_events_per_job}'",
            ),
            "ledger.event_range": (
                f"first_event >= 1 and last_event <= {max_event}", "last_event", f"'<= {max_event}'",
            ),
        }),
        findings(
            chained.where("previous >= first_event"), "ledger.overlap", ["job_id"],
            "first_event", "previous + 1",
        ),
    )
