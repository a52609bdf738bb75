"""Combine four polarized samples with constant coefficients."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..conventions import (
    ANALYSIS_SCHEMA_VERSION,
    CHANNEL_CODES,
    CHANNELS,
    COMBINATION_COEFFICIENTS,
    COMPONENT_WEIGHT_COLUMNS,
    COMPONENTS,
    COMPOSITION_SCHEMA_VERSION,
    NORMALIZATION_CONTRACT,
    SAMPLE_CODES,
    WEIGHTING_STRATEGY,
)
from ..functions.numeric import Sql, num
from ..operators import audit

SOURCE_CODE = "source_polarization_code"


class Composition(NamedTuple):
    events: DataFrame
    sources: DataFrame  # four rows
    summary: DataFrame  # one row
    findings: DataFrame


def coefficient(component: str, code: Sql = SOURCE_CODE) -> Sql:
    """Coefficient of the row's channel: a four-way constant, no join needed."""
    cases = " ".join(
        f"when {CHANNEL_CODES[c]} then {num(COMBINATION_COEFFICIENTS[component][c])}" for c in CHANNELS
    )
    return f"(case {code} {cases} end)"


def union_channels(samples: dict[str, DataFrame]) -> DataFrame:
    """The four samples one after another, source columns unchanged."""
    if tuple(sorted(samples)) != tuple(sorted(CHANNELS)):
        raise ValueError(f"exactly the channels {CHANNELS} are required")
    out = None
    for name in CHANNELS:
        part = samples[name].withColumn(SOURCE_CODE, F.lit(CHANNEL_CODES[name]).cast("tinyint"))
        out = part if out is None else out.unionByName(part)
    return out


def component_columns(events: DataFrame, weight: str = "weight_nominal_pb") -> DataFrame:
    """Append the three coefficients and the three component weights."""
    return events.selectExpr(
        "*",
        *[f"{coefficient(s)} as polarization_coefficient_{s}" for s in COMPONENTS],
        *[f"{weight} * {coefficient(s)} as {COMPONENT_WEIGHT_COLUMNS[s]}" for s in COMPONENTS],
    )


def component_totals(events: DataFrame) -> DataFrame:
    """One row: signed, squared, absolute sums and sign counts per component."""
    out = [F.count("*").alias("event_count")]
    for s in COMPONENTS:
        w = COMPONENT_WEIGHT_COLUMNS[s]
        out += [
            F.expr(f"sum({w}) as sumw_{s}_pb"),
            F.expr(f"sum({w} * {w}) as sumw2_{s}_pb2"),
            F.expr(f"sum(abs({w})) as sumabsw_{s}_pb"),
            F.expr(f"count_if({w} > 0 and not isnan({w})) as positive_weight_count_{s}"),
            F.expr(f"count_if({w} < 0) as negative_weight_count_{s}"),
            F.expr(f"count_if({w} = 0) as zero_weight_count_{s}"),
        ]
    return events.agg(*out)


def source_rows(summaries: DataFrame) -> DataFrame:
    """Four rows with cross section, coefficient and contribution per component.

    `summaries` holds the merge summaries plus source_polarization_code.
    """
    x = "effective_filtered_cross_section_pb"
    return summaries.selectExpr(
        f"{COMPOSITION_SCHEMA_VERSION} as schema_version", SOURCE_CODE, "campaign_id", "sample_code",
        "event_count", "source_job_count", f"{x} as source_cross_section_pb",
        "effective_filtered_cross_section_mc_error_pb as source_cross_section_mc_error_pb",
        *[
            e
            for s in COMPONENTS
            for e in (f"{coefficient(s)} as coefficient_{s}", f"{coefficient(s)} * {x} as contribution_{s}_pb")
        ],
    )


def composition_summary(totals: DataFrame, sources: DataFrame) -> DataFrame:
    """Component sums against the sum of coefficient times cross section."""
    expected = sources.agg(
        F.expr("max(campaign_id) as campaign_id"),
        F.expr("count(*) as input_file_count"),
        F.expr("sum(source_job_count) as source_job_count"),
        *[F.expr(f"sum(contribution_{s}_pb) as expected_integral_{s}_pb") for s in COMPONENTS],
    )
    names = expected.columns
    row = totals.withColumns({c: expected.select(c).scalar() for c in names})
    return row.selectExpr(
        f"{COMPOSITION_SCHEMA_VERSION} as schema_version",
        f"{ANALYSIS_SCHEMA_VERSION} as analysis_schema_version",
        "input_file_count", "source_job_count", "campaign_id", "event_count",
        f"{len(COMPONENTS)} as component_count",
        *[
            e
            for s in COMPONENTS
            for e in (
                f"sumw_{s}_pb", f"sumw2_{s}_pb2", f"sumabsw_{s}_pb", f"expected_integral_{s}_pb",
                f"sumw_{s}_pb - expected_integral_{s}_pb as closure_residual_{s}_pb",
                f"{audit.component_tolerance(f'expected_integral_{s}_pb', f'sumabsw_{s}_pb')} as closure_tolerance_{s}_pb",
                f"positive_weight_count_{s}", f"negative_weight_count_{s}", f"zero_weight_count_{s}",
            )
        ],
    )


def source_contract(metadata: DataFrame) -> DataFrame:
    """Rules on the four source declarations (one row per channel).

    Reads channel, sample_code, frame, z1_decay, z2_decay, interference,
    me_frame, normalization_contract, idwtup, process_card_sha256 and
    common_fingerprint.
    """
    codes = " ".join(f"when channel = '{c}' then {SAMPLE_CODES[f'vpolar_{c}']}" for c in CHANNELS)
    plain = lambda c: f"lower(translate({c}, '+-', ''))"
    frames = "('four_lepton_rest_frame', 'four_lepton_rest_frame_me_frame_3_4_5_6')"
    per_row = audit.rules(metadata, ["channel"], {
        "source.channel": (f"channel in {CHANNELS}", "channel", "'LL, TT, TL or LT'"),
        "source.sample_code": (f"sample_code = case {codes} end", "sample_code", f"case {codes} end"),
        "source.z1": (f"{plain('z1_decay')} in ('mumu', 'muonmuon')", "z1_decay", "'mumu'"),
        "source.z2": (f"{plain('z2_decay')} in ('ee', 'electronelectron')", "z2_decay", "'ee'"),
        "source.interference": (
            "lower(interference) in ('none', 'absent', 'incoherent', 'excluded') or "
            "(channel in ('LL', 'TT') and lower(interference) = 'not_applicable')",
            "interference", "'excluded'",
        ),
        "source.frame": (f"frame in {frames}", "frame", "'four_lepton_rest_frame'"),
        "source.me_frame": ("translate(me_frame, '[] ', '') = '3,4,5,6'", "me_frame", "'3,4,5,6'"),
        "source.contract": (
            f"normalization_contract = '{NORMALIZATION_CONTRACT}' and idwtup = {WEIGHTING_STRATEGY}",
            "normalization_contract", f"'{NORMALIZATION_CONTRACT}'",
        ),
    })
    one = metadata.agg(
        F.expr("count(*) as n"), F.expr("count(distinct channel) as channels"),
        F.expr("count(distinct campaign_id) as campaigns"),
        F.expr("count(distinct process_card_sha256) as cards"),
        F.expr("count(distinct common_fingerprint) as fingerprints"),
    )
    return audit.combine(per_row, audit.rules(one, [], {
        "source.complete": ("n = 4 and channels = 4", "n", "4"),
        "source.campaign": ("campaigns = 1", "campaigns", "1"),
        "source.cards": ("cards = n", "cards", "n"),
        "source.common": ("fingerprints = 1", "fingerprints", "1"),
    }))


def source_sums(events: DataFrame, runs: DataFrame, summaries: DataFrame) -> DataFrame:
    """Counts and sums must agree across events, job rows and merge summary.

    All three carry source_polarization_code.
    """
    from ..operators.moments import weight_aggregates

    e = events.groupBy(SOURCE_CODE).agg(
        F.expr("count(*) as events_e"), F.expr("sum(weight_nominal_pb) as nominal_e"),
        F.expr("sum(abs(weight_nominal_pb)) as nominal_abs_e"), *weight_aggregates("weight_lhe", "_e"),
    )
    names = ("sumw", "sumw2", "sumabsw", "positive_weight_count", "negative_weight_count", "zero_weight_count")
    r = runs.groupBy(SOURCE_CODE).agg(F.sum("event_count").alias("events_r"), *[F.sum(c).alias(f"{c}_r") for c in names])
    both = e.join(r, SOURCE_CODE, "full_outer").join(summaries, SOURCE_CODE, "full_outer")
    tol = "greatest(abs(sumabsw_r), 1D)"
    checks = {
        "source.events": ("events_e = events_r and events_e = event_count", "events_e", "events_r"),
        "source.nominal": (
            "abs(nominal_e - effective_filtered_cross_section_pb) <= 1e-11D * greatest(nominal_abs_e, 1D)",
            "nominal_e", "effective_filtered_cross_section_pb",
        ),
        "source.scale": (
            "abs(merged_weight_scale - try_divide(effective_filtered_cross_section_pb, sumw_e)) <= "
            "1e-11D * greatest(abs(merged_weight_scale), 1D)",
            "merged_weight_scale", "try_divide(effective_filtered_cross_section_pb, sumw_e)",
        ),
    }
    for c in names[:3]:
        checks[f"source.{c}"] = (f"abs({c}_e - {c}_r) <= 1e-11D * {tol}", f"{c}_e", f"{c}_r")
    for c in names[3:]:
        checks[f"source.{c}"] = (f"{c}_e = {c}_r and {c}_e = {c}", f"{c}_e", f"{c}_r")
    return audit.rules(both, [SOURCE_CODE], checks)


def sources_repooled(events: DataFrame, runs: DataFrame, summaries: DataFrame) -> DataFrame:
    """Findings of merged sources: run rows pooled anew against the summaries, and all three tables against each other.

    runs carry source_polarization_code and the normalization columns,
    summaries one row a source. Ratios come from the pooled sums, never from
    the jobs' own ratios.
    """
    from ..operators.moments import pool
    from .merge_campaign import EFFECTIVE, NORMALIZATION

    fresh = pool(runs.withColumnsRenamed(NORMALIZATION), keys=[SOURCE_CODE])
    names = {**NORMALIZATION, **EFFECTIVE}
    stated = summaries.select(SOURCE_CODE, *[F.col(c).alias(f"_{n}") for c, n in names.items()])
    both = fresh.join(stated, SOURCE_CODE, "full_outer")
    checks = {}
    for n in names.values():
        same = f"{n} = _{n}" if n.endswith("_events") else f"(isnan({n}) and isnan(_{n})) or abs({n} - _{n}) <= 1e-11D * greatest(abs({n}), abs(_{n}))"
        checks[f"repool.{n}"] = (same, f"_{n}", n)
    return audit.combine(audit.rules(both, [SOURCE_CODE], checks), source_sums(events, runs, summaries))


def compose_channels(
    samples: dict[str, DataFrame], summaries: dict[str, DataFrame], *, check: bool = True
) -> Composition:
    """Union the channels, weight the components, check the integrals."""
    events = component_columns(union_channels(samples))
    sources = source_rows(union_channels(summaries))
    summary = composition_summary(component_totals(events), sources)
    checks = {
        f"composition.{s}": (
            f"abs(closure_residual_{s}_pb) <= closure_tolerance_{s}_pb",
            f"closure_residual_{s}_pb", f"closure_tolerance_{s}_pb",
        )
        for s in COMPONENTS
    }
    found = audit.combine(
        audit.rules(summary, [], checks),
        audit.unique(sources, [SOURCE_CODE], "source.once"),
    )
    if check:
        audit.enforce(found)
    return Composition(events, sources, summary, found)


def verify_composed(written: dict[str, DataFrame]) -> DataFrame:
    """Rules on the composed tables as read back."""
    events, sources, summary = (
        written[n] for n in ("Events", "PolarizationSources", "PolarizationCombinationSummary")
    )
    checks = {}
    for s in COMPONENTS:
        c, w = f"polarization_coefficient_{s}", COMPONENT_WEIGHT_COLUMNS[s]
        checks[f"written.coefficient.{s}"] = (f"{c} = {coefficient(s)}", c, coefficient(s))
        checks[f"written.weight.{s}"] = (f"{w} = weight_nominal_pb * {c}", w, f"weight_nominal_pb * {c}")
    counted = summary.withColumns({
        "_events": events.agg(F.count("*")).scalar(),
        "_declared": sources.agg(F.sum("event_count")).scalar(),
    })
    fresh = composition_summary(component_totals(events), sources)
    closure = {
        f"written.{s}": (
            f"abs(closure_residual_{s}_pb) <= closure_tolerance_{s}_pb",
            f"sumw_{s}_pb", f"expected_integral_{s}_pb",
        )
        for s in COMPONENTS
    }
    return audit.combine(
        audit.rules(events, ["job_id", "source_event_id"], checks),
        audit.rules(counted, [], {
            "written.count": ("_events = event_count and _events = _declared", "_events", "_declared"),
        }),
        audit.rules(fresh, [], closure),
    )
