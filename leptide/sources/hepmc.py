"""HepMC2 ASCII listings: event and weight-name records."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..conventions import MARKER_ID, MARKER_UNIT
from ..functions.identity import decode_fault, decode_source_id
from ..functions.text import fields, fortran_double

_START = "HepMC::IO_GenEvent-START_EVENT_LISTING"
_END = "HepMC::IO_GenEvent-END_EVENT_LISTING"
FIRST_LINE = "translate(split_part(record, '\\n', 1), '\\t\\r', '  ')"


def read_hepmc(spark: SparkSession, paths: str | Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(events, findings). Events: (file, ordinal from 0, event_number, names, values, fault).

    The listing is cut at its event records while reading, so one file is
    spread over many tasks.
    """
    from .listing import read_records

    chunks = read_records(spark, paths, "\nE ")
    name = '"((?:[^"\\\\\\\\]|\\\\\\\\.)*)"|(\\\\S+)'
    body = chunks.where("chunk > 0").selectExpr(
        "file", "chunk - 1 as ordinal",
        f"{fields(FIRST_LINE)} as f",
        "regexp_extract_all(record, '(?m)^N[ \\\\t]+(.*)$', 1) as n_lines",
    )
    body = body.selectExpr(
        "file", "ordinal", "f", "n_lines",
        "try_cast(get(f, 0) as bigint) as event_number",
        "try_cast(get(f, 10) as int) as states",
    )
    body = body.selectExpr(
        "*",
        "try_cast(get(f, 11 + states) as int) as declared",
        "slice(f, 13 + states, greatest(size(f) - 12 - states, 0)) as w",
        "try_cast(regexp_extract(get(n_lines, 0), '^([0-9]+)', 1) as int) as n_declared",
        f"regexp_extract_all(regexp_replace(get(n_lines, 0), '^[0-9]+[ \\\\t]*', ''), '{name}', 0) as tokens",
    )
    body = body.selectExpr(
        "file", "ordinal", "event_number", "states", "declared", "n_declared", "n_lines",
        "transform(tokens, t -> if(startswith(t, '\"'), "
        "regexp_replace(substring(t, 2, length(t) - 2), '\\\\\\\\(.)', '$1'), t)) as names",
        f"transform(w, x -> {fortran_double('x')}) as values",
    )
    fault = (
        "case when event_number is null or states is null then 'bad event record' "
        "when states < 0 then 'negative random-state count' "
        "when declared is null then 'truncated event record' "
        "when size(values) <> declared then 'weight count mismatch' "
        "when exists(values, v -> v is null or v - v <> 0D) then 'bad weight' "
        "when size(n_lines) <> 1 then 'needs one name record' "
        "when n_declared is null or size(names) <> n_declared then 'name count mismatch' "
        "when size(array_distinct(names)) <> size(names) then 'duplicate weight name' "
        "when size(names) <> size(values) then 'names and weights differ in number' end"
    )
    events = body.selectExpr("file", "ordinal", "event_number", "names", "values", f"{fault} as fault")
    per_file = chunks.groupBy("file").agg(
        F.expr("max(chunk) as events"),
        F.expr(f"count_if(chunk = 0 and contains(record, 'HepMC::Version') and contains(record, '{_START}')) as heads"),
        F.expr(f"count_if(contains(record, '{_END}')) as tails"),
    )
    bad_file = per_file.where("events = 0 or heads <> 1 or tails <> 1").selectExpr(
        "'hepmc.document' as rule", "file as subject",
        "concat_ws(',', events, heads, tails) as observed", "'events, one head, one tail' as expected",
    )
    bad_event = events.where("fault is not null").selectExpr(
        "'hepmc.event' as rule", "concat_ws('#', file, ordinal) as subject",
        "fault as observed", "'sound record' as expected",
    )
    schemas = events.groupBy("file", "names").agg(F.count("*").alias("n")).groupBy("file").agg(
        F.count("*").alias("schemas")
    )
    changed = schemas.where("schemas > 1").selectExpr(
        "'hepmc.names' as rule", "file as subject", "cast(schemas as string) as observed", "'1' as expected"
    )
    return events, bad_file.unionByName(bad_event).unionByName(changed)


def named_values(names: str = "names", values: str = "values") -> str:
    return f"map_from_arrays({names}, {values})"


def with_source_ids(
    events: DataFrame, *, id_index: int | None = None, unit_index: int | None = None
) -> DataFrame:
    """Append source_event_id and id_fault, decoded from the two markers.

    Markers are found by name; listings whose names are plain numbers need the
    two positions as arguments.
    """
    if (id_index is None) != (unit_index is None):
        raise ValueError("give both marker indices or none")
    if id_index is None:
        i = f"get(values, array_position(names, '{MARKER_ID}') - 1)"
        u = f"get(values, array_position(names, '{MARKER_UNIT}') - 1)"
    else:
        i, u = f"get(values, {int(id_index)})", f"get(values, {int(unit_index)})"
    return (
        events.selectExpr("*", f"{i} as _i", f"{u} as _u")
        .selectExpr("*", f"{decode_source_id('_i', '_u')} as source_event_id", f"{decode_fault('_i', '_u')} as id_fault")
        .drop("_i", "_u")
    )


def canonicalize(
    events: DataFrame, first_event: int | str, *, keys: Sequence[str] = ("file",), order: str = "ordinal"
) -> DataFrame:
    """Exact marker names and contiguous event numbers from `first_event`.

    For each marker token, the single name containing it is renamed; rows where
    a token is found in no name, several names, or the same name as the other
    token carry a `name_fault` and keep their names.
    """
    from ..operators.ordering import with_rank

    hits = {m: f"filter(names, n -> contains(n, '{m}'))" for m in (MARKER_ID, MARKER_UNIT)}
    a, b = hits[MARKER_ID], hits[MARKER_UNIT]
    renamed = (
        f"transform(names, n -> case when contains(n, '{MARKER_ID}') then '{MARKER_ID}' "
        f"when contains(n, '{MARKER_UNIT}') then '{MARKER_UNIT}' else n end)"
    )
    fault = (
        f"case when size({a}) <> 1 or size({b}) <> 1 then 'ambiguous marker name' "
        f"when {a}[0] = {b}[0] then 'one name for both markers' "
        f"when size(array_distinct({renamed})) <> size(names) then 'marker names collide' end"
    )
    first = F.col(first_event) if isinstance(first_event, str) else F.lit(int(first_event))
    ranked = with_rank(events, keys, order, name="_position")
    return (
        ranked.withColumn("name_fault", F.expr(fault))
        .withColumn("names", F.when(F.col("name_fault").isNull(), F.expr(renamed)).otherwise(F.col("names")))
        .withColumn("event_number", first + F.col("_position"))
        .drop("_position")
    )


def name_record(names: str = "names") -> str:
    """Text of the weight-name record, names quoted."""
    quoted = f"transform({names}, n -> concat('\"', replace(replace(n, '\\\\', '\\\\\\\\'), '\"', '\\\\\"'), '\"'))"
    return f"concat_ws(' ', 'N', size({names}), array_join({quoted}, ' '))"
