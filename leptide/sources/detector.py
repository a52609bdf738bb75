"""Nested detector table: explicit schema and assembly from parallel leaves."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_TRUTH = "array<struct<pid:int,e:double,px:double,py:double,pz:double>>"
_RECO = "array<struct<pt:double,eta:double,phi:double,charge:int>>"

DETECTOR_SCHEMA = (
    "job_id bigint, event_number bigint, event_weight double, cross_section_pb double, "
    "cross_section_error_pb double, weights array<double>, "
    f"dressed_electron {_TRUTH}, dressed_muon {_TRUTH}, reco_electron {_RECO}, reco_muon {_RECO}"
)

# fixed names: collection -> (source prefix, [(field, leaf, type)])
COLLECTIONS = {
    "dressed_electron": ("DressedElectron", "truth"),
    "dressed_muon": ("DressedMuon", "truth"),
    "reco_electron": ("RecoElectron", "reco"),
    "reco_muon": ("RecoMuon", "reco"),
}
LEAVES = {
    "truth": (("pid", "PID", "int"), ("e", "E", "double"), ("px", "Px", "double"), ("py", "Py", "double"), ("pz", "Pz", "double")),
    "reco": (("pt", "PT", "double"), ("eta", "Eta", "double"), ("phi", "Phi", "double"), ("charge", "Charge", "int")),
}
EVENT_LEAVES = {
    "event_number": ("Event.Number", "bigint"),
    "event_weight": ("Event.Weight", "double"),
    "cross_section_pb": ("Event.CrossSection", "double"),
    "cross_section_error_pb": ("Event.CrossSectionError", "double"),
}


def required_leaves() -> list[str]:
    """The 23 leaves the analysis reads."""
    out = [leaf for leaf, _ in EVENT_LEAVES.values()] + ["Weight.Weight"]
    for prefix, kind in COLLECTIONS.values():
        out += [f"{prefix}.{leaf}" for _, leaf, _ in LEAVES[kind]]
    return out


def read_detector(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """Nested detector events; unread leaves are pruned by the Parquet scan."""
    return spark.read.schema(DETECTOR_SCHEMA).parquet(*([paths] if isinstance(paths, str) else paths))


def assemble_leaves(flat: DataFrame, keep: Sequence[str] = ("job_id",)) -> tuple[DataFrame, DataFrame]:
    """(nested events, findings) from columns named like the detector leaves.

    Leaves of one collection are parallel arrays; rows where their lengths
    differ, or a per-event leaf does not hold exactly one value, are reported.
    """
    from ..operators.audit import rules

    scalar = {}
    for name, (leaf, kind) in EVENT_LEAVES.items():
        is_array = flat.schema[leaf].dataType.typeName() == "array"
        scalar[name] = (f"get(`{leaf}`, 0)" if is_array else f"`{leaf}`", kind, is_array)
    nested, checks = [], {}
    for name, (prefix, kind) in COLLECTIONS.items():
        cols = [f"`{prefix}.{leaf}`" for _, leaf, _ in LEAVES[kind]]
        fields = ", ".join(
            f"'{field}', cast(get({col}, i) as {t})" for col, (field, _, t) in zip(cols, LEAVES[kind])
        )
        nested.append(f"transform({cols[0]}, (x, i) -> named_struct({fields})) as {name}")
        sizes = ", ".join(f"size({c})" for c in cols)
        checks[f"leaves.{name}"] = (
            f"size(array_distinct(array({sizes}))) = 1", f"concat_ws(',', {sizes})", "'equal lengths'",
        )
    for name, (_, _, is_array) in scalar.items():
        if is_array:
            leaf = EVENT_LEAVES[name][0]
            checks[f"scalar.{name}"] = (f"size(`{leaf}`) = 1", f"size(`{leaf}`)", "1")
    checks["event_number.range"] = (f"{scalar['event_number'][0]} >= 0", scalar["event_number"][0], "'>= 0'")
    events = flat.selectExpr(
        *keep,
        *[f"cast({x} as {t}) as {n}" for n, (x, t, _) in scalar.items()],
        "transform(`Weight.Weight`, w -> double(w)) as weights",
        *nested,
    )
    subject = [*keep, scalar["event_number"][0]]
    return events, rules(flat, subject, checks)


def with_source_ids(detector: DataFrame, id_index: int, unit_index: int) -> DataFrame:
    """Append source_event_id and id_fault decoded from the weight vector."""
    from ..functions.identity import decode_fault, decode_source_id

    i, u = f"get(weights, {int(id_index)})", f"get(weights, {int(unit_index)})"
    return detector.selectExpr(
        "*", f"{decode_source_id(i, u)} as source_event_id", f"{decode_fault(i, u)} as id_fault"
    )


def scaled(detector: DataFrame, weight_scale: float) -> DataFrame:
    """Multiply event weights and cross sections by one positive factor."""
    if not weight_scale > 0:
        raise ValueError("weight scale must be positive")
    k = F.lit(float(weight_scale))
    out = detector
    for c in ("event_weight", "cross_section_pb", "cross_section_error_pb"):
        out = out.withColumn(c, F.col(c) * k)
    return out.withColumn("weights", F.transform("weights", lambda w: w * k))
