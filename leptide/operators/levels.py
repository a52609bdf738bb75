"""Particle bucketing, candidates and the per-level kinematic record.

`derive_level` turns the sixteen raw momenta of one level into the full level
record. It is a chain of narrow `select`s: each step computes what the next
one reads more than once, so Catalyst neither duplicates nor re-evaluates the
deep trees, and no row is ever dropped. Rows without a candidate, or whose
projection fails, keep false masks and NaN values.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame

from ..conventions import (
    ANGULAR_FIELDS,
    DEGENERACY_FLAGS,
    LEPTON_MASS_GEV,
    LEPTONS,
    MOMENTUM,
    PDG_OF_LEPTON,
    PROJECTION_FIELDS,
    PUBLISHED_ANGLE_NAMES,
    STATUS_INVALID_TOPOLOGY,
    STATUS_PROJECTION_FAILED,
    STATUS_VALID,
    momentum_columns,
)
from ..functions.numeric import (
    NAN,
    Sql,
    above,
    acos_clipped,
    all_finite,
    choose,
    clip_unit,
    close_to,
    div,
    is_finite,
    num,
    root,
    signed_acos,
    solid,
    wrap_pi,
)
from ..functions.vectors import (
    P3,
    P4,
    boost_term,
    cross,
    dot,
    from_pt_eta_phi_mass,
    mass,
    mass2,
    norm,
    p4,
    pt,
    rapidity,
    to_rest_of_beta,
)

PROJECTION_TOLERANCE = 2.0e-10
FRAME_TOLERANCE = 1.0e-12
UNIT_TOLERANCE = 1.0e-14


def behind_generator(df: DataFrame, name: str) -> DataFrame:
    """The same columns, `name` passed through a generator of one row.

    A filter that depends on the column, as those on derived values do, then
    stays above: pushed down, it would be rewritten in terms of the raw
    momenta, and that expression grows with every step it passes. Filters on
    the other columns go through to the scan.
    """
    rows = df.selectExpr(*[f"`{c}`" for c in df.columns if c != name], f"inline(array(named_struct('{name}', `{name}`)))")
    return rows.select(*[f"`{c}`" for c in df.columns])


# --------------------------------------------------------------------------
# buckets, multiplicities, candidates
# --------------------------------------------------------------------------
def buckets_from_lhe(particles: str = "particles") -> dict[str, Sql]:
    """Status-1 leptons of an LHE particle array, by signed PDG code."""
    return {
        k: f"filter({particles}, p -> p.status = 1 and p.pdg = {code})"
        for k, code in PDG_OF_LEPTON.items()
    }


def buckets_from_dressed(
    electrons: str = "dressed_electron", muons: str = "dressed_muon"
) -> dict[str, Sql]:
    """Dressed leptons of both collections, by signed PDG code."""
    return {
        k: f"filter(concat({electrons}, {muons}), p -> p.pid = {code})"
        for k, code in PDG_OF_LEPTON.items()
    }


def buckets_from_reco(
    electrons: str = "reco_electron", muons: str = "reco_muon"
) -> dict[str, Sql]:
    """Reconstructed leptons by charge; charges away from +-1 are dropped."""

    def build(collection: str, flavor: str, sign: int) -> Sql:
        v = from_pt_eta_phi_mass(
            "double(p.pt)", "double(p.eta)", "double(p.phi)", LEPTON_MASS_GEV[flavor]
        )
        fields = ", ".join(f"'{n}', {x}" for n, x in zip(("px", "py", "pz", "e"), v))
        return (
            f"transform(filter({collection}, p -> abs(double(p.charge) - {sign}) <= 1e-6D), "
            f"p -> named_struct({fields}))"
        )

    return {
        "electron_minus": build(electrons, "electron", -1),
        "electron_plus": build(electrons, "electron", 1),
        "muon_minus": build(muons, "muon", -1),
        "muon_plus": build(muons, "muon", 1),
    }


def multiplicities(level: str, sizes: Mapping[str, Sql]) -> list[Sql]:
    """Counts per charge and flavour plus the two flavour totals."""
    out = [f"int({sizes[k]}) as {level}_n_{k}" for k in LEPTONS]
    for flavor in ("electron", "muon"):
        out.append(
            f"int({sizes[f'{flavor}_minus']} + {sizes[f'{flavor}_plus']}) "
            f"as {level}_n_{flavor}s"
        )
    return out


def is_unique(sizes: Mapping[str, Sql]) -> Sql:
    """Exactly one lepton in each of the four buckets."""
    return "coalesce(" + " and ".join(f"{sizes[k]} = 1" for k in LEPTONS) + ", false)"


def attach_candidate(df: DataFrame, level: str, buckets: Mapping[str, Sql]) -> DataFrame:
    """Add multiplicities, `<level>_topology_valid` and the raw momenta.

    The raw momenta are NaN unless the candidate is unique.
    """
    original = list(df.columns)
    tmp = {k: f"_{level}_bucket_{k}" for k in LEPTONS}
    df = df.selectExpr("*", *[f"{buckets[k]} as {tmp[k]}" for k in LEPTONS])
    sizes = {k: f"coalesce(size({tmp[k]}), 0)" for k in LEPTONS}
    valid = f"{level}_topology_valid"
    counts = multiplicities(level, sizes)
    df = df.selectExpr("*", *counts, f"{is_unique(sizes)} as {valid}")
    momenta = [
        choose(valid, solid(f"double(get({tmp[k]}, 0).{c.lower()})"))
        + f" as {level}_raw_{k}_{c}"
        for k in LEPTONS
        for c in MOMENTUM
    ]
    names = [c.rsplit(" as ", 1)[1] for c in counts]
    return df.selectExpr(*original, *names, valid, *momenta)


# --------------------------------------------------------------------------
# composites and projection
# --------------------------------------------------------------------------
def leptons(prefix: str) -> dict[str, P4]:
    return {k: p4(f"{prefix}_{k}") for k in LEPTONS}


def z1_of(l: Mapping[str, P4]) -> P4:
    return l["muon_minus"].plus(l["muon_plus"])


def z2_of(l: Mapping[str, P4]) -> P4:
    return l["electron_minus"].plus(l["electron_plus"])


def composites(level: str, frame: str = "raw") -> dict[str, P4]:
    """Z1 = mu- mu+, Z2 = e- e+ and their sum; flavour fixes the assignment."""
    l = leptons(f"{level}_{frame}")
    z1, z2 = z1_of(l), z2_of(l)
    return {"Z1": z1, "Z2": z2, "X": z1.plus(z2)}


def _unit_vector(direction: Sequence[float]) -> P3:
    values = [float(v) for v in direction]
    size = math.sqrt(sum(v * v for v in values))
    if len(values) != 3 or not math.isfinite(size) or size <= UNIT_TOLERANCE:
        raise ValueError("beam_direction must be a finite, nonzero 3-vector")
    return P3(*(num(v / size) for v in values))


def derive_level(
    df: DataFrame,
    level: str,
    *,
    beam_direction: Sequence[float] = (0.0, 0.0, 1.0),
    include_momenta: bool = True,
    check_projection: bool = True,
) -> DataFrame:
    """Append the level record to a table holding `<level>_raw_*` momenta.

    Reads `<level>_topology_valid` and the sixteen raw momenta, keeps every
    other column and every row. Angles come from the recoil-free projection of
    this level: a longitudinal and a transverse boost bring the four leptons to
    their common rest frame, and the inverse longitudinal boost gives the
    projected momenta. Angles are read off in the rest frame directly; the
    second Z moves opposite to the first there, so its helicity frame is the
    first one with y and z reversed.
    """
    topo = f"{level}_topology_valid"
    raw_names = momentum_columns(level, "raw")
    missing = [c for c in (topo, *raw_names) if c not in df.columns]
    if missing:
        raise ValueError(f"derive_level({level}) is missing columns {missing}")
    beam = _unit_vector(beam_direction)
    t = f"_{level}_"

    # names alive after each step; a step adds some and forgets some
    passthrough = [c for c in df.columns if c not in raw_names and c != topo]
    alive = [*passthrough, topo, *raw_names]
    df = df.selectExpr(
        *[f"`{c}`" for c in passthrough],
        f"coalesce({topo}, false) as {topo}",
        *[f"{solid(f'double({c})')} as {c}" for c in raw_names],
    )

    def step(new: Mapping[str, Sql], forget: Sequence[str] = ()) -> None:
        nonlocal df, alive
        gone = {t + f for f in forget}
        alive = [c for c in alive if c not in gone]
        df = df.selectExpr(*[f"`{c}`" for c in alive], *[f"{x} as {t}{n}" for n, x in new.items()])
        alive += [t + n for n in new]

    def vec(name: str) -> P3:
        return P3(*(f"{t}{name}{axis}" for axis in "xyz"))

    def spread(name: str, v: P3) -> dict[str, Sql]:
        return {f"{name}{axis}": c for axis, c in zip("xyz", v)}

    raw = leptons(f"{level}_raw")
    system = z1_of(raw).plus(z2_of(raw))

    # longitudinal velocity, raw diagnostics
    X = system
    step(
        {
            "bl": div(X.pz, X.e),
            "gl": div(f"abs({X.e})", root(f"({X.e} - {X.pz}) * ({X.e} + {X.pz})")),
            "raw_m4l": mass(X),
            "raw_y4l": rapidity(X),
            "raw_pt4l": pt(X),
            "timelike": f"{all_finite(*X)} and {above(X.e, 0.0)} and {above(mass2(X), 0.0)}",
            "X_px": X.px,
            "X_py": X.py,
            "X_E": X.e,
        }
    )
    bl, gl, xpx, xpy = f"{t}bl", f"{t}gl", f"{t}X_px", f"{t}X_py"

    # longitudinal boost
    new = {}
    for k, p in raw.items():
        new[f"zl_{k}"] = f"{gl} * ({p.pz} - {bl} * {p.e})"
        new[f"el_{k}"] = f"{gl} * ({p.e} - {bl} * {p.pz})"
    step(new)
    el = {k: f"{t}el_{k}" for k in LEPTONS}
    zl = {k: f"{t}zl_{k}" for k in LEPTONS}

    # transverse velocity
    et = f"({el['muon_minus']} + {el['muon_plus']} + ({el['electron_minus']} + {el['electron_plus']}))"
    step(
        {
            "tx": div(xpx, et),
            "ty": div(xpy, et),
            "gt": div(et, root(f"{et} * {et} - {xpx} * {xpx} - {xpy} * {xpy}")),
        },
        forget=["X_px", "X_py"],
    )
    tx, ty, gt = f"{t}tx", f"{t}ty", f"{t}gt"

    # transverse boost: all four leptons in the common rest frame
    new = {}
    for k, p in raw.items():
        along = f"({tx} * {p.px} + {ty} * {p.py})"
        shift = f"({boost_term(gt)} * {along} - {gt} * {el[k]})"
        new[f"rx_{k}"] = f"{p.px} + {shift} * {tx}"
        new[f"ry_{k}"] = f"{p.py} + {shift} * {ty}"
        new[f"re_{k}"] = f"{gt} * ({el[k]} - {along})"
    step(new)
    rest = {k: P4(f"{t}rx_{k}", f"{t}ry_{k}", zl[k], f"{t}re_{k}") for k in LEPTONS}

    # projected momenta, Z momenta and decay normals in the rest frame
    new = {}
    for k, p in rest.items():
        new[f"bz_{k}"] = f"{gl} * ({p.pz} + {bl} * {p.e})"
        new[f"be_{k}"] = f"{gl} * ({p.e} + {bl} * {p.pz})"
    z1, z2 = z1_of(rest), z2_of(rest)
    new |= spread("q", z1.spatial) | spread("w", z2.spatial)
    new |= {"e1": z1.e, "e2": z2.e}
    new |= spread("n1", cross(rest["muon_minus"].spatial, rest["muon_plus"].spatial))
    new |= spread("n2", cross(rest["electron_minus"].spatial, rest["electron_plus"].spatial))
    step(new, forget=[f"el_{k}" for k in LEPTONS] + ["tx", "ty", "gt"])

    # norms, Z velocities and their gamma factors
    new = {"qn": norm(vec("q")), "wn": norm(vec("w")), "n1n": norm(vec("n1")), "n2n": norm(vec("n2"))}
    for tag, v, e, g in (("v1", "q", f"{t}e1", "g1"), ("v2", "w", f"{t}e2", "g2")):
        new |= spread(tag, P3(*(div(c, e) for c in vec(v))))
        new[g] = div(e, root(f"{e} * {e} - {dot(vec(v), vec(v))}"))
    forget = [f"{n}_{k}" for n in ("zl", "re") for k in ("muon_minus", "electron_minus")]
    step(new, forget=[*forget, "e1", "e2", "wx", "wy", "wz", "bl", "gl"])

    # unit axes; positive leptons in the rest frame of their own Z
    new = {}
    for name, length in (("q", "qn"), ("n1", "n1n"), ("n2", "n2n")):
        new |= spread(f"{name}h", P3(*(div(c, f"{t}{length}") for c in vec(name))))
    for tag, k, v, g in (("a", "muon_plus", "v1", "g1"), ("b", "electron_plus", "v2", "g2")):
        new |= spread(tag, to_rest_of_beta(rest[k], vec(v), f"{t}{g}").spatial)
    forget = [f"{n}_{k}" for n in ("zl", "re") for k in ("muon_plus", "electron_plus")]
    forget += [f"{n}{axis}" for n in ("q", "n1", "n2", "v1", "v2") for axis in "xyz"]
    step(new, forget=[*forget, "g1", "g2"])

    # production normal, lepton norms
    qh, n1h, n2h, a, b = vec("qh"), vec("n1h"), vec("n2h"), vec("a"), vec("b")
    normal = cross(beam, qh)
    step({**spread("p", normal), "pn": norm(normal), "an": norm(a), "bn": norm(b)})

    # helicity frame of the first Z; a fixed axis replaces the beam when both align
    pn, deg = f"{t}pn", f"({t}pn < {num(FRAME_TOLERANCE)})"
    u = P3(*(div(c, pn) for c in vec("p")))
    steep = above(f"abs({qh.x})", 0.9)
    axis = P3(f"if({steep}, 0D, 1D)", f"if({steep}, 1D, 0D)", "0D")
    along = f"if({steep}, {qh.y}, {qh.x})"
    length = root(f"1D - {along} * {along}")
    side = P3(*(div(f"({c} - {along} * {h})", length) for c, h in zip(axis, qh)))
    step(
        {
            "deg": deg,
            **spread("u", u),
            **spread("y", P3(*(f"if({deg}, {s}, {r})" for s, r in zip(cross(qh, side), u)))),
        },
        forget=["px", "py", "pz"],
    )
    u, y, deg = vec("u"), vec("y"), f"{t}deg"
    x = cross(y, qh)

    # projected diagnostics and angles
    born = {k: P4(f"{t}rx_{k}", f"{t}ry_{k}", f"{t}bz_{k}", f"{t}be_{k}") for k in LEPTONS}
    bz1, bz2 = z1_of(born), z2_of(born)
    bX = bz1.plus(bz2)
    planes = f"{above(f'{t}n1n', UNIT_TOLERANCE)} and {above(f'{t}n2n', UNIT_TOLERANCE)}"
    production = above(pn, UNIT_TOLERANCE)
    step(
        {
            "m_Z1": mass(bz1),
            "m_Z2": mass(bz2),
            "m_ZZ": mass(bX),
            "y_ZZ": rapidity(bX),
            "pt_ZZ": pt(bX),
            "ct1": clip_unit(div(dot(a, qh), f"{t}an")),
            "ct2": clip_unit(f"(-{div(dot(b, qh), f'{t}bn')})"),
            "az1": f"atan2({dot(a, y)}, {dot(a, x)})",
            "az2": f"atan2(-{dot(b, y)}, {dot(b, x)})",
            "star": clip_unit(dot(beam, qh)),
            "planes": planes,
            "production": production,
            "PhiD": choose(planes, signed_acos(f"(-{dot(n1h, n2h)})", dot(qh, cross(n1h, n2h)))),
            "PhiP": choose(
                f"{planes} and {production}", signed_acos(dot(n1h, u), dot(qh, cross(n1h, u)))
            ),
        },
        forget=[f"{n}{c}" for n in ("n1h", "n2h", "a", "b", "u", "y", "qh") for c in "xyz"],
    )

    # validity of the projection
    ok = [topo, f"{t}timelike"]
    if check_projection:
        tol = PROJECTION_TOLERANCE
        ok += [
            close_to(f"{t}raw_m4l", f"{t}m_ZZ", tol, tol),
            close_to(f"{t}raw_y4l", f"{t}y_ZZ", tol, tol),
            f"not {above(f'{t}pt_ZZ', f'{num(tol)} * greatest(abs({t}X_E), 1D)')}",
        ]
    for length in ("qn", "wn", "an", "bn"):
        ok += [above(f"{t}{length}", UNIT_TOLERANCE), is_finite(f"{t}{length}")]
    step({"ok": " and ".join(ok)}, forget=["timelike", "X_E", "qn", "wn", "an", "bn", "n1n", "n2n", "pn"])
    df = behind_generator(df, f"{t}ok")

    # the record
    values = {
        "raw_m4l": f"{t}raw_m4l",
        "born_m4l": f"{t}m_ZZ",
        "raw_y4l": f"{t}raw_y4l",
        "born_y4l": f"{t}y_ZZ",
        "raw_pt4l": f"{t}raw_pt4l",
        "born_pt4l": f"{t}pt_ZZ",
        "m_Z1": f"{t}m_Z1",
        "m_Z2": f"{t}m_Z2",
        "m_ZZ": f"{t}m_ZZ",
        "y_ZZ": f"{t}y_ZZ",
        "pt_ZZ": f"{t}pt_ZZ",
        "theta1": acos_clipped(f"{t}ct1"),
        "phi1": f"{t}az1",
        "cos_theta1": f"{t}ct1",
        "theta2": acos_clipped(f"{t}ct2"),
        "phi2": f"{t}az2",
        "cos_theta2": f"{t}ct2",
        "cos_theta_star": f"{t}star",
        "abs_cos_theta_star": f"abs({t}star)",
        "theta1_standard": acos_clipped(f"(-{t}ct1)"),
        "theta2_standard": acos_clipped(f"(-{t}ct2)"),
        "Phi_standard": f"{t}PhiD",
        "Phi1_standard": f"{t}PhiP",
        "Psi_standard": wrap_pi(f"{t}PhiP + 0.5D * {t}PhiD"),
    }
    ok = f"{t}ok"
    record = [
        topo,
        f"{ok} as {level}_projection_valid",
        *[
            f"{choose(ok, values[f])} as {level}_{f}"
            for f in (*PROJECTION_FIELDS, *ANGULAR_FIELDS)
        ],
        f"({ok} and {deg}) as {level}_frame_degenerate",
        f"({ok} and not ({t}planes and {t}production)) as {level}_standard_angles_degenerate",
    ]
    if include_momenta:
        record += [f"{choose(topo, c)} as {c}" for c in raw_names]
        record += [
            f"{choose(ok, v)} as {level}_born_{k}_{c}"
            for k in LEPTONS
            for c, v in zip(MOMENTUM, born[k])
        ]
    record.append(f"{topo} as {level}_candidate")
    return df.selectExpr(*[f"`{c}`" for c in passthrough], *record)


def level_record_columns(level: str) -> list[str]:
    """Column names of one level record, in table order."""
    return [
        f"{level}_topology_valid",
        f"{level}_projection_valid",
        *[f"{level}_{f}" for f in (*PROJECTION_FIELDS, *ANGULAR_FIELDS, *DEGENERACY_FLAGS)],
        *momentum_columns(level, "raw"),
        *momentum_columns(level, "born"),
        f"{level}_candidate",
    ]


def exact_names(df: DataFrame) -> DataFrame:
    """Rename the three suffixed angles to their published names.

    Needs `spark.sql.caseSensitive=true`, because Phi1 and phi1 then coexist.
    """
    if df.sparkSession.conf.get("spark.sql.caseSensitive") != "true":
        raise ValueError("exact_names needs spark.sql.caseSensitive=true")
    renames = {}
    for c in df.columns:
        for ours, published in PUBLISHED_ANGLE_NAMES.items():
            if c.endswith(f"_{ours}"):
                renames[c] = c[: -len(ours)] + published
    return df.withColumnsRenamed(renames)


def lhe_status(level: str = "lhe") -> Sql:
    return (
        f"cast(case when not {level}_topology_valid then {STATUS_INVALID_TOPOLOGY} "
        f"when not {level}_projection_valid then {STATUS_PROJECTION_FAILED} "
        f"else {STATUS_VALID} end as tinyint)"
    )


def absent_level(df: DataFrame, level: str) -> DataFrame:
    """Schema-complete raw columns for a level that is not there at all."""
    return df.selectExpr(
        "*",
        f"false as {level}_topology_valid",
        *[f"{NAN} as {c}" for c in momentum_columns(level, "raw")],
    )
