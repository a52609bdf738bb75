"""Checked queries: each operator on the given tables, with equivalent SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .. import bridge
from ..conventions import LEPTONS
from ..functions.numeric import is_finite, rounded
from ..session import prepare

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

SHORT = dict(zip(LEPTONS, ("em", "ep", "mm", "mp")))


def query(name: str, sql: str | None = None):
    """Register a query; the session settings are applied before it is built."""

    def register(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(prepare(spark), sf_dir)

        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def r(x: str, name: str, digits: int = 6) -> str:
    """Spark output column: rounded, NULL where not finite."""
    return f"{rounded(x, digits)} as {name}"


def d(x: str, name: str, digits: int = 6) -> str:
    """The same column in the checking engine."""
    return f"case when isfinite({x}) then round({x}, {digits}) + 0e0 end as {name}"


def r_settled(x: str, name: str, digits: int) -> str:
    """Rounded by its decimal digits, half away from zero: a tie is none of the last bit's business, so five digits more are read first."""
    return f"if({is_finite(x)}, double(round(cast({x} as decimal(38,{digits + 5})), {digits})) + 0D, null) as {name}"


def d_settled(x: str, name: str, digits: int) -> str:
    """The same column in the checking engine."""
    return f"case when isfinite({x}) then cast(round(cast({x} as decimal(38,{digits + 5})), {digits}) as double) + 0e0 end as {name}"


def r_angle(x: str, name: str) -> str:
    """Angle in [-pi, pi) as rounded: what rounds to pi stands as -pi."""
    return f"if(round({x}, 6) >= 3.141593D, -3.141593D, {rounded(x, 6)}) as {name}"


def d_angle(x: str, name: str) -> str:
    """The same column in the checking engine."""
    return f"case when isfinite({x}) then case when round({x}, 6) >= 3.141593e0 then -3.141593e0 else round({x}, 6) + 0e0 end end as {name}"


def _sum(parts: list[str], c: str, alias: str) -> str:
    return " + ".join(f"{p}.{c}" if "." in p else f"{p}{c}" for p in parts) + f" as {alias}"


def _dot(a: str, b: str) -> str:
    return f"({a}e*{b}e - {a}x*{b}x - {a}y*{b}y - {a}z*{b}z)"


def view_sql(where: str = "") -> str:
    """CTE chain ev -> k -> v for the checking engine.

    v holds short-named momenta, composites, and the Lorentz invariants that
    give masses, decay angles and the production angle without any boost.
    """
    short = ", ".join(
        f"lhe_raw_{k}_{c} as {s}{'e' if c == 'E' else c[1]}"
        for k, s in SHORT.items()
        for c in ("px", "py", "pz", "E")
    )
    comp = ", ".join(
        f"mm{c}+mp{c} as a{c}, em{c}+ep{c} as n{c}, mm{c}+mp{c}+(em{c}+ep{c}) as t{c}" for c in "xyze"
    )
    return f"""
ev as ({bridge.event_view_sql('events')}),
k as (select i, w, job_id, source_event_id, campaign_id, sample_code, channel_code, reco_present, {short} from ev {where}),
k2 as (select *, {comp} from k),
k3 as (select *, sqrt(greatest({_dot('a','a')}, 0e0)) as m1, sqrt(greatest({_dot('n','n')}, 0e0)) as m2,
  sqrt({_dot('t','t')}) as m4, tz/te as bl, 1e0/sqrt(1e0-(tz/te)*(tz/te)) as gl from k2),
k4 as (select *, {_dot('mp','a')}/m1 as el1, {_dot('a','n')}/m1 as eq1, {_dot('ep','n')}/m2 as el2, {_dot('a','n')}/m2 as eq2,
  sqrt((m4*m4-(m1+m2)*(m1+m2))*(m4*m4-(m1-m2)*(m1-m2)))/(2e0*m4) as qabs from k3),
v as (select *,
  ({_dot('mp','n')} - el1*eq1)/(sqrt(el1*el1 - {_dot('mp','mp')})*sqrt(eq1*eq1 - m2*m2)) as c1,
  ({_dot('ep','a')} - el2*eq2)/(sqrt(el2*el2 - {_dot('ep','ep')})*sqrt(eq2*eq2 - m1*m1)) as c2,
  gl*(az - bl*ae)/qabs as cstar from k4)"""


def angle_sql() -> str:
    """CTE chain ending in `g`: adds azimuths read off in the rest frame.

    Boosts along the Z axis leave the azimuth alone, so the momenta in the
    four-lepton rest frame suffice.
    """
    lon = ", ".join(f"gl*({s}z-bl*{s}e) as {s}zl, gl*({s}e-bl*{s}z) as {s}el" for s in SHORT.values())
    rest = ", ".join(
        f"{s}x + (gt*gt/(1e0+gt)*(ux*{s}x+uy*{s}y) - gt*{s}el)*ux as {s}rx, "
        f"{s}y + (gt*gt/(1e0+gt)*(ux*{s}x+uy*{s}y) - gt*{s}el)*uy as {s}ry, "
        f"gt*({s}el - (ux*{s}x+uy*{s}y)) as {s}re"
        for s in SHORT.values()
    )
    return (
        view_sql()
        + f""",
g1 as (select *, {lon} from v),
g2 as (select *, tx/(mmel+mpel+emel+epel) as ux, ty/(mmel+mpel+emel+epel) as uy from g1),
g3 as (select *, 1e0/sqrt(1e0-ux*ux-uy*uy) as gt from g2),
g4 as (select *, {rest} from g3),
g5 as (select *, mmrx+mprx as qx, mmry+mpry as qy, mmzl+mpzl as qz from g4),
g6 as (select *, sqrt(qx*qx+qy*qy+qz*qz) as qn, sqrt(qx*qx+qy*qy) as qt from g5),
g7 as (select *, -qy/qt as yx, qx/qt as yy, qx/qn as zx, qy/qn as zy, qz/qn as zz from g6),
g8 as (select *, yy*zz as xx, 0e0-yx*zz as xy, yx*zy-yy*zx as xz from g7),
g as (select *,
  atan2(mprx*yx+mpry*yy, mprx*xx+mpry*xy+mpzl*xz) as p1,
  atan2(0e0-(eprx*yx+epry*yy), eprx*xx+epry*xy+epzl*xz) as p2 from g8)"""
    )


def wrap_sql(x: str) -> str:
    pi = "3.141592653589793e0"
    return f"(({x}) - 2e0*{pi}*floor((({x}) + {pi})/(2e0*{pi})))"


def fault_sql(n: str, u: str) -> str:
    """The decoding rules of `identity.decode_fault` for a marker pair, in the checking engine."""
    ratio = f"(({n})/nullif({u}, 0e0))"
    tol = f"greatest(1e-7, abs({ratio})*5e-8)"
    return (
        f"case when ({u}) = 0e0 then 'zero unit marker' when {tol} >= 25e-2 then 'ratio too large' "
        f"when abs({ratio}-round_even({ratio},0)) > {tol} then 'not integral' "
        f"when round_even({ratio},0) < 1 or round_even({ratio},0) > 1000000 then 'out of range' end"
    )


def decoded_sql(n: str, u: str) -> str:
    """The source ID of a marker pair, NULL where a decoding rule is broken."""
    return f"case when ({fault_sql(n, u)}) is null then cast(round_even(({n})/nullif({u}, 0e0), 0) as bigint) end"


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bridge.event_view(spark, sf_dir)


def lhe_level(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ..operators.levels import derive_level

    return derive_level(events(spark, sf_dir), "lhe")


def load_all() -> None:
    from . import aggregates, audits, derivations, matching, reporting, text  # noqa: F401
