"""Four-vectors as tuples of SQL expressions."""

from __future__ import annotations

from typing import NamedTuple

from .numeric import NAN, Sql, asinh, div, num, root, wrap_pi


class P3(NamedTuple):
    x: Sql
    y: Sql
    z: Sql

    def negated(self) -> "P3":
        return P3(*(f"(-{c})" for c in self))

    def scaled(self, k: Sql) -> "P3":
        return P3(*(f"({c} * {k})" for c in self))


class P4(NamedTuple):
    px: Sql
    py: Sql
    pz: Sql
    e: Sql

    def plus(self, other: "P4") -> "P4":
        return P4(*(f"({a} + {b})" for a, b in zip(self, other)))

    @property
    def spatial(self) -> P3:
        return P3(self.px, self.py, self.pz)


def p4(prefix: str) -> P4:
    """Four-vector stored in the columns <prefix>_px, _py, _pz, _E."""
    return P4(*(f"{prefix}_{c}" for c in ("px", "py", "pz", "E")))


def dot(a: P3, b: P3) -> Sql:
    return "(" + " + ".join(f"{u} * {v}" for u, v in zip(a, b)) + ")"


def cross(a: P3, b: P3) -> P3:
    return P3(
        f"({a.y} * {b.z} - {a.z} * {b.y})",
        f"({a.z} * {b.x} - {a.x} * {b.z})",
        f"({a.x} * {b.y} - {a.y} * {b.x})",
    )


def norm(a: P3) -> Sql:
    return root(dot(a, a))


def mass2(p: P4) -> Sql:
    return f"({p.e} * {p.e} - {dot(p.spatial, p.spatial)})"


def mass(p: P4) -> Sql:
    """Invariant mass; negative for spacelike vectors."""
    m2 = mass2(p)
    return f"(if({m2} < 0D, -1D, 1D) * {root(f'abs({m2})')})"


def pt(p: P4) -> Sql:
    return root(f"{p.px} * {p.px} + {p.py} * {p.py}")


def eta(p: P4) -> Sql:
    """Pseudorapidity asinh(pz/pt); NaN for pt = 0."""
    return asinh(div(p.pz, pt(p)))


def phi(p: P4) -> Sql:
    return f"atan2({p.py}, {p.px})"


def rapidity(p: P4) -> Sql:
    ratio = div(f"({p.e} + {p.pz})", f"({p.e} - {p.pz})")
    return f"(0.5D * coalesce(ln({ratio}), {NAN}))"


def delta_r(eta1: Sql, phi1: Sql, eta2: Sql, phi2: Sql) -> Sql:
    return f"hypot({eta1} - {eta2}, {wrap_pi(f'{phi1} - {phi2}')})"


def gamma(beta2: Sql) -> Sql:
    return div("1D", root(f"1D - {beta2}"))


def boost_term(g: Sql) -> Sql:
    """(g - 1) / beta^2 written so that it tends to 1/2 at rest."""
    return f"({g} * {g} / (1D + {g}))"


def boost(p: P4, b: P3, g: Sql) -> P4:
    """Boost by +b, given g = gamma(b)."""
    bp = dot(b, p.spatial)
    f = f"({boost_term(g)} * {bp} + {g} * {p.e})"
    return P4(
        f"({p.px} + {f} * {b.x})",
        f"({p.py} + {f} * {b.y})",
        f"({p.pz} + {f} * {b.z})",
        f"({g} * ({p.e} + {bp}))",
    )


def to_rest_of_beta(p: P4, b: P3, g: Sql) -> P4:
    """Boost into the frame that moves with velocity b."""
    return boost(p, b.negated(), g)


def velocity(p: P4) -> P3:
    return P3(*(div(c, p.e) for c in p.spatial))


def from_pt_eta_phi_mass(pt_: Sql, eta_: Sql, phi_: Sql, m: float) -> P4:
    px, py, pz = f"({pt_} * cos({phi_}))", f"({pt_} * sin({phi_}))", f"({pt_} * sinh({eta_}))"
    return P4(px, py, pz, f"sqrt({px} * {px} + {py} * {py} + {pz} * {pz} + {num(m * m)})")


