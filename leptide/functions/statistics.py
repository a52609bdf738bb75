"""Signed-weight statistics on aggregate rows."""

from __future__ import annotations

from typing import NamedTuple

from ..conventions import EPS
from .numeric import Sql, all_finite, choose, div, is_finite, num, root

TINY = 2.2250738585072014e-308


def mean_error(sumw: Sql, sumw2: Sql, n: Sql) -> Sql:
    """Monte Carlo error of the sample mean; NaN for fewer than two trials."""
    spread = f"greatest({sumw2} - {sumw} * {sumw} / nullif({n}, 0), 0D)"
    trials = f"(double({n}) * double({n} - 1))"
    return choose(f"{n} >= 2", root(div(spread, trials)))


def moments_consistent(sumw: Sql, sumw2: Sql, n: Sql) -> Sql:
    """False if the second moment contradicts the first beyond roundoff."""
    square = f"({sumw} * {sumw} / nullif({n}, 0))"
    return (
        f"({n} < 2 or {sumw2} - {square} >= "
        f"-1e-12D * greatest({sumw2}, {square}, 1D))"
    )


class Ratio(NamedTuple):
    value: Sql
    variance: Sql
    valid: Sql
    broken: Sql  # true where the inputs contradict the covariance model


def _finish(r: Sql, var: Sql, usable: Sql, broken: Sql) -> Ratio:
    valid = f"({usable} and {is_finite(r)} and {is_finite(var)})"
    return Ratio(choose(valid, r), choose(valid, var), valid, broken)


def resolved(d: Sql, vd: Sql) -> Sql:
    """Denominator not cancelled below floating-point resolution."""
    return f"(abs({d}) > {num(32 * EPS)} * {root(vd)})"


def subset_ratio(n: Sql, d: Sql, vn: Sql, vd: Sql) -> Ratio:
    """Ratio of a subset sum to the full sum, Cov(N, D) = Var(N).

    Signs are kept: ratios outside [0, 1] are legal. Denominators cancelled
    below floating-point resolution are masked.
    """
    r = div(n, d)
    rest = f"greatest({vd} - {vn}, 0D)"
    var = div(f"({vn} * (1D - {r}) * (1D - {r}) + {rest} * {r} * {r})", f"({d} * {d})")
    broken = f"({vd} - {vn} < {num(-32 * EPS)} * greatest({vd}, {vn}))"
    return _finish(r, var, f"{all_finite(n, d, vn, vd)} and {resolved(d, vd)}", broken)


def negative_variance(variance: Sql, scale: Sql) -> Sql:
    """Negative beyond roundoff: the covariance inputs are inconsistent."""
    return f"({variance} < {num(-128 * EPS)} * greatest({scale}, {num(TINY)}))"


def correlated_ratio(n: Sql, d: Sql, vn: Sql, vd: Sql, cov: Sql) -> Ratio:
    r = div(n, d)
    raw = f"({vn} + {r} * {r} * {vd} - 2D * {r} * {cov})"
    scale = f"({vn} + {r} * {r} * {vd} + 2D * abs({r} * {cov}))"
    var = div(f"greatest({raw}, 0D)", f"({d} * {d})")
    usable = f"{all_finite(n, d, vn, vd, cov)} and {resolved(d, vd)}"
    return _finish(r, var, usable, f"({usable} and {negative_variance(raw, scale)})")
