"""Scalar expressions with float semantics that survive NaN and ANSI mode.

Every helper here and in the sibling modules takes and returns Spark SQL
expression text. Wide physics records are then handed to Spark in a few
`selectExpr` calls, instead of thousands of small Column objects.

Spark orders NaN above every number and raises on division by zero in ANSI
mode, so comparisons and quotients used by physics columns go through here.
Helpers yield non-nullable doubles (NaN, never NULL): generated code then
carries no null flags for them.
"""

from __future__ import annotations

import math

Sql = str
NAN = "double('NaN')"


def num(value: float) -> Sql:
    """DOUBLE literal (a bare 1.0 would be a DECIMAL)."""
    value = float(value)
    if math.isnan(value):
        return NAN
    if math.isinf(value):
        return f"double('{'-' if value < 0 else ''}Infinity')"
    return f"{value!r}D" if value >= 0 else f"({value!r}D)"


PI = num(math.pi)
TWO_PI = num(2.0 * math.pi)


def solid(x: Sql) -> Sql:
    """NULL -> NaN, typed as a non-nullable double."""
    return f"coalesce({x}, {NAN})"


def div(a: Sql, b: Sql) -> Sql:
    """a / b, NaN where b is zero."""
    return f"coalesce(try_divide({a}, {b}), {NAN})"


def root(x: Sql) -> Sql:
    return f"coalesce(sqrt({x}), {NAN})"


def is_finite(x: Sql) -> Sql:
    # x - x is 0 for finite x and NaN for NaN or an infinity
    return f"(({x}) - ({x}) = 0D)"


def all_finite(*xs: Sql) -> Sql:
    # a sum of x - x terms is 0 exactly when every term is finite
    return "(" + " + ".join(f"(({x}) - ({x}))" for x in xs) + " = 0D)"


def above(x: Sql, bound: Sql | float) -> Sql:
    """x > bound, false for NaN."""
    b = bound if isinstance(bound, str) else num(bound)
    return f"(({x}) > {b} and not isnan({x}))"


def below(x: Sql, bound: Sql | float) -> Sql:
    """x < bound; NaN sorts last in Spark, so NaN is already false."""
    b = bound if isinstance(bound, str) else num(bound)
    return f"(({x}) < {b})"


def choose(condition: Sql, yes: Sql, no: Sql = NAN) -> Sql:
    return f"if({condition}, {yes}, {no})"


def wrap_pi(angle: Sql) -> Sql:
    """Map an angle to [-pi, pi)."""
    return f"(coalesce(pmod(({angle}) + {PI}, {TWO_PI}), {NAN}) - {PI})"


def clip_unit(x: Sql) -> Sql:
    """Clip a cosine to [-1, 1], keeping NaN."""
    return f"(case when ({x}) < -1D then -1D when {above(x, 1.0)} then 1D else {x} end)"


def acos_clipped(x: Sql) -> Sql:
    return f"coalesce(acos({clip_unit(x)}), {NAN})"


def signed_acos(cosine: Sql, orientation: Sql) -> Sql:
    return f"(if(({orientation}) < 0D, -1D, 1D) * {acos_clipped(cosine)})"


def asinh(t: Sql) -> Sql:
    """Inverse hyperbolic sine, accurate for both signs and for small |t|.

    log(t + sqrt(t*t + 1)) cancels for large negative t; working on |t| and
    putting the sign back does not.
    """
    a = f"abs({t})"
    grown = f"{a} + {a} * {a} / (1D + sqrt({a} * {a} + 1D))"
    return f"(if(({t}) < 0D, -1D, 1D) * coalesce(log1p({grown}), {NAN}))"


def close(a: Sql, b: Sql, rtol: float, atol: float) -> Sql:
    """Symmetric closeness: |a-b| <= max(rtol*max(|a|,|b|), atol)."""
    gap = f"abs(({a}) - ({b}))"
    return (
        f"({gap} <= greatest({num(rtol)} * greatest(abs({a}), abs({b})), {num(atol)})"
        f" and not isnan({gap}))"
    )


def close_to(a: Sql, reference: Sql, rtol: float, atol: float) -> Sql:
    """Asymmetric closeness: |a-ref| <= atol + rtol*|ref|."""
    gap = f"abs(({a}) - ({reference}))"
    return f"({gap} <= {num(atol)} + {num(rtol)} * abs({reference}) and not isnan({gap}))"


def null_if_not_finite(x: Sql) -> Sql:
    """NaN and infinities become NULL (metadata convention)."""
    return f"if({is_finite(x)}, {x}, null)"


def rounded(x: Sql, digits: int) -> Sql:
    """Rounded value for reports: no negative zero, NULL where not finite."""
    return f"if({is_finite(x)}, round({x}, {digits}) + 0D, null)"
