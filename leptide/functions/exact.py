"""Doubles as exact integers on a fixed ladder of powers of two.

A finite double is three integers below 2**32 on neighbouring rungs of width
32: p0 * 2**(32 k) + p1 * 2**(32 (k - 1)) + p2 * 2**(32 (k - 2)), with the
rung k of its own. Integers of one rung add without rounding, in any order,
and so does a sparse accumulator of rung totals. Only reading it out rounds.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .numeric import Sql

WIDTH = 32
#: Values below this are lifted by LIFT rungs first, so that no power of two under- or overflows.
_SMALL, LIFT = "pow(2D, -480)", 17


def exact_parts(df: DataFrame, values: Mapping[str, Sql]) -> DataFrame:
    """Append for each name the struct `name` (fine, rung, p0, p1, p2) of a double expression.

    `fine` is false for NaN and the infinities. NULL and zero are rung 0 with
    parts 0. The parts of a value are unique: p0 is not 0 but for zero.
    """
    names = list(values)
    keep = list(df.columns)
    unit = f"pow(2D, {WIDTH} * _k_{{n}})"
    stages = [
        {"_v_{n}": "double({x})"},
        {"_f_{n}": "_v_{n} is null or (not isnan(_v_{n}) and abs(_v_{n}) < double('Infinity'))"},
        {"_v_{n}": "if(_f_{n} and _v_{n} is not null, _v_{n}, 0D)"},
        {"_s_{n}": f"abs(_v_{{n}}) < {_SMALL}"},
        {"_v_{n}": f"if(_s_{{n}}, _v_{{n}} * pow(2D, {WIDTH * LIFT}), _v_{{n}})"},
        # the logarithm may be off at a power of two: start low, then compare exactly
        {"_k_{n}": f"if(_v_{{n}} = 0D, 0, cast(floor((log2(greatest(abs(_v_{{n}}), pow(2D, -1000))) - 0.01D) / {WIDTH}) as int))"},
        {"_k_{n}": f"if(abs(_v_{{n}}) * pow(2D, -{WIDTH} * (_k_{{n}} + 1)) >= 1D, _k_{{n}} + 1, _k_{{n}})"},
        {"_v_{n}": f"_v_{{n}} / {unit}"},
        {"_p0_{n}": "cast(_v_{n} as bigint)"},
        {"_v_{n}": "(_v_{n} - _p0_{n}) * 4294967296D"},
        {"_p1_{n}": "cast(_v_{n} as bigint)"},
        {"{n}": f"named_struct('fine', _f_{{n}}, 'rung', if(_p0_{{n}} = 0 and _p1_{{n}} = 0, 0, _k_{{n}} - if(_s_{{n}}, {LIFT}, 0)), "
                "'p0', _p0_{n}, 'p1', _p1_{n}, 'p2', cast((_v_{n} - _p1_{n}) * 4294967296D as bigint))"},
    ]
    for stage in stages:
        new = {k.format(n=n): e.format(n=n, x=values[n]) for n in names for k, e in stage.items()}
        df = df.selectExpr(*[c for c in df.columns if c not in new], *[f"{e} as {c}" for c, e in new.items()])
    return df.select(*[c for c in keep if c not in values], *names)


def _let(value: Column, then: Callable[[Column], Column]) -> Column:
    """`then` of a value computed once."""
    return F.transform(F.array(value), then)[0]


def _digits(totals: Column, sign: Column) -> Column:
    """struct(sign, carry, digits) of totals carried up into digits of one rung each, from the lowest."""
    base, wide = F.lit(1 << WIDTH).cast("decimal(20,0)"), "decimal(38,0)"

    def step(s: Column, total: Column) -> Column:
        def split(sum_: Column) -> Column:
            rest = F.pmod(sum_, base)
            carry = ((sum_ - rest).cast(wide) / base).cast("long")
            return F.struct(carry.alias("carry"), F.array_append(s["digits"], rest.cast("long")).alias("digits"))

        return _let((s["carry"].cast(wide) + total * sign).cast(wide), split)

    zero = F.struct(F.lit(0).cast("long").alias("carry"), F.array().cast("array<bigint>").alias("digits"))
    return _let(F.aggregate(totals, zero, step), lambda s: F.struct(sign.alias("sign"), s["carry"].alias("carry"), s["digits"].alias("digits")))


def _rounded(number: Column, lowest: Column) -> Column:
    """The double next to digits that start at the rung `lowest`."""
    base = F.lit(1 << WIDTH).cast("decimal(20,0)")

    def at(k: Column) -> Column:
        digit = lambda i: F.when(k >= i, F.get(number["digits"], k - i)).otherwise(0).cast("decimal(12,0)")
        below = F.exists(F.slice(number["digits"], 1, F.greatest(k - 2, F.lit(0))), lambda x: x > 0)
        # three digits are 96 bits; what lies below them is marked by a half
        head = ((digit(0) * base + digit(1)).cast("decimal(22,0)") * F.lit(1 << WIDTH).cast("decimal(10,0)") + digit(2)).cast("decimal(33,0)")
        mantissa = (head + F.when(below, 0.5).otherwise(0.0).cast("decimal(1,1)")).cast("decimal(34,1)").cast("double")
        power = WIDTH * (lowest + k - 2)
        half = F.floor(power / 2)
        return number["sign"] * mantissa * F.pow(F.lit(2.0), half) * F.pow(F.lit(2.0), power - half)

    places = F.filter(F.sequence(F.lit(0), F.size(number["digits"]) - 1), lambda i: F.get(number["digits"], i) > 0)
    return _let(F.array_max(places), lambda k: F.when(k.isNull(), F.lit(0.0)).otherwise(at(k)))


def read_out(entries: Column) -> Column:
    """The double next to the sum of rung totals: array<struct<rung int, total decimal(38,0)>>.

    Every rung stands once at most. Ties go to the even neighbour, as with a
    single addition. Beyond the largest double the result is infinite; a
    result that is subnormal may be rounded twice.
    """

    def of(es: Column) -> Column:
        rungs = F.transform(es, lambda e: e["rung"])
        total = lambda i: F.coalesce(F.get(F.filter(es, lambda e: e["rung"] == i), F.lit(0))["total"], F.lit(0).cast("decimal(38,0)"))
        # room for the last carries above the highest rung
        dense = F.transform(F.sequence(F.array_min(rungs), F.array_max(rungs) + 4), total)
        # of the sum and its negative, the one that leaves no carry is not negative
        both = _let(dense, lambda ts: F.filter(F.transform(F.array(F.lit(1), F.lit(-1)), lambda g: _digits(ts, g)), lambda x: x["carry"] == 0))
        return _let(F.get(both, F.lit(0)), lambda x: _rounded(x, F.array_min(rungs)))

    return F.when(F.size(entries) == 0, F.lit(0.0)).otherwise(_let(entries, of))
