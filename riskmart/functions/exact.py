"""Sums and averages of doubles that do not depend on the order of the rows.

Spark adds doubles in the order in which tasks and partitions happen to deliver them, so
the last bits of a plain ``sum`` or ``avg`` change with the number of partitions.  Here
each double is split into whole numbers of 24 bits (limbs) at fixed places, the limbs are
summed as longs, which no order can change, and the total is rounded to a double once.

A limb of 24 bits leaves 39 bits of a long for the number of rows (5e11 in one group).
Values below 2^53 in size are split exactly down to multiples of 2^-96, which every double
from 2^-43 up is; what a smaller one has below that is cut off, the same for any order.
Larger values, infinities and NaN are added as plain doubles on top.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

LIMB = 24
TOP = 48                          # the first limb counts units of 2^48
LIMBS = 7                         # the last one units of 2^-96
LARGEST = float(1 << 53)
_WINDOW = 4                       # limbs that hold every bit a double can show, and one more


def _let(value: Column, then: Callable[[Column], Column]) -> Column:
    """``then(value)`` with the value worked out once."""
    return F.transform(F.array(value), then)[0]


def _limbs(x: Column) -> list[Column]:
    """The limbs of each value, from the top, all of its sign: sum(limb * 2^place) is the value."""
    out, rest = [], F.abs(x) * F.lit(2.0 ** -TOP)
    for _ in range(LIMBS):
        whole = F.floor(rest)
        out.append(F.when(x < 0, -whole).otherwise(whole))
        rest = (rest - whole) * F.lit(float(1 << LIMB))
    return out


def _carried(sums: Column) -> Column:
    """Limb sums with every limb but the first brought into 0 .. 2^24 - 1."""
    start = F.struct(F.lit(0).cast("bigint").alias("carry"), F.array().cast("array<bigint>").alias("limbs"))

    def step(done: Column, limb: Column) -> Column:
        return _let(limb + done["carry"], lambda v: F.struct(
            F.shiftright(v, LIMB).alias("carry"),
            F.concat(F.array(v.bitwiseAND(F.lit((1 << LIMB) - 1))), done["limbs"]).alias("limbs")))

    def finish(done: Column) -> Column:
        first = F.shiftleft(done["carry"], LIMB) + done["limbs"][0]
        return F.concat(F.array(first), F.slice(done["limbs"], 2, LIMBS - 1))

    return F.aggregate(F.reverse(sums), start, step, finish)


def _nearest(limbs: Column) -> Column:
    """The double nearest to carried limbs of a total that is not negative."""
    def window(at: int) -> Column:
        whole = F.lit(0).cast("decimal(38,0)")
        for k in range(at, at + _WINDOW):
            whole = (whole * F.lit(1 << LIMB).cast("decimal(9,0)")).cast("decimal(38,0)") + limbs[k].cast("decimal(20,0)")
            whole = whole.cast("decimal(38,0)")
        below = F.lit(False)
        for k in range(at + _WINDOW, LIMBS):
            below = below | (limbs[k] != 0)
        # one more bit tells whether anything is left below, so that a tie is one
        whole = (whole * F.lit(2).cast("decimal(1,0)")).cast("decimal(38,0)") + F.when(below, 1).otherwise(0).cast("decimal(1,0)")
        return whole.cast("decimal(38,0)").cast("double") * F.lit(2.0 ** (TOP - LIMB * (at + _WINDOW - 1) - 1))

    last = LIMBS - _WINDOW
    out = window(last)
    for at in reversed(range(last)):
        out = F.when(limbs[at] != 0, window(at)).otherwise(out)
    return out


def _total(sums: Column) -> Column:
    def signed(limbs: Column) -> Column:
        return F.when(limbs[0] < 0, -_let(_carried(F.transform(sums, lambda s: -s)), _nearest)).otherwise(_nearest(limbs))
    return _let(_carried(sums), signed)


def exact_sum(c: Column | str) -> Column:
    """Aggregate: the sum of a double column, the same bits for any order of rows; NULL without values."""
    x = F.col(c) if isinstance(c, str) else c
    fits = F.abs(x) < F.lit(LARGEST)
    inside = F.when(fits, x)
    plain = F.sum(F.when(~fits | F.isnan(x), x))
    sums = F.array(*(F.sum(limb) for limb in _limbs(inside)))
    total = F.when(F.count(inside) > 0, _let(sums, _total))
    return F.when(plain.isNull(), total).otherwise(plain + F.coalesce(total, F.lit(0.0)))


def exact_avg(c: Column | str) -> Column:
    """Aggregate: :func:`exact_sum` divided by the number of values; NULL without values."""
    return F.try_divide(exact_sum(c), F.count(c if isinstance(c, Column) else F.col(c)))
