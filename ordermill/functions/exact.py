"""Sums of doubles that do not depend on the order of the rows.

Every value is cut into four whole numbers at fixed places: multiples of 2**31, of
1, of 2**-31 and of 2**-62. Whole numbers add up the same in any order, and are put
together once at the end. A value is exact in these places unless it has bits below
2**-62, which are rounded away in the value, so the result is off by no more than
2**-63 for each value, and by the last rounding.

Values from 2**62 on, infinities and NaN are added up as doubles beside the rest.
Nulls are left out; of nothing the sum is null, as ``sum`` has it. A sum may have
2**32 values.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_STEP = float(1 << 31)
_BITS, _MASK = 31, (1 << 31) - 1
#: Values from here on do not fit the places.
LARGE = float(1 << 62)


def _halves(value: Column) -> tuple[Column, Column]:
    """The whole part of a double, and its fraction in steps of 2**-31."""
    rest = value % 1.0
    return value - rest, rest * _STEP


def _high(half: Column, step: float) -> Column:
    return (half / step).cast("long") if step != 1.0 else half.cast("long")


def _low(whole: Column, high: Column, scaled: Column, upper: Column) -> tuple[Column, Column]:
    """What the higher place of each half leaves over."""
    low = (whole - high.cast("double") * _STEP).cast("long")
    return low, F.rint((scaled - upper.cast("double")) * _STEP).cast("long")


def _places(value: Column) -> list[Column]:
    """The four whole numbers of a double below ``LARGE``."""
    whole, scaled = _halves(value)
    high, upper = _high(whole, _STEP), _high(scaled, 1.0)
    low, lower = _low(whole, high, scaled, upper)
    return [high, low, upper, lower]


def _is_large(value: Column) -> Column:
    return F.isnan(value) | (F.abs(value) >= LARGE)


def _together(high: Column, low: Column, upper: Column, lower: Column) -> Column:
    """The sum as a double; carries go up first, so equal sums have equal places."""
    upper = upper + F.shiftright(lower, _BITS)
    low = low + F.shiftright(upper, _BITS)
    high = high + F.shiftright(low, _BITS)
    whole = high.cast("double") * _STEP + low.bitwiseAND(F.lit(_MASK)).cast("double")
    part = upper.bitwiseAND(F.lit(_MASK)) * F.lit(1 << _BITS) + lower.bitwiseAND(F.lit(_MASK))
    return whole + part.cast("double") / (_STEP * _STEP)


def exact_sum(value: Column) -> Column:
    """Aggregate: the sum of doubles, in whatever order rows arrive."""
    value = value.cast("double")
    large = _is_large(value)
    places = [F.coalesce(F.sum(p), F.lit(0)) for p in _places(F.when(~large, value))]
    beside = F.sum(F.when(large, value))
    total = _together(*places)
    return F.when(F.count(value) > 0, F.when(beside.isNull(), total).otherwise(total + beside))


def exact_total(values: Column) -> Column:
    """The sum of an array of doubles, equal to ``exact_sum`` of its elements.

    As for the sums of ``totals``, an empty array has the sum 0, and a null element
    makes the sum null.
    """
    nothing = F.struct(
        *[F.lit(0).cast("long").alias(p) for p in "abcd"], F.lit(None).cast("double").alias("beside")
    )

    # Functions of arrays are interpreted: a step for each value that is used again, as
    # one expression for all would compute the earlier ones over and over.
    def parted(value: Column) -> Column:
        large = _is_large(value)
        small = F.when(~large, value).otherwise(F.when(large, F.lit(0.0)))
        return F.struct(small.alias("small"), F.when(large, value).alias("beside"))

    def halved(x: Column) -> Column:
        whole, scaled = _halves(x["small"])
        return F.struct(whole.alias("whole"), scaled.alias("scaled"), x["beside"].alias("beside"))

    def raised(x: Column) -> Column:
        high, upper = _high(x["whole"], _STEP), _high(x["scaled"], 1.0)
        return F.struct(
            x["whole"].alias("whole"), x["scaled"].alias("scaled"), high.alias("high"),
            upper.alias("upper"), x["beside"].alias("beside"),
        )

    def add(total: Column, x: Column) -> Column:
        low, lower = _low(x["whole"], x["high"], x["scaled"], x["upper"])
        beside = F.coalesce(total["beside"] + x["beside"], x["beside"], total["beside"])
        return F.struct(
            *[(total[p] + n).alias(p) for p, n in zip("abcd", (x["high"], low, x["upper"], lower))],
            beside.alias("beside"),
        )

    def finish(total: Column) -> Column:
        whole = _together(*[total[p] for p in "abcd"])
        return F.when(total["beside"].isNull(), whole).otherwise(whole + total["beside"])

    steps = F.transform(F.transform(F.transform(values, parted), halved), raised)
    return F.aggregate(steps, nothing, add, finish)
