"""Exact sums of doubles: the same bits whatever the order and partitioning of the rows.

A double is cut into whole numbers of 32 bits by the power of two that they stand for, from
2^-128 to 2^128. Such limbs are summed as decimals, which loses nothing and merges in any order,
and the total is rounded to a double once. All of it is built-in expressions, so it
runs inside the hash aggregation, with partial sums before the shuffle and in streams.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, functions as F

BITS = 32
LOWEST, HIGHEST = -4, 3  # limbs: multiples of 2^(32 k)
_BASE = float(2**BITS)


def exact_limbs(value: Column) -> list[Column]:
    """The limbs of a double, lowest first, as decimals; their sums weighted by 2^(32 k) are the value.

    NULL, NaN and infinities have NULL limbs. A value of 2^128 or more, or with bits below
    2^-128 (nonzero ones below 2^-75 may have), is an error: to round it would change sums unseen.
    """
    size = F.abs(value)
    known = value.isNotNull() & ~F.isnan(value) & (size != F.lit(float("inf")))
    # Scaling by a power of two and cutting the fraction off are exact.
    whole = [_whole(size, k) for k in range(LOWEST, HIGHEST + 2)]
    told = F.concat(F.lit("value has bits outside 2^-128 to 2^128: "), value.cast("string"))
    outside = (size >= F.lit(2.0**128)) | (whole[0] * F.lit(2.0 ** (BITS * LOWEST)) != size)
    sign = F.signum(value)
    limbs = []
    for low, above in zip(whole, whole[1:]):
        limb = (sign * (low - above * F.lit(_BASE))).cast("decimal(18,0)")
        limbs.append(
            F.when(known & outside, F.raise_error(told).cast("decimal(18,0)")).when(known, limb)
        )
    return limbs


def _whole(size: Column, k: int) -> Column:
    """``size`` in units of 2^(32 k), without its fraction, as a double.

    ``floor`` gives a LONG, so numbers that are whole already (2^53 and more) pass as they are.
    """
    scaled = size * F.lit(2.0 ** (-BITS * k))
    return F.when(scaled < F.lit(2.0**53), F.floor(scaled).cast("double")).otherwise(scaled)


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once, however often it stands in the result."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _wide(value: Column) -> Column:
    return value.cast("decimal(38,0)")


def _carried(limbs: Column) -> Column:
    """Limb sums as digits 0 to 2^32 - 1, lowest first, and what is left over above them."""
    base = _wide(F.lit(2**BITS))
    start = F.struct(_wide(F.lit(0)).alias("carry"), F.array().cast("array<decimal(38,0)>").alias("digits"))

    def step(state: Column, limb: Column) -> Column:
        total = _wide(state["carry"] + limb)
        digit = _wide(F.pmod(total, base))
        carry = _wide(F.floor((total - digit) / base))
        return F.struct(carry.alias("carry"), F.concat(state["digits"], F.array(digit)).alias("digits"))

    return F.aggregate(limbs, start, step)


def _digits(carried: Column) -> Column:
    """All digits of a sum that is not negative."""
    base, over = _wide(F.lit(2**BITS)), carried["carry"]
    low = _wide(F.pmod(over, base))
    return F.concat(carried["digits"], F.array(low, _wide(F.floor((over - low) / base))))


def _rounded(digits: Column) -> Column:
    """The double nearest to a number of digits, half to even."""
    n, base = HIGHEST - LOWEST + 3, _wide(F.lit(2**BITS))
    highest = F.aggregate(
        F.sequence(F.lit(1), F.lit(n)), F.lit(0), lambda best, i: F.when(F.element_at(digits, i) != 0, i).otherwise(best)
    )
    scales = F.array(*(F.lit(2.0 ** (BITS * (LOWEST + i - 2))) for i in range(n)))

    def nearest(top: Column) -> Column:
        def digit(back: int) -> Column:
            """The digit ``back`` places below the highest that is not 0."""
            return F.when(top > back, F.element_at(digits, F.greatest(top - back, F.lit(1)))).otherwise(_wide(F.lit(0)))

        # Three digits hold 65 bits or more; one bit more tells that something nonzero lies below.
        head = _wide(_wide(_wide(digit(0) * base + digit(1)) * base) + digit(2))
        below = F.exists(F.slice(digits, F.lit(1), F.greatest(top - 3, F.lit(0))), lambda d: d != 0)

        def scaled(h: Column) -> Column:
            odd = F.when(below & (F.pmod(h, F.lit(2)) == 0), F.lit(1)).otherwise(F.lit(0))
            return _wide(h + odd).cast("double") * F.element_at(scales, F.greatest(top, F.lit(1)))

        return F.when(top == 0, F.lit(0.0)).otherwise(_let(head, scaled))

    return _let(highest, nearest)


def exact_value(limbs: list[Column]) -> Column:
    """The double nearest to summed limbs; NULL if nothing was summed."""

    def signed(plain: Column) -> Column:
        def of_sign(negative: Column) -> Column:
            turned = F.transform(plain, lambda x: _wide(F.when(negative, -x).otherwise(x)))
            size = _let(_let(_carried(turned), _digits), _rounded)
            return F.when(negative, -size).otherwise(size)

        return _let(_carried(plain)["carry"] < 0, of_sign)

    return F.when(limbs[0].isNotNull(), _let(F.array(*map(_wide, limbs)), signed))


def exact_sum(value: Column) -> Column:
    """Aggregate: the exact sum of doubles, rounded once."""
    return exact_value([F.sum(limb) for limb in exact_limbs(value)])
