"""Numeric column expressions shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Ratios are summed as integers on this grid, so that sums do not depend on row order or
# partitioning.
RATIO_GRID = 1e9


def half_even(value: Column, digits: int) -> Column:
    """Round to ``digits`` decimals, ties on the scaled value going to even."""
    scale = float(10**digits)
    return F.rint(value * scale) / scale


def exact_sum(integers: Column) -> Column:
    """The sum of integers as a decimal of 38 digits, exact for any number of rows."""
    return F.sum(integers.cast("decimal(28,0)"))


# 64-bit integers are summed in digits of so many bits, each in a long: 2^42 rows fit.
DIGIT_BITS = 21
_DIGIT = (1 << DIGIT_BITS) - 1


def _digit_sum(high: Column, rest: Column, where: Column | None) -> Column:
    """The sum of high * 2^42 + rest from sums of longs, put together once per group."""
    kept = (lambda c: c) if where is None else (lambda c: F.when(where, c))
    digits = (high, F.shiftright(rest, DIGIT_BITS), rest.bitwiseAND(F.lit(_DIGIT)))
    sums = [F.sum(kept(digit)).cast("decimal(20,0)") for digit in digits]
    scale = lambda bits: F.lit(1 << bits).cast("decimal(13,0)")
    return sums[0] * scale(2 * DIGIT_BITS) + sums[1] * scale(DIGIT_BITS) + sums[2]


def long_sum(integers: Column, where: Column | None = None) -> Column:
    """The exact sum of 64-bit integers as a decimal, without decimals per row."""
    rest = integers.bitwiseAND(F.lit((1 << 2 * DIGIT_BITS) - 1))
    return _digit_sum(F.shiftright(integers, 2 * DIGIT_BITS), rest, where)


def on_grid(value: Column) -> Column:
    """A ratio of moderate size as an integer on the grid."""
    return F.rint(value * RATIO_GRID).cast("long")


def grid_sum(value: Column, where: Column | None = None) -> Column:
    """The exact sum of a ratio's places on the grid, of any size up to 2^105."""
    place = F.rint(value * RATIO_GRID)
    high = F.floor(place / float(1 << 2 * DIGIT_BITS))
    rest = (place - high * float(1 << 2 * DIGIT_BITS)).cast("long")
    return _digit_sum(high, rest, where)


def grid_mean(value: Column, where: Column | None = None) -> Column:
    """Mean of a ratio, independent of row order (see RATIO_GRID)."""
    count = F.count(value) if where is None else F.count(F.when(where, value))
    return grid_sum(value, where).cast("double") / RATIO_GRID / count


def rounded_away(integers: Column, unit: int) -> Column:
    """Whole units of an integer that is not negative, ties away from zero."""
    shifted = integers.cast("decimal(38,0)") + F.lit(unit // 2)
    return F.floor((shifted - F.pmod(shifted, F.lit(unit).cast("decimal(38,0)"))) / F.lit(unit)).cast("double")


def clamp(value: Column, low: float, high: float) -> Column:
    return F.greatest(F.lit(low), F.least(F.lit(high), value))


def is_finite(value: Column) -> Column:
    """True for a number that is neither NULL, NaN nor infinite."""
    as_double = value.cast("double")
    return F.coalesce(
        ~F.isnan(as_double) & (F.abs(as_double) != F.lit(float("inf"))), F.lit(False)
    )


def finite_or_zero(value: Column) -> Column:
    return F.when(is_finite(value), value.cast("double")).otherwise(F.lit(0.0))


def signed_log(value: Column) -> Column:
    return F.signum(value) * F.log1p(F.abs(value))


def hash_bucket(value: Column, buckets: int) -> Column:
    """A bucket in [0, buckets) from the first 32 bits of the MD5 digest."""
    prefix = F.conv(F.substring(F.md5(value), 1, 8), 16, 10).cast("long")
    return prefix % F.lit(buckets)
