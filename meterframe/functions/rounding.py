"""Numeric storage classes that Spark has no type for."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

HALF_MAX = 65504.0  # largest finite half-precision number
HALF_MANTISSA_BITS = 10
HALF_MIN_EXPONENT = -14


def quantize_half(value: Column) -> Column:
    """Round a double to the nearest half-precision number, ties to even.

    The result stays a DOUBLE; beyond the half range it becomes infinite, as
    the 16-bit format does.
    """
    size = F.abs(value)
    exponent = F.greatest(F.floor(F.log2(size)), F.lit(HALF_MIN_EXPONENT))
    step = F.pow(F.lit(2.0), exponent - HALF_MANTISSA_BITS)
    rounded = F.rint(value / step) * step
    # 65520 is where rounding leaves the finite range.
    overflow = F.when(value > 0, F.lit(float("inf"))).otherwise(F.lit(float("-inf")))
    return F.when(size == 0, F.lit(0.0)).when(size >= 65520.0, overflow).otherwise(rounded)


def to_units(value: Column, digits: int) -> Column:
    """A reading with a fixed number of decimals as a whole number of units.

    Sums of units are exact and do not depend on the order of the rows, so a
    task that is run again after a lost executor gives the same bits.  What no
    whole number can hold (NaN, infinity) counts as missing.
    """
    scaled = value * F.lit(10.0**digits)
    return F.when(F.abs(scaled) < F.lit(9.2e18), F.rint(scaled).cast("bigint"))


def finite(value: Column) -> Column:
    """The number, or null for NaN and infinity."""
    return F.when(F.abs(value) < F.lit(float("inf")), value)


def from_units(units: Column, digits: int) -> Column:
    return units / F.lit(10.0**digits)
