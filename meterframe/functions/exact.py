"""Exact sums of readings, whatever their digits.

A reading is taken apart into whole numbers, its *limbs*.  Their sums are exact,
so they do not depend on the order of rows, and the difference of two running
sums is the exact sum of the rows between: 1e16 once, and gone again, leaves
nothing behind.

With ``digits`` a reading is one whole number of units.  Without, it is a fixed-
point number in base 2^32: limb i counts multiples of 2^(32 i + low), all but
the last are from 0 to 2^32 - 1, and the last carries the sign.  ``low`` and the
number of limbs follow from the smallest and the largest reading, such that every
bit of every reading has its place.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from .rounding import finite, from_units, to_units

BITS = 32
BASE = 1 << BITS
MANTISSA = 53
WIDE = "decimal(38,0)"


@dataclass(frozen=True)
class Units:
    """Readings with a fixed number of decimals."""

    digits: int

    def limbs(self, value: Column) -> list[Column]:
        return [to_units(value, self.digits).cast("decimal(19,0)")]

    def count(self, value: Column) -> Column:
        return F.count(to_units(value, self.digits))

    def carried(self, sums: list[Column]) -> list[Column]:
        return [s.cast(WIDE) for s in sums]

    def ratio(self, sums: list[Column], n: Column) -> Column:
        """The sum by n as a double."""
        return from_units(sums[0].cast("double") / n, self.digits)


@dataclass(frozen=True)
class Limbs:
    """Doubles of any size between two powers of two."""

    low: int
    size: int

    @classmethod
    def between(cls, least: float | None, most: float | None) -> Limbs:
        """``least`` and ``most`` of the readings' sizes, zero aside."""
        import math

        if not most:
            return cls(0, 1)
        low = max(math.frexp(least)[1] - MANTISSA, -1074)
        # One bit more for the sign, one for rounding of the first digit.
        return cls(low, -(-(math.frexp(most)[1] + 2 - low) // BITS))

    def _floor(self, value: Column, place: int) -> Column:
        """value / 2^place without what follows the point: exact, as a double."""
        scaled = value
        for step in _powers(-place):
            scaled = scaled * F.lit(step)
        return F.when(F.abs(scaled) < F.lit(2.0**MANTISSA), F.floor(scaled).cast("double")).otherwise(scaled)

    def limbs(self, value: Column) -> list[Column]:
        value = finite(value)
        places = [self.low + BITS * i for i in range(self.size)]
        floors = [self._floor(value, place) for place in places]
        lower = []
        for place, here, above in zip(places, floors, floors[1:]):
            digit = (here - above * F.lit(float(BASE))).cast("bigint")
            beyond = place + BITS + MANTISSA  # a larger number has no bit so low
            lower.append(digit if beyond > 1023 else F.when(F.abs(value) >= F.lit(2.0**beyond), F.lit(0).cast("bigint")).otherwise(digit))
        return [*lower, floors[-1].cast("bigint")]

    def count(self, value: Column) -> Column:
        return F.count(finite(value))

    def carried(self, sums: list[Column]) -> list[Column]:
        """Sums with all but the last brought below 2^32."""
        out, over = [], F.lit(0).cast("bigint")
        for s in sums[:-1]:
            whole = (s.cast(WIDE) + over.cast(WIDE)).cast(WIDE)
            # Floor, also of negative differences.
            over = F.floor((whole / F.lit(BASE).cast("decimal(11,0)")).cast("decimal(38,10)")).cast("bigint")
            out.append((whole - over.cast(WIDE) * F.lit(BASE).cast("decimal(11,0)")).cast("bigint"))
        return [*out, (sums[-1].cast(WIDE) + over.cast(WIDE)).cast("bigint")]

    def ratio(self, sums: list[Column], n: Column) -> Column:
        """The sum by n as a double, from the highest limb down: each step adds
        a number smaller than the last place of what is there, or is exact."""
        over, digits = F.lit(0).cast("bigint"), []
        for s in sums[:-1]:
            whole = s + over
            over = F.shiftright(whole, BITS)
            digits.append(whole - F.shiftleft(over, BITS))
        total = _scaled((sums[-1] + over).cast("double"), self.low + BITS * (self.size - 1))
        for i in range(self.size - 2, -1, -1):
            total = total + _scaled(digits[i].cast("double"), self.low + BITS * i)
        return total / n


def _powers(exponent: int) -> list[float]:
    """Factors whose product is 2^exponent; each is a double of its own."""
    out = []
    while exponent:
        step = max(min(exponent, 1000), -1000)
        out.append(2.0**step)
        exponent -= step
    return out


def _scaled(value: Column, place: int) -> Column:
    for step in _powers(place):
        value = value * F.lit(step)
    return value


def sizes(value: Column) -> list[Column]:
    """Smallest and largest size of the readings, as aggregates."""
    size = F.abs(finite(value))
    return [F.min(F.when(size > 0, size)), F.max(size)]
