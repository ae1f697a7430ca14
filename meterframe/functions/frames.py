"""Aggregates over the n rows before the current one, by name.

Each function takes (column, window, n) and returns an expression that is
null unless all n rows exist and hold a value.
"""

from __future__ import annotations

from pyspark.sql import Column, Window, WindowSpec
from pyspark.sql import functions as F

from .rounding import from_units, to_units


def _builtin(fn):
    return lambda c, frame, n: fn(c).over(frame)


def _sem(c, frame, n):
    return F.stddev_samp(c).over(frame) / F.sqrt(F.lit(float(n)))


def _median(c, frame, n):
    return F.percentile(c, F.lit(0.5)).over(frame)


def _flat(c, frame):
    """Whether all values are equal.  Such a window has skewness 0 and excess
    kurtosis -3, as pandas has it."""
    return F.min(c).over(frame) == F.max(c).over(frame)


def _skew(c, frame, n):
    """Bias-corrected skewness (needs three rows)."""
    if n < 3:
        return F.lit(None).cast("double")
    skew = F.skewness(c).over(frame) * F.lit((n * (n - 1)) ** 0.5 / (n - 2))
    return F.when(_flat(c, frame), F.lit(0.0)).otherwise(skew)


def _kurt(c, frame, n):
    """Bias-corrected excess kurtosis (needs four rows)."""
    if n < 4:
        return F.lit(None).cast("double")
    kurt = F.lit((n - 1) / ((n - 2) * (n - 3))) * ((n + 1) * F.kurtosis(c).over(frame) + 6)
    return F.when(_flat(c, frame), F.lit(-3.0)).otherwise(kurt)


def _rank(c, frame, n):
    """Average rank of the newest row among the n rows."""
    seen = F.collect_list(c).over(frame)
    newest = F.element_at(seen, -1)
    below = F.size(F.filter(seen, lambda x: x < newest))
    equal = F.size(F.filter(seen, lambda x: x == newest))
    return below + (equal + 1) / 2


ROLLING = {
    "sum": _builtin(F.sum),
    "mean": _builtin(F.avg),
    "var": _builtin(F.var_samp),
    "std": _builtin(F.stddev_samp),
    "sem": _sem,
    "min": _builtin(F.min),
    "max": _builtin(F.max),
    "median": _median,
    "skew": _skew,
    "kurt": _kurt,
    "rank": _rank,
}


def check_name(name: str) -> None:
    if name != "count" and name not in ROLLING:
        raise ValueError(f"unknown rolling aggregate {name!r}; known: {sorted([*ROLLING, 'count'])}")


def rolling(name: str, c: Column, window: WindowSpec, n: int, place: Column) -> Column:
    """The named aggregate of the n rows before the current row."""
    check_name(name)
    frame = window.rowsBetween(-n, -1)
    if name == "count":
        # Values among the previous n rows, once n - 1 rows lie behind.
        return F.when(place >= n - 1, F.count(c).over(frame))
    return F.when(F.count(c).over(frame) == n, ROLLING[name](c, frame, n))


# Aggregates that follow from the sums of whole units and of their squares.
# The running sums are exact, so the difference of two of them is the exact sum
# of the rows between: the cost per row does not depend on the window's length.
WIDE = "decimal(38,0)"
FROM_TOTALS = ("sum", "mean", "var", "std", "sem")


def running_totals(c: Column, window: WindowSpec, digits: int, squares: bool) -> dict[str, Column]:
    so_far = window.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    units = to_units(c, digits)
    wide = units.cast("decimal(19,0)")
    totals = {"count": F.count(units).over(so_far), "sum": F.sum(wide).over(so_far).cast(WIDE)}
    if squares:
        totals["squares"] = F.sum((wide * wide).cast("decimal(28,0)")).over(so_far).cast(WIDE)
    return totals


def from_totals(name: str, column: str, window: WindowSpec, n: int, digits: int) -> Column:
    """``name`` over the n rows before, from columns ``__{total}_{column}``."""

    def between(total: str) -> Column:
        c = f"__{total}_{column}"
        end, start = F.lag(c, 1).over(window), F.lag(c, n + 1).over(window)
        return (end - F.coalesce(start, F.lit(0).cast(WIDE))).cast(WIDE)

    if name == "sum":
        value = from_units(between("sum").cast("double"), digits)
    elif name == "mean":
        value = from_units(between("sum").cast("double") / n, digits)
    elif n < 2:
        value = F.lit(None).cast("double")
    else:
        total = between("sum")
        scatter = (between("squares") * F.lit(n).cast(WIDE)).cast(WIDE) - (total * total).cast(WIDE)
        value = scatter.cast("double") / (n * (n - 1)) / F.lit(10.0 ** (2 * digits))
        if name != "var":
            value = F.sqrt(value)
        if name == "sem":
            value = value / F.sqrt(F.lit(float(n)))
    return F.when(between("count") == n, value)
