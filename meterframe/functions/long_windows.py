"""Rolling aggregates whose cost does not grow with the window.

*Minimum and maximum.*  Rows are cut into blocks of n.  Going back in time, a
running extremum tells for each row the extremum from it to its block's end;
going forward, the one from the block's start to it.  The n rows before a row
lie in two blocks, or are one, so their extremum is the better of two lookups.

*Median and rank.*  A sorted list holds the values of the window.  It takes in
one value and gives up one per row, found by bisection; the median and the newest
value's rank are read off by place.  Rows go through it in Arrow batches, in the
order in which a window over their series has left them.  NaN is ordered as
infinity.
"""

from __future__ import annotations

import sys
from bisect import bisect_left, bisect_right, insort
from collections import deque
from collections.abc import Sequence

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql import types as T

cloudpickle.register_pickle_by_value(sys.modules[__name__])

LONG = 32  # windows of more rows are long
EXTREMA, ORDERED = ("min", "max"), ("median", "rank")


def _so_far(w: WindowSpec) -> WindowSpec:
    return w.rowsBetween(Window.unboundedPreceding, Window.currentRow)


def _best(agg: str, block: Column, value: Column, w: WindowSpec) -> Column:
    """The extremum of ``value`` so far within the block, if blocks are numbered
    upwards in the order of ``w``."""
    if agg == "max":
        return F.max(F.struct(block.alias("b"), value.alias("v"))).over(_so_far(w))["v"]
    return F.min(F.struct((-block).alias("b"), value.alias("v"))).over(_so_far(w))["v"]


def with_block_ends(df: DataFrame, columns: Sequence[str], windows: Sequence[int], aggs: Sequence[str], backward: WindowSpec) -> DataFrame:
    """Adds ``__block_{n}`` and ``__{agg}_end_{column}_{n}``; ``backward`` runs
    from a series' last row to its first."""
    placed = df.withColumn("__back", F.row_number().over(backward) - 1)
    blocked = placed.withColumns({f"__block_{n}": F.expr(f"__back div {n}") for n in windows}).drop("__back")
    return blocked.withColumns(
        {f"__{agg}_end_{c}_{n}": _best(agg, F.col(f"__block_{n}"), F.col(c), backward) for n in windows for agg in aggs for c in columns}
    )


def block_starts(columns: Sequence[str], windows: Sequence[int], aggs: Sequence[str], w: WindowSpec) -> dict[str, Column]:
    """``__{agg}_start_{column}_{n}`` and ``__seen_{column}``, the values so far."""
    out = {f"__{agg}_start_{c}_{n}": _best(agg, -F.col(f"__block_{n}"), F.col(c), w) for n in windows for agg in aggs for c in columns}
    return out | {f"__seen_{c}": F.count(c).over(_so_far(w)) for c in columns}


def from_blocks(agg: str, c: str, w: WindowSpec, n: int) -> Column:
    """The extremum of the n rows before; null unless all hold a value."""
    seen = F.lag(f"__seen_{c}", 1).over(w) - F.coalesce(F.lag(f"__seen_{c}", n + 1).over(w), F.lit(0))
    pick = F.greatest if agg == "max" else F.least
    return F.when(seen == n, pick(F.lag(f"__{agg}_end_{c}_{n}", n).over(w), F.lag(f"__{agg}_start_{c}_{n}", 1).over(w)))


class SortedWindow:
    """The last n values of a series, in order of time and of size."""

    def __init__(self, n: int):
        self.n, self.rows, self.sorted = n, deque(), []

    def push(self, value: float | None) -> None:
        if value is not None and value != value:
            value = float("inf")
        self.rows.append(value)
        if value is not None:
            insort(self.sorted, value)
        if len(self.rows) > self.n:
            old = self.rows.popleft()
            if old is not None:
                del self.sorted[bisect_left(self.sorted, old)]

    @property
    def full(self) -> bool:
        return len(self.sorted) == self.n

    def median(self) -> float:
        half = self.n // 2
        return self.sorted[half] if self.n % 2 else 0.5 * self.sorted[half - 1] + 0.5 * self.sorted[half]

    def rank(self) -> float:
        """Average rank of the newest value."""
        newest = self.rows[-1]
        below = bisect_left(self.sorted, newest)
        return below + (bisect_right(self.sorted, newest) - below + 1) / 2


def with_ordered(df: DataFrame, series: Sequence[str], columns: Sequence[str], windows: Sequence[int], aggs: Sequence[str], w: WindowSpec) -> DataFrame:
    """Adds ``rolling_{agg}_{column}_{n}``.  ``w`` is the window over ``series``;
    the place of rows in it is checked, so that rows in another order would be an
    error and not a wrong result."""
    placed = df.withColumn("__place", F.row_number().over(w))
    names = [(f"rolling_{agg}_{c}_{n}", agg, c, n) for n in windows for agg in aggs for c in columns]
    given = df.columns

    def run(batches):
        now, place, held = None, 0, {}
        for batch in batches:
            keys = list(zip(*[batch.column(k).to_pylist() for k in series]))
            places = batch.column("__place").to_pylist()
            values = {c: batch.column(c).cast(pa.float64()).to_pylist() for c in columns}
            out: dict[str, list] = {name: [] for name, *_ in names}
            for i, key in enumerate(keys):
                if key != now:
                    now, place = key, 0
                    held = {(c, n): SortedWindow(n) for c in columns for n in windows}
                place += 1
                if places[i] != place:
                    raise RuntimeError("the rows of a series are not in order")
                for name, agg, c, n in names:
                    window = held[c, n]
                    out[name].append(getattr(window, agg)() if window.full else None)
                for (c, _), window in held.items():
                    window.push(values[c][i])
            kept = [batch.column(c) for c in given]
            yield pa.RecordBatch.from_arrays([*kept, *[pa.array(out[name], pa.float64()) for name, *_ in names]], [*given, *out])

    return placed.mapInArrow(run, T.StructType([*df.schema.fields, *[T.StructField(name, T.DoubleType()) for name, *_ in names]]))
