"""Features from a meter's own past.  All frames count rows, not hours."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import frames, long_windows
from ..functions.frames import WIDE
from .series import SeriesOrder, SeriesParts, energy_columns, over_series

HOURS_PER_DAY = 24


def add_lags(
    df: DataFrame,
    lags: Sequence[int],
    parts: SeriesParts | None = None,
    order: SeriesOrder = SeriesOrder(),
    **measured,
) -> DataFrame:
    """``lagged_{n}_{column}``: the value n rows earlier, else null."""

    def build(frame: DataFrame, p: SeriesParts) -> DataFrame:
        w = p.window()
        return frame.select(
            "*",
            *[
                F.lag(c, n).over(w).alias(f"lagged_{n}_{c}")
                for n in lags
                for c in energy_columns(frame)
            ],
        )

    return over_series(df, parts, build, lookback=max(lags), order=order, **measured)


def add_rolling_stats(
    df: DataFrame,
    windows: Sequence[int],
    aggs: Sequence[str],
    parts: SeriesParts | None = None,
    order: SeriesOrder = SeriesOrder(),
    digits: int | None = None,
    **measured,
) -> DataFrame:
    """``rolling_{agg}_{column}_{n}`` over the n rows before the current row;
    null unless all n hold a value.  Minima, maxima, medians and ranks of more
    than ``long_windows.LONG`` rows cost as much as those of a few.

    ``digits`` says how many decimals readings have.  Sums, means and spreads
    are then exact, the same on every run, and taken from running totals.
    """
    for agg in aggs:
        frames.check_name(agg)
    exact = [a for a in aggs if digits is not None and a in frames.FROM_TOTALS]
    squares = any(a in ("var", "std", "sem") for a in exact)

    long = [n for n in windows if n > long_windows.LONG]
    extrema = [a for a in aggs if a in long_windows.EXTREMA]
    ordered = [a for a in aggs if a in long_windows.ORDERED]

    def build(frame: DataFrame, p: SeriesParts) -> DataFrame:
        w = p.window()
        columns = energy_columns(frame)
        names = frame.columns
        if extrema and long:
            frame = long_windows.with_block_ends(frame, columns, long, extrema, p.backward())
        helpers = {
            f"__{total}_{c}": value
            for c in columns
            if exact
            for total, value in frames.running_totals(F.col(c), w, digits, squares).items()
        }
        if "count" in aggs:
            helpers["__place"] = p.position()
        if extrema and long:
            helpers |= long_windows.block_starts(columns, long, extrema, w)

        def feature(agg: str, c: str, n: int) -> Column:
            if agg in exact:
                return frames.from_totals(agg, c, w, n, digits)
            if agg in extrema and n in long:
                return long_windows.from_blocks(agg, c, w, n)
            return frames.rolling(agg, F.col(c), w, n, F.col("__place") if agg == "count" else None)

        wanted = [(n, agg, c) for n in windows for agg in aggs for c in columns]
        plain = [(n, agg, c) for n, agg, c in wanted if not (agg in ordered and n in long)]
        out = frame.select("*", *[v.alias(k) for k, v in helpers.items()]).select(
            *names, *[feature(agg, c, n).alias(f"rolling_{agg}_{c}_{n}") for n, agg, c in plain]
        )
        if ordered and long:
            out = long_windows.with_ordered(out, p.keys, columns, long, ordered, w)
        return out.select(*names, *[f"rolling_{agg}_{c}_{n}" for n, agg, c in wanted])

    return over_series(df, parts, build, lookback=max(windows), order=order, **measured)


def averages_lookback(shift: int = 24, days: Sequence[int] = (30, 90)) -> int:
    return shift + max([d * HOURS_PER_DAY for d in days], default=0)


def add_customer_averages(
    df: DataFrame,
    shift_hours: int = 24,
    windows_days: Sequence[int] = (30, 90),
    parts: SeriesParts | None = None,
    order: SeriesOrder = SeriesOrder(),
    digits: int | None = None,
    part_rows: int | None = None,
) -> DataFrame:
    """Long averages that stop ``shift_hours`` rows before the current row:
    ``customer_mean_{column}`` over the whole past and
    ``customer_{d}d_mean_{column}`` over d * 24 rows, from one value on.

    The running sum is held in whole numbers (``functions.exact``) and taken once,
    and a trailing mean is the difference of two of them: a 90-day mean costs no
    more than a short one, and does not depend on the order of rows or on how a
    series was cut.  ``digits``, if known, makes it one number instead of a few.
    Readings that are not finite count as missing.
    """

    def build(frame: DataFrame, p: SeriesParts) -> DataFrame:
        if digits != p.digits and p.carried:
            raise ValueError("parts were measured with other digits")
        w = p.window()
        so_far = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        helpers, features = [], []
        for c in energy_columns(frame):
            scale = p.scale(c, digits)
            limbs = scale.limbs(F.col(c))
            kind = WIDE if digits is not None else "bigint"
            totals, count = [f"__total_{i}_{c}" for i in range(len(limbs))], f"__n_{c}"
            helpers += [F.coalesce(F.sum(x).over(so_far), F.lit(0)).cast(kind).alias(t) for x, t in zip(limbs, totals)]
            helpers.append(scale.count(F.col(c)).over(so_far).alias(count))

            def mean(sums, counts, name, scale=scale):
                return F.when(counts > 0, scale.ratio(sums, counts)).alias(name)

            def at(name, rows):
                return F.coalesce(F.lag(name, rows).over(w), F.lit(0))

            before, count0 = p.carry(c, len(limbs))
            # With a cut series the carry stands for rows before this part,
            # and a lag that ends before the part has nothing to add.
            near = [at(t, shift_hours) for t in totals]
            features.append(mean([x + y for x, y in zip(near, before)], at(count, shift_hours) + count0, f"customer_mean_{c}"))
            for d in windows_days:
                back = shift_hours + d * HOURS_PER_DAY
                gone = [x - at(t, back) for x, t in zip(near, totals)]
                features.append(mean(gone, at(count, shift_hours) - at(count, back), f"customer_{d}d_mean_{c}"))
        return frame.select("*", *helpers).select(*frame.columns, *features)

    return over_series(
        df,
        parts,
        build,
        lookback=averages_lookback(shift_hours, windows_days),
        order=order,
        carried=energy_columns(df),
        digits=digits,
        part_rows=part_rows,
    )


def add_horizon_index(
    df: DataFrame,
    horizon: int,
    parts: SeriesParts | None = None,
    order: SeriesOrder = SeriesOrder(),
    **measured,
) -> DataFrame:
    """``horizon_index_{h}``: the row's place in its series modulo h."""

    def build(frame: DataFrame, p: SeriesParts) -> DataFrame:
        return frame.select("*", (p.position() % horizon).alias(f"horizon_index_{horizon}"))

    return over_series(df, parts, build, lookback=0, order=order, **measured)


def freeze_history_features(
    df: DataFrame,
    window: int,
    extra: Sequence[str] = (),
    parts: SeriesParts | None = None,
    order: SeriesOrder = SeriesOrder(),
    **measured,
) -> DataFrame:
    """Hold history features at what was known at the forecast origin.

    A meter's rows form blocks of ``window`` rows from its first row on.  Each
    row gets ``{c}_frozen``, the value of c at the first row of its block (null
    if it is null there), for every ``lag*``/``roll*`` column and ``extra``,
    and ``forecast_origin_time``, one hour before the block starts.
    """

    def build(frame: DataFrame, p: SeriesParts) -> DataFrame:
        held = [c for c in frame.columns if c.startswith(("lag", "roll"))]
        held += [c for c in extra if c not in held]
        so_far = p.window().rowsBetween(Window.unboundedPreceding, Window.currentRow)
        # A struct is not null even where its fields are, so the last one is
        # the block's first row and nulls in it are kept.
        first = F.struct(F.col(p.order.time).alias("__origin"), *[F.col(c) for c in held])
        placed = frame.select("*", p.position().alias("__place"))
        blocked = placed.select(
            "*",
            F.last(F.when(F.col("__place") % window == 0, first), ignorenulls=True)
            .over(so_far)
            .alias("__first"),
        )
        return blocked.select(
            *frame.columns,
            *[F.col("__first")[c].alias(f"{c}_frozen") for c in held],
            (F.col("__first")["__origin"] - F.expr("INTERVAL 1 HOUR")).alias("forecast_origin_time"),
        )

    return over_series(df, parts, build, lookback=window, order=order, **measured)


def convert_to_multi_horizon(
    df: DataFrame,
    window: int,
    extra: Sequence[str] = (),
    parts: SeriesParts | None = None,
    order: SeriesOrder = SeriesOrder(),
    **measured,
) -> DataFrame:
    """Horizon index and frozen columns in one pass."""

    def build(frame: DataFrame, p: SeriesParts) -> DataFrame:
        indexed = add_horizon_index(frame, window, parts=p)
        return freeze_history_features(indexed, window, extra, parts=p)

    return over_series(df, parts, build, lookback=window, order=order, **measured)
