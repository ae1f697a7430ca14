"""How the rows of a panel are keyed, ordered and spread over tasks.

Every history feature is a window over (meter, time).  One meter may hold a
large share of all rows, and a plain window would put that meter in one task.
``SeriesParts`` cuts such a *hot* meter into consecutive parts of bounded
size.  Each part also receives the rows just before it (its *halo*), so that
lags and frames see the same rows as in the whole series, and it knows how
many rows of the meter lie before it, so that positions are the same too.
All other meters stay in one part and the plan is the plain window.

The cut is found from counts only, before any row is shuffled:

1. rows per meter; hot is a meter above ``limit`` rows;
2. hot meters: rows per time bin (bins that are still too full are cut once
   more, and what is then still too full, such as many rows in one second, at
   quantiles of (time, ties)), then a running count over the bins;
3. bins are put together into parts; a bin is also a halo of the parts that
   look back into it.

``limit`` is at least ``total / MAX_PARTS`` rows, so there are at most
``MAX_PARTS`` hot meters and a bounded number of bins whatever the size of
the data.  That is what makes broadcasting the bin tables safe.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from ..functions.exact import Limbs, Units, sizes
from ..functions.timeparts import epoch_seconds
from ..session import durable

PART_ROWS = 8_000_000  # rows of one meter that a task takes without being cut
MAX_PARTS = 20_000
BINS_PER_PART = 8

# Up to this many rows per meter, Spark cuts a ranked window before the
# shuffle (spark.sql.optimizer.windowGroupLimitThreshold).
GROUP_LIMIT = 1000

PART, HALO, BASE = "__part", "__halo", "__base"


def carry_sum(column: str, limb: int = 0) -> str:
    return f"__before_sum_{limb}_{column}"


def carry_count(column: str) -> str:
    return f"__before_count_{column}"


@dataclass(frozen=True)
class SeriesOrder:
    """Key, time and tie-break columns.  (key, time, ties) must be unique for
    the order to be fixed."""

    key: str = "object_id"
    time: str = "timestamp"
    ties: tuple[str, ...] = ()

    @property
    def sort(self) -> list[str]:
        return [self.time, *self.ties]


def _binned(
    df: DataFrame, coarse: DataFrame, key: str, fine: DataFrame | None = None, how: str = "inner"
) -> DataFrame:
    """Time bin (and bin within it) of the rows of hot meters; ``df`` has the
    time in seconds as ``__t``.  Both tables are bounded by ``MAX_PARTS``."""
    out = (
        df.join(F.broadcast(coarse), key, how)
        .withColumn("__bin", F.expr("(__t - lo) div width"))
        .drop("lo", "width")
    )
    zero = F.lit(0).cast("bigint")
    if fine is None:
        return out.withColumn("__sub", zero)
    return (
        out.join(F.broadcast(fine), [key, "__bin"], "left")
        .withColumn("__sub", F.coalesce(F.expr("(__t - lo2) div width2"), zero))
        .drop("lo2", "width2")
    )


def _cut_at(df: DataFrame, bounds: DataFrame | None, order: SeriesOrder) -> DataFrame:
    """Place of a row among the bounds of its bin, as ``__cut``."""
    if bounds is None:
        return df.withColumn("__cut", F.lit(0))
    keys = [order.key, "__bin", "__sub"]
    mark = F.struct(*[F.col(c) for c in order.sort])
    return (
        df.join(F.broadcast(bounds), keys, "left")
        .withColumn("__cut", F.coalesce(F.size(F.filter("__bounds", lambda b: b <= mark)), F.lit(0)))
        .drop("__bounds")
    )


BIN = ("__bin", "__sub", "__cut")


@dataclass(frozen=True)
class SeriesParts:
    order: SeriesOrder
    lookback: int
    digits: int | None = None
    carried: tuple[str, ...] = ()
    scales: tuple[Units | Limbs, ...] = ()
    bins: tuple[DataFrame, DataFrame | None, DataFrame | None, DataFrame] | None = field(default=None, repr=False)

    # -- measuring ---------------------------------------------------------

    @classmethod
    def measure(
        cls,
        df: DataFrame,
        order: SeriesOrder = SeriesOrder(),
        lookback: int = 0,
        carried: Sequence[str] = (),
        digits: int | None = None,
        part_rows: int | None = None,
    ) -> SeriesParts:
        """One aggregate job over two columns decides whether a cut is needed.

        ``lookback`` is the number of earlier rows a feature may read;
        ``carried`` names columns whose running sums must go on across parts; with
        ``digits`` they are sums of units, else of limbs, for which the smallest
        and largest reading are taken as well.
        Rows earlier than all that were measured open into a meter's first part.
        """
        key, time = F.col(order.key), F.col(order.time)
        open_ = list(carried) if digits is None else []
        sized = [c.alias(f"__{k}{i}") for i, name in enumerate(open_) for k, c in zip(("least", "most"), sizes(F.col(name)))]
        per_meter = df.groupBy(key).agg(
            F.count(F.lit(1)).alias("n"), F.count_if(time.isNull()).alias("untimed"), *sized
        )
        seen = per_meter.agg(
            F.sum("n").alias("total"),
            F.max("n").alias("hottest"),
            F.sum(F.when(key.isNull(), F.col("n")).otherwise(F.col("untimed"))).alias("unusable"),
            *[F.min(f"__least{i}").alias(f"__least{i}") for i in range(len(open_))],
            *[F.max(f"__most{i}").alias(f"__most{i}") for i in range(len(open_))],
        ).first()
        scales = tuple(Limbs.between(seen[f"__least{i}"], seen[f"__most{i}"]) for i in range(len(open_))) or tuple(Units(digits) for _ in carried)
        base = cls(order, lookback, digits, tuple(carried), scales)
        if seen["unusable"]:
            raise ValueError(
                f"{seen['unusable']} rows have no {order.key} or no {order.time}; "
                "remove them first (quality.drop_unkeyed)"
            )
        total = seen["total"] or 0
        limit = max(part_rows or PART_ROWS, lookback, -(-total // MAX_PARTS), 1)
        if (seen["hottest"] or 0) <= limit:
            return base
        return cls(order, lookback, digits, tuple(carried), scales, base._cut(df, limit))

    def _cut(self, df: DataFrame, limit: int):
        key = self.order.key
        lim = F.lit(limit).cast("bigint")
        seconds = epoch_seconds(F.col(self.order.time))

        def grid(lo: str, width: Column) -> list[Column]:
            pieces = F.ceil(F.col("n") / lim) * BINS_PER_PART
            return [F.col(lo), F.greatest(F.ceil(width / pieces), F.lit(1)).alias("width")]

        sums = []
        for c, scale in zip(self.carried, self.scales):
            limbs = scale.limbs(F.col(c))
            sums += [F.sum(x.cast("decimal(19,0)")).alias(carry_sum(c, i)) for i, x in enumerate(limbs)]
            sums.append(scale.count(F.col(c)).alias(carry_count(c)))

        # Hot meters (at most total / limit of them) and the width of their bins.
        coarse = durable(
            df.groupBy(key)
            .agg(
                F.count(F.lit(1)).alias("n"),
                epoch_seconds(F.min(self.order.time)).alias("lo"),
                epoch_seconds(F.max(self.order.time)).alias("hi"),
            )
            .where(F.col("n") > lim)
            .select(F.col(key), *grid("lo", F.col("hi") - F.col("lo") + 1))
        )
        narrow = df.select(*dict.fromkeys([key, *self.order.sort, *self.carried]), seconds.alias("__t"))
        hot = _binned(narrow, coarse, key)
        filled = durable(
            hot.groupBy(key, "__bin").agg(F.count(F.lit(1)).alias("n"), *sums).join(coarse, key)
        )
        # Bins that hold more than a part are cut once more.
        fine = (
            filled.where(F.col("n") > lim)
            .withColumn("lo2", F.col("lo") + F.col("__bin") * F.col("width"))
            .select(F.col(key), F.col("__bin"), *grid("lo2", F.col("width")))
            .withColumnRenamed("width", "width2")
        )
        if fine.isEmpty():
            fine = None
            counted = filled.withColumn("__sub", F.lit(0).cast("bigint"))
        else:
            fine = durable(fine)
            counted = (
                _binned(narrow, coarse, key, fine)
                .groupBy(key, "__bin", "__sub")
                .agg(F.count(F.lit(1)).alias("n"), *sums)
            )
        counted, bounds = self._cut_bursts(narrow, coarse, fine, counted, sums, limit)
        # One row per bin from here on.  Bins of one meter: at most MAX_PARTS
        # times a small constant.
        w = Window.partitionBy(key).orderBy(*BIN).rowsBetween(Window.unboundedPreceding, -1)
        running = {BASE: F.coalesce(F.sum("n").over(w), F.lit(0))}
        for c, scale in zip(self.carried, self.scales):
            names = [carry_sum(c, i) for i in range(len(scale.limbs(F.col(c))))]
            before = [F.coalesce(F.sum(name).over(w), F.lit(0)) for name in names]
            running |= dict(zip(names, scale.carried(before)))
            running[carry_count(c)] = F.coalesce(F.sum(carry_count(c)).over(w), F.lit(0))
        placed = (
            counted.select(F.col(key), *BIN, "n", *[v.alias(k) for k, v in running.items()])
            .withColumn(PART, F.expr(f"{BASE} div {limit}"))
        )
        starts = placed.groupBy(key, PART).agg(F.min(BASE).alias("start"))
        # A bin belongs to its own part and to those that look back into it.
        reach = F.expr(f"({BASE} + n + {self.lookback}) div {limit}")
        uses = (
            placed.withColumn("own", F.col(PART))
            .withColumn(PART, F.explode(F.sequence(F.col("own"), F.greatest(reach, F.col("own")))))
            .join(starts, [key, PART], "inner")
            .where(
                (F.col(PART) == F.col("own"))
                | (F.col(BASE) + F.col("n") > F.col("start") - F.lit(self.lookback))
            )
        )
        before = Window.partitionBy(key, PART).orderBy(BASE).rowsBetween(
            Window.unboundedPreceding, Window.unboundedFollowing
        )
        facts = [F.first(name).over(before).alias(name) for name in running]
        uses = uses.select(
            F.col(key), *BIN, F.col(PART), (F.col(PART) != F.col("own")).alias(HALO), *facts
        )
        targets = durable(
            uses.groupBy(key, *BIN).agg(
                F.collect_list(F.struct(PART, HALO, *running)).alias("__uses")
            )
        )
        return coarse, fine, bounds, targets

    def _cut_bursts(self, narrow: DataFrame, coarse: DataFrame, fine: DataFrame | None, counted: DataFrame, sums, limit: int):
        """Bins that time alone cannot cut any further, cut where Spark's range
        partitioning puts its borders; the borders are kept, so that rows find
        their place again."""
        keys = [self.order.key, "__bin", "__sub"]
        counted = durable(counted)
        full = counted.where(F.col("n") > limit)
        rows = full.agg(F.sum("n")).first()[0]
        if not rows:
            return counted.withColumn("__cut", F.lit(0)), None
        binned = _binned(narrow, coarse, self.order.key, fine)
        mark = F.struct(*[F.col(c) for c in self.order.sort]).alias("__mark")
        crowd = binned.join(F.broadcast(full.select(*keys)), keys, "left_semi").select(*keys, mark)
        dealt = crowd.repartitionByRange(-(-rows * 2 // limit), *keys, "__mark")  # about half a part each
        firsts = dealt.groupBy(*keys, F.spark_partition_id().alias("__piece")).agg(F.min("__mark").alias("__mark"))
        bounds = durable(firsts.groupBy(*keys).agg(F.sort_array(F.collect_list("__mark")).alias("__bounds")))
        cut = _cut_at(binned, bounds, self.order).groupBy(*keys, "__cut").agg(F.count(F.lit(1)).alias("n"), *sums)
        return durable(cut), bounds

    # -- using -------------------------------------------------------------

    @property
    def is_cut(self) -> bool:
        return self.bins is not None

    def open(self, df: DataFrame) -> DataFrame:
        """Give every row its part, and copy rows into the halos they serve."""
        if not self.is_cut:
            return df
        key = self.order.key
        coarse, fine, bounds, targets = self.bins
        uses = targets.schema["__uses"].dataType.elementType
        whole = F.struct(
            *[
                (F.lit(False) if f.name == HALO else F.lit(0).cast(f.dataType)).alias(f.name)
                for f in uses.fields
            ]
        )
        timed = df.withColumn("__t", epoch_seconds(F.col(self.order.time)))
        placed = (
            _cut_at(_binned(timed, coarse, key, fine, "left"), bounds, self.order)
            .join(F.broadcast(targets), [key, *BIN], "left")
            .withColumn("__use", F.explode(F.coalesce(F.col("__uses"), F.array(whole))))
        )
        return placed.select(
            *[F.col(c) for c in df.columns], *[F.col("__use")[f.name].alias(f.name) for f in uses.fields]
        )

    def close(self, df: DataFrame) -> DataFrame:
        """Drop the halo copies and the helper columns."""
        if not self.is_cut:
            return df
        extra = [PART, HALO, BASE]
        for c, scale in zip(self.carried, self.scales):
            extra += [*[carry_sum(c, i) for i in range(len(scale.limbs(F.col(c))))], carry_count(c)]
        return df.where(~F.col(HALO)).drop(*extra)

    @property
    def keys(self) -> list[str]:
        return [self.order.key, PART] if self.is_cut else [self.order.key]

    def window(self) -> WindowSpec:
        return Window.partitionBy(*self.keys).orderBy(*self.order.sort)

    def backward(self) -> WindowSpec:
        """The same rows from the last to the first."""
        return Window.partitionBy(*self.keys).orderBy(*[F.desc(c) for c in self.order.sort])

    def position(self) -> Column:
        """Zero-based place of the row in its whole series."""
        place = F.row_number().over(self.window()).cast("bigint") - 1
        return place + F.col(BASE) if self.is_cut else place

    def scale(self, column: str, digits: int | None) -> Units | Limbs:
        """How ``column`` is added up.  Units need no measure of the readings."""
        if column in self.carried:
            return self.scales[self.carried.index(column)]
        if self.is_cut or digits is None:
            raise ValueError(f"running sums of {column} were not measured")
        return Units(digits)

    def carry(self, column: str, size: int) -> tuple[list[Column], Column]:
        """Limbs of the sum, and count, of ``column`` over the rows before this part."""
        if not self.is_cut:
            return [F.lit(0)] * size, F.lit(0)
        return [F.col(carry_sum(column, i)) for i in range(size)], F.col(carry_count(column))


def over_series(
    df: DataFrame,
    parts: SeriesParts | None,
    build: Callable[[DataFrame, SeriesParts], DataFrame],
    *,
    lookback: int,
    order: SeriesOrder = SeriesOrder(),
    **measured,
) -> DataFrame:
    """Run ``build`` on a panel.

    With ``parts`` the caller has opened the panel already and closes it after
    the last feature, so that all features share one exchange and one sort.
    """
    if parts is not None:
        if parts.is_cut and parts.lookback < lookback:
            raise ValueError(f"parts look back {parts.lookback} rows, {lookback} are needed")
        return build(df, parts)
    parts = SeriesParts.measure(df, order, lookback, **measured)
    return parts.close(build(parts.open(df), parts))


def energy_columns(df: DataFrame) -> list[str]:
    """Columns whose name starts with ``energy``."""
    found = [c for c in df.columns if c.startswith("energy")]
    if not found:
        raise ValueError("no column starts with 'energy'")
    return found


def chain(df: DataFrame, *steps: Callable[[DataFrame], DataFrame]) -> DataFrame:
    return reduce(lambda frame, step: frame.transform(step), steps, df)
