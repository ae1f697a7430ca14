"""History features that follow new readings, batch by batch.

A store keeps what later batches need: each row's place in its series with the
running totals up to it (``log``), and the last row of each meter (``heads``).
A feature of a row is then made of a few earlier rows: a lag is one row, a mean
over any number of rows the difference of two totals.  A batch reads those rows
and no others, so its cost is its own rows times the number of such offsets,
however long the windows and the history are.

Rows are numbered in pieces of a range partitioning by (meter, time, ties), so a
meter of any size is spread; lookups meet by (meter, place), which no meter can
crowd.

Rules:

* The order of a meter's rows is (time, ties).  A row that is not after the last
  row of its meter in earlier batches is *late*: it is kept in ``late`` and takes
  no part in features, which were already given out.  Within a batch any order
  will do; rows alike in time and ties are numbered in no fixed order.
* Batch ids grow.  An id up to the last applied one is a repetition and changes
  nothing.  A batch that was cut off is applied again from the start with the same
  rows; only its last step, one file in ``applied``, makes it count.
* Rows without meter or time are an error, as elsewhere in history features.
* Readings that are not finite count as missing in means and sums.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.exact import Units
from ..functions.frames import FROM_TOTALS, WIDE
from ..functions.rounding import from_units, to_units
from ..joins import meet
from ..operators.series import SeriesOrder
from ..session import create_once, durable, list_names

HOURS_PER_DAY = 24
PLACE, BLOCK, BATCH, PIECE, OFFSET = "__place", "__block", "__batch", "__piece", "__offset"


@dataclass(frozen=True)
class Wanted:
    """Which features; names and values as ``operators.history`` has them."""

    lags: Sequence[int] = (24, 48, 168)
    windows: Sequence[int] = (6, 12, 24)
    aggs: Sequence[str] = ("mean", "std")
    shift_hours: int = 24
    windows_days: Sequence[int] = (30, 90)
    averages: bool = True
    digits: int = 2  # decimals of the readings

    def __post_init__(self):
        unknown = [a for a in self.aggs if a not in FROM_TOTALS]
        if unknown:
            raise ValueError(f"{unknown} do not follow from totals; known: {FROM_TOTALS}")
        if min([1, *self.lags, *self.windows, *self.windows_days, self.shift_hours]) < 1:
            raise ValueError("lags, windows and the shift are at least 1")

    @property
    def squares(self) -> bool:
        return any(a in ("var", "std", "sem") for a in self.aggs)

    @property
    def total_offsets(self) -> list[int]:
        """How far back totals are looked up."""
        out = {1, *[n + 1 for n in self.windows]} if self.aggs and self.windows else set()
        if self.averages:
            out |= {self.shift_hours, *[self.shift_hours + d * HOURS_PER_DAY for d in self.windows_days]}
        return sorted(out)

    @property
    def offsets(self) -> list[int]:
        return sorted({*self.lags, *self.total_offsets})


@dataclass(frozen=True)
class FeatureStore:
    """Features of the readings in ``columns`` below the folder ``root``."""

    spark: SparkSession = field(repr=False)
    root: str
    columns: Sequence[str] = ("energy_kwh",)
    wanted: Wanted = Wanted()
    order: SeriesOrder = SeriesOrder()
    block_rows: int = 8192  # places of a meter in one folder of the log

    # -- what is there -----------------------------------------------------

    def applied(self) -> list[int]:
        return sorted(int(name) for name in list_names(self.spark, f"{self.root}/applied"))

    def features(self) -> DataFrame:
        """Rows of all applied batches with their features."""
        return self._batches("features")

    def late(self) -> DataFrame:
        """Rows that came after later ones of their meter."""
        return self._batches("late")

    def _batches(self, name: str) -> DataFrame:
        done = self.applied()
        if not done:
            raise FileNotFoundError(f"no batch has been applied to '{self.root}'")
        return self.spark.read.parquet(*[f"{self.root}/{name}/{BATCH}={n}" for n in done])

    # -- a batch -----------------------------------------------------------

    def apply(self, rows: DataFrame, batch: int) -> bool:
        """Add a batch; False if it was there already."""
        done = self.applied()
        if done and batch <= done[-1]:
            return False
        dealt, heads = self._deal(rows, done[-1] if done else None)
        dealt.where("__late").drop("__late", PIECE).write.mode("overwrite").parquet(self._of("late", batch))
        fresh = dealt.where("NOT __late").drop("__late")
        pieces = durable(self._pieces(fresh, heads), "pieces")
        self._write_log(fresh, pieces, batch)
        self._looked_up(pieces, batch).write.mode("overwrite").parquet(self._of("features", batch))
        self._write_heads(pieces, heads, batch)
        create_once(self.spark, f"{self.root}/applied/{batch:012d}", "")
        return True

    def _of(self, name: str, batch: int) -> str:
        return f"{self.root}/{name}/{BATCH}={batch}"

    def _totals(self) -> dict[str, Column]:
        """What a row adds to the running totals."""
        out = {}
        for c in self.columns:
            units = to_units(F.col(c), self.wanted.digits)
            out[f"__count_{c}"] = units.isNotNull().cast("bigint")
            out[f"__sum_{c}"] = F.coalesce(units, F.lit(0)).cast(WIDE)
            if self.wanted.squares:
                wide = F.coalesce(units, F.lit(0)).cast("decimal(19,0)")
                out[f"__squares_{c}"] = (wide * wide).cast(WIDE)
        return out

    def _deal(self, rows: DataFrame, last: int | None) -> tuple[DataFrame, DataFrame | None]:
        """Rows in range pieces with a mark on late ones, and the heads of the
        batch before."""
        key, time = self.order.key, self.order.time
        counts = durable(
            rows.groupBy(key).agg(F.count(F.lit(1)).alias("__n"), F.count_if(F.col(time).isNull()).alias("__untimed")),
            "counts",
        )
        unusable = counts.agg(F.sum(F.when(F.col(key).isNull(), F.col("__n")).otherwise(F.col("__untimed")))).first()[0]
        if unusable:
            raise ValueError(f"{unusable} rows have no {key} or no {time}; remove them first (quality.drop_unkeyed)")
        mark = F.struct(*[F.col(c) for c in self.order.sort])
        if last is None:
            heads, marked = None, rows.withColumn("__late", F.lit(False))
        else:
            heads = self.spark.read.parquet(self._of("heads", last))
            facts = durable(counts.join(heads.select(key, "__last"), key, "left").select(key, "__n", "__last"), "facts")
            met = meet(rows, facts, [key], "__n")
            marked = met.withColumn("__late", F.coalesce(mark <= F.col("__last"), F.lit(False)))
        ranged = marked.select(*[F.col(f"`{c}`") for c in rows.columns], "__late").repartitionByRange(key, *self.order.sort)
        return durable(ranged.withColumn(PIECE, F.spark_partition_id()), "dealt"), heads

    def _pieces(self, fresh: DataFrame, heads: DataFrame | None) -> DataFrame:
        """A row per meter and piece: rows, last row, and place and totals of the
        meter before the piece.  A meter has at most as many pieces as the
        range partitioning has partitions."""
        key, totals = self.order.key, self._totals()
        own = fresh.groupBy(key, PIECE).agg(
            F.count(F.lit(1)).alias("__n"),
            F.max(F.struct(*self.order.sort)).alias("__last"),
            *[F.sum(v).cast(v_type).alias(k) for k, v, v_type in _typed(totals)],
        )
        if heads is not None:
            before = heads.select(key, F.col(PLACE).alias("__head"), *[F.col(t).alias(f"__head{t}") for t in totals])
            own = own.join(before, key, "left")
        else:
            own = own.select("*", F.lit(None).cast("bigint").alias("__head"), *[F.lit(None).alias(f"__head{t}") for t in totals])
        w = Window.partitionBy(key).orderBy(PIECE).rowsBetween(Window.unboundedPreceding, -1)

        def start(part: str, head: Column, kind: str) -> Column:
            return (F.coalesce(F.sum(part).over(w), F.lit(0)).cast(kind) + F.coalesce(head, F.lit(0)).cast(kind)).cast(kind)

        return own.select(
            key, PIECE, "__n", "__last", *totals,
            start("__n", F.col("__head") + 1, "bigint").alias("__start"),
            *[start(t, F.col(f"__head{t}"), kind).alias(f"__before{t}") for t, _, kind in _typed(totals)],
        )

    def _write_log(self, fresh: DataFrame, pieces: DataFrame, batch: int) -> None:
        key, totals = self.order.key, self._totals()
        carried = pieces.select(key, PIECE, "__start", *[f"__before{t}" for t in totals])
        w = Window.partitionBy(key, PIECE).orderBy(*self.order.sort)
        so_far = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        numbered = fresh.join(carried, [key, PIECE]).select(
            *[F.col(f"`{c}`") for c in fresh.columns if c != PIECE],
            (F.col("__start") + F.row_number().over(w) - 1).alias(PLACE),
            *[(F.sum(v).over(so_far).cast(kind) + F.col(f"__before{t}")).cast(kind).alias(t) for t, v, kind in _typed(totals)],
        )
        # A block's folder holds a folder per batch, so that a lookup lists the
        # blocks it needs; a repeated batch takes the place of its own folders.
        numbered.select(
            "*", F.expr(f"{PLACE} div {self.block_rows}").alias(BLOCK), F.lit(batch).cast("bigint").alias(BATCH)
        ).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(BLOCK, BATCH).parquet(f"{self.root}/log")

    def _log(self, spans: DataFrame) -> DataFrame | None:
        """Log rows in the blocks that rows at ``spans`` look back to."""
        back = F.explode(F.array(*[F.lit(o).cast("bigint") for o in [0, *self.wanted.offsets]])).alias("o")
        reach = spans.select("__first", "__end", back).where("__end >= o").select(
            F.explode(F.sequence(
                F.expr(f"greatest(__first - o, 0) div {self.block_rows}"), F.expr(f"(__end - o) div {self.block_rows}")
            )).alias("block")
        )
        needed = [r["block"] for r in reach.distinct().collect()]
        there = {int(name.split("=")[1]) for name in list_names(self.spark, f"{self.root}/log") if name.startswith(BLOCK)}
        paths = [f"{self.root}/log/{BLOCK}={b}" for b in sorted(there.intersection(needed))]
        return self.spark.read.option("basePath", f"{self.root}/log").parquet(*paths) if paths else None

    def _looked_up(self, pieces: DataFrame, batch: int) -> DataFrame:
        """The batch's rows with what lies at the wanted offsets before them."""
        key, wanted, totals = self.order.key, self.wanted, list(self._totals())
        spans = durable(
            pieces.groupBy(key).agg(
                F.min("__start").alias("__first"),
                F.max(F.col("__start") + F.col("__n") - 1).alias("__end"),
                F.sum("__n").alias("__n"),
            ),
            "spans",
        )
        log = self._log(spans)
        if log is None:  # a batch without rows in time
            return self.spark.read.parquet(self._of("late", batch)).limit(0).select("*", *self._empty())
        rows = log.where(F.col(BATCH) == batch).drop(BLOCK, BATCH)
        names = [c for c in rows.columns if c not in (PLACE, *totals)]

        low, high = spans.agg(F.min("__first"), F.max("__end")).first()
        near = reduce(Column.__or__, [F.col(PLACE).between(low - o, high - o) for o in wanted.offsets], F.lit(False))
        earlier = log.where((F.col(BATCH) <= batch) & near).select(key, PLACE, *self.columns, *totals)
        offsets = F.array(*[F.lit(o).cast("bigint") for o in wanted.offsets])
        sent = (
            meet(earlier, spans, [key], "__n")
            .select(key, PLACE, *self.columns, *totals, F.explode(F.filter(
                offsets, lambda o: (F.col(PLACE) + o).between(F.col("__first"), F.col("__end")))).alias(OFFSET))
            .withColumn(PLACE, F.col(PLACE) + F.col(OFFSET))
        )

        def at(column: str, offset: int) -> Column:
            return F.max(F.when(F.col(OFFSET) == offset, F.col(column)))

        found = sent.groupBy(key, PLACE).agg(
            *[at(c, n).alias(f"lagged_{n}_{c}") for n in wanted.lags for c in self.columns],
            *[at(t, o).alias(f"{t}@{o}") for o in wanted.total_offsets for t in totals],
        )
        joined = rows.select(*[F.col(f"`{c}`") for c in names], PLACE).join(found, [key, PLACE], "left")
        return joined.select(*[F.col(f"`{c}`") for c in names], *self._features())

    def _features(self) -> list[Column]:
        wanted, scale = self.wanted, Units(self.wanted.digits)
        out = [F.col(f"lagged_{n}_{c}") for n in wanted.lags for c in self.columns]

        def total(name: str, c: str, offset: int) -> Column:
            return F.coalesce(F.col(f"`__{name}_{c}@{offset}`"), F.lit(0))

        def between(name: str, c: str, near: int, far: int) -> Column:
            return total(name, c, near).cast(WIDE) - total(name, c, far).cast(WIDE)

        for n in wanted.windows:
            for agg in wanted.aggs:
                for c in self.columns:
                    value = _spread(agg, n, between("sum", c, 1, n + 1), between("squares", c, 1, n + 1) if wanted.squares else None, wanted.digits)
                    out.append(F.when(between("count", c, 1, n + 1) == n, value).alias(f"rolling_{agg}_{c}_{n}"))
        if wanted.averages:
            shift = wanted.shift_hours
            for c in self.columns:
                n = total("count", c, shift)
                out.append(F.when(n > 0, scale.ratio([total("sum", c, shift)], n)).alias(f"customer_mean_{c}"))
                for d in wanted.windows_days:
                    far = shift + d * HOURS_PER_DAY
                    n = total("count", c, shift) - total("count", c, far)
                    out.append(F.when(n > 0, scale.ratio([between("sum", c, shift, far)], n)).alias(f"customer_{d}d_mean_{c}"))
        return out

    def _empty(self) -> list[Column]:
        """Columns of the features for a batch that has none."""
        wanted = self.wanted
        names = [f"lagged_{n}_{c}" for n in wanted.lags for c in self.columns]
        names += [f"rolling_{a}_{c}_{n}" for n in wanted.windows for a in wanted.aggs for c in self.columns]
        if wanted.averages:
            names += [x for c in self.columns for x in (f"customer_mean_{c}", *[f"customer_{d}d_mean_{c}" for d in wanted.windows_days])]
        return [F.lit(None).cast("double").alias(n) for n in names]

    def _write_heads(self, pieces: DataFrame, heads: DataFrame | None, batch: int) -> None:
        """The last row of each meter: its place, its order and the totals."""
        key, totals = self.order.key, self._totals()
        end = F.max(F.col("__start") + F.col("__n") - 1).alias(PLACE)
        new = pieces.groupBy(key).agg(
            end, F.max("__last").alias("__last"),
            *[F.max_by((F.col(t) + F.col(f"__before{t}")).cast(kind), PIECE).alias(t) for t, _, kind in _typed(totals)],
        )
        if heads is not None:
            new = heads.join(new.select(key), key, "left_anti").unionByName(new)
        new.write.mode("overwrite").parquet(self._of("heads", batch))


def _typed(totals: dict[str, Column]) -> list[tuple[str, Column, str]]:
    return [(name, value, "bigint" if name.startswith("__count_") else WIDE) for name, value in totals.items()]


def _spread(agg: str, n: int, total: Column, squares: Column | None, digits: int) -> Column:
    """An aggregate of n readings from the sum of their units and of the squares."""
    if agg == "sum":
        return from_units(total.cast("double"), digits)
    if agg == "mean":
        return from_units(total.cast("double") / n, digits)
    if n < 2:
        return F.lit(None).cast("double")
    total = total.cast(WIDE)
    scatter = (squares.cast(WIDE) * F.lit(n).cast(WIDE)).cast(WIDE) - (total * total).cast(WIDE)
    value = scatter.cast("double") / (n * (n - 1)) / F.lit(10.0 ** (2 * digits))
    if agg != "var":
        value = F.sqrt(value)
    return value / F.sqrt(F.lit(float(n))) if agg == "sem" else value


def follow(stream: DataFrame, store: FeatureStore, checkpoint: str) -> StreamingQuery:
    """Apply what has arrived since the last call, then stop.  Batch ids come
    from the checkpoint, so a store goes with one checkpoint."""
    return (
        stream.writeStream.foreachBatch(lambda rows, batch: store.apply(rows, batch) and None)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
