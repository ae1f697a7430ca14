"""Gaps in the times of series, from runs instead of sorted rows.

A run is a stretch of times of one series in which no two neighbours are more
than a step apart; it is known by its first and last time and its rows.  Runs of
parts of a series merge: two of them are one if they overlap or lie at most a
step apart, whatever the order in which they are put together.  Each map task
turns its rows into runs, so what is shuffled are runs, and a series of any size
sends a few from each task.  A series that reaches a task in no order at all
sends at most one run per step of time and table of rows held.

Runs are merged within bins of time first, then across bins.
"""

from __future__ import annotations

import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


cloudpickle.register_pickle_by_value(sys.modules[__name__])

HELD_ROWS = 1_000_000  # rows or runs that a task holds before it makes runs of them
BIN_STEPS = 4096  # steps of time whose runs meet in one group


def merged_runs(code: np.ndarray, first: np.ndarray, last: np.ndarray, rows: np.ndarray, step: int) -> tuple[np.ndarray, ...]:
    """Runs of the series numbered ``code``, sorted by series and time."""
    if not len(code):
        return code, first, last, rows
    order = np.lexsort((first, code))
    code, first, last, rows = code[order], first[order], last[order], rows[order]
    # The latest time so far in the series: series are set apart, so that one
    # running maximum serves all of them.
    series = np.cumsum(np.append(False, code[1:] != code[:-1]))
    rank = np.searchsorted(np.sort(last), last).astype(np.int64)  # order of times as small numbers
    reach = np.maximum.accumulate(series * (len(last) + 1) + rank) - series * (len(last) + 1)
    reach = np.sort(last)[reach]
    new = np.append(True, (series[1:] != series[:-1]) | (first[1:] - reach[:-1] > step))
    at = np.flatnonzero(new)
    return code[at], first[at], np.maximum.reduceat(last, at), np.add.reduceat(rows, at)


def _task_runs(df: DataFrame, key: str, time: str, step: int) -> DataFrame:
    """(key, first, last, rows) of each task, in microseconds."""
    kind = df.schema[key].dataType
    # A row without a key or time has no place in a series.
    broken = F.col(key).isNull() | F.col(time).isNull()
    message = f"rows have no {key} or no {time}; remove them first (quality.drop_unkeyed)"
    micros = F.when(broken, F.raise_error(F.lit(message)).cast("bigint")).otherwise(F.unix_micros(F.col(time).cast("timestamp")))
    narrow = df.select(F.col(key), micros.alias("t"))

    def run(batches):
        numbers: dict = {}
        held: list[tuple[np.ndarray, ...]] = []
        size = 0

        def merged():
            return merged_runs(*[np.concatenate(c) for c in zip(*held)], step)

        def out(runs):
            names = list(numbers)
            keys = pa.array([names[c] for c in runs[0].tolist()], keys_type)
            return pa.RecordBatch.from_arrays([keys, *[pa.array(c.astype(np.int64)) for c in runs[1:]]], [key, "first", "last", "rows"])

        for batch in batches:
            keys_type = batch.column(key).type
            coded = batch.column(key).dictionary_encode()
            codes = np.array([numbers.setdefault(k, len(numbers)) for k in coded.dictionary.to_pylist()], np.int64)
            times = batch.column("t").to_numpy()
            if not len(times):
                continue
            held.append((codes[coded.indices.to_numpy()], times, times, np.ones(len(times), np.int64)))
            size += len(times)
            if size >= HELD_ROWS:
                runs = merged()
                held, size = [runs], len(runs[0])
                if size > HELD_ROWS // 2:  # runs that do not shrink any further
                    yield out(runs)
                    numbers, held, size = {}, [], 0
        if held:
            yield out(merged())

    schema = T.StructType([T.StructField(key, kind), *[T.StructField(c, T.LongType()) for c in ("first", "last", "rows")]])
    return narrow.mapInArrow(run, schema)


def _chained(runs: DataFrame, keys: list[str], step: int) -> DataFrame:
    """``runs`` with ``new``: whether a run is more than a step after all before it."""
    before = Window.partitionBy(*keys).orderBy("first", "last")
    reach = F.max("last").over(before.rowsBetween(Window.unboundedPreceding, -1))
    return runs.withColumn("new", F.coalesce((F.col("first") - reach > step).cast("int"), F.lit(1)))


def time_runs(df: DataFrame, key: str = "object_id", time: str = "timestamp", step_hours: float = 1) -> DataFrame:
    """(key, first, last, rows, new) of each series: runs of bins of time; those
    with ``new`` 1 begin a run of the series, the others go on with the one before.
    Times are microseconds since 1970."""
    step = round(step_hours * 3_600_000_000)
    binned = _task_runs(df, key, time, step).withColumn("bin", F.expr(f"floor(first / {float(step * BIN_STEPS)!r}D)"))
    so_far = Window.partitionBy(key, "bin").orderBy("first", "last").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    numbered = _chained(binned, [key, "bin"], step).withColumn("run", F.sum("new").over(so_far))
    whole = numbered.groupBy(key, "bin", "run").agg(F.min("first").alias("first"), F.max("last").alias("last"), F.sum("rows").alias("rows"))
    return _chained(whole.drop("bin", "run"), [key], step)


def continuity_runs(df: DataFrame, key: str = "object_id", time: str = "timestamp", expected_step_hours: float = 1) -> DataFrame:
    """Steps per series that are ok, a gap, or run backwards (none do: the order
    of rows is that of time).  Equals ``quality.time_continuity``."""
    return time_runs(df, key, time, expected_step_hours).groupBy(key).agg(
        (F.sum("rows") - F.sum("new") + 1).alias("ok"), (F.sum("new") - 1).alias("gap"), F.lit(0).cast("bigint").alias("time_reversal")
    )
