"""Row filters and half-open time splits."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from datetime import datetime
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import fresh_path, put_in_place, remove
from ..sources.versions import Dataset

Bounds = Mapping[str, tuple[datetime, datetime]]

ORDERED = ("train", "dev", "test")  # fixed values
WARMUP = "rolling_offset"


def _time(value: object) -> datetime:
    return value if isinstance(value, datetime) else datetime.fromisoformat(str(value))


def check_bounds(raw: Mapping[str, Mapping[str, object]]) -> dict[str, tuple[datetime, datetime]]:
    """Split bounds as times.  All that is wrong with them is reported at once:
    train and test must be there, each split needs both ends and some length,
    and none may begin before the one ahead of it is over."""
    whole = {n: (_time(g["start"]), _time(g["end"])) for n, g in raw.items() if {"start", "end"} <= g.keys()}
    in_order = [n for n in ORDERED if n in whole]
    faults = [f"no {n} split" for n in ("train", "test") if n not in raw]
    faults += [f"{n} has no start or no end" for n in raw if n not in whole]
    faults += [f"{n} is empty" for n, (start, end) in whole.items() if not start < end]
    faults += [f"{b} overlaps {a}" for a, b in zip(in_order, in_order[1:]) if whole[a][1] > whole[b][0]]
    if faults:
        raise ValueError("split bounds: " + "; ".join(faults))
    return whole


def load_splits(path: str | Path) -> tuple[dict[str, tuple[datetime, datetime]], str]:
    """Bounds under ``splits`` in a YAML file, and the file's name."""
    import yaml

    with open(path, encoding="utf-8") as text:  # no such file: FileNotFoundError
        content = yaml.safe_load(text)
    if not isinstance(content, dict) or "splits" not in content:
        raise ValueError(f"{path} says nothing under 'splits'")
    return check_bounds(content["splits"]), Path(path).stem


def in_range(time: Column, start, end) -> Column:
    """start <= time < end"""
    low, high = (F.lit(str(_time(v))).cast("timestamp_ntz") for v in (start, end))
    return (time >= low) & (time < high)


def filter_members(df: DataFrame, column: str, values: Sequence) -> DataFrame:
    """Rows whose value is one of the given; reaches the scan."""
    return df.where(F.col(column).isin(*values))


def filter_time_range(df: DataFrame, start, end, time: str = "timestamp") -> DataFrame:
    return df.where(in_range(F.col(time), start, end))


def split_of(time: Column, bounds: Bounds, names: Sequence[str] = ORDERED) -> Column:
    """Name of the split a time falls into, else null.  The bounds are three
    literals, so this is an expression and not a join."""
    label = F.lit(None).cast("string")
    for name in names:
        if name in bounds:
            label = F.when(in_range(time, *bounds[name]), F.lit(name)).otherwise(label)
    return label


def assign_split(df: DataFrame, bounds: Bounds, time: str = "timestamp") -> DataFrame:
    """Rows inside a split, with a ``split`` column."""
    present = [bounds[n] for n in ORDERED if n in bounds]
    low, high = min(b[0] for b in present), max(b[1] for b in present)
    # The outer range reaches the scan as a pushed filter.
    return (
        filter_time_range(df, low, high, time)
        .withColumn("split", split_of(F.col(time), bounds))
        .where(F.col("split").isNotNull())
    )


def prepare_splits(df: DataFrame, bounds: Bounds, time: str = "timestamp") -> list[DataFrame]:
    """[train, dev, test] or [train, test] as separate frames."""
    return [filter_time_range(df, *bounds[n], time) for n in ORDERED if n in bounds]


def split_coverage(df: DataFrame, time: str = "timestamp") -> DataFrame:
    """Rows and time span of each split."""
    return df.groupBy("split").agg(
        F.count(F.lit(1)).alias("rows"), F.min(time).alias("first_time"), F.max(time).alias("last_time")
    )


def split_bounds_violations(bounds: DataFrame, by: str) -> DataFrame:
    """Bounds kept as rows (``by``, split, start, end), a few per key: those
    that end too early, or start before the earlier one ended."""
    w = Window.partitionBy(by).orderBy("start", "split")
    return (
        bounds.withColumn("previous_end", F.lag("end").over(w))
        .select(
            by,
            "split",
            (F.col("start") >= F.col("end")).alias("empty"),
            F.coalesce(F.col("start") < F.col("previous_end"), F.lit(False)).alias("overlaps"),
        )
        .where("empty OR overlaps")
    )


def write_splits(df: DataFrame, path: str, expected: Sequence[str] | None = None) -> str:
    """One dataset partitioned by ``split``; a reader of one split lists and
    reads that directory only.  An empty split is an error, and what was there
    before stays: rows are written beside it and take its place only then."""
    from pyspark.sql import Observation

    names = list(expected or ORDERED)
    seen = Observation()
    beside = f"{path.rstrip('/')}.new-{uuid.uuid4().hex}"
    counted = df.observe(seen, *[F.count_if(F.col("split") == n).alias(n) for n in names])
    counted.write.partitionBy("split").parquet(beside)
    empty = [n for n in names if not seen.get[n]]
    if empty:
        remove(df.sparkSession, beside)
        raise ValueError(f"nothing to write for {empty}")
    put_in_place(df.sparkSession, beside, path)
    return path


def publish_splits(df: DataFrame, root: str, expected: Sequence[str] | None = None) -> Dataset:
    """The same as a dataset with versions (``sources.versions``): readers of
    ``read_splits`` see the splits of one build, the earlier or the new one,
    whenever a write ends.  An empty split is an error, and the earlier build stays."""
    names = list(expected or ORDERED)

    def check(written: DataFrame) -> None:
        there = {r["split"] for r in written.groupBy("split").count().collect()}
        empty = [n for n in names if n not in there]
        if empty:
            raise ValueError(f"nothing to write for {empty}")

    data = Dataset(df.sparkSession, root.rstrip("/"))
    data.replace(df, ("split",), check)
    return data


def read_splits(spark: SparkSession, root: str, name: str) -> DataFrame:
    """One split of the last published build; its folder only is read."""
    return Dataset(spark, root.rstrip("/")).read().where(F.col("split") == name).drop("split")


def save_splits(splits: Sequence[DataFrame], path: str) -> str:
    """[train, test] or [train, dev, test] as one dataset."""
    names = {2: ("train", "test"), 3: ORDERED}.get(len(splits))
    if names is None:
        raise ValueError("expected [train, test] or [train, dev, test]")
    tagged = [df.withColumn("split", F.lit(n)) for df, n in zip(splits, names)]
    whole = tagged[0]
    for frame in tagged[1:]:
        whole = whole.unionByName(frame)
    return write_splits(whole, path, names)


def scratch_splits(df: DataFrame, names: Sequence[str] = ORDERED) -> DataFrame:
    """Write to a new folder below the shared one and read it back."""
    spark = df.sparkSession
    return spark.read.parquet(write_splits(df, fresh_path(spark, "splits"), names))
