"""Checks that report violations as rows instead of stopping half-way."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from ..schemas import TABLES, TableRules
from .series import SeriesOrder, SeriesParts, over_series


def duplicate_stats(df: DataFrame, key: str, time: str = "timestamp") -> DataFrame:
    """One row: duplicated (key, time) groups and the rows they hold."""
    groups = df.groupBy(key, time).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    return groups.agg(
        F.count(F.lit(1)).alias("duplicate_groups"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("duplicate_rows"),
    )


def check_duplicates(df: DataFrame, key: str, time: str = "timestamp") -> int:
    """Number of duplicated (key, time) groups."""
    return duplicate_stats(df, key, time).first()["duplicate_groups"]


def time_continuity(
    df: DataFrame,
    key: str = "object_id",
    time: str = "timestamp",
    expected_step_hours: float = 1,
    ties: Sequence[str] = (),
    parts: SeriesParts | None = None,
    **measured,
) -> DataFrame:
    """Steps per series that are ok, a gap, or run backwards."""
    order = SeriesOrder(key, time, tuple(ties))

    def build(frame: DataFrame, p: SeriesParts) -> DataFrame:
        before = F.lag(time).over(p.window())
        hours = (F.col(time) - before).cast("interval day to second")
        step = F.expr(f"INTERVAL '{round(expected_step_hours * 3600)}' SECOND")
        zero = F.expr("INTERVAL '0' SECOND")
        return frame.withColumn(
            "__flag",
            F.when(hours > step, "gap").when(hours < zero, "time_reversal").otherwise("ok"),
        )

    # Only the two columns that matter are shuffled.
    narrow = df.select(*dict.fromkeys([key, time, *ties]))
    flagged = over_series(narrow, parts, build, lookback=1, order=order, **measured)
    return flagged.groupBy(key).agg(
        *[F.count_if(F.col("__flag") == f).alias(f) for f in ("ok", "gap", "time_reversal")]
    )


def check_time_continuity(df: DataFrame, id_col: str = "object_id", **options) -> DataFrame:
    """``time_continuity``; fails if any series has a gap."""
    summary = time_continuity(df, id_col, **options)
    broken = summary.where("gap > 0 OR time_reversal > 0").count()
    if broken:
        raise ValueError(f"time continuity: {broken} series of {id_col} have gaps")
    return summary


BIN_STEPS = 4096  # steps of time of one series that are looked at together


def series_summary(
    df: DataFrame, keys: Sequence[str], time: str = "timestamp", expected_step_hours: float = 1
) -> DataFrame:
    """(keys, first, last, rows, repeated, gaps) of each series and bin of time:
    what the checks of keys, references and steps need, from one exchange of
    keys and times.  ``repeated`` counts times that more than one row has, ``gaps``
    steps within the bin that are too long; times are microseconds since 1970.

    A series of any length is cut into bins, so none has to be in one task.
    """
    step = round(expected_step_hours * 3_600_000_000)
    broken = reduce(Column.__or__, [F.col(c).isNull() for c in [*keys, time]])
    message = f"rows have no {' or no '.join([*keys, time])}; remove them first (quality.drop_unkeyed)"
    at = F.when(broken, F.raise_error(F.lit(message)).cast("bigint")).otherwise(
        F.unix_micros(F.col(time).cast("timestamp"))
    )
    binned = df.select(*keys, at.alias("__at")).withColumn(
        "__bin", F.expr(f"floor(__at / {float(step * BIN_STEPS)!r}D)")
    )
    w = Window.partitionBy(*keys, "__bin").orderBy("__at")
    before = F.lag("__at").over(w)
    second = (F.col("__at") == before) & ~F.lag("__at", 2).over(w).eqNullSafe(F.col("__at"))
    flagged = binned.withColumns({"__second": second, "__gap": F.col("__at") - before > step})
    return (
        flagged.groupBy(*keys, "__bin")
        .agg(
            F.min("__at").alias("first"),
            F.max("__at").alias("last"),
            F.count(F.lit(1)).alias("rows"),
            F.count_if("__second").alias("repeated"),
            F.count_if("__gap").alias("gaps"),
        )
        .drop("__bin")
    )


def series_gaps(summary: DataFrame, keys: Sequence[str], expected_step_hours: float = 1) -> DataFrame:
    """One row, ``gap``: steps of all series that are too long, within bins of the
    summary and between them."""
    step = round(expected_step_hours * 3_600_000_000)
    before = F.lag("last").over(Window.partitionBy(*keys).orderBy("first"))
    between = summary.select("gaps", (F.col("first") - before > step).cast("int").alias("between"))
    return between.agg((F.coalesce(F.sum("gaps"), F.lit(0)) + F.coalesce(F.sum("between"), F.lit(0))).alias("gap"))


def _rule(name: str, broken: Column) -> tuple[str, Column]:
    return name, F.count_if(broken)


def _report(df: DataFrame, table: str, rules: Sequence[tuple[str, Column]]) -> DataFrame:
    """All rules in one pass: (table_name, rule, violations)."""
    names = [name for name, _ in rules]
    counted = df.agg(*[c.alias(name) for name, c in rules])
    return counted.unpivot([], [F.col(f"`{n}`") for n in names], "rule", "violations").select(
        F.lit(table).alias("table_name"), "rule", "violations"
    )


def schema_mismatches(df: DataFrame, rules: TableRules) -> list[str]:
    """Columns that are missing or have another type; needs no job."""
    have = {f.name: f.dataType for f in df.schema.fields}
    out = []
    for f in rules.schema.fields:
        if f.name not in have:
            if f.name not in rules.optional:
                out.append(f"{f.name}: missing")
        elif have[f.name] != f.dataType:
            out.append(f"{f.name}: {have[f.name].simpleString()} is not {f.dataType.simpleString()}")
    return out


def _rules(df: DataFrame, table: str) -> list[tuple[str, Column]]:
    rules = TABLES[table]
    checks = [
        _rule(f"{c} not null", F.col(c).isNull()) for c in rules.not_null if c in df.columns
    ]
    for c, low, high in rules.ranges:
        if c not in df.columns:
            continue
        if low is not None:
            checks.append(_rule(f"{c} >= {low}", F.col(c) < low))
        if high is not None:
            checks.append(_rule(f"{c} <= {high}", F.col(c) > high))
    return checks


def schema_violations(df: DataFrame, table: str) -> DataFrame:
    """Nulls and out-of-range values per rule of the table."""
    return _report(df, table, _rules(df, table))


def watch_rules(df: DataFrame, table: str) -> tuple[DataFrame, Observation]:
    """The frame, and the violations of its table's rules as they are counted
    by the job that writes it: rule -> rows, in ``get``."""
    seen = Observation()
    return df.observe(seen, *[c.alias(name) for name, c in _rules(df, table)]), seen


def validate(df: DataFrame, table: str) -> DataFrame:
    """The frame itself if it satisfies its table's rules; else an error."""
    wrong = schema_mismatches(df, TABLES[table])
    wrong += [
        f"{r['rule']}: {r['violations']} rows"
        for r in schema_violations(df, table).where("violations > 0").collect()  # one row per rule
    ]
    if wrong:
        raise ValueError(f"{table}: {'; '.join(wrong)}")
    return df


def not_null_violations(df: DataFrame, table: str) -> DataFrame:
    rules = TABLES[table]
    return _report(df, table, [_rule(c, F.col(c).isNull()) for c in rules.not_null])


def pk_violations(df: DataFrame, table: str) -> DataFrame:
    """(table_name, duplicate_keys, extra_rows) of the primary key."""
    keys = TABLES[table].primary_key
    groups = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return groups.agg(
        F.count_if(F.col("n") > 1).alias("duplicate_keys"),
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("extra_rows"),
    ).select(F.lit(table).alias("table_name"), "duplicate_keys", "extra_rows")


def fk_violations(frames: Mapping[str, DataFrame], counted: Mapping[str, str] | None = None) -> DataFrame:
    """Rows per foreign key whose parent is missing; a null reference is
    allowed.  Child rows are reduced to (reference, rows) before the join, so
    a reference that many rows share travels once.  Of a table in ``counted``
    the frame is a summary, and that column says how many rows a line stands for."""
    found = []
    for table, rules in TABLES.items():
        for column, parent, parent_key in rules.foreign_keys:
            if table not in frames or parent not in frames:
                continue
            rows = F.sum((counted or {})[table]) if table in (counted or {}) else F.count(F.lit(1))
            used = (
                frames[table]
                .where(F.col(column).isNotNull())
                .groupBy(F.col(column).alias("reference"))
                .agg(rows.alias("n"))
            )
            parents = frames[parent].select(F.col(parent_key).alias("reference"))
            found.append(
                used.join(parents, "reference", "left_anti").agg(
                    F.count(F.lit(1)).alias("missing_keys"),
                    F.coalesce(F.sum("n"), F.lit(0)).alias("orphan_rows"),
                ).select(
                    F.lit(f"{table}.{column} -> {parent}").alias("foreign_key"),
                    "missing_keys",
                    "orphan_rows",
                )
            )
    return reduce(DataFrame.unionByName, found)
