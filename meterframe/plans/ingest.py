"""From delivered rows to checked raw tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import cleaning, quality
from ..schemas import TABLES
from ..session import durable


@dataclass(frozen=True)
class Ingested:
    metadata: DataFrame
    regions: DataFrame
    readings: DataFrame
    weather: DataFrame
    report: DataFrame


def _line(df: DataFrame, table: str, check, value: str) -> DataFrame:
    check = F.lit(check) if isinstance(check, str) else check
    return df.select(
        F.lit(table).alias("table_name"), check.alias("check_name"), F.col(value).cast("bigint").alias("value")
    )


# The series of a table; of weather, each kind is one of its own.
SERIES = {"smart_meter": ["object_id"], "weather": ["region_id", "data_type"]}


def _checked_schema(frame: DataFrame, table: str) -> DataFrame:
    wrong = quality.schema_mismatches(frame, TABLES[table])
    if wrong:  # there is nothing to count in a column that is not there
        raise ValueError(f"{table}: {'; '.join(wrong)}")
    return frame


def quality_report(
    metadata: DataFrame,
    regions: DataFrame,
    readings: DataFrame,
    weather: DataFrame,
    watched: Mapping[str, Mapping[str, int]] | None = None,
) -> DataFrame:
    """(table_name, check_name, value) of all checks; 0 is good.

    Readings and weather are read once, into a summary of their series from which
    keys, references and steps are checked.  Rules of a table in ``watched`` were
    counted when it was written (``quality.watch_rules``); others take one more pass.
    """
    frames = {"region": regions, "customer_metadata": metadata, "smart_meter": readings, "weather": weather}
    lines = []
    for table, frame in frames.items():
        _checked_schema(frame, table)
        if table in (watched or {}):
            found = [(table, rule, int(n)) for rule, n in watched[table].items()]
            lines.append(frame.sparkSession.createDataFrame(found, "table_name string, check_name string, value bigint"))
        else:
            lines.append(_line(quality.schema_violations(frame, table), table, F.col("rule"), "violations"))
        if table not in SERIES:
            lines.append(_line(quality.pk_violations(frame, table), table, "duplicate keys", "duplicate_keys"))
    for table, keys in SERIES.items():
        frames[table] = durable(quality.series_summary(frames[table], keys), f"{table}-series")
        repeated = frames[table].agg(F.coalesce(F.sum("repeated"), F.lit(0)).alias("repeated"))
        lines.append(_line(repeated, table, "duplicate keys", "repeated"))
        lines.append(_line(quality.series_gaps(frames[table], keys), table, "gaps", "gap"))
    fk = quality.fk_violations(frames, {table: "rows" for table in SERIES})
    lines.append(
        fk.select(
            F.split("foreign_key", r"\.")[0].alias("table_name"),
            F.col("foreign_key").alias("check_name"),
            F.col("orphan_rows").cast("bigint").alias("value"),
        )
    )
    return reduce(DataFrame.unionByName, lines)


def ingest(
    readings: DataFrame,
    metadata: DataFrame,
    regions: DataFrame,
    weather: DataFrame,
    key: str = "object_id",
    ties: Sequence[str] = (),
    strict: bool = True,
) -> Ingested:
    """Parse times, merge duplicates, stamp, stage and check.

    ``strict`` fails if any check finds something; otherwise the report says
    what was found.
    """
    parsed = cleaning.timestamp_to_datetime(readings)
    single = cleaning.handle_duplicates(parsed, "smart_meter", key, ties)
    stamped = cleaning.add_ingestion_time(single, "smart_meter_backtest")
    clean_weather = cleaning.add_ingestion_time(cleaning.timestamp_to_datetime(weather), "weather", 7)
    # Written once; rules are counted on the way, the rest is checked from what was written.
    kept, watched = {}, {}
    for table, frame in {"smart_meter": stamped, "weather": clean_weather}.items():
        frame, seen = quality.watch_rules(_checked_schema(frame, table), table)
        kept[table] = durable(frame, table)
        watched[table] = seen.get
    staged, staged_weather = kept["smart_meter"], kept["weather"]
    report = quality_report(metadata, regions, staged, staged_weather, watched)
    if strict:
        # one row per check
        found = [f"{r['table_name']}: {r['check_name']} = {r['value']}" for r in report.where("value > 0").collect()]
        if found:
            raise ValueError("ingestion checks failed: " + "; ".join(found))
    return Ingested(metadata, regions, staged, staged_weather, report)
