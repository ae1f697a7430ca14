import math
import random
from datetime import datetime

import numpy as np
import pytest
from conftest import in_order
from pyspark.sql import functions as F

from meterframe.functions.rounding import quantize_half
from meterframe.functions.timeparts import epoch_seconds
from meterframe.operators import calendar, directions, encode, splits, weather


@pytest.fixture
def times(spark):
    def build(*values):
        return spark.createDataFrame([(v,) for v in values], "t string").selectExpr(
            "cast(t as timestamp_ntz) AS timestamp"
        )

    return build


def test_calendar(times):
    row = calendar.add_calendar_features(times("2017-04-01 01:00:00")).first()
    expected = {"hour": 1, "day": 1, "weekday": 5, "is_weekend": True, "week": 13, "month": 4, "is_holiday": False}
    assert {k: row[k] for k in expected} == expected
    assert row["hour_sin"] == pytest.approx(math.sin(2 * math.pi / 24))
    assert row["month_cos"] == pytest.approx(math.cos(2 * math.pi * 4 / 12))


def test_week_53_wraps(times):
    row = calendar.add_weeks(times("2021-01-01 00:00:00")).first()
    assert row["week"] == 53 and row["week_sin"] == pytest.approx(math.sin(2 * math.pi * 53 / 52))


def test_holidays(times):
    days = ["2025-06-24", "2025-12-26 23:59:59", "2024-05-01", "2024-05-04", "2024-12-27"]
    assert [r["is_holiday"] for r in calendar.add_holidays(times(*days)).collect()] == [True, True, True, False, False]
    assert not calendar.add_holidays(times("2025-06-24"), country="xx").first()["is_holiday"]


def test_switched_off(times):
    df = times("2017-04-01 01:00:00")
    assert calendar.add_calendar_features(
        df, hours=False, dates=False, weekends=False, holidays=False, weeks=False, months=False
    ).columns == ["timestamp", "weekday"]
    assert calendar.add_weekdays(df, weekends=True, country="xx").first()["is_weekend"] is False


def test_seconds_ignore_clock_changes(spark, times):
    spark.conf.set("spark.sql.session.timeZone", "Europe/Riga")
    try:
        hours = [f"2018-03-25 0{h}:30:00" for h in range(6)] + [f"2018-10-28 0{h}:30:00" for h in range(6)]
        found = [r[0] for r in times(*hours).select(epoch_seconds(F.col("timestamp"))).collect()]
        assert [b - a for a, b in zip(found[:6], found[1:6])] == [3600] * 5
        assert [b - a for a, b in zip(found[6:], found[7:])] == [3600] * 5
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_bools_and_one_hot(spark):
    df = spark.createDataFrame([(True, "1", 5), (False, "2", 6), (None, None, 7)], "flag boolean, kind string, v int")
    out = encode.one_hot(encode.normalize_bool_columns(df), ["kind"])
    assert [tuple(r) for r in out.collect()] == [(1, "1", 5, 1, 0), (0, "2", 6, 0, 1), (None, None, 7, 0, 0)]
    assert dict(out.dtypes)["flag"] == "tinyint" and dict(out.dtypes)["kind_1"] == "tinyint"
    with pytest.raises(KeyError):
        encode.one_hot(df, ["absent"])


def test_many_categories(spark):
    assert len(encode.one_hot(spark.range(1001).withColumnRenamed("id", "kind"), ["kind"]).columns) == 1002


def test_sparse_one_hot(spark):
    rng = random.Random(6)
    words = [f"v{rng.randrange(3000)}" for _ in range(5000)]
    rows = [(i, rng.choice([None, "hot", "hot", w])) for i, w in enumerate(words)]
    df = spark.createDataFrame(rows, "i int, kind string").repartition(5)
    place = {v: k for k, v in enumerate(sorted({v for _, v in rows if v is not None}))}
    out = encode.one_hot_sparse(df, ["kind"])
    assert out.columns == ["i", "kind", "kind_index", "kind_value"]
    assert sorted(tuple(r) for r in out.collect()) == sorted(
        ((i, v, place.get(v), int(v is not None)) for i, v in rows), key=lambda r: r[0]
    )
    assert dict(out.dtypes)["kind_value"] == "tinyint"
    fitted = encode.category_codes(df.where("i < 100"), "kind")
    codes = {r["value"]: r["code"] for r in fitted.collect()}
    assert [codes[v] for v in sorted(codes)] == list(range(len(codes)))
    other = {r["i"]: (r["kind_index"], r["kind_value"]) for r in encode.one_hot_sparse(df, ["kind"], {"kind": fitted}).collect()}
    assert other == {i: (codes.get(v), int(v in codes)) for i, v in rows}
    empty = encode.one_hot_sparse(df.limit(0), ["kind", "i"])
    assert empty.collect() == [] and empty.columns[2:] == ["kind_index", "kind_value", "i_index", "i_value"]
    with pytest.raises(KeyError):
        encode.one_hot_sparse(df, ["absent"])


def test_zscore(spark):
    df = spark.createDataFrame([(1.0, 5.0, 9.0), (2.0, 5.0, 9.5), (3.0, 5.0, 1.0)], "x double, same double, energy_kwh double")
    out, stats = encode.zscore_scale_float_columns(df)
    assert [r["x"] for r in out.collect()] == [-1.0, 0.0, 1.0]
    assert [r["same"] for r in out.collect()] == [5.0] * 3
    assert [r["energy_kwh"] for r in out.collect()] == [9.0, 9.5, 1.0]
    again, _ = encode.zscore_scale_float_columns(df.withColumn("x", F.lit(4.0)), stats=stats)
    assert again.first()["x"] == 2.0
    with pytest.raises(KeyError):
        encode.apply_zscore(df, {"same": (1.0, 1.0)})


def test_downcast(spark):
    df = spark.createDataFrame(
        [(1.1, 1e6, None, 1), (2.5, 2e6, None, 2)], "small double, large double, empty double, i int"
    )
    out = encode.downcast_floats(df, half=True)
    assert dict(out.dtypes) == {"small": "float", "large": "float", "empty": "double", "i": "int"}
    assert out.first()["small"] == float(np.float16(1.1))
    assert dict(encode.downcast_floats(df, ["large"]).dtypes)["large"] == "double"


def test_half_precision(spark):
    rnd = random.Random(3)
    values = [0.0, 65504.0, 65519.9, 65520.0, -70000.0, 6e-8, 2.0**-24, 2.0**-25, 2049.0, 2051.0, 8.0, 7.9999]
    values += [rnd.uniform(-1, 1) * 10 ** rnd.randint(-7, 5) for _ in range(2000)]
    df = spark.createDataFrame([(v,) for v in values], "x double").select(quantize_half(F.col("x")).alias("h"))
    with np.errstate(over="ignore"):
        expected = [float(np.float16(v)) for v in values]
    assert [r["h"] for r in df.collect()] == expected


BOUNDS = {
    "train": {"start": "2020-01-01 00:00:00", "end": "2020-01-01 04:00:00"},
    "dev": {"start": "2020-01-01 04:00:00", "end": "2020-01-01 07:00:00"},
    "test": {"start": "2020-01-01 07:00:00", "end": "2020-01-01 10:00:00"},
}


def test_half_open_ranges(panel):
    df = panel([("a", h, float(h)) for h in range(12)])
    assert splits.filter_time_range(df, "2020-01-01 02:00:00", "2020-01-01 05:00:00").count() == 3
    bounds = splits.check_bounds(BOUNDS)
    assert [s.count() for s in splits.prepare_splits(df, bounds)] == [4, 3, 3]
    found = {r["split"]: (r["rows"], r["first_time"].hour, r["last_time"].hour)
             for r in splits.split_coverage(splits.assign_split(df, bounds)).collect()}
    assert found == {"train": (4, 0, 3), "dev": (3, 4, 6), "test": (3, 7, 9)}


def test_bounds_without_dev(panel):
    bounds = splits.check_bounds({k: v for k, v in BOUNDS.items() if k != "dev"})
    assert len(splits.prepare_splits(panel([("a", 0, 1.0)]), bounds)) == 2


@pytest.mark.parametrize(
    "change, message",
    [
        ({"test": None}, "no test split"),
        ({"dev": {"start": "2020-01-01 03:00:00", "end": "2020-01-01 07:00:00"}}, "overlap"),
        ({"dev": {"start": "2020-01-01 07:00:00", "end": "2020-01-01 07:00:00"}}, "dev is empty"),
        ({"dev": {"start": "2020-01-01 07:00:00"}}, "no start or no end"),
    ],
)
def test_wrong_bounds(change, message):
    raw = {k: v for k, v in {**BOUNDS, **change}.items() if v}
    with pytest.raises(ValueError, match=message):
        splits.check_bounds(raw)


def test_bounds_file(tmp_path):
    path = tmp_path / "short.yaml"
    path.write_text("splits:\n" + "".join(
        f"  {k}:\n    start: \"{v['start']}\"\n    end: \"{v['end']}\"\n" for k, v in BOUNDS.items()
    ))
    bounds, name = splits.load_splits(path)
    assert name == "short" and bounds["dev"][0] == datetime(2020, 1, 1, 4)
    with pytest.raises(FileNotFoundError):
        splits.load_splits(tmp_path / "none.yaml")
    (tmp_path / "odd.yaml").write_text("other: 1\n")
    with pytest.raises(ValueError, match="nothing under"):
        splits.load_splits(tmp_path / "odd.yaml")


def test_written_splits(panel, spark, tmp_path):
    df = panel([("a", h, float(h)) for h in range(10)])
    parts = splits.prepare_splits(df, splits.check_bounds(BOUNDS))
    path = splits.save_splits(parts, str(tmp_path / "s"))
    back = spark.read.parquet(path).where("split = 'dev'")
    assert back.count() == 3
    assert "PartitionFilters: [isnotnull(split" in back._jdf.queryExecution().executedPlan().toString()
    with pytest.raises(ValueError, match="expected"):
        splits.save_splits([df], path)
    with pytest.raises(ValueError, match="nothing to write"):
        splits.save_splits([df, df.where("false")], str(tmp_path / "t"))


def test_time_filter_reaches_the_scan(panel, spark, tmp_path):
    panel([("a", h, float(h)) for h in range(10)]).write.parquet(str(tmp_path / "p"))
    df = splits.assign_split(spark.read.parquet(str(tmp_path / "p")), splits.check_bounds(BOUNDS))
    plan = df.select("split")._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(timestamp,2020-01-01T00:00)" in plan
    assert "ReadSchema: struct<timestamp:timestamp_ntz>" in plan


def test_weather_of_int_and_text_ids(spark):
    hour = "timestamp_ntz'2020-01-01 00:00:00'"
    readings = spark.sql(f"SELECT * FROM VALUES ({hour}, 1, 10), ({hour}, 2, 20), ({hour}, 9, 30) t(timestamp, object_id, value)")
    metadata = spark.sql("SELECT * FROM VALUES ('1', 7), ('2', 8) t(object_id, region_id)")
    rows = spark.sql(
        f"SELECT * FROM VALUES ({hour}, 7, 5.0D, 'historical', 1), ({hour}, 8, 7.0D, 'historical', 2), "
        f"({hour}, 8, 7.5D, 'forecast', 3) t(timestamp, region_id, temp, data_type, value)"
    )
    out = weather.join_weather(readings, metadata, rows).orderBy("object_id").collect()
    assert [(r["object_id"], r["temp"], r["value_x"], r["value_y"]) for r in out] == [
        ("1", 5.0, 10, 1), ("2", 7.0, 20, 2), ("9", None, 30, None),
    ]
    assert weather.join_weather(readings, metadata, rows, None).count() == 4


def test_directions(spark):
    df = spark.createDataFrame(
        [("m", 1.0, 2.0, 3.0, 4.0, 5)],
        "object_id string, energy_import_kwh double, energy_export_kwh double, import_lag_1 double, "
        "lagged_1_energy_export_kwh double, hour int",
    )
    one, two = directions.energy_import_export_split(df)
    assert one.columns == ["object_id", "energy_kwh", "lag_1", "hour"]
    assert two.columns == ["object_id", "energy_kwh", "lagged_1_energy_kwh", "hour"]
    assert (one.first()["energy_kwh"], two.first()["energy_kwh"]) == (1.0, 2.0)
    with pytest.raises(ValueError):
        directions.split_by_direction(df, "sideways")


def test_overlapping_bounds_as_rows(spark):
    df = spark.createDataFrame(
        [("k", "a", 1, 5), ("k", "b", 4, 8), ("k", "c", 8, 8), ("j", "a", 1, 2), ("j", "b", 2, 3)],
        "k string, split string, start int, end int",
    )
    found = {(r["k"], r["split"]): (r["empty"], r["overlaps"]) for r in splits.split_bounds_violations(df, "k").collect()}
    assert found == {("k", "b"): (False, True), ("k", "c"): (True, False)}
