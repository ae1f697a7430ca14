import random
from collections import Counter
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from meterframe.operators import quality, splits
from meterframe.plans import ingest as ingestion
from meterframe.plans.features import FeaturePlan, build_features, make_splits
from meterframe.schemas import METADATA, READINGS, REGIONS, WEATHER
from meterframe.sources import files, layers, prices, tables, weather_payload
from meterframe.streaming import incremental


def test_csv_by_header(spark, tmp_path):
    (tmp_path / "1.csv").write_text(
        "timestamp,customer_id,object_id,metering_point_id,energy_import_kwh,energy_export_kwh,tariff_code\n"
        "01.04.2017 01:00,c,m,7,1.5,0,T1\n01.04.2017 02:00,c,m,7,NaN,,NA\n"
    )
    (tmp_path / "2.csv").write_text(
        "object_id,timestamp,energy_export_kwh,energy_import_kwh,customer_id\nn,01.04.2017 01:00,0.25,2,d\n"
    )
    df = files.read_readings(spark, [str(tmp_path / "1.csv"), str(tmp_path / "2.csv")])
    assert [f.name for f in df.schema.fields] == [n for n in READINGS.fieldNames() if n != "ingested_at"]
    rows = {(r["object_id"], r["timestamp"][-5:]): r for r in df.collect()}
    assert rows["m", "01:00"]["energy_import_kwh"] == 1.5 and rows["m", "01:00"]["metering_point_id"] == 7
    assert rows["m", "02:00"]["energy_import_kwh"] is None and rows["m", "02:00"]["tariff_code"] is None
    assert rows["n", "01:00"]["energy_export_kwh"] == 0.25 and rows["n", "01:00"]["tariff_code"] is None


def test_layers(spark, tmp_path):
    root = str(tmp_path)
    df = spark.createDataFrame([(1, 2), (3, 4)], "a int, b int")
    path = layers.write_parquet(df, root, "Raw", "t")
    assert path.endswith("/raw/t.parquet")
    assert layers.load_parquet(spark, root, "RAW", "t").exceptAll(df).count() == 0
    with pytest.raises(ValueError, match="invalid layer"):
        layers.load_parquet(spark, root, "cooked", "t")
    with pytest.raises(FileNotFoundError):
        layers.load_parquet(spark, root, "raw", "absent")
    with pytest.raises(ValueError, match="empty"):
        layers.write_parquet(df.where("false"), root, "raw", "t")
    assert layers.load_parquet(spark, root, "raw", "t").count() == 2
    df.write.parquet(f"{root}/original/sub/t.parquet")
    assert layers.load_parquet(spark, root, "original", "t", category="sub").count() == 2


def test_at_date():
    assert tables.validate_at_date("2017-04-01 00:00:00") == datetime(2017, 4, 1)
    for wrong in ("2017-04-01", "01.04.2017 00:00:00", "2017-04-01T00:00:00"):
        with pytest.raises(ValueError, match="no time of the form"):
            tables.validate_at_date(wrong)


@pytest.fixture
def readings(spark):
    return spark.createDataFrame(
        [("c", datetime(2020, 1, 1, h), "m", 7, "T", float(h), 0.0, datetime(2020, 1, 1, h)) for h in range(4)],
        READINGS,
    )


def test_incremental_read_is_strict_and_pushed(spark, readings, tmp_path):
    readings.write.parquet(str(tmp_path / "r"))
    df = tables.load_sm_data(spark.read.parquet(str(tmp_path / "r")), "2020-01-01 01:00:00")
    assert sorted(r["energy_import_kwh"] for r in df.collect()) == [2.0, 3.0]
    assert "GreaterThan(ingested_at,2020-01-01T01:00)" in df._jdf.queryExecution().executedPlan().toString()


def test_tables(spark, readings, tmp_path):
    where, prefix = str(tmp_path / "tables"), "unit_"
    assert len(tables.create_raw_tables(spark, where, prefix)) == 4
    tables.create_raw_tables(spark, where, prefix)
    name = prefix + tables.TABLE_NAMES["smart_meter"]
    tables.load_dataframe(readings.select(*reversed(readings.columns)), name)
    tables.load_dataframe(readings, name)
    assert spark.table(name).count() == 8
    with pytest.raises(ValueError, match="not empty"):
        tables.load_dataframe(readings, name, if_exists="fail")
    tables.load_dataframe(readings, name, if_exists="replace")
    assert spark.table(name).count() == 4
    assert set(tables.truncate_table(spark, "region", prefix)) == {prefix + n for n in tables.TABLE_NAMES.values()}
    assert spark.table(name).count() == 0


def test_truncating_a_child_leaves_its_parents(spark, tmp_path):
    tables.create_raw_tables(spark, str(tmp_path), "child_")
    region = "child_" + tables.TABLE_NAMES["region"]
    tables.load_dataframe(spark.createDataFrame([(1, 0.0, 0.0)], REGIONS), region)
    tables.truncate_table(spark, "customer_metadata", "child_")
    assert spark.table(region).count() == 1


def test_stream_reads_each_file_once(spark, readings, tmp_path):
    source, sink, marks = (str(tmp_path / n) for n in ("in", "out", "marks"))

    def run():
        stream = incremental.readings_stream(spark, source, READINGS, "2020-01-01 00:00:00")
        incremental.append_new(stream, sink, marks).awaitTermination()
        return spark.read.schema(READINGS).parquet(sink).count()

    readings.where("energy_import_kwh < 2").write.mode("append").parquet(source)
    assert run() == 1
    assert run() == 1
    readings.where("energy_import_kwh >= 2").write.mode("append").parquet(source)
    assert run() == 3


def payload(spark, hours, region=1, **extra):
    start = 1_491_004_800  # 2017-04-01 00:00:00
    return spark.createDataFrame(
        [(region, start, start + 3600 * hours, 3600, 10800, [float(h) for h in range(hours)], [1.0])],
        "region_id int, start_epoch bigint, end_epoch bigint, step_s int, offset_s int, "
        "temperature_2m array<float>, rain array<float>",
    )


VARS = ("temperature_2m", "rain")


def test_payload_rows(spark):
    rows = weather_payload.explode_payload(payload(spark, 3), ["region_id"], VARS).orderBy("timestamp").collect()
    assert [(r["timestamp"], r["temperature_2m"], r["rain"]) for r in rows] == [
        (datetime(2017, 4, 1, 3), 0.0, 1.0), (datetime(2017, 4, 1, 4), 1.0, None), (datetime(2017, 4, 1, 5), 2.0, None),
    ]
    assert weather_payload.explode_payload(payload(spark, 0), ["region_id"], VARS).count() == 0


def test_weather_modes(spark):
    regions = spark.createDataFrame([(1, 0.0, 0.0), (2, 0.0, 0.0)], REGIONS)
    both = payload(spark, 5).unionByName(payload(spark, 2, 2)).unionByName(payload(spark, 4, 3))
    out = weather_payload.weather_by_region(both, regions, "forecast", horizon_hours=3, variables=VARS)
    assert {r[0]: r[1] for r in out.groupBy("region_id").count().collect()} == {1: 3, 2: 2}
    assert out.select("forecast_start").distinct().first()[0] == datetime(2017, 4, 1, 3)
    assert weather_payload.weather_by_region(
        both, regions, "historical", "2017-04-01", "2017-04-02", variables=VARS
    ).where("data_type = 'historical'").count() == 7
    assert weather_payload.pull_weather("backtest", both, regions, VARS).count() == 7
    assert weather_payload.pull_weather("live", both, regions, VARS) is None
    many = weather_payload.first_hours(weather_payload.explode_payload(payload(spark, 1300), ["region_id"], VARS), 1200)
    assert many.count() == 1200
    for mode, days in (("backcast", ()), ("historical", ("2017-04-01",))):
        with pytest.raises(ValueError):
            weather_payload.weather_by_region(both, regions, mode, *days, variables=VARS)


def test_price_rows(spark):
    rows = [
        "<tr><td> 00 - 01 </td><td>\n 12,34 </td></tr>",
        "<TR><TD class='a'><b>01 - 02</b></TD><TD>-5.5</TD></TR>",
        "<tr><td>02 - 03</td><td>1.234,5</td></tr>",
        "<tr><td>03 - 04</td><td>-</td></tr>",
        "<tr><td>a</td><td>1</td><td>2</td></tr>",
        "<tr><td>only</td></tr>",
    ]
    df = prices.clean_price_rows(spark.createDataFrame([(r,) for r in rows], "row_html string"))
    assert sorted((r[0], r[1]) for r in df.collect()) == [("00 - 01", 12.34), ("01 - 02", -5.5)]


@pytest.fixture
def world(spark):
    """Two meters in two regions with hourly readings and weather."""
    regions = spark.createDataFrame([(1, 56.9, 24.1), (2, 56.5, 21.0)], REGIONS)
    metadata = spark.createDataFrame(
        [("c", "n", "m", "a", 7, "T", 56.9, 24.1, 1), ("d", "n", "k", "a", 8, "T", 56.5, 21.0, 2)], METADATA
    )
    hours = spark.range(24 * 12).selectExpr(
        "timestamp_ntz'2018-10-20 00:00:00' + make_dt_interval(0, cast(id as int)) AS timestamp", "id"
    )
    readings = hours.selectExpr(
        "*", "explode(array(struct('c' AS c, 'm' AS o, 7L AS p), struct('d' AS c, 'k' AS o, 8L AS p))) AS who"
    ).selectExpr(
        "who.c AS customer_id", "date_format(timestamp, 'dd.MM.yyyy HH:mm:ss') AS timestamp", "who.o AS object_id",
        "who.p AS metering_point_id", "'T' AS tariff_code", "cast(id % 24 as double) AS energy_import_kwh",
        "0D AS energy_export_kwh",
    )
    weather = hours.selectExpr("*", "explode(array(1, 2)) AS region_id").select(
        *[
            F.col(f.name) if f.name in ("timestamp", "region_id")
            else F.lit("historical").alias(f.name) if f.name == "data_type"
            else F.col("timestamp").alias(f.name) if f.name == "ingested_at"
            else (F.col("id") + F.col("region_id")).cast("float").alias(f.name)
            for f in WEATHER.fields
        ]
    )
    return readings, metadata, regions, weather


def test_ingest(world):
    readings, metadata, regions, weather = world
    twice = readings.unionByName(readings.where("timestamp = '28.10.2018 03:00:00' OR timestamp = '21.10.2018 03:00:00'"))
    done = ingestion.ingest(twice, metadata, regions, weather)
    assert done.readings.schema["timestamp"].dataType.typeName() == "timestamp_ntz"
    assert quality.check_duplicates(done.readings, "object_id") == 0
    hour3 = done.readings.where("hour(timestamp) = 3 AND object_id = 'm'")
    found = {r["timestamp"].day: r["energy_import_kwh"] for r in hour3.collect()}
    assert (found[21], found[28], found[22]) == (3.0, 6.0, 3.0)
    assert done.report.where("value > 0").count() == 0


def test_ingest_stops_on_a_gap(world):
    readings, metadata, regions, weather = world
    holes = readings.where("NOT (object_id = 'm' AND timestamp = '22.10.2018 05:00:00')")
    with pytest.raises(ValueError, match="smart_meter: gaps = 1"):
        ingestion.ingest(holes, metadata, regions, weather)
    report = ingestion.ingest(holes, metadata.where("object_id = 'm'"), regions, weather, strict=False).report
    found = {(r["table_name"], r["check_name"]): r["value"] for r in report.where("value > 0").collect()}
    assert found == {
        ("smart_meter", "gaps"): 1,
        ("smart_meter", "smart_meter.object_id -> customer_metadata"): 288,
    }


def test_report_reads_the_staged_rows_once(world):
    readings, metadata, regions, weather = world
    done = ingestion.ingest(readings, metadata, regions, weather)
    staged = {*done.readings.inputFiles(), *done.weather.inputFiles()}
    assert staged and not staged & set(done.report.inputFiles())  # only summaries of series
    assert len(done.report.collect()) == len({(r["table_name"], r["check_name"]) for r in done.report.collect()})


def test_rules_broken_are_counted_while_staging(world):
    readings, metadata, regions, weather = world
    low = readings.withColumn("energy_import_kwh", F.when(F.hour(F.to_timestamp("timestamp", "dd.MM.yyyy HH:mm:ss")) == 5, -1.0).otherwise(F.col("energy_import_kwh")))
    report = ingestion.ingest(low, metadata, regions, weather, strict=False).report
    found = {(r["table_name"], r["check_name"]): r["value"] for r in report.where("value > 0").collect()}
    assert found == {("smart_meter", "energy_import_kwh >= 0"): 24}
    none = ingestion.ingest(readings.limit(0), metadata, regions, weather)
    assert none.readings.count() == 0 and none.report.where("value > 0").count() == 0


def test_series_summary(spark):
    rng = random.Random(3)
    rows = [(rng.choice("abb"), rng.choice("xy"), rng.randrange(0, 60_000) * 30) for _ in range(3000)]
    rows += [r for r in rows if rng.random() < 0.2] * 2
    df = spark.createDataFrame(rows, "a string, b string, m int").selectExpr(
        "a", "b", "timestamp_ntz'2000-03-01 00:00:00' + make_dt_interval(0, 0, m) AS timestamp"
    )
    summary = quality.series_summary(df, ["a", "b"], expected_step_hours=2)
    assert summary.count() > 8
    repeated = sum(n > 1 for n in Counter(rows).values())
    assert summary.agg(F.sum("repeated"), F.sum("rows")).first() == (repeated, len(rows))
    whole = quality.time_continuity(df.withColumn("s", F.concat("a", "b")), "s", expected_step_hours=2)
    assert quality.series_gaps(summary, ["a", "b"], 2).first()["gap"] == whole.agg(F.sum("gap")).first()[0]
    with pytest.raises(Exception, match="remove them first"):
        quality.series_summary(df.withColumn("b", F.lit(None).cast("string")), ["a", "b"]).collect()


def test_feature_table(world, spark, tmp_path):
    readings, metadata, regions, weather = world
    done = ingestion.ingest(readings, metadata, regions, weather)
    table = build_features(done.readings, done.metadata, done.weather, FeaturePlan(digits=2))
    assert table.count() == 24 * 12 * 2
    row = table.where("object_id = 'k' AND timestamp = timestamp_ntz'2018-10-28 05:00:00'").first()
    assert row["temperature_2m"] == 24 * 8 + 5 + 2
    assert row["rolling_mean_energy_kwh_6"] == pytest.approx((23 + 0 + 1 + 2 + 3 + 4) / 6)
    assert row["lagged_168_energy_kwh"] == 5.0 and row["lagged_168_energy_kwh_frozen"] == 0.0
    assert row["forecast_origin_time"] == datetime(2018, 10, 27, 23)
    assert row["hour_5"] == 1 and row["weekday_6"] == 1 and row["is_weekend"] == 1
    assert row["customer_mean_energy_kwh"] == pytest.approx((7 * sum(range(24)) + sum(range(6))) / (7 * 24 + 6))

    cut = build_features(done.readings, done.metadata, done.weather, FeaturePlan(
        digits=2, windows=(6,), lags=(1,), average_days=(1,), part_rows=60))
    whole = build_features(done.readings, done.metadata, done.weather, FeaturePlan(
        digits=2, windows=(6,), lags=(1,), average_days=(1,)))
    assert cut.exceptAll(whole).count() == 0 and cut.count() == whole.count()

    every = build_features(done.readings, done.metadata, done.weather.unionByName(
        done.weather.withColumn("data_type", F.lit("forecast"))), FeaturePlan(digits=2, data_type=None))
    assert every.count() == 2 * table.count()

    # Rows that occur twice in a dimension repeat finished rows, never a past.
    twice = build_features(done.readings, done.metadata.unionAll(done.metadata), done.weather, FeaturePlan(digits=2))
    assert twice.columns == table.columns
    assert twice.count() == 2 * table.count() and twice.distinct().exceptAll(table).count() == 0

    bounds = {
        "train": (datetime(2018, 10, 22), datetime(2018, 10, 28)),
        "test": (datetime(2018, 10, 28), datetime(2018, 10, 30)),
    }
    path = make_splits(done.readings, done.metadata, done.weather, bounds, str(tmp_path / "s"), FeaturePlan(digits=2))
    found = {r[0]: r[1] for r in spark.read.parquet(path).groupBy("split").count().collect()}
    assert found == {"train": 288, "test": 96}


def test_folder_of_files_with_other_column_orders(spark, tmp_path):
    folder = tmp_path / "mixed"
    folder.mkdir()
    (folder / "a.csv").write_text("region_id,center_latitude,center_longitude\n1,10.0,20.0\n")
    (folder / "b.csv").write_text("center_longitude,region_id,center_latitude\n21.0,2,11.0\n")
    (folder / "c.csv").write_text("region_id,center_longitude\n3,NaN\n")
    rows = {r["region_id"]: (r["center_latitude"], r["center_longitude"]) for r in files.read_regions(spark, str(folder)).collect()}
    by = {str(k): v for k, v in rows.items()}
    assert by == {"1": (10.0, 20.0), "2": (11.0, 21.0), "3": (None, None)}


def test_refused_splits_leave_the_dataset(spark, tmp_path):
    path = str(tmp_path / "splits")
    rows = spark.range(10).withColumn("split", F.when(F.col("id") < 5, "train").otherwise("test"))
    splits.write_splits(rows, path, ["train", "test"])
    with pytest.raises(ValueError):
        splits.write_splits(rows.where("split = 'train'"), path, ["train", "test"])
    assert spark.read.parquet(path).count() == 10
    splits.write_splits(rows.where("id between 4 and 5"), path, ["train", "test"])
    assert spark.read.parquet(path).count() == 2 and len(list(tmp_path.iterdir())) == 1


def test_all_faults_of_bounds_are_told():
    with pytest.raises(ValueError, match="no test split.*train is empty"):
        splits.check_bounds({"train": {"start": "2020-01-02", "end": "2020-01-01"}})


def test_not_a_number_is_missing_in_parquet(spark, tmp_path):
    spark.createDataFrame([(float("nan"),), (float("inf"),), (1.0,)], "x double").write.parquet(str(tmp_path / "raw" / "t.parquet"))
    got = layers.load_parquet(spark, str(tmp_path), "raw", "t").collect()
    assert sorted((r["x"] is None, r["x"]) for r in got if r["x"] is not None) == [(False, 1.0)] and len(got) == 3


def test_later_forecast_stands_beside_an_earlier(spark, tmp_path):
    path = str(tmp_path / "weather")
    for day in (1, 2, 2):
        rows = spark.range(3).selectExpr("'forecast' AS data_type", "1 AS region_id", f"timestamp_ntz'2020-01-0{day} 00:00:00' AS forecast_start", "24 AS horizon_hours", "id")
        weather_payload.write_weather(rows, path)
    assert spark.read.parquet(path).count() == 6
