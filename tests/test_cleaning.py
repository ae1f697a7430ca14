from datetime import datetime

import pytest
from conftest import in_order
from pyspark.sql import functions as F

from meterframe.operators import cleaning, quality


@pytest.fixture
def texts(spark):
    def build(*values):
        return spark.createDataFrame([(v,) for v in values], "timestamp string")

    return build


def test_day_first_but_iso_stays(texts):
    df = cleaning.timestamp_to_datetime(
        texts("02.04.2017 13:00:00", "02/04/2017 13:00", "2017-04-02 13:00:00", "2017-04-02T13:00:00+03:00", None)
    )
    assert df.schema["timestamp"].dataType.typeName() == "timestamp_ntz"
    assert [r[0] for r in df.collect()] == [datetime(2017, 4, 2, 13)] * 4 + [None]


def test_unreadable_time(texts):
    df = texts("yesterday", "02.04.2017")
    assert cleaning.unparsed_times(df) == 1
    assert cleaning.timestamp_to_datetime(df, strict=False).where("timestamp is null").count() == 1
    with pytest.raises(Exception, match="unreadable time"):
        cleaning.timestamp_to_datetime(df).collect()


@pytest.fixture
def readings(spark):
    rows = [
        # the doubled hour at the end of October: added up, first value that is there
        ("c", "m", "2018-10-28 03:00:00", 1.0, None, None, 1),
        ("c", "m", "2018-10-28 03:00:00", 2.0, None, "T2", 2),
        # the same on another day: first row wins, nulls and all
        ("c", "m", "2018-10-24 03:00:00", 5.0, 1.0, None, 3),
        ("c", "m", "2018-10-24 03:00:00", 7.0, 2.0, "T1", 4),
        ("c", "m", "2018-10-31 03:00:00", 9.0, 1.0, "T1", 5),
        # another meter of the customer
        ("c", "n", "2018-10-24 03:00:00", 4.0, 0.0, "T1", 6),
    ]
    return spark.createDataFrame(
        rows,
        "customer_id string, object_id string, t string, energy_import_kwh double, "
        "energy_export_kwh double, tariff_code string, nr int",
    ).selectExpr("* except (t)", "cast(t as timestamp_ntz) AS timestamp")


def test_duplicates_of_meters(readings):
    assert quality.check_duplicates(readings, "object_id") == 2
    out = cleaning.handle_duplicates(readings, "smart_meter", ties=["nr"])
    assert out.columns == readings.columns
    assert in_order(out, "object_id", "energy_import_kwh", "energy_export_kwh", "tariff_code", "nr") == [
        ("m", 5.0, 1.0, None, 3),
        ("m", 3.0, 0.0, "T2", 1),
        ("m", 9.0, 1.0, "T1", 5),
        ("n", 4.0, 0.0, "T1", 6),
    ]
    assert quality.check_duplicates(out, "object_id") == 0


def test_duplicates_of_customers(readings):
    out = cleaning.handle_duplicates(readings, "smart_meter", key="customer_id", ties=["nr"])
    assert out.count() == 3  # the two meters fall together on the 24th


def test_energy_is_kept_on_merged_days(readings):
    merged = readings.where(cleaning.clock_change_days())
    out = cleaning.handle_duplicates(merged, "smart_meter", ties=["nr"])
    assert out.agg(F.sum("energy_import_kwh")).first()[0] == 3.0


def test_merge_sum_of_nulls_is_zero(readings):
    out = cleaning.merge_sum(
        readings.where(cleaning.clock_change_days()),
        ["object_id", "timestamp"],
        ["energy_import_kwh", "energy_export_kwh"],
        ["nr"],
    ).first()
    assert (out["energy_import_kwh"], out["energy_export_kwh"], out["tariff_code"]) == (3.0, 0.0, "T2")


def test_one_group_of_many_rows_is_reduced_before_the_shuffle(readings):
    plan = cleaning.handle_duplicates(readings, "smart_meter", ties=["nr"])
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "partial_min_by" in text and "partial_sum" in text
    assert "Window" not in text


def test_other_dataset_type(readings):
    with pytest.raises(ValueError):
        cleaning.handle_duplicates(readings, "prices")


def test_ingestion_time(readings):
    out = cleaning.add_ingestion_time(readings, "smart_meter_backtest")
    assert out.where("ingested_at <> timestamp").count() == 0
    with pytest.raises(ValueError):
        cleaning.add_ingestion_time(readings, "weather")
    with pytest.raises(ValueError):
        cleaning.add_ingestion_time(readings, "live")


def test_warmup(panel):
    df = panel([(m, h, float(h)) for m in ("a", "b") for h in range(4)] + [("c", 0, 1.0), (None, 0, 1.0)])
    assert in_order(cleaning.drop_warmup(df, 2), "object_id", "energy_kwh") == [
        ("a", 2.0), ("a", 3.0), ("b", 2.0), ("b", 3.0),
    ]
    assert cleaning.remove_warmup_and_validate(df, 2).count() == 4


def test_warmup_with_a_null_left(panel):
    with pytest.raises(ValueError, match="energy_kwh"):
        cleaning.remove_warmup_and_validate(panel([("a", 0, 1.0), ("a", 1, 2.0), ("a", 2, None)]), 1)


def test_nan_becomes_null(spark):
    df = cleaning.nan_to_null(spark.createDataFrame([(float("nan"), 1), (2.0, 2)], "x double, i int"))
    assert [r["x"] for r in df.orderBy("i").collect()] == [None, 2.0]


def test_continuity(panel):
    df = panel([("a", 0, 1.0), ("a", 1, 1.0), ("a", 3, 1.0), ("b", 5, 1.0), ("b", 6, 1.0)])
    found = {r["object_id"]: (r["ok"], r["gap"], r["time_reversal"]) for r in quality.time_continuity(df).collect()}
    assert found == {"a": (2, 1, 0), "b": (2, 0, 0)}
    with pytest.raises(ValueError, match="1 series"):
        quality.check_time_continuity(df)
    assert quality.check_time_continuity(df, expected_step_hours=2).count() == 2


def test_rules_of_a_table(spark):
    good = spark.createDataFrame([(1, 56.9, 24.1)], "region_id int, center_latitude double, center_longitude double")
    assert quality.validate(good, "region") is good
    bad = spark.createDataFrame(
        [(1, 91.0, 24.1), (None, 0.0, -1.0)], "region_id int, center_latitude double, center_longitude double"
    )
    with pytest.raises(ValueError) as error:
        quality.validate(bad, "region")
    for part in ("region_id not null: 1", "center_latitude <= 90: 1", "center_longitude >= 0: 1"):
        assert part in str(error.value)
    with pytest.raises(ValueError, match="center_longitude: missing"):
        quality.validate(good.drop("center_longitude"), "region")
    with pytest.raises(ValueError, match="region_id: bigint is not int"):
        quality.validate(good.withColumn("region_id", F.col("region_id").cast("bigint")), "region")


def test_optional_column(readings):
    ready = cleaning.add_ingestion_time(readings, "smart_meter_backtest").withColumn(
        "metering_point_id", F.lit(1).cast("bigint")
    )
    ready = ready.na.fill(0.0, ["energy_export_kwh"])
    assert quality.validate(ready.drop("tariff_code"), "smart_meter") is not None


def test_orphans(spark):
    regions = spark.createDataFrame([(1, 0.0, 0.0)], "region_id int, center_latitude double, center_longitude double")
    metadata = spark.createDataFrame([("m", 1), ("n", 2), ("o", None)], "object_id string, region_id int")
    readings = spark.createDataFrame([("m",), ("x",), ("x",)], "object_id string")
    found = {
        r["foreign_key"]: (r["missing_keys"], r["orphan_rows"])
        for r in quality.fk_violations(
            {"region": regions, "customer_metadata": metadata, "smart_meter": readings}
        ).collect()
    }
    assert found == {
        "customer_metadata.region_id -> region": (1, 1),
        "smart_meter.object_id -> customer_metadata": (1, 2),
    }
