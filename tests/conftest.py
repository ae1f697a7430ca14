import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from meterframe.session import get_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = get_session(
        "tests",
        "local[4]",
        4,
        **{
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "4g",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def panel(spark):
    """Build a panel from (meter, hour number, value) rows."""

    def build(rows, value="energy_kwh"):
        df = spark.createDataFrame(rows, f"object_id string, h int, {value} double")
        return df.selectExpr(
            "object_id",
            "timestamp_ntz'2020-01-01 00:00:00' + make_dt_interval(0, h) AS timestamp",
            value,
        )

    return build


def in_order(df, *columns):
    return [tuple(r) for r in df.orderBy("object_id", "timestamp").select(*columns).collect()]
