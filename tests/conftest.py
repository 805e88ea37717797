import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "6g")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def sales(spark):
    """Monthly sales rows from {segment: {month_no: value}}, month 0 being 2020-01."""

    def make(series):
        rows = [
            (segment, f"{2020 + m // 12}-{m % 12 + 1:02d}-01", value)
            for segment, points in series.items()
            for m, value in points.items()
        ]
        return spark.createDataFrame(
            rows, "segment string, timestamp string, target double"
        ).selectExpr("segment", "cast(timestamp as timestamp_ntz) timestamp", "target")

    return make
