from __future__ import annotations

import os
import sys
from datetime import datetime, timezone

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from hazemill import build_session
from hazemill.schemas import AGGREGATE, MEASUREMENT


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        spark_master="local[8]",
        spark_driver_memory="6g",
        spark_ui_enabled="false",
        spark_ui_showConsoleProgress="false",
        spark_sql_shuffle_partitions="4",
        spark_checkpoint_dir=str(tmp_path_factory.mktemp("shared")),
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def at(text: str) -> datetime:
    return datetime.fromisoformat(text).replace(tzinfo=timezone.utc)


@pytest.fixture
def measurements(spark):
    """Build readings from dictionaries; what is left out gets a usual value."""

    def build(*rows: dict):
        usual = {
            "location_id": "st-1",
            "location": "Centre",
            "city": "Moscow",
            "country": "RU",
            "parameter": "pm25",
            "value": 10.0,
            "unit": "µg/m³",
            "latitude": 55.75,
            "longitude": 37.6,
            "timestamp": at("2024-01-01T00:00:01"),
        }
        return spark.createDataFrame([{**usual, **row} for row in rows], MEASUREMENT)

    return build


@pytest.fixture
def aggregates(spark):
    """Build aggregates from dictionaries; what is left out gets a usual value."""

    def build(*rows: dict):
        usual = {
            "location_id": "st-1",
            "location": "Centre",
            "city": "Moscow",
            "country": "RU",
            "parameter": "pm25",
            "unit": "µg/m³",
            "latitude": 55.75,
            "longitude": 37.6,
            "window_start": at("2024-01-01T00:00:00"),
            "window_end": at("2024-01-01T00:00:10"),
            "count": 5,
            "sum": 71.0,
            "avg": 14.2,
            "min": 10.0,
            "max": 20.0,
            "aqi": 55,
            "aqi_category": "Moderate",
        }
        return spark.createDataFrame([{**usual, **row} for row in rows], AGGREGATE)

    return build
