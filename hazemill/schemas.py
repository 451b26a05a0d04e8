"""Explicit schemas. Nothing in this package infers a schema from data."""

from __future__ import annotations

from pyspark.sql import types as T


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields])


_TEXT, _REAL, _TIME = T.StringType(), T.DoubleType(), T.TimestampType()

STATION = _struct(
    ("location_id", _TEXT),
    ("location", _TEXT),
    ("city", _TEXT),
    ("country", _TEXT),
    ("latitude", _REAL),
    ("longitude", _REAL),
)

MEASUREMENT = _struct(
    ("location_id", _TEXT),
    ("location", _TEXT),
    ("city", _TEXT),
    ("country", _TEXT),
    ("parameter", _TEXT),
    ("value", _REAL),
    ("unit", _TEXT),
    ("latitude", _REAL),
    ("longitude", _REAL),
    ("timestamp", _TIME),
)

AGGREGATE = _struct(
    ("location_id", _TEXT),
    ("location", _TEXT),
    ("city", _TEXT),
    ("country", _TEXT),
    ("parameter", _TEXT),
    ("unit", _TEXT),
    ("latitude", _REAL),
    ("longitude", _REAL),
    ("window_start", _TIME),
    ("window_end", _TIME),
    ("count", T.LongType()),
    ("sum", _REAL),
    ("avg", _REAL),
    ("min", _REAL),
    ("max", _REAL),
    ("aqi", T.IntegerType()),
    ("aqi_category", _TEXT),
)

# When a sink published a window; of versions with equally many readings the last one counts.
PUBLISHED = T.StructField("published", _TIME)
VERSIONED = T.StructType([*AGGREGATE.fields, PUBLISHED])

# What describes a station or a sensor rather than being measured.
METADATA = ["location", "city", "country", "unit", "latitude", "longitude"]

LOCATIONS_PAYLOAD = _struct(
    (
        "results",
        T.ArrayType(
            _struct(
                ("id", T.LongType()),
                ("name", _TEXT),
                ("country", _struct(("code", _TEXT))),
                ("locality", _TEXT),
                ("coordinates", _struct(("latitude", _REAL), ("longitude", _REAL))),
            )
        ),
    )
)

LATEST_PAYLOAD = _struct(
    (
        "results",
        T.ArrayType(
            _struct(
                ("parameter", _struct(("name", _TEXT), ("units", _TEXT))),
                ("value", _REAL),
                ("datetime", _struct(("utc", _TEXT))),
            )
        ),
    )
)
