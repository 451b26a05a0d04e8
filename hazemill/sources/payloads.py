"""Station catalogue and latest readings from nested API payloads."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hazemill.functions.times import parse_ts
from hazemill.schemas import LATEST_PAYLOAD, LOCATIONS_PAYLOAD

ID_PREFIX = "oa-"


def station_id(number: Column) -> Column:
    """Station id of an API location number."""
    return F.concat(F.lit(ID_PREFIX), number.cast("string"))


def location_number(location_id: Column) -> Column:
    """API location number of a station id; NULL for an id without the prefix."""
    digits = F.substr(location_id, F.lit(len(ID_PREFIX) + 1))
    return F.when(location_id.startswith(ID_PREFIX), digits.try_cast("bigint"))


def _text(path: str) -> Column:
    return F.coalesce(F.col(path), F.lit(""))


def _real(path: str) -> Column:
    return F.coalesce(F.col(path), F.lit(0.0))


def flatten_locations(payloads: DataFrame, payload: str = "payload") -> DataFrame:
    """One station per entry of ``results``; absent fields are empty or 0."""
    parsed = F.from_json(F.col(payload), LOCATIONS_PAYLOAD)
    entries = payloads.select(F.explode(parsed["results"]).alias("r"))
    return entries.select(
        station_id(F.coalesce("r.id", F.lit(0))).alias("location_id"),
        _text("r.name").alias("location"),
        _text("r.locality").alias("city"),
        _text("r.country.code").alias("country"),
        _real("r.coordinates.latitude").alias("latitude"),
        _real("r.coordinates.longitude").alias("longitude"),
    )


def flatten_latest(
    payloads: DataFrame, location_id: str = "location_id", payload: str = "payload"
) -> DataFrame:
    """One reading per entry of ``results``, with the station id of its payload.

    A time that cannot be read becomes NULL.
    """
    parsed = F.from_json(F.col(payload), LATEST_PAYLOAD)
    entries = payloads.select(
        F.col(location_id).alias("location_id"), F.explode(parsed["results"]).alias("r")
    )
    return entries.select(
        "location_id",
        _text("r.parameter.name").alias("parameter"),
        _real("r.value").alias("value"),
        _text("r.parameter.units").alias("unit"),
        parse_ts("r.datetime.utc").alias("timestamp"),
    )
