"""Tumbling-window roll-up of readings, shared by batch and streaming."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hazemill import domain
from hazemill.functions.air import aqi, aqi_category
from hazemill.functions.numeric import SUMS, parts_text, round_window, total_text
from hazemill.schemas import AGGREGATE, METADATA

STATION_PARAMETER = ["location_id", "parameter"]


def reading_aggregates() -> list[Column]:
    """Partial results of a group of readings, all in fixed-width buffers."""
    return [
        F.count("value").alias("count"),
        F.min("value").alias("min"),
        F.max("value").alias("max"),
        *(F.expr(f"sum({part})").alias(name) for part, name in zip(parts_text("value"), SUMS)),
    ]


def finish(groups: DataFrame, window: str = "_window", extra: Sequence[str] = ()) -> DataFrame:
    """The 17 aggregate columns from partial results and the struct ``_first``.

    The index is taken from the unrounded mean; sum and mean are then rounded, minimum
    and maximum are not.
    """
    total = total_text(SUMS)
    means = groups.withColumns(
        {"_total": F.expr(total), "_mean": F.expr(f"{total} / nullif(count, 0)")}
    ).withColumn("aqi", aqi("parameter", "_mean"))
    computed = {
        **{c: F.col(f"_first.{c}") for c in METADATA},
        "window_start": F.col(f"{window}.start"),
        "window_end": F.col(f"{window}.end"),
        "sum": round_window("_total"),
        "avg": round_window("_mean"),
        "aqi_category": aqi_category("aqi"),
    }
    return means.select(
        *(computed[c].alias(c) if c in computed else c for c in AGGREGATE.fieldNames()), *extra
    )


def tumbling_aggregate(
    readings: DataFrame, size: str = domain.WINDOW_SIZE, keys: Sequence[str] = STATION_PARAMETER
) -> DataFrame:
    """Per station, pollutant and window: count, sum, mean, extremes, index, category.

    Windows are event-time windows aligned to the epoch. The describing columns come
    from the earliest reading of the group; among readings of the same instant, from
    the smallest description.

    Two steps. The first groups by the description as well, so that every aggregation
    buffer is fixed-width and Spark aggregates in hash tables before the shuffle: a
    station with a third of all readings leaves each task as a few rows. The second
    step merges the few descriptions of a group; a single ``min_by`` over strings
    would sort all raw readings instead and takes twice as long.
    """
    described = readings.groupBy(
        *keys, F.window("timestamp", size).alias("_window"), *METADATA
    ).agg(*reading_aggregates(), F.min("timestamp").alias("_since"))
    merged = described.groupBy(*keys, "_window").agg(
        F.sum("count").alias("count"),
        F.min("min").alias("min"),
        F.max("max").alias("max"),
        *(F.sum(name).alias(name) for name in SUMS),
        F.min(F.struct("_since", *METADATA)).alias("_first"),
    )
    return finish(merged, extra=[k for k in keys if k not in AGGREGATE.fieldNames()])


def with_aqi(aggregates: DataFrame, extra: Sequence[str] = ()) -> DataFrame:
    """Complete aggregates written without index and category from their stored mean; other
    columns stay if they are named in ``extra``."""
    known = set(aggregates.columns)
    index = aqi("parameter", "avg")
    if "aqi" in known:
        index = F.coalesce("aqi", index)
    out = aggregates.withColumn("aqi", index)
    category = aqi_category("aqi")
    if "aqi_category" in known:
        category = F.coalesce("aqi_category", category)
    return out.withColumn("aqi_category", category).select(*AGGREGATE.fieldNames(), *extra)
