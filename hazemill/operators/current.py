"""The present state: latest rows, key figures, recent windows, rolling summaries."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hazemill import domain
from hazemill.functions.numeric import (
    SUMS,
    exact_mean_text,
    parts_text,
    round_half_up,
    total_text,
)
from hazemill.functions.times import interval, micros
from hazemill.operators.reports import by_parameter
from hazemill.operators.survivors import newest_rank, one_per_key

SENSOR = ["location_id", "location", "city", "country", "parameter"]
SERIES = ["city", "parameter"]


def latest_per_station(df: DataFrame) -> DataFrame:
    """The newest aggregate of each station and pollutant; of several with one end a fixed one.

    An aggregation, so each task passes on one number per sensor before the shuffle; the rows
    that belong to the winning numbers are met by a broadcast of these.
    """
    return one_per_key(df, SENSOR, newest_rank())


def aqi_map(df: DataFrame) -> DataFrame:
    """Current PM2.5 index of each station with its position."""
    shown = ["latitude", "longitude", "aqi", "aqi_category", "avg"]
    # Only what the map shows is carried through the aggregation and read from disk.
    pm = by_parameter(df).select(*SENSOR, "window_end", *shown)
    return latest_per_station(pm).select("location_id", "location", "city", *shown)


def kpi_summary(df: DataFrame, approximate: bool = False) -> DataFrame:
    """Active stations, aggregates, and the station with the worst current PM2.5 index.

    One pass: rows are reduced to one per station and pollutant, and the three figures
    come from those. A missing station id counts as one station. Of two rows with the
    same end the higher index counts; equal indexes of stations are decided by city,
    then station id. A station whose newest index is missing is not rated.
    ``approximate`` estimates the station count.
    """
    # Time and, below it, the index: the reduction then keeps fixed-width buffers and runs in
    # hash tables, where a struct would make it sort all rows. The index only decides between
    # equal times, a missing one ranks lowest, and no index can outweigh a time.
    tie = F.least(F.greatest(F.coalesce("aqi", F.lit(-1)) + 1, F.lit(0)), F.lit(1023))
    age = F.unix_micros(F.col("window_end").cast("timestamp")) * 1024 + tie
    newest = df.groupBy(*SENSOR).agg(
        F.max_by("aqi", age).alias("_aqi"), F.count(F.lit(1)).alias("_n")
    )
    rated = (F.col("parameter") == "pm25") & F.col("_aqi").isNotNull()
    rank = F.struct((-F.col("_aqi")).alias("low"), "city", "location_id")
    worst = F.min(F.when(rated, rank))
    # A struct is never NULL, so a NULL id is counted too.
    station = F.struct("location_id")
    active = F.approx_count_distinct(station) if approximate else F.countDistinct(station)
    figures = newest.agg(
        active.alias("active_stations"),
        F.coalesce(F.sum("_n"), F.lit(0)).alias("aggregates_in_window"),
        worst.alias("_worst"),
    )
    return figures.select(
        "active_stations",
        "aggregates_in_window",
        (-F.col("_worst.low")).alias("worst_pm25_aqi"),
        F.col("_worst.city").alias("worst_pm25_city"),
        F.col("_worst.location_id").alias("worst_pm25_location_id"),
    )


def recent_windows(df: DataFrame, batches: int = domain.RECENT_BATCHES) -> DataFrame:
    """All rows of the ``batches`` most recent windows.

    The list of window ends has at most ``batches`` rows, which is what makes the
    broadcast safe at any table size.
    """
    ends = df.select("window_end").distinct().orderBy(F.desc("window_end")).limit(batches)
    return df.join(F.broadcast(ends), "window_end", "left_semi").select(*df.columns)


def _as_of(df: DataFrame, as_of: datetime | Column | None) -> Column:
    if as_of is None:
        return df.agg(F.max("window_end")).scalar()
    return as_of if isinstance(as_of, Column) else F.lit(as_of)


def within_last(
    df: DataFrame,
    span: str | timedelta = domain.ROLLING_SPAN,
    as_of: datetime | Column | None = None,
) -> DataFrame:
    """Rows whose ``window_end`` lies within ``span`` before ``as_of``, ends included.

    ``as_of`` defaults to the newest window end. Rows without an end are left out.
    """
    now = _as_of(df, as_of)
    end = F.col("window_end")
    return df.filter((end >= now - interval(micros(span))) & (end <= now))


def rolling_summary(
    df: DataFrame,
    span: str | timedelta = domain.ROLLING_SPAN,
    as_of: datetime | Column | None = None,
) -> DataFrame:
    """Rolling mean, index and peak per city and pollutant, as of one instant."""
    return summarise_series(within_last(df, span, as_of), *SERIES).orderBy(*SERIES)


def summarise_series(df: DataFrame, *keys: Column | str) -> DataFrame:
    """The rolling figures of each group (batch or streaming)."""
    return df.groupBy(*keys).agg(
        round_half_up(exact_mean_text("avg"), 2).alias("rolling_mean"),
        round_half_up("avg(aqi)", 1).alias("rolling_aqi"),
        F.max("max").alias("peak"),
        F.count(F.lit(1)).alias("windows"),
    )


def _series_sums() -> list[Column]:
    """Partial results of the rolling figures, in fixed-width buffers."""
    return [
        *(F.expr(f"sum({part})").alias(c) for part, c in zip(parts_text("avg"), SUMS)),
        F.count("avg").alias("_means"),
        F.sum("aqi").alias("_index"),
        F.count("aqi").alias("_indexes"),
        F.max("max").alias("_peak"),
        F.count(F.lit(1)).alias("_rows"),
    ]


_SUMMED = [*SUMS, "_means", "_index", "_indexes", "_rows"]


def _series_figures() -> list[Column]:
    return [
        round_half_up(f"{total_text(SUMS)} / nullif(_means, 0)", 2).alias("rolling_mean"),
        round_half_up("_index / nullif(_indexes, 0)", 1).alias("rolling_aqi"),
        F.col("_peak").alias("peak"),
        F.col("_rows").alias("windows"),
    ]


def sliding_figures(df: DataFrame, span: str | timedelta, slide: str | timedelta) -> DataFrame:
    """The rolling figures of each city and pollutant as of every ``slide`` at which the
    ``span`` before it, ends included, has a row.

    Rows are added up per pane of one slide before the shuffle, those at the very end of a
    pane apart, since one span later they are seen a last time: what is shuffled does not
    depend on how many slides a span has. As in ``rolling_as_of`` an instant then sees the end
    of the block of one span before its own, and its own block up to itself; both are
    running totals.
    """
    length, step = micros(span), micros(slide)
    if length % step:
        raise ValueError("the span must be a multiple of the slide")
    at = F.unix_micros(F.col("window_end").cast("timestamp"))
    pane = at + F.pmod(-at, F.lit(step))
    panes = df.filter(F.col("window_end").isNotNull()).groupBy(
        *SERIES, pane.alias("_pane"), (at == pane).alias("_last")
    ).agg(*_series_sums())
    ends = panes.groupBy(*SERIES, "_pane").agg(F.max("_last").alias("_last"))
    after = F.lead("_pane").over(Window.partitionBy(*SERIES).orderBy("_pane"))
    seen_until = F.col("_pane") + length - F.when(F.col("_last"), 0).otherwise(step)
    until = F.least(F.coalesce(F.col("_after") - step, seen_until), seen_until)
    ticks = ends.withColumn("_after", after).select(*SERIES, F.explode(F.sequence("_pane", until, F.lit(step))).alias("_tick"))
    rows = panes.withColumn("_at", F.when(F.col("_last"), F.col("_pane")).otherwise(F.col("_pane") - 1))
    both = (
        rows.select(*SERIES, "_at", *_SUMMED, "_peak")
        .unionByName(ticks.withColumn("_at", F.col("_tick")).withColumn("_looks", F.lit(False)), True)
        .unionByName(ticks.withColumn("_at", F.col("_tick") - length).withColumn("_looks", F.lit(True)), True)
        .withColumn("_block", F.col("_at") - F.pmod("_at", F.lit(length)))
    )
    block = Window.partitionBy(*SERIES, "_block")
    asks = F.col("_tick").isNotNull()
    until_now = (Window.unboundedPreceding, Window.currentRow)
    forward = block.orderBy("_at", asks).rowsBetween(*until_now)
    backward = block.orderBy(F.desc("_at"), asks).rowsBetween(*until_now)

    def running(total: Callable[[str], Column], c: str) -> Column:
        return F.when(F.col("_looks"), total(c).over(backward)).otherwise(total(c).over(forward))

    halves = both.select(
        *SERIES, "_tick", *(running(F.sum, c).alias(c) for c in _SUMMED), running(F.max, "_peak").alias("_peak")
    ).filter(asks)
    seen = halves.groupBy(*SERIES, "_tick").agg(*(F.sum(c).alias(c) for c in _SUMMED), F.max("_peak").alias("_peak"))
    as_of = F.timestamp_micros("_tick").cast(df.schema["window_end"].dataType)
    return seen.select(as_of.alias("as_of"), *SERIES, *_series_figures())


def rolling_as_of(df: DataFrame, span: str | timedelta = domain.ROLLING_SPAN) -> DataFrame:
    """The rolling figures of a city and pollutant at each of its window ends.

    Rows that share city, pollutant and window end see the same figures, so they are
    added up first (before the shuffle, whatever the size of the group). Time is then cut
    into blocks of one span: what an instant sees is the end of the block before its own,
    from one span ago on, and its own block up to itself. Both are running totals, one
    backward and one forward, so the work is linear in the instants whatever the span, and
    the blocks of a hot city are spread over many tasks.
    """
    length = micros(span)
    instants = (
        df.filter(F.col("window_end").isNotNull())
        .groupBy(*SERIES, "window_end")
        .agg(*_series_sums())
    )
    summed = _SUMMED
    at = F.unix_micros(F.col("window_end").cast("timestamp"))
    # Every instant is there twice: as itself, and one span ago, where it only looks back.
    ends = F.array(
        F.struct(at.alias("at"), F.lit(False).alias("looks")),
        F.struct((at - F.lit(length)).alias("at"), F.lit(True).alias("looks")),
    )
    both = instants.withColumn("_end", F.explode(ends)).select(
        *SERIES,
        "window_end",
        F.col("_end.at").alias("_at"),
        F.col("_end.looks").alias("_looks"),
        F.expr(f"_end.at - pmod(_end.at, {length}L)").alias("_block"),
        *(F.when(~F.col("_end.looks"), F.col(c)).alias(c) for c in [*summed, "_peak"]),
    )
    block = Window.partitionBy(*SERIES, "_block")
    until_now = (Window.unboundedPreceding, Window.currentRow)
    forward = block.orderBy("_at").rowsBetween(*until_now)
    # From the end of the block; an instant that is exactly one span ago is still seen.
    backward = block.orderBy(F.desc("_at"), "_looks").rowsBetween(*until_now)

    def running(total: Callable[[str], Column], c: str) -> Column:
        return F.when(F.col("_looks"), total(c).over(backward)).otherwise(total(c).over(forward))

    halves = both.select(
        *SERIES,
        "window_end",
        *(running(F.sum, c).alias(c) for c in summed),
        running(F.max, "_peak").alias("_peak"),
    )
    seen = halves.groupBy(*SERIES, "window_end").agg(
        *(F.sum(c).alias(c) for c in summed), F.max("_peak").alias("_peak")
    )
    return seen.select(*SERIES, "window_end", *_series_figures())
