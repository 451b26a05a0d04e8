"""Windowed streaming operators with event time and watermarks."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hazemill import domain
from hazemill.functions.times import interval, micros
from hazemill.operators.current import SERIES, sliding_figures, summarise_series
from hazemill.operators.quality import WINDOW_KEYS, dedup
from hazemill.operators.rollup import (
    STATION_PARAMETER,
    finish,
    reading_aggregates,
    tumbling_aggregate,
)
from hazemill.schemas import METADATA

DELAY = "1 minute"


def stream_tumbling(
    readings: DataFrame,
    size: str = domain.WINDOW_SIZE,
    delay: str = DELAY,
    event_time: bool = False,
) -> DataFrame:
    """Tumbling roll-up of a stream of (valid) readings.

    The same figures as ``tumbling_aggregate``, from one stateful aggregation. A
    window is complete once the watermark, ``delay`` behind the newest reading, has
    passed its end. ``event_time=True`` adds the column ``event_time`` that a further
    window needs.
    """
    groups = (
        readings.withWatermark("timestamp", delay)
        .groupBy(*STATION_PARAMETER, F.window("timestamp", size).alias("_window"))
        .agg(*reading_aggregates(), F.min(F.struct("timestamp", *METADATA)).alias("_first"))
    )
    if not event_time:
        return finish(groups)
    return finish(groups.withColumn("event_time", F.window_time("_window")), extra=["event_time"])


def stream_dedup(
    aggregates: DataFrame, keys: Sequence[str] = WINDOW_KEYS, delay: str = DELAY
) -> DataFrame:
    """Each version of a key once, for sources that deliver again.

    A window that is published again with late readings has more of them and passes as a
    version of its own, whichever came first; ``newest_versions`` reads the last one. Keys are
    remembered until the watermark is ``delay`` past them, so the state does not grow with
    the stream.
    """
    marked = aggregates.withWatermark("window_end", delay)
    return marked.dropDuplicatesWithinWatermark([*keys, "count"])


def _sliding(df: DataFrame, time: str, span: str, slide: str, shift: int) -> DataFrame:
    """Summaries over ``span`` up to each ``slide``, both ends included.

    Spark's windows leave out their end. One microsecond more makes an aggregate that
    ended exactly ``span`` ago count, as the rule is "not older than". ``shift`` is how
    many microseconds ``time`` lies before the window end.
    """
    length, step = micros(span), micros(slide)
    if length % step:
        raise ValueError("the span must be a multiple of the slide")
    offset = f"{(-shift) % step} microseconds"
    window: Column = F.window(time, f"{length + 1} microseconds", f"{step} microseconds", offset)
    figures = summarise_series(df, window.alias("_window"), *SERIES)
    as_of = F.col("_window.start") + interval(length + shift)
    figure_columns = [c for c in figures.columns if c not in ("_window", *SERIES)]
    return figures.select(as_of.alias("as_of"), *SERIES, *figure_columns)


def stream_sliding(
    aggregates: DataFrame,
    span: str = domain.ROLLING_SPAN,
    slide: str = "1 minute",
    delay: str = DELAY,
) -> DataFrame:
    """Rolling figures per city and pollutant, as of every ``slide``.

    Works on a stream of aggregates (update mode shows open windows, append mode only
    complete ones) and on a table, whose rows are added up per slide first.
    """
    if not aggregates.isStreaming:
        return sliding_figures(aggregates, span, slide)
    return _sliding(aggregates.withWatermark("window_end", delay), "window_end", span, slide, 0)


def stream_chain(
    readings: DataFrame,
    size: str = domain.WINDOW_SIZE,
    span: str = domain.ROLLING_SPAN,
    slide: str = "1 minute",
    delay: str = DELAY,
) -> DataFrame:
    """Tumbling windows of readings feeding sliding windows, in one streaming query.

    Append mode. The watermark set on the readings carries through both windows.
    """
    rolled = stream_tumbling(readings, size, delay, event_time=True)
    # event_time is the last microsecond of a window.
    return _sliding(rolled, "event_time", span, slide, 1)


def closed_before(readings: DataFrame, delay: str = DELAY) -> Column:
    """The watermark after all of ``readings``: windows ending by then are complete."""
    return readings.agg(F.max("timestamp")).scalar() - interval(micros(delay))


def flush_tail(
    readings: DataFrame, size: str = domain.WINDOW_SIZE, delay: str = DELAY
) -> DataFrame:
    """Roll-up of the windows a stopped stream has not completed.

    Together with what the stream emitted, this is every window of ``readings``, unless some
    came after their window was emitted: ``missing_windows`` finds those too.
    """
    watermark = closed_before(readings, delay)
    tail = readings.filter(F.col("timestamp") > watermark - interval(micros(size)))
    return tumbling_aggregate(tail, size).filter(F.col("window_end") > watermark)


def owed_days(readings: DataFrame, emitted: DataFrame, size: str = domain.WINDOW_SIZE) -> list[date]:
    """Days of window starts on which ``readings`` has more readings than ``emitted`` counts.

    A stream counts no reading that there is not, so equal numbers of a day mean that all of
    its windows are whole. The answer is as long as the history has days.
    """
    here = readings.select("value", F.window("timestamp", size).alias("_window"))
    here = here.groupBy(F.to_date("_window.start").alias("day")).agg(F.count("value").alias("n"))
    known = emitted.groupBy(*WINDOW_KEYS).agg(F.max("count").alias("_known"))
    known = known.groupBy(F.to_date("window_start").alias("day")).agg(F.sum("_known").alias("known"))
    differing = here.join(known, "day", "left").filter(F.col("n") > F.coalesce("known", F.lit(0)))
    return sorted(row["day"] for row in differing.select("day").collect())


def _of_days(readings: DataFrame, days: list[date], size: str) -> DataFrame:
    """Readings of windows that start on the days. Runs of days are plain bounds of time,
    which reach the scan; a column ``day`` that the readings are stored by does so too."""
    runs: list[list[date]] = []
    for day in days:
        if runs and (day - runs[-1][1]).days == 1:
            runs[-1][1] = day
        else:
            runs.append([day, day])
    at, length = F.col("timestamp"), interval(micros(size))
    kind = readings.schema["timestamp"].dataType
    within = F.lit(False)
    for first, last in runs:
        start, end = (F.lit(d.isoformat()).cast(kind) for d in (first, last + timedelta(days=1)))
        within = within | ((at >= start) & (at < end + length))
    kept = readings.filter(within)
    if "day" in readings.columns:
        more = -(-micros(size) // micros("1 day"))
        stored = sorted({d + timedelta(days=i) for d in days for i in range(more + 1)})
        kept = kept.filter(F.to_date("day").isin(stored))
    started = kept.select("*", F.window("timestamp", size).alias("_window"))
    return started.filter(F.to_date("_window.start").isin(days)).drop("_window")


def missing_windows(
    readings: DataFrame, emitted: DataFrame, size: str = domain.WINDOW_SIZE
) -> DataFrame:
    """What a stopped stream still owes: windows of ``readings`` that ``emitted`` lacks or
    has with fewer readings, in full, plus ``missed``, the number of those readings.

    These are the windows that were open at the end and those that got readings later than
    the watermark allows, which the stream drops. Read with ``newest_versions``, what was
    emitted and this are the roll-up of all ``readings``.

    Days are compared by their number of readings first, which reads times alone and moves
    one row per day and task; only the days that differ are rolled up (``owed_days``).
    """
    days = owed_days(readings, emitted, size)
    readings, emitted = _of_days(readings, days, size), emitted.filter(F.to_date("window_start").isin(days))
    known = emitted.groupBy(*WINDOW_KEYS).agg(F.max("count").alias("_known"))
    renamed = known.select("_known", *(F.col(k).alias(f"_{k}") for k in WINDOW_KEYS))
    same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in WINDOW_KEYS]
    whole = tumbling_aggregate(readings, size)
    met = whole.join(renamed, same, "left").withColumn(
        "missed", F.col("count") - F.coalesce("_known", F.lit(0))
    )
    return met.filter(F.col("missed") > 0).select(*whole.columns, "missed")


def newest_versions(aggregates: DataFrame) -> DataFrame:
    """One row per window: the one with the most readings (a repaired window has more)."""
    return dedup(aggregates)
