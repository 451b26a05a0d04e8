"""The collector job: readings to validated windows to sinks.

    python -m hazemill.plans.collect READINGS WINDOWS MESSAGES CHECKPOINT
"""

from __future__ import annotations

import logging
import signal
import sys
import time
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from hazemill import domain
from hazemill.operators.quality import observe_quality, only_valid, valid_readings, validate_frame
from hazemill.operators.rollup import tumbling_aggregate
from hazemill.session import build_session, shared_dir
from hazemill.sources.sinks import MessageSink, ParquetSink, Sink, fan_out
from hazemill.sources.tables import (
    read_aggregates,
    read_measurement_stream,
    read_measurements,
)
from hazemill.streaming.counters import StreamCounters
from hazemill.streaming.run import start
from hazemill.streaming.windows import DELAY, missing_windows, stream_tumbling

log = logging.getLogger(__name__)


def collect_windows(readings: DataFrame, size: str = domain.WINDOW_SIZE) -> DataFrame:
    """Aggregates of the valid readings of a table."""
    return tumbling_aggregate(valid_readings(readings), size)


def collect_stream(
    readings: DataFrame,
    sinks: Sequence[Sink],
    checkpoint: str,
    *,
    size: str = domain.WINDOW_SIZE,
    delay: str = DELAY,
    every: str | None = None,
) -> StreamingQuery:
    """Validate a stream, count what is rejected, roll it up and publish each batch."""
    checked = observe_quality(validate_frame(readings, value="value"))
    windows = stream_tumbling(only_valid(checked), size, delay)
    return start(windows, checkpoint, batch=fan_out(sinks), every=every)


def collect_rest(
    readings: DataFrame,
    emitted: DataFrame,
    sinks: Sequence[Sink],
    *,
    size: str = domain.WINDOW_SIZE,
) -> dict[str, int]:
    """Publish what a stopped stream still owes: open windows, and whole those that late
    readings belong to. Says how many windows and readings that was.

    The rows are stored before anything is published, since ``emitted`` may well be what a
    sink has written.
    """
    owed = missing_windows(valid_readings(readings), emitted, size)
    spark = readings.sparkSession
    folder = shared_dir(spark, "owed")
    owed.write.parquet(folder)
    stored = spark.read.schema(owed.schema).parquet(folder)
    fan_out(sinks)(stored.drop("missed"), time.time_ns())
    totals = stored.agg(
        F.count(F.lit(1)).alias("windows"), F.coalesce(F.sum("missed"), F.lit(0)).alias("readings")
    )
    return totals.first().asDict()


def _stopped(*_: object) -> None:
    raise KeyboardInterrupt


def main(arguments: list[str]) -> int:
    if len(arguments) != 4:
        print("usage: collect READINGS WINDOWS MESSAGES CHECKPOINT", file=sys.stderr)
        return 2
    readings, windows, messages, checkpoint = arguments
    spark, counters = build_session("hazemill-collect"), StreamCounters()
    spark.streams.addListener(counters)
    signal.signal(signal.SIGTERM, _stopped)
    sinks = [ParquetSink(windows), MessageSink(messages)]
    stream = read_measurement_stream(spark, readings)
    query = collect_stream(stream, sinks, checkpoint, every=domain.WINDOW_SIZE)
    try:
        query.awaitTermination()
    except KeyboardInterrupt:
        query.stop()
    # A stream that was stopped before its first batch has published nothing yet.
    emitted = read_aggregates(spark, windows, missing_ok=True)
    rest = collect_rest(read_measurements(spark, readings), emitted, sinks)
    log.info("stream %s, published at the end %s", counters.totals(query), rest)
    return 0


if __name__ == "__main__":
    raise SystemExit(main(sys.argv[1:]))
