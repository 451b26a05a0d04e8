"""The live board: every table of the dashboard, and the stream that feeds it.

    python -m hazemill.plans.board MESSAGES CHECKPOINT TABLES
"""

from __future__ import annotations

import sys
from collections.abc import Callable
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql.streaming import StreamingQuery

from hazemill import domain
from hazemill.operators import (
    aqi_category_share,
    aqi_map,
    aqi_timeseries,
    dedup,
    kpi_summary,
    latest_per_station,
    within_last,
)
from hazemill.operators.current import SERIES, summarise_series
from hazemill.schemas import AGGREGATE
from hazemill.session import build_session
from hazemill.sources.sinks import computed_once
from hazemill.sources.tables import read_aggregate_stream, read_aggregates, write_aggregates
from hazemill.streaming.run import start


def board_tables(
    aggregates: DataFrame,
    span: str | timedelta = domain.ROLLING_SPAN,
    as_of: datetime | Column | None = None,
) -> dict[str, DataFrame]:
    """The tables over the aggregates of the last ``span``."""
    live = within_last(aggregates, span, as_of)
    return {
        "kpi_summary": kpi_summary(live),
        "latest_per_station": latest_per_station(live),
        "aqi_map": aqi_map(live),
        "aqi_timeseries": aqi_timeseries(live),
        "aqi_category_share": aqi_category_share(live),
        "rolling_summary": summarise_series(live, *SERIES).orderBy(*SERIES),
    }


def watch(
    aggregates: DataFrame,
    checkpoint: str,
    show: Callable[[dict[str, DataFrame], int], None],
    *,
    span: str = domain.ROLLING_SPAN,
    every: str | None = "3 seconds",
) -> StreamingQuery:
    """Hand all tables of the board to ``show`` at every emission of a stream.

    What the tables need is kept beside the checkpoint: the newest version of each window of
    the last ``span``, whatever has come before. A batch adds its rows to what the batch
    before it left and writes that to the other one of two folders, so a repeated batch
    starts from the same rows, and what is kept does not grow with the stream. The tables are
    those of ``board_tables`` over all that has come in.
    """
    spark = aggregates.sparkSession
    slots = [f"{checkpoint.rstrip('/')}-board/slot={i}" for i in range(2)]

    def emit(batch: DataFrame, batch_id: int) -> None:
        before, now = slots[(batch_id + 1) % 2], slots[batch_id % 2]
        rows = batch.select(*AGGREGATE.fieldNames())
        if batch_id:
            rows = rows.unionByName(read_aggregates(spark, before, missing_ok=True))
        with computed_once(rows) as once:
            write_aggregates(within_last(dedup(once), span), now)
        show(board_tables(read_aggregates(spark, now), span), batch_id)

    return start(aggregates, checkpoint, batch=emit, every=every)


def write_tables(folder: str) -> Callable[[dict[str, DataFrame], int], None]:
    """Tables as Parquet under ``folder``, each replaced at every emission."""

    def write(tables: dict[str, DataFrame], batch_id: int) -> None:
        for name, table in tables.items():
            table.write.mode("overwrite").parquet(f"{folder}/{name}")

    return write


def main(arguments: list[str]) -> int:
    if len(arguments) != 3:
        print("usage: board MESSAGES CHECKPOINT TABLES", file=sys.stderr)
        return 2
    messages, checkpoint, tables = arguments
    stream = read_aggregate_stream(build_session("hazemill-board"), messages)
    watch(stream, checkpoint, write_tables(tables)).awaitTermination()
    return 0


if __name__ == "__main__":
    raise SystemExit(main(sys.argv[1:]))
