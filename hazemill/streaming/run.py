"""Starting streaming queries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from hazemill.session import shared_dir


def start(
    stream: DataFrame,
    checkpoint: str,
    *,
    batch: Callable[[DataFrame, int], None] | None = None,
    path: str | None = None,
    mode: str = "append",
    every: str | None = None,
) -> StreamingQuery:
    """Run a stream into a ``foreachBatch`` function or a Parquet folder.

    ``every`` is the emission interval ("3 seconds"); without it the query handles
    what has arrived and stops. Offsets and state live in ``checkpoint``.
    """
    writer = stream.writeStream.outputMode(mode).option("checkpointLocation", checkpoint)
    if every:
        writer = writer.trigger(processingTime=every)
    else:
        writer = writer.trigger(availableNow=True)
    if batch is not None:
        return writer.foreachBatch(batch).start()
    return writer.format("parquet").option("path", path).start()


def run_to_table(spark: SparkSession, stream: DataFrame, label: str) -> DataFrame:
    """Drain a stream in append mode into a Parquet folder and return that table."""
    folder = shared_dir(spark, label)
    query = start(stream, f"{folder}/checkpoint", path=f"{folder}/rows")
    query.awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{folder}/rows")
