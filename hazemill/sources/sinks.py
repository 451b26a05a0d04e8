"""Sinks of a streaming batch and the fan-out to several of them."""

from __future__ import annotations

import logging
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager
from typing import Protocol

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hazemill.sources.messages import to_messages
from hazemill.sources.tables import write_aggregates

log = logging.getLogger(__name__)

# More partitions than any batch has: coalescing to it merges none of them.
_ALL_PARTITIONS = 1_000_000


def _folder(aggregates: DataFrame, batch_id: int) -> str:
    """Where a batch goes: batches of another query (a new checkpoint numbers them from 0
    again) never share a folder with it."""
    query = aggregates.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
    return f"query_id={query or 'none'}/batch_id={batch_id}"


class Sink(Protocol):
    """Receives each batch of aggregates; publishing a batch again replaces it."""

    name: str

    def publish(self, aggregates: DataFrame, batch_id: int) -> None: ...


class ParquetSink:
    """One folder per query and batch under ``path``, read back as one table. Rows carry the
    time of their publication, by which ``read_windows`` tells versions of a window apart."""

    name = "parquet"

    def __init__(self, path: str):
        self.path = path

    def publish(self, aggregates: DataFrame, batch_id: int) -> None:
        versioned = aggregates.withColumn("published", F.current_timestamp())
        write_aggregates(versioned, f"{self.path}/{_folder(aggregates, batch_id)}")


class MessageSink:
    """Keyed JSON messages as files, one folder per query and batch."""

    name = "messages"

    def __init__(self, path: str, ordered: bool = False):
        self.path = path
        self.ordered = ordered

    def publish(self, aggregates: DataFrame, batch_id: int) -> None:
        messages = to_messages(aggregates, self.ordered)
        messages.write.mode("overwrite").json(f"{self.path}/{_folder(aggregates, batch_id)}")


class RejectSink:
    """Messages that hold no aggregate, as they came, one folder per query and batch."""

    name = "rejects"

    def __init__(self, path: str):
        self.path = path

    def publish(self, messages: DataFrame, batch_id: int) -> None:
        rows = messages.select(
            *(F.col(c).cast("string").alias(c) for c in ("key", "value")), F.current_timestamp().alias("rejected")
        )
        rows.write.mode("overwrite").parquet(f"{self.path}/{_folder(messages, batch_id)}")


class KafkaSink:
    """Keyed JSON messages to a topic; the key decides the topic's partition.

    A batch is sent in the order of station, window and pollutant, cut into ranges of rows, so
    that a station with a third of all windows is several tasks' work. Tasks run at the same
    time; the header ``order`` (microseconds of the window's start as decimal text of fixed
    width) lets a reader put a station's messages back in order, also repeated ones. Needs
    the Kafka connector on the class path. Delivery is at least once.
    """

    name = "kafka"

    def __init__(self, brokers: str, topic: str):
        self.brokers = brokers
        self.topic = topic

    def messages(self, aggregates: DataFrame) -> DataFrame:
        order = ["location_id", "window_start", "parameter"]
        ranged = aggregates.repartitionByRange(*order).sortWithinPartitions(*order)
        start = F.unix_micros(F.col("window_start").cast("timestamp"))
        token = F.lpad(F.coalesce(start, F.lit(0)).cast("string"), 20, "0").cast("binary")
        header = F.struct(F.lit("order").alias("key"), token.alias("value"))
        return to_messages(ranged.withColumn("headers", F.array(header)), keep=["headers"])

    def publish(self, aggregates: DataFrame, batch_id: int) -> None:
        (
            self.messages(aggregates)
            .write.format("kafka")
            .option("kafka.bootstrap.servers", self.brokers)
            .option("topic", self.topic)
            .option("includeHeaders", "true")
            .save()
        )


@contextmanager
def computed_once(batch: DataFrame) -> Iterator[DataFrame]:
    """A micro-batch that is computed, in full, before anything reads it.

    Its state is then saved even if a reader fails or looks at a few rows only.
    """
    # Coalescing drops the sort order of the plan, which Spark 4.1 fails to carry into a
    # cached micro-batch (its columns were renamed on the way).
    once = batch.coalesce(_ALL_PARTITIONS).persist()
    try:
        once.count()
        yield once
    finally:
        once.unpersist()


class SinkError(RuntimeError):
    """Some sinks did not take a batch."""


def fan_out(
    sinks: Sequence[Sink], on_failure: str = "raise"
) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function that hands each batch to every sink in turn.

    The batch is computed once. A sink that fails is logged and the others still get the
    batch; then the failure is raised, so that the stream stops before the batch counts as
    done and repeats it when it is started again. ``on_failure="log"`` goes on without.
    """
    if on_failure not in ("raise", "log"):
        raise ValueError(f"unknown treatment of failures: {on_failure!r}")

    def publish(batch: DataFrame, batch_id: int) -> None:
        failed: list[str] = []
        with computed_once(batch) as once:
            for sink in sinks:
                try:
                    sink.publish(once, batch_id)
                except Exception:
                    log.exception("sink %s failed on batch %d", sink.name, batch_id)
                    failed.append(sink.name)
        if failed and on_failure == "raise":
            raise SinkError(f"batch {batch_id} did not reach {', '.join(failed)}")

    return publish
