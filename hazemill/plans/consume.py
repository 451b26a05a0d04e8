"""The consumer job: messages to aggregates to sinks, what cannot be read to a folder of rejects.

    python -m hazemill.plans.consume MESSAGES WINDOWS REJECTS CHECKPOINT
"""

from __future__ import annotations

import logging
import sys
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from hazemill.session import build_session
from hazemill.sources.messages import from_messages, is_rejected, rejected_messages
from hazemill.sources.sinks import ParquetSink, RejectSink, Sink, computed_once, fan_out
from hazemill.sources.tables import read_messages
from hazemill.streaming.counters import StreamCounters
from hazemill.streaming.run import start

log = logging.getLogger(__name__)


def consume(
    messages: DataFrame,
    sinks: Sequence[Sink],
    rejects: RejectSink,
    checkpoint: str,
    *,
    every: str | None = None,
) -> StreamingQuery:
    """Publish the aggregates of a stream of messages, and keep every message that has none.

    Both parts of a micro-batch are published before it counts as done, each into a folder of
    its own that a repeated batch replaces: every message that came in is one aggregate or one
    reject, once. The counters ``messages_total`` and ``rejected_total`` are observed in
    the pass that decodes.
    """
    counted = messages.observe(
        "messages",
        F.count(F.lit(1)).alias("messages_total"),
        F.count(F.when(is_rejected(), 1)).alias("rejected_total"),
    )
    publish = fan_out(sinks)

    def both(batch: DataFrame, batch_id: int) -> None:
        with computed_once(batch) as once:
            rejects.publish(rejected_messages(once), batch_id)
            publish(from_messages(once), batch_id)

    return start(counted, checkpoint, batch=both, every=every)


def main(arguments: list[str]) -> int:
    if len(arguments) != 4:
        print("usage: consume MESSAGES WINDOWS REJECTS CHECKPOINT", file=sys.stderr)
        return 2
    messages, windows, rejects, checkpoint = arguments
    spark, counters = build_session("hazemill-consume"), StreamCounters("messages")
    spark.streams.addListener(counters)
    sinks = [ParquetSink(windows)]
    query = consume(read_messages(spark, messages), sinks, RejectSink(rejects), checkpoint, every="3 seconds")
    try:
        query.awaitTermination()
    finally:
        log.info("messages %s", counters.totals(query))
    return 0


if __name__ == "__main__":
    raise SystemExit(main(sys.argv[1:]))
