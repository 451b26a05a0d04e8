"""Aggregates as keyed JSON messages."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hazemill.schemas import AGGREGATE

# Six digits: the default prints milliseconds and would lose the rest.
_TIME_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"


def to_messages(aggregates: DataFrame, ordered: bool = False, keep: Sequence[str] = ()) -> DataFrame:
    """``key`` (station id) and ``value`` (one JSON object) per aggregate, then the columns in
    ``keep``.

    ``ordered=True`` sorts the messages by station and window for a sink that keeps
    the order of its input. The sort is by range, so a station with many windows is
    spread over several consecutive partitions.
    """
    rows = aggregates
    if ordered:
        rows = rows.repartitionByRange("location_id", "window_start").sortWithinPartitions(
            "location_id", "window_start", "parameter"
        )
    fields = [F.col(f.name).cast(f.dataType).alias(f.name) for f in AGGREGATE]
    options = {"timestampFormat": _TIME_FORMAT, "ignoreNullFields": "false"}
    return rows.select(
        F.col("location_id").alias("key"), F.to_json(F.struct(*fields), options).alias("value"), *keep
    )


def _decoded() -> Column:
    return F.from_json(F.col("value").cast("string"), AGGREGATE)


def from_messages(messages: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Aggregate columns of the messages, after the message's own columns in ``keep``.

    What holds no aggregate is left out; ``rejected_messages`` has it.
    """
    # Expanding an array of one parses each text once; a filter on a plain struct would
    # be pushed below the projection and parse it a second time. A malformed text decodes
    # to a struct of NULLs.
    return messages.select(*keep, F.inline(F.array(_decoded()))).filter(F.col("parameter").isNotNull())


def is_rejected() -> Column:
    """Whether a message holds no aggregate: no JSON object, or one without a pollutant."""
    return F.coalesce(_decoded()["parameter"].isNull(), F.lit(True))


def rejected_messages(messages: DataFrame) -> DataFrame:
    """The messages that ``from_messages`` leaves out, as they came."""
    return messages.filter(is_rejected())
