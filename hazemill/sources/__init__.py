"""Sources and sinks."""

from hazemill.sources.messages import from_messages, rejected_messages, to_messages
from hazemill.sources.payloads import (
    flatten_latest,
    flatten_locations,
    location_number,
    station_id,
)
from hazemill.sources.sinks import (
    KafkaSink,
    MessageSink,
    ParquetSink,
    RejectSink,
    Sink,
    SinkError,
    fan_out,
)
from hazemill.sources.tables import (
    read_aggregate_stream,
    read_aggregates,
    read_measurement_stream,
    read_measurements,
    read_messages,
    read_windows,
    register_views,
    write_aggregates,
)

__all__ = [
    "KafkaSink",
    "MessageSink",
    "ParquetSink",
    "RejectSink",
    "Sink",
    "SinkError",
    "fan_out",
    "flatten_latest",
    "flatten_locations",
    "from_messages",
    "location_number",
    "read_aggregate_stream",
    "read_aggregates",
    "read_measurement_stream",
    "read_measurements",
    "read_messages",
    "read_windows",
    "register_views",
    "rejected_messages",
    "station_id",
    "to_messages",
    "write_aggregates",
]
