"""Structured Streaming operators."""

from hazemill.streaming.counters import StreamCounters
from hazemill.streaming.run import run_to_table, start
from hazemill.streaming.windows import (
    closed_before,
    flush_tail,
    missing_windows,
    newest_versions,
    owed_days,
    stream_chain,
    stream_dedup,
    stream_sliding,
    stream_tumbling,
)

__all__ = [
    "StreamCounters",
    "closed_before",
    "flush_tail",
    "missing_windows",
    "newest_versions",
    "owed_days",
    "run_to_table",
    "start",
    "stream_chain",
    "stream_dedup",
    "stream_sliding",
    "stream_tumbling",
]
