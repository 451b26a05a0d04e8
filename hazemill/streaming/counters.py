"""Counters of running streams."""

from __future__ import annotations

from collections import Counter

from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener


class StreamCounters(StreamingQueryListener):
    """Adds up, per query, what ``observe_quality`` attaches, and ``late_rows``.

    Register it with ``spark.streams.addListener``. Late rows are the partial sums that the
    state dropped as older than the watermark, so one may stand for several readings;
    ``missing_windows`` counts the readings themselves.
    """

    def __init__(self, name: str = "quality"):
        self.name = name
        self._totals: dict[str, Counter] = {}

    def onQueryStarted(self, event) -> None:  # noqa: N802
        self._totals.setdefault(str(event.id), Counter())

    def onQueryProgress(self, event) -> None:  # noqa: N802
        progress = event.progress
        totals = self._totals.setdefault(str(progress.id), Counter())
        observed = progress.observedMetrics.get(self.name)
        if observed is not None:
            totals.update(observed.asDict())
        late = sum(s.numRowsDroppedByWatermark for s in progress.stateOperators)
        totals.update(late_rows=late)

    def onQueryIdle(self, event) -> None:  # noqa: N802
        pass

    def onQueryTerminated(self, event) -> None:  # noqa: N802
        pass

    def totals(self, query: StreamingQuery) -> dict[str, int]:
        return dict(self._totals.get(str(query.id), {}))
