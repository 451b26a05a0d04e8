"""Operators: DataFrame in, DataFrame out. Nothing is run, but for a lookup that measures its
dimension and a matrix that has to find its columns."""

from hazemill.operators.current import (
    aqi_map,
    kpi_summary,
    latest_per_station,
    recent_windows,
    rolling_as_of,
    rolling_summary,
    within_last,
)
from hazemill.operators.distribution import pollutant_distribution
from hazemill.operators.joins import enrich_with_station, join_dimension, with_spec
from hazemill.operators.quality import (
    clean,
    clean_report,
    collector_counters,
    dedup,
    observe_quality,
    only_valid,
    quality_report,
    valid_readings,
    validate_frame,
)
from hazemill.operators.reports import (
    aqi_category_breakdown,
    aqi_category_share,
    aqi_timeseries,
    by_parameter,
    city_pollutant_matrix,
    distinct_values,
    pollutant_summary,
    preview,
    worst_stations,
    worst_stations_sql,
)
from hazemill.operators.rollup import tumbling_aggregate, with_aqi
from hazemill.operators.shards import (
    assign_shards,
    assigned_readings,
    assigned_to,
    shard_moves,
    shard_sizes,
)

__all__ = [
    "aqi_category_breakdown",
    "aqi_category_share",
    "aqi_map",
    "aqi_timeseries",
    "assign_shards",
    "assigned_readings",
    "assigned_to",
    "by_parameter",
    "city_pollutant_matrix",
    "clean",
    "clean_report",
    "collector_counters",
    "dedup",
    "distinct_values",
    "enrich_with_station",
    "join_dimension",
    "kpi_summary",
    "latest_per_station",
    "observe_quality",
    "only_valid",
    "pollutant_distribution",
    "pollutant_summary",
    "preview",
    "quality_report",
    "recent_windows",
    "rolling_as_of",
    "rolling_summary",
    "shard_moves",
    "shard_sizes",
    "tumbling_aggregate",
    "valid_readings",
    "validate_frame",
    "with_aqi",
    "with_spec",
    "within_last",
    "worst_stations",
    "worst_stations_sql",
]
