"""The batch analysis job: aggregates to a cleaned table to report tables.

    python -m hazemill.plans.batch_report AGGREGATES OUTPUT
"""

from __future__ import annotations

import sys

from pyspark.sql import DataFrame, SparkSession

from hazemill.operators import (
    aqi_category_breakdown,
    aqi_category_share,
    aqi_timeseries,
    city_pollutant_matrix,
    clean,
    clean_report,
    pollutant_distribution,
    pollutant_summary,
    worst_stations,
    worst_stations_sql,
)
from hazemill.session import build_session
from hazemill.sources.tables import read_aggregates, register_views, write_aggregates


def report_tables(cleaned: DataFrame) -> dict[str, DataFrame]:
    """Every report over cleaned aggregates, by name."""
    return {
        "pollutant_summary": pollutant_summary(cleaned),
        "aqi_category_breakdown": aqi_category_breakdown(cleaned),
        "worst_stations": worst_stations(cleaned),
        "aqi_timeseries": aqi_timeseries(cleaned),
        "pollutant_distribution": pollutant_distribution(cleaned),
        "city_pollutant_matrix": city_pollutant_matrix(cleaned),
        "aqi_category_share": aqi_category_share(cleaned),
    }


def analyze(spark: SparkSession, source: str, target: str) -> dict[str, str]:
    """Clean ``source`` once, write it and every report under ``target``. Of a window that was
    published again only the newest version counts.

    The reports read the written table, each only its own columns, instead of
    repeating the deduplication.
    """
    raw = read_aggregates(spark, source, versions=True)
    register_views(spark, source, newest=True)
    write_aggregates(clean(raw).drop("published"), f"{target}/clean")
    cleaned = read_aggregates(spark, f"{target}/clean")
    tables = report_tables(cleaned)
    tables["clean_report"] = clean_report(raw, cleaned)
    tables["worst_stations_sql"] = worst_stations_sql(spark)
    for name, table in tables.items():
        table.write.mode("overwrite").parquet(f"{target}/{name}")
    return {name: f"{target}/{name}" for name in ["clean", *tables]}


def main(arguments: list[str]) -> int:
    if len(arguments) != 2:
        print("usage: batch_report AGGREGATES OUTPUT", file=sys.stderr)
        return 2
    spark = build_session("hazemill-report")
    for name, path in analyze(spark, *arguments).items():
        print(f"{name}: {path}")
    return 0


if __name__ == "__main__":
    raise SystemExit(main(sys.argv[1:]))
