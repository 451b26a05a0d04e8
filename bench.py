"""Headline queries at one scale: prints a single JSON line.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

``collect_*`` starts from readings; ``report_*`` and ``now_*`` start from stored
aggregates, like the published figures. Readings and aggregates are written before the
clock starts. Every query is run in full (``noop`` sink) twice to warm up and then three
times; the median counts. Nothing is cached between runs.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from hazemill import build_session, operators as op, sources, streaming
from hazemill.plans import sensor_feed as feed
from hazemill.plans.collect import collect_windows

WARM_UPS, RUNS = 2, 3


def seconds(job) -> float:
    began = time.perf_counter()
    job()
    return time.perf_counter() - began


def drain(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> int:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    folder = tempfile.mkdtemp(prefix="hazemill-bench-")
    spark = build_session(
        "bench",
        spark_master=f"local[{cpus}]",
        spark_driver_memory="8g",
        spark_ui_enabled="false",
        spark_ui_showConsoleProgress="false",
        spark_sql_shuffle_partitions=cpus,
        spark_checkpoint_dir=folder,
    )
    spark.sparkContext.setLogLevel("ERROR")

    # One file per core, as a collector would leave many; the source table is one file.
    feed.readings(spark, sf_dir).repartition(int(cpus)).write.parquet(f"{folder}/readings")
    readings = spark.read.parquet(f"{folder}/readings")
    sources.write_aggregates(feed.instrument_feed(spark, sf_dir), f"{folder}/raw")
    raw = sources.read_aggregates(spark, f"{folder}/raw")
    sources.write_aggregates(op.clean(raw), f"{folder}/clean")
    clean = sources.read_aggregates(spark, f"{folder}/clean")
    n_readings, n_raw, n_clean = readings.count(), raw.count(), clean.count()
    raw.createOrReplaceTempView("aggregates")

    def stream() -> None:
        events = sources.read_measurement_stream(spark, f"{folder}/readings")
        windows = streaming.stream_tumbling(op.valid_readings(events), "1 hour", "1 minute")
        streaming.run_to_table(spark, windows, "bench-stream")

    jobs = {
        "collect_from_events": lambda: drain(collect_windows(feed.readings(spark, sf_dir), "1 hour")),
        "collect_validate": lambda: drain(op.validate_frame(readings, value="value")),
        "collect_windows_10s": lambda: drain(collect_windows(readings)),
        "collect_windows_1h": lambda: drain(collect_windows(readings, "1 hour")),
        "collect_stream_1h": stream,
        "report_clean": lambda: drain(op.clean(raw)),
        "report_worst_stations": lambda: drain(op.worst_stations(clean)),
        "report_worst_stations_sql": lambda: drain(op.worst_stations_sql(spark)),
        "report_pollutant_summary": lambda: drain(op.pollutant_summary(clean)),
        "report_aqi_category_breakdown": lambda: drain(op.aqi_category_breakdown(clean)),
        "report_city_pollutant_matrix": lambda: drain(op.city_pollutant_matrix(clean)),
        "report_pollutant_distribution": lambda: drain(op.pollutant_distribution(clean)),
        "report_aqi_timeseries": lambda: drain(op.aqi_timeseries(clean)),
        "now_latest_per_station": lambda: drain(op.latest_per_station(clean)),
        "now_kpi_summary": lambda: drain(op.kpi_summary(clean)),
        "now_recent_windows": lambda: drain(op.recent_windows(clean)),
        "now_rolling_summary": lambda: drain(op.rolling_summary(clean, "7 days")),
        "now_rolling_as_of": lambda: drain(op.rolling_as_of(clean, "3 days")),
    }
    taken = {}
    for name, job in jobs.items():
        for _ in range(WARM_UPS):
            job()
        taken[name] = round(statistics.median(seconds(job) for _ in range(RUNS)), 4)

    # The same from a tenth of the rows, where the smaller tables are at hand.
    smaller = os.path.join(os.path.dirname(sf_dir.rstrip("/")), "sf0.01")
    scaling = {}
    if os.path.isdir(smaller) and os.path.basename(sf_dir.rstrip("/")) != "sf0.01":
        feed.readings(spark, smaller).repartition(int(cpus)).write.parquet(f"{folder}/fewer")
        fewer = spark.read.parquet(f"{folder}/fewer")
        few = {
            "collect_from_events": lambda: drain(collect_windows(feed.readings(spark, smaller), "1 hour")),
            "collect_windows_1h": lambda: drain(collect_windows(fewer, "1 hour")),
            "collect_validate": lambda: drain(op.validate_frame(fewer, value="value")),
        }
        ratio = n_readings / fewer.count()
        for name, job in few.items():
            job()
            spent = statistics.median(seconds(job) for _ in range(RUNS))
            scaling[name] = {"sec_at_sf0.01": round(spent, 4), "rows_ratio": round(ratio, 1),
                             "sec_ratio": round(taken[name] / spent, 2)}

    inputs = {"collect": n_readings, "report": n_clean, "now": n_clean}
    on_raw = {"report_clean": n_raw, "report_worst_stations_sql": n_raw}
    rates = {
        name: round(on_raw.get(name, inputs[name.split("_")[0]]) / spent)
        for name, spent in taken.items()
    }
    print(
        json.dumps(
            {
                "metric": "total of headline queries",
                "value": round(sum(taken.values()), 3),
                "unit": "sec",
                "queries": taken,
                "sf": os.path.basename(sf_dir.rstrip("/")),
                "rows": {"readings": n_readings, "raw_aggregates": n_raw, "clean_aggregates": n_clean},
                "rows_per_sec": rates,
                "scaling": scaling,
                "cpus": int(cpus),
            }
        )
    )
    spark.stop()
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
