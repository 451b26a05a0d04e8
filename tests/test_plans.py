"""Physical plans: what is pushed down, pre-aggregated, shuffled and compiled."""

from __future__ import annotations

import contextlib
import io
import re

import pytest
from pyspark.sql import functions as F

from hazemill import functions as fn
from hazemill import operators as op
from hazemill import sources
from hazemill.plans import board, collect
from hazemill.plans.batch_report import analyze, main
from hazemill.session import shared_dir


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def files(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("plans")
    readings, windows = str(root / "readings"), str(root / "windows")
    start = 1704067200
    (
        spark.range(2000)
        .select(
            F.concat(F.lit("st-"), F.col("id") % 7).alias("location_id"),
            F.lit("L").alias("location"),
            F.lit("C").alias("city"),
            F.lit("X").alias("country"),
            F.element_at(F.array(F.lit("pm25"), F.lit("o3")), (F.col("id") % 2 + 1).cast("int")).alias("parameter"),
            (F.col("id") % 90).cast("double").alias("value"),
            F.lit("").alias("unit"),
            F.lit(1.0).alias("latitude"),
            F.lit(1.0).alias("longitude"),
            F.timestamp_seconds(F.lit(start) + F.col("id")).alias("timestamp"),
        )
        .write.parquet(readings)
    )
    sources.write_aggregates(op.tumbling_aggregate(spark.read.parquet(readings)), windows)
    return readings, windows


def test_readings_are_hash_aggregated_before_the_first_shuffle(spark, files):
    text = plan(op.tumbling_aggregate(op.valid_readings(spark.read.parquet(files[0]))))
    # Read from the scan upwards.
    steps = re.findall(r"(HashAggregate|SortAggregate|Exchange)", text)[::-1]
    assert steps[:2] == ["HashAggregate", "Exchange"]


def test_pollutant_filter_and_columns_reach_the_scan(spark, files):
    text = plan(op.worst_stations(sources.read_aggregates(spark, files[1])))
    assert "PushedFilters: [IsNotNull(parameter), EqualTo(parameter,pm25)]" in text
    assert "ReadSchema: struct<location:string,city:string,country:string,parameter:string,avg:double,max:double,aqi:int>" in text
    assert "TakeOrderedAndProject" in text


def test_distribution_counts_values_once(spark, files):
    df = op.pollutant_distribution(sources.read_aggregates(spark, files[1]))
    df.collect()
    final = plan(df).split("== Initial Plan ==")[0]
    assert final.count("FileScan") == 1


def test_key_figures_use_hash_tables_on_the_data(spark, files):
    text = plan(op.kpi_summary(sources.read_aggregates(spark, files[1])))
    assert re.findall(r"(HashAggregate|SortAggregate|Exchange)", text)[::-1][:2] == ["HashAggregate", "Exchange"]


def test_ranges_keep_rolling_groups_small(spark, files):
    text = plan(op.rolling_as_of(sources.read_aggregates(spark, files[1])))
    assert re.search(r"hashpartitioning\(city#\d+, parameter#\d+, _block#\d+", text)
    assert re.findall(r"(HashAggregate|Exchange)", text)[::-1][:2] == ["HashAggregate", "Exchange"]


def test_shards_need_no_shuffle(spark, files):
    stations = spark.read.parquet(files[0]).select("location_id")
    text = plan(op.assign_shards(stations, ["a", "b"]))
    assert "Exchange" not in text and "Join" not in text


def method_sizes(df) -> list[int]:
    with contextlib.redirect_stdout(io.StringIO()) as out:
        df.explain("codegen")
    return [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", out.getvalue())]


def test_expressions_stay_small_enough_to_be_compiled(spark, files):
    """The JVM does not compile methods above 8000 bytes of bytecode."""
    readings = spark.read.parquet(files[0])
    judged = op.validate_frame(readings, value="value")
    rated = judged.withColumn("aqi", fn.aqi("parameter", "value")).withColumn("c", fn.aqi_category("aqi"))
    for df in (judged, rated):
        sizes = method_sizes(df)
        assert sizes and max(sizes) < 8000


def test_no_python_in_any_plan(spark, files):
    readings = spark.read.parquet(files[0])
    windows = sources.read_aggregates(spark, files[1])
    for df in (
        op.tumbling_aggregate(op.valid_readings(readings)),
        op.clean(windows),
        op.assign_shards(readings, ["a", "b"]),
        op.pollutant_distribution(windows),
        sources.to_messages(windows),
    ):
        assert "Python" not in plan(df)


def test_batch_report(spark, files, tmp_path):
    written = analyze(spark, files[1], str(tmp_path))
    assert set(written) >= {"clean", "clean_report", "worst_stations", "worst_stations_sql", "city_pollutant_matrix"}
    assert spark.read.parquet(written["pollutant_summary"]).count() == 2
    report = spark.read.parquet(written["clean_report"]).first()
    assert report["clean_rows"] == spark.read.parquet(written["clean"]).count()
    assert [main([]), collect.main([]), board.main([])] == [2, 2, 2]


def test_shared_folder_comes_from_the_session(spark):
    assert shared_dir(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))
    assert shared_dir(spark, "x") != shared_dir(spark, "x")
