from __future__ import annotations

import json
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from hazemill import sources
from hazemill.operators import worst_stations_sql
from hazemill.schemas import AGGREGATE, STATION
from tests.conftest import at


def two(aggregates):
    return aggregates(
        {},
        {"location_id": "st-2", "parameter": "o3", "avg": 60.0, "aqi": 30, "aqi_category": "Good",
         "window_start": at("2024-01-01T00:00:00") + timedelta(microseconds=123456)},
    )


def test_parquet_round_trip(spark, aggregates, tmp_path):
    path = str(tmp_path / "windows")
    df = two(aggregates)
    sources.write_aggregates(df, path)
    sources.write_aggregates(df, path)
    assert sources.read_aggregates(spark, path).count() == 2
    sources.write_aggregates(df, path, mode="append")
    back = sources.read_aggregates(spark, path)
    assert back.count() == 4
    assert len(back.columns) == 17
    assert sorted(map(tuple, back.distinct().collect())) == sorted(map(tuple, df.collect()))


def test_partitioned_layout_reads_back_the_same(spark, aggregates, tmp_path):
    path = str(tmp_path / "windows")
    sources.write_aggregates(two(aggregates), path, partition_by=["parameter"])
    back = sources.read_aggregates(spark, path)
    assert back.columns == AGGREGATE.fieldNames()
    pm = back.filter("parameter = 'pm25'")
    assert pm.count() == 1
    assert "PartitionFilters: [isnotnull(parameter" in pm._jdf.queryExecution().executedPlan().toString()


def test_files_without_index_are_completed(spark, aggregates, tmp_path):
    path = str(tmp_path / "old")
    aggregates({"avg": 20.0}).drop("aqi", "aqi_category").write.parquet(path)
    assert sources.read_aggregates(spark, path).first()["aqi"] is None
    done = sources.read_aggregates(spark, path, complete=True).first()
    assert (done["aqi"], done["aqi_category"]) == (68, "Moderate")


def test_views(spark, aggregates, tmp_path):
    path = str(tmp_path / "windows")
    sources.write_aggregates(two(aggregates), path)
    sources.register_views(spark, path, "from_file")
    assert worst_stations_sql(spark, "from_file").count() == 1


def test_messages_round_trip(aggregates):
    df = two(aggregates)
    for ordered in (False, True):
        messages = sources.to_messages(df, ordered)
        assert messages.columns == ["key", "value"]
        assert sorted(map(tuple, sources.from_messages(messages).collect())) == sorted(map(tuple, df.collect()))
    row = next(r for r in messages.collect() if r["key"] == "st-2")
    payload = json.loads(row["value"])
    assert list(payload) == AGGREGATE.fieldNames()
    assert payload["window_start"] == "2024-01-01T00:00:00.123456Z"


def test_ordered_messages_follow_the_windows(aggregates):
    start = at("2024-01-01T00:00:00")
    df = aggregates(*({"location_id": f"st-{i % 3}", "window_start": start + timedelta(seconds=(i * 7) % 50)} for i in range(50)))
    rows = [json.loads(r["value"]) for r in sources.to_messages(df.repartition(5), ordered=True).collect()]
    keys = [(r["location_id"], r["window_start"]) for r in rows]
    assert keys == sorted(keys)


def test_other_text_is_not_a_message(spark):
    df = spark.createDataFrame([("not json",), ("{}",), (None,)], "value string")
    assert sources.from_messages(df).count() == 0
    assert sources.rejected_messages(df).count() == 3


def test_messages_keep_their_key(aggregates):
    messages = sources.to_messages(two(aggregates)).withColumn("key", F.concat(F.lit("k-"), "key"))
    kept = sources.from_messages(messages, keep=["key"])
    assert sorted(r["key"] for r in kept.collect()) == ["k-st-1", "k-st-2"]
    assert sources.rejected_messages(messages).isEmpty()


def test_locations_payload(spark):
    entry = {"id": 155, "name": "Châtelet", "country": {"code": "FR"}, "locality": "Paris",
             "coordinates": {"latitude": 48.8, "longitude": 2.3}}
    payloads = [json.dumps({"results": [entry, {"id": 7}]}), '{"results": []}', "{}", "oops"]
    out = sources.flatten_locations(spark.createDataFrame([(p,) for p in payloads], "payload string"))
    assert out.columns == STATION.fieldNames()
    assert [tuple(r) for r in out.collect()] == [
        ("oa-155", "Châtelet", "Paris", "FR", 48.8, 2.3),
        ("oa-7", "", "", "", 0.0, 0.0),
    ]


def test_latest_payload(spark):
    results = [
        {"parameter": {"name": "pm25", "units": "µg/m³"}, "value": 1.5, "datetime": {"utc": "2024-01-01T00:00:00Z"}},
        {"parameter": {"name": "o3", "units": "µg/m³"}, "value": 2.5, "datetime": {"utc": "?"}},
    ]
    df = spark.createDataFrame([("oa-1", json.dumps({"results": results}))], "location_id string, payload string")
    rows = sources.flatten_latest(df).withColumn("timestamp", F.col("timestamp").cast("string")).collect()
    assert [tuple(r) for r in rows] == [
        ("oa-1", "pm25", 1.5, "µg/m³", "2024-01-01 00:00:00"),
        ("oa-1", "o3", 2.5, "µg/m³", None),
    ]


def test_location_numbers(spark):
    df = spark.createDataFrame([("oa-42",), ("st-42",), ("oa-x",)], "id string")
    assert [r[0] for r in df.select(sources.location_number(F.col("id"))).collect()] == [42, None, None]
    long = spark.createDataFrame([("oa-" + "0" * 20 + "17",), ("oa-" + "9" * 30,), ("oa-",), (None,)], "id string")
    assert [r[0] for r in long.select(sources.location_number(F.col("id"))).collect()] == [17, None, None, None]


class Broken:
    name = "broken"

    def publish(self, aggregates, batch_id):
        raise OSError("no such sink")


def test_fan_out_goes_on_after_a_failure_and_can_repeat(spark, aggregates, tmp_path, caplog):
    parquet = sources.ParquetSink(str(tmp_path / "p"))
    messages = sources.MessageSink(str(tmp_path / "m"))
    publish = sources.fan_out([Broken(), parquet, messages], on_failure="log")
    df = two(aggregates)
    for batch in (0, 1, 1):
        publish(df, batch)
    assert "sink broken failed on batch 0" in caplog.text
    assert sources.read_aggregates(spark, parquet.path).count() == 4
    stored = spark.read.schema("key string, value string").json(messages.path)
    assert sources.from_messages(stored).count() == 4


def test_fan_out_raises_after_all_sinks_had_the_batch(spark, aggregates, tmp_path):
    parquet = sources.ParquetSink(str(tmp_path / "p"))
    with pytest.raises(sources.SinkError, match="broken"):
        sources.fan_out([Broken(), parquet])(two(aggregates), 0)
    assert sources.read_aggregates(spark, parquet.path).count() == 2
    with pytest.raises(ValueError):
        sources.fan_out([], on_failure="ignore")


def test_a_station_is_sent_by_one_task_in_order(aggregates):
    start = at("2024-01-01T00:00:00")
    df = aggregates(*({"location_id": f"st-{i % 3}", "window_start": start + timedelta(seconds=(i * 7) % 50)} for i in range(50)))
    sent = sources.KafkaSink("", "").messages(df.repartition(5)).withColumn("task", F.spark_partition_id())
    seen = {}
    for row in sent.collect():
        seen.setdefault(row["key"], []).append((row["task"], json.loads(row["value"])["window_start"]))
    for order in seen.values():
        assert len({task for task, _ in order}) == 1
        assert order == sorted(order)


def test_a_stream_needs_one_source(spark):
    for wrong in ({}, {"path": "x", "brokers": "y"}):
        with pytest.raises(ValueError):
            sources.read_aggregate_stream(spark, **wrong)
