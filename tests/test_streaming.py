from __future__ import annotations

import json
import random
import time
from collections import Counter
from datetime import timedelta

import pytest
from pyspark.errors import AnalysisException, StreamingQueryException
from pyspark.sql import functions as F

from hazemill import operators as op
from hazemill import sources, streaming
from hazemill.plans.batch_report import analyze
from hazemill.plans.board import board_tables, watch, write_tables
from hazemill.plans.collect import collect_rest, collect_stream, collect_windows
from hazemill.plans.consume import consume
from hazemill.schemas import AGGREGATE
from hazemill.session import shared_dir
from tests.conftest import at

START = at("2024-01-01T00:00:00")


def feed(measurements, n=300):
    rng = random.Random(5)
    rows = []
    for i in range(n):
        rows.append(
            {
                "location_id": f"st-{rng.randrange(4)}",
                "parameter": rng.choice(["pm25", "o3", "xx"]),
                "value": round(rng.uniform(-5, 1100), 2),
                "location": rng.choice(["A", "B"]),
                "timestamp": START + timedelta(seconds=i, microseconds=rng.randrange(1000)),
            }
        )
    return measurements(*rows)


def stored(df, path, files=3):
    """Readings as files in the order of their times, one per batch."""
    for i in range(files):
        piece = df.filter(F.pmod(F.floor(F.unix_seconds("timestamp") / 100), F.lit(files)) == i)
        piece.coalesce(1).write.mode("append").parquet(path)
    return path


def rows_of(df):
    return sorted(tuple(r) for r in df.collect())


def test_stream_and_tail_make_the_batch(spark, measurements, tmp_path):
    df = feed(measurements)
    path = stored(df, str(tmp_path / "in"))
    stream = sources.read_measurement_stream(spark, path, max_files=1)
    valid = op.valid_readings(stream)
    emitted = streaming.run_to_table(spark, streaming.stream_tumbling(valid, "10 seconds", "30 seconds"), "t")
    tail = streaming.flush_tail(op.valid_readings(df), "10 seconds", "30 seconds")
    assert emitted.columns == AGGREGATE.fieldNames()
    assert emitted.count() and tail.count()
    whole = rows_of(emitted.unionByName(tail))
    assert whole == rows_of(collect_windows(df, "10 seconds"))


def test_collector_job(spark, measurements, tmp_path):
    df = feed(measurements)
    path = stored(df, str(tmp_path / "in"))
    parquet = sources.ParquetSink(str(tmp_path / "windows"))
    messages = sources.MessageSink(str(tmp_path / "messages"))
    query = collect_stream(
        sources.read_measurement_stream(spark, path, max_files=1),
        [parquet, messages],
        str(tmp_path / "checkpoint"),
        delay="30 seconds",
    )
    query.awaitTermination()
    metrics = [p.observedMetrics["quality"] for p in query.recentProgress if "quality" in p.observedMetrics]
    assert sum(m["measurements_total"] for m in metrics) == 300
    expected = op.quality_report(op.validate_frame(df, value="value")).filter("code = 1").first()["readings"]
    assert sum(m["invalid_1"] for m in metrics) == expected
    written = rows_of(sources.read_aggregates(spark, parquet.path))
    sent = spark.read.schema("key string, value string").json(messages.path)
    assert written and written == rows_of(sources.from_messages(sent))


class Flaky:
    """Refuses its first batch."""

    name = "flaky"

    def __init__(self, sink):
        self.sink, self.path, self.refused = sink, sink.path, False

    def publish(self, aggregates, batch_id):
        if not self.refused:
            self.refused = True
            raise OSError("not now")
        self.sink.publish(aggregates, batch_id)


def test_late_readings_and_failing_sinks_lose_nothing(spark, measurements, tmp_path):
    df = feed(measurements)
    path = str(tmp_path / "in")
    # One quarter of the readings arrives last, after its windows were emitted: rows count
    # as late by the watermark of the batch before the last.
    for part in (0, 2, 3, 1):
        piece = df.filter(F.floor((F.unix_seconds("timestamp") - int(START.timestamp())) / 75) == part)
        piece.coalesce(1).write.mode("append").parquet(path)
        time.sleep(1.1)  # files are taken in the order of their times
    parquet = sources.ParquetSink(str(tmp_path / "windows"))
    flaky = Flaky(sources.ParquetSink(str(tmp_path / "flaky")))
    counters = streaming.StreamCounters()
    spark.streams.addListener(counters)

    def run(checkpoint):
        stream = sources.read_measurement_stream(spark, path, max_files=1)
        query = collect_stream(stream, [flaky, parquet], str(tmp_path / checkpoint), delay="30 seconds")
        query.awaitTermination()
        return query

    try:
        with pytest.raises(StreamingQueryException, match="flaky"):
            run("checkpoint")
        query = run("checkpoint")
        for _ in range(100):
            if counters.totals(query).get("late_rows"):
                break
            time.sleep(0.1)
        assert counters.totals(query)["late_rows"] > 0
        assert counters.totals(query)["measurements_total"] >= 300
    finally:
        spark.streams.removeListener(counters)
    whole = rows_of(collect_windows(df, "10 seconds"))
    emitted = sources.read_aggregates(spark, parquet.path)
    assert rows_of(emitted) == rows_of(sources.read_aggregates(spark, flaky.path))
    assert emitted.count() < len(whole)
    rest = collect_rest(df, emitted, [flaky, parquet])
    assert rest["windows"] and rest["readings"]
    for sink in (flaky, parquet):
        both = sources.read_aggregates(spark, sink.path)
        assert rows_of(streaming.newest_versions(both)) == whole
    # Nothing is owed twice, and a run from a new checkpoint replaces nothing.
    emitted = sources.read_aggregates(spark, parquet.path)
    before = emitted.count()
    assert collect_rest(df, emitted, [parquet]) == {"windows": 0, "readings": 0}
    run("other")
    assert sources.read_aggregates(spark, parquet.path).count() > before


def windows(aggregates):
    rng = random.Random(9)
    return aggregates(
        *(
            {
                "city": rng.choice("ab"),
                "window_end": START + timedelta(seconds=10 * rng.randrange(120)),
                "avg": round(rng.uniform(1, 90), 2),
                "aqi": rng.randrange(200),
                "max": float(rng.randrange(99)),
            }
            for _ in range(300)
        )
    )


def test_sliding_table_is_the_summary_at_each_instant(aggregates):
    df = windows(aggregates)
    sliding = streaming.stream_sliding(df, "5 minutes", "1 minute")
    for minute in (0, 1, 5, 12, 19):
        now = START + timedelta(minutes=minute)
        here = sliding.filter(F.col("as_of") == F.lit(now)).drop("as_of")
        assert rows_of(here) == rows_of(op.rolling_summary(df, "5 minutes", now))


def test_sliding_stream_equals_the_table(spark, aggregates):
    df = windows(aggregates)
    folder = shared_dir(spark, "messages")
    sources.to_messages(df).coalesce(1).write.json(folder)
    stream = streaming.stream_sliding(sources.read_aggregate_stream(spark, folder), "5 minutes", "1 minute")
    emitted = streaming.run_to_table(spark, stream, "s")
    newest = df.agg(F.max("window_end")).first()[0]
    closed = streaming.stream_sliding(df, "5 minutes", "1 minute").filter(
        F.col("as_of") < F.lit(newest) - timedelta(minutes=1)
    )
    assert emitted.count()
    assert rows_of(emitted) == rows_of(closed)


def test_update_mode_shows_open_windows(spark, aggregates, tmp_path):
    df = windows(aggregates)
    folder = shared_dir(spark, "messages")
    sources.to_messages(df).coalesce(1).write.json(folder)
    stream = streaming.stream_sliding(sources.read_aggregate_stream(spark, folder), "5 minutes", "1 minute")
    out = str(tmp_path / "updates")

    def keep(batch, batch_id):
        batch.write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")

    streaming.start(stream, str(tmp_path / "checkpoint"), batch=keep, mode="update").awaitTermination()
    shown = spark.read.schema(stream.schema).parquet(out).select(*stream.columns)
    assert rows_of(shown) == rows_of(streaming.stream_sliding(df, "5 minutes", "1 minute"))


def test_repeated_deliveries_are_dropped(spark, aggregates):
    df = windows(aggregates).withColumn("window_start", F.col("window_end") - timedelta(seconds=10))
    df = op.dedup(df)
    folder = shared_dir(spark, "twice")
    for _ in range(3):
        sources.to_messages(df).coalesce(1).write.mode("append").json(folder)
    stream = sources.read_aggregate_stream(spark, folder, max_per_trigger=1)
    kept = streaming.run_to_table(spark, streaming.stream_dedup(stream, delay="1 hour"), "dedup")
    assert rows_of(kept) == rows_of(df)


def test_chained_windows(spark, measurements, tmp_path):
    df = feed(measurements)
    path = stored(df, str(tmp_path / "in"), 1)
    stream = streaming.stream_chain(
        op.valid_readings(sources.read_measurement_stream(spark, path)),
        "10 seconds", "1 minute", "20 seconds", "30 seconds",
    )
    emitted = streaming.run_to_table(spark, stream, "chain")
    batch = streaming.stream_sliding(collect_windows(df, "10 seconds"), "1 minute", "20 seconds")
    last = emitted.agg(F.max("as_of")).first()[0]
    assert emitted.count()
    assert rows_of(emitted) == rows_of(batch.filter(F.col("as_of") <= F.lit(last)))


def test_board(spark, aggregates, tmp_path):
    df = windows(aggregates)
    now = START + timedelta(minutes=12)
    tables = board_tables(df, as_of=now)
    live = op.within_last(df, as_of=now)
    assert rows_of(tables["rolling_summary"]) == rows_of(op.rolling_summary(df, as_of=now))
    assert tables["kpi_summary"].first()["aggregates_in_window"] == live.count()
    assert sum(r["windows"] for r in tables["aqi_category_share"].collect()) == live.count()
    for name in ("latest_per_station", "aqi_map", "aqi_timeseries"):
        assert tables[name].count() > 0


def test_watch_hands_out_the_tables_of_all_that_came(spark, aggregates, tmp_path):
    df = op.dedup(windows(aggregates).withColumn("window_start", F.col("window_end") - timedelta(seconds=10)))
    folder = shared_dir(spark, "messages")
    pieces = [df.filter(F.pmod(F.xxhash64("window_end"), F.lit(3)) == i) for i in range(3)]
    for piece in [*pieces, pieces[1]]:  # out of order, and one delivered again
        sources.to_messages(piece).coalesce(1).write.mode("append").json(folder)
        time.sleep(1.1)
    shown = []

    def show(tables, batch_id):
        shown.append((batch_id, {name: rows_of(table) for name, table in tables.items()}))

    stream = sources.read_aggregate_stream(spark, folder, max_per_trigger=1)
    watch(stream, str(tmp_path / "checkpoint"), show, every=None).awaitTermination()
    assert [i for i, _ in shown] == [0, 1, 2, 3]
    seen = pieces[0]
    for piece, (_, tables) in zip([None, *pieces[1:], None], shown):
        seen = seen if piece is None else seen.unionByName(piece)
        assert tables == {name: rows_of(table) for name, table in board_tables(seen).items()}
    write_tables(str(tmp_path / "tables"))(board_tables(df), 0)
    assert rows_of(spark.read.parquet(str(tmp_path / "tables" / "aqi_map"))) == rows_of(board_tables(df)["aqi_map"])


def test_every_message_is_an_aggregate_or_a_reject(spark, aggregates, tmp_path):
    df = windows(aggregates)
    good = sources.to_messages(df)
    bad = spark.createDataFrame(
        [("a", "{"), ("b", None), (None, "[]"), ("c", "{}"), ("d", '{"parameter": null}'), ("e", "no"), ("f", '{"avg": "x"}')] * 3,
        "key string, value string",
    )
    folder = shared_dir(spark, "mixed")
    for part in range(3):
        good.unionByName(bad).sample(0.5, seed=part).coalesce(1).write.mode("append").json(folder)
    sent = spark.read.schema("key string, value string").json(folder)
    parquet, rejects = sources.ParquetSink(str(tmp_path / "windows")), sources.RejectSink(str(tmp_path / "rejects"))
    flaky = Flaky(sources.MessageSink(str(tmp_path / "flaky")))
    counters = streaming.StreamCounters("messages")
    spark.streams.addListener(counters)
    try:
        for attempt in range(2):
            stream = sources.read_messages(spark, folder, max_per_trigger=1)
            query = consume(stream, [flaky, parquet], rejects, str(tmp_path / "checkpoint"))
            if attempt == 0:
                with pytest.raises(StreamingQueryException, match="flaky"):
                    query.awaitTermination()
            else:
                query.awaitTermination()
        taken, kept = sources.read_aggregates(spark, parquet.path), spark.read.parquet(rejects.path)
        assert rows_of(taken) == rows_of(sources.from_messages(sent))
        wanted = sorted(map(str, map(tuple, sources.rejected_messages(sent).collect())))
        assert sorted(str((r["key"], r["value"])) for r in kept.collect()) == wanted
        assert taken.count() + kept.count() == sent.count() and kept.count() > 10
        for _ in range(100):
            if counters.totals(query).get("messages_total", 0) >= sent.count():
                break
            time.sleep(0.1)
        assert counters.totals(query)["rejected_total"] >= kept.count()
    finally:
        spark.streams.removeListener(counters)


def test_repaired_windows_replace_stale_ones_for_every_reader(spark, aggregates, tmp_path):
    stale, repaired = aggregates({"count": 1, "avg": 10.0, "max": 11.0}), aggregates({"count": 2, "avg": 30.0, "max": 50.0})
    folder, messages = str(tmp_path / "windows"), shared_dir(spark, "versions")
    sinks = [sources.ParquetSink(folder), sources.MessageSink(messages)]
    for i, batch in enumerate((stale, repaired, stale)):
        sources.fan_out(sinks)(batch, i)
        time.sleep(0.1)
    assert sources.read_aggregates(spark, folder).count() == 3
    assert rows_of(sources.read_windows(spark, folder)) == rows_of(repaired)
    assert [r["avg"] for r in op.clean(sources.read_aggregates(spark, folder)).collect()] == [30.0]
    written = analyze(spark, folder, str(tmp_path / "report"))
    assert rows_of(sources.read_aggregates(spark, written["clean"])) == rows_of(repaired)
    for name in ("worst_stations", "worst_stations_sql"):
        row = spark.read.parquet(written[name]).first()
        assert (row["avg_pm25"], row["windows"], row["peak_pm25"]) == (30.0, 1, 50.0)
    stream = streaming.stream_dedup(sources.read_aggregate_stream(spark, messages), delay="1 hour")
    versions = streaming.run_to_table(spark, stream, "versions")
    assert versions.count() == 2
    assert rows_of(streaming.newest_versions(versions)) == rows_of(repaired)


def test_a_collector_stopped_before_its_first_batch(spark, measurements, tmp_path):
    df = feed(measurements)
    sink = sources.ParquetSink(str(tmp_path / "windows"))
    emitted = sources.read_aggregates(spark, sink.path, missing_ok=True)
    assert emitted.count() == 0 and emitted.columns == AGGREGATE.fieldNames()
    rest = collect_rest(df, emitted, [sink])
    assert rest["windows"] == collect_windows(df).count()
    assert rows_of(sources.read_windows(spark, sink.path)) == rows_of(collect_windows(df))
    with pytest.raises(AnalysisException):
        sources.read_aggregates(spark, str(tmp_path / "nothing"))


def test_only_owed_days_are_rolled_up(spark, measurements, tmp_path):
    days = [{"timestamp": START + timedelta(days=d, hours=h, minutes=50 * h), "value": float(d + h)} for d in range(12) for h in range(0, 12, 3)]
    df = op.valid_readings(measurements(*days))
    for size in ("10 seconds", "7 hours", "3 days"):
        whole = op.tumbling_aggregate(df, size)
        emitted = whole.filter(~F.col("window_start").cast("date").isin([(START + timedelta(days=d)).date() for d in (3, 4, 9)]))
        owed = streaming.missing_windows(df, emitted, size)
        assert rows_of(emitted.unionByName(owed.drop("missed"))) == rows_of(whole)
        expected = sorted({r["window_start"].date() for r in whole.exceptAll(emitted).collect()})
        assert streaming.owed_days(df, emitted, size) == expected
    path = str(tmp_path / "readings")
    df.withColumn("day", F.to_date("timestamp")).write.partitionBy("day").parquet(path)
    stored = spark.read.parquet(path)
    whole = op.tumbling_aggregate(stored, "10 seconds")
    late = (START + timedelta(days=5)).date()
    owed = streaming.missing_windows(stored, whole.filter(F.to_date("window_start") != F.lit(late)), "10 seconds")
    plan = owed._jdf.queryExecution().executedPlan().toString()
    assert str(late) in plan[plan.index("PartitionFilters") :] and "GreaterThanOrEqual(timestamp" in plan
    assert owed.count() == 4


def test_hot_station_is_sent_by_several_tasks_in_order(spark, aggregates):
    rows = [{"location_id": "hot" if i % 3 == 0 else f"st-{i % 50}", "window_start": START + timedelta(seconds=10 * (i * 7919 % 3000))} for i in range(3000)]
    df = aggregates(*rows)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    try:
        sent = sources.KafkaSink("none:1", "topic").messages(df).withColumn("task", F.spark_partition_id())
        got = sent.select("task", "key", F.col("headers")[0]["value"].cast("string").alias("order"), "value").collect()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    loads = Counter(r["task"] for r in got)
    assert len(got) == 3000 and max(loads.values()) < 3000 / 4
    assert len({r["task"] for r in got if r["key"] == "hot"}) > 1
    hot = [r for r in got if r["key"] == "hot"]
    assert [r["order"] for r in hot] == sorted(r["order"] for r in hot)
    starts = [json.loads(r["value"])["window_start"] for r in sorted(hot, key=lambda r: r["order"])]
    assert starts == sorted(starts)
