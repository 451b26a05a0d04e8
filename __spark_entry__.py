
from __future__ import annotations

import os
import sys
from collections.abc import Callable
from datetime import datetime

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

import oracle
from hazemill import functions as fn
from hazemill import operators as op
from hazemill import sources, streaming
from hazemill.plans import sensor_feed as feed
from hazemill.plans.board import watch
from hazemill.plans.collect import collect_rest, collect_stream
from hazemill.plans.consume import consume
from hazemill.session import shared_dir
from oracle import MEMBERS, MORE_MEMBERS

Query = Callable[[SparkSession, str], DataFrame]


def entry(spark: SparkSession) -> DataFrame:
    """Readings to daily windows to the stations with the worst PM2.5 index."""
    return op.worst_stations(feed.daily_windows(spark, "/root/testdata/sf0.001"))


def _unzoned(df: DataFrame) -> DataFrame:
    """Times without a zone, as the source tables have them."""
    return df.select(
        *(
            F.col(f.name).cast("timestamp_ntz").alias(f.name)
            if isinstance(f.dataType, T.TimestampType)
            else F.col(f.name)
            for f in df.schema
        )
    )


def _on_cleaned(operator: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf: operator(op.clean(feed.instrument_feed(spark, sf)))


def _on_daily(operator: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf: operator(feed.daily_windows(spark, sf))


def _on_readings(operator: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf: operator(feed.readings(spark, sf))


def _on_stations(operator: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf: operator(_slug_catalogue(spark, sf))


def _judged(readings: DataFrame) -> DataFrame:
    return op.validate_frame(readings, value="value")


def _stored_daily(spark: SparkSession, sf: str) -> str:
    folder = shared_dir(spark, "daily")
    sources.write_aggregates(feed.daily_windows(spark, sf), folder)
    return folder


def _stored_messages(spark: SparkSession, sf: str) -> str:
    folder = shared_dir(spark, "messages")
    messages = sources.to_messages(feed.daily_windows(spark, sf), ordered=True)
    messages.write.json(folder)
    return folder


def _read_aggregates(spark: SparkSession, sf: str) -> DataFrame:
    return _unzoned(sources.read_aggregates(spark, _stored_daily(spark, sf)))


def _register_views(spark: SparkSession, sf: str) -> DataFrame:
    sources.register_views(spark, _stored_daily(spark, sf), "daily_windows")
    return spark.sql(
        "SELECT city, parameter, count(*) AS windows, max(aqi) AS peak_aqi FROM daily_windows"
        " WHERE window_end > :since GROUP BY city, parameter",
        args={"since": datetime(1970, 1, 1)},
    )


def _to_messages(spark: SparkSession, sf: str) -> DataFrame:
    messages = sources.to_messages(feed.daily_windows(spark, sf), ordered=True)
    return _unzoned(sources.from_messages(messages, keep=["key"]))


def _read_aggregate_stream(spark: SparkSession, sf: str) -> DataFrame:
    stream = sources.read_aggregate_stream(spark, _stored_messages(spark, sf))
    return _unzoned(streaming.run_to_table(spark, stream, "aggregate-stream"))


def _fan_out(spark: SparkSession, sf: str) -> DataFrame:
    folder = shared_dir(spark, "fan-out")
    sinks = [
        sources.ParquetSink(f"{folder}/windows"),
        sources.MessageSink(f"{folder}/messages"),
    ]
    collect_stream(
        feed.reading_stream(spark, sf), sinks, f"{folder}/checkpoint", size=feed.DAY, delay="1 hour"
    ).awaitTermination()
    collect_rest(
        feed.readings(spark, sf), sources.read_aggregates(spark, f"{folder}/windows"), sinks, size=feed.DAY
    )
    windows = sources.read_aggregates(spark, f"{folder}/windows")
    messages = spark.read.schema("key string, value string").json(f"{folder}/messages")
    both = windows.withColumn("sink", F.lit("parquet")).unionByName(
        sources.from_messages(messages).withColumn("sink", F.lit("messages"))
    )
    return _unzoned(both)


def _enrich(spark: SparkSession, sf: str) -> DataFrame:
    return op.enrich_with_station(feed.latest_readings(spark, sf), feed.catalogue(spark, sf))


def _with_spec_table(spark: SparkSession, sf: str) -> DataFrame:
    """Validation against a table of rules, here limits taken from all usual readings."""
    readings = feed.readings(spark, sf)
    usual = (F.col("parameter") != "xx") & F.col("unit").isin("µg/m³", "mg/m³")
    specs = (
        readings.filter(usual & ~F.isnan("value"))
        .groupBy("parameter")
        .agg(
            F.max("unit").alias("expected_unit"),
            F.lit(0.0).alias("min_value"),
            (2 * fn.exact_mean("value")).alias("max_value"),
        )
    )
    judged = _judged(op.with_spec(readings, specs))
    return judged.select("event_id", "parameter", "max_value", "code")


def _counters(spark: SparkSession, sf: str) -> DataFrame:
    return op.collector_counters(
        _judged(feed.readings(spark, sf)), feed.daily_windows(spark, sf)
    )


def _worst_stations_sql(spark: SparkSession, sf: str) -> DataFrame:
    feed.instrument_feed(spark, sf).createOrReplaceTempView("instrument_feed")
    return op.worst_stations_sql(spark, "instrument_feed")


def _slug_catalogue(spark: SparkSession, sf: str) -> DataFrame:
    """Stations whose id is the slug of their name, hashed once per station."""
    return feed.catalogue(spark, sf).withColumn("location_id", fn.station_slug("location"))


def _assigned_to(spark: SparkSession, sf: str) -> DataFrame:
    named = feed.catalogue(spark, sf).withColumn("location", fn.station_slug("location"))
    readings = op.enrich_with_station(feed.latest_readings(spark, sf), named)
    readings = readings.withColumn("location_id", F.col("location"))
    stations = _slug_catalogue(spark, sf)
    return op.assigned_readings(readings, stations, MEMBERS[1], MEMBERS)


def _scalar_functions(spark: SparkSession, sf: str) -> DataFrame:
    readings = feed.readings(spark, sf)
    events = feed.table(spark, sf, "events").select("event_id", "event_type")
    iso = F.date_format("timestamp", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
    text = F.when(F.col("event_type") == "error", "not a time").otherwise(iso)
    computed = readings.withColumns(
        {
            "aqi": fn.aqi("parameter", "value"),
            "code": fn.validate_code("parameter", "value", "unit", "latitude", "longitude"),
            "third": F.col("value") / 3,
        }
    )
    return _unzoned(
        computed.join(events, "event_id").select(
            "event_id",
            "aqi",
            fn.aqi("parameter", "value", gaps="close").alias("aqi_closed"),
            fn.aqi_category("aqi").alias("category"),
            "code",
            fn.reason_message("code").alias("reason"),
            fn.round_window("third").alias("window_rounded"),
            fn.round_half_up("third", 1).alias("half_up"),
            fn.parse_ts(text).alias("parsed"),
            fn.station_slug(
                F.concat("location", F.lit("·"), F.col("user_id").cast("string"))
            ).alias("slug"),
        )
    )


def _sql_functions(spark: SparkSession, sf: str) -> DataFrame:
    fn.register_sql_functions(spark)
    feed.readings(spark, sf).createOrReplaceTempView("readings")
    return spark.sql(
        """
        SELECT event_id, aqi(parameter, value) AS aqi,
               aqi_category(aqi(parameter, value)) AS category,
               validate_code(parameter, value, unit, latitude, longitude) AS code,
               reason_message(validate_code(parameter, value, unit, latitude, longitude)) AS reason,
               round_half_up(value / 3, 2) AS half_up
        FROM readings
        """
    )


def _valid_stream(spark: SparkSession, sf: str) -> DataFrame:
    return op.valid_readings(feed.reading_stream(spark, sf))


def _stream_tumbling(spark: SparkSession, sf: str) -> DataFrame:
    stream = streaming.stream_tumbling(_valid_stream(spark, sf), feed.DAY, "1 hour")
    return _unzoned(streaming.run_to_table(spark, stream, "tumbling"))


def _stream_and_tail(spark: SparkSession, sf: str) -> DataFrame:
    """What a stream emitted and what it still owed when it stopped."""
    stream = streaming.stream_tumbling(_valid_stream(spark, sf), feed.DAY, "1 hour")
    emitted = streaming.run_to_table(spark, stream, "whole")
    rest = streaming.missing_windows(op.valid_readings(feed.readings(spark, sf)), emitted, feed.DAY)
    return streaming.newest_versions(_unzoned(emitted).unionByName(_unzoned(rest.drop("missed"))))


def _stream_dedup(spark: SparkSession, sf: str) -> DataFrame:
    """Messages that were all delivered twice."""
    folder = shared_dir(spark, "twice")
    for _ in range(2):
        sources.to_messages(feed.daily_windows(spark, sf)).write.mode("append").json(folder)
    stream = streaming.stream_dedup(sources.read_aggregate_stream(spark, folder), delay="60 days")
    return _unzoned(streaming.run_to_table(spark, stream, "dedup"))


def _repaired_windows(spark: SparkSession, sf: str) -> DataFrame:
    """Windows published as of half of the readings, then again as of all: the newest versions."""
    folder, readings = shared_dir(spark, "versions"), op.valid_readings(feed.readings(spark, sf))
    half = op.tumbling_aggregate(readings.filter("event_id % 2 = 0"), feed.DAY)
    sink = sources.ParquetSink(folder)
    for batch, windows in enumerate((half, op.tumbling_aggregate(readings, feed.DAY))):
        sink.publish(windows, batch)
    return _unzoned(sources.read_windows(spark, folder))


def _consume(spark: SparkSession, sf: str) -> DataFrame:
    """Messages of which those about CO were cut in half: aggregates and rejects by station."""
    folder = shared_dir(spark, "consume")
    messages = sources.to_messages(feed.daily_windows(spark, sf))
    cut = F.expr("substring(value, 1, length(value) DIV 2)")
    broken = F.col("value").contains('"parameter":"co"')
    messages.withColumn("value", F.when(broken, cut).otherwise(F.col("value"))).write.json(f"{folder}/in")
    windows, rejects = sources.ParquetSink(f"{folder}/windows"), sources.RejectSink(f"{folder}/rejects")
    consume(sources.read_messages(spark, f"{folder}/in"), [windows], rejects, f"{folder}/checkpoint").awaitTermination()
    taken = sources.read_aggregates(spark, windows.path).select(F.col("location_id").alias("key"))
    kept = spark.read.schema("key string, value string").parquet(rejects.path).select("key")
    both = taken.withColumn("outcome", F.lit("aggregate")).unionByName(kept.withColumn("outcome", F.lit("reject")))
    return both.groupBy("key", "outcome").agg(F.count(F.lit(1)).alias("messages"))


def _live_board(name: str) -> Query:
    """A table of the board after all messages came in, in three batches."""

    def run(spark: SparkSession, sf: str) -> DataFrame:
        folder, tables = shared_dir(spark, "board"), {}
        for i in range(3):
            part = feed.daily_windows(spark, sf).filter(F.pmod(F.xxhash64("location_id"), F.lit(3)) == i)
            sources.to_messages(part).coalesce(1).write.mode("append").json(f"{folder}/in")
        stream = sources.read_aggregate_stream(spark, f"{folder}/in", max_per_trigger=1)
        watch(stream, f"{folder}/checkpoint", lambda t, _: tables.update(t), span="7 days", every=None).awaitTermination()
        return _unzoned(tables[name])

    return run


def _periodic_emission(spark: SparkSession, sf: str) -> DataFrame:
    """A stream that emits every second until it has read all there is."""
    folder = shared_dir(spark, "periodic")
    windows = streaming.stream_tumbling(_valid_stream(spark, sf), feed.DAY, "1 hour")
    query = streaming.start(windows, f"{folder}/checkpoint", path=f"{folder}/rows", every="1 second")
    query.processAllAvailable()
    query.stop()
    return _unzoned(spark.read.schema(windows.schema).parquet(f"{folder}/rows"))


def _flush_tail(spark: SparkSession, sf: str) -> DataFrame:
    return streaming.flush_tail(op.valid_readings(feed.readings(spark, sf)), feed.DAY, "1 hour")


def _stream_sliding(spark: SparkSession, sf: str) -> DataFrame:
    aggregates = sources.read_aggregate_stream(spark, _stored_messages(spark, sf))
    stream = streaming.stream_sliding(aggregates, "3 days", "1 day", "1 hour")
    return _unzoned(streaming.run_to_table(spark, stream, "sliding"))


def _stream_chain(spark: SparkSession, sf: str) -> DataFrame:
    stream = streaming.stream_chain(_valid_stream(spark, sf), feed.DAY, "3 days", "1 day", "1 hour")
    return _unzoned(streaming.run_to_table(spark, stream, "chain"))


try:  # the training-data operators can be left out
    from hazemill.llm.queries import llm_oracle_sql, llm_queries
except ImportError:

    def llm_queries() -> dict[str, Query]:
        return {}

    def llm_oracle_sql() -> dict[str, str]:
        return {}


def queries() -> dict[str, Query]:
    """Every operator over the driver's tables."""
    return {**_sensor_queries(), **llm_queries()}


def _sensor_queries() -> dict[str, Query]:
    return {
        # Sources, sinks and payloads.
        "read_aggregates": _read_aggregates,
        "register_views": _register_views,
        "to_messages": _to_messages,
        "read_aggregate_stream": _read_aggregate_stream,
        "fan_out": _fan_out,
        "flatten_locations": feed.catalogue,
        "flatten_latest": feed.latest_readings,
        "enrich_with_station": _enrich,
        # Validation and cleaning.
        "validate_frame": _on_readings(_judged),
        "only_valid": _on_readings(
            lambda df: op.only_valid(_judged(df)).drop("code", "valid", "reason")
        ),
        "with_spec": _on_readings(op.with_spec),
        "with_spec_table": _with_spec_table,
        "quality_report": _on_readings(lambda df: op.quality_report(_judged(df))),
        "collector_counters": _counters,
        "dedup": lambda spark, sf: op.dedup(feed.instrument_feed(spark, sf)),
        "clean": _on_cleaned(lambda df: df),
        "clean_report": lambda spark, sf: op.clean_report(feed.instrument_feed(spark, sf)),
        # Roll-up and reports.
        "tumbling_aggregate": feed.daily_windows,
        "with_aqi": _on_daily(lambda df: op.with_aqi(df.drop("aqi", "aqi_category"))),
        "by_parameter": _on_daily(op.by_parameter),
        "worst_stations": _on_cleaned(op.worst_stations),
        "worst_stations_sql": _worst_stations_sql,
        "pollutant_summary": _on_cleaned(op.pollutant_summary),
        "aqi_category_breakdown": _on_cleaned(op.aqi_category_breakdown),
        "aqi_category_share": _on_cleaned(op.aqi_category_share),
        "city_pollutant_matrix": _on_cleaned(op.city_pollutant_matrix),
        "pollutant_distribution": _on_cleaned(op.pollutant_distribution),
        "aqi_timeseries": _on_cleaned(op.aqi_timeseries),
        "distinct_values": _on_cleaned(lambda df: op.distinct_values(df, "city", "parameter")),
        "preview": _on_daily(
            lambda df: op.preview(df, 5, ["window_end", "location_id", "parameter", "unit"])
        ),
        # The present state.
        "latest_per_station": _on_daily(op.latest_per_station),
        "aqi_map": _on_daily(op.aqi_map),
        "kpi_summary": _on_daily(op.kpi_summary),
        "recent_windows": _on_daily(lambda df: op.recent_windows(df, 5)),
        "within_last": _on_daily(lambda df: op.within_last(df, "7 days")),
        "rolling_summary": _on_daily(lambda df: op.rolling_summary(df, "7 days")),
        "rolling_as_of": _on_daily(lambda df: op.rolling_as_of(df, "3 days")),
        "sliding_summary": lambda spark, sf: _unzoned(
            streaming.stream_sliding(feed.daily_windows(spark, sf), "3 days", "1 day")
        ),
        # Shards.
        "assign_shards": _on_stations(lambda df: op.assign_shards(df, MEMBERS)),
        "shard_sizes": _on_stations(lambda df: op.shard_sizes(df, MEMBERS)),
        "shard_moves": _on_stations(lambda df: op.shard_moves(df, MEMBERS, MORE_MEMBERS)),
        "assigned_to": _assigned_to,
        # Scalar functions, as columns and from SQL.
        "scalar_functions": _scalar_functions,
        "sql_functions": _sql_functions,
        # Streams.
        "stream_tumbling": _stream_tumbling,
        "stream_and_tail": _stream_and_tail,
        "stream_dedup": _stream_dedup,
        "flush_tail": _flush_tail,
        "repaired_windows": _repaired_windows,
        "consume_messages": _consume,
        "live_latest_per_station": _live_board("latest_per_station"),
        "live_rolling_summary": _live_board("rolling_summary"),
        "periodic_emission": _periodic_emission,
        "stream_sliding": _stream_sliding,
        "stream_chain": _stream_chain,
    }


def oracle_sql() -> dict[str, str]:
    """DuckDB twin per query that SQL can express."""
    return {**oracle.oracle_sql(), **llm_oracle_sql()}
