"""Sensor readings derived from the ``events`` table, for tests and measurements.

Each event is one reading: the user is the instrument, 25 stations take their city and
country from ``nation`` and ``region``, and a counter in ``props`` decides which
readings are faulty and how.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hazemill.operators.joins import join_dimension
from hazemill.operators.quality import valid_readings
from hazemill.operators.rollup import STATION_PARAMETER, tumbling_aggregate
from hazemill.schemas import AGGREGATE
from hazemill.sources.payloads import flatten_latest, flatten_locations, station_id

STATIONS = 25
DAY = "1 day"

SCHEMAS = {
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double,"
    " props string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "region": "r_regionkey int, r_name string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
}

# Which pollutant an event stands for, and the faults by counter k.
_READING = [
    "concat('st-', site) AS location_id",
    "city AS location",
    "city",
    "country",
    """CASE WHEN k = 97 THEN 'xx' WHEN k % 6 = 5 THEN 'co' WHEN event_type = 'click' THEN 'pm25'
            WHEN event_type = 'view' THEN 'pm10' WHEN event_type = 'purchase' THEN 'no2'
            WHEN event_type = 'signup' THEN 'o3' ELSE 'so2' END AS parameter""",
    """CASE WHEN k = 95 THEN value * 50 WHEN k = 94 THEN -value WHEN k = 93 THEN DOUBLE('NaN')
            ELSE value END AS value""",
    """CASE WHEN k = 98 THEN 'ppm' WHEN k = 96 THEN '' WHEN k % 6 = 5 AND k <> 97 THEN 'mg/m³'
            ELSE 'µg/m³' END AS unit""",
    "if(k = 92, 200D, latitude) AS latitude",
    "longitude",
    "ts AS timestamp",
    "event_id",
    "user_id",
]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One driver table. Times are handled in UTC whatever the session came with."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def sites(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Place of each of the 25 station numbers."""
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    regions = region.withColumnRenamed("r_regionkey", "n_regionkey")
    return join_dimension(nation, regions, "n_regionkey").selectExpr(
        "bigint(n_nationkey) AS site",
        "n_name AS city",
        "r_name AS country",
        "double(n_nationkey * 6 - 72) AS latitude",
        "double(n_nationkey * 14 - 168) AS longitude",
    )


def readings_from(events: DataFrame, places: DataFrame) -> DataFrame:
    """Measurements (some faulty) plus ``event_id`` and ``user_id``, batch or stream."""
    # A generator parses each text once; predicates on k cannot be pushed into it.
    numbered = events.select(
        "*",
        (F.col("user_id") % STATIONS).alias("site"),
        F.inline(F.array(F.from_json("props", "k int"))),
    )
    return join_dimension(numbered, places, "site").selectExpr(*_READING)


def readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All readings of the ``events`` table."""
    return readings_from(table(spark, sf_dir, "events"), sites(spark, sf_dir))


def reading_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same readings as a stream; its times are instants, as watermarks require."""
    places = sites(spark, sf_dir)
    events = (
        spark.readStream.schema(SCHEMAS["events"])
        .option("pathGlobFilter", "events.parquet")
        .parquet(sf_dir)
    )
    stream = readings_from(events, places)
    return stream.withColumn("timestamp", F.col("timestamp").cast("timestamp"))


def daily_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily aggregates of the valid readings."""
    return tumbling_aggregate(valid_readings(readings(spark, sf_dir)), DAY)


def instrument_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily aggregates of every instrument, not validated.

    Instruments at one station report the same pollutant and day, so the feed holds
    duplicates as well as invalid rows.
    """
    raw = readings(spark, sf_dir)
    rolled = tumbling_aggregate(raw, DAY, [*STATION_PARAMETER, "user_id"])
    return rolled.select(*AGGREGATE.fieldNames())


def location_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One catalogue answer per supplier, as the API would give it."""
    suppliers = table(spark, sf_dir, "supplier").withColumn(
        "site", F.col("s_nationkey").cast("bigint")
    )
    placed = join_dimension(suppliers, sites(spark, sf_dir), "site")
    entry = F.struct(
        F.col("s_suppkey").alias("id"),
        F.col("s_name").alias("name"),
        F.struct(F.col("country").alias("code")).alias("country"),
        F.col("city").alias("locality"),
        F.struct("latitude", "longitude").alias("coordinates"),
    )
    return placed.select(F.to_json(F.struct(F.array(entry).alias("results"))).alias("payload"))


def latest_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One answer with the latest readings per event: the reading and one with a bad time."""
    source = readings(spark, sf_dir)

    def entry(utc: Column) -> Column:
        return F.struct(
            F.struct(F.col("parameter").alias("name"), F.col("unit").alias("units")).alias(
                "parameter"
            ),
            "value",
            F.struct(utc.alias("utc")).alias("datetime"),
        )

    utc = F.date_format("timestamp", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
    results = F.array(entry(utc), entry(F.lit("yesterday")))
    return source.select(
        station_id(F.col("user_id")).alias("location_id"),
        F.to_json(F.struct(results.alias("results"))).alias("payload"),
    )


def catalogue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stations from the catalogue payloads."""
    return flatten_locations(location_payloads(spark, sf_dir))


def latest_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings from the payloads; times without a zone, like the source table's."""
    flat = flatten_latest(latest_payloads(spark, sf_dir))
    return flat.withColumn("timestamp", F.col("timestamp").cast("timestamp_ntz"))
