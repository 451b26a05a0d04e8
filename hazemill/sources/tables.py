"""Aggregate tables and streams: reading, writing, views."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from hazemill.operators.quality import dedup
from hazemill.operators.rollup import with_aqi
from hazemill.schemas import AGGREGATE, MEASUREMENT, PUBLISHED, VERSIONED
from hazemill.sources.messages import from_messages


def read_aggregates(
    spark: SparkSession, path: str, complete: bool = False, versions: bool = False, missing_ok: bool = False
) -> DataFrame:
    """The 17 aggregate columns from Parquet, with a declared schema.

    Files of a collector that writes neither index nor category read as NULL there;
    ``complete=True`` fills both from the stored mean. ``versions=True`` adds ``published``,
    which ranks versions of a window (NULL where a writer gave none). With ``missing_ok`` a
    folder that nothing was written to is an empty table.
    """
    schema = VERSIONED if versions else AGGREGATE
    try:
        stored = spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if not missing_ok or error.getCondition() != "PATH_NOT_FOUND":
            raise
        stored = spark.createDataFrame([], schema)
    stored = stored.select(*schema.fieldNames())
    if not complete:
        return stored
    return with_aqi(stored, [PUBLISHED.name] if versions else [])


def read_windows(spark: SparkSession, path: str, missing_ok: bool = False) -> DataFrame:
    """The newest version of every window that a sink's folder holds, as aggregates."""
    return dedup(read_aggregates(spark, path, versions=True, missing_ok=missing_ok)).drop(PUBLISHED.name)


def register_views(
    spark: SparkSession, path: str, view: str = "aggregates", newest: bool = False
) -> DataFrame:
    """Make a Parquet path available to SQL under a name; ``newest`` leaves out versions of a
    window that have been replaced."""
    df = read_windows(spark, path) if newest else read_aggregates(spark, path)
    df.createOrReplaceTempView(view)
    return df


def write_aggregates(
    df: DataFrame,
    path: str,
    mode: str = "overwrite",
    partition_by: Sequence[str] = (),
) -> None:
    """Snappy Parquet with the 17 aggregate columns, and ``published`` if the rows have it.

    The first write replaces what is there, ``mode="append"`` adds a window. Large
    tables can be laid out by ``partition_by=["parameter"]``, so that a query of one
    pollutant opens only its files.
    """
    fields = [f for f in VERSIONED.fieldNames() if f in AGGREGATE.fieldNames() or f in df.columns]
    writer = df.select(*fields).write.mode(mode).option("compression", "snappy")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def read_measurements(spark: SparkSession, path: str, file_format: str = "parquet") -> DataFrame:
    """Readings stored as files in a folder."""
    return spark.read.schema(MEASUREMENT).format(file_format).load(path)


def read_measurement_stream(
    spark: SparkSession, path: str, file_format: str = "parquet", max_files: int | None = None
) -> DataFrame:
    """Readings that arrive as files in a folder."""
    reader = spark.readStream.schema(MEASUREMENT).format(file_format)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(path)


def read_aggregate_stream(spark: SparkSession, path: str | None = None, **options) -> DataFrame:
    """Aggregates decoded from the stream of ``read_messages``; what holds no aggregate is
    left out (``consume`` keeps it)."""
    return from_messages(read_messages(spark, path, **options))


def read_messages(
    spark: SparkSession,
    path: str | None = None,
    *,
    brokers: str | None = None,
    topic: str | None = None,
    group: str | None = None,
    starting: str = "earliest",
    max_per_trigger: int | None = None,
) -> DataFrame:
    """A stream of keyed messages, from Kafka or a folder of files.

    ``starting`` is the Kafka start position (``earliest`` or ``latest``); later starts
    of the same query go on from its checkpoint.
    """
    if (path is None) == (brokers is None):
        raise ValueError("give either a folder or Kafka brokers")
    if path is not None:
        reader = spark.readStream.schema("key string, value string").format("json")
        if max_per_trigger:
            reader = reader.option("maxFilesPerTrigger", max_per_trigger)
        return reader.load(path)
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", brokers)
        .option("subscribe", topic)
        .option("startingOffsets", starting)
    )
    if group:
        reader = reader.option("kafka.group.id", group)
    if max_per_trigger:
        reader = reader.option("maxOffsetsPerTrigger", max_per_trigger)
    return reader.load()
