"""Which collector owns which station (rendezvous hashing)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hazemill.functions.hashing import rendezvous_owner
from hazemill.operators.joins import join_dimension


def assign_shards(stations: DataFrame, members: Sequence[str]) -> DataFrame:
    """Add ``owner``: a projection over the catalogue, neither a join nor a shuffle."""
    return stations.withColumn("owner", rendezvous_owner("location_id", members))


def assigned_to(stations: DataFrame, member: str, members: Sequence[str]) -> DataFrame:
    """Stations of one member. Without any members every station is one's own."""
    if not members:
        return stations
    return stations.filter(rendezvous_owner("location_id", members) == member)


def assigned_readings(
    readings: DataFrame, stations: DataFrame, member: str, members: Sequence[str]
) -> DataFrame:
    """Readings of one member's stations; the hash is taken per station, not per reading."""
    mine = assigned_to(stations, member, members).select("location_id").distinct()
    return join_dimension(readings, mine, "location_id", "left_semi").select(*readings.columns)


def shard_sizes(stations: DataFrame, members: Sequence[str]) -> DataFrame:
    """Stations per member, members without stations included."""
    owned = assign_shards(stations, members).groupBy("owner")
    counts = owned.agg(F.count(F.lit(1)).alias("stations"))
    # The list of members is a parameter, so its join side is bounded.
    listed = stations.sparkSession.createDataFrame([(m,) for m in dict.fromkeys(members)], "owner string")
    joined = listed.join(counts, "owner", "left")
    return joined.select("owner", F.coalesce("stations", F.lit(0)).alias("stations")).orderBy("owner")


def shard_moves(stations: DataFrame, before: Sequence[str], after: Sequence[str]) -> DataFrame:
    """Owner of each station under two member lists and whether it moved."""
    old, new = rendezvous_owner("location_id", before), rendezvous_owner("location_id", after)
    return stations.select("location_id", old.alias("old_owner"), new.alias("new_owner")).withColumn(
        "moved", ~F.col("old_owner").eqNullSafe(F.col("new_owner"))
    )
