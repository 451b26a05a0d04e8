"""Lookups of a dimension table: broadcast once its size is measured, hot keys salted beyond."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hazemill.functions.checks import spec_columns
from hazemill.operators.quality import dedup
from hazemill.schemas import MEASUREMENT, STATION

SALTS = 32
#: A key that this share of the facts has is hot; there are no more such keys than that.
HOT = 1 / 64
_DEFAULT_LIMIT = 10 * 1024 * 1024


def _broadcast_limit(df: DataFrame) -> int:
    text = df.sparkSession.conf.get("spark.sql.autoBroadcastJoinThreshold", str(_DEFAULT_LIMIT))
    units = {"k": 2**10, "m": 2**20, "g": 2**30}
    number = text.lower().rstrip("b")
    if number and number[-1] in units:
        return int(number[:-1]) * units[number[-1]]
    return int(number)


#: Sizes found in this process, by plan and size of the files it reads.
_measured: dict[tuple[int, str], int | None] = {}


def _row_bytes(df: DataFrame) -> Column:
    """What a row takes in memory: a word per column, and the contents of the others."""
    total = F.lit(16 + 8 * len(df.columns)).cast("bigint")
    for f in df.schema:
        column = F.col(f"`{f.name}`")
        kind = f.dataType.typeName()
        if kind in ("string", "binary", "varchar", "char"):
            total = total + F.coalesce(F.octet_length(column), F.lit(0)) + 8
        elif kind in ("array", "map", "struct", "variant"):
            total = total + 3 * F.coalesce(F.octet_length(F.to_json(F.struct(column))), F.lit(0)) + 16
        elif kind == "decimal":
            total = total + 16
    return total


def measured_size(df: DataFrame, limit: int) -> int | None:
    """Bytes that the rows of a table take in memory, None if more than ``limit``.

    Counted, not estimated: a compressed file says little of what is in it. Counting stops at
    the number of rows that would exceed the limit even if they were empty. A table is
    counted once as long as its plan and its files' size stay the same.
    """
    if limit < 0 or df.isStreaming:
        return None
    plan = df._jdf.queryExecution().optimizedPlan()
    known = (df.semanticHash(), f"{plan.stats().sizeInBytes()}/{limit}")
    if known not in _measured:
        most = limit // (16 + 8 * max(len(df.columns), 1)) + 1
        size = df.limit(most).agg(F.coalesce(F.sum(_row_bytes(df)), F.lit(0))).first()[0]
        _measured[known] = size if size <= limit else None
    return _measured[known]


def hot_keys(facts: DataFrame, keys: Sequence[str], share: float = HOT) -> list[int]:
    """Hashes of the keys that ``share`` of the facts or more have, from a sketch of fixed size
    over the key columns alone."""
    most = int(1 / share)
    sketch = F.expr(f"approx_top_k(_hash, {most}, {64 * most})")
    found = facts.select(F.xxhash64(*keys).alias("_hash")).agg(F.count(F.lit(1)), sketch).first()
    total, items = found[0], found[1] or []
    return [item["item"] for item in items if item["count"] >= share * total]


def join_dimension(
    facts: DataFrame,
    dimension: DataFrame,
    on: str | Sequence[str],
    how: str = "inner",
    salts: int = SALTS,
) -> DataFrame:
    """Join each fact with its (unique) dimension row.

    A dimension that is measured to be within ``spark.sql.autoBroadcastJoinThreshold`` is
    broadcast, and no fact moves. With any other one a sketch of the facts' keys finds the hot
    ones: those rows, and only those, are replicated ``salts`` times and joined on the key and
    a salt, so that a key holding a third of all facts is spread over ``salts`` tasks. The
    keys of a stream of facts cannot be looked at beforehand; all of them are salted.

    The salt is a hash of the fact's other columns and of its input partition: copies
    of one fact are spread too, and a task that is run again sends every row the same
    way, which a random salt would not.
    """
    if how not in ("inner", "left", "left_semi"):
        raise ValueError(f"unsupported lookup join: {how!r}")
    keys = [on] if isinstance(on, str) else list(on)
    if measured_size(dimension, _broadcast_limit(facts)) is not None:
        return facts.join(F.broadcast(dimension), keys, how)
    hot = None if facts.isStreaming else hot_keys(facts, keys)
    if hot == []:
        return facts.join(dimension, keys, how)
    is_hot = F.lit(True) if hot is None else F.xxhash64(*keys).isin(hot)
    spread = F.xxhash64(F.spark_partition_id(), *(c for c in facts.columns if c not in keys))
    salt = F.when(is_hot, F.pmod(spread, F.lit(salts)).cast("int")).otherwise(0)
    salted = facts.withColumn("_salt", salt)
    every = F.when(is_hot, F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    copies = dimension.withColumn("_salt", F.explode(every))
    return salted.join(copies, [*keys, "_salt"], how).drop("_salt")


def enrich_with_station(readings: DataFrame, stations: DataFrame) -> DataFrame:
    """Measurements from readings that carry only a station id.

    A reading of a station missing from the catalogue is skipped. Of several catalogue
    rows with one id a fixed one is used, so readings are never multiplied.
    """
    catalogue = dedup(stations.select(*STATION.fieldNames()), ["location_id"])
    own = [c for c in readings.columns if c == "location_id" or c not in STATION.fieldNames()]
    joined = join_dimension(readings.select(*own), catalogue, "location_id")
    extra = [c for c in own if c not in MEASUREMENT.fieldNames()]
    return joined.select(*MEASUREMENT.fieldNames(), *extra)


def with_spec(
    df: DataFrame, specs: DataFrame | None = None, parameter: str = "parameter"
) -> DataFrame:
    """Add ``expected_unit, min_value, max_value`` of the pollutant; NULL if unknown.

    The built-in rules are a CASE expression (no join). A table of other rules with
    the columns ``parameter, expected_unit, min_value, max_value`` is looked up.
    """
    if specs is None:
        return df.withColumns(spec_columns(f"`{parameter}`"))
    rules = specs.select(
        F.col("parameter").alias(parameter), "expected_unit", "min_value", "max_value"
    )
    joined = join_dimension(df, dedup(rules, [parameter]), parameter, "left")
    return joined.select(*df.columns, "expected_unit", "min_value", "max_value")
