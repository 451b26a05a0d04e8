"""Reading, storing and linking, shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hazemill.session import shared_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written once to the shared folder and read back: what follows neither
    computes it again nor depends on the executors that made it."""
    path = shared_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def unused(df: DataFrame, name: str) -> str:
    """``name``, with as many underscores before it as no column of ``df`` needs."""
    taken = {column.lower() for column in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def map_rows(df: DataFrame, rows: Callable[[Iterator[dict]], Iterator[dict]], schema: str) -> DataFrame:
    """``rows`` over the columns of each Arrow batch; it yields dictionaries of lists."""
    arrow: dict[str, pa.DataType] = {}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def columns() -> Iterator[dict]:
            for batch in batches:
                if batch.num_rows:
                    yield {name: batch.column(i) for i, name in enumerate(batch.schema.names)}

        for out in rows(columns()):
            fields = [pa.field(name, kind) for name, kind in arrow.items()]
            arrays = [
                value.cast(kind) if isinstance(value, pa.Array) else pa.array(value, kind)
                for value, kind in ((out[name], kind) for name, kind in arrow.items())
            ]
            yield pa.RecordBatch.from_arrays(arrays, schema=pa.schema(fields))

    kinds = {
        "long": pa.int64(), "int": pa.int32(), "double": pa.float64(), "string": pa.string(),
        "boolean": pa.bool_(), "binary": pa.binary(), "array<long>": pa.list_(pa.int64()),
        "array<string>": pa.list_(pa.string()),
    }
    for field in schema.split(","):
        name, kind = field.split()
        arrow[name] = kinds[kind]
    return df.mapInArrow(run, schema)


def _mark(edges: DataFrame) -> tuple:
    """Equal marks mean equal edge sets: count and a sum of hashes cut to stay in range."""
    row = edges.agg(F.count("*"), F.sum(F.shiftright(F.xxhash64("u", "v"), 24))).first()
    return tuple(row)


def connected_components(edges: DataFrame, label: str) -> DataFrame:
    """Component of every node of an undirected edge list.

    ``edges`` has two long columns, in any order and direction. Returns
    ``node, component``, component being the smallest node reachable; nodes of loops
    alone and null ends are left out. Star contraction: every round hangs a node's larger
    neighbours, then its smaller ones, under the smallest of them. Each round reduces
    before it shuffles (a minimum per node), is written to the shared folder, and no node's
    neighbours are ever gathered in one place. Rounds grow with the logarithm of the
    longest chain.
    """
    left, right = edges.columns[:2]
    pairs = edges.select(
        F.greatest(left, right).alias("u"), F.least(left, right).alias("v")
    ).filter(F.col(left).isNotNull() & F.col(right).isNotNull() & (F.col(left) != F.col(right)))
    now = stored(pairs.distinct(), label)
    mark = _mark(now)
    while mark[0]:
        both = now.unionAll(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m"))
        least = least.select("u", F.least("u", "m").alias("m"))
        large = (
            both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        ).distinct()
        large = stored(large, label)
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u")
        small = small.select(F.col("v").alias("u"), F.col("m").alias("v")).unionAll(
            least.select("u", F.col("m").alias("v"))
        )
        now = stored(small.filter("u != v").distinct(), label)
        before, mark = mark, _mark(now)
        if mark == before:
            break
    hung = now.select(F.col("u").alias("node"), F.col("v").alias("component"))
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return hung.unionAll(roots)
