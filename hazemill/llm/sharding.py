"""Shards by a consistent-hash ring with virtual nodes and bounded loads."""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hazemill.llm.common import stored

#: Places on the ring; what the driver plans with grows with this, not with the rows.
RING = 1 << 16
#: Virtual nodes of a shard: more of them send fewer keys past their first shard.
VIRTUAL = 256
#: Rows of one place are numbered in this many parts, should one key hold very many.
PARTS = 8


@dataclass(frozen=True)
class Move:
    """Rows of a place from rank ``first`` on go to ``shard``, numbered from ``base``."""

    place: int
    first: int
    shard: int
    base: int


def ring_nodes(shards: int, virtual: int = VIRTUAL, ring: int = RING) -> list[tuple[int, int]]:
    """``(place, shard)`` of every virtual node, clockwise. A node whose place is taken by
    an earlier shard tries another, so one more shard moves nothing between the others."""
    if shards * virtual > ring // 2:
        raise ValueError("the ring needs two places or more per virtual node")
    taken: dict[int, int] = {}
    for shard in range(shards):
        for copy in range(virtual):
            for attempt in range(ring):
                name = f"{shard}/{copy}/{attempt}".encode()
                place = int.from_bytes(hashlib.blake2b(name, digest_size=8).digest(), "little") % ring
                if place not in taken:
                    taken[place] = shard
                    break
            else:
                raise ValueError("no free place on the ring")
    return sorted(taken.items())


def plan_loads(counts: dict[int, int], shards: int, virtual: int = VIRTUAL, ring: int = RING) -> list[Move]:
    """Which ranks of each place go to which shard.

    A shard holds the mean at most, rounded up for as many shards as rows are left over:
    these loads add up to all rows, so every shard is filled exactly. First each shard
    takes keys of its own arcs, clockwise, until it is full; those it has no room for
    continue clockwise to the next virtual node of a shard with room.
    """
    total = sum(counts.values())
    room = [total // shards + (s < total % shards) for s in range(shards)]
    used = [0] * shards
    nodes = ring_nodes(shards, virtual, ring)
    owner, at = [0] * ring, 0
    for place in range(ring):  # the node at or after a place, around the ring
        while at < len(nodes) and nodes[at][0] < place:
            at += 1
        owner[place] = at % len(nodes)
    moves: list[Move] = []
    waiting: list[tuple[int, int, int]] = []
    for place in sorted(counts):
        shard = nodes[owner[place]][1]
        took = min(counts[place], room[shard] - used[shard])
        if took:
            moves.append(Move(place, 0, shard, used[shard]))
            used[shard] += took
        if took < counts[place]:
            waiting.append((place, took, counts[place] - took))
    ahead = list(range(len(nodes)))  # the next node with room, found along shortened paths

    def next_with_room(i: int) -> int:
        path = []
        while used[nodes[i][1]] >= room[nodes[i][1]]:
            path.append(i)
            step = ahead[i]
            i = step if step != i else (i + 1) % len(nodes)
        for j in path:
            ahead[j] = i
        return i

    for place, first, left in waiting:
        node = owner[place]
        while left:
            node = next_with_room(node)
            shard = nodes[node][1]
            took = min(left, room[shard] - used[shard])
            moves.append(Move(place, first, shard, used[shard]))
            used[shard] += took
            first, left = first + took, left - took
    return moves


def shard_rows(docs: DataFrame, shards: int = 24, virtual: int = VIRTUAL) -> DataFrame:
    """Every document's shard under the law ``rows``: counts differ by one at most.

    ``doc_id, size, text_crc32, law, shard, slot, grown_shard``; ``slot`` numbers a shard's
    rows without gaps, ``grown_shard`` is null, as a bounded load depends on all rows. A
    null text has size 8 and the checksum of nothing. Rows without ``doc_id`` are spread by
    their text; repeated rows get slots of their own. An empty table gives no rows; other
    columns are not looked at. Only numbers of rows per place reach the driver, and no text
    is shuffled.
    """
    spark = docs.sparkSession
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    measured = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.octet_length(text) + 8).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
    )
    key = F.when(F.col("doc_id").isNull(), F.xxhash64("text_crc32", "size")).otherwise(F.xxhash64("doc_id"))
    # The part is written down, so both uses below see the same one.
    placed = measured.withColumn("_place", F.pmod(key, F.lit(RING)).cast("int")).withColumn(
        "_part", F.pmod(F.spark_partition_id(), F.lit(PARTS))
    )
    placed = stored(placed, "shard-places")
    sizes = placed.groupBy("_place", "_part").agg(F.count("*").alias("_n"))
    before = Window.partitionBy("_place").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = stored(sizes.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0))), "shard-sizes")
    rows = sizes.groupBy("_place").agg(F.sum("_n").alias("n")).collect()
    moves = plan_loads({r["_place"]: r["n"] for r in rows}, shards, virtual)
    plan = spark.createDataFrame(
        [(m.place, m.first, m.shard, m.base) for m in moves],
        "_place int, _first long, shard int, _base long",
    )
    order = Window.partitionBy("_place", "_part").orderBy("doc_id", "size", "text_crc32")
    ranked = placed.withColumn("_rank", F.row_number().over(order) - 1)
    ranked = ranked.join(F.broadcast(sizes.select("_place", "_part", "_before")), ["_place", "_part"])
    ranked = ranked.withColumn("_rank", F.col("_rank") + F.col("_before"))
    ends = Window.partitionBy("_place").orderBy("_first")
    never = F.lit(1 << 62)
    spans = plan.withColumn("_next", F.coalesce(F.lead("_first").over(ends), never))
    met = ranked.join(F.broadcast(spans), "_place").filter("_rank >= _first and _rank < _next")
    return met.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard",
        (F.col("_base") + F.col("_rank") - F.col("_first")).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
