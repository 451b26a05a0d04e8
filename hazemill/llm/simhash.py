"""Near copies by SimHash, found by hashing balls of half the radius."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hazemill.llm.common import connected_components, map_rows, stored, unused

BITS = 64
#: Shingles of one text that are counted at a time; it bounds memory, not what is counted.
BLOCK = 1 << 18


def text_fingerprint(text: str | None, words: int = 3, seed: int = 42) -> int:
    """SimHash of the whole text as an unsigned number; 0 if it has no word.

    Words are runs without ASCII white space after lower-casing A-Z; a shingle is
    ``words`` of them joined by a space (all of them, if there are fewer), repeats count.
    """
    tokens = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not tokens:
        return 0
    count = max(1, len(tokens) - words + 1)
    digest, join = xxhash.xxh64_intdigest, b" ".join
    ones = np.zeros(BITS, dtype=np.int64)
    for start in range(0, count, BLOCK):
        stop = min(count, start + BLOCK)
        hashes = np.fromiter(
            (digest(join(tokens[i : i + words]), seed) for i in range(start, stop)),
            dtype="<u8",
            count=stop - start,
        )
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > count, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, words: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, bits``: the fingerprint of each row's whole text as a signed long."""

    def run(batches: Iterator[dict]) -> Iterator[dict]:
        for batch in batches:
            found = [text_fingerprint(t, words) for t in batch["text"].to_pylist()]
            yield {
                "doc_id": batch["doc_id"],
                "bits": np.array(found, dtype=np.uint64).view(np.int64).tolist(),
            }

    given = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")
    )
    return map_rows(given, run, "doc_id long, bits long")


def ball_links(nodes: DataFrame, radius: int = 2) -> DataFrame:
    """Links ``u, v`` that join all of ``nodes`` (``node, bits``; bits distinct) whose bits
    differ in at most ``radius`` places, which is 0 or 2.

    Every fingerprint emits itself and, for radius 2, its 64 neighbours at one flipped bit.
    Two fingerprints within the radius share a variant; those that share one are two flips
    apart at most, and no more than 65 can. So within a variant all are linked to the
    smallest node; links are deduplicated and their distance is verified.
    """
    if radius not in (0, 2):
        raise ValueError("balls of half the radius are built for radius 0 and 2")
    flips = f"transform(sequence(0, {BITS - 1}), i -> bits ^ shiftleft(1L, i))"
    variants = f"concat(array(bits), {flips})" if radius else "array(bits)"
    emitted = nodes.select("node", "bits", F.explode(F.expr(variants)).alias("variant"))
    first = F.min(F.struct("node", "bits")).over(Window.partitionBy("variant"))
    met = emitted.withColumn("first", first).filter("node != first.node")
    near = met.filter(F.expr(f"bit_count(bits ^ first.bits) <= {radius}"))
    return near.select(F.col("node").alias("u"), F.col("first.node").alias("v")).distinct()


def simhash_groups(
    docs: DataFrame, words: int = 3, radius: int = 2, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Near-copy groups of all documents: ``doc_id, fingerprint, component_id``.

    Two documents are linked if their fingerprints differ in ``radius`` bits or fewer, and
    a group is what links reach; ``component_id`` is its smallest ``doc_id``. Copies with
    one fingerprint become one node before anything is shuffled by variant, so a group of
    copies of any size costs no more than one document.

    One row per input row: repeated rows stay repeated, a null text is an empty one
    (fingerprint zero, linked like any other), a row without ``doc_id`` gets the group of
    its fingerprint and is never its name (null, if the group has no other). An empty table
    gives no rows. Other columns are not looked at.
    """
    marked = stored(fingerprints(docs, words, id_col, text_col), "simhash")
    nodes = marked.filter("doc_id is not null").groupBy("bits").agg(F.min("doc_id").alias("node"))
    nodes = stored(nodes, "simhash-nodes")
    links = ball_links(nodes, radius)
    found = connected_components(links, "simhash-links")
    named = nodes.join(found, "node", "left").select(
        "bits", F.coalesce("component", "node").alias("component_id")
    )
    return marked.join(named, "bits", "left").select(
        "doc_id", F.lower(F.lpad(F.hex("bits"), 16, "0")).alias("fingerprint"), "component_id"
    )


def drop_near_copies(docs: DataFrame, words: int = 3, radius: int = 2) -> DataFrame:
    """One document of each near-copy group, with all columns of ``docs``.

    The smallest ``doc_id`` of a group stays; of several rows with that id the one with the
    smallest text (a null one first). Rows without ``doc_id`` cannot be told apart and all
    stay. A null text is an empty one, an empty table gives no rows, other columns may have
    any name. Documents meet the ids that stay in a sort-merge join at every size, so that
    cost grows evenly and a skewed partition can be split.
    """
    groups = simhash_groups(docs, words, radius).filter("doc_id is not null")
    kept = groups.groupBy("doc_id").agg(
        F.count("*").alias("times"), F.max(F.expr("doc_id = component_id")).alias("stays")
    )
    kept = stored(kept.filter("stays").drop("stays"), "simhash-kept")
    out = docs.join(kept.filter("times = 1").select("doc_id").hint("merge"), "doc_id", "left_semi")
    repeated = kept.filter("times > 1").select("doc_id")
    if not repeated.isEmpty():
        order = Window.partitionBy("doc_id").orderBy(F.col("text").asc_nulls_first())
        at = unused(docs, "at")
        several = docs.join(repeated, "doc_id", "left_semi").withColumn(at, F.row_number().over(order))
        out = out.unionByName(several.filter(F.col(at) == 1).drop(at))
    return out.select(docs.columns).unionByName(docs.filter("doc_id is null"))
