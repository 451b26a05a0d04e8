"""Near copies among vectors: binary codes by iterative quantisation, multi-index Hamming
tables to retrieve, the vectors themselves to decide."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hazemill.llm.common import connected_components, map_rows, stored
from hazemill.llm.vectors import by_length, matrix, one_per_id, usable

BITS = 64
#: Vectors of each length that the rotation is learned from; every vector is indexed.
SAMPLE = 10_000
#: Substrings of a code, one table each. Two codes meet in a table if their substrings
#: differ in two bits or fewer. 16 bits suit some 100,000 vectors to a few million; more
#: vectors want fewer and longer substrings.
TABLES = 4
#: Codes further apart than this are not compared: cosine 0.9 differs in 9 bits, give or
#: take 3.
RADIUS = 20
#: Members of a bucket that are compared in one go; larger buckets are cut into chunks and
#: every pair of chunks is a group of its own.
CHUNK = 4_096


@dataclass
class Quantiser:
    """Rotation of one vector length. Nothing is subtracted before it: that would change
    the angles, which the codes are to keep."""

    rotation: np.ndarray

    def codes(self, unit: np.ndarray) -> np.ndarray:
        on = unit @ self.rotation > 0
        return np.packbits(on, axis=1, bitorder="little").view("<u8")[:, 0].view(np.int64)


def learn(unit: np.ndarray, rounds: int = 40, seed: int = 7) -> Quantiser:
    """Rotation that brings the principal directions close to the corners of a cube.

    Alternates between the nearest corners and the rotation that fits them best. Vectors
    with fewer components than bits get several rotations side by side.
    """
    rng = np.random.default_rng(seed)
    size = unit.shape[1]
    _, axes = np.linalg.eigh(unit.T @ unit)
    axes = axes[:, ::-1][:, :BITS]
    main = unit @ axes
    parts = []
    while sum(p.shape[1] for p in parts) < BITS:
        turn, _ = np.linalg.qr(rng.normal(size=(axes.shape[1], axes.shape[1])))
        for _ in range(rounds):
            corners = np.where(main @ turn > 0, 1.0, -1.0)
            u, _, v = np.linalg.svd(corners.T @ main)
            turn = (u @ v).T
        parts.append(axes @ turn)
    return Quantiser(np.hstack(parts)[:, :BITS].reshape(size, BITS))


def _unit(vectors: np.ndarray) -> np.ndarray:
    """Rows of length one; tiny and huge components are scaled first. Zero stays zero."""
    top = np.abs(vectors).max(axis=1, keepdims=True)
    scaled = vectors / np.where(top > 0, top, 1)
    norm = np.linalg.norm(scaled, axis=1, keepdims=True)
    return scaled / np.where(norm > 0, norm, 1)


def _learned(reps: DataFrame, sample: int) -> dict[int, Quantiser]:
    """A quantiser for each vector length, from a sample chosen by hash."""
    lengths = [r[0] for r in reps.select(F.size("embedding")).distinct().collect()]
    out = {}
    for n in lengths:
        rows = (
            reps.filter(F.size("embedding") == n).orderBy(F.xxhash64("node"), "node")
            .limit(sample).select("embedding").toArrow()
        )
        out[n] = learn(_unit(matrix(rows["embedding"].combine_chunks(), n)))
    return out


def _coded(reps: DataFrame, models: dict[int, Quantiser]) -> DataFrame:
    shared = reps.sparkSession.sparkContext.broadcast(models)

    def run(batches: Iterator[dict]) -> Iterator[dict]:
        for batch in batches:
            column = batch["embedding"]
            code, size = np.zeros(len(column), np.int64), np.zeros(len(column), np.int32)
            for n, at in by_length(column):
                code[at] = shared.value[n].codes(_unit(matrix(column.take(pa.array(at)), n)))
                size[at] = n
            yield {"node": batch["node"], "code": code, "size": size}

    return map_rows(reps.select("node", "embedding"), run, "node long, code long, size int")


def _emitted(coded: DataFrame, tables: int) -> DataFrame:
    """``bucket, node, code``: per table a code's substring and its one-bit neighbours."""
    width = BITS // tables
    rows = []
    for t in range(tables):
        sub = f"(shiftrightunsigned(code, {t * width}) & {(1 << width) - 1}L)"
        near = f"concat(array({sub}), transform(sequence(0, {width - 1}), i -> {sub} ^ shiftleft(1L, i)))"
        rows.append(f"transform({near}, v -> struct({t} as table, v as part))")
    return coded.select("node", "code", "size", F.explode(F.expr(f"concat({', '.join(rows)})")).alias("b")).select(
        "size", F.col("b.table").alias("table"), F.col("b.part").alias("part"), "node", "code"
    )


BUCKET = ["size", "table", "part", "low", "high"]


def _chunked(emitted: DataFrame) -> DataFrame:
    """Adds ``low, high, chunk``: the pair of chunks that a row is compared in."""
    keys = ["size", "table", "part"]
    hot = emitted.groupBy(*keys).agg(F.count("*").alias("n")).filter(F.col("n") > CHUNK)
    hot = stored(hot.withColumn("chunks", F.ceil(F.col("n") / CHUNK).cast("int")).drop("n"), "itq-hot")
    if hot.isEmpty():
        zero = F.lit(0).cast("int")
        return emitted.withColumns({"low": zero, "high": zero, "chunk": zero})
    dealt = emitted.join(hot, keys, "left").withColumn("chunks", F.coalesce("chunks", F.lit(1)))
    dealt = dealt.withColumn("chunk", F.expr("int(pmod(xxhash64(node), chunks))"))
    dealt = dealt.withColumn("other", F.explode(F.expr("sequence(0, chunks - 1)")))
    return dealt.withColumns({"low": F.least("chunk", "other"), "high": F.greatest("chunk", "other")}).drop(
        "chunks", "other"
    )


def _buckets(batches: Iterator[dict]) -> Iterator[dict]:
    """Whole buckets of a partition sorted by bucket, some batches at a time."""
    kept: dict | None = None
    for batch in batches:
        if kept is not None:
            batch = {k: pa.concat_arrays([kept[k], v]) for k, v in batch.items()}
        keys = np.stack([np.asarray(batch[k]) for k in BUCKET])
        new = np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1
        if len(new) == 0:
            kept = batch
            continue
        cut = int(new[-1])
        yield {k: v.slice(0, cut) for k, v in batch.items()}
        kept = {k: v.slice(cut) for k, v in batch.items()}
    if kept is not None:
        yield kept


def _close_pairs(batch: dict, tables: int, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Row numbers ``i, j`` of pairs within the radius, each pair in one bucket only: the
    first table in which the two meet and the smallest variant that they share there."""
    keys = np.stack([np.asarray(batch[k]) for k in BUCKET]).astype(np.int64)
    code = np.asarray(batch["code"]).view(np.uint64)
    chunk, table, part = np.asarray(batch["chunk"]), keys[1], keys[2].view(np.uint64)
    n, width = len(code), BITS // tables
    begins = np.flatnonzero(np.append(True, (keys[:, 1:] != keys[:, :-1]).any(axis=0)))
    bucket = np.repeat(np.arange(len(begins)), np.diff(np.append(begins, n)))
    last = np.append(begins[1:], n)[bucket]
    rows = np.arange(n)
    mask = np.uint64((1 << width) - 1)
    one = np.uint64(1)
    for step in range(1, int(np.diff(np.append(begins, n)).max(initial=1))):
        rows = rows[rows + step < last[rows]]
        if not len(rows):
            return
        i, j = rows, rows + step
        split = keys[3][i] != keys[4][i]
        far = np.bitwise_count(code[i] ^ code[j])
        good = (far <= radius) & ~(split & (chunk[i] == chunk[j]))
        i, j = i[good], j[good]
        for t in range(tables):  # no earlier table may have brought them together
            before = table[i] > t
            if before.any():
                apart = np.bitwise_count(((code[i] ^ code[j]) >> np.uint64(t * width)) & mask)
                i, j = i[~(before & (apart <= 2))], j[~(before & (apart <= 2))]
        shift = (table[i] * width).astype(np.uint64)
        a, b = (code[i] >> shift) & mask, (code[j] >> shift) & mask
        diff = a ^ b
        low = diff & (~diff + one)
        apart = np.bitwise_count(diff)
        middle = np.minimum(a ^ low, b ^ low)
        first = np.where(apart == 0, a, np.where(apart == 1, np.minimum(a, b), middle))
        mine = first == part[i]
        if mine.any():
            yield i[mine], j[mine]


def _joined(root: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Unites the sets of ``a`` and ``b`` pair by pair; ``root`` names each row's set."""
    while True:
        x, y = root[a], root[b]
        apart = x != y
        if not apart.any():
            return
        a, b = a[apart], b[apart]
        np.minimum.at(root, np.maximum(x, y)[apart], np.minimum(x, y)[apart])
        while (root[root] != root).any():
            root[:] = root[root]


def _members(dealt: DataFrame, tables: int, radius: int) -> DataFrame:
    """Rows of ``dealt`` that have a pair within the radius in their bucket."""

    def run(batches: Iterator[dict]) -> Iterator[dict]:
        for batch in _buckets(batches):
            found = np.zeros(len(batch["node"]), bool)
            for i, j in _close_pairs(batch, tables, radius):
                found[i] = found[j] = True
            keep = pa.array(np.flatnonzero(found))
            yield {k: v.take(keep) for k, v in batch.items()}

    sorted_ = dealt.repartition(*BUCKET).sortWithinPartitions(*BUCKET)
    names = "size int, table int, part long, node long, code long, low int, high int, chunk int"
    return map_rows(sorted_, run, names)


def _verified(members: DataFrame, reps: DataFrame, tables: int, radius: int, least: float) -> DataFrame:
    """``node, links, under``: links of a node found in one bucket, counted by weight, and
    the node that stands for all that links reach there."""

    def run(batches: Iterator[dict]) -> Iterator[dict]:
        for batch in _buckets(batches):
            node, weight = np.asarray(batch["node"]), np.asarray(batch["weight"])
            links, root = np.zeros(len(node), np.int64), np.arange(len(node))
            vectors = batch["embedding"]
            units = {}
            place = np.zeros(len(node), np.int64)
            for n, at in by_length(vectors):
                units[n] = _unit(matrix(vectors.take(pa.array(at)), n))
                place[at] = np.arange(len(at))
            size = np.asarray(batch["size"])
            for i, j in _close_pairs(batch, tables, radius):
                cosine = np.empty(len(i))
                for n, unit in units.items():
                    of = size[i] == n
                    cosine[of] = np.einsum("ij,ij->i", unit[place[i[of]]], unit[place[j[of]]])
                near = cosine >= least
                a, b = i[near], j[near]
                np.add.at(links, a, weight[b])
                np.add.at(links, b, weight[a])
                _joined(root, a, b)
            at = np.flatnonzero(links)
            yield {"node": node[at], "links": links[at], "under": node[root[at]]}

    full = members.join(reps.select("node", "embedding", "weight"), "node")
    sorted_ = full.repartition(*BUCKET).sortWithinPartitions(*BUCKET)
    return map_rows(sorted_, run, "node long, links long, under long")


def vector_groups(
    vectors: DataFrame, least: float = 0.9, tables: int = TABLES, radius: int = RADIUS,
    sample: int = SAMPLE, id_col: str = "vec_id", vector_col: str = "embedding",
) -> DataFrame:
    """``vec_id, n_links, component_id, kept``: vectors linked at cosine ``least`` or more.

    Equal vectors become one before anything is compared and count each other as links.
    Links are verified in double precision on the original vectors, so none is wrong; one
    is missed only if the two codes meet in no table or lie beyond ``radius`` (measured
    recall: see the README). A null, empty or zero vector or one with null or non-finite
    components links with nothing; so do vectors of different lengths with each other.
    Rows of one ``vec_id`` are one vector, rows without it are left out, an empty table
    gives no rows, other columns are not looked at.
    """
    if BITS % tables:
        raise ValueError("the number of tables must divide 64")
    given = stored(one_per_id(vectors, id_col, vector_col), "itq-vectors")
    zero = F.aggregate("embedding", F.lit(0.0), lambda s, x: F.greatest(s, F.abs(x.cast("double"))))
    good = given.filter(usable(F.col("embedding")) & (zero > 0))
    # -0.0 and 0.0 are one value to a grouping, as to a cosine.
    reps = good.groupBy("embedding").agg(F.min("vec_id").alias("node"), F.count("*").alias("weight"))
    reps = stored(reps, "itq-reps")
    members_of = good.join(
        reps.select(F.col("embedding"), "node", "weight"), "embedding"
    ).select("vec_id", "node", "weight")
    members_of = stored(members_of, "itq-copies")
    coded = stored(_coded(reps, _learned(reps, sample)), "itq-codes")
    dealt = _chunked(_emitted(coded, tables))
    members = stored(_members(dealt, tables, radius), "itq-members")
    found = stored(_verified(members, reps, tables, radius, least), "itq-links")
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    parts = connected_components(found.select("node", "under"), "itq-components")
    named = members_of.join(links, "node", "left").join(parts, "node", "left").select(
        "vec_id",
        (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"),
        F.coalesce("component", "node").alias("component_id"),
    )
    out = given.select("vec_id").join(named, "vec_id", "left").select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component_id", "vec_id").alias("component_id"),
    )
    return out.withColumn("kept", F.col("vec_id") == F.col("component_id"))
