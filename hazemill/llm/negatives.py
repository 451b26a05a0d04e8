"""Hard negatives by Four-Russians scoring: sums of every subset of eight components of an
anchor are tabulated once, and a candidate's bit planes, packed to bytes, look them up."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hazemill.llm.common import map_rows, stored
from hazemill.llm.vectors import by_length, matrix, usable

#: Vectors of a block; a task holds one block of candidates and one of anchors.
BLOCK = 8_192
#: Anchors and candidates that are scored together, so that the tables stay in the cache.
ANCHORS_AT_ONCE, CANDIDATES_AT_ONCE = 128, 1_024
#: Parts that labels are hashed into when anchors meet the rows of their own label.
CELLS = 64


def pack_planes(values: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """Bit planes of integer rows in two's complement: ``(rows, bytes)`` per number of planes.

    ``bytes[i, b, g]`` has bit b of the eight components of group g; the last plane is the
    sign's. Every row has as many planes as its own components need.
    """
    large = np.abs(values ^ (values >> 63)).max(axis=1, initial=0)
    need = 1 + sum(((large >> b) > 0).astype(np.int64) for b in range(63))
    out = []
    for planes in np.unique(need):
        rows = np.flatnonzero(need == planes)
        bits = (values[rows, None, :] >> np.arange(planes)[None, :, None]) & 1
        out.append((rows, np.packbits(bits.astype(np.uint8), axis=2, bitorder="little")))
    return out


def unpack_planes(packed: np.ndarray, size: int) -> np.ndarray:
    """The integer rows that ``pack_planes`` packed."""
    bits = np.unpackbits(packed, axis=2, bitorder="little")[:, :, :size].astype(np.int64)
    weights = np.int64(1) << np.arange(packed.shape[1])
    weights[-1] = -(1 << (packed.shape[1] - 1))
    return (bits * weights[None, :, None]).sum(axis=1)


def subset_sums(anchors: np.ndarray, groups: int, kind: np.dtype) -> np.ndarray:
    """``sums[g, byte, a]``: anchor a's components of group g that the byte's bits choose."""
    padded = np.zeros((len(anchors), groups * 8), np.int64)
    padded[:, : anchors.shape[1]] = anchors
    sums = np.zeros((groups, 256, len(anchors)), kind)
    for g in range(groups):
        for bit in range(8):
            step = 1 << bit
            sums[g, step : 2 * step] = sums[g, :step] + padded[:, 8 * g + bit].astype(kind)
    return sums


def scores(anchors: np.ndarray, packed: np.ndarray) -> np.ndarray:
    """Exact inner products of every candidate (rows) with every anchor (columns).

    From the sign plane down the sum so far is doubled and the plane's lookups are added;
    products beyond 64 bits are taken modulo 2^64.
    """
    n, planes, groups = packed.shape
    largest = float(np.abs(anchors.astype(np.float64)).sum(axis=1).max(initial=0)) * 2.0**planes
    kind = np.dtype(np.int32 if largest < 2**31 else np.int64)
    out = np.empty((n, len(anchors)), np.int64)
    for a in range(0, len(anchors), ANCHORS_AT_ONCE):
        sums = subset_sums(anchors[a : a + ANCHORS_AT_ONCE], groups, kind)
        width = sums.shape[2]
        for c in range(0, n, CANDIDATES_AT_ONCE):
            part = packed[c : c + CANDIDATES_AT_ONCE].astype(np.intp)
            total, looked = (np.zeros((len(part), width), kind) for _ in range(2))
            for b in range(planes - 1, -1, -1):
                total += total
                for g in range(groups):
                    np.take(sums[g], part[:, b, g], axis=0, out=looked, mode="clip")
                    if b == planes - 1:
                        total -= looked
                    else:
                        total += looked
            out[c : c + CANDIDATES_AT_ONCE, a : a + width] = total
    return out


class _Block:
    """Rows of one block, by number of components; candidates in the order of their ids."""

    def __init__(self, rows: pa.Table) -> None:
        rows = rows.combine_chunks()
        self.id, self.label, self.size, self.planes = (
            rows.column(name).to_numpy() for name in ("vec_id", "label", "size", "planes")
        )
        self.packed = rows.column("packed")
        self.rows = rows

    def bytes_of(self, rows: np.ndarray, size: int, planes: int) -> np.ndarray:
        joined = b"".join(self.packed[int(i)].as_py() for i in rows)
        return np.frombuffer(joined, np.uint8).reshape(len(rows), planes, -(-size // 8))

    def integers(self, rows: np.ndarray, size: int) -> np.ndarray:
        out = np.empty((len(rows), size), np.int64)
        for planes in np.unique(self.planes[rows]):
            some = np.flatnonzero(self.planes[rows] == planes)
            out[some] = unpack_planes(self.bytes_of(rows[some], size, int(planes)), size)
        return out


def _scored(candidates: _Block, anchors: _Block) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """``anchor row, candidate rows by id, their scores`` of every anchor."""
    for size in np.intersect1d(candidates.size, anchors.size):
        mine = np.flatnonzero(anchors.size == size)
        for first in range(0, len(mine), ANCHORS_AT_ONCE):
            some = mine[first : first + ANCHORS_AT_ONCE]
            values = anchors.integers(some, int(size))
            theirs, found = [], []
            for planes in np.unique(candidates.planes[candidates.size == size]):
                rows = np.flatnonzero((candidates.size == size) & (candidates.planes == planes))
                theirs.append(rows)
                found.append(scores(values, candidates.bytes_of(rows, int(size), int(planes))))
            rows, table = np.concatenate(theirs), np.concatenate(found)
            order = np.argsort(candidates.id[rows], kind="stable")
            rows, table = rows[order], table[order].T.copy()
            for i, anchor in enumerate(some):
                yield int(anchor), rows, table[i]


def _first(score: np.ndarray, k: int) -> np.ndarray:
    """Places of the ``k`` highest scores, of equal ones the earlier first."""
    if len(score) > 4 * k:
        least = np.partition(score, len(score) - k)[len(score) - k]
        some = np.flatnonzero(score >= least)
        return some[np.argsort(-score[some], kind="stable")[:k]]
    return np.argsort(-score, kind="stable")[:k]


def _dealt(rows: DataFrame, anchors: DataFrame, cell: Column, cells: int, block: int):
    """Both sides of a meeting of every anchor with every row of its cell, in blocks: a block
    of rows is copied once per block of anchors of its cell and the other way round."""
    counts = [[0, 0] for _ in range(cells)]
    for side, given in enumerate((rows, anchors)):
        for row in given.groupBy(cell.alias("cell")).count().collect():  # at most ``cells`` rows
            counts[row["cell"]][side] = row["count"]

    def parts(side: int) -> Column:
        return F.element_at(F.array(*(F.lit(-(-c[side] // block)) for c in counts)), F.col("cell") + 1)

    spread = F.xxhash64("vec_id", "packed")
    left = rows.withColumn("cell", cell).filter(parts(1) > 0)
    left = left.withColumn("block", F.pmod(spread, parts(0)).cast("int"))
    left = left.withColumn("other", F.explode(F.sequence(F.lit(0), parts(1) - 1)))
    right = anchors.withColumn("cell", cell).filter(parts(0) > 0)
    right = right.withColumn("other", F.pmod(spread, parts(1)).cast("int"))
    right = right.withColumn("block", F.explode(F.sequence(F.lit(0), parts(0) - 1)))
    keys = ["cell", "block", "other"]
    return left.groupBy(*keys).cogroup(right.groupBy(*keys))


def packed_vectors(vectors: DataFrame, scale: int, id_col: str, vector_col: str, label: Column) -> DataFrame:
    """``vec_id, label, size, planes, packed``: ``floor(scale * x)`` of every usable vector
    with id and label, as bit planes; equal rows are one."""

    def run(batches: Iterator[dict]) -> Iterator[dict]:
        for batch in batches:
            ids, labels = (np.asarray(batch[k].to_numpy(zero_copy_only=False)) for k in ("vec_id", "label"))
            column = batch["embedding"]
            for size, rows in by_length(column):
                whole = np.floor(matrix(column.take(pa.array(rows)), size) * scale)
                # Beyond a long the nearest one counts.
                values = np.where(whole >= 2.0**63, np.iinfo(np.int64).max, 0)
                inside = np.abs(whole) < 2.0**63
                values[inside] = whole[inside].astype(np.int64)
                values[whole <= -(2.0**63)] = np.iinfo(np.int64).min
                for some, packed in pack_planes(values):
                    yield {
                        "vec_id": ids[rows[some]], "label": labels[rows[some]],
                        "size": np.full(len(some), size), "planes": np.full(len(some), packed.shape[1]),
                        "packed": [row.tobytes() for row in packed],
                    }

    given = vectors.select(
        F.col(id_col).cast("long").alias("vec_id"), label.cast("long").alias("label"),
        F.col(vector_col).cast("array<double>").alias("embedding"),
    )
    given = given.filter(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & usable(F.col("embedding")))
    return map_rows(given, run, "vec_id long, label long, size int, planes int, packed binary").distinct()


def hard_negatives(
    vectors: DataFrame, label: Column | None = None, positives: int = 5, negatives: int = 10,
    every: int = 100, low: int = 30, high: int = 90, scale: int = 256,
    id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", block: int = BLOCK,
) -> DataFrame:
    """Hard negatives of every anchor and positive:
    ``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    Components become ``floor(scale * x)``, a score is the inner product of two such rows;
    higher scores come first, ties by smaller id. Anchors are the rows whose id is divisible
    by ``every``; an anchor's positives are its first rows of another id and the same label
    (``label`` computes one from the columns); its negatives the first rows of another label
    with ``low`` to ``high`` percent of the positive's score, both ends included.

    Anchors meet the rows of their label first and then all rows, each time in blocks of
    both sides that one task scores; a label that most rows have is many blocks. Only first
    places leave a block. Rows with a null id, label or vector, an empty vector, or a null or
    non-finite component take no part; vectors of different lengths never meet. Rows equal
    in id, label and integers are one; other rows of one id are rows of their own. An empty
    table gives no rows; other columns are not looked at.
    """
    given = packed_vectors(vectors, scale, id_col, vector_col, F.col(label_col) if label is None else label)
    given = stored(given, "negatives-rows")
    anchors = given.filter(F.col("vec_id") % every == 0).withColumn("row", F.xxhash64("label", "packed"))

    def nearest(rows: pa.Table, asked: pa.Table) -> pa.Table:
        candidates, queries = _Block(rows), _Block(asked)
        row = asked.column("row").to_numpy()
        out: list[list] = [[], [], [], []]
        for anchor, theirs, score in _scored(candidates, queries):
            same = (candidates.label[theirs] == queries.label[anchor]) & (candidates.id[theirs] != queries.id[anchor])
            theirs, score = theirs[same], score[same]
            best = _first(score, positives)
            for values, found in zip(out, ([queries.id[anchor]] * len(best), [row[anchor]] * len(best), candidates.id[theirs[best]], score[best])):
                values.append(np.asarray(found, np.int64))
        return _table(out, ("anchor_id", "row", "positive_id", "positive_score"))

    label_cell = F.pmod(F.xxhash64("label"), F.lit(CELLS)).cast("int")
    met = _dealt(given, anchors, label_cell, CELLS, block).applyInArrow(
        nearest, "anchor_id long, row long, positive_id long, positive_score long"
    )
    best = Window.partitionBy("anchor_id", "row").orderBy(F.col("positive_score").desc(), "positive_id")
    met = met.withColumn("place", F.row_number().over(best)).filter(F.col("place") <= positives)
    chosen = F.sort_array(F.collect_list(F.struct("place", "positive_id", "positive_score")))
    chosen = met.groupBy("anchor_id", "row").agg(chosen.alias("chosen"))
    chosen = chosen.select(
        F.col("anchor_id").alias("vec_id"), "row", F.col("chosen.positive_id").alias("positive_ids"),
        F.col("chosen.positive_score").alias("positive_scores"),
    )
    asking = stored(anchors.join(chosen, ["vec_id", "row"]), "negatives-anchors")

    def between(rows: pa.Table, asked: pa.Table) -> pa.Table:
        candidates, queries = _Block(rows), _Block(asked)
        row = asked.column("row").to_numpy()
        ids, values = asked.column("positive_ids").to_pylist(), asked.column("positive_scores").to_pylist()
        out: list[list] = [[] for _ in range(7)]
        for anchor, theirs, score in _scored(candidates, queries):
            other = candidates.label[theirs] != queries.label[anchor]
            theirs, score = theirs[other], score[other]
            ends = [(-(-low * p // 100), high * p // 100) for p in values[anchor]]
            widest = [e for e in ends if e[0] <= e[1]]
            if not widest:
                continue
            some = (score >= min(e[0] for e in widest)) & (score <= max(e[1] for e in widest))
            theirs, score = theirs[some], score[some]
            order = np.argsort(-score, kind="stable")
            theirs, score = theirs[order], score[order]
            for place, (least, most) in enumerate(ends):
                if least > most:
                    continue
                start = np.searchsorted(-score, -most, "left")
                stop = min(start + negatives, np.searchsorted(-score, -least, "right"))
                n = max(0, stop - start)
                for column, found in zip(out, (
                    [queries.id[anchor]] * n, [row[anchor]] * n, [place] * n, [ids[anchor][place]] * n,
                    [values[anchor][place]] * n, candidates.id[theirs[start:stop]], score[start:stop],
                )):
                    column.append(np.asarray(found, np.int64))
        return _table(out, ("anchor_id", "row", "place", "positive_id", "positive_score", "negative_id", "negative_score"))

    met = _dealt(given, asking, F.lit(0), 1, block).applyInArrow(
        between,
        "anchor_id long, row long, place long, positive_id long, positive_score long, negative_id long, negative_score long",
    )
    best = Window.partitionBy("anchor_id", "row", "place").orderBy(F.col("negative_score").desc(), "negative_id")
    ranked = met.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= negatives)
    return ranked.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def _table(columns: list[list], names: tuple[str, ...]) -> pa.Table:
    arrays = [np.concatenate(c) if c else np.zeros(0, np.int64) for c in columns]
    return pa.table([pa.array(a, pa.int64()) for a in arrays], names=list(names))
