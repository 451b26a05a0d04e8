"""Exact top-k by inner product: statistics of segments, coarse to fine, bound the scores
of all candidates; exact products are computed for those that can still win."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hazemill.llm.common import stored
from hazemill.llm.vectors import one_per_id, usable

#: Vectors of a block; a task holds one block of candidates and one of queries.
BLOCK = 8_192
#: Queries that are looked at together.
AT_ONCE = 64
#: Segments per level, coarse to fine.
LEVELS = (1, 4, 16)


def statistics(vectors: np.ndarray, segments: int) -> np.ndarray:
    """Per row and segment ``sqrt(n) * mean`` and ``sqrt(n) * deviation``, side by side.

    For rows x and y, |x - y|^2 is at least the squared distance of these, segment by
    segment; so their product bounds the inner product of x and y from above.
    """
    out = []
    for part in np.array_split(vectors, min(segments, vectors.shape[1]), axis=1):
        n = part.shape[1]
        out += [part.mean(axis=1) * n**0.5, part.std(axis=1) * n**0.5]
    return np.stack(out, axis=1)


def search_block(
    queries: np.ndarray, query_ids: np.ndarray, vectors: np.ndarray, ids: np.ndarray, k: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each query's ``k`` best of a block: ``(row of query, row of vector, score)``.

    Integers in, exact scores out; a query's own id is no candidate; ties go to the
    smaller id.
    """
    # Ordered by id, so that the first of equal scores is the one that stays.
    order = np.argsort(ids, kind="stable")
    vectors, ids = vectors[order], ids[order]
    x, y = queries.astype(np.float64), vectors.astype(np.float64)
    levels = [(statistics(x, s), statistics(y, s)) for s in LEVELS]
    # What rounding may take from a bound.
    slack = 1e-9 * (np.abs(x).max(initial=0) + 1) * (np.abs(y).max(initial=0) + 1) * x.shape[1] + 1e-6
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    for first in range(0, len(queries), AT_ONCE):
        part = slice(first, first + AT_ONCE)
        own = query_ids[part, None] == ids[None, :]
        bounds = levels[0][0][part] @ levels[0][1].T
        for qs, vs in levels[1:2]:
            bounds = np.minimum(bounds, qs[part] @ vs.T)
        bounds[own] = -np.inf
        for row in range(bounds.shape[0]):
            q = first + row
            bound = bounds[row]
            some = np.argpartition(-bound, min(k, len(bound)) - 1)[:k]
            some = some[np.isfinite(bound[some])]
            if not len(some):
                continue
            least = (vectors[some] @ queries[q]).min() if len(some) == k else -np.inf
            alive = np.flatnonzero(bound >= least - slack)
            alive = alive[np.isfinite(bound[alive])]
            for qs, vs in levels[2:]:
                alive = alive[vs[alive] @ qs[q] >= least - slack]
            score = vectors[alive] @ queries[q]
            best = np.lexsort((alive, -score))[:k]
            found.append((np.full(len(best), q), order[alive[best]], score[best]))
    if not found:
        return tuple(np.zeros(0, np.int64) for _ in range(3))
    return tuple(np.concatenate(x) for x in zip(*found))


def top_k(
    vectors: DataFrame, k: int = 5, every: int = 50, scale: int = 256,
    id_col: str = "vec_id", vector_col: str = "embedding", block: int = BLOCK,
) -> DataFrame:
    """The ``k`` vectors with the highest inner product for every query.

    Components become ``floor(scale * x)``; queries are the rows whose id is divisible by
    ``every``, candidates all rows but the query's own. ``query_id, rank, vec_id, score``.

    Both sides are dealt into blocks by a hash of the id. A block of candidates meets each
    block of queries in one task; the blocks' winners are ranked once more. Null or empty
    vectors and those with null or non-finite components take no part; vectors of another
    length than the query's are no candidates. Rows of one id are one vector (the smallest),
    rows without id are left out, an empty table gives no rows.
    """
    given = one_per_id(vectors, id_col, vector_col).filter(usable(F.col("embedding")))
    whole = F.transform("embedding", lambda x: F.floor(x.cast("double") * scale).cast("long"))
    given = stored(given.select("vec_id", F.size("embedding").alias("size"), whole.alias("e")), "topk-vectors")
    asked = given.filter(F.col("vec_id") % every == 0)
    blocks = max(1, -(-given.count() // block))
    groups = max(1, -(-asked.count() // block))
    hashed = F.xxhash64("vec_id")
    left = given.withColumn("block", F.pmod(hashed, F.lit(blocks)).cast("int")).withColumn(
        "group", F.explode(F.sequence(F.lit(0), F.lit(groups - 1)))
    )
    right = asked.withColumn("group", F.pmod(hashed, F.lit(groups)).cast("int")).withColumn(
        "block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))
    )

    def search(candidates: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        parts = []
        for size in set(queries["size"]) & set(candidates["size"]):
            q = queries[queries["size"] == size]
            c = candidates[candidates["size"] == size]
            qid, cid = q["vec_id"].to_numpy(), c["vec_id"].to_numpy()
            i, j, score = search_block(np.stack(q["e"].to_numpy()), qid, np.stack(c["e"].to_numpy()), cid, k)
            parts.append(pd.DataFrame({"query_id": qid[i], "vec_id": cid[j], "score": score}))
        empty = pd.DataFrame({"query_id": [], "vec_id": [], "score": []}, dtype="int64")
        return pd.concat(parts) if parts else empty

    keys = ["size", "block", "group"]
    met = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(
        search, "query_id long, vec_id long, score long"
    )
    best = Window.partitionBy("query_id").orderBy(F.col("score").desc(), F.col("vec_id"))
    ranked = met.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
