"""The registered queries of this subpackage, and the SQL twins of those that have one."""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hazemill.llm import (
    bpe, html, itq, negatives, packing, pieces, pii, repair, secrets, sharding, simhash, topk, toxicity,
)
from hazemill.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]


def op1_itq(spark: SparkSession, sf_dir: str) -> DataFrame:
    return itq.vector_groups(table(spark, sf_dir, "embeddings"))


def op2_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.main_text(table(spark, sf_dir, "pages"))


def op3_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"), k=5, every=50)


def op4_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.find_secrets(table(spark, sf_dir, "documents"))


def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.json")
    return packing.pack_documents(table(spark, sf_dir, "documents"), path)


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_groups(table(spark, sf_dir, "documents"))


def op7_ring_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_rows(table(spark, sf_dir, "documents"), 24)


def op8_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("piece_bpe_32k.model")
    return pieces.encode_texts(table(spark, sf_dir, "documents"), path)


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find_pii(table(spark, sf_dir, "documents"))


def op11_four_russians(spark: SparkSession, sf_dir: str) -> DataFrame:
    relabelled = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.hard_negatives(table(spark, sf_dir, "embeddings"), relabelled)


def op12_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.json")
    texts = bpe.decode_ids(bpe.encode_texts(table(spark, sf_dir, "documents"), path), path)
    return texts.select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("text").cast("binary"), 256).alias("decoded_sha256"),
    )


def op13_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair.repair_conversations(repair.damage(table(spark, sf_dir, "conversations")))


def llm_queries() -> dict[str, Query]:
    return {
        "op1_itq": op1_itq,
        "op2_main_text": op2_main_text,
        "op3_top_k": op3_top_k,
        "op4_secrets": op4_secrets,
        "op5_best_fit_packing": op5_best_fit_packing,
        "op6_simhash": op6_simhash,
        "op7_ring_shards": op7_ring_shards,
        "op8_sentencepiece": op8_sentencepiece,
        "op9_toxicity": op9_toxicity,
        "op10_pii": op10_pii,
        "op11_four_russians": op11_four_russians,
        "op12_bpe": op12_bpe,
        "op13_repair": op13_repair,
        "pipeline": corpus_pipeline.run,
    }


_VECTORS = """
v AS (
    SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
    WHERE len(embedding) > 0
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
)"""

ITQ_SQL = f"""
WITH RECURSIVE {_VECTORS},
links AS (
    SELECT a.vec_id AS u, b.vec_id AS w FROM v a JOIN v b ON a.vec_id <> b.vec_id
    WHERE len(a.e) = len(b.e) AND list_dot_product(a.e, a.e) > 0 AND list_dot_product(b.e, b.e) > 0
      AND list_cosine_similarity(a.e, b.e) >= 0.9
),
reached AS (
    SELECT u, u AS w FROM links UNION
    SELECT reached.u, links.w FROM reached JOIN links ON links.u = reached.w
),
counted AS (SELECT u, count(*) AS n FROM links GROUP BY u),
named AS (SELECT u, min(w) AS c FROM reached GROUP BY u)
SELECT vec_id, coalesce(n, 0) AS n_links, coalesce(c, vec_id) AS component_id,
       vec_id = coalesce(c, vec_id) AS kept
FROM embeddings LEFT JOIN counted ON counted.u = vec_id LEFT JOIN named ON named.u = vec_id
"""

TOP_K_SQL = f"""
WITH {_VECTORS},
w AS (SELECT vec_id, list_transform(e, lambda x: floor(256 * x)) AS e FROM v),
scored AS (
    SELECT q.vec_id AS query_id, w.vec_id, CAST(list_dot_product(q.e, w.e) AS BIGINT) AS score
    FROM w q JOIN w ON w.vec_id <> q.vec_id AND len(w.e) = len(q.e) WHERE q.vec_id % 50 = 0
),
ranked AS (
    SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS r FROM scored
)
SELECT query_id, CAST(r AS INTEGER) AS rank, vec_id, score FROM ranked WHERE r <= 5
"""


NEGATIVES_SQL = """
WITH v AS (
    SELECT DISTINCT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
           list_transform(CAST(embedding AS DOUBLE[]), lambda x: floor(256 * x)) AS e
    FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(embedding) > 0
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
numbered AS (SELECT *, row_number() OVER (ORDER BY vec_id) AS n FROM v),
scored AS (
    SELECT a.n AS anchor, a.vec_id AS anchor_id, c.vec_id, c.label = a.label AS same,
           CAST(list_dot_product(a.e, c.e) AS BIGINT) AS score
    FROM numbered a JOIN numbered c ON len(a.e) = len(c.e) WHERE a.vec_id % 100 = 0
),
positives AS (
    SELECT *, row_number() OVER (PARTITION BY anchor ORDER BY score DESC, vec_id) AS place
    FROM scored WHERE same AND vec_id <> anchor_id
),
ranked AS (
    SELECT p.anchor_id, p.vec_id AS positive_id, s.vec_id AS negative_id, p.score AS positive_score,
           s.score AS negative_score,
           row_number() OVER (PARTITION BY p.anchor, p.place ORDER BY s.score DESC, s.vec_id) AS r
    FROM positives p JOIN scored s ON s.anchor = p.anchor AND NOT s.same
    WHERE p.place <= 5 AND 30 * p.score <= 100 * s.score AND 100 * s.score <= 90 * p.score
)
SELECT anchor_id, positive_id, CAST(r AS INTEGER) AS rank, negative_id, positive_score, negative_score
FROM ranked WHERE r <= 10
"""


def llm_oracle_sql() -> dict[str, str]:
    """Twins of the queries that SQL can express; the tests compare the others with
    brute-force versions."""
    given = {"op1_itq": ITQ_SQL, "op3_top_k": TOP_K_SQL, "op11_four_russians": NEGATIVES_SQL, "pipeline": corpus_pipeline.ORACLE_SQL}
    return {name: sql for name, sql in given.items() if sql}
