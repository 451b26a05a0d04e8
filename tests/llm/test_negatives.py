"""Hard negatives against a brute-force version."""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import functions as F

from hazemill.llm import negatives
from hazemill.llm.queries import llm_queries

SCHEMA = "vec_id long, label int, embedding array<double>, row int, block string, place int, packed int"


def brute(rows, positives=5, count=10):
    rows = {
        (i, (lab + 1) % 10 if i % 7 == 0 else lab, tuple(math.floor(256 * x) for x in v))
        for i, lab, v in rows
        if i is not None and lab is not None and v and all(x is not None and math.isfinite(x) for x in v)
    }
    out = []
    for anchor in rows:
        if anchor[0] % 100:
            continue
        scored = sorted(
            ((-sum(a * b for a, b in zip(anchor[2], v)), i, lab) for i, lab, v in rows if len(v) == len(anchor[2])), key=lambda s: s[:2]
        )
        for score, positive, _ in [s for s in scored if s[2] == anchor[1] and s[1] != anchor[0]][:positives]:
            fits = [s for s in scored if s[2] != anchor[1] and 30 * -score <= 100 * -s[0] <= 90 * -score]
            out += [(anchor[0], positive, r, s[1], -score, -s[0]) for r, s in enumerate(fits[:count], 1)]
    return sorted(out)


def test_planes_are_exact():
    rng = np.random.default_rng(0)
    for size in (1, 7, 8, 20, 64):
        anchors = rng.integers(-500, 500, (200, size))
        rows = rng.integers(-2000, 2000, (1500, size))
        rows[:200] //= 100
        for some, packed in negatives.pack_planes(rows):
            assert (negatives.unpack_planes(packed, size) == rows[some]).all()
            assert (negatives.scores(anchors, packed) == rows[some] @ anchors.T).all()
    huge = np.array([[2**62, -(2**63)], [2**63 - 1, 5], [0, 0]])
    for some, packed in negatives.pack_planes(huge):
        assert (negatives.unpack_planes(packed, 2) == huge[some]).all()
        assert (negatives.scores(huge, packed) == (huge[some][:, None] * huge[None]).sum(axis=2)).all()


def test_subset_sums():
    sums = negatives.subset_sums(np.array([[1, 2, 4, 8, 16, 32, 64, 128, -3]]), 2, np.dtype(np.int64))
    assert sums[0, :, 0].tolist() == list(range(256)) and set(sums[1, :, 0].tolist()) == {0, -3}


def test_hard_negatives(spark):
    rng = np.random.default_rng(1)
    rows = [(i, int(rng.integers(0, 3)) if i % 3 else 4, [float(x) for x in rng.normal(0.4, 0.3, 12)]) for i in range(700)]
    rows += [(1000 + i, 4, rows[i % 5 * 100][2]) for i in range(40)]  # ties and copies of anchors
    rows += [(5000, None, rows[0][2]), (5100, 1, None), (5200, 1, [float("nan")] * 12), (5300, 1, [None] * 12), (5400, 1, [])]
    rows += [(None, 1, rows[0][2]), (300, *rows[300][1:]), (300, 2, rows[301][2]), (400, 1, [1.0, -2.0]), (401, 1, [3.0, 1.0]), (402, 2, [2.5, 1.0])]
    rows += [(6000, 9, [0.0] * 12), (6100, 9, [0.0] * 12), (6200, 8, [-1.0] * 12), (6201, 8, [1.0] * 12), (7000, 77, rows[3][2])]
    df = spark.createDataFrame([(*r, 1, "x", 2, 3) for r in rows], SCHEMA)
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    want = brute(rows)
    assert len(want) > 100
    for block in (8192, 61):
        assert sorted(tuple(r) for r in negatives.hard_negatives(df, label, block=block).collect()) == want
    assert negatives.hard_negatives(spark.createDataFrame([], SCHEMA)).count() == 0
    assert negatives.hard_negatives(df.filter("vec_id % 100 <> 0"), label).count() == 0


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/embeddings.parquet").select("vec_id", "label", "embedding").collect()]
    assert sorted(tuple(r) for r in llm_queries()["op11_four_russians"](spark, sf).collect()) == brute(rows)
