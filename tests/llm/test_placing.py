"""Packing, sharding, top-k search and the pipeline."""

from __future__ import annotations

import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers

import corpus_pipeline
from hazemill.llm import packing, pii, sharding, simhash, topk
from hazemill.llm.queries import llm_oracle_sql, llm_queries
from hazemill.llm.tokens import ByteLevelEncoder
from tests import compare

DOCS = "doc_id long, text string, length string"
PATH = public_tokenizers.path("byte_bpe_50k.json")


def check_packed(rows, size):
    at = defaultdict(list)
    for r in rows:
        at[r.sequence_id].append((r.offset, r.length))
    for spans in at.values():
        end = 0
        for offset, length in sorted(spans):
            assert offset == end
            end += length
        assert end <= size
    return len(at)


def test_packing(spark):
    text = " ".join(f"word{i}" for i in range(700))
    rows = [(i, text[: (37 * i * i) % 4800], "x") for i in range(150)] + [(7, text[:1813], "x"), (None, None, "x"), (999, "", "x")]
    got = packing.pack_documents(spark.createDataFrame(rows, DOCS), PATH, size=128).collect()
    encoder = ByteLevelEncoder(PATH)
    want = Counter()
    for i, t, _ in rows:
        ids = np.append(np.frombuffer(encoder.encode_bytes(t or ""), "<u4"), 0).astype("<u4")
        first = len(ids) % 128 or min(128, len(ids))
        cuts = [0, *range(first, len(ids) + 1, 128)]
        for piece, (a, b) in enumerate(zip(cuts, cuts[1:])):
            want[i, piece, a, b - a, zlib.crc32(ids[a:b].tobytes())] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == want
    used = check_packed(got, 128)
    assert used <= math.ceil(sum(r.length for r in got) / 128) * 1.02 + 1
    assert packing.pack_documents(spark.createDataFrame([], DOCS), PATH).count() == 0


def test_fill_uses_complements_first():
    counts = np.zeros(11, int)
    counts[[10, 7, 3, 5, 2, 4]] = [2, 3, 3, 4, 2, 1]
    made = packing._fill(counts, 10)
    assert made[:3] == [([10], 2), ([7, 3], 3), ([5, 5], 2)]
    placed = Counter()
    for lengths, times in made:
        assert sum(lengths) <= 10
        for n in lengths:
            placed[n] += times
    assert placed == {n: c for n, c in enumerate(counts) if c}


def test_fill_places_everything_at_any_count():
    rng = np.random.default_rng(0)
    for _ in range(30):
        size = int(rng.integers(1, 60))
        counts = np.zeros(size + 1, int)
        counts[1:] = rng.integers(0, 2000, size) * (rng.random(size) < rng.random())
        made = packing._fill(counts, size)
        placed = Counter()
        for lengths, times in made:
            assert sum(lengths) <= size and times > 0
            for n in lengths:
                placed[n] += times
        assert placed == {n: c for n, c in enumerate(counts) if c}
        assert len(packing._places(made)) <= 40 * size


def brute_ring(keys, shards, virtual, ring):
    """One key after another: first own arcs, then clockwise past full shards."""
    room = [len(keys) // shards + (s < len(keys) % shards) for s in range(shards)]
    nodes = sharding.ring_nodes(shards, virtual, ring)
    owner = lambda place: next((i for i, (p, _) in enumerate(nodes) if p >= place), 0)
    used, at, left = Counter(), {}, []
    for place, key in sorted(keys):
        shard = nodes[owner(place)][1]
        if used[shard] < room[shard]:
            used[shard] += 1
            at[place, key] = shard
        else:
            left.append((place, key))
    for place, key in left:
        i = owner(place)
        while used[nodes[i][1]] >= room[nodes[i][1]]:
            i = (i + 1) % len(nodes)
        used[nodes[i][1]] += 1
        at[place, key] = nodes[i][1]
    return at


def test_loads_follow_the_ring():
    rng = np.random.default_rng(1)
    for n, shards in ((0, 3), (5, 24), (400, 7), (1000, 24)):
        keys = [(int(p), k) for k, p in enumerate(rng.integers(0, 256, n))]
        counts = Counter(p for p, _ in keys)
        rank, want = Counter(), Counter()
        for (place, key), shard in sorted(brute_ring(keys, shards, 4, 256).items()):
            want[place, shard] += 1
        moves = sharding.plan_loads(counts, shards, 4, 256)
        got = Counter()
        for m in moves:
            end = min([x.first for x in moves if x.place == m.place and x.first > m.first], default=counts[m.place])
            got[m.place, m.shard] += end - m.first
        assert got == want, (n, shards, rank)


def test_shards(spark):
    rows = [(i, "é" * (i % 9), "x") for i in range(500)] + [(7, "same", "x")] * 60 + [(None, None, "x")] * 5
    df = spark.createDataFrame(rows, "doc_id long, text string, slot string")
    got = sharding.shard_rows(df, 24).collect()
    sizes = Counter(r.shard for r in got)
    assert len(got) == 565 and set(sizes) == set(range(24)) and max(sizes.values()) - min(sizes.values()) <= 1
    for shard, n in sizes.items():
        assert sorted(r.slot for r in got if r.shard == shard) == list(range(n))
    texts = {i: t or "" for i, t, _ in rows[:500] if i != 7}
    for r in got:
        if r.doc_id in texts:
            raw = texts[r.doc_id].encode()
            assert (r.size, r.text_crc32) == (len(raw) + 8, zlib.crc32(raw))
    assert {(r.law, r.grown_shard) for r in got} == {("rows", None)}
    assert [(r.size, r.text_crc32) for r in got if r.doc_id is None] == [(8, 0)] * 5
    assert sharding.shard_rows(spark.createDataFrame([], df.schema)).count() == 0


def test_top_k(spark):
    rng = np.random.default_rng(2)
    rows = [(i, [float(x) for x in np.float32(rng.normal(size=20))], 0) for i in range(300)]
    rows += [(1000 + i, rows[50][1], 0) for i in range(8)]  # ties
    rows += [(2000, None, 0), (2050, [float("inf")] * 20, 0), (2100, [None] * 20, 0), (2150, [1.0, 2.0], 0), (2151, [3.0, -1.0], 0)]
    rows += [(None, rows[0][1], 0), (100, rows[100][1], 0)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, score int")
    want = set()
    whole = {i: [math.floor(256 * x) for x in v] for i, v, _ in rows
             if i is not None and v and all(x is not None and math.isfinite(x) for x in v)}
    for q in (i for i in whole if i % 50 == 0):
        scored = sorted((-sum(a * b for a, b in zip(whole[q], v)), i) for i, v in whole.items() if i != q and len(v) == len(whole[q]))
        want |= {(q, rank, i, -s) for rank, (s, i) in enumerate(scored[:5], 1)}
    for block in (8192, 37):
        assert {tuple(r) for r in topk.top_k(df, block=block).collect()} == want
    assert topk.top_k(spark.createDataFrame([], df.schema)).count() == 0


def test_bounds_hold():
    rng = np.random.default_rng(3)
    x, y = rng.integers(-300, 300, (40, 50)).astype(float), rng.integers(-300, 300, (60, 50)).astype(float)
    exact = x @ y.T
    last = None
    for n in topk.LEVELS:
        bound = topk.statistics(x, n) @ topk.statistics(y, n).T
        assert (bound >= exact - 1e-6).all()
        assert last is None or bound.mean() <= last
        last = bound.mean()


def test_pipeline(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    clean = stages["toxicity"](spark, docs, sf)
    unique = stages["simhash"](spark, clean, sf)
    masked = stages["pii"](spark, unique, sf)
    assert docs.columns == clean.columns == unique.columns == masked.columns
    prints = {r.doc_id: simhash.text_fingerprint(r.text) for r in clean.collect()}
    stay = {r.doc_id for r in unique.collect()}
    assert all(any((prints[i] ^ prints[j]).bit_count() <= 2 for j in stay) for i in prints)
    assert not [1 for a in stay for b in stay if a < b and (prints[a] ^ prints[b]).bit_count() <= 2]
    texts = {r.doc_id: r.text for r in masked.collect()}
    assert texts.keys() == stay and not any(pii.find_spans(t) for t in texts.values())
    rows = corpus_pipeline.run(spark, sf).collect()
    check_packed(rows, 2048)
    encoder = ByteLevelEncoder(PATH)
    total = Counter()
    for r in rows:
        total[r.doc_id] += r.length
    assert total == {i: len(encoder.encode_bytes(t or "")) // 4 + 1 for i, t in texts.items()}


def test_twins(spark):
    con = compare.duck("/root/testdata/sf0.001")
    for name in llm_oracle_sql():
        good, note = compare.compare(spark, con, name, "/root/testdata/sf0.001")
        assert good, (name, note)
    assert len([n for n in llm_queries() if n.startswith("op")]) == 13
