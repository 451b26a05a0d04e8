"""SimHash groups and vector groups against brute force."""

from __future__ import annotations

import numpy as np
import pytest
import xxhash

from hazemill.llm import itq, simhash
from hazemill.llm.common import connected_components

DOCS = "doc_id long, text string, lang string"


def brute_fingerprint(text):
    words = [w for w in (text or "").encode().lower().replace(b"\x0b", b" ").split()]
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(nodes, linked):
    name = {n: n for n in nodes}
    changed = True
    while changed:
        changed = False
        for a in nodes:
            for b in nodes:
                if name[a] != name[b] and linked(a, b):
                    low = min(name[a], name[b])
                    name[a] = name[b] = low
                    changed = True
    return name


@pytest.fixture(scope="module")
def texts():
    rng = np.random.default_rng(1)
    words = [f"w{i}" for i in range(300)]
    out = []
    for i in range(60):
        base = list(rng.choice(words, 400))
        out.append(" ".join(base))
        for _ in range(i % 4):
            near = list(base)
            near[rng.integers(400)] = "Other"
            out.append("  ".join(near).upper() if i % 3 else "\n".join(near))
    return [*out, "", None, " \t\n", "one", "ONE", "one two", "a b c a b c", "é É ü", out[0], out[0]]


def test_fingerprints_and_groups(spark, texts):
    rows = [(100 + i, t, "x") for i, t in enumerate(texts)]
    found = {r.doc_id: r for r in simhash.simhash_groups(spark.createDataFrame(rows, DOCS)).collect()}
    prints = {i: brute_fingerprint(t) for i, t, _ in rows}
    assert {i: f"{p:016x}" for i, p in prints.items()} == {i: r.fingerprint for i, r in found.items()}
    want = components(list(prints), lambda a, b: (prints[a] ^ prints[b]).bit_count() <= 2)
    assert want == {i: r.component_id for i, r in found.items()}
    assert len(set(want.values())) < len(rows)


def test_long_texts_are_counted_in_blocks(monkeypatch):
    text = " ".join(str(i * i) for i in range(5000))
    whole = simhash.text_fingerprint(text)
    monkeypatch.setattr(simhash, "BLOCK", 7)
    assert simhash.text_fingerprint(text) == whole == brute_fingerprint(text)


def test_simhash_edges(spark):
    empty = spark.createDataFrame([], DOCS)
    assert simhash.simhash_groups(empty).count() == 0
    rows = [(None, "a b", "n"), (5, "a b", "n"), (5, "a b", "n"), (7, None, "n"), (None, "zz", "n")]
    got = simhash.simhash_groups(spark.createDataFrame(rows, DOCS)).collect()
    assert sorted((r.doc_id or 0, r.component_id or 0) for r in got) == [(0, 0), (0, 5), (5, 5), (5, 5), (7, 7)]
    kept = simhash.drop_near_copies(spark.createDataFrame(rows, DOCS)).collect()
    assert sorted(r.doc_id or 0 for r in kept) == [0, 0, 5, 7]


def test_clashing_columns_stay(spark):
    df = spark.createDataFrame(
        [(1, "a b", 9, 8, 7), (2, "a b", 1, 1, 1)], "doc_id long, text string, bits long, node long, times int"
    )
    assert [tuple(r) for r in simhash.drop_near_copies(df).collect()] == [(1, "a b", 9, 8, 7)]


def test_components(spark):
    edges = [(i, i + 1) for i in range(1, 40)] + [(100, 90), (90, 95), (200, 200), (None, 3)]
    got = connected_components(spark.createDataFrame(edges, "a long, b long"), "t").collect()
    want = {i: 1 for i in range(1, 41)} | {100: 90, 90: 90, 95: 90}
    assert {r.node: r.component for r in got} == want and len(got) == len(want)


VECTORS = "vec_id long, embedding array<float>, node int"


def brute_links(rows, least=0.9):
    good = {}
    for i, v, *_ in rows:
        if i is None:
            continue
        good[i] = v
    unit = {}
    for i, v in good.items():
        if v and all(x is not None and np.isfinite(x) for x in v) and any(v):
            a = np.array(v, np.float32).astype(float)
            unit[i] = a / np.linalg.norm(a)
    near = lambda a, b: len(unit[a]) == len(unit[b]) and unit[a] @ unit[b] >= least
    links = {i: sum(near(i, j) for j in unit if j != i) if i in unit else 0 for i in good}
    name = components(list(unit), near)
    return {i: (links[i], name.get(i, i)) for i in good}


def test_vector_groups(spark):
    rng = np.random.default_rng(2)
    base = rng.normal(size=(60, 64))
    rows = [(i, v.tolist(), 0) for i, v in enumerate(base)]
    for i in range(120):  # chains, near copies, exact copies
        of = np.array(rows[rng.integers(len(rows))][1])
        rows.append((100 + i, (of + rng.normal(size=64) * rng.choice([0, 0.1, 0.3])).tolist(), 0))
    rows += [(900, None, 0), (901, [0.0] * 64, 0), (902, [float("nan")] * 64, 0), (903, [], 0)]
    rows += [(904, [1.0, None], 0), (905, [1.0, 2.0], 0), (906, [2.0, 4.0], 0), (None, [1.0, 2.0], 0)]
    rows = [(i, v if v is None else [x if x is None else float(np.float32(x)) for x in v], n) for i, v, n in rows]
    got = {r.vec_id: r for r in itq.vector_groups(spark.createDataFrame(rows, VECTORS)).collect()}
    want = brute_links(rows)
    assert got.keys() == want.keys()
    right = sum(got[i].n_links for i in got) / sum(n for n, _ in want.values())
    assert 0.97 <= right <= 1
    assert all(got[i].n_links <= want[i][0] for i in got)
    assert sum((got[i].n_links, got[i].component_id) == want[i] for i in got) >= 0.97 * len(got)
    assert all(r.kept == (r.vec_id == r.component_id) for r in got.values())


def test_chunks_of_large_buckets(spark, monkeypatch):
    rng = np.random.default_rng(3)
    base = rng.normal(size=64)
    rows = [(i, (base + 0.02 * rng.normal(size=64)).tolist(), 0) for i in range(90)]
    df = spark.createDataFrame(rows, VECTORS)
    monkeypatch.setattr(itq, "CHUNK", 20)
    got = itq.vector_groups(df).collect()
    assert {(r.n_links, r.component_id) for r in got} == {(89, 0)}


def test_no_vectors(spark):
    assert itq.vector_groups(spark.createDataFrame([], VECTORS)).count() == 0
