"""Repair of conversations against a brute-force version of the whole contract."""

from __future__ import annotations

import hashlib
import random
import re
import sys
import zlib
from functools import lru_cache

import pytest

from hazemill.llm import repair
from hazemill.llm.common import table
from hazemill.llm.queries import llm_queries

SCHEMA = "conv_id long, turn long, role string, text string, copies string, mark int, first int, place int, audit int"
MACHINE = {"": {"s": "s", "u": "u"}, "s": {"u": "u"}, "u": {"a": "a"}, "a": {"u": "u"}}
FULL = {"u": "user", "a": "assistant"}


def brute_repair(rows):
    """Cheapest ``(cost, audit)`` and the lines of it; rows are ``role, text, fault``."""

    @lru_cache(None)
    def best(i, state, inserts):
        options = []
        if i == len(rows):
            if state in ("", "a"):
                options.append((0, ""))
        else:
            role, _, fault = rows[i]
            rest = best(i + 1, state, 0)
            options.append((rest[0] + 4, "D" + rest[1]))
            if fault not in ("blank", "duplicate"):
                more = 3 * (fault == "truncated")
                if role[:1] in MACHINE[state]:
                    rest = best(i + 1, MACHINE[state][role[:1]], 0)
                    options.append((rest[0] + more, "K" + rest[1]))
                for to in "ua":
                    if to in MACHINE[state]:
                        rest = best(i + 1, to, 0)
                        options.append((rest[0] + 3 + more, "R" + rest[1]))
        if inserts < 3:
            for to in "ua":
                if to in MACHINE[state]:
                    rest = best(i, to, inserts + 1)
                    options.append((rest[0] + 3, "I" + rest[1]))
        return min(options, default=(10**9, ""))

    sys.setrecursionlimit(20_000)
    cost, audit = best(0, "", 0)
    lines, state, at = [], "", iter(rows)
    for edit in audit:
        role, text = next(at)[:2] if edit != "I" else (None, "")
        if edit == "D":
            continue
        if edit != "K":
            role = FULL["a" if state == "u" else "u"]
        state = role[:1]
        lines.append(f"{role}:{text}")
    return cost, audit, "\n".join(lines)


def brute_all(rows):
    convs = {}
    for conv, turn, role, text in rows:
        kept = convs.setdefault(conv, [])
        shown = [" " if x is None else x for x in (conv, turn, role, text)]
        roll = zlib.crc32(f"{shown[0]}:{shown[1]}".encode()) % 20
        role, text = shown[2:]
        if roll == 0:
            continue
        text = "" if roll == 1 else re.sub("[.!?]", "", text) if roll == 2 else text
        kept += [(turn, "user" if roll == 4 else role, text)] * (2 if roll == 3 else 1)
    out = {}
    for conv, kept in convs.items():
        kept.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2].encode()))
        seen, judged = set(), []
        for _, role, text in kept:
            solid = re.sub(r"[\x20\x09-\x0D]", "", text)
            fault = "blank" if not solid else "duplicate" if (role, text) in seen else "truncated" if solid[-1] not in ".!?" else ""
            seen.add((role, text))
            judged.append((role, text, fault))
        turns = {t for t, _, _ in kept if t is not None}
        initials = [r[:1] for _, r, _ in kept]
        cost, audit, lines = brute_repair(tuple(judged))
        out[conv] = (
            max(turns) - min(turns) + 1 - len(turns) if turns else 0,
            *(sum(f == k for _, _, f in judged) for k in ("blank", "duplicate", "truncated")),
            sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])),
            cost, audit, hashlib.sha256(lines.encode()).hexdigest(),
        )
    return out


def got(frame):
    rows = frame.collect()
    out = {r.conv_id: tuple(r)[1:] for r in rows}
    assert len(out) == len(rows)
    return out


def test_search_is_exhaustive():
    rng = random.Random(4)
    roles = ("system", "user", "assistant", "tool", "", "use")
    for _ in range(3000):
        rows = [
            (rng.choice(roles), f"t{i}", rng.choice(("", "", "truncated", "blank", "duplicate")))
            for i in range(rng.randrange(9))
        ]
        marks = {"": 0, "truncated": repair.CUT, "blank": repair.GONE, "duplicate": repair.GONE}
        packed = bytes({"s": 1, "u": 2, "a": 3}.get(r[:1], 0) | marks[f] for r, _, f in rows)
        cost, audit, lines = brute_repair(tuple(rows))
        assert repair.search(packed) == (cost, audit)
        made = repair.Repair(audit)
        for role, text, _ in rows:
            made.row(role, text)
        assert made.sha256() == hashlib.sha256(lines.encode()).hexdigest()
        # Put together from two stretches.
        cut = rng.randrange(len(rows) + 1)
        ways = []
        for middle in range(4):
            left = repair.search(packed[:cut], 0, middle)
            right = repair.search(packed[cut:], middle)
            if left:
                ways.append((left[0] + right[0], left[1] + right[1]))
        assert min(ways) == (cost, audit)


def test_search_of_a_long_conversation_is_short(monkeypatch):
    rng = random.Random(5)
    rows = bytes(rng.randrange(4) | rng.choice((0, 0, 4, 8)) for _ in range(200_000))
    cost, audit = repair.search(rows)
    assert cost == repair.suffix_bounds(rows)[0][0] and sum(e != "I" for e in audit) == len(rows)


@pytest.fixture(scope="module")
def odd_rows():
    rng = random.Random(6)
    roles = ("system", "user", "assistant", "user", "assistant", "tool", "", None)
    texts = ("Yes.", "No!", "cut", " \t", "", None, "end. \n", "é?", "a" * 50_000 + ".")
    rows = []
    for conv in range(120):
        for turn in range(rng.randrange(12)):
            rows.append((conv, rng.choice((turn, turn, turn, None, turn - 3, 10**15 * turn)), rng.choice(roles), rng.choice(texts)))
    # One conversation with more rows than any task, one of equal rows, one without a name.
    rows += [(500, i // 2, roles[i % 5], f"line {i % 700}{'.' * (i % 3)}") for i in range(3_000)]
    rows += [(501, 7, "user", "same.")] * 800 + [(502, None, "user", f"x{i}.") for i in range(300)]
    rows += [(None, i, "user" if i % 2 else "assistant", "Hm.") for i in range(40)]
    rows += [(503, -(2**63), "user", "a."), (503, 2**63 - 1, "assistant", "b.")]
    rows += [(600 + i, 0, None, None) for i in range(200)]
    rng.shuffle(rows)
    return rows


def test_conversations(spark, odd_rows):
    df = spark.createDataFrame([(*r, "x", 1, 2, 3, 4) for r in odd_rows], SCHEMA)
    want = brute_all(odd_rows)
    want[503] = (min(want[503][0], 2**63 - 1), *want[503][1:])
    for parts in (1, 4, 23):
        spark.conf.set("spark.sql.shuffle.partitions", parts)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        try:
            found = got(repair.repair_conversations(repair.damage(df)))
            assert found.keys() == want.keys()
            assert not [(c, found[c], want[c]) for c in want if found[c] != want[c]][:3]
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", 4)
            spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert any(v[5:7] == (0, "") for v in want.values())
    empty = spark.createDataFrame([], SCHEMA)
    assert repair.repair_conversations(repair.damage(empty)).count() == 0


def test_query(spark):
    sf = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in table(spark, sf, "conversations").select("conv_id", "turn", "role", "text").collect()]
    assert got(llm_queries()["op13_repair"](spark, sf)) == brute_all(rows)
