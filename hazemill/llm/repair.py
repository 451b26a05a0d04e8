"""Repair of damaged conversations: a depth-first branch-and-bound over edits finds the
cheapest ones that make the roles alternate."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hazemill.llm.common import map_rows, stored

#: What the edits cost; a row that ends in mid-sentence and stays costs ``TRUNCATED`` more.
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3

# The roles that may follow one another, as a machine. State 0 is before any
# row, 1 after a system row, 2 after a user row, 3 after an assistant row.
START, SYSTEM, USER, ASSISTANT = range(4)
#: Per state: where the kinds of role that may be kept lead, and the state that a rerole or an
#: insert leads to (a user row everywhere but after a user row).
_KEEPS = ({1: SYSTEM, 2: USER}, {2: USER}, {3: ASSISTANT}, {2: USER})
_NEXT = (USER, USER, ASSISTANT, USER)
_KINDS = {"s": 1, "u": 2, "a": 3}
_LEGAL = frozenset(("su", "ua", "au"))
#: Inserts that are still due at the end of a conversation, per state.
_CLOSING = (0, 2, 1, 0)
#: Marks of a row besides the kind of its role: it has to go; it stays at a price.
GONE, CUT = 4, 8

_FAR = 1 << 62


def suffix_bounds(rows: bytes, end: int | None = None) -> list[list[int]]:
    """``bounds[state][i]``: what rows i and later cost at least from a state, whichever edits.

    ``end`` is the state to end in right after the last row's edit; None for the end of the
    conversation, where inserts may follow.
    """
    n = len(rows)
    bounds = [[_FAR] * (n + 1) for _ in range(4)]
    for state in range(4):
        if end is None:
            bounds[state][n] = INSERT * _CLOSING[state]
        elif state == end:
            bounds[state][n] = 0
    b0, b1, b2, b3 = (b[n] for b in bounds)
    for i in range(n - 1, -1, -1):
        row = rows[i]
        if row & GONE:
            c0, c1, c2, c3 = b0 + DELETE, b1 + DELETE, b2 + DELETE, b3 + DELETE
        else:
            more = TRUNCATED if row & CUT else 0
            kind = row & 3
            to_user, to_assistant = b2 + more + REROLE, b3 + more + REROLE
            kept_user = b2 + more if kind == 2 else _FAR
            c0 = min(b0 + DELETE, to_user, kept_user, b1 + more if kind == 1 else _FAR)
            c1 = min(b1 + DELETE, to_user, kept_user)
            c2 = min(b2 + DELETE, to_assistant, b3 + more if kind == 3 else _FAR)
            c3 = min(b3 + DELETE, to_user, kept_user)
        b2, b3 = min(c2, c3 + INSERT), min(c3, c2 + INSERT)
        b0, b1 = min(c0, b2 + INSERT), min(c1, b2 + INSERT)
        bounds[0][i], bounds[1][i], bounds[2][i], bounds[3][i] = b0, b1, b2, b3
    return bounds


def search(rows: bytes, start: int = START, end: int | None = None, bounds: list[list[int]] | None = None) -> tuple[int, str] | None:
    """``cost, audit`` of the cheapest edits, of equal ones those whose audit is least; None if
    no edits lead to ``end``. ``rows`` has a kind of role and marks per row.

    The stack holds prefixes, the next one in the audits' order on top. A prefix is cut off if
    its cost and the bound of what is left exceed the least bound of the whole or reach the
    incumbent (a later audit is a greater one), or if an earlier prefix came to the same row
    and state at no higher cost. An incumbent as cheap as the bound is proved optimal.
    """
    bounds = bounds or suffix_bounds(rows, end)
    n, least = len(rows), bounds[start][0]
    if least >= _FAR:
        return None
    dominant: list[dict[int, int]] = [{} for _ in range(4)]
    incumbent, audit = least + 1, ""
    path = bytearray()
    stack = [(0, start, 0, 0, "")]
    while stack:
        i, state, cost, depth, edit = stack.pop()
        if cost + bounds[state][i] >= incumbent:
            continue
        if dominant[state].get(i, _FAR) <= cost:
            continue
        dominant[state][i] = cost
        del path[depth:]
        if edit:
            path += edit.encode()
            depth += 1
        if i == n and (state == end if end is not None else not _CLOSING[state]):
            incumbent, audit = cost, path.decode()
            if incumbent == least:
                break
            continue
        # From the greatest edit to the least, so that the least is on top.
        if i < n:
            row = rows[i]
            more = TRUNCATED if row & CUT else 0
            if not row & GONE:
                stack.append((i + 1, _NEXT[state], cost + REROLE + more, depth, "R"))
                if row & 3 in _KEEPS[state]:
                    stack.append((i + 1, _KEEPS[state][row & 3], cost + more, depth, "K"))
        if i < n or end is None:
            stack.append((i, _NEXT[state], cost + INSERT, depth, "I"))
        if i < n:
            stack.append((i + 1, state, cost + DELETE, depth, "D"))
    return incumbent, audit


class Repair:
    """Lines of a repaired conversation, one row after another, as an audit says."""

    def __init__(self, audit: str) -> None:
        self._audit, self._at, self._state = audit, 0, START
        self._digest, self._any = hashlib.sha256(), False

    def _emit(self, role: str, text: str) -> None:
        self._state = _KEEPS[self._state].get(_KINDS.get(role[:1], 0), self._state)
        self._digest.update(("\n" if self._any else "").encode() + f"{role}:{text}".encode("utf-8", "surrogatepass"))
        self._any = True

    def _insert(self) -> None:
        while self._audit[self._at : self._at + 1] == "I":
            self._emit("assistant" if self._state == USER else "user", "")
            self._at += 1

    def row(self, role: str, text: str) -> None:
        self._insert()
        edit = self._audit[self._at]
        self._at += 1
        if edit == "K":
            self._emit(role, text)
        elif edit == "R":
            self._emit("assistant" if self._state == USER else "user", text)

    def sha256(self) -> str:
        self._insert()
        return self._digest.hexdigest()


@dataclass
class Stretch:
    """Consecutive rows of one conversation and what is counted of them."""

    rows: bytearray = field(default_factory=bytearray)
    blank: int = 0
    duplicate: int = 0
    truncated: int = 0
    illegal: int = 0
    turns: int = 0
    first_turn: int | None = None
    last_turn: int | None = None
    first_role: str | None = None
    last_role: str | None = None

    def add(self, turn: int | None, role: str, copies: int, blank: bool, cut: bool, first: bool) -> None:
        """``copies`` equal rows; ``first`` says that none like them came before."""
        if copies <= 0:
            return
        initial = role[:1]
        kind = _KINDS.get(initial, 0)
        if blank:
            self.blank += copies
            self.rows += bytes((kind | GONE,)) * copies
        else:
            if first:
                self.truncated += cut
                self.rows.append(kind | (CUT if cut else 0))
            self.duplicate += copies - first
            self.rows += bytes((kind | GONE,)) * (copies - first)
        if self.last_role is not None and self.last_role + initial not in _LEGAL:
            self.illegal += 1
        self.illegal += copies - 1  # no role may follow itself
        self.first_role = initial if self.first_role is None else self.first_role
        self.last_role = initial
        if turn is not None and turn != self.last_turn:
            self.first_turn = turn if self.first_turn is None else self.first_turn
            self.last_turn = turn
            self.turns += 1

    def counts(self) -> dict[str, int]:
        gaps = self.last_turn - self.first_turn + 1 - self.turns if self.turns else 0
        return {
            "gaps": min(gaps, (1 << 63) - 1), "blank": self.blank, "duplicate": self.duplicate,
            "truncated": self.truncated, "illegal": self.illegal,
        }

    def followed_by(self, other: Stretch) -> Stretch:
        """Counts of both, this one's rows first; the rows themselves are left out."""
        joined = Stretch(
            blank=self.blank + other.blank, duplicate=self.duplicate + other.duplicate,
            truncated=self.truncated + other.truncated, illegal=self.illegal + other.illegal,
            turns=self.turns + other.turns, first_turn=self.first_turn if self.turns else other.first_turn,
            last_turn=other.last_turn if other.turns else self.last_turn,
            first_role=other.first_role if self.first_role is None else self.first_role,
            last_role=self.last_role if other.last_role is None else other.last_role,
        )
        if None not in (self.last_role, other.first_role):
            joined.illegal += self.last_role + other.first_role not in _LEGAL
        if self.turns and other.turns and self.last_turn == other.first_turn:
            joined.turns -= 1
        return joined


_COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal")
_RESULT = "conv_id long, " + ", ".join(f"{name} long" for name in _COUNTS) + ", cost long, audit string, repaired_sha256 string"
_STRETCH = ("blank", "duplicate", "truncated", "illegal", "turns", "first_turn", "last_turn", "first_role", "last_role")


def damage(conversations: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text, copies`` after the damage that a row's key decides: crc32 of
    ``conv_id:turn`` modulo 20 is 0: no copies, 1: no text, 2: no ``.``, ``!``, ``?``, 3: two
    copies, 4: role user. Nulls read as one space, but a null conversation or turn stays one."""
    space = F.lit(" ")

    def shown(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), space)

    given = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        shown("role").alias("role"), shown("text").alias("text"),
    )
    key = F.concat(shown("conv_id"), F.lit(":"), shown("turn"))
    roll = F.crc32(key.cast("binary")) % 20
    dropped = roll == 0
    text = F.when(dropped | (roll == 1), "").when(roll == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    return given.select(
        "conv_id", "turn", F.when(dropped, "").when(roll == 4, "user").otherwise(F.col("role")).alias("role"),
        text.alias("text"), F.when(dropped, 0).when(roll == 3, 2).otherwise(1).cast("long").alias("copies"),
    )


def judged(damaged: DataFrame) -> DataFrame:
    """Rows with ``blank``, ``cut`` (ends in mid-sentence) and ``first`` (no row of the
    conversation with its role and text comes before); equal rows are one with more copies.

    Rows that are alone with their role and text, which nearly all are, meet no others: only
    marks of them are shuffled to find that out.
    """
    conv = F.coalesce(F.col("conv_id").cast("string"), F.lit(" "))
    real = F.least("copies", F.lit(1)).cast("string")  # a row without copies is like no other
    mark = F.sha2(F.concat_ws(":", conv, real, F.length("role").cast("string"), "role", "text").cast("binary"), 256)
    space = r"[\x20\x09-\x0D]"
    rows = damaged.withColumns({
        "mark": mark,
        "blank": ~F.col("text").rlike(r"[^\x20\x09-\x0D]"),
        "cut": ~F.col("text").rlike(rf"[.!?]{space}*\z"),
    })
    repeated = rows.groupBy("mark").agg(
        F.count("*").alias("times"), F.min("turn").alias("least"), F.max(F.col("turn").isNull()).alias("unplaced")
    )
    repeated = stored(repeated.filter("times > 1").drop("times"), "repair-repeated")
    alone = rows.join(repeated.select("mark"), "mark", "left_anti").withColumn("first", F.lit(True))
    earliest = F.when(F.col("unplaced"), F.lit(None).cast("long")).otherwise(F.col("least"))
    several = rows.join(repeated, "mark").withColumn("first", F.col("turn").eqNullSafe(earliest))
    keys = ["conv_id", "turn", "role", "text", "blank", "cut", "first"]
    several = several.groupBy(*keys).agg(F.sum("copies").alias("copies"))
    return alone.select(*keys, "copies").unionByName(several.select(*keys, "copies"))


def _solve(batches: Iterator[dict]) -> Iterator[dict]:
    """Conversations that lie within the task's rows, solved; of the first and the last one,
    which may go on in the tasks before and after, costs and audits between all states."""
    part = TaskContext.get().partitionId()
    held: list[tuple] = []  # rows of the conversation that is being read
    stretch, now, opened, several = Stretch(), None, False, False
    columns = ("conv_id", "turn", "role", "text", "copies", "blank", "cut", "first")

    found = _Rows(_SOLVED)

    def whole() -> dict:
        cost, audit = search(bytes(stretch.rows))
        made = Repair(audit)
        for role, text, copies in held:
            for _ in range(copies):
                made.row(role, text)
        return {"conv_id": now, "part": part, "whole": True, **stretch.counts(),
                "cost": cost, "audit": audit, "repaired_sha256": made.sha256()}

    def fragment() -> dict:
        rows = bytes(stretch.rows)
        costs: list[int] = []
        audits: list[str] = []
        for end in range(4):
            bounds = suffix_bounds(rows, end)
            for start in range(4):
                cost, audit = search(rows, start, end, bounds) or (_FAR, "")
                costs.append(cost)
                audits.append(audit)
        kept = {f"s_{k}": getattr(stretch, k) for k in _STRETCH}
        return {"conv_id": now, "part": part, **kept, "whole": False, "costs": costs, "audits": audits}

    for batch in batches:
        for conv, turn, role, text, copies, blank, cut, first in zip(*(batch[k].to_pylist() for k in columns)):
            if not opened or conv != now:
                if opened:
                    yield from found.add(whole() if several else fragment())
                    several = True
                held, stretch, now, opened = [], Stretch(), conv, True
            stretch.add(turn, role, copies, blank, cut, first)
            if several and copies:
                held.append((role, text, copies))
    if opened:
        yield from found.add(fragment())
    yield from found.rest()


_FRAGMENT = ", ".join(f"s_{k} {'string' if k.endswith('role') else 'long'}" for k in _STRETCH)
_SOLVED = f"{_RESULT}, whole boolean, part int, {_FRAGMENT}, costs array<long>, audits array<string>"


class _Rows:
    """Rows on their way out, a few thousand at a time; what a row lacks is null."""

    def __init__(self, schema: str) -> None:
        self._names = [f.split()[0] for f in schema.split(", ")]
        self._rows: list[dict] = []

    def add(self, row: dict) -> Iterator[dict]:
        self._rows.append(row)
        if len(self._rows) >= 2_000:
            yield from self.rest()

    def rest(self) -> Iterator[dict]:
        rows, self._rows = self._rows, []
        if rows:
            yield {name: [row.get(name) for row in rows] for name in self._names}


def _compose(stretches: pa.Table) -> pa.Table:
    """One conversation from its stretches in order: costs from the last one on tell which
    states can be on the cheapest way, then the least audit is taken from the first one on."""
    rows = stretches.sort_by("part").to_pylist()
    costs, audits = [row["costs"] for row in rows], [row["audits"] for row in rows]
    ahead = [[INSERT * n for n in _CLOSING]]
    for cost in reversed(costs):
        ahead.append([min(cost[4 * end + state] + ahead[-1][end] for end in range(4)) for state in range(4)])
    ahead.reverse()
    state, chosen = START, []
    for cost, audit, here, there in zip(costs, audits, ahead, ahead[1:]):
        # No stretch ends with an insert, so no audit of equal cost begins another one.
        ends = [e for e in range(4) if cost[4 * e + state] + there[e] == here[state]]
        end = min(ends, key=lambda e: audit[4 * e + state])
        chosen.append(audit[4 * end + state])
        state = end
    chosen.append("I" * _CLOSING[state])
    counted = Stretch()
    for row in rows:
        counted = counted.followed_by(Stretch(**{k: row[f"s_{k}"] for k in _STRETCH}))
    longs = {"conv_id": rows[0]["conv_id"], **counted.counts(), "cost": ahead[0][START]}
    columns = {k: pa.array([v], pa.int64()) for k, v in longs.items()}
    return pa.table({**columns, "audit": pa.array(["".join(chosen)], pa.string())})


def _digest(batches: Iterator[dict]) -> Iterator[dict]:
    """Conversations as a stream: a row with the audit, then the rows that it is about."""
    made, result, found = None, None, _Rows(_RESULT)
    for batch in batches:
        columns = ("conv_id", "place", "role", "text", "copies", "audit", "cost", *_COUNTS)
        for conv, place, role, text, copies, audit, cost, *counts in zip(*(batch[k].to_pylist() for k in columns)):
            if not place:
                if made:
                    yield from found.add({**result, "repaired_sha256": made.sha256()})
                made = Repair(audit)
                result = {"conv_id": conv, "cost": cost, "audit": audit, **dict(zip(_COUNTS, counts))}
            else:
                for _ in range(copies):
                    made.row(role, text)
    if made:
        yield from found.add({**result, "repaired_sha256": made.sha256()})
    yield from found.rest()


def repair_conversations(rows: DataFrame) -> DataFrame:
    """Cheapest repair of every conversation of ``conv_id, turn, role, text, copies``:
    ``conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256``.

    Rows are taken by turn (nulls first), of one turn by role and text; a row with no copies
    only names its conversation, which then has a result of its own even without any row.
    A null conversation is one. An empty table gives no rows; other columns are not looked at.

    Rows are dealt in sorted order by ranges, so a long conversation is many tasks' work: each
    solves its stretch from every state to every state, and the stretches are put together.
    Only the repaired text's digest has to go through the rows of such a conversation one
    after another; it is a stream that keeps nothing but the audit.
    """
    given = rows.select("conv_id", "turn", "role", "text", F.col("copies").cast("long").alias("copies"))
    dealt = judged(given)
    order = ["conv_id", "turn", "role"]
    dealt = dealt.repartitionByRange(*order, F.substring("text", 1, 32)).sortWithinPartitions(*order, "text")
    solved = stored(map_rows(dealt, _solve, _SOLVED), "repair-solved")
    names = [f.split()[0] for f in _RESULT.split(", ")]
    whole = solved.filter("whole").select(*names)
    split = solved.filter(~F.col("whole"))
    composed = split.groupBy("conv_id").applyInArrow(
        _compose, "conv_id long, " + ", ".join(f"{k} long" for k in _COUNTS) + ", cost long, audit string"
    )
    composed = stored(composed, "repair-composed")
    # Two conversations per task at most lie in more than one.
    ids = F.broadcast(composed.select(F.col("conv_id").alias("id")))
    rest = judged(given).join(ids, F.col("conv_id").eqNullSafe(F.col("id")), "left_semi")
    both = rest.select("conv_id", F.lit(1).alias("place"), "turn", "role", "text", "copies").unionByName(
        composed.withColumn("place", F.lit(0)), allowMissingColumns=True
    )
    stream = both.repartition("conv_id").sortWithinPartitions("conv_id", "place", "turn", "role", "text")
    return whole.unionByName(map_rows(stream, _digest, _RESULT)).select(*names)
