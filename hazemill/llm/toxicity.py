"""Toxic spans and document scores by a linear-chain conditional random field."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hazemill.llm.common import map_rows

#: Labelled documents that the field is fitted on, per class; the bound on what the driver sees.
SAMPLE = 1_000
THRESHOLD = 0.7
#: With hundreds of thousands of features some differ by chance; at 35 hardly any does. A
#: small sample cannot give as much: it is asked for a twentieth of its toxic documents.
EVIDENCE = 35
_WORD = re.compile(r"\w+")
#: Words whose features are kept at hand in a task.
_KEPT = 200_000
#: Characters that are tagged together.
_TOGETHER = 300_000


def token_features(word: str) -> tuple[str, ...]:
    """What the field sees of a word: itself, its first four and five letters, its ends."""
    return ("w:" + word, "p4:" + word[:4], "p5:" + word[:5], "s4:" + word[-4:], "s5:" + word[-5:])


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -500, 500)))


def _times(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Products of 2x2 matrices laid out as (2, 2, ...)."""
    return np.stack(
        [np.stack([p[r, 0] * q[0, c] + p[r, 1] * q[1, c] for c in (0, 1)]) for r in (0, 1)]
    )


def _scan(m: np.ndarray, block: int = 64) -> np.ndarray:
    """Running products of 2x2 matrices, (2, 2, n), each scaled by some positive number.

    Blocks run side by side, then their totals are scanned the same way: a few vector
    steps whatever the length.
    """
    n = m.shape[-1]
    if n <= 1:
        return m
    blocks = -(-n // block)
    full = np.empty((2, 2, blocks * block))
    full[..., :n] = m
    full[..., n:] = np.eye(2)[..., None]
    steps = np.ascontiguousarray(full.reshape(2, 2, blocks, block).transpose(3, 0, 1, 2))
    for i in range(1, block):
        steps[i] = _times(steps[i], steps[i - 1])
        if i % 4 == 0 or i == block - 1:
            steps[i] /= steps[i].max(axis=(0, 1))
    if blocks > 1:
        before = _scan(steps[-1][..., :-1], block)
        for i in range(block):
            steps[i][..., 1:] = _times(steps[i][..., 1:], before)
    out = steps.transpose(1, 2, 3, 0).reshape(2, 2, -1)[..., :n]
    return out / out.max(axis=(0, 1))


def marginals(
    unary: np.ndarray, starts: np.ndarray, transition: np.ndarray, joint: bool = False
) -> tuple[np.ndarray, np.ndarray | None]:
    """Forward-backward over many chains laid end to end.

    ``unary`` is each token's log-odds for "toxic", ``starts`` the index of each chain's
    first token, ``transition`` the 2x2 log weights (from, to). Returns the probability of
    "toxic" of each token and, if ``joint``, the expected number of each pair of
    neighbouring tags. Log-odds count up to 30 either way.
    """
    n = len(unary)
    if n == 0:
        return np.zeros(0), np.zeros((2, 2))
    push = np.exp(transition)
    bounded = np.clip(unary, -30, 30)
    weight = np.exp(np.stack([np.minimum(0, -bounded), np.minimum(0, bounded)]))
    begins = np.zeros(n, bool)
    begins[starts] = True
    # forward: a_i = diag(w_i) T' a_(i-1); a chain's first matrix forgets what was before.
    step = np.where(begins, 1.0, push.T[..., None])
    ahead = _scan(weight[:, None] * step).sum(axis=1)
    ahead /= ahead.sum(axis=0)
    # backward: b_i = T diag(w_(i+1)) b_(i+1), read from the end.
    ends = np.append(begins[1:], True)
    after = np.concatenate([weight[:, 1:], np.ones((2, 1))], axis=1)
    back = np.where(ends, 1.0, push[..., None] * after[None])
    behind = _scan(back[..., ::-1]).sum(axis=1)[:, ::-1]
    behind = behind / behind.sum(axis=0)
    both = ahead * behind
    toxic = both[1] / both.sum(axis=0)
    if not joint:
        return toxic, None
    pairs = np.zeros((2, 2, n))
    pairs[..., 1:] = ahead[:, None, :-1] * push[..., None] * (weight * behind)[None, :, 1:]
    pairs[..., begins] = 0
    total = pairs.sum(axis=(0, 1))
    return toxic, (pairs / np.where(total > 0, total, 1)).sum(axis=2)


@dataclass
class ToxicField:
    """Weights of the field and of the document score."""

    weights: dict[str, float]
    bias: float
    transition: np.ndarray
    score: np.ndarray = field(default_factory=lambda: np.zeros(3))

    def __post_init__(self) -> None:
        self._known: dict[str, float] = {}

    def unary(self, words: list[str]) -> np.ndarray:
        known, get = self._known, self.weights.get
        if len(known) > _KEPT:
            known.clear()
        for word in set(words) - known.keys():
            known[word] = self.bias + sum(get(x, 0.0) for x in token_features(word))
        return np.fromiter(map(known.__getitem__, words), float, len(words))

    def tag(self, texts: list[list[str]]) -> tuple[np.ndarray, np.ndarray]:
        """Marginals of all tokens, end to end, and where each text begins (n + 1 marks)."""
        marks = np.cumsum([0, *map(len, texts)])
        unary = self.unary([w for words in texts for w in words])
        starts = marks[:-1][np.diff(marks) > 0]
        return marginals(unary, starts, self.transition)[0], marks

    def tagged(self, texts: list[str | None]) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
        """``tag`` over neighbouring texts of together some 300,000 characters, which bounds
        memory: ``(first, end, marginals, marks)``. A longer text is one by itself."""
        first, room = 0, _TOGETHER
        for i, text in enumerate(texts):
            room -= len(text or "")
            if room <= 0 or i == len(texts) - 1:
                yield first, i + 1, *self.tag([_words(t) for t in texts[first : i + 1]])
                first, room = i + 1, _TOGETHER

    def summarize(self, texts: list[str | None]) -> np.ndarray:
        """Per text: its largest marginal and the log of its expected toxic tokens."""
        out = np.zeros((len(texts), 2))
        for first, end, toxic, marks in self.tagged(texts):
            out[first:end] = _summary(toxic, marks)
        return out

    def scores(self, summary: np.ndarray) -> np.ndarray:
        return _sigmoid(summary @ self.score[1:] + self.score[0])


def _summary(toxic: np.ndarray, marks: np.ndarray) -> np.ndarray:
    out = np.zeros((len(marks) - 1, 2))
    full = np.flatnonzero(np.diff(marks))
    if len(full):
        out[full, 0] = np.maximum.reduceat(toxic, marks[full])
        out[full, 1] = np.log1p(np.add.reduceat(toxic, marks[full]))
    return out


def _words(text: str | None) -> list[str]:
    return _WORD.findall((text or "").lower())


class _Corpus:
    """Texts as numbers: every distinct word once, with the numbers of its features."""

    def __init__(self, texts: list[str | None]) -> None:
        vocabulary: dict[str, int] = {}
        self.docs = [
            np.array([vocabulary.setdefault(w, len(vocabulary)) for w in _words(t)], dtype=np.int32)
            for t in texts
        ]
        self.words = list(vocabulary)
        names: dict[str, int] = {}
        self.features = np.array(
            [[names.setdefault(x, len(names)) for x in token_features(w)] for w in self.words],
            dtype=np.int32,
        ).reshape(len(self.words), len(token_features("")))
        self.names = list(names)

    def frequencies(self, docs: list[int]) -> np.ndarray:
        """Of each feature: in how many of the documents it occurs."""
        out = np.zeros(len(self.names), dtype=np.int64)
        for i in docs:
            out[np.unique(self.features[np.unique(self.docs[i])])] += 1
        return out


def _fit_field(corpus: _Corpus, docs: np.ndarray, toxic: np.ndarray, rounds: int) -> ToxicField:
    """Fits the chain to tokens labelled from their documents' labels.

    A token of a toxic document is labelled toxic if one of its features is at least 20
    times as common, by documents, among toxic documents as among clean ones and that is no
    chance (by a likelihood ratio, see ``EVIDENCE``); all other tokens are labelled clean.
    """
    n1, n0 = max(1, int(toxic.sum())), max(1, int((1 - toxic).sum()))
    c1 = corpus.frequencies(docs[toxic == 1])
    c0 = corpus.frequencies(docs[toxic == 0])
    usual = np.maximum(c1 + c0, 1) / (n1 + n0)
    with np.errstate(divide="ignore", invalid="ignore"):
        ratio = np.where(c1, c1 * np.log(c1 / (usual * n1)), 0) + np.where(
            c0, c0 * np.log(c0 / (usual * n0)), 0
        )
    evidence = min(EVIDENCE, max(12, n1 / 20))
    marks = (c1 >= 3) & (c1 / n1 >= 20 * (c0 + 0.5) / n0) & (2 * ratio >= evidence)
    used = np.flatnonzero(marks | (c0 >= 0.02 * n0))
    tokens = np.concatenate([corpus.docs[i] for i in docs]) if len(docs) else np.zeros(0, np.int32)
    if len(tokens) == 0:
        return ToxicField({}, 0.0, np.zeros((2, 2)))
    lengths = np.array([len(corpus.docs[i]) for i in docs])
    starts = np.cumsum([0, *lengths])[:-1][lengths > 0]
    y = (marks[corpus.features].any(axis=1)[tokens] & (np.repeat(toxic, lengths) == 1)).astype(float)
    number = np.full(len(corpus.names), -1)
    number[used] = np.arange(len(used))
    grid = number[corpus.features]
    rows, slots = np.nonzero(grid >= 0)
    cols = grid[rows, slots]
    real = np.zeros((2, 2))
    begins = np.zeros(len(y), bool)
    begins[starts] = True
    pair = np.flatnonzero(~begins)
    np.add.at(real, (y[pair - 1].astype(int), y[pair].astype(int)), 1)
    # Gradient ascent on the log-likelihood with a step of its own per weight.
    size = len(corpus.words)
    weight, bias, move = np.zeros(len(used)), -2.0, np.zeros((2, 2))
    power = [np.full(len(used), 1e-8), 1e-8, np.full((2, 2), 1e-8)]
    for _ in range(rounds):
        per_word = np.bincount(rows, weight[cols], minlength=size) + bias
        p, pairs = _in_parts(per_word, tokens, starts, move)
        error = np.bincount(tokens, y - p, minlength=size)
        slopes = [
            np.bincount(cols, error[rows], minlength=len(used)) - 0.1 * weight,
            error.sum(),
            real - pairs - 0.1 * move,
        ]
        for i, g in enumerate(slopes):
            power[i] = power[i] + g * g
        weight = weight + 0.7 * slopes[0] / np.sqrt(power[0])
        bias = bias + 0.7 * slopes[1] / np.sqrt(power[1])
        move = move + 0.7 * slopes[2] / np.sqrt(power[2])
    weights = {corpus.names[i]: float(w) for i, w in zip(used, weight) if abs(w) > 1e-6}
    return ToxicField(weights, float(bias), move)


def _in_parts(
    per_word: np.ndarray, tokens: np.ndarray, starts: np.ndarray, move: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Marginals of all chains, some 100,000 tokens at a time to bound memory."""
    cuts = starts[np.unique(np.searchsorted(starts, np.arange(0, len(tokens), 100_000)).clip(0, len(starts) - 1))]
    p, pairs = np.empty(len(tokens)), np.zeros((2, 2))
    for a, b in zip(cuts, [*cuts[1:], len(tokens)]):
        mine = starts[(starts >= a) & (starts < b)] - a
        p[a:b], more = marginals(per_word[tokens[a:b]], mine, move, joint=True)
        pairs += more
    return p, pairs


def fit_field(texts: list[str | None], toxic: list[int], rounds: int = 18) -> ToxicField:
    """Field from two thirds of the texts, document score from the marginals on the rest."""
    corpus, y = _Corpus(texts), np.array(toxic, dtype=float)
    rest = np.arange(len(texts)) % 3 == 0
    model = _fit_field(corpus, np.flatnonzero(~rest), y[~rest], rounds)
    if rest.any():
        found = model.summarize([texts[i] for i in np.flatnonzero(rest)])[:, :2]
        x = np.hstack([np.ones((len(found), 1)), found])
        goal = y[rest]
        beta = np.zeros(3)
        for _ in range(100):  # Newton, with a slight pull to zero
            p = _sigmoid(x @ beta)
            slope = x.T @ (goal - p) - 0.01 * beta
            bend = (x * (p * (1 - p))[:, None]).T @ x + 0.01 * np.eye(3)
            step = np.linalg.solve(bend, slope)
            beta = beta + np.clip(step, -2, 2)
            if np.abs(step).max() < 1e-8:
                break
        model.score = beta
    return model


def held_out(doc_id: F.Column) -> F.Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> ToxicField:
    """Field fitted on at most ``sample`` toxic and ``2 * sample`` clean labelled documents.

    They are chosen by a hash of ``doc_id`` from rows that are not held out, so the same
    data give the same field. A document labelled both ways counts as toxic; rows without
    id or label are left out. Without labelled rows all scores are one half.
    """
    known = (
        labels.select(F.col("doc_id").cast("long"), F.col("toxic").cast("int"))
        .filter("doc_id is not null and toxic in (0, 1)")
        .filter(~held_out(F.col("doc_id")))
        .groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    )
    # Ids that are in documents only; the sizes below bound what is broadcast and collected.
    ids = docs.select(F.col("doc_id").cast("long").alias("doc_id")).distinct()
    known = known.join(ids, "doc_id", "left_semi")
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    chosen = known.filter("toxic = 1").orderBy(*order).limit(sample).unionAll(
        known.filter("toxic = 0").orderBy(*order).limit(2 * sample)
    )
    rows = (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
        .join(F.broadcast(chosen), "doc_id")
        .groupBy("doc_id").agg(F.max("toxic").alias("toxic"), F.max("text").alias("text"))
        .orderBy(*order).collect()
    )
    return fit_field([r["text"] for r in rows], [r["toxic"] for r in rows])


def score(docs: DataFrame, model: ToxicField, threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id, held_out, score, predicted, n_toxic, spans`` of every whole text.

    ``spans`` are the offending tokens, ``start:end`` in code points, comma-joined, those
    with a marginal of one half or more; runs of neighbours are one span. A null or empty
    text has no token and the score of none. One row per input row, whatever is repeated;
    ``held_out`` is null without a ``doc_id``.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[dict]) -> Iterator[dict]:
        field_ = shared.value
        for batch in batches:
            texts = batch["text"].to_pylist()
            n, spans, scores = [0] * len(texts), [""] * len(texts), np.zeros(len(texts))
            for first, end, toxic, marks in field_.tagged(texts):
                scores[first:end] = field_.scores(_summary(toxic, marks))
                hits = np.flatnonzero(toxic >= 0.5)
                owners = np.searchsorted(marks, hits, side="right") - 1
                for doc in np.unique(owners):
                    mine = hits[owners == doc] - marks[doc]
                    n[first + doc], spans[first + doc] = len(mine), _spans(texts[first + doc], mine)
            yield {"doc_id": batch["doc_id"], "score": scores, "n_toxic": n, "spans": spans}

    given = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")
    )
    found = map_rows(given, run, "doc_id long, score double, n_toxic long, spans string")
    return found.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        F.when(F.col("score") >= threshold, 1).otherwise(0).alias("predicted"),
        "n_toxic",
        "spans",
    )


def _spans(text: str, tokens: np.ndarray) -> str:
    """Offsets of the given tokens of a text; lower-casing may change lengths, so the
    original is split in step with it."""
    places = [m.span() for m in _WORD.finditer(text)]
    if len(places) != len(_words(text)):
        low = [(m.start(), m.end()) for m in _WORD.finditer(text.lower())]
        back = [i for i, c in enumerate(text) for _ in c.lower()] + [len(text)]
        places = [(back[a], back[b]) for a, b in low]
    out: list[list[int]] = []
    last = -2
    for i in tokens:
        a, b = places[i]
        if i == last + 1:
            out[-1][1] = b
        else:
            out.append([a, b])
        last = i
    return ",".join(f"{a}:{b}" for a, b in out)


def drop_toxic(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Documents that are not predicted toxic, with all their columns.

    The decision is made in the pass that reads the text: a score column is added by a
    vectorized function and filtered on, so no text is shuffled.
    """
    model = train(docs, labels)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def toxicity(texts: pd.Series) -> pd.Series:
        return pd.Series(shared.value.scores(shared.value.summarize(list(texts))))

    return docs.filter(toxicity(F.col("text").cast("string")) < threshold)
