"""SentencePiece ids as the shortest path of a weighted transducer.

The transducer is made of three parts: the normaliser (a space becomes the space mark, one
mark goes in front), one path per piece, and one path of byte pieces per character that no
piece has. Composed with a text it is a lattice whose states are a place in the text and
the piece that ends there. A piece after another weighs nothing if merging both together
would leave the two as they are, and infinitely much if it would not. A sequence of pieces
is what merging makes of a text exactly if that holds for all its neighbours, so in the
tropical semiring the one path of finite weight is the shortest one, and each place has one
state that it can pass.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MARK = "▁"
#: Stretches of text and pairs of pieces whose paths are kept at hand; the store starts anew
#: beyond that, which costs time, not results.
KEPT = 250_000


class Transducer:
    """Encoder and decoder of one model file of kind BPE with byte fallback."""

    def __init__(self, path: str) -> None:
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = model.get_piece_size()
        self.bytes_out: list[bytes] = [b""] * size
        self._rank: dict[str, float] = {}
        ids: dict[str, int] = {}
        self._byte = [0] * 256
        for i in range(size):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                self._byte[int(piece[1:-1], 16)] = i
                self.bytes_out[i] = bytes([int(piece[1:-1], 16)])
            elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
                ids[piece] = i
                self._rank[piece] = -model.get_score(i)
                self.bytes_out[i] = piece.replace(MARK, " ").encode()
        if any(MARK in p.lstrip(MARK) for p in ids):
            raise ValueError("a piece goes on after a space: texts cannot be cut at spaces")
        # Only pieces that merging can make have a path.
        self._ids = {p: i for p, i in ids.items() if len(p) == 1 or self._merged(p) == [p]}
        self._automaton = ahocorasick.Automaton()
        for piece in self._ids:
            self._automaton.add_word(piece, piece)
        self._automaton.make_automaton()
        self._inside = {p[k : k + 2] for p in self._rank for k in range(len(p) - 1)}
        self._fits: dict[tuple[str, str], bool] = {}
        self._paths: dict[str, bytes] = {}
        self._older: dict[str, bytes] = {}

    def _merged(self, text: str) -> list[str]:
        """What merging neighbours, best piece first, leftmost first, makes of a short text."""
        parts, rank = list(text), self._rank
        while len(parts) > 1:
            best = min(range(len(parts) - 1), key=lambda k: rank.get(parts[k] + parts[k + 1], np.inf))
            if parts[best] + parts[best + 1] not in rank:
                break
            parts[best : best + 2] = [parts[best] + parts[best + 1]]
        return parts

    def _weightless(self, left: str, right: str) -> bool:
        if left[-1] + right[0] not in self._inside:
            return True
        known = self._fits.get((left, right))
        if known is None:
            known = self._merged(left + right) == [left, right]
            if len(self._fits) >= KEPT:
                self._fits.clear()
            self._fits[left, right] = known
        return known

    def _fill(self, text: str, last: list[str], end: int) -> None:
        """Characters without piece up to a place pass it by themselves."""
        while end and not last[end]:
            last[end] = text[end - 1]
            end -= 1

    def _shortest_path(self, text: str) -> list[str]:
        """The pieces of a normalised stretch; a character without piece is one by itself.

        The automaton gives the pieces that end at each place, from left to right.
        """
        n, last, fits = len(text), [""] * (len(text) + 1), self._fits
        for at, piece in self._automaton.iter(text):
            end = at + 1
            if last[end]:
                continue  # the one state of this place is known
            before = last[end - len(piece)]
            if not before:
                if end == len(piece):
                    last[end] = piece
                else:  # only a character without piece can have left no state
                    self._fill(text, last, end - len(piece))
                    before = last[end - len(piece)]
            if before:
                known = fits.get((before, piece))
                if known if known is not None else self._weightless(before, piece):
                    last[end] = piece
        self._fill(text, last, n)
        out, end = [], n
        while end:
            out.append(last[end])
            end -= len(last[end])
        return out[::-1]

    def _keep(self, stretch: str, found: bytes) -> bytes:
        """Kept in two generations: the older one goes when the newer is full."""
        if len(stretch) <= 64:
            if len(self._paths) >= KEPT:
                self._paths, self._older = {}, self._paths
            self._paths[stretch] = found
        return found

    def _path(self, stretch: str) -> bytes:
        known = self._paths.get(stretch)
        if known is not None:
            return known
        known = self._older.get(stretch)
        if known is None:
            out: list[int] = []
            for piece in self._shortest_path(stretch):
                i = self._ids.get(piece)
                out += [i] if i is not None else [self._byte[b] for b in piece.encode("utf-8", "replace")]
            known = np.array(out, "<i4").tobytes()
        return self._keep(stretch, known)

    def _stretches(self, unit: str) -> Iterator[str]:
        """Cuts where no piece has the two characters next to each other: the lattice has one
        state there, whatever comes before and after."""
        start, inside = 0, self._inside
        for k in range(1, len(unit)):
            if unit[k - 1 : k + 1] not in inside:
                yield unit[start:k]
                start = k
        yield unit[start:]

    def encode(self, text: str) -> bytes:
        """Little-endian 32-bit ids of the whole text."""
        if not text:
            return b""
        out: list[bytes] = []
        spaces = ""
        for word in text.replace(MARK, " ").split(" "):
            spaces += MARK
            if not word:
                continue
            unit, spaces = spaces + word, ""
            found = self._paths.get(unit)
            if found is None:
                found = self._older.get(unit)
                if found is None:
                    found = b"".join(map(self._path, self._stretches(unit)))
                self._keep(unit, found)
            out.append(found)
        if spaces:
            out.append(self._path(spaces))
        return b"".join(out)

    def decode(self, ids: list[int]) -> str:
        """The text that the ids stand for, without the mark in front."""
        text = b"".join(map(self.bytes_out.__getitem__, ids)).decode("utf-8", "replace")
        return text[1:] if text.startswith(" ") else text


def encode_texts(docs: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_ids, ids_crc32, round_trip, ids`` of every whole text.

    ``round_trip`` tells whether decoding the ids gives the text back; it does not for texts
    that hold the space mark itself, which reads as a space. A null text is an empty one and
    has no ids. One row per input row, repeated or without ``doc_id``; an empty table gives
    no rows; other columns are not looked at. Texts are not shuffled.
    """
    schema = "doc_id long, n_ids long, ids_crc32 long, round_trip boolean, ids array<int>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        transducer = Transducer(model)
        for whole in batches:
            # Some texts at a time: their ids take more room than they do.
            for at in range(0, whole.num_rows, 500):
                batch = whole.slice(at, 500)
                texts = [t or "" for t in batch.column(1).to_pylist()]
                found = [transducer.encode(t) for t in texts]
                values = np.frombuffer(b"".join(found), "<i4")
                ends = np.cumsum([0, *(len(x) // 4 for x in found)])
                back = [transducer.decode(values[a:b].tolist()) for a, b in zip(ends, ends[1:])]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0),
                        pa.array(np.diff(ends)),
                        pa.array([zlib.crc32(x) for x in found], pa.int64()),
                        pa.array([a == b for a, b in zip(texts, back)]),
                        pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values)),
                    ],
                    names=["doc_id", "n_ids", "ids_crc32", "round_trip", "ids"],
                )

    given = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")
    )
    return given.mapInArrow(run, schema)


def decode_ids(encoded: DataFrame, model: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """``doc_id, text``: the text of each row's ids; null ids are none."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        transducer = Transducer(model)
        for batch in batches:
            texts = [transducer.decode(x or []) for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(texts, pa.string())], names=["doc_id", "text"]
            )

    given = encoded.select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(ids_col).cast("array<int>").alias("ids")
    )
    return given.mapInArrow(run, "doc_id long, text string")
