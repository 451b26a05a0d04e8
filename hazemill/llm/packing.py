"""Packing of tokenized documents into fixed-length sequences by exact complements."""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hazemill.llm.common import map_rows, stored
from hazemill.llm.tokens import ByteLevelEncoder

#: Rows of one length are ranked in this many parts, so that a frequent length (full
#: pieces of long documents) is not one task.
PARTS = 64


def pieces(
    docs: DataFrame, tokenizer: str, size: int = 2048, end_id: int = 0,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32`` of every document's ids and ``end_id``.

    A document of more than ``size`` ids is cut into full pieces; what is left over is its
    first piece. ``tokenizer`` names a byte-level BPE file of the tokenizers library, whose
    added tokens get their ids where a text holds them.
    """

    def run(batches: Iterator[dict]) -> Iterator[dict]:
        encoder = ByteLevelEncoder(tokenizer, added=True)
        end = np.array([end_id], "<u4").tobytes()
        for batch in batches:
            out: dict[str, list] = {k: [] for k in ("doc_id", "piece", "start", "length", "ids_crc32")}
            for doc, text in zip(batch["doc_id"].to_pylist(), batch["text"].to_pylist()):
                ids = encoder.encode_bytes(text or "") + end
                count = len(ids) // 4
                start, stop, piece = 0, count % size or min(size, count), 0
                while start < count:
                    out["doc_id"].append(doc)
                    out["piece"].append(piece)
                    out["start"].append(start)
                    out["length"].append(stop - start)
                    out["ids_crc32"].append(zlib.crc32(ids[4 * start : 4 * stop]))
                    start, stop, piece = stop, stop + size, piece + 1
            yield out

    given = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")
    )
    return map_rows(given, run, "doc_id long, piece int, start long, length long, ids_crc32 long")


def _fill(counts: np.ndarray, size: int) -> list[tuple[list[int], int]]:
    """Whole sequences from the available lengths: ``(lengths, how many)``.

    The index of exact complements: a length that fills a sequence alone, then two that
    add up to it, then three; each combination is used as often as its lengths last. What
    remains goes by best fit, longest first, into the open sequence it fills most; equal
    sequences are handled together, so the work depends on ``size``, not on the documents.
    """
    left = counts.astype(np.int64).copy()
    made: list[tuple[list[int], int]] = []

    def use(lengths: list[int], times: int) -> None:
        if times > 0:
            made.append((lengths, int(times)))
            for n in lengths:
                left[n] -= times

    use([size], left[size])
    for a in range(size - 1, 0, -1):
        b = size - a
        if b > a:
            break
        use([a, b], left[a] // 2 if a == b else min(left[a], left[b]))
    sums = {}
    for a in range(size - 2, 0, -1):  # longest first: they are the hardest to place
        if left[a] <= 0:
            continue
        rest = size - a
        for b in range(min(a, rest - 1), (rest + 1) // 2 - 1, -1):
            c = rest - b
            if left[b] <= 0 or left[c] <= 0:
                continue
            need = sums.setdefault((a, b, c), [(n, (a, b, c).count(n)) for n in {a, b, c}])
            use([a, b, c], min(left[n] // k for n, k in need))
            if left[a] <= 0:
                break
    # Best fit on the rest. Open sequences of one room and one content are one entry.
    rooms: list[int] = []
    open_: dict[int, list[tuple[list[int], int]]] = {}

    def put(lengths: list[int], times: int, room: int) -> None:
        if room == 0:
            made.append((lengths, times))
        else:
            if room not in open_:
                insort(rooms, room)
            open_.setdefault(room, []).append((lengths, times))

    for n in range(size, 0, -1):
        todo = int(left[n])
        while todo > 0:
            at = bisect_left(rooms, n)
            if at == len(rooms):
                each = size // n  # new sequences take as many of this length as fit
                if todo >= each:
                    put([n] * each, todo // each, size - each * n)
                if todo % each:
                    put([n] * (todo % each), 1, size - (todo % each) * n)
                todo = 0
            else:
                room = rooms[at]
                lengths, times = open_[room].pop()
                took = min(times, todo)
                if times > took:
                    open_[room].append((lengths, times - took))
                elif not open_[room]:
                    del open_[room], rooms[at]
                put([*lengths, n], took, room - n)
                todo -= took
    for room in rooms:
        made.extend(open_[room])
    return made


def _places(made: list[tuple[list[int], int]]) -> list[tuple[int, int, int, int, int]]:
    """``(length, first rank, how many, first sequence, offset)``: the pieces of a length,
    in rank order, fill its places one after another."""
    rank: dict[int, int] = {}
    out, sequence = [], 0
    for lengths, times in made:
        offset = 0
        for n in lengths:
            first = rank.get(n, 0)
            out.append((n, first, times, sequence, offset))
            rank[n] = first + times
            offset += n
        sequence += times
    return out


def pack(cut: DataFrame, size: int = 2048) -> DataFrame:
    """Adds ``sequence_id, offset`` to pieces (``doc_id, piece, length, ...``).

    Only the count of pieces of each length goes to the driver (``size`` numbers), which
    plans how often each combination of lengths is used; pieces then find their place by
    their rank among those of equal length. Ranks are taken in 64 parts per length. Rows
    that are equal in all columns are interchangeable; every row gets a place of its own.
    """
    spark = cut.sparkSession
    part = F.expr(f"pmod(xxhash64(doc_id, piece, ids_crc32, spark_partition_id()), {PARTS})")
    # The part is written down, so both uses below see the same one.
    dealt = stored(cut.withColumn("_part", part.cast("int")), "pieces")
    sizes = dealt.groupBy("length", "_part").agg(F.count("*").alias("_n"))
    before = Window.partitionBy("length").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = stored(sizes.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0))), "lengths")
    counts = np.zeros(size + 1, dtype=np.int64)
    for row in sizes.groupBy("length").agg(F.sum("_n").alias("n")).collect():
        counts[row["length"]] = row["n"]
    places = _places(_fill(counts, size))
    shape = "length long, _first long, _times long, _sequence long, offset long"
    # At most a few places per length and combination: bounded by size, not by documents.
    plan = spark.createDataFrame(places or [(0, 0, 0, 0, 0)], shape)
    order = Window.partitionBy("length", "_part").orderBy("doc_id", "piece", "ids_crc32", "start")
    ranked = dealt.withColumn("_rank", F.row_number().over(order) - 1)
    ranked = ranked.join(F.broadcast(sizes.drop("_n")), ["length", "_part"])
    ranked = ranked.withColumn("_rank", F.col("_rank") + F.col("_before"))
    return _placed(ranked, plan).select(*cut.columns, "sequence_id", "offset")


def _placed(ranked: DataFrame, plan: DataFrame) -> DataFrame:
    """Each rank's place: the last one of its length that begins at or before it."""
    firsts = plan.groupBy("length").agg(
        F.sort_array(F.collect_list(F.struct("_first", "_sequence", "offset"))).alias("_places")
    )
    # Binary search in the places of a length: 20 steps reach a million of them.
    found = F.expr(
        "aggregate(sequence(1, 20), named_struct('lo', 0, 'hi', size(_places) - 1), (s, i) ->"
        " if(s.lo >= s.hi, s, if(_places[int((s.lo + s.hi + 1) / 2)]._first <= _rank,"
        " named_struct('lo', int((s.lo + s.hi + 1) / 2), 'hi', s.hi),"
        " named_struct('lo', s.lo, 'hi', int((s.lo + s.hi + 1) / 2) - 1))), s -> _places[s.lo])"
    )
    placed = ranked.join(F.broadcast(firsts), "length").withColumn("_at", found)
    return placed.withColumn(
        "sequence_id", F.col("_at._sequence") + F.col("_rank") - F.col("_at._first")
    ).withColumn("offset", F.col("_at.offset"))


def pack_documents(docs: DataFrame, tokenizer: str, size: int = 2048, end_id: int = 0) -> DataFrame:
    """Documents as few sequences of at most ``size`` tokens as the method finds.

    One row per piece: ``doc_id, piece, start, length, ids_crc32, sequence_id, offset``.
    A null or empty text is the end id alone. Repeated rows and rows without ``doc_id`` are
    packed like any other; an empty table gives no rows; other columns are not looked at.
    """
    return pack(pieces(docs, tokenizer, size, end_id), size)
