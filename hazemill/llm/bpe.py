"""Byte-level BPE as a streaming transducer: tokens leave as soon as no later byte can
change them, and ids become text again one byte at a time."""

from __future__ import annotations

import heapq
import json
import re
import unicodedata
from array import array
from collections.abc import Iterator
from functools import lru_cache

import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers.pre_tokenizers import ByteLevel

from hazemill.llm.common import map_rows
from hazemill.llm.tokens import SPLIT, byte_letters

#: Characters of a text that are looked at in one go, characters of an open word from which
#: on it is streamed, words and pairs that are remembered. They bound memory, not results.
CHUNK, OPEN, KEPT = 1 << 16, 1 << 10, 300_000
#: Bytes of a word up to which it is spelled from the longest tokens on.
SHORT = 64

# The runs that a word of several characters can be of, by its last character.
_RUNS = {"letters": r"\p{L}+", "digits": r"\p{N}+", "space": r"\s+", "other": r"[^\s\p{L}\p{N}]+"}


class MergeList:
    """Tables of a byte-level BPE file, and how far ahead its merges have to look."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as file:
            given = json.load(file)
        model = given["model"]
        if model["type"] != "BPE" or model.get("ignore_merges") or given["pre_tokenizer"]["type"] != "ByteLevel":
            raise ValueError("not a byte-level BPE file with plain merges")
        ids = model["vocab"]
        letters = byte_letters()
        byte = {letter: b for b, letter in enumerate(letters)}
        self.byte_ids = [ids[letter] for letter in letters]
        #: Pair of ids (as one number) to the merge's rank and the id that it makes.
        self.merges: dict[int, tuple[int, int]] = {}
        #: Per id the rank of the merge that makes it (-1 for a byte) and the merge's two sides.
        self.made_at, self.left_of, self.right_of = ([-1] * (1 + max(ids.values())) for _ in range(3))
        pairs = []
        for rank, merge in enumerate(model["merges"]):
            left, right = merge.split(" ") if isinstance(merge, str) else merge
            a, b, made = ids[left], ids[right], ids[left + right]
            self.merges.setdefault(a << 32 | b, (rank, made))
            if self.made_at[made] < 0:
                self.made_at[made], self.left_of[made], self.right_of[made] = rank, a, b
            pairs.append((a, b, made, len(left)))
        self.added = {t["content"]: t["id"] for t in given.get("added_tokens", ())}
        if any(t[k] for t in given.get("added_tokens", ()) for k in ("lstrip", "rstrip", "single_word", "normalized")):
            raise ValueError("added tokens that take their surroundings along are not read")
        self.token_bytes = {
            i: bytes(byte[c] for c in token) if all(c in byte for c in token) else token.encode()
            for token, i in [*ids.items(), *self.added.items()]
        }
        self.lookahead = sufficient_lookahead(pairs)


def sufficient_lookahead(merges: list[tuple[int, int, int, int]]) -> int:
    """Bytes after a token from which on nothing that follows can change the token.

    ``merges`` has, by rank, the left and right id, the id made and the left one's bytes.

    Compare a word with the same word continued. The tokens first differ at a place that
    starts at the word's end and moves left only where a merge (P, Q) takes the token P
    before that place. P then begins the next differing token, so the next such merge
    (P', Q') has P on the left edge of Q'; and it is later, because until then what lies
    left of the place was the same in both. So the ranks grow along a chain, and the longest
    chain, measured in the bytes of its P, is as far as a difference can reach.
    """
    edges: dict[int, set[int]] = {}
    rank_of: dict[int, int] = {}
    for rank, (left, right, made, _) in enumerate(merges):
        if any(rank_of.get(part, -1) >= rank for part in (left, right)):
            raise ValueError("a merge comes before the merges of its parts")
        rank_of[made] = rank
        edges.setdefault(made, {made}).update(edges.get(left, {left}))
    reach: dict[int, int] = {}  # the longest chain of later merges with this token on Q's left edge
    longest = 0
    for left, right, _, length in reversed(merges):
        chain = length + reach.get(left, 0)
        longest = max(longest, chain)
        for token in edges.get(right, (right,)):
            if reach.get(token, 0) < chain:
                reach[token] = chain
    return longest


class Transducer:
    """Merges of words, whole or as a stream of their bytes."""

    def __init__(self, tables: MergeList) -> None:
        self._tables = tables
        self._words: dict[str, bytes] = {}
        self._fits: dict[int, bool] = {}
        self._ids = {token: i for i, token in tables.token_bytes.items() if i not in tables.added.values()}
        #: Length of the longest token by its first two bytes.
        self._longest: dict[bytes, int] = {}
        for token in self._ids:
            self._longest[token[:2]] = max(len(token), self._longest.get(token[:2], 0))
        self._shorter: dict[int, int] = {}
        self._stays: dict[int, bool] = {}
        self.window = max(1024, 4 * tables.lookahead)
        lengths = [1] * (1 + max(tables.token_bytes))
        for i, token in tables.token_bytes.items():
            lengths[i] = len(token)
        self._lengths = lengths

    def merged(self, data: bytes) -> list[int]:
        """Ids of a word: the merge of the least rank first, of equal ones the leftmost."""
        byte_ids, merges = self._tables.byte_ids, self._tables.merges
        ids = [byte_ids[b] for b in data]
        n = len(ids)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = []

        def offer(i: int) -> None:
            j = after[i]
            if j < n:
                key = ids[i] << 32 | ids[j]
                if key in merges:
                    rank, made = merges[key]
                    heapq.heappush(heap, (rank, i, key, made))

        for i in range(n - 1):
            offer(i)
        while heap:
            _, i, key, made = heapq.heappop(heap)
            j = after[i]
            if j >= n or ids[i] << 32 | ids[j] != key:
                continue  # one of the two has been merged since
            ids[i], ids[j] = made, -1
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
            offer(i)
            if before[i] >= 0:
                offer(before[i])
        return [i for i in ids if i >= 0]

    def spelled(self, data: bytes) -> list[int]:
        """The same ids of a short word, found from the longest token on.

        Ids are those of the merges if and only if any two neighbours, merged alone, stay
        these two; and the ids of a beginning of the word are unique. So the first spelling
        whose neighbours all fit is the one, and an end from which none goes on never has to
        be tried again.
        """
        ids, n, longest, fits, lengths = self._ids, len(data), self._longest, self._fits, self._lengths
        out: list[int] = []
        dead: set[int] = set()
        at, token = 0, -1
        while at < n:
            if token < 0:
                stop = min(n, at + longest.get(data[at : at + 2], 1))
                while data[at:stop] not in ids:
                    stop -= 1
                token = ids[data[at:stop]]
            stop = at + lengths[token]
            if stop not in dead:
                pair = out[-1] << 32 | token if out else ~token
                fit = fits.get(pair)
                if fit is None:
                    fit = self._fit(pair, token)
                if fit:
                    out.append(token)
                    at, token = stop, -1
                    continue
            token = self._next_shorter(token)
            if token < 0:
                dead.add(at)
                token = out.pop()
                at -= lengths[token]
        return out

    def _next_shorter(self, token: int) -> int:
        """The longest token that begins this one and is shorter; -1 if there is none."""
        found = self._shorter.get(token)
        if found is None:
            data = self._tables.token_bytes[token]
            found = next((self._ids[data[:n]] for n in range(len(data) - 1, 0, -1) if data[:n] in self._ids), -1)
            self._shorter[token] = found
        return found

    def _fit(self, pair: int, right: int) -> bool:
        """Whether two tokens, merged as one word, stay these two (or one, at a word's start)."""
        stays = self._stays.get(right)
        if stays is None:  # some lists have tokens whose own bytes are merged differently
            stays = self._stays[right] = self.merged(self._tables.token_bytes[right]) == [right]
        if len(self._fits) >= 2 * KEPT:
            self._fits.clear()
        found = self._fits[pair] = stays and (pair < 0 or self._apart(pair >> 32, right))
        return found

    def _apart(self, left: int, right: int) -> bool:
        """Goes back in time at the border of two tokens: were the two that lay there ever
        due to be merged before one of them was taken by another merge? Of equal ranks the
        left merge comes first, so it is undone last."""
        tables = self._tables
        merges, made_at = tables.merges, tables.made_at
        until = len(merges) + 1
        while True:
            merge = merges.get(left << 32 | right)
            if merge is not None and merge[0] < until:
                return False
            from_left, from_right = made_at[left], made_at[right]
            if from_left > from_right:
                until, left = from_left, tables.right_of[left]
            elif from_right >= 0:
                until, right = from_right + 1, tables.left_of[right]
            else:
                return True

    def stable(self, data: bytearray) -> list[int]:
        """Takes from the front of an open word's bytes the ids that are final."""
        ids = self.merged(bytes(data))
        end, count, limit = 0, 0, len(data) - self._tables.lookahead
        while count < len(ids) and end + self._lengths[ids[count]] <= limit:
            end += self._lengths[ids[count]]
            count += 1
        del data[:end]
        return ids[:count]

    def word(self, word: str) -> bytes:
        """Little-endian ids of a whole word."""
        known = self._words.get(word)
        if known is not None:
            return known
        data = word.encode("utf-8", "surrogatepass")
        if len(data) > self.window:
            run = OpenWord(self)
            return run.feed(data) + run.close()
        found = packed(self.spelled(data) if len(data) <= SHORT else self.merged(data))
        if len(word) <= SHORT:
            if len(self._words) >= KEPT:
                self._words.clear()
            self._words[word] = found
        return found


def packed(ids: list[int]) -> bytes:
    out = array("I", ids)
    if out.itemsize != 4:
        raise ValueError("ids need 32-bit numbers")
    return out.tobytes()


class OpenWord:
    """A word that comes in pieces; it never holds more than a window and a piece of it."""

    def __init__(self, transducer: Transducer) -> None:
        self._transducer, self._rest = transducer, bytearray()

    def feed(self, data: bytes) -> bytes:
        out, step = [], self._transducer.window
        for start in range(0, len(data), step):
            self._rest += data[start : start + step]
            if len(self._rest) >= step:
                out.append(packed(self._transducer.stable(self._rest)))
        return b"".join(out)

    def close(self) -> bytes:
        ids = self._transducer.merged(bytes(self._rest))
        self._rest.clear()
        return packed(ids)


@lru_cache(maxsize=1)
def latin_split() -> re.Pattern:
    """``SPLIT`` for texts of Latin-1 characters, its classes written out: twice as fast."""
    every = "".join(map(chr, range(256)))
    letters, digits, space = ("".join(map(re.escape, regex.findall(form, every))) for form in (r"\p{L}", r"\p{N}", r"\s"))
    inside = {r"[^\s\p{L}\p{N}]": f"[^{space}{letters}{digits}]", r"\p{L}": f"[{letters}]", r"\p{N}": f"[{digits}]",
              r"\S": f"[^{space}]", r"\s": f"[{space}]"}
    form = SPLIT
    for general, written in inside.items():
        form = form.replace(general, written)
    return re.compile(form)


@lru_cache(maxsize=1)
def newer_letters() -> regex.Pattern:
    """Letters and digits that ``regex`` knows and the tokenizers library, whose table is
    older, splits like punctuation. Of those that Python's own table lacks the library is
    asked: does the character stay with a letter or a digit before it?"""
    every = "".join(chr(c) for c in range(0x110000) if not 0xD800 <= c <= 0xDFFF)
    newer = [c for c in regex.findall(r"[\p{L}\p{N}]", every) if unicodedata.category(c) == "Cn"]
    known = set()
    for first in "a1":
        pieces = ByteLevel(add_prefix_space=False).pre_tokenize_str("".join(f"{first}{c}\n" for c in newer))
        known |= {newer[start // 3] for _, (start, end) in pieces if start % 3 == 0 and end - start == 2}
    newer = [ord(c) for c in newer if c not in known]
    ranges: list[list[int]] = []
    for c in newer:
        if ranges and ranges[-1][1] == c - 1:
            ranges[-1][1] = c
        else:
            ranges.append([c, c])
    return regex.compile(f"[{''.join(f'{chr(a)}-{chr(b)}' for a, b in ranges)}]" if ranges else r"(?!)")


class Encoder:
    """Ids of texts, whole or in pieces of any length (``feed`` and ``close``).

    Splits a text at added tokens, then into words, then merges each word. Between two
    pieces it keeps the last word, and of a word longer than ``OPEN`` only the bytes that
    the lookahead still needs.
    """

    def __init__(self, tables: MergeList) -> None:
        self.tables = tables
        self._transducer = Transducer(tables)
        self._split, self._latin = regex.compile(SPLIT), latin_split()
        self._newer = newer_letters()
        self._runs = {kind: regex.compile(form) for kind, form in _RUNS.items()}
        self._added = tables.added
        longest = sorted(map(regex.escape, self._added), key=len, reverse=True)
        self._cut = regex.compile(f"({'|'.join(longest)})") if longest else None
        self._prefixes = sorted({t[:n] for t in self._added for n in range(1, len(t))}, key=len, reverse=True)
        self._reset()

    def _reset(self) -> None:
        self._held, self._kind, self._open = "", "", None

    def encode(self, text: str) -> bytes:
        """Little-endian unsigned 32-bit ids of a whole text."""
        self._reset()
        if len(text) <= CHUNK:
            return b"".join(self._segments(text, self._closed))
        out = [self.feed(text[at : at + CHUNK]) for at in range(0, len(text), CHUNK)]
        return b"".join(out) + self.close()

    def _shadow(self, text: str) -> str:
        return text if text.isascii() else self._newer.sub("!", text)

    def _split_words(self, text: str) -> list[str]:
        try:
            text.encode("latin-1")
            return self._latin.findall(text)
        except UnicodeEncodeError:
            pass
        shadow = self._shadow(text)
        if shadow is text or shadow == text:
            return self._split.findall(text)
        return [text[m.start() : m.end()] for m in self._split.finditer(shadow)]

    def feed(self, piece: str) -> bytes:
        return b"".join(self._segments(self._held + piece, self._going_on))

    def close(self) -> bytes:
        held, self._held = self._held, ""
        out = self._closed(held)
        self._reset()
        return out

    def _segments(self, text: str, last) -> Iterator[bytes]:
        """What lies between added tokens, each of which ends the words before it."""
        parts = self._cut.split(text) if self._cut else [text]
        for part, token in zip(parts[:-1:2], parts[1::2]):
            yield self._closed(part)
            yield packed([self._added[token]])
        yield last(parts[-1])

    def _closed(self, text: str) -> bytes:
        """Ids of the open word and of a text that ends here."""
        out, text = self._continue(text)
        if self._open:
            out += self._end_open(text)
            text = ""
        return out + b"".join(map(self._transducer.word, self._split_words(text)))

    def _going_on(self, text: str) -> bytes:
        """Ids of what is final of a text that may go on; the rest is held."""
        # An added token may have begun.
        begun = next((p for p in self._prefixes if text.endswith(p)), "")
        text = text[: len(text) - len(begun)]
        out, text = self._continue(text)
        if self._open:
            self._held = text + begun
            return out
        words = self._split_words(text)
        held = words.pop() if words else ""
        if words and words[-1] == "'":  # may become one word with a letter or two
            held = words.pop() + held
        out += b"".join(map(self._transducer.word, words))
        if len(held) > OPEN:
            kind = next(k for k, run in self._runs.items() if run.fullmatch(self._shadow(held[-1])))
            self._kind, self._open = kind, OpenWord(self._transducer)
            more, held = self._feed_open(held)
            out += more
        self._held = held + begun
        return out

    def _continue(self, text: str) -> tuple[bytes, str]:
        """Ids that the start of ``text`` adds to the open word, and what is left of it."""
        if not self._open:
            return b"", text
        m = self._runs[self._kind].match(self._shadow(text))
        end = m.end() if m else 0
        out, left = self._feed_open(text[:end])
        text = left + text[end:]
        if len(text) > len(left):  # another word has begun
            out += self._end_open("")
        return out, text

    def _feed_open(self, run: str) -> tuple[bytes, str]:
        # The last of several white characters may belong to the word after them.
        left = run[-1:] if self._kind == "space" else ""
        return self._open.feed(run[: len(run) - len(left)].encode("utf-8", "surrogatepass")), left

    def _end_open(self, run: str) -> bytes:
        out = self._open.feed(run.encode("utf-8", "surrogatepass")) + self._open.close()
        self._open, self._kind = None, ""
        return out


class Decoder:
    """Text of ids, whole or in pieces: a machine whose state is the character begun.

    Bytes that are no UTF-8 become U+FFFD, one for each longest start of a character that
    does not go on. Ids of no token give nothing.
    """

    def __init__(self, tables: MergeList) -> None:
        self._bytes = tables.token_bytes
        self._whole: dict[int, str] = {}
        for i, token in self._bytes.items():
            text = token.decode("utf-8", "replace")
            if text.encode() == token:
                self._whole[i] = text
        self._begun = b""

    def decode(self, ids: bytes) -> str:
        self._begun = b""
        return self.feed(ids) + self.close()

    def feed(self, ids: bytes) -> str:
        given = array("I")
        given.frombytes(ids)
        whole = self._whole
        if not self._begun:
            try:
                return "".join([whole[i] for i in given])
            except KeyError:
                pass
        out = []
        for i in given:
            if i in whole and not self._begun:
                out.append(whole[i])
            else:
                for b in self._bytes.get(i, b""):
                    out.append(self._step(b))
        return "".join(out)

    def close(self) -> str:
        out, self._begun = "�" if self._begun else "", b""
        return out

    def _step(self, b: int) -> str:
        if self._begun:
            low, high = _second(self._begun[0]) if len(self._begun) == 1 else (0x80, 0xBF)
            if low <= b <= high:
                self._begun += bytes((b,))
                if len(self._begun) < _length(self._begun[0]):
                    return ""
                done, self._begun = self._begun.decode(), b""
                return done
            self._begun = b""
            return "�" + self._step(b)
        if b < 0x80:
            return chr(b)
        if _length(b):
            self._begun = bytes((b,))
            return ""
        return "�"


def _length(lead: int) -> int:
    """Bytes of the character that a byte begins; 0 if it begins none."""
    return 2 * (0xC2 <= lead <= 0xDF) + 3 * (0xE0 <= lead <= 0xEF) + 4 * (0xF0 <= lead <= 0xF4)


def _second(lead: int) -> tuple[int, int]:
    """Bytes that may follow the first: no longer forms, surrogates or numbers too large."""
    return (0xA0 if lead == 0xE0 else 0x90 if lead == 0xF0 else 0x80), (0x9F if lead == 0xED else 0x8F if lead == 0xF4 else 0xBF)


@lru_cache(maxsize=2)
def _machines(path: str) -> tuple[Encoder, Decoder]:
    """One pair per file in a Python worker, for all its tasks."""
    tables = MergeList(path)
    return Encoder(tables), Decoder(tables)


def encode_texts(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_tokens, ids`` of every whole text; ids as little-endian unsigned 32-bit
    integers in one binary.

    The ids are those of the tokenizers file at ``path`` without added start or end tokens;
    literal added tokens in a text get their own ids. A null text is an empty one. One row
    per input row, repeated or without ``doc_id``; an empty table gives no rows; other
    columns are not looked at. Nothing is shuffled, and memory besides the batch does not
    grow with a text.
    """

    def run(batches: Iterator[dict]) -> Iterator[dict]:
        encoder = _machines(path)[0]
        for batch in batches:
            ids = [encoder.encode(text or "") for text in batch["text"].to_pylist()]
            yield {"doc_id": batch["doc_id"], "n_tokens": [len(x) // 4 for x in ids], "ids": ids}

    given = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return map_rows(given, run, "doc_id long, n_tokens long, ids binary")


def decode_ids(encoded: DataFrame, path: str) -> DataFrame:
    """The rows of ``encode_texts`` with their ``text`` made from the ids again. Null ids
    are none; ids that the file lacks give nothing."""

    def run(batches: Iterator[dict]) -> Iterator[dict]:
        decoder = _machines(path)[1]
        for batch in batches:
            texts = [decoder.decode(ids or b"") for ids in batch["ids"].to_pylist()]
            yield {**{k: batch[k] for k in ("doc_id", "n_tokens", "ids")}, "text": texts}

    return map_rows(
        encoded.select("doc_id", "n_tokens", "ids"), run, "doc_id long, n_tokens long, ids binary, text string"
    )
