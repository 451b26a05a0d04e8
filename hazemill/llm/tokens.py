"""Byte-level BPE ids of whole texts."""

from __future__ import annotations

import re

import numpy as np
import tiktoken
from tokenizers import Tokenizer

#: Fixed value: how byte-level BPE splits a text before merging.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: White space runs from here on overflow the splitter's stack; such texts go by the slower library.
LONG_SPACE = re.compile(r"\s{50000}")


def byte_letters() -> str:
    """The letter that stands for each byte in a byte-level vocabulary."""
    shown = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    other = iter(range(256, 512))
    return "".join(chr(b) if b in set(shown) else chr(next(other)) for b in range(256))


class ByteLevelEncoder:
    """Ids of texts as a tokenizers file of a byte-level BPE gives them. With ``added`` a
    literal added token in a text gets its own id, as by the library's default; without, it
    is plain text."""

    def __init__(self, path: str, added: bool = False) -> None:
        self._slow = Tokenizer.from_file(path)
        self._slow.encode_special_tokens = not added
        tokens = self._slow.get_added_tokens_decoder().items() if added else ()
        self._added = {t.content: i for i, t in tokens}
        # Tokens that take blanks along or need a word's edge are left to the library.
        self._plain = not any(t.lstrip or t.rstrip or t.single_word or t.normalized for _, t in tokens)
        longest = sorted(map(re.escape, self._added), key=len, reverse=True)
        self._cut = re.compile(f"({'|'.join(longest)})") if longest else None
        vocabulary = self._slow.get_vocab(with_added_tokens=False)
        byte = {ord(letter): b for b, letter in enumerate(byte_letters())}
        # In these files the ids are in the order of the merges, so an id is a rank too.
        ranks = {bytes(byte[ord(x)] for x in token): i for token, i in vocabulary.items() if "<|" not in token}
        self._merge = tiktoken.Encoding("byte-level", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={})

    def encode_bytes(self, text: str) -> bytes:
        """Little-endian unsigned 32-bit ids."""
        parts = self._cut.split(text) if self._cut else [text]
        if len(parts) > 1 and not self._plain:
            ids = self._slow.encode(text, add_special_tokens=False).ids
        else:
            ids = []
            for i, part in enumerate(parts):
                ids += [self._added[part]] if i % 2 else self._encode(part)
        return np.array(ids, "<u4").tobytes()

    def _encode(self, text: str) -> list[int]:
        if len(text) >= 50_000 and LONG_SPACE.search(text):
            return self._slow.encode(text, add_special_tokens=False).ids
        return self._merge.encode_ordinary(text)
