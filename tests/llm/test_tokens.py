"""Byte-level ids of texts that hold added tokens, against the library's defaults."""

from __future__ import annotations

import zlib

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from hazemill.llm import packing
from hazemill.llm.tokens import ByteLevelEncoder


def test_added_tokens_get_their_ids_as_by_the_library():
    path = public_tokenizers.path("byte_bpe_50k.json")
    own, encoder = Tokenizer.from_file(path), ByteLevelEncoder(path, added=True)
    texts = ["", " it's é 漢字 \n 12", "a<|endoftext|>b", "<|endoftext|>", " x  <|endoftext|><|endoftext|>  it's\n<|endoftext", " " * 60_000 + "x<|endoftext|> "]
    want = [np.array(e.ids, "<u4").tobytes() for e in own.encode_batch(texts, add_special_tokens=False)]
    assert [encoder.encode_bytes(t) for t in texts] == want
    assert np.frombuffer(want[-4], "<u4").tolist() == [64, 50256, 65]


def test_packed_pieces_hold_added_tokens(spark):
    ids = np.array([64, 50256, 65, 0], "<u4")
    docs = spark.createDataFrame([(1, "a<|endoftext|>b", "k")], "doc_id long, text string, kind string")
    row = packing.pieces(docs, public_tokenizers.path("byte_bpe_50k.json")).first()
    assert (row.start, row.length, row.ids_crc32) == (0, 4, zlib.crc32(ids.tobytes()))
