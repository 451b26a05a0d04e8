"""The streaming transducer against the tokenizers library, and its lookahead against words
of random merge lists."""

from __future__ import annotations

import hashlib
import itertools
import json
import random
import time

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from hazemill.llm import bpe
from hazemill.llm.queries import llm_queries
from hazemill.llm.tokens import byte_letters

PATH = public_tokenizers.path("byte_bpe_50k.json")
END = "<|endoftext|>"


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def tables():
    return bpe.MergeList(PATH)


def ids(packed):
    return np.frombuffer(packed, "<u4").tolist()


def pieces(text, rng, most):
    at = 0
    while at < len(text):
        step = rng.randrange(1, most + 1)
        yield text[at : at + step]
        at += step


def test_texts_whole_and_in_pieces(library, tables):
    rng = random.Random(3)
    encoder, decoder = bpe.Encoder(tables), bpe.Decoder(tables)
    pools = ["ab", "a", "the ing tion er", " a", " \n\t", "'slrvemtd ", f"{END} x", "0123456789 ", "éèß日本語🙂 a", "!?.-_= \n", "\x1c\x85　 ."]
    for n in range(1200):
        pool = rng.choice(pools) + rng.choice(pools)
        text = "".join(rng.choice(pool) for _ in range(rng.randrange(1, rng.choice((5, 50, 500, 4000)))))
        if n % 5 == 0:
            run = rng.choice(("a", " ", "\n", "=", "7", "é", "-", "　", "the", "<|"))
            text = run * rng.randrange(1, 3000) + text + rng.choice(("", " ", "x", " x", "'", END[:5]))
        if n % 7 == 0:
            text = text.replace("a", END, 2)
        want = library.encode(text, add_special_tokens=False).ids
        assert ids(encoder.encode(text)) == want
        streamed = b"".join(encoder.feed(p) for p in pieces(text, rng, rng.choice((1, 3, 20, 700, 3000)))) + encoder.close()
        assert ids(streamed) == want
        assert decoder.decode(streamed) == library.decode(want, skip_special_tokens=False) == text


def test_every_character_is_split_as_by_the_library(library, tables):
    encoder = bpe.Encoder(tables)
    every = [chr(c) for c in range(0x110000) if not 0xD800 <= c <= 0xDFFF]
    for at in range(0, len(every), 20_000):
        text = "".join(f"a{c}1{c}{c} {c}!{c}'s" for c in every[at : at + 20_000])
        assert ids(encoder.encode(text)) == library.encode(text, add_special_tokens=False).ids, at


def test_decoding_of_any_ids(library, tables):
    rng = random.Random(5)
    decoder = bpe.Decoder(tables)
    odd = [i for i, token in tables.token_bytes.items() if max(token) >= 0x80]
    for _ in range(3000):
        given = [rng.choice(odd) if rng.random() < 0.7 else rng.randrange(50_300) for _ in range(rng.randrange(20))]
        packed, cut = bpe.packed(given), 4 * rng.randrange(len(given) + 1)
        want = library.decode(given, skip_special_tokens=False)
        assert decoder.decode(packed) == want
        assert decoder.feed(packed[:cut]) + decoder.feed(packed[cut:]) + decoder.close() == want


def merge_list(tmp_path, rng, letters, count):
    """A file with random merges in a valid order."""
    tokens, merges = list(letters), []
    for _ in range(10 * count):
        if len(merges) == count:
            break
        left, right = rng.choice(tokens), rng.choice(tokens)
        if left + right not in tokens and len(left + right) < 10:
            merges.append([left, right])
            tokens.append(left + right)
    vocab = {token: i for i, token in enumerate([*byte_letters(), *tokens[len(letters) :]])}
    path = tmp_path / f"{rng.random()}.json"
    model = {"type": "BPE", "vocab": vocab, "merges": merges, "ignore_merges": False}
    whole = {"version": "1.0", "pre_tokenizer": {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True},
             "added_tokens": [], "model": model}
    path.write_text(json.dumps(whole))
    return bpe.MergeList(str(path))


def test_tokens_before_the_lookahead_are_final(tmp_path):
    rng = random.Random(8)
    reached = []
    for _ in range(60):
        tables = merge_list(tmp_path, rng, "abc"[: rng.randrange(1, 4)], rng.randrange(1, 14))
        machine = bpe.Transducer(tables)
        furthest = 0
        for _ in range(150):
            word = "".join(rng.choice("abc") for _ in range(rng.randrange(1, 30))).encode()
            first = machine.merged(word)
            assert first == machine.spelled(word)
            for more in itertools.chain("abc", ("".join(rng.choice("abc") for _ in range(6)) for _ in range(4))):
                then = machine.merged(word + more.encode())
                same = sum(1 for _ in itertools.takewhile(lambda p: p[0] == p[1], zip(first, then)))
                end = sum(len(tables.token_bytes[i]) for i in first[:same])
                furthest = max(furthest, len(word) - end)
        assert furthest <= tables.lookahead
        reached.append(furthest / tables.lookahead)
    assert max(reached) == 1  # and not more than is needed


def test_memory_of_an_open_word_is_constant(tables, library):
    machine = bpe.Transducer(tables)
    run, most, out = bpe.OpenWord(machine), 0, []
    word = "".join(random.Random(1).choice(("the", "ing", "a", "tion", "zq")) for _ in range(200_000))
    began = time.perf_counter()
    for at in range(0, len(word), 997):
        out.append(run.feed(word[at : at + 997].encode()))
        most = max(most, len(run._rest))
    out.append(run.close())
    assert most < 2 * machine.window + 1000 and time.perf_counter() - began < 60
    assert ids(b"".join(out)) == library.encode(word, add_special_tokens=False).ids


def test_operators(spark, library, tables):
    texts = [None, "", END, f"a {END} b", "é" * 100_000, " " * 300_000, "a" * 500_000, "x y" * 40_000, "it's 12,5 €!\n\n  ok"]
    rows = [(i, t, 1, "x", "y") for i, t in enumerate(texts)] + [(3, texts[3], 1, "x", "y"), (None, "none", 1, "x", "y")]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids int, n_tokens string, doc string")
    got = bpe.decode_ids(bpe.encode_texts(df, PATH), PATH).collect()
    want = sorted((str(i), library.encode(t or "", add_special_tokens=False).ids, t or "") for i, t, *_ in rows)
    assert sorted((str(r.doc_id), ids(r.ids), r.text) for r in got) == want
    assert all(r.n_tokens == len(r.ids) // 4 for r in got)
    assert bpe.decode_ids(bpe.encode_texts(spark.createDataFrame([], df.schema), PATH), PATH).count() == 0


def test_query(spark, library):
    sf = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = llm_queries()["op12_bpe"](spark, sf).collect()
    assert len(rows) == len(texts)
    for r in rows:
        found = library.encode(texts[r.doc_id], add_special_tokens=False).ids
        back = library.decode(found, skip_special_tokens=False)
        assert (r.n_tokens, r.ids_sha256) == (len(found), hashlib.sha256(np.array(found, "<u4").tobytes()).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256(back.encode()).hexdigest()
