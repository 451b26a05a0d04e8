"""One odd document must not end a job: very long runs, unclosed tags, clashing columns."""

from __future__ import annotations

import time

import pytest

from hazemill.llm import html, pii, secrets, simhash

LONG = 1_000_000


@pytest.mark.parametrize("text, spans", [
    ("0" * LONG + ".2.3.4", [("ip", 0, LONG + 6)]),
    ("7" * LONG + ".2.3.4", []),
    ("1." * (LONG // 2), [("ip", 8 * i, 8 * i + 7) for i in range(LONG // 8)]),
    ("+1 " + " " * LONG, []),
    ("IBAN " + "DE89 " * (LONG // 5), []),
    ("http://" + "a:" * (LONG // 2), []),
    ("a" * LONG + "@b.c", [("email", 0, LONG + 4)]),
])
def test_long_personal_data(text, spans):
    began = time.perf_counter()
    assert pii.find_spans(text) == spans
    assert time.perf_counter() - began < 10


def test_masking_goes_on_until_nothing_is_left():
    assert pii.mask("x " + "a@b.c " * 5_000) == "x " + "<EMAIL> " * 5_000
    assert pii.mask(None) is None


@pytest.mark.parametrize("page", [
    "<a " * (LONG // 3), "<a '" * (LONG // 4), "<!" * (LONG // 2), "<div " + "x " * (LONG // 2),
    "<div>" * 100_000 + "</p>" * 100_000, "<script>" + "</script" * (LONG // 8), "<p>" * (LONG // 3), "&" * LONG,
])
def test_odd_pages_cost_no_more_than_their_length(page):
    began = time.perf_counter()
    html.Page(page).extract(html.Template())
    assert time.perf_counter() - began < 20
    assert html.Page("<article><p>kept</p></article>" + page).extract(html.Template()) == "kept"


def test_a_tag_ends_before_the_next_one():
    assert html.Page("<article><p title='a > b' x=\"<i>\">one</p><p>1 < 2</p></article>").extract(html.Template()) == "one\n\n1 < 2"


def test_long_paths_of_words_are_allowed(spark):
    words = "/".join(["abc"] * 100_000)
    df = spark.createDataFrame([(1, "a_" * 200_000), (2, words), (3, words + "/Zq8rT2vXw9Lk4Pm7Ns3B")], "doc_id long, text string")
    spans = {r.doc_id: r.spans for r in secrets.find_secrets(df).collect()}
    assert spans[1] == spans[2] == "" and spans[3].startswith("entropy_base64:")


def test_helper_columns_clash_with_nothing(spark):
    schema = "doc_id long, text string, n_chars int, masked string, _masked string, at int, _AT int, bits string, variant int"
    rows = [
        (5, "mail a@b.c", 10, "keep", "keep too", 1, 2, "b", 3), (5, "mail a@b.c", 10, "k", "kk", 7, 8, "b", 9),
        (9, "mail a@b.c", 10, None, None, None, None, None, None), (None, None, None, "x", "y", 1, 1, "z", 1),
    ]
    df = spark.createDataFrame(rows, schema)
    masked = pii.mask_documents(df)
    assert masked.schema == df.schema
    got = sorted(map(tuple, masked.collect()), key=str)
    assert got == sorted(((i, t and "mail <EMAIL>", n and 12, *rest) for i, t, n, *rest in rows), key=str)
    kept = simhash.drop_near_copies(df)
    assert kept.schema == df.schema
    assert sorted(r.doc_id or 0 for r in kept.collect()) == [0, 5]
    assert simhash.drop_near_copies(spark.createDataFrame([], schema)).count() == 0


def test_rows_without_or_with_one_id(spark):
    rows = [(None, "a b"), (5, "a b"), (5, "a b"), (7, None), (None, "zz"), (5, "c d"), (9, "c d")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted((r.doc_id or 0, r.text or "") for r in simhash.drop_near_copies(df).collect()) == [
        (0, "a b"), (0, "zz"), (5, "a b"), (7, "")]
