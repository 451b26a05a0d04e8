"""Personal data by anchors: an Aho-Corasick pass finds where to look, local parsers decide."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hazemill.llm.common import map_rows, unused

#: Kinds in the order in which they are listed; the last two are added by the method.
BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "iban", "login")
#: Cues that announce an account number, and schemes that may carry a user's name.
ACCOUNT_CUES = ("iban", "IBAN", "Iban")
SCHEMES = ("http://", "https://", "ftp://", "ssh://", "sftp://")

# What the kinds look like from their anchor on.
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DIGITS = frozenset("0123456789")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"([0-9]+)\.([0-9]+)\.([0-9]+)\.([0-9]+)")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_ACCOUNT = re.compile(r"[\s:=#.]{0,4}([A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,31})")
_WORD = re.compile(r"[A-Za-z0-9]")
#: Letters and digits of an account number by its country.
ACCOUNT_LENGTHS = {
    country: length
    for length, countries in (
        (15, "NO"), (16, "BE"), (18, "DK FI FK FO GL NL SD"), (19, "MK SI"), (20, "AT BA EE KZ LT LU MN XK"),
        (21, "CH HR LI LV"), (22, "BG BH CR DE GB GE IE ME RS VA"), (23, "AE GI IL IQ OM SO TL"),
        (24, "AD CZ ES MD PK RO SA SE SK TN VG"), (25, "LY PT ST"), (26, "IS TR"),
        (27, "BI DJ FR GR IT MC MR SM"), (28, "AL AZ BY CY DO GT HN HU LB NI PL SV"), (29, "BR EG PS QA UA"),
        (30, "JO KW MU YE"), (31, "MT SC"), (32, "LC"), (33, "RU"),
    )
    for country in countries.split()
}
_LOGIN = re.compile(r"[^\s/@:]+(?::[^\s/@]*)?@[A-Za-z0-9.-]+")

Span = tuple[str, int, int]


@lru_cache(maxsize=1)
def _anchors() -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    found.add_word("@", ("email", 1))
    for digit in _DIGITS:
        found.add_word(digit, ("card", 1))
        found.add_word(digit + ".", ("ip", 2))
        found.add_word("+" + digit, ("phone", 2))
    for word in ACCOUNT_CUES:
        found.add_word(word, ("iban", len(word)))
    for word in SCHEMES:
        found.add_word(word, ("login", len(word)))
    found.make_automaton()
    return found


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        n = int(c) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def _at_most_255(digits: str) -> bool:
    short = digits.lstrip("0")
    return len(short) <= 3 and int(short or "0") <= 255


def _iban(text: str) -> bool:
    code = text.replace(" ", "")
    if not 15 <= len(code) <= 34:
        return False
    turned = code[4:] + code[:4]
    return int("".join(str(int(c, 36)) for c in turned)) % 97 == 1


def _account_end(run: str, after: str) -> int:
    """Where the account number at the start of ``run`` (blocks, then ``after``) ends; 0 if
    there is none. The country's length fixes it; in a country without one, of the ends of
    blocks from long to short the first that passes the remainder does."""
    length = ACCOUNT_LENGTHS.get(run[:2])
    ends, seen = [], 0
    for i, c in enumerate(run, 1):
        seen += c != " "
        if seen > 34:
            break
        following = run[i : i + 1] or after
        if c != " " and seen >= 15 and length in (None, seen) and not _WORD.match(following):
            ends.append(i)
    return next((end for end in reversed(ends) if _iban(run[:end])), 0)


def find_spans(text: str | None) -> list[Span]:
    """Personal data of a whole text: ``(kind, start, end)`` by kind, then start.

    Every kind is matched from left to right without overlaps of its own; a candidate that
    fails its check (parts over 255, Luhn, number of digits, IBAN remainder) is dropped and
    not tried again from a later start; an IBAN's end is looked for among its blocks. Kinds may overlap each other.
    """
    if not text:
        return []
    spans: dict[str, list[Span]] = {kind: [] for kind in KINDS}
    done = dict.fromkeys(KINDS, 0)  # up to where a kind has used the text
    for last, (kind, length) in _anchors().iter(text):
        at = last - length + 1
        free = done[kind]
        if kind == "email":
            tail = _DOMAIN.match(text, at)
            if not tail or at < free:
                continue
            start = at
            while start > free and text[start - 1] in _LOCAL:
                start -= 1
            if start < at:
                spans[kind].append((kind, start, tail.end()))
                done[kind] = tail.end()
        elif kind == "ip":
            start = at
            while start > free and text[start - 1] in _DIGITS:
                start -= 1
            m = _IP.match(text, start) if at >= free else None
            if m:
                done[kind] = m.end()
                if all(_at_most_255(x) for x in m.groups()):
                    spans[kind].append((kind, start, m.end()))
        elif kind == "card":
            m = _CARD.match(text, at) if at >= free else None
            if m:
                done[kind] = m.end()
                digits = m[0].replace(" ", "").replace("-", "")
                if 16 <= len(digits) <= 19 and luhn(digits):
                    spans[kind].append((kind, at, m.end()))
        elif kind == "phone":
            m = _PHONE.match(text, at) if at >= free else None
            if m:
                done[kind] = m.end()
                if 8 <= sum(c in _DIGITS for c in m[0]) <= 15:
                    spans[kind].append((kind, at, m.end()))
        elif kind == "iban":
            m = _ACCOUNT.match(text, last + 1) if at >= free else None
            end = _account_end(m[1], text[m.end() : m.end() + 1]) if m else 0
            if end:
                spans[kind].append((kind, m.start(1), m.start(1) + end))
                done[kind] = m.start(1) + end
        else:
            m = _LOGIN.match(text, last + 1) if at >= free else None
            if m:
                spans[kind].append((kind, last + 1, m.end()))
                done[kind] = m.end()
    return [span for kind in KINDS for span in spans[kind]]


def _joined(spans: list[Span]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end in spans)


def find_pii(docs: DataFrame) -> DataFrame:
    """Counts and spans of personal data in every whole text.

    ``doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans``; offsets are code points.
    A null text is an empty one: zero counts, the hash of nothing, no spans. One row per
    input row, repeated or without ``doc_id``; an empty table gives no rows; other columns
    are not looked at.
    """

    def run(batches: Iterator[dict]) -> Iterator[dict]:
        for batch in batches:
            out: dict[str, list] = {f"n_{kind}": [] for kind in BASE_KINDS}
            out |= {"base_sha256": [], "spans": []}
            for text in batch["text"].to_pylist():
                spans = find_spans(text)
                base = [s for s in spans if s[0] in BASE_KINDS]
                for kind in BASE_KINDS:
                    out[f"n_{kind}"].append(sum(s[0] == kind for s in base))
                out["base_sha256"].append(hashlib.sha256(_joined(base).encode()).hexdigest())
                out["spans"].append(_joined(spans))
            yield {"doc_id": batch["doc_id"], **out}

    given = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")
    )
    counts = ", ".join(f"n_{kind} long" for kind in BASE_KINDS)
    return map_rows(given, run, f"doc_id long, {counts}, base_sha256 string, spans string")


def mask(text: str | None) -> str | None:
    """The text with personal data replaced by its kind in angle brackets; spans that
    touch the same characters become one, named by the first."""
    while spans := sorted(find_spans(text), key=lambda s: (s[1], -s[2])):
        out, at = [], 0
        last_end = -1
        for kind, start, end in spans:
            if start < last_end:  # within or across the span before: one replacement
                at = last_end = max(last_end, end)
                continue
            out += [text[at:start], f"<{kind.upper()}>"]
            at = last_end = end
        out.append(text[at:])
        # What is left between two spans may read as one anew; each round has fewer anchors.
        text = "".join(out)
    return text


def mask_documents(docs: DataFrame) -> DataFrame:
    """All rows and columns of ``docs``, personal data masked in ``text``; ``n_chars`` of
    changed texts is their new length. Null and clean texts stay as they are, repeated rows
    too; an empty table gives no rows; other columns may have any name."""
    @F.pandas_udf("string")
    def masked(texts: pd.Series) -> pd.Series:
        return texts.map(mask, na_action="ignore")

    new = unused(docs, "masked")
    out = docs.withColumn(new, masked(F.col("text").cast("string")))
    changed = F.col(new) != F.col("text")
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        length = F.length(new).cast(kind)
        out = out.withColumn("n_chars", F.when(changed, length).otherwise(F.col("n_chars")))
    return out.withColumn("text", F.col(new)).select(docs.columns)
