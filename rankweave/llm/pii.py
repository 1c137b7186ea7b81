"""Personal data: anchors found by one Aho-Corasick pass, then local parsers on both sides of each."""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import NamedTuple

import ahocorasick
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

#: Base kinds in the order in which spans are listed, then those that cues add.
KINDS = ("email", "ip", "card", "phone", "address", "account", "secret")
BASE_KINDS = KINDS[:4]

DIGITS = frozenset("0123456789")
LOCAL_PART = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
DIGIT_GROUPS = re.compile(r"[0-9]+")
NUMERIC_RUN = re.compile(r"[0-9. -]+")
PHONE_RUN = re.compile(r"[\x20().0-9-]+")
#: A web address that names a person: user information before the host.
AUTHORITY = re.compile(r"[^\s/?#@\"'<>]+@[^\s/?#@\"'<>]+[^\s\"'<>]*")
SCHEME_NAME = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+.-")
AFTER_CUE = re.compile(r"(?:[ _-]?(?:number|no\.?|nr\.?|id|key|code))?[\x20\t]{0,3}[:=#]?[\x20\t]{0,3}[\"']?", re.I)
IDENTIFIER = re.compile(r"[A-Za-z0-9]+(?:[ -]?[A-Za-z0-9]+)*")
SSN = re.compile(r"[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")
IBAN = re.compile(r"[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{1,4}){3,8}(?![A-Za-z0-9])")
ACCOUNT = re.compile(r"[A-Za-z0-9]{0,4}[0-9]{6,20}(?![A-Za-z0-9])")
SECRET = re.compile(r"[A-Za-z0-9+/_-]{16,}+={0,2}+(?![A-Za-z0-9+/_=-])")

#: A-Z in lower case, all else as it is, so that places stay the same.
LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}

#: Cues and the kind that may follow each, in any case; their words may be parted by space, hyphen or underscore.
CUES = {
    "iban": "iban",
    "ssn": "ssn",
    "social security": "ssn",
    "account": "account",
    "acct": "account",
    "passport": "account",
    "token": "secret",
    "api_key": "secret",
    "apikey": "secret",
    "secret": "secret",
    "password": "secret",
}


class Span(NamedTuple):
    kind: str
    start: int
    end: int


def anchors() -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    for sign, use in [("@", "at"), ("+", "plus"), ("://", "scheme"), *((d, "digit") for d in DIGITS)]:
        found.add_word(sign, (use, len(sign)))
    for cue, kind in CUES.items():
        for written in {cue, *(cue.replace("_", " ").replace(" ", mark) for mark in " _-")}:
            found.add_word(written, (kind, len(written)))
    found.make_automaton()
    return found


def luhn(digits: str) -> bool:
    doubled = sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])
    return (sum(map(int, digits[-1::-2])) + doubled) % 10 == 0


def _emails(text: str, at: int, after: int) -> Iterator[Span]:
    """The address around the at-sign, not reaching back over ``after``, the end of the one before."""
    domain = DOMAIN.match(text, at + 1)
    start = at
    while domain and start > after and text[start - 1] in LOCAL_PART:
        start -= 1
    if domain and start < at:
        yield Span("email", start, domain.end())


def _chains(text: str, groups: list[tuple[int, int]], links: str) -> Iterator[list[tuple[int, int]]]:
    """Longest sequences of digit groups with exactly one character of ``links`` between neighbours."""
    chain: list[tuple[int, int]] = []
    for start, end in groups:
        if chain and not (start - chain[-1][1] == 1 and text[start - 1] in links):
            yield chain
            chain = []
        chain.append((start, end))
    if chain:
        yield chain


def _numbers(text: str, start: int, end: int) -> Iterator[Span]:
    """Network addresses and card numbers in a run of digits, points, spaces and hyphens."""
    groups = [m.span() for m in DIGIT_GROUPS.finditer(text, start, end)]
    for chain in _chains(text, groups, "."):
        for i in range(0, len(chain) - 3, 4):
            parts = [text[a:b].lstrip("0") or "0" for a, b in chain[i : i + 4]]
            if all(len(p) <= 3 and int(p) <= 255 for p in parts):
                yield Span("ip", chain[i][0], chain[i + 3][1])
    for chain in _chains(text, groups, " -"):
        digits = sum(b - a for a, b in chain)
        if 16 <= digits <= 19 and luhn("".join(text[a:b] for a, b in chain)):
            yield Span("card", chain[0][0], chain[-1][1])


def _phone(text: str, plus: int) -> tuple[int, Span | None]:
    """Where the number after a plus sign ends, and its span if it has 8 to 15 digits."""
    if text[plus + 1 : plus + 2] not in DIGITS or plus + 1 >= len(text):
        return plus, None
    run = PHONE_RUN.match(text, plus + 2)
    last = run.end() - 1 if run else 0
    while run and last > run.start() and text[last] not in DIGITS:
        last -= 1
    if not run or last <= run.start():
        return plus, None
    count = sum(c in DIGITS for c in text[plus : last + 1])
    return last + 1, Span("phone", plus, last + 1) if 8 <= count <= 15 else None


def _scheme(text: str, at: int) -> Iterator[Span]:
    start = at
    while start > 0 and at - start < 32 and text[start - 1] in SCHEME_NAME:
        start -= 1
    rest = AUTHORITY.match(text, at + 3)
    if rest and start < at:
        yield Span("address", start, rest.end())


def iban_is_valid(value: str) -> bool:
    packed = value.replace(" ", "")
    moved = packed[4:] + packed[:4]
    return 15 <= len(packed) <= 34 and int("".join(str(int(c, 36)) for c in moved)) % 97 == 1


def _cued(text: str, kind: str, start: int, end: int) -> Iterator[Span]:
    """The identifier that a cue at ``start:end`` announces, if its form is right."""
    if start and (text[start - 1].isalnum()):
        return
    after = AFTER_CUE.match(text, end).end()
    if after == end or after >= len(text):
        return
    if kind == "iban":
        m = IBAN.match(text, after)
        found = m if m and iban_is_valid(m.group()) else None
    elif kind == "ssn":
        found = SSN.match(text, after)
    elif kind == "account":
        found = ACCOUNT.match(text, after)
    else:
        m = SECRET.match(text, after)
        mixed = m and any(c in DIGITS for c in m.group()) and any(c.isalpha() for c in m.group())
        found = m if mixed else None
    if found:
        yield Span("secret" if kind == "secret" else "account", after, found.end())


def find_spans(text: str | None, found: ahocorasick.Automaton | None = None) -> list[Span]:
    """All spans of a text by kind as in ``KINDS``, then start; code points, end exclusive.

    The base kinds hold exactly the leftmost non-overlapping matches of their patterns that pass the
    check of their parts: a match uses only characters of its kind and contains an anchor, so expanding
    each anchor over them cannot miss one, and takes time in proportion to the text. Of the other kinds,
    overlapping spans keep the first. ``found`` are ``anchors()``, for callers with many texts.
    """
    if not text:
        return []
    out: dict[str, list[Span]] = {kind: [] for kind in KINDS}
    email_end = number_end = phone_end = 0
    for last, (use, size) in (found or anchors()).iter(text.translate(LOWER)):
        at = last - size + 1
        if use == "digit":
            if at >= number_end:
                number_end = NUMERIC_RUN.match(text, at).end()
                for span in _numbers(text, at, number_end):
                    out[span.kind].append(span)
        elif use == "at":
            for span in _emails(text, at, email_end):
                out["email"].append(span)
                email_end = span.end
        elif use == "plus":
            if at >= phone_end:
                end, span = _phone(text, at)
                phone_end = max(phone_end, end)
                out["phone"] += [span] if span else []
        else:
            for span in _scheme(text, at) if use == "scheme" else _cued(text, use, at, last + 1):
                if not out[span.kind] or span.start >= out[span.kind][-1].end:
                    out[span.kind].append(span)
    return [span for kind in KINDS for span in out[kind]]


def redacted(text: str | None, found: ahocorasick.Automaton | None = None) -> str | None:
    """The text with every span replaced by its kind in brackets; overlapping spans become one, named
    by the kind that starts first (of several, the one listed first in ``KINDS``)."""
    if text is None:
        return None
    spans = sorted(find_spans(text, found), key=lambda s: (s.start, KINDS.index(s.kind)))
    parts, at, end = [], 0, 0
    for span in spans:
        if span.start >= end:
            parts += [text[at if not end else end : span.start], f"[{span.kind.upper()}]"]
        end = max(end, span.end)
    return "".join(parts) + text[end:]


SPANS_TYPE = ArrayType(
    StructType([StructField("kind", StringType()), StructField("start", IntegerType()), StructField("end", IntegerType())])
)


@F.pandas_udf(SPANS_TYPE)
def _spans(texts: pd.Series) -> pd.Series:
    found = anchors()
    return pd.Series([[{"kind": s.kind, "start": s.start, "end": s.end} for s in find_spans(t, found)] for t in texts], dtype=object)


@F.pandas_udf(StringType())
def _redacted(texts: pd.Series) -> pd.Series:
    found = anchors()
    return pd.Series([redacted(t, found) for t in texts], dtype=object)


_spans = _spans.asNondeterministic()  # so that one evaluation serves every column taken from it


def pii_spans(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, spans): array of kind, start, end for every row, empty for null and empty texts.

    Repeated rows and null ids stay rows of their own. Other columns are not read.
    """
    return docs.select(F.col(doc_id).alias("doc_id"), _spans(F.col(text)).alias("spans"))


def redact(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with personal data in ``text`` replaced by ``[KIND]``; null stays null."""
    return docs.withColumn(text, _redacted(F.col(text)))


def spans_as_text(spans: Column) -> Column:
    """``kind:start:end`` joined by commas."""
    parts = F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")))
    return F.array_join(parts, ",")
