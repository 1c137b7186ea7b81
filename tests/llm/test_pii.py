import random
import re
import time

import pytest

from rankweave.llm import pii
from rankweave.llm.queries import QUERIES

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def brute(text):
    out = []
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m.group())
            if kind == "ip" and any(int(p) > 255 for p in m.group().split(".")):
                continue
            if kind == "card" and not (16 <= len(digits) <= 19 and pii.luhn(digits)):
                continue
            if kind == "phone" and not 8 <= len(digits) <= 15:
                continue
            out.append((kind, *m.span()))
    return out


def base(text):
    return [tuple(s) for s in pii.find_spans(text) if s.kind in pii.BASE_KINDS]


def test_base_spans_are_the_patterns_matches():
    rng = random.Random(1)
    alphabets = ["0123456789.", "0123456789 -+", "a@.-b1", "0129 -.+()@a", "4 0-1+", "é1.+@ 中4"]
    for _ in range(30_000):
        text = "".join(rng.choice(rng.choice(alphabets)) for _ in range(rng.randrange(60)))
        assert base(text) == brute(text), text


@pytest.mark.parametrize(
    "text",
    ["1" * 200_000, "a" * 200_000 + "@", "@" * 100_000, "1." * 100_000, "+1 " * 60_000, "1 " * 100_000, "+1" + " " * 200_000, "token " * 50_000],
)
def test_long_texts_take_linear_time(text):
    start = time.time()
    pii.find_spans(text)
    assert time.time() - start < 5


def test_cues_and_schemes_add_spans():
    text = 'x ssn: 123-45-6789, IBAN GB82 WEST 1234 5698 7654 32 ok token = "9b0b3c6a43eb78aa99cb" account no. 12345678 http://joe:pw@host/x http://host/x iban GB00 1234 1234 1234'
    found = [(s.kind, text[s.start : s.end]) for s in pii.find_spans(text)]
    assert found == [
        ("address", "http://joe:pw@host/x"),
        ("account", "123-45-6789"),
        ("account", "GB82 WEST 1234 5698 7654 32"),
        ("account", "12345678"),
        ("secret", "9b0b3c6a43eb78aa99cb"),
    ]


def test_clean_prose_has_no_spans():
    assert pii.find_spans("The account of a token, 12 secrets + 3. Passport control at 10.30, see a.b.c. Token ring") == []


def test_redacted():
    assert pii.redacted("mail a@b.c and +1 (017) 555-7713x") == "mail [EMAIL] and [PHONE]x"
    assert pii.redacted("1.2.3.4") == "[IP]"
    assert (pii.redacted(None), pii.redacted("")) == (None, "")


def test_query_on_odd_rows(spark, tmp_path):
    rows = [(1, "a@b.c 1.2.3.4"), (1, "a@b.c 1.2.3.4"), (None, None), (2, ""), (3, "é" * 50_000 + "a@b.c")]
    path = str(tmp_path)
    spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as spans", "2 as kind").write.parquet(f"{path}/documents.parquet")
    got = sorted(QUERIES["op8_pii"](spark, path).collect(), key=str)
    assert [r.doc_id for r in got] == [1, 1, 2, 3, None]
    assert got[0].spans == "email:0:5,ip:6:13" and got[3].spans == "email:50000:50005" and got[4].n_ip == 0


@pytest.mark.parametrize(
    "text,kind,value",
    [
        ("Social Security Number: 123-45-6789", "account", "123-45-6789"),
        ("Social-Security 123-45-6789", "account", "123-45-6789"),
        ("API key: 9b0b3c6a43eb78aa99cb", "secret", "9b0b3c6a43eb78aa99cb"),
        ("ApiKey=9b0b3c6a43eb78aa99cb", "secret", "9b0b3c6a43eb78aa99cb"),
        ("\u0130 Api-Key: 9b0b3c6a43eb78aa99cb", "secret", "9b0b3c6a43eb78aa99cb"),
        ("token: " + "a1" * 400, "secret", "a1" * 400),
    ],
)
def test_cues_in_any_spelling_and_long_secrets(text, kind, value):
    assert [(s.kind, text[s.start : s.end]) for s in pii.find_spans(text)] == [(kind, value)]
