import html
import random
import re
import tracemalloc
from html.entities import html5

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from rankweave.functions import terms, text

CLEAN_CASES = [
    (None, ""),
    ("", ""),
    ("Hello, World!", "hello world"),
    ("<p>A<br>b</p>", "ab"),
    ("x &amp; y", "x amp y"),
    ("<b>x &amp; y</b>", "x  y"),
    ("see http://a.b/c?d=1 now", "see  now"),
    ("HTTP://A.b ok", "httpab ok"),
    ("go www.x.org", "go "),
    ("Café\tNoël\n2", "caf\tnol\n2"),
    ("[TITLE] Q? [BODY] t", "title q body t"),
    ("a < b and c > d", "a  b and c  d"),
    ("<script>var a=1</script>k", "k"),
    ("<!-- n -->z<i>Y</i>", "zy"),
    ("-- !!", " "),
    ("a b\u001cc d", "a b\u001cc d"),
    ("<p>&eacute;t&#233; &lt;b&gt;</p>", "t b"),
]


def _apply(spark, column, values):
    rows = [(i, v) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, "i int, t string")
    return [r[0] for r in df.orderBy("i").select(column(F.col("t"))).collect()]


def test_clean_text(spark):
    got = _apply(spark, text.clean_text, [c for c, _ in CLEAN_CASES])
    assert got == [want for _, want in CLEAN_CASES]


def test_html_to_text(spark):
    cases = [
        ("<p>A<br>b</p>", "Ab"),
        ("x &amp; y", "x & y"),
        ("&lt;b&gt; &eacute; &#8364; &amp;copy;", "<b> é € &copy;"),
        ("plain", "plain"),
        ("<STYLE>p{}</STYLE ><template>t</template>z", "z"),
        (None, None),
    ]
    assert _apply(spark, text.html_to_text, [c for c, _ in cases]) == [w for _, w in cases]


def test_compose_query(spark):
    df = spark.createDataFrame([("Q", "<p>b</p>"), ("Q", None), (" Q ", " ")], "t string, b string")
    marked = [r[0] for r in df.select(text.compose_query(F.col("t"), F.col("b"))).collect()]
    assert marked == ["[TITLE] Q [BODY] b", "[TITLE] Q [BODY]", "[TITLE]  Q  [BODY]"]
    bare = [r[0] for r in df.select(text.compose_query(F.col("t"), F.col("b"), markers=False)).collect()]
    assert bare == ["Q b", "Q", "Q"]


def test_patterns_agree_with_python_on_random_text(spark):
    rng = random.Random(7)
    alphabet = "abzAZ09 .,!?<>&;\t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85    　​éß中😀"
    pieces = ["http", "www.", "https://x", "HTTP"]
    texts = ["".join(rng.choice(alphabet) if rng.random() < 0.9 else rng.choice(pieces) for _ in range(40)) for _ in range(300)]
    no_urls = [re.sub(r"http\S+|www\.\S+", "", t) for t in texts]
    assert _apply(spark, text.strip_urls, texts) == no_urls
    assert _apply(spark, text.strip_special, texts) == [re.sub(r"[^a-zA-Z0-9\s]", "", t) for t in texts]
    assert _apply(spark, text.words, texts) == [t.split() for t in texts]
    assert _apply(spark, text.strip_space, texts) == [t.strip() for t in texts]


def test_entities_decode_like_the_standard_library(spark):
    texts = ["&copy &notit; &#x41; &#128; &frac12;", "&nosuch; & &amp;amp;"]
    assert _apply(spark, text.html_to_text, texts) == [html.unescape(t) for t in texts]


def test_every_reference_decodes_like_the_standard_library(spark):
    """The whole table of names, odd numbers, and random rubbish; without tags, so that only references count."""
    rng = random.Random(2)
    names = [f"&{n}" for n in html5]
    numbers = [0, 1, 8, 9, 10, 11, 13, 14, 31, 32, 38, 60, 127, 128, 129, 150, 159, 160, 0xD7FF, 0xD800, 0xDFFF, 0xE000, 0xFDD0, 0xFDEF, 0xFEFF, 0xFFFD, 0xFFFE, 0xFFFF, 0x10000, 0x1FFFE, 0x10FFFD, 0x10FFFF, 0x110000, 10**9, 10**30]
    texts = [f"{a}&#{n}{b}&#x{n:x}{b}z&#X{n:08X}{b}" for n in numbers for a in ("", "a") for b in ("", ";", ";;", " ")]
    texts += names + [f"x{n}y" for n in names] + ["&", "&&", "&;", "&#", "&#;", "&#x;", "&#xg", "&a" * 30, "&" + "b" * 40 + ";", "&amp" + "c" * 40, "&lt;&gt", ""]
    parts = ["&", "#", "x", ";", "amp", "lt", "not", "in", "copy", "1", "9", "4", " ", "é", "\n", "frac12", "😀"]
    texts += ["".join(rng.choices(parts, k=rng.randint(1, 9))) for _ in range(1500)]
    assert _apply(spark, text._decode_entities, texts) == [html.unescape(t) for t in texts]


def test_cleaning_stays_in_the_jvm(spark):
    df = spark.createDataFrame([("<b>&eacute;</b>",)], "t string").select(text.clean_text(F.col("t")).alias("a"), text.html_to_text(F.col("t")).alias("b"))
    assert "Python" not in df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("buckets", [8, None])
def test_term_vectors(spark, buckets):
    texts = ["b a b\tc", "", None, "  x  ", "a b"]
    got = _apply(spark, lambda t: terms.term_vector(t, buckets), texts)
    for value, vector in zip(texts, got):
        counts: dict[int, float] = {}
        for word in (value or "").split():
            digest = __import__("hashlib").md5(word.encode()).hexdigest()
            bucket = int(digest[:15], 16)
            bucket = bucket % buckets if buckets else bucket
            counts[bucket] = counts.get(bucket, 0) + 1
        assert (vector.terms, vector.tf) == (sorted(counts), [counts[b] for b in sorted(counts)])


def test_word_sets(spark):
    got = _apply(spark, terms.word_sets, ["a b a b c", "a b", "b a", "", "a"])
    assert [(len(s.words), len(s.bigrams)) for s in got] == [(3, 3), (2, 1), (2, 1), (0, 0), (1, 0)]
    assert set(got[1].words) == set(got[2].words) < set(got[0].words)
    assert set(got[1].bigrams) < set(got[0].bigrams) and set(got[2].bigrams) < set(got[0].bigrams)
    assert not set(got[1].bigrams) & set(got[2].bigrams)


@pytest.mark.parametrize("make", [terms.term_vector, terms.word_sets, lambda t: terms.dense_terms(t, 128)])
def test_words_of_a_full_batch_are_numbered_in_parts(monkeypatch, make):
    """The same rows as from texts one by one, in less memory than eight numbers for each word."""
    monkeypatch.setattr(terms.F, "arrow_udf", lambda kernel, kind: lambda column: kernel)
    rng = np.random.default_rng(2)
    words = np.array([f"w{i}" for i in range(5000)])
    texts = [" ".join(rng.choice(words, size=n)) for n in [200_000, *rng.integers(0, 400, 4000)]] + [None, "", " a  b "]
    kernel, array = make(None), pa.array(texts)
    tracemalloc.start()
    got = kernel(array)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 64 * sum(len((t or "").split()) for t in texts) / 2
    assert len(got) == len(texts)

    def shown(value):  # word sets have no order
        return {name: sorted(part) for name, part in value.items()} if make is terms.word_sets else value

    for at in [0, 1, 2, *range(600, 4000, 500), 4000, 4001, 4002, 4003]:
        assert shown(got[at].as_py()) == shown(kernel(array.slice(at, 1))[0].as_py())
    assert kernel(array.slice(0, 0)).to_pylist() == []
