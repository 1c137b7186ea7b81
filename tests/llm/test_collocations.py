"""Collocations against a count of every run of words, and the trie against plain counting."""

import random
import re
from collections import Counter

import numpy as np
import pytest

from rankweave.llm import collocations, hattrie

ROWS = [
    (1, "a b c a b. A B c; d\ta b c", "en"),
    (2, None, "en"),
    (3, "", None),
    (4, "é É é É x y x y x y x y", None),
    (5, "é É é É x y x y x y x y", None),
    (6, "one", "und"),
    (7, " \t ..;;\n\r\x0b\x0c", "de"),
    (8, "w w w w w w w w w w w w", "fr"),
    (9, "\x1c b\x1c   b\x1c   b\x1c", "fr"),
]


def brute(rows, least, shown):
    found, total = {}, Counter()
    for text, lang in rows:
        lang, counts = lang or "und", found.setdefault(lang or "und", Counter())
        lowered = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
        for piece in re.split("[.,;:!?\n-\r]", lowered):
            words = re.findall("[^ \t]+", piece)
            total[lang] += len(words)
            for k in range(1, 6):
                for i in range(len(words) - k + 1):
                    counts[tuple(words[i : i + k])] += 1
    out = []
    for lang, counts in found.items():
        candidates = {p: a for p, a in counts.items() if len(p) > 1 and a >= least}
        inside = {p[i : i + m] for p, a in candidates.items() for m in range(2, len(p)) for i in range(len(p) - m + 1) if a >= counts[p[i : i + m]]}
        scored = []
        for p in candidates.keys() - inside:
            a, n = counts[p], total[lang]
            score, k = min((1000 * a * n // (counts[p[:k]] * counts[p[k:]]), k) for k in range(1, len(p)))
            scored.append((-score, -a, " ".join(p).encode(), counts[p[:k]], counts[p[k:]]))
        ranked = enumerate(sorted(scored)[:shown], 1)
        out += [(lang, place, p.decode(), -a, left, right, total[lang], -score) for place, (score, a, p, left, right) in ranked]
    return sorted(out)


@pytest.mark.parametrize("least, shown, block_bytes", [(2, 2000, 1), (2, 3, 1 << 20), (1, 2000, 40), (5, 2000, 1 << 20)])
def test_phrases_of_odd_rows(spark, least, shown, block_bytes):
    docs = spark.createDataFrame([(*r, 1, "k") for r in ROWS], "doc_id long, body string, tongue string, n long, key string").repartition(3)
    got = collocations.collocations(docs, least, shown, text="body", lang="tongue", block_bytes=block_bytes).collect()
    assert sorted(map(tuple, got)) == brute([r[1:] for r in ROWS], least, shown)


def test_phrases_of_made_up_text(spark, monkeypatch):
    rng = random.Random(4)
    words = [f"w{i}" for i in range(30)]
    texts = [" ".join(rng.choices(words, k=200, weights=[1 / (i + 1) for i in range(30)])) + rng.choice([".", " ", "\n"]) for _ in range(60)]
    texts += ["the same passage again and again"] * 40
    rows = [(t, rng.choice(["en", "de", None])) for t in texts]
    monkeypatch.setattr(collocations, "FED", 700)
    monkeypatch.setattr(collocations, "MERGED", 500)
    docs = spark.createDataFrame(rows, "text string, lang string").repartition(4)
    got = collocations.collocations(docs, least=10).collect()
    assert sorted(map(tuple, got)) == brute(rows, 10, 2000)


def test_no_phrase_is_often_enough(spark):
    docs = spark.createDataFrame([("a b c", "en")], "text string, lang string")
    assert collocations.collocations(docs).collect() == []


def test_scores_beyond_64_bits(spark):
    """The score's products as the operator forms them, at counts that no test corpus has."""
    a, n, left, right = 10**12, 10**15, 10**13, 10**13 + 1
    row = spark.sql(
        f"select (cast(1000 as decimal(38, 0)) * cast({a} as decimal(38, 0)) * cast({n} as decimal(38, 0))) div (cast({left} as decimal(38, 0)) * cast({right} as decimal(38, 0))) as score"
    ).first()
    assert row["score"] == 1000 * a * n // (left * right)


@pytest.mark.parametrize("burst, held", [(3, 10**9), (3, 500), (2048, 10**9), (20, 3000)])
def test_the_trie_counts_every_path(burst, held):
    rng = np.random.default_rng(1)
    codes = np.minimum(rng.zipf(1.4, 20_000), 60).astype(np.uint32)
    codes[rng.random(20_000) < 0.1] = 0
    codes[500:900] = 1
    paths = collocations.paths_of(codes)
    trie, got = hattrie.HatTrie(burst, held), Counter()

    def take(run):
        assert (hattrie.row_order(run) == np.arange(len(run))).all()
        for row in hattrie.unpacked_rows(hattrie.packed_rows(run)).tolist():
            got[tuple(row[:-1])] += row[-1]

    for low in range(0, len(paths), 1500):
        trie.add(paths[low : low + 1500])
        if trie.full():
            take(trie.spilled())
            assert not trie.full()
    take(trie.spilled(True))
    assert not trie.root
    assert got == Counter(map(tuple, paths.tolist()))
