"""The fitted encoder, the descent and the pair scorers against plain computations."""

import hashlib
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from rankweave.operators import fit, idf
from rankweave.operators.rerank import FEATURES


def _term(word):
    return int(hashlib.md5(word.encode()).hexdigest()[:15], 16)


def _weighted(texts, corpus):
    held = [set(t.split()) for t in corpus if t]
    out = {}
    for key, text in texts:
        counts = {}
        for w in (text or "").split():
            counts[_term(w)] = counts.get(_term(w), 0) + 1
        df = {t: sum(t in {_term(w) for w in words} for words in held) for t in counts}
        raw = {t: n * (math.log((1 + len(corpus)) / (1 + df[t])) + 1) for t, n in counts.items()}
        norm = math.sqrt(sum(v * v for v in raw.values()))
        out[key] = {t: round(v / norm, 9) for t, v in raw.items()}
    return out


@pytest.mark.parametrize("hot_rows", [1, 200_000])
def test_idf_of_a_corpus(spark, tmp_path, monkeypatch, hot_rows):
    monkeypatch.setattr(idf, "HOT_ROWS", hot_rows)
    rng = random.Random(1)
    words = [f"w{i}" for i in range(25)]
    corpus = [" ".join(rng.choices(words, weights=[1 / (i + 1) for i in range(25)], k=rng.randint(0, 12))) for _ in range(60)] + [None, ""]
    docs = spark.createDataFrame(list(enumerate(corpus)), "doc_id long, text string").repartition(3)
    idf.save_idf(idf.fit_idf(docs, "text"), str(tmp_path), "m")
    fitted = idf.load_idf(spark, str(tmp_path), "m")
    rows = {r.doc_id: r for r in idf.encode_idf(docs, "text", fitted).collect()}
    assert {k: {t: round(v, 9) for t, v in zip(r.terms, r.tf)} for k, r in rows.items()} == _weighted(list(enumerate(corpus)), corpus)
    assert all(list(r.terms) == sorted(r.terms) for r in rows.values())
    asked = [("a", "w1 w1 new words"), ("b", "")]
    queries = spark.createDataFrame(asked, "query_id string, query string")
    got = {r.query_id: dict(zip(r.terms, (round(v, 9) for v in r.tf))) for r in idf.encode_idf(queries, "query", fitted, "query_id").collect()}
    assert got == _weighted(asked, corpus)


def test_idf_without_documents(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    fitted = idf.fit_idf(docs, "text")
    assert [tuple(r) for r in fitted.collect()] == [(idf.UNSEEN, 0, 1.0)]
    assert idf.encode_idf(docs, "text", fitted).count() == 0


def _pairs(spark, n, dim=5, seed=3):
    rng = np.random.default_rng(seed)
    unit = [v / np.linalg.norm(v) for v in rng.normal(size=(2 * n, dim))]
    true = rng.normal(size=dim)
    rows = [(f"q{i % 37}", f"d{i}", unit[2 * i].tolist(), unit[2 * i + 1].tolist(), float((unit[2 * i] * unit[2 * i + 1]) @ true)) for i in range(n)]
    return rows, spark.createDataFrame(rows, "query_id string, doc_id string, query_vec array<double>, doc_vec array<double>, label double")


def test_descent_is_what_each_worker_would_do_alone(spark):
    rows, train = _pairs(spark, 400)
    _, val = _pairs(spark, 90, seed=4)
    best, history = fit.descend_bi_weights(train.repartition(5), val, epochs=4, workers=3, batches=2)
    got = sorted(history.collect())
    x = np.array([np.array(r[2]) * r[3] for r in rows])
    y = np.array([r[4] for r in rows])
    digest = [hashlib.md5(f"{r[0]}|{r[1]}".encode()).hexdigest() for r in rows]
    worker, batch = (np.array([int(h[a : a + 4], 16) % n for h in digest]) for a, n in ((0, 3), (4, 2)))
    step, w = 0.5 / (x * x).sum(axis=1).mean(), np.ones(5)
    for epoch in range(5):
        assert got[epoch].mse == pytest.approx(((x @ w - y) ** 2).mean())
        assert got[epoch].weights == pytest.approx(w.tolist())
        moved = []
        for k in range(3):
            own = w.copy()
            for b in range(2):
                m = (worker == k) & (batch == b)
                own -= step * 2 / m.sum() * x[m].T @ (x[m] @ own - y[m])
            moved.append(own * (worker == k).sum())
        w = sum(moved) / len(rows)
    assert got[4].mse < got[0].mse / 4
    assert best == got[min(range(5), key=lambda e: got[e].val_mse)].weights


def test_descent_without_validation_or_training_rows(spark):
    _, train = _pairs(spark, 50)
    _, history = fit.descend_bi_weights(train, train.limit(0), epochs=2)
    assert [r.val_mse for r in history.collect()] == [None] * 3
    with pytest.raises(ValueError, match="no training rows"):
        fit.descend_bi_weights(train.limit(0), train)


def _featured(spark, n, seed):
    """Relevant where exactly one of two features is high, which no linear score can tell."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        values = [rng.random() for _ in FEATURES]
        rows.append((f"q{i // 8}", f"d{i}", int((values[0] > 0.5) != (values[1] > 0.5)), *values))
    return spark.createDataFrame(rows, ", ".join(["query_id string", "doc_id string", "score int", *[f"{f} double" for f in FEATURES]]))


def test_trees_are_chosen_where_they_rank_better(spark):
    train, val = _featured(spark, 800, 1), _featured(spark, 240, 2)
    reached = []
    model, score = fit.fit_pair_scorer(train, val, reached=reached)
    assert [kind for kind, _ in reached] == ["logistic"] * 3 + ["trees"]
    assert score == max(s for _, s in reached) == reached[-1][1]
    assert len(model.stages[-1].trees) == fit.EPOCHS
    leaves = fit.tree_leaves(train, model).collect()
    assert {r.tree for r in leaves} == set(range(fit.EPOCHS))
    for tree in range(fit.EPOCHS):
        own = [r for r in leaves if r.tree == tree]
        assert sum(r.rows for r in own) == 800
        assert 1 < len(own) <= 8
        assert all(r.value == pytest.approx(r.expected, abs=1e-9) for r in own)


def test_an_unregularised_logistic_fit_has_no_slope_left(spark):
    rng = random.Random(5)
    rows = []
    for i in range(300):
        values = [rng.random() for _ in FEATURES]
        rows.append((f"q{i}", f"d{i}", int(values[0] + rng.gauss(0, 0.4) > 0.5), *values))
    train = spark.createDataFrame(rows, ", ".join(["query_id string", "doc_id string", "score int", *[f"{f} double" for f in FEATURES]]))
    done = fit.pair_estimator("logistic", 0.0, 300).fit(fit.positive_labels(train))
    slopes = {r.term: r.gradient for r in fit.logistic_gradient(train, done).collect()}
    assert set(slopes) == {"intercept", *FEATURES}
    assert max(map(abs, slopes.values())) < 1e-4
    begun = fit.pair_estimator("logistic", 0.0, 1).fit(fit.positive_labels(train))
    assert fit.logistic_gradient(train, begun).agg(F.max(F.abs("gradient"))).first()[0] > 1e-3
    with pytest.raises(ValueError, match="logistic or trees"):
        fit.pair_estimator("forest", 0.0, 1)
