import json

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import Observation
from pyspark.sql import functions as F

from rankweave.operators import fit, joins, pairs, rerank
from rankweave.operators.rerank import FEATURES, fitted_scorer
from rankweave.sources import readers, writers


def _file(tmp_path, name, text):
    path = tmp_path / name
    path.write_text(text, encoding="utf-8")
    return str(path)


def _set(df):
    return {tuple(r) for r in df.collect()}


def test_topics_from_an_array_file(spark, tmp_path):
    data = [{"query_id": 7, "query": "First!"}, {"query_id": "b", "query": "B"}, {"query_id": 7, "query": "Last!"}]
    path = _file(tmp_path, "t.json", json.dumps(data, indent=2))
    assert _set(readers.load_topics(spark, path, array=True)) == {("7", "last"), ("b", "b")}


def test_answers_key_presence(spark, tmp_path):
    lines = [{"doc_id": "a", "doc": "A."}, {"doc_id": "b"}, {"doc_id": "c", "doc": None}, {"doc_id": "a", "doc": "A2"}]
    path = _file(tmp_path, "a.json", "\n".join(map(json.dumps, lines)))
    assert _set(readers.load_answers(spark, path)) == {("a", "a2"), ("c", "")}
    assert _set(readers.load_answers(spark, path, keep_null_docs=False)) == {("a", "a2")}
    array = _file(tmp_path, "b.json", json.dumps(lines))
    assert _set(readers.load_answers(spark, array, array=True)) == {("a", "a2"), ("c", "")}
    assert _set(readers.load_answers(spark, array, array=True, keep_null_docs=False)) == {("a", "a2")}


def test_qrels(spark, tmp_path):
    path = _file(tmp_path, "q.tsv", "q1 0 d1 1\nq1\t0  d1\t2 \nq1 0 d2 0\nq1 0 d2 0\n")
    assert _set(readers.parse_qrel(spark, path)) == {("q1", "d1", 2), ("q1", "d2", 0)}
    assert _set(readers.parse_qrel(spark, path, "keep_all")) == {("q1", "d1", 1), ("q1", "d1", 2), ("q1", "d2", 0)}


@pytest.mark.parametrize("bad", ["", "q1 0 d1", "q1 0 d1 x", "q1 0 d1 1 extra"])
def test_malformed_qrels(spark, tmp_path, bad):
    path = _file(tmp_path, "q.tsv", f"q1 0 d1 1\n{bad}\nq2 0 d2 1\n")
    with pytest.raises(PySparkException):
        readers.parse_qrel(spark, path).collect()
    seen = Observation("qrels")
    kept = readers.parse_qrel(spark, path, mode="permissive", observation=seen)
    assert _set(kept) == {("q1", "d1", 1), ("q2", "d2", 1)}
    assert seen.get["bad_lines"] == 1


def test_run_file_round_trip(spark, tmp_path):
    rows = [("q", f"d{i}", i + 1, 1 / (i + 1), "t") for i in range(30)]
    run = spark.createDataFrame(rows, "query_id string, doc_id string, rank int, score double, tag string")
    path = str(tmp_path / "run")
    writers.write_run(run, path)
    lines = [r.value for r in spark.read.text(path).collect()]
    assert "q\tQ0\td0\t1\t1.0\tt" in lines
    back = readers.read_run(spark, path)
    assert {(r.doc_id, r["rank"]) for r in back.collect()} == {(d, n) for _, d, n, _, _ in rows}


def test_tiny_scores_survive_a_run_file(spark, tmp_path):
    rows = [("q", "a", 1, 3e-13, "t"), ("q", "b", 2, 1e-14, "t"), ("q", "c", 3, 0.1 + 0.2, "t")]
    path = str(tmp_path / "run")
    writers.write_run(spark.createDataFrame(rows, "query_id string, doc_id string, rank int, score double, tag string"), path)
    assert {(r.doc_id, r.score) for r in readers.read_run(spark, path).collect()} == {(d, s) for _, d, _, s, _ in rows}


@pytest.mark.parametrize("bad", ["q\tQ0\td\t1\tabc\tt", "q\tQ0\td", "q Q0 d 1 0.5 t", "q\tQ0\td\tx\t0.5\tt", "q\tQ0\td\t1\tNaN\tt", ""])
def test_malformed_run_lines(spark, tmp_path, bad):
    path = _file(tmp_path, "run", f"q\tQ0\ta\t1\t0.5\tt\n{bad}\nq\tQ0\tb\t2\t0.25\tt\n")
    with pytest.raises(PySparkException):
        readers.read_run(spark, path).collect()
    seen = Observation("runs")
    kept = readers.read_run(spark, path, depth=10, mode="permissive", observation=seen)
    assert {r.doc_id for r in kept.collect()} == {"a", "b"}
    assert seen.get["bad_lines"] == 1


def test_the_whole_range_of_grades(spark, tmp_path):
    path = _file(tmp_path, "q.tsv", "q 0 a 2147483647\nq 0 b 2147483648\nq 0 c -1\n")
    assert _set(readers.parse_qrel(spark, path, mode="permissive")) == {("q", "a", 2147483647), ("q", "c", -1)}


def test_raw_files(spark, tmp_path):
    topics = [{"Id": "1", "Title": "T", "Body": "<p>b</p>"}, {"Id": "2", "Title": "U"}]
    array = _file(tmp_path, "t.json", json.dumps(topics))
    lines = _file(tmp_path, "t.jsonl", "\n".join(map(json.dumps, topics)))
    want = {("1", "[TITLE] T [BODY] b"), ("2", "[TITLE] U [BODY]")}
    assert _set(pairs.compose_topics(readers.read_raw(spark, array, "topics", "array"))) == want
    assert _set(pairs.compose_topics(readers.read_raw(spark, lines, "topics"))) == want
    answers = _file(tmp_path, "a.jsonl", '{"Id": "a", "Text": "x"}\n{"Id": "b"}\n{"Text": "y"}\n')
    assert _set(readers.load_raw_answers(spark, answers)) == {("a", "x")}
    mixed = _file(tmp_path, "m.json", json.dumps([{"query_id": "q", "query": "Q?"}, {"Id": "i", "Title": "T"}]))
    read = readers.read_raw(spark, mixed, "mixed topics", "array")
    assert _set(pairs.resolve_topics(read, clean_queries=False)) == {("q", "Q?"), ("i", "T")}


def test_whitespace_run(spark, tmp_path):
    path = _file(tmp_path, "run", "q Q0  a 9 0.5 t\nq\tQ0\tb 3   0.5 t\nq Q0 c 1 0.75 t\nq Q0 a 9 0.1 t\n")
    back = readers.read_run(spark, path, whitespace=True).orderBy("rank")
    assert [(r.doc_id, r["rank"], r.score) for r in back.collect()] == [("c", 1, 0.75), ("b", 2, 0.5), ("a", 3, 0.5)]


def _pairs(spark, rows):
    return spark.createDataFrame(rows, "query string, query_id string, doc string, doc_id string, score int")


def test_choices_of_a_large_group(spark):
    rows = [("hot", "h", f"t{i}", f"d{i}", int(i == 7)) for i in range(3000)]
    rows += [("q", "one", "p", "a", 2), ("q", "one", "n", "b", 0), ("x", "pos", "p", "a", 1), ("y", "neg", "n", "a", 0), ("q", "one", "m", "c", -1)]
    choices = pairs.ranked_choices(_pairs(spark, rows))
    sizes = {(r.query_id, r.n_positive, r.n_negative): r["count"] for r in choices.groupBy("query_id", "n_positive", "n_negative").count().collect()}
    assert sizes == {("h", 1, 2999): 3000, ("one", 1, 1): 2}
    assert [r.doc_id for r in choices.where("positive and query_id = 'h'").collect()] == ["d7"]
    with pytest.raises(ValueError):
        pairs.require_choices(pairs.ranked_choices(_pairs(spark, rows).where("query_id = 'pos'")))


def test_scaled_labels_without_a_positive_grade(spark):
    labelled = pairs.graded_labels(_pairs(spark, [("q", "1", "d", "a", 0)]), scale_labels=True)
    assert labelled.first().label == 0.0


def test_last_wins_with_null_keys(spark):
    from rankweave.operators.dedup import keep_last

    df = spark.createDataFrame([("a", 1, "x"), ("a", 3, "y"), (None, 2, "z"), (None, 5, "w")], "k string, at int, v string")
    assert _set(keep_last(df, ["k"], F.col("at"))) == {("a", 3, "y"), (None, 5, "w")}


def test_scratch_needs_a_shared_folder_on_a_cluster(spark, tmp_path):
    from types import SimpleNamespace

    from rankweave import session

    conf = {}
    context = SimpleNamespace(getCheckpointDir=lambda: None, master="spark://host:7077")
    cluster = SimpleNamespace(sparkContext=context, conf=SimpleNamespace(get=lambda k, d: conf.get(k, d)))
    with pytest.raises(ValueError):
        session.scratch_base(cluster)
    conf["spark.checkpoint.dir"] = "hdfs://shared/"
    assert session.scratch_base(cluster) == "hdfs://shared"
    context.getCheckpointDir = lambda: "hdfs://own"
    assert session.scratch_base(cluster) == "hdfs://own"


def test_scratch_scope_removes_its_tables(spark):
    from rankweave import session

    with session.scratch_scope(spark):
        session.staged(spark.range(3), "gone")
        path = session.scratch_path(spark, "kept-by-name")
        spark.range(2).write.parquet(path)
        assert spark.read.parquet(path).count() == 2
    with pytest.raises(PySparkException):
        spark.read.parquet(path)


def test_first_stage_scores_of_pairs(spark):
    topics = spark.createDataFrame([("q", "a b b"), ("r", "z")], "query_id string, query string")
    answers = spark.createDataFrame([("d", "b c"), ("e", "")], "doc_id string, text string")
    ids = spark.createDataFrame([("q", "d"), ("q", "e"), ("r", "d")], "query_id string, doc_id string")
    got = {(r.query_id, r.doc_id): r.bi_score for r in rerank.with_bi_scores(ids, topics, answers).collect()}
    assert got == {("q", "d"): pytest.approx(2 / (5**0.5 * 2**0.5)), ("q", "e"): 0.0, ("r", "d"): 0.0}


@pytest.mark.parametrize("how", ["inner", "left", "left_semi"])
def test_salted_join_equals_the_plain_join(spark, how):
    many = spark.range(3000).select(
        F.when(F.col("id") % 3 > 0, "hot").otherwise(F.concat(F.lit("q"), (F.col("id") % 50).cast("string"))).alias("query_id"),
        F.concat(F.lit("d"), F.col("id").cast("string")).alias("doc_id"),
    )
    one = many.select("query_id").distinct().where("query_id <> 'q3'").withColumn("query", F.upper("query_id"))
    salted = joins.salted_join(many, one, "query_id", "doc_id", how, hot_rows=100)
    want = many.join(one, "query_id", how)
    assert sorted(map(str, salted.select(*want.columns).collect())) == sorted(map(str, want.collect()))


def test_a_hot_key_is_dealt_out_over_salts(spark):
    many = spark.range(3000).select(
        F.when(F.col("id") < 2000, "hot").otherwise(F.concat(F.lit("q"), F.col("id").cast("string"))).alias("k"), "id"
    )
    hot = joins.hot_keys(many, "k", 100)
    assert _set(hot) == {("hot", 20)}
    sizes = joins.with_salt(many, hot, "k", "id").where("k = 'hot'").groupBy("_salt").count().collect()
    assert len(sizes) == 20 and max(r["count"] for r in sizes) < 200


def test_features_do_not_depend_on_salting(spark, monkeypatch):
    answers = spark.createDataFrame([(f"d{i}", f"a b c w{i}") for i in range(5)], "doc_id string, text string")
    topics = spark.createDataFrame([(f"q{i}", f"b c w{i % 5}") for i in range(40)], "query_id string, query string")
    rows = [(f"q{i}", d, 0.1) for i in range(40) for d in ("d0", f"d{1 + i % 4}")]
    found = spark.createDataFrame(rows, "query_id string, doc_id string, bi_score double")
    plain = _set(rerank.candidate_features(found, topics, answers))
    monkeypatch.setattr(rerank, "hot_keys", lambda many, key: joins.hot_keys(many, key, 7))
    assert _set(rerank.candidate_features(found, topics, answers)) == plain and len(plain) == 80


def test_pair_scorer_picks_the_best_candidate_and_survives_saving(spark, tmp_path):
    import random

    rng = random.Random(1)
    rows = []
    for q in range(60):
        for d in range(4):
            good = d == 0
            rows.append((f"q{q}", f"d{d}", 2 if good else 0, (0.8 if good else 0.2) + rng.random() * 0.1, *[rng.random() for _ in FEATURES[1:]]))
    names = ["query_id", "doc_id", "score", *FEATURES]
    data = spark.createDataFrame(rows, names)
    train, val = data.where("query_id < 'q40'"), data.where("query_id >= 'q40'")
    model, reached = fit.fit_pair_scorer(train, val)
    assert reached == 1.0
    path = str(tmp_path / "model")
    fit.save_model(model, path)
    again = fitted_scorer(fit.load_model(path))(val)
    assert _set(again) == _set(fitted_scorer(model)(val))


def test_bi_weights_recover_a_planted_weighting(spark):
    import numpy as np

    rng = np.random.default_rng(0)
    planted = np.array([2.0, 0.0, -1.0, 0.5])
    rows = []
    for _ in range(400):
        q, d = rng.normal(size=4), rng.normal(size=4)
        rows.append((q.tolist(), d.tolist(), float((planted * q * d).sum())))
    pairs_df = spark.createDataFrame(rows, "query_vec array<double>, doc_vec array<double>, label double")
    assert np.allclose(fit.fit_bi_weights(pairs_df), planted, atol=1e-3)
    chosen = fit.fit_bi_weights(pairs_df, pairs_df, candidates=(5.0, 1e-6))
    assert np.allclose(chosen, planted, atol=1e-3)
