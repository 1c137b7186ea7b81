import random

import pytest
from pyspark.sql import functions as F

from rankweave.operators import ranking
from rankweave.operators.split import assign_splits
from rankweave.operators.evaluate import evaluate, mean_metrics, ski_jump, ski_jump_ticks


def test_split_sizes_and_order(spark):
    ids = spark.createDataFrame([(str(i),) for i in range(1003)], "query_id string")
    got = {r.query_id: (r.pos, r.split) for r in assign_splits(ids).collect()}
    hashed = __import__("hashlib").md5
    order = sorted(got, key=lambda q: (hashed(f"42|{q}".encode()).hexdigest(), q))
    assert [got[q][0] for q in order] == list(range(1, 1004))
    assert [got[q][1] for q in order] == ["train"] * 802 + ["val"] * 100 + ["test"] * 101


def test_split_does_not_depend_on_partitioning(spark):
    ids = spark.createDataFrame([(str(i),) for i in range(300)], "query_id string")
    before = sorted(map(tuple, assign_splits(ids.repartition(3)).collect()))
    spark.conf.set("spark.sql.shuffle.partitions", "5")
    try:
        assert sorted(map(tuple, assign_splits(ids.repartition(7)).collect())) == before
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")


def _run_rows():
    rng = random.Random(3)
    rows = []
    for i in range(3000):  # one query holds most rows, and a third of all scores are equal
        query = "hot" if rng.random() < 0.7 else f"q{rng.randrange(40)}"
        score = 0.5 if rng.random() < 0.35 else rng.random()
        rows.append((query, f"d{i}", rng.randrange(20000), score, "t"))
    return rows


@pytest.mark.parametrize("depth", [None, 3000])
def test_rank_run_both_ways(spark, depth):
    rows = _run_rows()
    run = spark.createDataFrame(rows, "query_id string, doc_id string, rank int, score double, tag string")
    got = {(r.query_id, r.doc_id): r["rank"] for r in ranking.rank_run(run, depth).collect()}
    want = {}
    for query in {r[0] for r in rows}:
        mine = sorted((r for r in rows if r[0] == query), key=lambda r: (-r[3], r[2], r[1]))
        want.update({(query, r[1]): n for n, r in enumerate(mine, 1)})
    assert got == want


QRELS = [("q1", "d1", 2), ("q1", "d2", 1), ("q1", "d9", 1), ("q1", "d3", 0), ("q2", "d1", 0), ("q3", "d1", 1)]
RUN = [
    *[("q1", d, s) for d, s in (("d3", 0.9), ("d1", 0.8), ("d4", 0.7), ("d2", 0.6), ("d5", 0.5), ("d9", 0.4))],
    ("q2", "d1", 0.9),
    ("q4", "d1", 0.9),
]


def _ranked(spark):
    run = spark.createDataFrame([(q, d, 0, s, "t") for q, d, s in RUN], "query_id string, doc_id string, rank int, score double, tag string")
    return ranking.rank_run(run)


@pytest.mark.parametrize("depth", [None, 100])
def test_metrics_by_hand(spark, depth):
    qrels = spark.createDataFrame(QRELS, "query_id string, doc_id string, relevance int")
    per_query = evaluate(_ranked(spark), qrels, depth=depth)
    rows = {r.query_id: [round(v, 6) for v in r[1:]] for r in per_query.collect()}
    assert rows == {"q1": [0, 0.4, 0.666667, 0.540586, 0.5, 0.5], "q2": [0] * 6, "q3": [0] * 6}
    means = [round(v, 6) for v in mean_metrics(per_query).first()]
    assert means == [0, 0.133333, 0.222222, 0.180195, 0.166667, 0.166667]


def test_a_perfect_run_scores_one(spark):
    qrels = spark.createDataFrame(
        [("q", f"d{i}", 1 + (i < 3)) for i in range(7)] + [("q", "x", 0)], "query_id string, doc_id string, relevance int"
    )
    run = qrels.where("relevance > 0").withColumn("rank", (F.substring("doc_id", 2, 1).cast("int") + 1))
    row = evaluate(run, qrels).first().asDict()
    assert {k: round(row[k], 9) for k in ("p1", "p5", "ndcg5", "mrr", "map")} == dict.fromkeys(("p1", "p5", "ndcg5", "mrr", "map"), 1)


def test_a_hot_query_with_equal_scores_and_ranks_is_spread(spark):
    run = spark.range(4000).selectExpr("if(id % 10 = 0, 'q', 'hot') AS query_id", "cast(id AS string) AS doc_id", "0 AS rank", "0.5D AS score", "'t' AS tag")
    got = {(r.query_id, r.doc_id): r["rank"] for r in ranking.rank_run(run).collect()}
    hot = sorted(d for q, d in got if q == "hot")
    assert [got["hot", d] for d in hot] == list(range(1, 3601))
    order = [F.col("score").desc(), F.col("doc_id").asc()]
    ranges = run.repartitionByRange(8, F.col("query_id"), *order).groupBy(F.spark_partition_id()).count().collect()
    assert len(ranges) == 8 and max(r["count"] for r in ranges) < 1200


def test_deep_runs_count_hits_across_ranges(spark):
    rng = random.Random(5)
    relevant = {d for d in range(200) if rng.random() < 0.3}
    run = spark.createDataFrame([("q", f"d{i}", i + 1) for i in range(200)], "query_id string, doc_id string, rank int")
    qrels = spark.createDataFrame([("q", f"d{i}", 1) for i in sorted(relevant)], "query_id string, doc_id string, relevance int")
    hits, total = 0, 0.0
    for i in range(200):
        if i in relevant:
            hits += 1
            total += hits / (i + 1)
    assert evaluate(run, qrels).first()["map"] == pytest.approx(total / len(relevant), abs=1e-12)


def test_ski_jump_is_sorted_and_thinned(spark):
    rng = random.Random(9)
    values = [(f"q{i}", rng.choice([0.0, 0.2, 0.4])) for i in range(57)]
    series = ski_jump(spark.createDataFrame(values, "query_id string, p5 double"), jitter_seed=1)
    rows = sorted(series.collect(), key=lambda r: r.pos)
    assert [r.pos for r in rows] == list(range(57))
    assert [r.p5 for r in rows] == sorted(v for _, v in values)
    assert all(abs(r.p5_jittered - r.p5) <= 0.01 for r in rows)
    assert sorted(r.pos for r in ski_jump_ticks(series).collect()) == list(range(0, 57, 5))


def test_top_k_limits_before_the_exchange(spark):
    df = spark.range(100).selectExpr("id % 3 AS g", "id AS v")
    top = ranking.top_k(df, ["g"], [F.col("v").desc()], 2)
    plan = top._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2
    assert sorted(map(tuple, top.collect())) == [(0, 96, 2), (0, 99, 1), (1, 94, 2), (1, 97, 1), (2, 95, 2), (2, 98, 1)]


def test_stored_runs_are_measured_by_system_and_tag(spark, tmp_path):
    """The hand-computed case as one of two result sets; the other has no results."""
    from rankweave.operators.evaluate import evaluate_runs
    from rankweave.sources.readers import read_runs
    from rankweave.sources.writers import write_runs

    qrels = [("q1", "d1", 2), ("q1", "d2", 1), ("q1", "d9", 1), ("q1", "d3", 0), ("q2", "d1", 0), ("q3", "d1", 1)]
    ranked = [("q1", f"d{d}", n, 1.0 - n / 10) for n, d in enumerate((3, 1, 4, 2, 5, 9), 1)] + [("q2", "d1", 1, 0.9), ("q4", "d1", 1, 0.9)]
    rows = [(q, "Q0", d, n, s, "a", 1, "bi") for q, d, n, s in ranked] + [("q1", "Q0", "d1", 1, 0.5, "a", 2, "bi"), ("q1", "Q0", "d1", 1, 0.5, "b", 1, "bi")]
    runs = spark.createDataFrame(rows, "query_id string, q0 string, doc_id string, rank int, score double, system string, topic_set int, tag string")
    write_runs(runs, f"{tmp_path}/runs")
    judged = spark.createDataFrame(qrels, "query_id string, doc_id string, relevance int")
    means = evaluate_runs(spark, f"{tmp_path}/runs", judged, f"{tmp_path}/out", ["a"], ["bi", "ce"], depth=100)
    got = {(r.system, r.tag): [round(v, 6) for v in r[2:]] for r in means.collect()}
    assert got == {("a", "bi"): [0, 0.133333, 0.222222, 0.180195, 0.166667, 0.166667], ("a", "ce"): [0] * 6}
    for tag, p5 in (("bi", 0.4), ("ce", 0.0)):
        written = spark.read.option("header", True).csv(f"{tmp_path}/out/a/{tag}/metrics").collect()
        assert len(written) == 1 and "precision@5" in written[0].asDict()
        series = spark.read.option("header", True).csv(f"{tmp_path}/out/a/{tag}/series").collect()
        assert sorted(int(r.pos) for r in series) == [0, 1, 2]
        assert max(float(r.p5) for r in series) == p5
    plan = read_runs(spark, f"{tmp_path}/runs", ["b"], [1], ["bi"])._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(system" in plan or "system#" in plan.split("PartitionFilters")[1][:200]


def test_judgments_of_hot_topics_and_documents(spark, monkeypatch):
    from rankweave.operators import joins, pairs

    topics = spark.createDataFrame([(f"q{i}", f"query {i}") for i in range(40)], "query_id string, query string")
    answers = spark.createDataFrame([(f"d{i}", f"text {i}") for i in range(40)], "doc_id string, text string")
    rows = [("q0", f"d{i % 50}", i % 3) for i in range(300)] + [(f"q{i % 50}", "d1", 1) for i in range(300)] + [(None, "d1", 1), ("q1", None, 1)]
    qrels = spark.createDataFrame(rows, "query_id string, doc_id string, relevance int")

    def found():
        judged = pairs.judged_pairs(topics, qrels, answers)
        samples = pairs.training_samples(topics, answers, qrels)
        return sorted(map(tuple, judged.collect())), sorted(map(tuple, samples.collect()))

    plain = found()
    known = [(q, d, r) for q, d, r in rows if q and d and int(q[1:]) < 40 and int(d[1:]) < 40]
    assert sorted((r[1], r[3], r[4]) for r in plain[0]) == sorted(known)
    few = joins.hot_keys
    for module in (pairs, joins):
        monkeypatch.setattr(module, "hot_keys", lambda many, key, hot_rows=0: few(many, key, 7))
    assert found() == plain
