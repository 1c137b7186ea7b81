import time
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from rankweave.functions.vectors import dense_from_terms, normalize
from rankweave.operators import similarity
from rankweave.operators.encode import (
    append_cache,
    cached_vectors,
    encode_dense_terms,
    encode_model,
    encode_terms,
    read_cache,
)
from rankweave.operators.evaluate import evaluate, mean_metrics
from rankweave.operators.retrieve import run_rows, two_stage
from rankweave.operators.similarity import cosine_topk
from rankweave.operators.vector_table import VectorTable, with_keys
from rankweave.session import scratch_path

PATHS = {"one block": {}, "passes": {"block_bytes": 4096}, "floors": {"floor_share": 3}, "floored passes": {"block_bytes": 4096, "floor_share": 2, "stored": True}}


def _brute(queries, docs, k, normalize=True):
    out = set()
    for q, qv in queries:
        scored = []
        for d, dv in docs:
            scale = np.linalg.norm(qv) * np.linalg.norm(dv) if normalize else 1.0
            scored.append((-round(float(np.dot(qv, dv)) / scale, 10) if scale else 0.0, d))
        out |= {(q, d, n) for n, (s, d) in enumerate(sorted(scored)[:k], 1)}
    return out


def _got(df):
    return {(r.query_id, r.doc_id, r["rank"]) for r in df.collect()}


@pytest.mark.parametrize("path", PATHS)
@pytest.mark.parametrize("normalize", [True, False])
def test_dense_topk_is_brute_force(spark, path, normalize):
    rng = np.random.default_rng(1)
    # a third of the documents are copies of one vector, two are zero
    docs = [(f"d{i}", (np.ones(6) if i % 3 == 0 else rng.normal(size=6)).tolist()) for i in range(150)]
    docs += [("z1", [0.0] * 6), ("z2", [0.0] * 6)]
    queries = [(f"q{i}", rng.normal(size=6).tolist()) for i in range(9)] + [("one", [1.0] * 6)]
    q = spark.createDataFrame(queries, "query_id string, embedding array<double>").repartition(3)
    d = spark.createDataFrame(docs, "doc_id string, embedding array<double>").repartition(5)
    assert _got(cosine_topk(q, d, 20, normalize, **PATHS[path])) == _brute(queries, docs, 20, normalize)


@pytest.mark.parametrize("path", PATHS)
def test_fewer_documents_than_k(spark, path):
    q = spark.createDataFrame([("q", [1.0, 0.0])], "query_id string, embedding array<double>")
    d = spark.createDataFrame([("a", [1.0, 1.0]), ("b", [1.0, 0.0])], "doc_id string, embedding array<double>")
    assert [tuple(r) for r in cosine_topk(q, d, 100, **PATHS[path]).orderBy("rank").select("doc_id", "rank").collect()] == [("b", 1), ("a", 2)]
    assert cosine_topk(q, d.limit(0), 100, **PATHS[path]).count() == 0
    assert cosine_topk(q.limit(0), d, 100, **PATHS[path]).count() == 0


def _texts(rng, n):
    words = [f"w{i}" for i in range(30)]
    return [" ".join(rng.choice(words, size=rng.integers(0, 25))) for _ in range(n)]


@pytest.mark.parametrize("path", PATHS)
def test_sparse_equals_dense_on_hashed_vectors(spark, path):
    rng = np.random.default_rng(2)
    docs = spark.createDataFrame([(f"d{i}", t) for i, t in enumerate(_texts(rng, 120))], "doc_id string, text string")
    queries = spark.createDataFrame([(f"q{i}", t) for i, t in enumerate(_texts(rng, 12))], "query_id string, query string")
    sparse = cosine_topk(encode_terms(queries, "query", 64), encode_terms(docs, "text", 64), 30, **PATHS[path])
    dense = cosine_topk(encode_dense_terms(queries, "query", 64), encode_dense_terms(docs, "text", 64), 30)
    assert _got(sparse) == _got(dense)


def _skewed(rng, n, terms=4000):
    """Documents of a few very common words and some rare ones, so that bounds tell them apart."""
    common = [f"c{i}" for i in range(12)]
    rare = [f"r{i}" for i in range(terms)]
    return [" ".join([*rng.choice(common, size=rng.integers(3, 30)), *rng.choice(rare, size=rng.integers(5, 20))]) for _ in range(n)]


def test_skipped_blocks_and_cells_change_no_row(spark):
    rng = np.random.default_rng(3)
    texts = _skewed(rng, 3000)
    docs = spark.createDataFrame([(f"d{i}", t) for i, t in enumerate(texts)], "doc_id string, text string")
    queries = [(f"q{i}", " ".join(rng.choice(texts[i * 7].split(), size=12))) for i in range(40)]
    asked = encode_terms(spark.createDataFrame(queries, "query_id string, query string"), "query")
    vectors = encode_terms(docs.repartition(2), "text")
    scored, cells = (spark.sparkContext.accumulator(0) for _ in range(2))
    got = _got(cosine_topk(asked, vectors, 10, floor_share=4, cells=(scored, cells)))
    assert cells.value == 40 * 3000
    assert 2 * scored.value < cells.value
    as_rows = [[(r[0], dict(zip(r.terms, r.tf))) for r in df.collect()] for df in (asked, vectors)]
    want = set()
    for q, own in as_rows[0]:
        ranked = []
        for d, other in as_rows[1]:
            scale = np.sqrt(sum(v * v for v in own.values()) * sum(v * v for v in other.values()))
            ranked.append((-round(sum(v * other.get(t, 0) for t, v in own.items()) / scale, 10), d))
        want |= {(q, d, n) for n, (_, d) in enumerate(sorted(ranked)[:10], 1)}
    assert got == want


def test_floors_leave_fewer_partial_rows(spark):
    rng = np.random.default_rng(5)
    docs = spark.createDataFrame([(f"d{i}", rng.normal(size=8).tolist()) for i in range(4000)], "doc_id string, embedding array<double>").repartition(16)
    queries = spark.createDataFrame([(f"q{i}", rng.normal(size=8).tolist()) for i in range(5)], "query_id string, embedding array<double>")
    block = queries.toArrow()
    floor = similarity._floors(block, docs, similarity._DenseQueries, True, 50, 4)
    rows = [similarity._best(block, f, docs, similarity._DenseQueries, True, 50, None)[1].count() for f in (np.full(5, -np.inf), floor)]
    assert rows[0] == 16 * 5 * 50
    assert rows[1] < rows[0] / 3


def test_documents_are_neither_exchanged_nor_sorted(spark, tmp_path):
    spark.range(500).selectExpr("cast(id as string) as doc_id", "array(rand(1), rand(2)) as embedding").write.parquet(f"{tmp_path}/d")
    docs = spark.read.parquet(f"{tmp_path}/d")
    block = docs.limit(20).withColumnRenamed("doc_id", "query_id").toArrow()
    partial = similarity._best(block, np.full(20, -np.inf), docs, similarity._DenseQueries, True, 5, None)[1]
    plan = partial._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Sort" not in plan


def test_normalizing_is_linear_in_the_entries(spark):
    rng = np.random.default_rng(6)
    rows = [(i, rng.normal(size=6).tolist()) for i in range(7)] + [(7, None), (8, [0.0] * 6)]
    df = spark.createDataFrame(rows, "id long, v array<double>").select("id", normalize(F.col("v")).alias("u"))
    got = {r.id: r.u for r in df.collect()}
    assert got[7] is None and got[8] == [0.0] * 6
    for i, v in rows[:7]:
        assert np.allclose(got[i], np.array(v) / np.linalg.norm(v))

    def seconds(entries):
        many = spark.range(1500).select(F.transform(F.sequence(F.lit(1), F.lit(entries)), lambda x: x + F.rand(1)).alias("v"))
        many.cache().count()
        started = time.perf_counter()
        many.select(normalize(F.col("v")).alias("u")).write.format("noop").mode("overwrite").save()
        taken = time.perf_counter() - started
        many.unpersist()
        return taken

    seconds(64)
    assert seconds(2048) < 4 * max(0.3, seconds(1024))


def test_dense_from_terms(spark):
    df = spark.createDataFrame([([0, 3], [1.0, 2.0]), ([], []), ([4], [7.0])], "terms array<int>, tf array<double>")
    got = [r[0] for r in df.select(dense_from_terms(F.col("terms"), F.col("tf"), 5)).collect()]
    assert got == [[1, 0, 0, 2, 0], [0] * 5, [0, 0, 0, 0, 7]]


def test_published_fixture_metrics(spark):
    """Vectors whose id divides by 25 as queries over the rest, with the means computed beforehand."""
    rows = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    q = rows.where("vec_id % 25 = 0")
    d = rows.where("vec_id % 25 <> 0")
    run = cosine_topk(
        q.select(F.col("vec_id").alias("query_id"), "embedding"), d.select(F.col("vec_id").alias("doc_id"), "embedding")
    )
    grade = F.when(F.col("d.label") == F.col("q.label"), 1 + F.col("d.vec_id") % 2).otherwise(0)
    near = (F.col("d.label") == F.col("q.label")) | (F.col("d.label") == (F.col("q.label") + 1) % 10)
    qrels = q.alias("q").join(d.alias("d"), near).select(
        F.col("q.vec_id").cast("string").alias("query_id"), F.col("d.vec_id").cast("string").alias("doc_id"), grade.cast("int").alias("relevance")
    )
    means = mean_metrics(evaluate(run, qrels, depth=100)).first()
    # ties and order there are by numeric id, which only matters for equal scores
    assert [round(v, 6) for v in means] == [0.05, 0.07, 0.006964, 0.065094, 0.214381, 0.029165]


def test_user_model(spark):
    seen_batches = "batches of at most two"

    def make():
        def encode(texts):
            assert len(texts) <= 2, seen_batches
            return np.array([[len(t), t.count("a")] for t in texts], dtype=np.float32).reshape(len(texts), 2)

        return encode

    df = spark.createDataFrame([("x", "banana"), ("y", None), ("z", "b")], "doc_id string, text string")
    rows = {r.doc_id: r.embedding for r in encode_model(df, "text", make, batch_size=2).collect()}
    assert rows == {"x": [6.0, 3.0], "y": [0.0, 0.0], "z": [1.0, 0.0]}


def test_cache_adds_only_what_is_missing(spark):
    path = scratch_path(spark, "cache")
    old = spark.createDataFrame([("a", "one two"), ("b", "two")], "doc_id string, text string")
    append_cache(old, path, "m1")
    append_cache(old, path, "m2")
    now = spark.createDataFrame([("a", "one two"), ("b", "changed"), ("c", "new")], "doc_id string, text string")
    vectors = {r.doc_id: (r.terms, r.tf) for r in cached_vectors(now, path, "m1").collect()}
    assert cached_vectors(now, path, "m1").count() == 3  # a second call adds nothing
    want = {r.doc_id: (r.terms, r.tf) for r in encode_terms(now, "text").collect()}
    assert vectors == want
    assert read_cache(spark, path, "m1").count() == 4  # a, b, changed b, c
    assert read_cache(spark, path, "m2").count() == 2


def _lengths(df):
    """An encoder of the others' kind, which tells how often it ran."""

    def make():
        return lambda texts: np.array([[len(t), t.count("o")] for t in texts], dtype=np.float32)

    return encode_model(df, "text", make)


def test_stored_vectors_of_a_model(spark, tmp_path):
    table = VectorTable(spark, str(tmp_path), "m/1", buckets=3)
    docs = spark.createDataFrame([(f"d{i}", "o" * i) for i in range(20)] + [("null", None)], "doc_id string, text string")
    assert table.rows() is None
    first = {r.doc_id: r.embedding for r in table.vectors(docs.limit(7), _lengths).collect()}
    assert len(first) == 7
    found = {r.doc_id: r.embedding for r in table.vectors(docs, _lengths).collect()}
    assert found == {f"d{i}": [float(i)] * 2 for i in range(20)} | {"null": [0.0, 0.0]}
    assert table.update(docs, _lengths) == 0 and table.rows().count() == 21
    changed = spark.createDataFrame([("d3", "changed"), ("new", "oo")], "doc_id string, text string")
    assert table.update(changed, _lengths) == 2
    assert {r.doc_id: r.embedding for r in table.vectors(changed, _lengths).collect()} == {"d3": [7.0, 0.0], "new": [2.0, 2.0]}
    table.add(table.rows().where("doc_id = 'new'"))  # another writer at the same time
    assert table.rows().count() == 24
    assert table.vectors(changed, _lengths).count() == 2
    other = VectorTable(spark, str(tmp_path), "m/2", buckets=3)
    assert other.rows() is None
    table.compact(keep=changed)
    assert sorted(r.doc_id for r in table.rows().collect()) == ["d3", "new"]
    assert [v[0] for v in table._versions()] == [2]
    assert not spark.catalog.listTables()


def test_looking_up_moves_no_text_and_no_stored_row(spark, tmp_path):
    table = VectorTable(spark, str(tmp_path), "m", buckets=4)
    docs = spark.createDataFrame([(f"d{i}", "o" * i) for i in range(50)], "doc_id string, text string")
    docs.write.parquet(f"{tmp_path}/docs")
    docs = spark.read.parquet(f"{tmp_path}/docs")
    table.update(docs.limit(30), _lengths)
    keep = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = table.missing_keys(with_keys(docs).select("key"))._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", keep)
    lines = plan.splitlines()
    exchanges = [i for i, line in enumerate(lines) if "Exchange" in line]
    assert len(exchanges) == 1  # of the documents' keys; the stored side lies in its buckets
    assert "Bucketed: true" in plan or "SelectedBucketsCount" in plan
    below = lines[exchanges[0] + 1]
    assert "Project [concat_ws" in below and "AS key" in below


def test_two_stage_invariants(spark):
    rng = np.random.default_rng(4)
    docs = spark.createDataFrame([(f"d{i}", t) for i, t in enumerate(_texts(rng, 80))], "doc_id string, text string")
    queries = [(f"q{i}", t) for i, t in enumerate(_texts(rng, 8))] + [("q0", "again"), ("", "no id"), ("empty", "")]
    topics = spark.createDataFrame(queries, "query_id string, query string")
    found = two_stage(topics.where("query <> 'again'"), docs, k=15).collect()
    by_query = {}
    for r in found:
        by_query.setdefault(r.query_id, []).append(r)
    assert "" not in by_query and "empty" not in by_query
    for rows in by_query.values():
        assert sorted(r.bi_rank for r in rows) == sorted(r.ce_rank for r in rows) == list(range(1, 16))
        order = sorted(rows, key=lambda r: (-r.ce_score, r.bi_rank))
        assert [r.ce_rank for r in order] == list(range(1, 16))
    runs = run_rows(spark.createDataFrame(found))
    assert runs.count() == 2 * len(found)
    assert {r[0] for r in runs.select("tag").distinct().collect()} == {"bi-encoder", "cross-encoder"}


def test_topics_are_cleaned_before_one_text_is_chosen(spark):
    from rankweave.operators.retrieve import prepare_topics

    rows = [("q1", ""), ("q1", "Hello!"), ("q2", "?"), ("q3", "b"), ("q3", "a"), ("", "x"), (None, "y")]
    topics = spark.createDataFrame(rows, "query_id string, query string")
    assert {tuple(r) for r in prepare_topics(topics, True).collect()} == {("q1", "hello"), ("q3", "a")}


def test_two_stage_with_user_models(spark):
    def make_encoder():
        return lambda texts: np.array([[t.count("a") + 1, t.count("b")] for t in texts], dtype=np.float32)

    def make_scorer():
        return lambda texts: np.array([len(d) - len(q) for q, d in texts], dtype=np.float64)

    docs = spark.createDataFrame([("x", "A!a"), ("y", "b"), ("z", "aa aab")], "doc_id string, text string")
    topics = spark.createDataFrame([("q", "a")], "query_id string, query string")
    found = two_stage(
        topics, docs, encode=lambda df, text: encode_model(df, text, make_encoder), pair_model=make_scorer, k=2
    )
    rows = {r.doc_id: (r.bi_rank, r.ce_rank, r.ce_score) for r in found.collect()}
    assert rows == {"x": (1, 2, 1.0), "z": (2, 1, 5.0)}


def test_batches_are_ordered_together(monkeypatch):
    """Few orderings for many batches, and still the best rows, ties by id."""
    rng = np.random.default_rng(4)
    queries, width, k = 40, 50, 10
    best, merges = similarity._BestDocs(np.full(queries, -np.inf), k), []
    merge = best._merge
    monkeypatch.setattr(best, "_merge", lambda: (merges.append(len(best.waiting)), merge()))
    scores = rng.integers(-3, 40, (queries, 200 * width)) / 40 + rng.choice([0.0, 2e-11, -2e-11], (queries, 200 * width))
    ids = np.array([f"d{i}" for i in rng.permutation(200 * width)], dtype=object)
    for start in range(0, len(ids), width):
        best.add(ids[start : start + width], scores[:, start : start + width])
    table = best.table(np.array([f"q{i}" for i in range(queries)], dtype=object))
    want = {
        (f"q{q}", doc, score)
        for q in range(queries)
        for score, doc in sorted(zip(np.round(scores[q], 10).tolist(), ids.tolist()), key=lambda r: (-r[0], r[1]))[:k]
    }
    assert set(zip(*(c.to_pylist() for c in table.columns))) == want
    assert len(merges) < 20


def _random_vectors(rng, rows, kind):
    if kind is similarity._DenseQueries:
        flat = pa.array(rng.normal(size=rows * 16))
        return [pa.ListArray.from_arrays(pa.array(np.arange(rows + 1, dtype=np.int32) * 16), flat)]
    offsets = pa.array(np.arange(rows + 1, dtype=np.int32) * 40)
    terms = np.sort(rng.integers(0, 60, (rows, 40)) + np.arange(40) * 60, axis=1).ravel()
    return [pa.ListArray.from_arrays(offsets, pa.array(terms)), pa.ListArray.from_arrays(offsets, pa.array(rng.integers(1, 4, rows * 40) + 0.0))]


@pytest.mark.parametrize("kind", [similarity._DenseQueries, similarity._TermQueries])
def test_a_task_of_the_search_holds_little_beside_its_rows(kind):
    """4,000 queries keep 400,000 rows; the arrays of a step and the ordering of rows come on top."""
    rng, queries, docs = np.random.default_rng(9), 4000, 3000

    class Shared:
        value = pa.table([pa.array([f"q{i}" for i in range(queries)]), *_random_vectors(rng, queries, kind)], names=["query_id", *kind.columns]), np.full(queries, -np.inf)

    ids = pa.array([f"d{i}" for i in range(docs)])
    batch = pa.record_batch([ids, *_random_vectors(rng, docs, kind)], names=["doc_id", *kind.columns])
    tracemalloc.start()
    rows = sum(len(b) for b in similarity._scorer(kind, Shared, True, 100, None)(batch.slice(at, 1000) for at in range(0, docs, 1000)))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert rows == queries * 100
    assert peak < 100e6


def _jobs(spark, group, run):
    spark.sparkContext.setJobGroup(group, group)
    run()
    return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))


def test_passes_of_query_blocks_run_side_by_side(spark, tmp_path):
    """A job takes all blocks: four times as many blocks of queries need no more jobs."""
    rng = np.random.default_rng(10)
    rows = spark.createDataFrame([(f"d{i}", rng.normal(size=6).tolist()) for i in range(300)], "doc_id string, embedding array<double>")
    rows.write.parquet(f"{tmp_path}/d")
    docs = spark.read.parquet(f"{tmp_path}/d")
    queries = docs.withColumnRenamed("doc_id", "query_id")
    size = 300 * (6 + 10 * 8) * 8
    jobs, found = [], []
    for blocks in (16, 64):
        run = lambda: found.append(_got(cosine_topk(queries, docs, 10, block_bytes=size // blocks, floor_share=4, stored=True)))  # noqa: E731, B023
        jobs.append(_jobs(spark, f"{blocks} blocks", run))
    vectors = [tuple(r) for r in docs.collect()]
    assert found[0] == found[1] == _brute(vectors, vectors, 10)
    assert jobs[0] == jobs[1]


@pytest.mark.parametrize("element", ["float", "double"])
@pytest.mark.parametrize("share", [0, 4])
def test_slices_of_documents_change_no_row(spark, monkeypatch, element, share):
    """Copies, zeros, tiny and large vectors in many slices, whose equal scores go by id over all of them."""
    monkeypatch.setattr(similarity, "SLICE_BYTES", 2000)
    rng = np.random.default_rng(11)
    some = rng.normal(size=(12, 5)).astype(np.float32)
    docs = [(f"d{i}", (some[i % 12] * np.float32(4.0 ** (i % 3 * 20 - 20))).tolist()) for i in rng.permutation(400)]
    docs += [(f"z{i}", [0.0] * 5) for i in range(8)] + [("tiny", [1e-40, 0.0, 0.0, 0.0, 0.0])]
    queries = [(f"q{i}", rng.normal(size=5).astype(np.float32).tolist()) for i in range(30)] + [("zero", [0.0] * 5)]
    q = spark.createDataFrame(queries, f"query_id string, embedding array<{element}>").repartition(3)
    d = spark.createDataFrame(docs, f"doc_id string, embedding array<{element}>").repartition(5)
    vectors = [(r.doc_id, r.embedding) for r in d.collect()]
    asked = [(r.query_id, r.embedding) for r in q.collect()]
    assert _got(cosine_topk(q, d, 40, block_bytes=4096, floor_share=share)) == _brute(asked, vectors, 40)


def test_scores_nearer_than_single_precision_are_told_apart(spark):
    """Documents whose cosines differ by some 1e-9, among others that are far away."""
    rng = np.random.default_rng(12)
    close = [(f"c{i:03d}", [1.0, 1e-4 * (1 + 1e-2 * i), 0.0]) for i in range(200)]
    docs = [close[i] for i in rng.permutation(200)] + [(f"f{i}", rng.normal(size=3).tolist()) for i in range(3000)]
    queries = [(f"q{i}", [1.0, 0.0, 0.0]) for i in range(8)]
    q = spark.createDataFrame(queries, "query_id string, embedding array<double>")
    d = spark.createDataFrame(docs, "doc_id string, embedding array<double>").repartition(3)
    want = _brute(queries, docs, 20)
    assert {doc for _, doc, _ in want} <= {name for name, _ in close}
    for path in ("one block", "floored passes"):
        assert _got(cosine_topk(q, d, 20, **PATHS[path])) == want


def test_queries_of_one_id_share_a_list(spark):
    """Repeated and null ids give the same rows in streamed blocks as in one block."""
    rng = np.random.default_rng(13)
    names = [None if i % 10 == 0 else f"q{i // 2}" for i in range(40)]
    q = spark.createDataFrame([(n, rng.normal(size=4).tolist()) for n in names], "query_id string, embedding array<double>")
    docs = [(None if i == 7 else f"d{i // 2}", rng.integers(-1, 2, 4).astype(float).tolist()) for i in range(90)]
    d = spark.createDataFrame(docs, "doc_id string, embedding array<double>").repartition(3)
    rows = [sorted(map(str, cosine_topk(q, d, 15, **PATHS[path]).collect())) for path in ("one block", "floored passes")]
    assert len(rows[0]) == 15 * len(set(names))
    assert rows[0] == rows[1]


def test_many_equal_scores_are_held_in_bounded_memory(monkeypatch):
    """A batch of copies: cells that no score tells apart are cut by id, before the batch ends."""
    monkeypatch.setattr(similarity, "WAITING", 1000)
    copies = np.tile(np.array([[0.6, 0.8]]), (20_000, 1))
    column = pa.ListArray.from_arrays(pa.array(np.arange(20_001, dtype=np.int32) * 2), pa.array(copies.ravel()))
    ids = pa.array([f"d{i:05d}" for i in np.random.default_rng(14).permutation(20_000)])
    block = pa.table([pa.array(["a", "b"]), column[:2]], names=["query_id", "embedding"])
    queries, best, held = similarity._DenseQueries(block, True), similarity._BestDocs(np.full(2, -np.inf), 10), []
    monkeypatch.setattr(similarity, "CELLS", 1000)
    add = best.add_cells
    monkeypatch.setattr(best, "add_cells", lambda ids, query, doc, scores: (held.append(len(query)), add(ids, query, doc, scores)))
    queries.scan(pa.table([ids, column], names=["doc_id", "embedding"]), ids, best)
    assert sum(held) == 2 * 20_000 and max(held) < 5000
    rows = best.rows()
    assert sorted(zip(rows["query"].to_pylist(), rows["doc"].to_pylist())) == [(q, f"d{i:05d}") for q in range(2) for i in range(10)]
