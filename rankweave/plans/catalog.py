"""Every operator as a named query over the given tables."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rankweave.functions import text as tx
from rankweave.functions.vectors import cosine, normalize
from rankweave.operators import encode, evaluate, fit, idf, pairs, rerank, retrieve
from rankweave.operators.dedup import keep_highest, keep_last
from rankweave.operators.similarity import DEPTH, cosine_topk
from rankweave.operators.split import TWO_WAY, assign_splits
from rankweave.operators.vector_table import VectorTable
from rankweave.plans import standins as si
from rankweave.session import scratch_path, staged
from rankweave.sources import readers, writers

Query = Callable[[SparkSession, str], DataFrame]

SHOWN_SCALE = 1e6


def shown(name: str) -> Column:
    """Rounded half up on the binary value, as the comparison engine does, not on its decimal text."""
    return (F.round(F.col(name) * SHOWN_SCALE) / SHOWN_SCALE).alias(name)


# --- sources and sinks -------------------------------------------------------------------------------


def load_topics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Drafts of all benchmark items, then the final text of those without a line break."""
    items = si.text_topics(spark, sf_dir)
    path = scratch_path(spark, "topics")
    items.withColumn("query", F.concat(F.lit("Draft: "), F.col("query"))).write.json(f"{path}/1-drafts")
    items.where(~F.col("query").contains("\n")).write.json(f"{path}/2-final")
    return readers.load_topics(spark, [f"{path}/1-drafts", f"{path}/2-final"])


def _answer_parts(spark: SparkSession, sf_dir: str) -> dict[str, tuple[DataFrame, bool]]:
    """Documents (no ``doc`` key for one source), pages (some null), then revised labelled documents, with
    whether a null is written."""
    docs = si.table(spark, sf_dir, "documents")
    ident = F.col("doc_id").cast("string").alias("doc_id")
    plain = docs.select(ident, F.when(F.col("source") != "src0", F.col("text")).alias("doc"))
    pages = si.table(spark, sf_dir, "pages").select(
        F.concat(F.lit("p"), F.col("page_id").cast("string")).alias("doc_id"),
        F.when(~F.col("html").contains("&copy;"), F.col("html")).alias("doc"),
    )
    labelled = docs.join(si.table(spark, sf_dir, "labels").select("doc_id"), "doc_id", "left_semi")
    revised = labelled.select(ident, F.concat(F.lit("Revised. "), F.col("text")).alias("doc"))
    return {"1-docs": (plain, False), "2-pages": (pages, True), "3-revised": (revised, False)}


def load_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The parts as JSON Lines."""
    path = scratch_path(spark, "answers")
    for name, (rows, nulls) in _answer_parts(spark, sf_dir).items():
        rows.write.option("ignoreNullFields", not nulls).json(f"{path}/{name}")
    return readers.load_answers(spark, [f"{path}/{name}" for name in ("1-docs", "2-pages", "3-revised")])


#: Records of a file that holds one array.
ARRAY_RECORDS = 500


def load_answers_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The parts as files of one JSON array each, about ``ARRAY_RECORDS`` records long."""
    path = scratch_path(spark, "answer-arrays")
    for name, (rows, nulls) in _answer_parts(spark, sf_dir).items():
        files = max(1, rows.count() // ARRAY_RECORDS)
        record = F.to_json(F.struct("doc_id", "doc"), {"ignoreNullFields": str(not nulls).lower()})
        dealt = rows.groupBy(F.pmod(F.xxhash64("doc_id"), F.lit(files)).alias("file")).agg(F.collect_list(record).alias("_r"))
        array = F.concat(F.lit("["), F.array_join("_r", ",\n"), F.lit("]"))
        dealt.select("file", array.alias("value")).write.partitionBy("file").text(f"{path}/{name}")
    return readers.load_answers(spark, [f"{path}/{name}" for name in ("1-docs", "2-pages", "3-revised")], array=True)


def _qrel_files(spark: SparkSession, sf_dir: str) -> list[str]:
    path = scratch_path(spark, "qrels")
    graded = si.chat_qrels(spark, sf_dir)
    lines = F.concat_ws(" ", "query_id", F.lit("0"), "doc_id", F.col("relevance").cast("string"))
    graded.where(F.col("relevance") < 2).select(lines.alias("value")).write.text(f"{path}/1-first")
    graded.where(F.col("relevance") > 0).select(lines.alias("value")).write.text(f"{path}/2-second")
    graded.where(F.col("relevance") == 2).select(lines.alias("value")).write.text(f"{path}/3-third")
    return [f"{path}/{part}" for part in ("1-first", "2-second", "3-third")]


def parse_qrel_last(spark: SparkSession, sf_dir: str) -> DataFrame:
    return readers.parse_qrel(spark, _qrel_files(spark, sf_dir), conflict="last")


def parse_qrel_set(spark: SparkSession, sf_dir: str) -> DataFrame:
    return readers.parse_qrel(spark, _qrel_files(spark, sf_dir), conflict="keep_all")


def _split_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pairs.split_pairs(
        si.chat_topics(spark, sf_dir), si.chat_qrels(spark, sf_dir), si.chat_answers(spark, sf_dir)
    )


def _split_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pairs.split_ids(
        si.chat_topics_raw(spark, sf_dir).select(F.col("Id").alias("query_id")),
        si.chat_qrels(spark, sf_dir),
        si.chat_answers(spark, sf_dir),
    )


def _pair_files(spark: SparkSession, sf_dir: str) -> str:
    path = scratch_path(spark, "pairs")
    writers.write_pairs(_split_pairs(spark, sf_dir), path)
    return path


def pairs_json_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return readers.scan_pairs(spark, _pair_files(spark, sf_dir))


def scan_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids and grades only: the scan parses three fields of the written pairs."""
    return readers.scan_pairs(spark, _pair_files(spark, sf_dir)).select("query_id", "doc_id", "score")


def embed_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled documents are in the table first; a second pass adds what is missing."""
    table = VectorTable(spark, scratch_path(spark, "vectors"), "clean terms")
    docs = si.text_answers(spark, sf_dir)
    table.update(_labelled(spark, sf_dir, docs), _clean_terms)
    return encode.explode_terms(table.vectors(docs, _clean_terms).select("doc_id", "terms", "tf"), ["doc_id"])


def _cleaned(docs: DataFrame) -> DataFrame:
    return docs.withColumn("text", tx.clean_text(F.col("text")))


def _clean_terms(docs: DataFrame) -> DataFrame:
    """Cleaning is part of the encoder, so that looking up stored vectors reads texts as they are."""
    return encode.encode_terms(_cleaned(docs), "text")


DENSE = 64


def embed_cache_dense(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dense vectors through the table: labelled documents first, then all, of which a third pass finds none
    missing."""
    table = VectorTable(spark, scratch_path(spark, "dense-vectors"), "clean dense/64")
    docs = si.text_answers(spark, sf_dir)
    encode_all = lambda df: encode.encode_dense_terms(_cleaned(df), "text", DENSE)
    table.update(_labelled(spark, sf_dir, docs), encode_all)
    table.update(docs, encode_all)
    added = table.update(docs, encode_all)
    if added:
        raise AssertionError(f"{added} texts were encoded twice")
    rows = table.vectors(docs, encode_all).select("doc_id", F.posexplode("embedding").alias("dim", "value"))
    return rows.where(F.col("value") != 0).select("doc_id", "dim", shown("value"))


def _labelled(spark: SparkSession, sf_dir: str, docs: DataFrame) -> DataFrame:
    labels = si.table(spark, sf_dir, "labels").select(F.col("doc_id").cast("string").alias("doc_id"))
    return docs.join(labels, "doc_id", "left_semi")


def embed_cache_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents still to encode, where the table holds those labelled as good quality and the toxic
    ones had another text when they were encoded."""
    docs = si.text_answers(spark, sf_dir)
    labels = si.table(spark, sf_dir, "labels").where(F.col("quality") == 1)
    seen = docs.join(labels.select(F.col("doc_id").cast("string").alias("doc_id"), "toxic"), "doc_id")
    old = F.when(F.col("toxic") == 1, F.concat(F.col("text"), F.lit(" old"))).otherwise(F.col("text"))
    cached = encode.with_text_hash(seen.withColumn("text", old)).select("doc_id", "text_hash")
    return encode.not_cached(docs, cached).select("doc_id", "text_hash")


def read_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run file that lists every row twice, under a rank that says nothing."""
    path = scratch_path(spark, "run")
    run = si.vector_run(spark, sf_dir).withColumn("tag", F.lit("vectors")).withColumn("rank", F.lit(0))
    twice = run.withColumn("_copy", F.explode(F.array(F.lit(1), F.lit(2)))).drop("_copy")
    writers.write_run(twice, path)
    return readers.read_run(spark, path).select("query_id", "doc_id", "rank", shown("score"))


def run_tsv_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "run")
    writers.write_run(retrieve.run_rows(_text_results(spark, sf_dir)), path, ordered=True)
    fields = F.split(F.col("value"), "\t")
    return spark.read.text(path).select(
        F.array_join(F.slice(fields, 1, 4), "\t").alias("line"),
        F.get(fields, 4).cast("double").alias("score"),
        F.get(fields, 5).alias("tag"),
        F.size(fields).alias("n_fields"),
    ).select("line", shown("score"), "tag", "n_fields")


def test_qrel_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "qrels")
    chosen = pairs.split_qrels(_split_ids(spark, sf_dir), si.chat_qrels(spark, sf_dir), "test")
    writers.write_qrels(chosen, path)
    return spark.read.text(path).select(F.col("value").alias("line"))


def metrics_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "metrics")
    means = evaluate.named_metrics(evaluate.mean_metrics(_vector_metrics(spark, sf_dir)))
    writers.write_metrics(means, path)
    names = list(evaluate.METRICS.values())
    read = spark.read.schema(", ".join(f"`{n}` double" for n in names)).option("header", True).csv(path)
    return read.select(*[shown(n) for n in names])


# --- text --------------------------------------------------------------------------------------------


def clean_text_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = si.documents(spark, sf_dir)
    return docs.select("doc_id", tx.clean_text(F.col("text")).alias("text"))


def clean_text_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = si.pages(spark, sf_dir)
    return pages.select("page_id", tx.clean_text(F.col("html")).alias("text"))


def html_to_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = si.pages(spark, sf_dir)
    return pages.select("page_id", tx.html_to_text(F.col("html")).alias("text"))


def strip_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    sentence = F.concat(F.lit("see "), F.col("url"), F.lit(" or www.example.org/x now"))
    return si.table(spark, sf_dir, "pages").select("page_id", tx.strip_urls(sentence).alias("text"))


def strip_special(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = si.documents(spark, sf_dir)
    return docs.select("doc_id", tx.strip_special(F.col("text")).alias("text"))


def scan_raw_topics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw topics through Parquet and JSON Lines files, composed."""
    path = scratch_path(spark, "raw-topics")
    raw = si.page_topics_raw(spark, sf_dir)
    even = F.col("Id").cast("long") % 2 == 0
    raw.where(even).write.parquet(f"{path}/a")
    raw.where(~even).write.json(f"{path}/b")
    read = readers.read_raw(spark, f"{path}/a", "topics", "parquet").unionByName(readers.read_raw(spark, f"{path}/b", "topics"))
    return pairs.compose_topics(read)


def scan_raw_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "raw-answers")
    docs = si.text_answers(spark, sf_dir).select(F.col("doc_id").alias("Id"), F.col("text").alias("Text"))
    docs.write.json(path)
    return readers.load_raw_answers(spark, path)


def compose_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pairs.compose_topics(si.page_topics_raw(spark, sf_dir))


def default_topic_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chat topics; those with a line break in the title have no id."""
    raw = si.chat_topics_raw(spark, sf_dir).withColumnRenamed("Id", "key")
    topics = raw.select("key", "Title", F.when(~F.col("Title").contains("\n"), F.col("key")).alias("Id"))
    return pairs.default_topic_ids(topics, F.col("key")).select("key", "Id", "Title")


def _mixed_topics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns under query_id/query (empty unless by a user), benchmark items under Id/Title."""
    turns = si.table(spark, sf_dir, "conversations")
    chat = turns.select(
        F.concat_ws("-", F.col("conv_id").cast("string"), F.col("turn").cast("string")).alias("query_id"),
        F.when(F.col("role") == "user", F.col("text")).otherwise(F.lit("")).alias("query"),
        F.lit(None).cast("string").alias("Id"),
        F.lit(None).cast("string").alias("Title"),
    )
    items = si.table(spark, sf_dir, "benchmark").select(
        F.lit("").alias("query_id"),
        F.when(F.col("text").contains("\n"), F.lit("!?")).alias("query"),
        F.col("item_id").cast("string").alias("Id"),
        F.col("text").alias("Title"),
    )
    return chat.unionByName(items)


def resolve_topic_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pairs.resolve_topics(_mixed_topics(spark, sf_dir), clean_queries=True)


def valid_topics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pairs.valid_topics(pairs.resolve_topics(_mixed_topics(spark, sf_dir), clean_queries=False))


# --- pairs and splits --------------------------------------------------------------------------------


def judged_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pairs.judged_pairs(
        si.chat_topics(spark, sf_dir), si.chat_qrels(spark, sf_dir), si.chat_answers(spark, sf_dir)
    )


def split_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _split_ids(spark, sf_dir).groupBy("split").agg(
        F.count("*").alias("n_pairs"), F.count_distinct("query_id").alias("n_queries")
    )


def split_leakage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Query ids shared by two splits (must be none), next to the number of all query ids."""
    places = _split_ids(spark, sf_dir).select("query_id", "split").distinct()
    per_query = places.groupBy("query_id").agg(F.count("*").alias("n"))
    return per_query.agg(F.count("*").alias("n_queries"), F.count_if(F.col("n") > 1).alias("n_shared"))


def split_two_way(spark: SparkSession, sf_dir: str) -> DataFrame:
    return assign_splits(si.chat_qrels(spark, sf_dir).select("query_id").distinct(), TWO_WAY)


def binary_label_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Samples from cleaned texts. All turns are judged, but only user turns are topics: the rest get ''."""
    topics = si.chat_topics_raw(spark, sf_dir).select(
        F.col("Id").alias("query_id"), tx.clean_text(F.col("Title")).alias("query")
    )
    answers = retrieve.clean_answers(si.chat_answers(spark, sf_dir))
    return pairs.training_samples(topics, answers, keep_highest(si.chat_qrels(spark, sf_dir, all_roles=True)))


def graded_label_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    plain = judged_pairs(spark, sf_dir)
    scaled = pairs.graded_labels(plain, scale_labels=True).withColumnRenamed("label", "scaled_label")
    return pairs.graded_labels(scaled).select("query_id", "doc_id", "score", "label", "scaled_label")


def dedup_last(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last document of every distinct text, by id."""
    docs = si.table(spark, sf_dir, "documents").select(F.md5("text").alias("text_hash"), "doc_id", "n_chars")
    return keep_last(docs, ["text_hash"], F.col("doc_id"))


def pos_neg_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents of the queries that have both sides, with the sizes of the sides."""
    choices = pairs.ranked_choices(judged_pairs(spark, sf_dir))
    return choices.select("query_id", "doc_id", "score", "positive", "n_positive", "n_negative")


def explode_pos_neg(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pairs.ranked_choices(judged_pairs(spark, sf_dir)).select("query_id", "query", "doc", "positive")


# --- vectors and similarity --------------------------------------------------------------------------


def embed_queries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode.explode_terms(encode.encode_terms(si.text_topics(spark, sf_dir), "query"), ["query_id"])


def normalize_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = si.table(spark, sf_dir, "embeddings").select("vec_id", normalize(F.col("embedding")).alias("unit"))
    unit = rows.select("vec_id", F.posexplode("unit").alias("dim", "value"))
    return unit.select("vec_id", "dim", shown("value"))


def cosine_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = si.vector_judgments(spark, sf_dir)
    return judged.select(
        "query_id", "doc_id", cosine(F.col("query_vec"), F.col("doc_vec")).alias("cosine")
    ).select("query_id", "doc_id", shown("cosine"))


def cosine_mse(spark: SparkSession, sf_dir: str) -> DataFrame:
    labelled = si.vector_judgments(spark, sf_dir).withColumn("label", F.col("relevance").cast("double"))
    return fit.cosine_loss(labelled).select(shown("mse"), "n_pairs")


def _vector_topk(spark: SparkSession, sf_dir: str, **options: int) -> DataFrame:
    found = cosine_topk(si.vectors(spark, sf_dir, "query_id"), si.vectors(spark, sf_dir, "doc_id"), **options)
    return found.select("query_id", "doc_id", "rank", shown("score"))


def cosine_top(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _vector_topk(spark, sf_dir)


def cosine_topk_blocked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A pass for each block of queries, as for sets too large to broadcast, and floors from one document
    in four; blocks of about 4 MB here."""
    return _vector_topk(spark, sf_dir, block_bytes=4 << 20, floor_share=4, stored=True)


def sparse_cosine_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    queries = encode.encode_terms(retrieve.prepare_topics(si.text_topics(spark, sf_dir), True), "query")
    docs = encode.encode_terms(retrieve.clean_answers(si.text_answers(spark, sf_dir)), "text")
    return cosine_topk(queries, docs).select("query_id", "doc_id", "rank", shown("score"))


def _idf_model(spark: SparkSession, sf_dir: str, docs: DataFrame) -> DataFrame:
    """The encoder fitted on the documents, through the store."""
    path = scratch_path(spark, "encoders")
    idf.save_idf(idf.fit_idf(docs, "text"), path, "documents")
    return idf.load_idf(spark, path, "documents")


def embed_docs_idf(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = retrieve.clean_answers(si.text_answers(spark, sf_dir))
    vectors = idf.encode_idf(docs, "text", _idf_model(spark, sf_dir, docs))
    return encode.explode_terms(vectors, ["doc_id"]).select("doc_id", "term", shown("tf"))


def idf_cosine_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The search of ``sparse_cosine_topk`` under the fitted encoder."""
    docs = retrieve.clean_answers(si.text_answers(spark, sf_dir))
    fitted = _idf_model(spark, sf_dir, docs)
    queries = idf.encode_idf(retrieve.prepare_topics(si.text_topics(spark, sf_dir), True), "query", fitted, "query_id")
    found = cosine_topk(queries, idf.encode_idf(docs, "text", fitted))
    return found.select("query_id", "doc_id", "rank", shown("score"))


# --- second stage ------------------------------------------------------------------------------------


def _text_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    return retrieve.two_stage(si.text_topics(spark, sf_dir), si.text_answers(spark, sf_dir))


def rerank_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Features and second score of every judged chat pair."""
    return _scored_pairs(spark, sf_dir).select(
        "query_id", "doc_id", "score", *[shown(name) for name in (*rerank.FEATURES, "ce_score")]
    )


def _scored_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rerank.weighted_scorer()(_pair_features(spark, sf_dir))


def _pair_features(spark: SparkSession, sf_dir: str, weights: Sequence[float] | None = None) -> DataFrame:
    """Features of the judged pairs (ids, grade, split) over cleaned texts, the first-stage score among them."""
    topics = retrieve.prepare_topics(si.chat_topics(spark, sf_dir), True)
    answers = retrieve.clean_answers(si.chat_answers(spark, sf_dir))
    judged = staged(rerank.with_bi_scores(_split_ids(spark, sf_dir), topics, answers, weights), "bi-scores")
    features = rerank.candidate_features(judged, topics, answers)
    return staged(features.withColumnRenamed("relevance", "score"), "features")


def rerank_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _text_results(spark, sf_dir).select("query_id", "doc_id", "bi_rank", "ce_rank", shown("ce_score"))


def two_stage_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    return retrieve.run_rows(_text_results(spark, sf_dir)).select(
        "query_id", "q0", "doc_id", "rank", shown("score"), "tag"
    )


def _system_runs(
    spark: SparkSession, sf_dir: str, systems: Sequence[str] = ("basic", "fine_tuned"), topic_sets: Sequence[int] = (1, 2)
) -> DataFrame:
    """Both stages of each system over each topic set and the chat answers: up to eight result sets.

    ``basic`` searches with term vectors and scores with fixed weights, as it stands. ``fine_tuned``
    searches with fitted weights over dense vectors and scores with a fitted model, both from the train split.
    """
    answers = si.chat_answers(spark, sf_dir)
    cleaned = retrieve.clean_answers(answers)
    topics = {}
    if 1 in topic_sets:
        test = _split_pairs(spark, sf_dir).where(F.col("split") == "test")
        topics[1] = staged(test.select("query_id", "query"), "topics")
    if 2 in topic_sets:
        topics[2] = si.text_topics(spark, sf_dir)
    runs = []
    for system in systems:
        options: dict = {"clean_queries": system == "fine_tuned"}
        if system == "basic":
            doc_vectors = encode.encode_terms(cleaned, "text")
        else:
            weights, scorer = _fine_tuned(spark, sf_dir)
            doc_vectors = encode.encode_dense_terms(cleaned, "text", len(weights))
            options |= {"scorer": scorer, "encode": _dense(len(weights)), "query_weights": weights}
        options["doc_vectors"] = staged(doc_vectors, "vectors")
        for topic_set, wanted in topics.items():
            rows = retrieve.run_rows(retrieve.two_stage(wanted, answers, **options))
            runs.append(rows.select(F.lit(system).alias("system"), F.lit(topic_set).alias("topic_set"), "*"))
    return reduce(DataFrame.unionByName, runs)


def _dense(dim: int) -> retrieve.Encode:
    return lambda df, text: encode.encode_dense_terms(df, text, dim)


def _shown_runs(spark: SparkSession, runs: DataFrame) -> DataFrame:
    path = scratch_path(spark, "runs")
    writers.write_runs(runs, path)
    return spark.read.parquet(path).select(
        "system", "topic_set", "tag", "query_id", "doc_id", "rank", shown("score")
    )


def all_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The eight result sets, through the partitioned run table."""
    return _shown_runs(spark, _system_runs(spark, sf_dir))


def basic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The four result sets of the unfitted system."""
    return _shown_runs(spark, _system_runs(spark, sf_dir, ["basic"]))


# --- evaluation --------------------------------------------------------------------------------------


def filtered_qrels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluate.filter_grades(si.vector_qrels(spark, sf_dir))


def _vector_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluate.evaluate(si.vector_run(spark, sf_dir), si.vector_qrels(spark, sf_dir), depth=DEPTH)


def metrics_per_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _vector_metrics(spark, sf_dir).select("query_id", *[shown(m) for m in evaluate.METRICS])


def metrics_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    means = evaluate.mean_metrics(_vector_metrics(spark, sf_dir))
    return means.select(*[shown(m) for m in evaluate.METRICS])


def _metrics_by_system(spark: SparkSession, sf_dir: str, systems: Sequence[str]) -> DataFrame:
    """Both stages of the systems over the test topics, side by side."""
    runs = _system_runs(spark, sf_dir, systems, topic_sets=[1])
    runs = runs.withColumn("system", F.concat_ws("/", "system", "tag"))
    names = [f"{s}/{t}" for s in systems for t in (retrieve.BI_TAG, retrieve.CE_TAG)]
    qrels = pairs.split_qrels(_split_ids(spark, sf_dir), si.chat_qrels(spark, sf_dir), "test")
    per_query = evaluate.evaluate(runs, qrels, depth=DEPTH, systems=names)
    means = evaluate.mean_metrics(per_query, ["system"])
    return means.select("system", *[shown(m) for m in evaluate.METRICS])


def metrics_by_system(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _metrics_by_system(spark, sf_dir, ["basic", "fine_tuned"])


def metrics_basic(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _metrics_by_system(spark, sf_dir, ["basic"])


def evaluate_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored result sets of the unfitted system, measured; each query's place in its series beside the
    means, both as read back from the files."""
    path = scratch_path(spark, "measured")
    writers.write_runs(_system_runs(spark, sf_dir, ["basic"], topic_sets=[1]), f"{path}/runs")
    qrels = pairs.split_qrels(_split_ids(spark, sf_dir), si.chat_qrels(spark, sf_dir), "test")
    tags = [retrieve.BI_TAG, retrieve.CE_TAG]
    evaluate.evaluate_runs(spark, f"{path}/runs", qrels, f"{path}/out", ["basic"], tags, depth=DEPTH)
    parts = []
    for tag in tags:
        place = f"{path}/out/basic/{tag}"
        names = ", ".join(f"`{n}` double" for n in evaluate.METRICS.values())
        means = spark.read.schema(names).option("header", True).csv(f"{place}/metrics").toDF(*evaluate.METRICS).first()
        series = spark.read.schema("query_id string, p5 double, pos long").option("header", True).csv(f"{place}/series")
        columns = [F.lit(means[m]).alias(f"mean_{m}") for m in evaluate.METRICS]
        parts.append(series.select(F.lit("basic").alias("system"), F.lit(tag).alias("tag"), "*", *columns))
    rows = reduce(DataFrame.unionByName, parts)
    return rows.select("system", "tag", "query_id", shown("p5"), "pos", *[shown(f"mean_{m}") for m in evaluate.METRICS])


def ski_jump(spark: SparkSession, sf_dir: str) -> DataFrame:
    series = evaluate.ski_jump(_vector_metrics(spark, sf_dir))
    return series.select("query_id", shown("p5"), "pos")


def ski_jump_ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    ticks = evaluate.ski_jump_ticks(evaluate.ski_jump(_vector_metrics(spark, sf_dir)))
    return ticks.select("query_id", shown("p5"), "pos")


def ski_jump_jitter(spark: SparkSession, sf_dir: str) -> DataFrame:
    series = evaluate.ski_jump(_vector_metrics(spark, sf_dir), jitter_seed=42)
    return series.select("query_id", shown("p5"), "pos", shown("p5_jittered"))


# --- fitting -----------------------------------------------------------------------------------------


def val_mrr10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ranking score of the unfitted pair scorer on the validation queries."""
    scored = _scored_pairs(spark, sf_dir).where(F.col("split") == "val")
    return fit.ranking_score(pairs.ranked_choices(scored)).select(shown("mrr10"), "n_queries")


def _unit(name: str) -> Column:
    return normalize(F.col(name)).alias(name)


def _labelled_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Judged vector pairs (unit vectors, label, split)."""
    judged = si.vector_judgments(spark, sf_dir).withColumn("label", F.col("relevance").cast("double"))
    splits = assign_splits(judged.select("query_id").distinct()).select("query_id", "split")
    return staged(judged.join(splits, "query_id").select("query_id", "doc_id", _unit("query_vec"), _unit("doc_vec"), "label", "split"), "judged")


def tuned_bi_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = _labelled_vectors(spark, sf_dir)
    weights = fit.fit_bi_weights(
        placed.where(F.col("split") == "train"), placed.where(F.col("split") == "val")
    )
    queries = fit.weigh_queries(si.vectors(spark, sf_dir, "query_id").select("query_id", _unit("embedding")), weights)
    docs = si.vectors(spark, sf_dir, "doc_id").select("doc_id", _unit("embedding"))
    found = cosine_topk(queries, docs, normalize=False)
    return found.select("query_id", "doc_id", "rank", shown("score"))


def tuned_bi_optimality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The slope of the squared loss at the fitted weights, 0 in every dimension at the optimum."""
    train = _labelled_vectors(spark, sf_dir).where(F.col("split") == "train")
    weights = fit.fit_bi_weights(train, candidates=[0.0])
    return fit.bi_gradient(train, weights).select("dim", (F.round("gradient", 5) + F.lit(0.0)).alias("gradient"))


def bi_epoch_losses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both errors after each epoch of the descent, eight workers of two batches."""
    placed = _labelled_vectors(spark, sf_dir)
    train, val = (placed.where(F.col("split") == part) for part in ("train", "val"))
    _, history = fit.descend_bi_weights(train, val, workers=8, batches=2)
    return history.select("epoch", shown("mse"), shown("val_mse"))


def tuned_ce_optimality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The slope of the log loss at an unregularised logistic fit, 0 in every coefficient and the intercept."""
    train = _pair_features(spark, sf_dir).where(F.col("split") == "train")
    model = fit.reloaded(fit.pair_estimator("logistic", 0.0, 500).fit(fit.positive_labels(train)), spark)
    return fit.logistic_gradient(train, model).select("term", (F.round("gradient", 4) + F.lit(0.0)).alias("gradient"))


def tuned_tree_leaves(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For each boosted tree the rows that its leaves hold and how far a leaf lies from the mean of its rows."""
    train = _pair_features(spark, sf_dir).where(F.col("split") == "train")
    model = fit.reloaded(fit.pair_estimator("trees", 3, fit.EPOCHS).fit(fit.positive_labels(train)), spark)
    leaves = fit.tree_leaves(train, model)
    gap = F.round(F.max(F.abs(F.col("value") - F.col("expected"))), 6)
    return leaves.groupBy("tree").agg(F.sum("rows").alias("rows"), gap.alias("gap"))


def _fine_tuned(spark: SparkSession, sf_dir: str) -> tuple[list[float], rerank.Scorer]:
    """Both stages fitted on the training pairs and chosen on the validation pairs."""
    labelled = pairs.graded_labels(_split_pairs(spark, sf_dir), scale_labels=True)
    texts = staged(labelled.select(tx.clean_text(F.col("query")).alias("query"), tx.clean_text(F.col("doc")).alias("doc"), "label", "split"), "texts")
    train, val = (texts.where(F.col("split") == part) for part in ("train", "val"))
    weights = fit.fit_text_weights(train, val)
    features = _pair_features(spark, sf_dir, weights)
    model, _ = fit.fit_pair_scorer(
        features.where(F.col("split") == "train"), features.where(F.col("split") == "val")
    )
    return weights, rerank.fitted_scorer(model)


def _tuned_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    test = _split_pairs(spark, sf_dir).where(F.col("split") == "test")
    weights, scorer = _fine_tuned(spark, sf_dir)
    return retrieve.two_stage(
        test, si.chat_answers(spark, sf_dir), scorer, encode=_dense(len(weights)), clean_queries=True, query_weights=weights
    )


def tuned_ce_permutation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per query: the re-ranking orders exactly the first stage's documents, ranks without gaps."""
    found = _tuned_results(spark, sf_dir)
    return found.groupBy("query_id").agg(
        F.count("*").alias("n"),
        (F.count_distinct("doc_id") == F.count("*")).alias("distinct_docs"),
        ((F.count_distinct("bi_rank") == F.count("*")) & (F.max("bi_rank") == F.count("*"))).alias("bi_gapless"),
        ((F.count_distinct("ce_rank") == F.count("*")) & (F.max("ce_rank") == F.count("*"))).alias("ce_gapless"),
    )


def tuned_ce_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _tuned_results(spark, sf_dir).select("query_id", "doc_id", "bi_rank", "ce_rank", shown("ce_score"))


def two_stage_run_tuned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return retrieve.run_rows(_tuned_results(spark, sf_dir)).select(
        "query_id", "q0", "doc_id", "rank", shown("score"), "tag"
    )


QUERIES: dict[str, Query] = {
    "load_topics": load_topics,
    "load_answers": load_answers,
    "load_answers_array": load_answers_array,
    "parse_qrel_last": parse_qrel_last,
    "parse_qrel_set": parse_qrel_set,
    "scan_pairs": scan_pairs,
    "embed_cache_missing": embed_cache_missing,
    "read_run": read_run,
    "pairs_json_roundtrip": pairs_json_roundtrip,
    "run_tsv_lines": run_tsv_lines,
    "test_qrel_lines": test_qrel_lines,
    "metrics_wide": metrics_wide,
    "embed_docs": embed_docs,
    "embed_cache_dense": embed_cache_dense,
    "all_runs": all_runs,
    "basic_runs": basic_runs,
    "clean_text_docs": clean_text_docs,
    "clean_text_pages": clean_text_pages,
    "html_to_text": html_to_text,
    "strip_urls": strip_urls,
    "strip_special": strip_special,
    "scan_raw_topics": scan_raw_topics,
    "scan_raw_answers": scan_raw_answers,
    "compose_query": compose_query,
    "default_topic_id": default_topic_id,
    "resolve_topic_fields": resolve_topic_fields,
    "valid_topics": valid_topics,
    "judged_pairs": judged_pairs,
    "split_pairs": _split_pairs,
    "split_two_way": split_two_way,
    "split_counts": split_counts,
    "split_leakage": split_leakage,
    "binary_label_pairs": binary_label_pairs,
    "graded_label_pairs": graded_label_pairs,
    "dedup_last": dedup_last,
    "pos_neg_groups": pos_neg_groups,
    "explode_pos_neg": explode_pos_neg,
    "embed_queries": embed_queries,
    "normalize_vectors": normalize_vectors,
    "cosine_pairs": cosine_pairs,
    "cosine_mse": cosine_mse,
    "cosine_topk": cosine_top,
    "cosine_topk_blocked": cosine_topk_blocked,
    "sparse_cosine_topk": sparse_cosine_topk,
    "embed_docs_idf": embed_docs_idf,
    "idf_cosine_topk": idf_cosine_topk,
    "rerank_pairs": rerank_pairs,
    "rerank_topk": rerank_topk,
    "two_stage_run": two_stage_run,
    "filtered_qrels": filtered_qrels,
    "metrics_per_query": metrics_per_query,
    "metrics_mean": metrics_mean,
    "metrics_by_system": metrics_by_system,
    "metrics_basic": metrics_basic,
    "evaluate_runs": evaluate_runs,
    "ski_jump": ski_jump,
    "ski_jump_ticks": ski_jump_ticks,
    "ski_jump_jitter": ski_jump_jitter,
    "val_mrr10": val_mrr10,
    "tuned_bi_topk": tuned_bi_topk,
    "tuned_bi_optimality": tuned_bi_optimality,
    "bi_epoch_losses": bi_epoch_losses,
    "tuned_ce_optimality": tuned_ce_optimality,
    "tuned_tree_leaves": tuned_tree_leaves,
    "tuned_ce_topk": tuned_ce_topk,
    "tuned_ce_permutation": tuned_ce_permutation,
    "two_stage_run_tuned": two_stage_run_tuned,
}
