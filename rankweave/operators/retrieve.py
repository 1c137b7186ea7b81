"""Two-stage retrieval: cosine top-k, then the pair scorer over those candidates."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankweave.functions.text import clean_text
from rankweave.operators.encode import encode_terms
from rankweave.operators.fit import weigh_queries
from rankweave.operators.rerank import (
    MakePairModel,
    Scorer,
    candidate_features,
    candidate_texts,
    model_scores,
    rerank,
    weighted_scorer,
)
from rankweave.operators.similarity import DEPTH, cosine_topk
from rankweave.session import staged

# Tags of the two stages.
BI_TAG = "bi-encoder"
CE_TAG = "cross-encoder"

Encode = Callable[[DataFrame, str], DataFrame]


def prepare_topics(topics: DataFrame, clean_queries: bool) -> DataFrame:
    """Valid topics, one row per query id, cleaned on demand.

    Labelled pairs repeat their query once per document; it is searched once. Of differing valid texts
    under one id the smallest is taken.
    """
    chosen = topics.select("query_id", "query")
    if clean_queries:
        chosen = chosen.withColumn("query", clean_text(F.col("query")))
    valid = chosen.where((F.col("query_id") != "") & (F.col("query") != ""))
    return valid.groupBy("query_id").agg(F.min("query").alias("query"))


def clean_answers(answers: DataFrame) -> DataFrame:
    return answers.select("doc_id", clean_text(F.col("text")).alias("text"))


def two_stage(
    topics: DataFrame,
    answers: DataFrame,
    scorer: Scorer | None = None,
    encode: Encode = encode_terms,
    doc_vectors: DataFrame | None = None,
    k: int = DEPTH,
    clean_queries: bool = False,
    pair_model: MakePairModel | None = None,
    stage: bool = True,
    query_weights: Sequence[float] | None = None,
) -> DataFrame:
    """(query_id, doc_id, bi_rank, bi_score, ce_rank, ce_score): both rankings of one search.

    ``answers`` are raw and get cleaned here. ``doc_vectors`` are their stored vectors, else they are
    encoded here. ``pair_model`` makes a model that scores the texts, in place of ``scorer``, which
    scores their lexical features. ``query_weights`` are those of a fitted first stage: ``encode`` and
    ``doc_vectors`` are then dense and of unit length. With ``stage`` the first-stage result is written once, since its rows are needed both
    to pick the documents to tokenise and to rank them.
    """
    topics = prepare_topics(topics, clean_queries)
    vectors = doc_vectors if doc_vectors is not None else encode(clean_answers(answers), "text")
    queries = encode(topics, "query")
    if query_weights is not None:
        queries = weigh_queries(queries, query_weights)
    found = cosine_topk(queries, vectors, k, normalize=query_weights is None)
    found = found.select("query_id", "doc_id", F.col("rank").alias("bi_rank"), F.col("score").alias("bi_score"))
    if stage:
        found = staged(found, "candidates")
    if pair_model is not None:
        scored = model_scores(candidate_texts(found, topics, answers, clean_docs=True), pair_model)
    else:
        scored = (scorer or weighted_scorer())(candidate_features(found, topics, answers, clean_docs=True))
    ranked = rerank(scored, k)
    return ranked.select("query_id", "doc_id", "bi_rank", "bi_score", "ce_rank", "ce_score")


def run_rows(results: DataFrame) -> DataFrame:
    """Both rankings as run rows (query_id, q0, doc_id, rank, score, tag), from one pass over ``results``."""

    def entry(tag: str, rank: str, score: str):
        return F.struct(
            F.col(rank).alias("rank"), F.col(score).alias("score"), F.lit(tag).alias("tag")
        )

    others = [c for c in results.columns if c not in ("query_id", "doc_id", "bi_rank", "bi_score", "ce_rank", "ce_score")]
    both = F.array(entry(BI_TAG, "bi_rank", "bi_score"), entry(CE_TAG, "ce_rank", "ce_score"))
    return results.select(*others, "query_id", "doc_id", F.explode(both).alias("_r")).select(
        *others, "query_id", F.lit("Q0").alias("q0"), "doc_id", "_r.rank", "_r.score", "_r.tag"
    )
