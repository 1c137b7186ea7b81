"""Second stage: score (query, document) pairs and order the first-stage candidates again."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rankweave.functions.terms import term_vector, word_sets
from rankweave.functions.text import clean_text
from rankweave.functions.vectors import SCORE_DECIMALS, term_cosine, weighted_dot
from rankweave.operators.encode import encode_dense_terms
from rankweave.operators.joins import hot_keys, salted_join, with_copies, with_salt
from rankweave.operators.ranking import top_k
from rankweave.session import staged

FEATURES = ("coverage", "jaccard", "bigram_coverage", "length_ratio", "bi_score")
LEXICAL_WEIGHTS = {
    "coverage": 0.4,
    "jaccard": 0.2,
    "bigram_coverage": 0.3,
    "length_ratio": 0.05,
    "bi_score": 0.05,
}

Scorer = Callable[[DataFrame], DataFrame]
MakePairModel = Callable[[], Callable[[list[tuple[str, str]]], np.ndarray]]


def with_word_sets(texts: DataFrame, text: str, prefix: str) -> DataFrame:
    """Replace ``text`` by its distinct words and word pairs, once per text rather than once per pair."""
    others = [c for c in texts.columns if c != text]
    sets = texts.select(*others, word_sets(F.col(text)).alias("_sets"))
    return sets.select(
        *others,
        F.col("_sets.words").alias(f"{prefix}_words"),
        F.col("_sets.bigrams").alias(f"{prefix}_bigrams"),
    )


def _share(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part / whole).otherwise(F.lit(0.0))


def pair_features(pairs: DataFrame) -> DataFrame:
    """Lexical features of a pair from ``q_words d_words q_bigrams d_bigrams bi_score``; drops the sets."""
    sets = ("q_words", "d_words", "q_bigrams", "d_bigrams")
    rest = [c for c in pairs.columns if c not in sets]
    counted = pairs.select(
        *rest,
        F.size("q_words").alias("_q"),
        F.size("d_words").alias("_d"),
        F.size(F.array_intersect("q_words", "d_words")).alias("_both"),
        F.size("q_bigrams").alias("_qb"),
        F.size(F.array_intersect("q_bigrams", "d_bigrams")).alias("_both_b"),
    )
    q, d, both = F.col("_q"), F.col("_d"), F.col("_both")
    return counted.select(
        *rest,
        _share(both, q).alias("coverage"),
        _share(both, q + d - both).alias("jaccard"),
        _share(F.col("_both_b"), F.col("_qb")).alias("bigram_coverage"),
        _share(F.least(q, d), F.greatest(q, d)).alias("length_ratio"),
    )


def weighted_scorer(weights: Mapping[str, float] = LEXICAL_WEIGHTS) -> Scorer:
    """A fixed linear score of the features."""

    def score(features: DataFrame) -> DataFrame:
        total = F.lit(0.0)
        for name in FEATURES:
            total = total + F.lit(float(weights.get(name, 0.0))) * F.col(name)
        return features.withColumn("ce_score", total)

    return score


def fitted_scorer(model) -> Scorer:
    """The probability of relevance under a fitted pipeline."""
    from pyspark.ml.functions import vector_to_array

    def score(features: DataFrame) -> DataFrame:
        kept = features.columns
        likely = F.get(vector_to_array("probability"), 1)
        return model.transform(features).select(*kept, likely.alias("ce_score"))

    return score


def model_scores(pairs: DataFrame, make_scorer: MakePairModel) -> DataFrame:
    """``ce_score`` of (query, doc) texts from a user's model, loaded once per task."""
    kept = pairs.schema.fields
    schema = T.StructType([*kept, T.StructField("ce_score", T.DoubleType())])

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        scorer = make_scorer()
        for rows in batches:
            texts = list(zip(rows["query"], rows["doc"], strict=True))
            yield rows.assign(ce_score=np.asarray(scorer(texts), dtype=np.float64))

    return pairs.mapInPandas(score, schema)


def candidate_features(
    candidates: DataFrame, topics: DataFrame, answers: DataFrame, clean_docs: bool = False
) -> DataFrame:
    """Features of (query_id, doc_id, bi_score) candidates, the texts joined after the top-k.

    Only documents that are candidates are cleaned and tokenised: the semi-join comes first, and its
    exchange also serves the join with the candidates. A document that is a candidate of very many
    queries is copied to several salts, so that no task meets all of its pairs.
    """
    place = ["doc_id", "_salt"]
    hot = hot_keys(candidates.select("doc_id"), "doc_id")
    salted = with_salt(candidates, hot, "doc_id", "query_id")
    wanted = with_copies(answers.select("doc_id", "text"), hot, "doc_id").join(
        salted.select(*place).distinct(), place, "left_semi"
    )
    if clean_docs:
        wanted = wanted.withColumn("text", clean_text(F.col("text")))
    doc_sets = with_word_sets(wanted, "text", "d")
    query_sets = with_word_sets(topics.select("query_id", "query"), "query", "q")
    return pair_features(salted.join(query_sets, "query_id").join(doc_sets, place).drop("_salt"))


def candidate_texts(
    candidates: DataFrame, topics: DataFrame, answers: DataFrame, clean_docs: bool = False
) -> DataFrame:
    """The candidates with their ``query`` and ``doc`` texts, for a model that reads both."""
    hot = hot_keys(candidates.select("doc_id"), "doc_id")
    salted = with_salt(candidates, hot, "doc_id", "query_id")
    docs = with_copies(answers.select("doc_id", F.col("text").alias("doc")), hot, "doc_id")
    texts = salted.join(topics.select("query_id", "query"), "query_id").join(docs, ["doc_id", "_salt"])
    if clean_docs:
        texts = texts.withColumn("doc", clean_text(F.col("doc")))
    return texts.drop("_salt")


def with_bi_scores(
    pairs: DataFrame, topics: DataFrame, answers: DataFrame, weights: Sequence[float] | None = None
) -> DataFrame:
    """Add ``bi_score``, the first-stage score, to (query_id, doc_id) pairs over texts cleaned before.

    Without ``weights`` it is the cosine of the term vectors, with them the fitted product of dense ones,
    as the search computes it, so that a scorer is trained on what it is served.
    """

    def vectors(texts: DataFrame, key: str, text: str, name: str) -> DataFrame:
        picked = texts.select(key, text)
        if weights is None:
            return picked.select(key, term_vector(F.col(text)).alias(name))
        return encode_dense_terms(picked, text, len(weights)).withColumnRenamed("embedding", name)

    queries, docs = vectors(topics, "query_id", "query", "_q"), vectors(answers, "doc_id", "text", "_d")
    ids = staged(pairs, "judged")
    hot_queries = hot_keys(ids.select("query_id"), "query_id")
    with_docs = salted_join(ids, docs, "doc_id", "query_id")
    joined = salted_join(with_docs, queries, "query_id", "doc_id", hot=hot_queries)
    left, right = F.col("_q"), F.col("_d")
    score = term_cosine(left, right) if weights is None else weighted_dot(left, right, weights)
    return joined.select(*pairs.columns, F.round(score, SCORE_DECIMALS).alias("bi_score"))


def rerank(scored: DataFrame, k: int) -> DataFrame:
    """``ce_rank`` by the second score; equal scores keep the first-stage order."""
    return top_k(scored, ["query_id"], [F.col("ce_score").desc(), F.col("bi_rank").asc()], k, "ce_rank")
