"""Labelled query-document pairs from topics, answers and judgments.

The joins below are many judgments to one topic or one answer. The judgments of a topic or document with a
huge share of them are dealt out over salts, to which its one row is copied; nothing is collected per query.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rankweave.functions.text import clean_text, compose_query, filled
from rankweave.operators.dedup import keep_highest
from rankweave.operators.joins import hot_keys, salted_join
from rankweave.operators.ranking import exact_rank
from rankweave.operators.split import THREE_WAY, TWO_WAY, assign_splits
from rankweave.session import staged


def compose_topics(raw_topics: DataFrame, markers: bool = True) -> DataFrame:
    """(query_id, query) from raw topics: title and body text in one query."""
    return raw_topics.select(
        F.col("Id").alias("query_id"), compose_query(F.col("Title"), F.col("Body"), markers).alias("query")
    )


def default_topic_ids(raw_topics: DataFrame, row_key: Column, seed: int = 42) -> DataFrame:
    """Fill a missing ``Id`` with ``topic_<position>``, the position from 0 in the seeded order.

    ``row_key`` identifies a row. Only it takes part in the ranking; the texts are joined afterwards.
    """
    keyed = raw_topics.withColumn("_row", row_key.cast("string"))
    hashed = keyed.select("_row", F.md5(F.concat_ws("|", F.lit(str(seed)), F.col("_row"))).alias("_key"))
    placed = exact_rank(hashed, [F.col("_key"), F.col("_row")])
    default = F.concat(F.lit("topic_"), (F.col("pos") - 1).cast("string"))
    return (
        keyed.join(placed.select("_row", "pos"), "_row")
        .withColumn("Id", F.coalesce("Id", default))
        .select(*raw_topics.columns)
    )


def resolve_topics(topics: DataFrame, clean_queries: bool) -> DataFrame:
    """(query_id, query) from topics that carry query_id/query or Id/Title.

    An empty ``query`` or ``query_id`` falls back to the other name. With ``clean_queries`` only
    ``query`` is cleaned where it is present, else ``Title``.
    """
    query, title = F.col("query"), F.col("Title")
    if clean_queries:
        query, title = (
            F.when(query.isNotNull(), clean_text(query)),
            F.when(query.isNull() & title.isNotNull(), clean_text(title)).otherwise(title),
        )
    return topics.select(
        filled(F.col("query_id"), F.col("Id")).alias("query_id"), filled(query, title).alias("query")
    )


def valid_topics(topics: DataFrame) -> DataFrame:
    """Topics with an id and a query."""
    return topics.where((F.col("query_id") != "") & (F.col("query") != ""))


def judged_ids(qrels: DataFrame, topics: DataFrame, answers: DataFrame) -> DataFrame:
    """Judgments whose topic and document both exist; no text is read for this."""
    known = salted_join(qrels, answers.select("doc_id"), "doc_id", "query_id", "left_semi")
    return salted_join(known, topics.select("query_id"), "query_id", "doc_id", "left_semi", hot=hot_keys(qrels.select("query_id"), "query_id"))


def with_texts(judged: DataFrame, topics: DataFrame, answers: DataFrame) -> DataFrame:
    judged = staged(judged, "judged-ids")  # read for its hot keys, and then twice joined
    pairs = salted_join(judged, topics.select("query_id", "query"), "query_id", "doc_id")
    docs = answers.select("doc_id", F.col("text").alias("doc"))
    pairs = salted_join(pairs, docs, "doc_id", "query_id", hot=hot_keys(judged.select("doc_id"), "doc_id"))
    others = [c for c in judged.columns if c not in ("query_id", "doc_id", "relevance")]
    return pairs.select("query", "query_id", "doc", "doc_id", F.col("relevance").alias("score"), *others)


def judged_pairs(topics: DataFrame, qrels: DataFrame, answers: DataFrame) -> DataFrame:
    """(query, query_id, doc, doc_id, score) for every judgment with a known topic and document."""
    return with_texts(judged_ids(qrels, topics, answers), topics, answers)


def split_ids(
    topics: DataFrame,
    qrels: DataFrame,
    answers: DataFrame,
    parts: Sequence[tuple[str, float | None]] = THREE_WAY,
    seed: int = 42,
) -> DataFrame:
    """(query_id, doc_id, relevance, split): whole queries go to one split; all on ids."""
    judged = judged_ids(qrels, topics, answers)
    splits = assign_splits(judged.select("query_id").distinct(), parts, seed)
    return judged.join(splits.select("query_id", "split"), "query_id")


def split_pairs(
    topics: DataFrame,
    qrels: DataFrame,
    answers: DataFrame,
    parts: Sequence[tuple[str, float | None]] = THREE_WAY,
    seed: int = 42,
) -> DataFrame:
    """Labelled pairs with their split. Splitting runs on ids; the texts are joined last."""
    return with_texts(split_ids(topics, qrels, answers, parts, seed), topics, answers)


def split_qrels(split: DataFrame, qrels: DataFrame, name: str = "test") -> DataFrame:
    """All judgments of the queries of one split, documents outside the corpus included.

    Of differing grades for one document the highest is kept.
    """
    chosen = split.where(F.col("split") == name).select("query_id").distinct()
    return keep_highest(salted_join(qrels, chosen, "query_id", "doc_id", "left_semi"))


def binary_label(relevance: Column) -> Column:
    return (relevance > 0).cast("double")


def graded_labels(pairs: DataFrame, scale_labels: bool = False) -> DataFrame:
    """``label`` as the grade; ``scale_labels`` divides by the highest grade, to fit a cosine's range."""
    label = F.col("score").cast("double")
    if scale_labels:
        top = pairs.select(F.max("score").cast("double")).scalar()
        label = F.when(top > 0, label / top).otherwise(F.lit(0.0))
    return pairs.withColumn("label", label)


def training_samples(
    topics: DataFrame, answers: DataFrame, qrels: DataFrame, ratio: float = 0.9, seed: int = 42
) -> DataFrame:
    """(query_id, doc_id, query, doc, label, split): binary labels, train/val by judged query.

    Queries without a topic stay, with an empty text.
    """
    parts = ((TWO_WAY[0][0], ratio), TWO_WAY[1])
    splits = assign_splits(qrels.select("query_id").distinct(), parts, seed).select("query_id", "split")
    hot_queries, hot_docs = (hot_keys(qrels.select(k), k) for k in ("query_id", "doc_id"))
    labelled = salted_join(qrels, splits, "query_id", "doc_id", hot=hot_queries)
    labelled = salted_join(labelled, topics.select("query_id", "query"), "query_id", "doc_id", "left", hot=hot_queries)
    docs = answers.select("doc_id", F.col("text").alias("doc"))
    return salted_join(labelled, docs, "doc_id", "query_id", hot=hot_docs).select(
        "query_id",
        "doc_id",
        F.coalesce("query", F.lit("")).alias("query"),
        "doc",
        binary_label(F.col("relevance")).alias("label"),
        "split",
    )


def ranked_choices(pairs: DataFrame) -> DataFrame:
    """Pairs of the queries that have a positive (score >= 1) and a negative (score = 0).

    One row per document, flagged ``positive``, with the query's ``n_positive`` and ``n_negative``; a
    query of any size stays one group, since nothing is collected into arrays. Negative scores belong to
    neither side and are left out.
    """
    flagged = pairs.where(F.col("score") >= 0).withColumn("positive", F.col("score") >= 1)
    counts = flagged.groupBy("query_id").agg(
        F.count_if("positive").alias("n_positive"), F.count_if(~F.col("positive")).alias("n_negative")
    )
    both = counts.where((F.col("n_positive") > 0) & (F.col("n_negative") > 0))
    return salted_join(flagged, both, "query_id", "doc_id")


def require_choices(choices: DataFrame) -> DataFrame:
    """``choices`` unchanged, or an error where no query is left to validate on."""
    if choices.isEmpty():
        raise ValueError("no query has both a positive and a negative document")
    return choices
