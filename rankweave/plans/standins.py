"""Topics, answers, judgments and vectors drawn from the given tables.

Three data sets, each from whole tables:

* chat: user turns are topics, assistant turns are answers, and a user turn is judged against the turns
  at fixed distances from it in the same conversation (so judgments grow linearly with the table);
* text: benchmark passages are topics, documents are answers;
* vectors: every embedding is a query and a document, judged against the vectors at the next ids.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rankweave.operators.pairs import compose_topics
from rankweave.operators.ranking import top_k
from rankweave.operators.similarity import DEPTH, cosine_topk

# (distance in turns, grade); distance 3 is judged twice with different grades.
CHAT_JUDGMENTS = ((1, 2), (3, 1), (3, 2), (5, 1), (-1, 0))
VECTOR_NEIGHBOURS = 20
VECTOR_LABELS = 10


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", "text")


def pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages")


def _turn_id(turn: Column) -> Column:
    return F.concat_ws("-", F.col("conv_id").cast("string"), turn.cast("string"))


def chat_topics_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").where(F.col("role") == "user")
    return turns.select(
        _turn_id(F.col("turn")).alias("Id"), F.col("text").alias("Title"), F.lit(None).cast("string").alias("Body")
    )


def chat_topics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compose_topics(chat_topics_raw(spark, sf_dir))


def chat_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").where(F.col("role") == "assistant")
    return turns.select(_turn_id(F.col("turn")).alias("doc_id"), "text")


def chat_qrels(spark: SparkSession, sf_dir: str, all_roles: bool = False) -> DataFrame:
    """All distinct (query_id, doc_id, relevance); some documents do not exist.

    ``all_roles`` judges every turn, so some queries have no topic either.
    """
    turns = table(spark, sf_dir, "conversations")
    if not all_roles:
        turns = turns.where(F.col("role") == "user")
    judged = F.array(*[F.struct(F.lit(d).alias("d"), F.lit(g).alias("g")) for d, g in CHAT_JUDGMENTS])
    return turns.select("conv_id", "turn", F.explode(judged).alias("_j")).select(
        _turn_id(F.col("turn")).alias("query_id"),
        _turn_id(F.col("turn") + F.col("_j.d")).alias("doc_id"),
        F.col("_j.g").alias("relevance"),
    )


def text_topics(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = table(spark, sf_dir, "benchmark")
    return items.select(F.col("item_id").cast("string").alias("query_id"), F.col("text").alias("query"))


def text_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return documents(spark, sf_dir).select(F.col("doc_id").cast("string").alias("doc_id"), "text")


def page_topics_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages(spark, sf_dir).select(
        F.col("page_id").cast("string").alias("Id"), F.col("url").alias("Title"), F.col("html").alias("Body")
    )


def vectors(spark: SparkSession, sf_dir: str, id_name: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    return rows.select(F.col("vec_id").cast("string").alias(id_name), "embedding")


def vector_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector's 100 nearest others: one more is searched and the vector itself left out."""
    found = cosine_topk(vectors(spark, sf_dir, "query_id"), vectors(spark, sf_dir, "doc_id"), DEPTH + 1)
    others = found.where(F.col("query_id") != F.col("doc_id")).drop("rank")
    return top_k(others, ["query_id"], [F.col("score").desc(), F.col("doc_id").asc()], DEPTH)


def vector_judgments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(query_id, doc_id, relevance, query_vec, doc_vec) for the next ids; graded by the labels."""
    rows = table(spark, sf_dir, "embeddings")
    near = F.explode(F.sequence(F.lit(1), F.lit(VECTOR_NEIGHBOURS)))
    left = rows.select(
        F.col("vec_id").alias("q"), F.col("label").alias("q_label"), F.col("embedding").alias("query_vec"), near.alias("_n")
    ).withColumn("d", F.col("q") + F.col("_n"))
    right = rows.select(F.col("vec_id").alias("d"), F.col("label").alias("d_label"), F.col("embedding").alias("doc_vec"))
    grade = (
        F.when(F.col("d_label") == F.col("q_label"), 2)
        .when(F.col("d_label") == (F.col("q_label") + 1) % VECTOR_LABELS, 1)
        .otherwise(0)
    )
    return left.join(right, "d").select(
        F.col("q").cast("string").alias("query_id"),
        F.col("d").cast("string").alias("doc_id"),
        grade.alias("relevance"),
        "query_vec",
        "doc_vec",
    )


def vector_qrels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_judgments(spark, sf_dir).select("query_id", "doc_id", "relevance")
