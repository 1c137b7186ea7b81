"""A text encoder fitted on a corpus: word counts weighted by how few documents hold the word."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rankweave.operators.encode import encode_terms, explode_terms
from rankweave.operators.joins import HOT_ROWS, salted_join

#: Stands for all terms that the corpus does not have; real terms are not negative.
UNSEEN = -1


def fit_idf(docs: DataFrame, text: str, key: str = "doc_id") -> DataFrame:
    """(term, df, idf) of a corpus with unique keys: ``df`` documents hold the term, and
    ``idf = ln((1 + documents) / (1 + df)) + 1``. One more row has the idf of unseen terms."""
    terms = explode_terms(encode_terms(docs.select(key, text), text), [key])
    counted = terms.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    documents = docs.count()
    unseen = docs.sparkSession.createDataFrame([(UNSEEN, 0)], "term long, df long")
    weight = F.ln(F.lit(1.0 + documents) / (F.lit(1.0) + F.col("df"))) + F.lit(1.0)
    return counted.unionByName(unseen).select("term", "df", weight.alias("idf"))


def save_idf(fitted: DataFrame, path: str, model_id: str) -> None:
    """Keep a fitted encoder among others at ``path``; one of the same name is replaced."""
    fitted.select("term", "df", "idf").write.mode("overwrite").parquet(f"{path}/model_id={model_id}")


def load_idf(spark: SparkSession, path: str, model_id: str) -> DataFrame:
    return spark.read.schema("term long, df long, idf double").parquet(f"{path}/model_id={model_id}")


def _hot_terms(fitted: DataFrame) -> DataFrame:
    """(term, _salts) of the terms of very many documents, which the fitted counts already tell.

    At most four for each shuffle partition, as their counts are above a quarter of its share.
    """
    partitions = int(fitted.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    share = fitted.select(F.sum("df") / (4 * partitions)).scalar()
    limit = F.greatest(F.lit(float(HOT_ROWS)), share)
    return F.broadcast(fitted.where(F.col("df") > limit).select("term", F.ceil(F.col("df") / limit).alias("_salts")))


def encode_idf(texts: DataFrame, text: str, fitted: DataFrame, key: str = "doc_id") -> DataFrame:
    """(key, terms, tf): counts times idf, scaled to length one, the terms ascending. Keys are unique.

    A text without words has empty arrays. Terms of very many documents are dealt out over salts.
    """
    unseen = fitted.where(F.col("term") == UNSEEN).first()
    if unseen is None:
        raise ValueError("the encoder has no row for unseen terms")
    long = explode_terms(encode_terms(texts.select(key, text), text), [key])
    known = fitted.where(F.col("term") != UNSEEN).select("term", "idf")
    weighed = salted_join(long, known, "term", key, "left", hot=_hot_terms(fitted))
    weight = F.col("tf") * F.coalesce(F.col("idf"), F.lit(unseen["idf"]))
    rows = weighed.select(key, F.struct("term", weight.alias("weight")).alias("_t"))
    # The terms of one document are as many as its different words.
    gathered = rows.groupBy(key).agg(F.array_sort(F.collect_list("_t")).alias("_t"), F.sqrt(F.sum(F.col("_t.weight") * F.col("_t.weight"))).alias("_norm"))
    whole = texts.select(key).join(gathered, key, "left")
    return whole.select(
        key,
        F.coalesce(F.col("_t.term"), F.array().cast("array<long>")).alias("terms"),
        F.coalesce(F.transform("_t", lambda t: t["weight"] / F.col("_norm")), F.array().cast("array<double>")).alias("tf"),
    )
