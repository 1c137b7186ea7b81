"""The stages of the corpus pipeline. Each takes (spark, docs, sf_dir) and works on all rows of ``docs``."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rankweave.llm import lines, packing, pii, quality, simhash
from rankweave.session import staged

#: What every stage but the last hands on.
DOCUMENTS = ("doc_id", "text", "lang", "source", "n_chars")


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that the rules reject, null and empty ones among them; repeated rows fare alike."""
    return quality.drop_low_quality(docs).select(*DOCUMENTS)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Deletes later copies of repeated line runs; a document that loses all its lines stays, empty."""
    cut = lines.dedup_lines(docs)
    counted = F.when(F.col("deleted_lines") > 0, F.char_length("text").cast("long")).otherwise(F.col("n_chars"))
    return cut.withColumn("n_chars", counted).select(*DOCUMENTS)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the smallest id of all whose fingerprints (three-word shingles) differ in at
    most three bits, link by link."""
    return simhash.keep_one_of_each(docs).select(*DOCUMENTS)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces personal data by the name of its kind."""
    changed = pii.redact(docs.withColumn("_before", F.col("text")))
    counted = F.when(F.col("text") != F.col("_before"), F.char_length("text").cast("long")).otherwise(F.col("n_chars"))
    return changed.withColumn("n_chars", counted).select(*DOCUMENTS)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces and their places in sequences of 4096: of a null or empty text the end id, of repeated rows
    the pieces of each."""
    return packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("simhash_near_dedup", simhash_near_dedup),
    ("personal_data", personal_data),
    ("best_fit_packing", best_fit_packing),
]

#: The label model and the tokenizer are not expressible in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The result of the last stage on ``documents``, each stage written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), name)
    return docs
