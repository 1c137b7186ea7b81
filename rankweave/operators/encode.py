"""Encoders: text to vectors, and the table that keeps them."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rankweave.functions.terms import dense_terms, term_vector
from rankweave.operators.vector_table import VectorTable

ENCODE_BATCH = 32  # fixed value: texts per model call

Encoder = Callable[[list[str]], np.ndarray]


def encode_terms(df: DataFrame, text: str, buckets: int | None = None) -> DataFrame:
    """Sparse hashed term vectors (``terms``, ``tf``) in place of ``text``."""
    others = [c for c in df.columns if c != text]
    encoded = df.select(*others, term_vector(F.col(text), buckets).alias("_vector"))
    return encoded.select(*others, "_vector.terms", "_vector.tf")


def encode_dense_terms(df: DataFrame, text: str, dim: int) -> DataFrame:
    """Unit-length dense hashed term vectors (``embedding``) in place of ``text``."""
    others = [c for c in df.columns if c != text]
    return df.select(*others, dense_terms(F.col(text), dim).alias("embedding"))


def encode_model(
    df: DataFrame, text: str, make_encoder: Callable[[], Encoder], batch_size: int = ENCODE_BATCH
) -> DataFrame:
    """``embedding`` from a user's model in place of ``text``.

    ``make_encoder`` runs once per task and returns a function from a list of texts to a matrix.
    """
    kept = [f for f in df.schema.fields if f.name != text]
    schema = T.StructType([*kept, T.StructField("embedding", T.ArrayType(T.FloatType()))])
    names = [f.name for f in kept]

    def encode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder = make_encoder()
        for rows in batches:
            texts = rows[text].fillna("").tolist()
            vectors: list[np.ndarray] = []
            for start in range(0, len(texts), batch_size):
                vectors.extend(np.asarray(encoder(texts[start : start + batch_size]), dtype=np.float32))
            yield rows[names].assign(embedding=vectors)

    return df.mapInPandas(encode, schema)


def with_text_hash(docs: DataFrame) -> DataFrame:
    return docs.withColumn("text_hash", F.md5("text"))


def read_cache(spark: SparkSession, path: str, model_id: str) -> DataFrame:
    """The stored term vectors of one model: doc_id, text_hash, terms, tf."""
    rows = VectorTable(spark, path, model_id).rows()
    if rows is None:
        raise ValueError(f"no vectors of {model_id!r} below {path}")
    return rows.select("doc_id", "text_hash", "terms", "tf")


def not_cached(docs: DataFrame, cached: DataFrame) -> DataFrame:
    """Documents that have no vector yet, or whose text changed since."""
    return with_text_hash(docs).join(
        cached.select("doc_id", "text_hash"), ["doc_id", "text_hash"], "left_anti"
    )


def _stored_terms(docs: DataFrame) -> DataFrame:
    return encode_terms(docs, "text")


def append_cache(docs: DataFrame, path: str, model_id: str) -> None:
    """Add the term vectors of ``docs`` to the table of the model."""
    VectorTable(docs.sparkSession, path, model_id).update(docs.select("doc_id", "text"), _stored_terms)


def cached_vectors(docs: DataFrame, path: str, model_id: str) -> DataFrame:
    """(doc_id, terms, tf) of all ``docs``: only what the table at ``path`` lacks is encoded and appended.

    ``docs`` has unique ids. The table is read here, at the time of the call, and may not exist yet.
    """
    found = VectorTable(docs.sparkSession, path, model_id).vectors(docs.select("doc_id", "text"), _stored_terms)
    return found.select("doc_id", "terms", "tf")


def explode_terms(vectors: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Long form: one row per key and term."""
    return vectors.select(*keys, F.explode(F.arrays_zip("terms", "tf")).alias("_t")).select(
        *keys, F.col("_t.terms").alias("term"), F.col("_t.tf").alias("tf")
    )
