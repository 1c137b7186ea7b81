"""Duplicate handling."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def keep_last(df: DataFrame, keys: Sequence[str], position: Column) -> DataFrame:
    """One row per key: the one with the highest ``position``, which no two rows of a key share.

    Rows are read once, so a position that comes from the scan means the same row throughout. A task sends
    one row for each of its keys.
    """
    others = [c for c in df.columns if c not in keys]
    if not others:
        return df.distinct()
    last = df.groupBy(*keys).agg(F.max_by(F.struct(*others), position).alias("_last"))
    return last.select(*[f"_last.{c}" if c in others else c for c in df.columns])


def keep_highest(qrels: DataFrame) -> DataFrame:
    """One judgment per (query, document): the highest grade."""
    return qrels.groupBy("query_id", "doc_id").agg(F.max("relevance").alias("relevance"))
