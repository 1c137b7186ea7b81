"""Sharding by vector bin packing: bytes, tokens and rows are balanced together."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rankweave.llm.ranks import spread_rank
from rankweave.session import staged

#: Groups below ``1 / (shards * FINE)`` of every total are packed by hash bucket, larger ones singly.
FINE = 64
BUCKETS = 16_384

WORD = r"[^\x20\x09-\x0D]+"


def pack_vectors(items: np.ndarray, shards: int) -> np.ndarray:
    """A shard for each row of ``items``, largest first, where its dot product with the capacity left
    is highest; of equal ones the first. Capacity is an equal share of each column's sum."""
    share = np.maximum(items.sum(axis=0) / shards, 1e-12)
    scaled = items / share
    left = np.ones((shards, items.shape[1]))
    placed = np.zeros(len(items), dtype=int)
    for i in np.argsort(-scaled.max(axis=1), kind="stable"):
        placed[i] = best = int(np.argmax(left @ scaled[i]))
        left[best] -= scaled[i]
    return placed


def _measured(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    body = F.coalesce(F.col(text), F.lit(""))
    return docs.select(
        F.col(doc_id).alias("doc_id"),
        (F.octet_length(body) + 1).cast("long").alias("size"),
        F.crc32(body.cast("binary")).alias("text_crc32"),
        F.regexp_count(body, F.lit(WORD)).cast("long").alias("n_tokens"),
        F.xxhash64(body).alias("_group"),
    )


VECTOR = ("_bytes", "_tokens", "_rows")


def _vector() -> list[Column]:
    return [F.sum("size").alias("_bytes"), F.sum("n_tokens").alias("_tokens"), F.count(F.lit(1)).alias("_rows")]


def shard(docs: DataFrame, shards: int = 16, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, size, text_crc32, n_tokens, shard, slot.

    Rows of equal texts form a group and share a shard, unless the group exceeds a whole shard's share in
    bytes, tokens or rows; it is then dealt out by document id in parts of ``1 / FINE`` of a share. Null
    and empty texts are one group of size 1 each row. ``slot`` counts up from 0 in each shard.

    The driver places vectors, not documents: one per hash bucket of small groups, one per larger group
    or part. A larger group holds at least ``1 / (shards * FINE)`` of some total, so there are at most
    ``3 * shards * FINE`` of them besides the ``BUCKETS``, however many documents there are.
    """
    spark = docs.sparkSession
    rows = staged(_measured(docs, doc_id, text), "shard-sizes")
    groups = rows.groupBy("_group").agg(*_vector())
    totals = groups.agg(*[F.sum(c).alias(c) for c in VECTOR]).first()
    if not totals["_rows"]:
        return rows.select("doc_id", "size", "text_crc32", "n_tokens", F.lit(0).alias("shard"), F.lit(0).cast("long").alias("slot"))
    part = {c: max(1, totals[c]) / (shards * FINE) for c in VECTOR}
    share = F.greatest(*[F.col(c) / part[c] for c in VECTOR])
    large = groups.where(share > 1).select("_group", F.when(share > FINE, F.ceil(share)).otherwise(1).alias("_parts"))
    large_parts, first = [], BUCKETS
    for row in sorted(large.collect()):
        large_parts.append((row["_group"], int(row["_parts"]), first))
        first += int(row["_parts"])
    named = F.broadcast(spark.createDataFrame(large_parts, "_group long, _parts long, _first long"))
    salt = F.xxhash64("doc_id", "_group")
    with_item = rows.join(named, "_group", "left").withColumn(
        "_item", F.coalesce(F.col("_first") + F.pmod(salt, F.col("_parts")), F.pmod(F.xxhash64("_group"), F.lit(BUCKETS)))
    )
    items = sorted(with_item.groupBy("_item").agg(*_vector()).collect(), key=lambda r: r["_item"])
    placed = pack_vectors(np.array([[r[c] for c in VECTOR] for r in items], dtype=float), shards)
    table = [(r["_item"], int(s)) for r, s in zip(items, placed)]
    homes = F.broadcast(spark.createDataFrame(table, "_item long, shard int"))
    homed = with_item.join(homes, "_item").select("doc_id", "size", "text_crc32", "n_tokens", "shard", salt.alias("_salt"))
    return spread_rank(homed, "shard", ["doc_id", "text_crc32", "size"], F.col("_salt"), totals["_rows"], "slot").drop("_salt")
