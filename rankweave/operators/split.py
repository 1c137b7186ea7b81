"""Seeded train/validation/test split by query."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankweave.operators.ranking import exact_rank

# Shares of the two splits.
THREE_WAY = (("train", 0.8), ("val", 0.1), ("test", None))
TWO_WAY = (("train", 0.9), ("val", None))


def assign_splits(
    query_ids: DataFrame,
    parts: Sequence[tuple[str, float | None]] = THREE_WAY,
    seed: int = 42,
) -> DataFrame:
    """(query_id, pos, split) for a DataFrame of distinct query ids.

    Queries are ordered by a seeded md5 and cut at exact sizes: each share of the count, truncated, the
    part without a share taking the rest.
    """
    hashed = query_ids.select("query_id").withColumn(
        "_key", F.md5(F.concat_ws("|", F.lit(str(seed)), F.col("query_id")))
    )
    ranked = exact_rank(
        hashed,
        [F.col("_key"), F.col("query_id")],
        total="_n",
    )
    edge = F.lit(0).cast("long")
    split = None
    rest = next(name for name, share in parts if share is None)
    for name, share in parts:
        if share is None:
            continue
        edge = edge + F.floor(F.col("_n").cast("double") * F.lit(float(share)))
        inside = F.col("pos") <= edge
        split = F.when(inside, name) if split is None else split.when(inside, name)
    return ranked.select("query_id", "pos", split.otherwise(rest).alias("split"))
