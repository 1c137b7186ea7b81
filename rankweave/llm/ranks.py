"""Gapless row numbers inside groups of which any may hold a large share of all rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

ROWS_PER_BUCKET = 20_000


def spread_rank(df: DataFrame, group: str, order: list[str | Column], salt: Column, rows: int, name: str) -> DataFrame:
    """Add ``name``: 0, 1, 2, ... inside each ``group``, without sorting a group in one task.

    Rows are dealt to about ``rows / ROWS_PER_BUCKET`` hash buckets of ``salt`` in every group, numbered
    by ``order`` in their bucket, and moved up by the sizes of the earlier buckets of their group. Only
    one count per group and bucket meets in the prefix sum. ``salt`` must come from the row, so that a
    recomputed task numbers alike; rows equal in ``salt`` and ``order`` share a bucket and may swap
    numbers among themselves.
    """
    buckets = max(1, -(-rows // ROWS_PER_BUCKET))
    dealt = df.withColumn("_bucket", F.pmod(salt, F.lit(buckets)).cast("int"))
    sizes = dealt.groupBy(group, "_bucket").agg(F.count(F.lit(1)).alias("_size"))
    earlier = Window.partitionBy(group).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(group, "_bucket", F.coalesce(F.sum("_size").over(earlier), F.lit(0)).alias("_start"))
    inside = Window.partitionBy(group, "_bucket").orderBy(*order)
    numbered = dealt.withColumn("_at", F.row_number().over(inside) - 1)
    return (
        numbered.join(starts, [group, "_bucket"])
        .withColumn(name, F.col("_start") + F.col("_at"))
        .drop("_bucket", "_start", "_at")
    )
