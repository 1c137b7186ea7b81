"""Ranking operators that stay distributed whatever the group sizes are."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rankweave.session import staged


def top_k(df: DataFrame, keys: Sequence[str], order: Sequence[Column], k: int, name: str = "rank") -> DataFrame:
    """The first ``k`` rows of every key in ``order``, with their 1-based rank.

    ``row_number() <= k`` lets Catalyst put a group limit before and after the exchange, so a task ships
    at most ``k`` rows per key and a hot key costs no more than a cold one.
    """
    numbered = df.withColumn(name, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return numbered.where(F.col(name) <= k)


def exact_rank(
    df: DataFrame, order: Sequence[Column], keys: Sequence[str] = (), name: str = "pos", total: str | None = None
) -> DataFrame:
    """Exact 1-based rank of every row within ``keys`` (or over everything), without a one-task sort.

    Rows are dealt by range of (keys, order), so partitions are even whatever the keys and values are: a
    hot key, or a value that most rows share, is spread as long as ``order`` tells its rows apart. Rows
    are numbered inside a partition; the sizes of the earlier ones are added. The ranges are written
    once, as both steps must see the same. ``total`` names an optional column for the row count of the key.
    """
    ranges = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = df.repartitionByRange(ranges, *[F.col(k).asc() for k in keys], *order)
    tagged = staged(dealt.withColumn("_bucket", F.spark_partition_id()), "ranges")
    sizes = tagged.groupBy(*keys, "_bucket").agg(F.count(F.lit(1)).alias("_size"))
    along = Window.partitionBy(*keys).orderBy("_bucket")
    so_far = F.sum("_size").over(along.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    everything = F.sum("_size").over(Window.partitionBy(*keys))
    starts = sizes.select(
        *keys, "_bucket", (so_far - F.col("_size")).alias("_start"), everything.alias("_total")
    )
    if not keys:
        starts = F.broadcast(starts)  # one row per partition
    inside = F.row_number().over(Window.partitionBy(*keys, "_bucket").orderBy(*order))
    ranked = tagged.withColumn("_inside", inside).join(starts, [*keys, "_bucket"])
    extra = [(F.col("_start") + F.col("_inside")).alias(name)]
    if total:
        extra.append(F.col("_total").alias(total))
    return ranked.select(*df.columns, *extra)


def rank_run(run: DataFrame, depth: int | None = None) -> DataFrame:
    """Rank a run by score, highest first; equal scores keep the order of the given ``rank``, then doc_id.

    The given rank is otherwise ignored and replaced. ``depth`` is the caller's promise of a bound on the
    rows of a query, which are then ranked in one window group; without it they are ranked over ranges.
    """
    rows = run.withColumn("_given", F.coalesce(F.col("rank").cast("long"), F.lit(0)))
    order = [F.col("score").desc(), F.col("_given").asc(), F.col("doc_id").asc()]
    if depth is not None:
        per_query = Window.partitionBy("query_id").orderBy(*order)
        return rows.withColumn("rank", F.row_number().over(per_query)).drop("_given")
    return exact_rank(rows.drop("rank"), order, ["query_id"], "rank").select(
        *[F.col(c).cast("int").alias(c) if c == "rank" else c for c in run.columns]
    )
