"""Joins of many rows to one row per key, where a single key may hold any share of the rows.

The adaptive skew join covers two shuffled inputs that meet directly. These helpers cover the joins it
does not see, where one side is an aggregate or a Python step over the same key: the rows of a hot key
are dealt out over as many salts as its count asks for, and its one partner row is copied to each.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

HOT_ROWS = 200_000


def hot_keys(many: DataFrame, key: str, hot_rows: int = HOT_ROWS) -> DataFrame:
    """(key, _salts) of the keys with more than ``hot_rows`` rows and a quarter of a partition's share.

    So there are at most four for each shuffle partition, whatever the number of rows, which makes the
    table fit for broadcasting; a key below that share cannot overload a task.
    """
    spark = many.sparkSession
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    counts = many.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    share = counts.select(F.sum("_n") / (4 * partitions)).scalar()
    limit = F.greatest(F.lit(float(hot_rows)), share)
    found = counts.where(F.col("_n") > limit).select(key, F.ceil(F.col("_n") / limit).alias("_salts"))
    # Read here, once for all joins that use it; where no key is hot the joins are planned as plain ones.
    rows = [tuple(r) for r in found.collect()]
    return F.broadcast(spark.createDataFrame(rows, StructType([many.schema[key], StructField("_salts", LongType())])))


def with_salt(many: DataFrame, hot: DataFrame, key: str, spread_by: str) -> DataFrame:
    """Add ``_salt``: 0, or for a hot key a number below its salt count drawn from ``spread_by``."""
    salt = F.coalesce(F.pmod(F.xxhash64(spread_by), F.col("_salts")), F.lit(0).cast("long"))
    return many.join(hot, key, "left").withColumn("_salt", salt).drop("_salts")


def with_copies(one: DataFrame, hot: DataFrame, key: str) -> DataFrame:
    """Add ``_salt``, with one copy of the row for every salt of its key."""
    last = F.coalesce(F.col("_salts"), F.lit(1).cast("long")) - 1
    copies = one.join(hot, key, "left").withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("long"), last)))
    return copies.drop("_salts")


def salted_join(
    many: DataFrame,
    one: DataFrame,
    key: str,
    spread_by: str,
    how: str = "inner",
    hot_rows: int = HOT_ROWS,
    hot: DataFrame | None = None,
) -> DataFrame:
    """``many.join(one, key, how)`` for unique keys in ``one``; ``how`` is inner, left or left_semi.

    ``many`` is read for its hot keys first, unless ``hot`` names them: stage it where it is costly.
    """
    hot = hot_keys(many.select(key), key, hot_rows) if hot is None else hot
    salted = with_salt(many, hot, key, spread_by)
    return salted.join(with_copies(one, hot, key), [key, "_salt"], how).drop("_salt")
