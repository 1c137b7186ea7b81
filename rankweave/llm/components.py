"""Connected components of a graph held as an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankweave.session import staged


def _smallest(edges: DataFrame) -> DataFrame:
    return staged(edges.groupBy("u").agg(F.min("v").alias("m")), "component-mins")


def _signature(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first())


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(vertex, component) for every vertex with an edge to another; component is its smallest vertex.

    Large-star and small-star steps in turn: each vertex hands the smallest of its neighbours to the
    others, which halves distances, until the edges no longer change. Edges never grow in number. The
    smallest neighbour of each vertex is written before it is joined back, so that the join has two plain
    inputs and a vertex with very many edges can be split by the adaptive skew join.
    """
    first = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct()
    now = staged(first, "component-edges")
    before, signature = None, _signature(now)
    while signature != before:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        joined = both.join(_smallest(both), "u").where("v > u")
        large = staged(joined.select(F.col("v").alias("u"), F.least("m", "u").alias("v")).where("u <> v").distinct(), "large-star")
        mins = _smallest(large)
        rest = large.join(mins, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        now = staged(rest.unionByName(mins.withColumnRenamed("m", "v")).distinct(), "small-star")
        before, signature = signature, _signature(now)
    roots = now.select(F.col("v").alias("vertex"), F.col("v").alias("component")).distinct()
    return now.select(F.col("u").alias("vertex"), F.col("v").alias("component")).unionByName(roots)
