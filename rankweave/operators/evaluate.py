"""Ranking metrics over graded judgments."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rankweave.operators.ranking import exact_rank
from rankweave.session import staged
from rankweave.sources.readers import read_runs
from rankweave.sources.writers import write_metrics

# The grades that count, the metric names and cutoffs.
GRADES = (1, 2)
METRICS = {"p1": "precision@1", "p5": "precision@5", "recall5": "recall@5", "ndcg5": "ndcg@5", "mrr": "mrr", "map": "map"}
CUTOFF = 5


def filter_grades(qrels: DataFrame, grades: Sequence[int] = GRADES) -> DataFrame:
    return qrels.where(F.col("relevance").isin(*grades))


def _ideal(judged: DataFrame, keys: list[str]) -> DataFrame:
    """Relevant count and ideal DCG per query, from its grade counts.

    Counting (query, grade) first leaves one row per grade, so a query with any number of judgments costs
    a handful of rows after the partial aggregation.
    """
    grades = judged.groupBy(*keys, "relevance").agg(F.count(F.lit(1)).alias("_n"))
    better = Window.partitionBy(*keys).orderBy(F.col("relevance").desc())
    first = F.sum("_n").over(better.rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("_n")
    placed = grades.withColumn("_first", first)
    discounts = sum(
        (
            F.when(
                (F.col("_first") < i) & (F.col("_first") + F.col("_n") >= i), F.lit(1 / math.log2(i + 1))
            ).otherwise(F.lit(0.0))
            for i in range(1, CUTOFF + 1)
        ),
        F.lit(0.0),
    )
    return placed.groupBy(*keys).agg(
        F.sum("_n").alias("n_relevant"), F.sum(F.col("relevance") * discounts).alias("ideal")
    )


def _hits_so_far(hits: DataFrame, keys: list[str], depth: int | None) -> DataFrame:
    if depth is not None:
        return hits.withColumn(
            "hit_no", F.row_number().over(Window.partitionBy(*keys).orderBy("rank"))
        )
    return exact_rank(hits, [F.col("rank")], keys, "hit_no")


def evaluate(
    run: DataFrame,
    qrels: DataFrame,
    grades: Sequence[int] = GRADES,
    depth: int | None = None,
    systems: Sequence[str] = (),
) -> DataFrame:
    """Metrics of every judged query: p1, p5, recall5, ndcg5, mrr, map.

    ``run`` is ranked, with unique (query_id, doc_id); ``qrels`` has one grade per (query_id, doc_id).
    Every query in ``qrels`` counts, with 0 where it has no relevant document or no result; queries only
    in the run are left out. ``depth`` states a bound on run rows per query, None that there is none.
    With ``systems``, both the run and the result carry a ``system`` column and every system named is
    measured over the same queries.
    """
    keys = ["system", "query_id"] if systems else ["query_id"]
    universe = qrels.select("query_id").distinct()
    if systems:
        named = F.explode(F.array(*[F.lit(s) for s in systems])).alias("system")
        universe = universe.select(named, "query_id")
    judged = filter_grades(qrels, grades).where(F.col("relevance") > 0)
    hits = run.select(*keys, "doc_id", "rank").join(judged, ["query_id", "doc_id"])
    hits = _hits_so_far(hits.select(*keys, "rank", "relevance"), keys, depth)
    top = F.col("rank") <= CUTOFF
    scored = hits.groupBy(*keys).agg(
        F.count_if(F.col("rank") == 1).alias("top1"),
        F.count_if(top).alias("top5"),
        F.sum(F.when(top, F.col("relevance") / F.log2(F.col("rank") + 1)).otherwise(F.lit(0.0))).alias("dcg"),
        F.min("rank").alias("first_hit"),
        F.sum(F.col("hit_no") / F.col("rank")).alias("precisions"),
    )
    ideal = _ideal(judged, ["query_id"])
    rows = universe.join(ideal, "query_id", "left").join(scored, keys, "left")

    def or_zero(value: Column, name: str) -> Column:
        return F.coalesce(value, F.lit(0.0)).alias(name)

    return rows.select(
        *keys,
        or_zero(F.col("top1").cast("double"), "p1"),
        or_zero(F.col("top5") / F.lit(float(CUTOFF)), "p5"),
        or_zero(F.col("top5") / F.col("n_relevant"), "recall5"),
        or_zero(F.col("dcg") / F.col("ideal"), "ndcg5"),
        or_zero(F.lit(1.0) / F.col("first_hit"), "mrr"),
        or_zero(F.col("precisions") / F.col("n_relevant"), "map"),
    )


def mean_metrics(per_query: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Mean of every metric over the queries, one row (or one per ``by`` value)."""
    means = [F.avg(name).alias(name) for name in METRICS]
    return per_query.groupBy(*by).agg(*means)


def named_metrics(means: DataFrame) -> DataFrame:
    """The same row under the published metric names."""
    return means.select(*[F.col(c).alias(METRICS.get(c, c)) for c in means.columns])


def ski_jump(per_query: DataFrame, jitter_seed: int | None = None) -> DataFrame:
    """(query_id, p5, pos, n): queries in ascending order of P@5, positions from 0.

    Equal values are ordered by md5 of the id. With ``jitter_seed`` a column ``p5_jittered`` spreads the
    points by up to 0.01 either way, by a hash of seed and id, so that a repeated run draws them alike.
    """
    keyed = per_query.select("query_id", "p5").withColumn("_key", F.md5("query_id"))
    ranked = exact_rank(
        keyed,
        [F.col("p5"), F.col("_key"), F.col("query_id")],
        total="n",
    )
    series = ranked.select("query_id", "p5", (F.col("pos") - 1).alias("pos"), "n")
    if jitter_seed is not None:
        drawn = F.conv(F.substring(F.md5(F.concat_ws("|", F.lit(str(jitter_seed)), "query_id")), 1, 8), 16, 10)
        share = drawn.cast("double") / F.lit(float(0xFFFFFFFF))
        series = series.withColumn("p5_jittered", F.col("p5") + share * 0.02 - 0.01)
    return series


def ski_jump_ticks(series: DataFrame, ticks: int = 10) -> DataFrame:
    """The labelled positions of the series: every (n // ticks)-th query, all of them when n is small."""
    step = F.greatest(F.lit(1).cast("long"), F.floor(F.col("n") / ticks))
    return series.where(F.pmod(F.col("pos"), step) == 0).select("query_id", "p5", "pos")


def evaluate_runs(
    spark: SparkSession,
    runs_path: str,
    qrels: DataFrame,
    out_path: str,
    systems: Sequence[str],
    tags: Sequence[str],
    topic_set: int = 1,
    grades: Sequence[int] = GRADES,
    depth: int | None = None,
) -> DataFrame:
    """Measure stored result sets: (system, tag) with the mean of every metric.

    Each of them is written to ``out_path``/system/tag: the means as a CSV file in ``metrics``, the series of
    P@5 by query in ``series``. All are measured over the judged queries, so one without results has zeros.
    """
    runs = read_runs(spark, runs_path, systems, [topic_set], tags)
    named = {f"{system}/{tag}": (system, tag) for system in systems for tag in tags}
    runs = runs.withColumn("system", F.concat_ws("/", "system", "tag"))
    per_query = staged(evaluate(runs, qrels, grades, depth, list(named)), "per-query")
    means = staged(mean_metrics(per_query, ["system"]), "means")
    for name, (system, tag) in named.items():
        place = f"{out_path}/{system}/{tag}"
        write_metrics(named_metrics(means.where(F.col("system") == name).drop("system")), f"{place}/metrics")
        ski_jump(per_query.where(F.col("system") == name)).drop("n").write.option("header", True).csv(f"{place}/series")
    parts = F.split("system", "/")
    return means.select(F.get(parts, 0).alias("system"), F.get(parts, 1).alias("tag"), *METRICS)
