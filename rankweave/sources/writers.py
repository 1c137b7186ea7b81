"""File sinks: pairs, runs, judgments, metrics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def write_pairs(pairs: DataFrame, path: str) -> None:
    """JSON Lines, one folder per split."""
    pairs.write.partitionBy("split").json(path)


def run_line() -> Column:
    return F.concat_ws(
        "\t",
        "query_id",
        F.lit("Q0"),
        "doc_id",
        F.col("rank").cast("string"),
        F.col("score").cast("string"),  # every digit: near-equal scores stay apart
        "tag",
    )


def write_run(run: DataFrame, path: str, ordered: bool = False) -> None:
    """Six tab-separated columns; ``ordered`` range-sorts by query and rank across the part files, at the
    cost of a pass over the run."""
    rows = run.orderBy("query_id", "rank") if ordered else run
    rows.select(run_line().alias("value")).write.text(path)


def write_runs(runs: DataFrame, path: str) -> None:
    """All result sets as one Parquet table; a filter on the partition columns reads one of them."""
    runs.write.partitionBy("system", "topic_set", "tag").parquet(path)


def qrel_line() -> Column:
    return F.concat_ws("\t", "query_id", F.lit("0"), "doc_id", F.col("relevance").cast("string"))


def write_qrels(qrels: DataFrame, path: str) -> None:
    qrels.select(qrel_line().alias("value")).write.text(path)


def write_metrics(metrics: DataFrame, path: str) -> None:
    """The one-row table of means as CSV with a header."""
    metrics.coalesce(1).write.option("header", True).csv(path)
