"""Every named query against its SQL, at the smallest scale."""

import pytest
from compare import differences, sql_engine

from __spark_entry__ import LLM_QUERIES, LLM_SQL, entry, oracle_sql, queries

ROWS_ONLY = {"all_runs", "metrics_by_system", "tuned_bi_topk", "tuned_ce_topk", "two_stage_run_tuned"}


@pytest.fixture(scope="module")
def con(small_dir):
    return sql_engine(small_dir)


def test_only_known_queries_lack_sql():
    assert set(queries()) - set(oracle_sql()) - set(LLM_QUERIES) == ROWS_ONLY
    assert set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("name", sorted(set(oracle_sql()) - set(LLM_SQL)))
def test_query_matches_sql(spark, con, small_dir, name):
    assert differences(spark, con, queries()[name], oracle_sql()[name], small_dir) == []


def test_entry(spark, small_dir):
    row = entry(spark).collect()[0].asDict()
    assert set(row) == {"p1", "p5", "recall5", "ndcg5", "mrr", "map"}
    assert all(0 <= v <= 1 for v in row.values())


@pytest.mark.parametrize(
    "name", ["metrics_mean", "two_stage_run", "cosine_topk_blocked", "split_pairs", "ski_jump", "rerank_pairs"]
)
def test_no_cross_join(spark, small_dir, name):
    plan = queries()[name](spark, small_dir)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan


def test_only_bucket_sizes_meet_in_one_partition(spark, small_dir):
    """What the global rank gathers in one place are counts per bucket, never the ranked rows."""
    plan = queries()["split_two_way"](spark, small_dir)._jdf.queryExecution().executedPlan().toString()
    lines = plan.splitlines()
    gathered = [i for i, line in enumerate(lines) if "Exchange SinglePartition" in line]
    assert gathered and all("HashAggregate(keys=[_bucket" in lines[i + 1] for i in gathered)


def test_scans_read_only_the_columns_used(spark, small_dir):
    plan = queries()["embed_cache_missing"](spark, small_dir)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<doc_id:bigint,quality:int,toxic:int>" in plan
    assert "PushedFilters: [IsNotNull(quality), EqualTo(quality,1)" in plan
    assert "n_chars" not in plan and "lang" not in plan
