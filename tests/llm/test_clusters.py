"""What only shows away from the repository's folder, and what calls leave behind."""

import os
import subprocess
import sys

from pyspark.sql import functions as F

from rankweave.llm import blocks, lines, quality
from rankweave.llm.queries import QUERIES

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
SCRIPT = """
import sys
sys.path.insert(0, {root!r})
from __spark_entry__ import queries
from rankweave.session import local_session
spark = local_session("4")
spark.sparkContext.setLogLevel("ERROR")
def known(batches):
    import importlib.util
    for batch in batches:
        yield batch.assign(found=importlib.util.find_spec("rankweave") is not None)
assert not spark.range(1).mapInPandas(known, "id long, found boolean").first().found, "workers see the package"
for name in {names!r}:
    queries()[name](spark, {path!r}).write.format("noop").mode("overwrite").save()
    print("ran", name, flush=True)
"""


def test_executors_need_no_install_of_the_package(small_dir, tmp_path):
    names = list(QUERIES)
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"} | {"PYSPARK_PYTHON": sys.executable}
    # The script itself must be able to import the entry; the workers start without its path.
    script = tmp_path / "run.py"
    script.write_text(SCRIPT.format(root=ROOT, names=names, path=small_dir))
    done = subprocess.run([sys.executable, str(script)], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=1200)
    assert done.returncode == 0, done.stderr[-3000:]
    assert [line.split()[1] for line in done.stdout.splitlines() if line.startswith("ran ")] == names


def test_bucketed_blocks_leave_no_name_in_the_catalog(spark):
    rows = spark.range(100).select(F.concat(F.lit("b"), (F.col("id") % 3).cast("string")).alias("block"), "id")
    staged = blocks.staged_by_block(rows, "some-blocks")
    assert not spark.catalog.listTables()
    assert staged.groupBy("block").count().count() == 3
    plan = staged.groupBy("block").count()._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning" not in plan  # the buckets still count


def test_columns_of_the_caller_may_have_inner_names(spark):
    text = "\n".join(f"line {i} of some prose that the rules leave alone as it has words and ends well" for i in range(30))
    inner = ("_runs", "_run_key", "_line_key", "_kept", "_quality", "_votes", "_stats")
    docs = spark.createDataFrame([(1, text), (2, text + "."), (3, None)], "doc_id long, text string")
    docs = docs.select("*", *[F.lit(c).alias(c) for c in inner])
    cut = lines.dedup_lines(docs)
    assert cut.columns == [*docs.columns, "deleted_lines"]
    assert {r.doc_id: r._runs for r in cut.collect()} == dict.fromkeys((1, 2, 3), "_runs")
    kept = quality.drop_low_quality(docs)
    assert kept.columns == docs.columns
    assert {r._quality for r in kept.collect()} <= {"_quality"}
