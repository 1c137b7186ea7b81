"""Session defaults and the shared scratch location."""

from __future__ import annotations

import contextlib
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession


def configure(spark: SparkSession) -> SparkSession:
    """Settings the operators rely on at scale.

    Many judgments can share one topic or document. The adaptive skew join splits such a key's rows, but
    by default not where the next step needs the same partitioning; forcing it adds a shuffle there
    instead of leaving the hot key to one task.
    """
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    spark.conf.set("spark.sql.adaptive.forceOptimizeSkewedJoin", "true")
    # Whole texts go to Python in batches of bounded size, whatever their length.
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(8 << 20))
    return spark


def local_session(cpus: str = "*", memory: str = "12g") -> SparkSession:
    """A local session for tests and the bench; clusters bring their own."""
    return configure(
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("rankweave")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )


def scratch_base(spark: SparkSession) -> str:
    """The shared folder for intermediate tables.

    That is the folder given to ``setCheckpointDir``, else the one in ``spark.checkpoint.dir``. Only a
    local session may do without: a temporary folder is made and set for it. On a cluster each executor
    would write to a disk of its own, so that is refused.
    """
    base = spark.sparkContext.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        master = spark.sparkContext.master
        if not (master == "local" or master.startswith("local[")):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="rankweave-")
        spark.sparkContext.setCheckpointDir(base)
    return base.rstrip("/")


_scopes: list[list[str]] = []


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below ``scratch_base``."""
    path = f"{scratch_base(spark)}/{label}-{uuid.uuid4().hex}"
    for scope in _scopes:
        scope.append(path)
    return path


@contextlib.contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Removes the intermediate tables made inside, when it is left. Results must be written before."""
    _scopes.append([])
    try:
        yield
    finally:
        for path in _scopes.pop():
            dropped(spark, path)


def dropped(spark: SparkSession, path: str) -> None:
    """Removes an intermediate table."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def staged(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once as Parquet and read it back.

    For a costly result with several consumers: it is computed once, and a lost executor costs a re-read
    of the table rather than a recomputation.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
