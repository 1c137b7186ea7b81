"""Stored vectors of any encoder, so that a text is encoded once for each model.

A model's vectors lie in one Parquet table in hash buckets of a key, which stands for a document and the
hash of its text. Documents are looked up by their keys in the same buckets, so the table itself is never
exchanged, and texts are fetched only for what is missing.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from urllib.parse import quote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rankweave.session import staged

#: Keys of missing texts are broadcast up to this many bytes; beyond it the join is left to Spark.
KEY_BYTES, BROADCAST_BYTES = 100, 32 << 20

#: Replaces the column ``text`` by vector columns and keeps the others.
Encode = Callable[[DataFrame], DataFrame]


def with_keys(docs: DataFrame) -> DataFrame:
    """``docs`` (doc_id, text) with ``text_hash`` and ``key``."""
    hashed = docs.withColumn("text_hash", F.md5("text"))
    return hashed.withColumn("key", F.concat_ws("|", F.col("doc_id").cast("string"), "text_hash"))


class VectorTable:
    """The vectors of ``model_id`` below ``path``: doc_id, text_hash, key and the encoder's columns.

    Writers append. Two at a time may add the same key; one row of each is read. ``compact`` writes the
    rows anew under the next version; a version counts once it is complete.
    """

    def __init__(self, spark: SparkSession, path: str, model_id: str, buckets: int | None = None):
        self.spark = spark
        self.folder = f"{path}/{quote(model_id, safe='')}"
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))

    def _versions(self) -> list[tuple[int, int]]:
        """(number, buckets) of the complete versions."""
        folder = self.spark._jvm.org.apache.hadoop.fs.Path(self.folder)
        system = folder.getFileSystem(self.spark._jsc.hadoopConfiguration())
        if not system.exists(folder):
            return []
        named = [s.getPath() for s in system.listStatus(folder)]
        complete = [p.getName() for p in named if system.exists(self.spark._jvm.org.apache.hadoop.fs.Path(p, "_SUCCESS"))]
        return sorted(tuple(map(int, name[1:].split("-b"))) for name in complete)

    def _place(self, version: tuple[int, int]) -> str:
        return f"{self.folder}/v{version[0]}-b{version[1]}"

    def _named(self, version: tuple[int, int]) -> str:
        """The version under a passing name in the session's catalog."""
        place, name = self._place(version), f"vectors_{uuid.uuid4().hex}"
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in self.spark.read.parquet(place).schema.fields)
        self.spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY (key) INTO {version[1]} BUCKETS LOCATION '{place}'")
        return name

    def rows(self) -> DataFrame | None:
        """All rows as they are stored, None where nothing is."""
        versions = self._versions()
        if not versions:
            return None
        name = self._named(versions[-1])
        try:
            return self.spark.table(name)  # resolved here; the name is not needed any more
        finally:
            self.spark.sql(f"DROP TABLE {name}")

    def add(self, vectors: DataFrame) -> None:
        """Append rows (doc_id, text_hash, key and vector columns)."""
        versions = self._versions()
        version = versions[-1] if versions else (1, self.buckets)
        dealt = vectors.repartition(version[1], "key").write.mode("append").bucketBy(version[1], "key")
        name = self._named(version) if versions else f"vectors_{uuid.uuid4().hex}"
        try:
            (dealt if versions else dealt.option("path", self._place(version))).saveAsTable(name)
        finally:
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")

    def missing_keys(self, keys: DataFrame) -> DataFrame:
        """Those of ``keys`` that have no vector yet: of new documents, and of those whose text has changed."""
        stored = self.rows()
        return keys if stored is None else keys.join(stored.select("key"), "key", "left_anti")

    def _update(self, docs: DataFrame, keys: DataFrame, encode: Encode) -> int:
        missing = staged(self.missing_keys(keys.select("key")), "missing-keys")
        number = missing.count()
        if number:
            few = number * KEY_BYTES <= BROADCAST_BYTES
            wanted = with_keys(docs).join(F.broadcast(missing) if few else missing, "key", "left_semi")
            encoded = encode(wanted.select("doc_id", "text_hash", "key", "text"))
            others = [c for c in encoded.columns if c not in ("doc_id", "text_hash", "key")]
            self.add(encoded.select("doc_id", "text_hash", "key", *others))
        return number

    def update(self, docs: DataFrame, encode: Encode) -> int:
        """Encode and append what is missing of ``docs`` (doc_id, text); how many texts that were."""
        return self._update(docs, with_keys(docs).select("doc_id", "key"), encode)

    def vectors(self, docs: DataFrame, encode: Encode) -> DataFrame:
        """doc_id and the vector of every one of ``docs`` (unique ids); only what is missing is encoded first."""
        keys = staged(with_keys(docs).select("doc_id", "key"), "document-keys")  # texts are hashed once
        self._update(docs, keys, encode)
        stored = self.rows()
        if stored is None:
            return encode(docs.limit(0).select("doc_id", "text"))
        return keys.join(stored.dropDuplicates(["key"]).drop("doc_id", "text_hash"), "key").drop("key")

    def compact(self, keep: DataFrame | None = None) -> None:
        """One row for each key, one file for each bucket; with ``keep`` (doc_id, text) only those texts.

        The version before stays readable until the new one is complete, and is then removed.
        """
        versions, rows = self._versions(), self.rows()
        if rows is None:
            return
        rows = rows.dropDuplicates(["key"])
        if keep is not None:
            rows = rows.join(with_keys(keep).select("key"), "key", "left_semi")
        version, name = (versions[-1][0] + 1, self.buckets), f"vectors_{uuid.uuid4().hex}"
        try:
            rows.repartition(version[1], "key").write.bucketBy(version[1], "key").option("path", self._place(version)).saveAsTable(name)
        finally:
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")
        for old in versions:
            folder = self.spark._jvm.org.apache.hadoop.fs.Path(self._place(old))
            folder.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(folder, True)
