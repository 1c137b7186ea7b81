"""Token ids of a corpus in files: shards of whole documents in id order, each under its own grammar."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StructField, StructType

from rankweave.llm.blocks import pack_ints, unpack_ints
from rankweave.llm.repair import Grammar, compress
from rankweave.llm.wordbpe import WordIds

#: Ids after which a shard ends with the document.
SHARD_IDS = 1 << 21
PARTS = ("left", "right", "lengths", "symbols")
SHARDS = ["part int", "serial int", "start long", "n_ids long", "terminals int", "places binary", *[f"{c} binary" for c in PARTS]]


def write_ids(docs: DataFrame, vocabulary: str, path: str, doc_id: str = "doc_id", text: str = "text", shard_ids: int = SHARD_IDS) -> None:
    """Write the ids of every text, an end id after each, to ``path`` in ascending order of ids.

    Null ids come first; rows of one id are documents of their own, ordered by a hash of their text (equal
    rows in any order). A null or empty text is the end alone. Other columns are not read. Rows are dealt by
    range of (id, text hash), so that neither a null id nor a repeated one meets in one task. A task cuts
    its documents into shards of some ``shard_ids`` ids, which hold whole documents; it holds one shard, and
    a longer text whole.
    """
    spark = docs.sparkSession
    picked = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    order = ["doc_id", F.xxhash64("text")]
    dealt = picked.repartitionByRange(int(spark.conf.get("spark.sql.shuffle.partitions")), *order).sortWithinPartitions(*order)
    id_type = picked.schema["doc_id"].dataType
    schema = StructType([StructField("doc_ids", ArrayType(id_type)), *StructType.fromDDL(", ".join(SHARDS)).fields])

    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, part = WordIds(vocabulary), TaskContext.get().partitionId()
        names, held, sizes, count, serial, begun = [], [], [], 0, 0, 0

        def shard() -> pa.RecordBatch:
            ids, lengths = np.concatenate(held), np.concatenate(sizes)
            grammar, places = compress(ids, np.cumsum(lengths) - lengths, words.terminals)
            ids_of = pa.concat_arrays(names)
            listed = pa.ListArray.from_arrays(pa.array([0, len(ids_of)], pa.int32()), ids_of)
            row = [part, serial, begun, len(ids), words.terminals, pack_ints(places), *grammar.pack()]
            kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int32(), *[pa.binary()] * 5]
            return pa.record_batch([listed, *[pa.array([v], k) for v, k in zip(row, kinds)]], names=schema.names)

        for batch in batches:
            ids, lengths = words.encode(batch.column(1))
            ends = np.cumsum(lengths)
            low = 0
            while low < len(lengths):
                # Up to and with the document that fills the shard.
                before = int(ends[low - 1]) if low else 0
                high = min(int(np.searchsorted(ends, before + shard_ids - count)) + 1, len(lengths))
                names.append(batch.column(0).slice(low, high - low))
                held.append(ids[before : int(ends[high - 1])])
                sizes.append(lengths[low:high])
                count += len(held[-1])
                low = high
                if count >= shard_ids:
                    yield shard()
                    begun, serial = begun + count, serial + 1
                    names, held, sizes, count = [], [], [], 0
        if names:
            yield shard()

    dealt.mapInArrow(shards, schema).write.parquet(path)


def _placed(spark: SparkSession, path: str) -> DataFrame:
    """The shards with ``before``, the ids of all earlier parts: one number for each part, which there are
    as many of as partitions wrote the files."""
    shards = spark.read.parquet(path)
    sizes = shards.groupBy("part").agg(F.sum("n_ids").alias("_n"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = sizes.select("part", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("before"))
    return shards.join(F.broadcast(before), "part")


def _grammar(row: dict) -> Grammar:
    return Grammar.unpack(row["terminals"], [row[c] for c in PARTS])


def read_documents(spark: SparkSession, path: str, digests: bool = False) -> DataFrame:
    """(doc_id, start, n_tokens, ids) of every document in the files at ``path``; ``start`` counts the ids of
    all documents before it. With ``digests`` the crc32 of the ids comes instead of them."""
    placed = _placed(spark, path)
    id_field = StructField("doc_id", placed.schema["doc_ids"].dataType.elementType)
    last = StructField("ids_crc32", LongType()) if digests else StructField("ids", ArrayType(LongType()))
    schema = StructType([id_field, StructField("start", LongType()), StructField("n_tokens", LongType()), last])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                row = batch.slice(at, 1)
                doc_ids = row.column(0).flatten()
                fields = dict(zip(batch.schema.names[1:], (c[0].as_py() for c in row.columns[1:])))
                grammar = _grammar(fields)
                ids = grammar.expand()
                sizes = np.add.reduceat(grammar.sizes(grammar.symbols), unpack_ints(fields["places"]))
                starts = np.cumsum(sizes) - sizes
                data = memoryview(ids.astype("<u4").tobytes())
                if digests:
                    values = pa.array([zlib.crc32(data[4 * a : 4 * (a + n)]) for a, n in zip(starts.tolist(), sizes.tolist())], pa.int64())
                else:
                    values = pa.ListArray.from_arrays(pa.array(np.append(starts, len(ids)), pa.int32()), pa.array(ids.astype(np.int64)))
                begun = pa.array(starts + (fields["before"] + fields["start"]))
                yield pa.record_batch([doc_ids, begun, pa.array(sizes), values], names=schema.names)

    return placed.select("doc_ids", "before", "start", "terminals", "places", *PARTS).mapInArrow(read, schema)


def read_ids(spark: SparkSession, path: str, start: int, length: int) -> DataFrame:
    """(start, ids) of the pieces, one for each shard that holds some, of ``length`` ids from ``start`` on.

    Only shards in reach are read, and of those only the symbols that hold the ids are expanded.
    """
    placed = _placed(spark, path).withColumn("first", F.col("before") + F.col("start"))
    near = placed.where((F.col("first") < start + length) & (F.col("first") + F.col("n_ids") > start))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                low = max(start, row["first"])
                high = min(start + length, row["first"] + row["n_ids"])
                ids = _grammar(row).slice(low - row["first"], high - low)
                yield pa.record_batch([pa.array([low]), pa.array([ids.tolist()], pa.list_(pa.int64()))], names=["start", "ids"])

    return near.select("first", "n_ids", "terminals", *PARTS).mapInArrow(read, "start long, ids array<long>")
