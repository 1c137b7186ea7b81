"""Texts as positions of different words: the shared ground of operators that treat each word once.

A block is some 16 MB of text with one list of its different words; each of its documents is a sequence of
numbers into that list. What is to be known of a word is worked out once for all blocks, in the hash
bucket of the word, and sent back to the blocks. A very frequent word is one entry per block.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from typing import Protocol

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame

from rankweave.session import scratch_path

#: Characters of text in a block. A longer text is not cut.
BLOCK_CHARS = 16 << 20


def staged_by_block(rows: DataFrame, label: str) -> DataFrame:
    """``rows`` written once to the shared folder, bucketed by block, so that documents are not shuffled
    again when the words of their blocks come back."""
    spark = rows.sparkSession
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    path = scratch_path(spark, label)
    name = f"{label}_{uuid.uuid4().hex}".replace("-", "_")
    try:
        rows.write.bucketBy(buckets, "block").option("path", path).saveAsTable(name)
        return spark.table(name)  # resolved here, so that the name can go; the files stay
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


class Block(Protocol):
    #: Number of each word, in order of appearance.
    numbers: dict

    def add(self, doc_id: object, text: str) -> bytes:
        """The words of the text by position, as unsigned 32-bit numbers."""

    def weights(self) -> np.ndarray | None:
        """An unsigned number for each word, by its number."""


def pack_ints(values: np.ndarray) -> bytes:
    """Unsigned 32-bit integers, byte planes apart, compressed."""
    planes = np.ascontiguousarray(values, dtype="<u4").view(np.uint8).reshape(-1, 4).T
    return zstandard.compress(planes.tobytes(), 3)


def unpack_ints(body: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.decompress(body), dtype=np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<u4").ravel().astype(np.int64)


def split_texts(docs: DataFrame, make_block: Callable[[], Block], buckets: int) -> DataFrame:
    """Rows of two kinds for each block: documents as positions, and words by bucket.

    A document row holds ids, numbers of pre-tokens, and the positions of several documents. A word row
    holds the block's words of one hash bucket with their numbers in the block, and their weights if the
    block keeps any.
    """
    id_type = docs.schema.fields[0].dataType
    schema = "block string, bucket int, doc_ids array<{}>, counts array<int>, numbers binary, weights binary, body binary".format(id_type.simpleString())

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        partition, serial = TaskContext.get().partitionId(), 0
        block, held, size = make_block(), 0, 0
        ids, counts, parts = [], [], []
        arrow_ids = None

        def rows(name: str, rows: list[tuple]) -> pa.RecordBatch:
            bucket, doc_ids, per_doc, numbers, weights, body = zip(*rows)
            return pa.record_batch(
                [
                    pa.array([name] * len(rows)),
                    pa.array(bucket, pa.int32()),
                    pa.array(doc_ids, pa.list_(arrow_ids)),
                    pa.array(per_doc, pa.list_(pa.int32())),
                    pa.array(numbers, pa.binary()),
                    pa.array(weights, pa.binary()),
                    pa.array(body, pa.binary()),
                ],
                names=["block", "bucket", "doc_ids", "counts", "numbers", "weights", "body"],
            )

        def documents() -> pa.RecordBatch:
            packed = pack_ints(np.frombuffer(b"".join(parts), dtype="<u4"))
            return rows(f"{partition}-{serial}", [(None, ids, counts, None, None, packed)])

        def words() -> pa.RecordBatch:
            dealt: list[list[tuple[bytes, int]]] = [[] for _ in range(buckets)]
            for word, number in block.numbers.items():
                value = word if isinstance(word, bytes) else word.encode("utf-8", "surrogatepass")
                dealt[hash_bytes(value) % buckets].append((value, number))
            out, weights = [], block.weights()
            for bucket, found in enumerate(dealt):
                if found:
                    found.sort()
                    lengths = pack_ints(np.array([len(w) for w, _ in found]))
                    body = len(lengths).to_bytes(4, "little") + lengths + zstandard.compress(b"".join(w for w, _ in found), 3)
                    numbers = np.array([n for _, n in found])
                    out.append((bucket, None, None, pack_ints(numbers), None if weights is None else pack_ints(weights[numbers]), body))
            return rows(f"{partition}-{serial}", out)

        for batch in batches:
            arrow_ids = batch.column(0).type
            for doc_id, value in zip(batch.column(0).to_pylist(), batch.column(1)):
                text = value.as_py() or ""
                found = block.add(doc_id, text)
                ids.append(doc_id)
                counts.append(len(found) // 4)
                parts.append(found)
                held += len(found)
                size += len(text)
                if held > 4 << 20 or size > BLOCK_CHARS:
                    yield documents()
                    ids, counts, parts, held = [], [], [], 0
                if size > BLOCK_CHARS:
                    if block.numbers:
                        yield words()
                    serial, block, size = serial + 1, make_block(), 0
        if ids:
            yield documents()
        if block.numbers:
            yield words()

    return docs.mapInArrow(split, schema)


def hash_bytes(value: bytes) -> int:
    return xxhash.xxh32_intdigest(value)


def bucketed_words(words: list[bytes], numbers: np.ndarray, weights: np.ndarray, buckets: int) -> Iterator[tuple[int, bytes, bytes, bytes]]:
    """(bucket, numbers, weights, words) of different words by hash bucket, packed; ``weights`` go by number."""
    dealt = np.fromiter((hash_bytes(w) % buckets for w in words), dtype=np.int64, count=len(words))
    order = np.argsort(dealt, kind="stable")
    ends = np.searchsorted(dealt[order], np.arange(buckets + 1))
    for bucket in np.flatnonzero(np.diff(ends)).tolist():
        mine = order[ends[bucket] : ends[bucket + 1]]
        listed = [words[i] for i in mine.tolist()]
        lengths = pack_ints(np.array([len(w) for w in listed]))
        body = len(lengths).to_bytes(4, "little") + lengths + zstandard.compress(b"".join(listed), 3)
        yield bucket, pack_ints(numbers[mine]), pack_ints(weights[numbers[mine]]), body


def word_list(body: bytes) -> list[bytes]:
    size = int.from_bytes(body[:4], "little")
    ends = np.cumsum(unpack_ints(body[4 : 4 + size]))
    joined = zstandard.decompress(body[4 + size :])
    return [joined[a:b] for a, b in zip([0, *ends[:-1].tolist()], ends.tolist())]


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The numbers start, start + 1, ... of each range, one range after the other; in 32 bits if ``starts`` has them and they are enough."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    kind = np.int32 if starts.dtype == np.int32 and total < 1 << 31 else np.int64
    out = np.repeat((starts - (ends - lengths)).astype(kind), lengths)
    out += np.arange(total, dtype=kind)
    return out


def encode_words(words: DataFrame, make_encoder: Callable[[], Callable[[bytes], list[int]]]) -> DataFrame:
    """(block, numbers, lengths, ids) for the word rows of ``split_texts``.

    All rows with a word are in one bucket, so it is encoded once. The words of one bucket are held
    until the next bucket begins, two million of them at most.
    """
    schema = "block string, numbers binary, lengths binary, ids binary"

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        piece = make_encoder()
        known, current = {}, None
        for batch in batches:
            lengths, ids = [], []
            for bucket, body in zip(batch.column(1).to_pylist(), batch.column(3)):
                if bucket != current or len(known) > 2_000_000:
                    known, current = {}, bucket
                found = []
                for word in word_list(body.as_py()):
                    value = known.get(word)
                    if value is None:
                        value = known[word] = np.array(piece(word), dtype="<u4").tobytes()
                    found.append(value)
                lengths.append(pack_ints(np.array([len(v) // 4 for v in found])))
                ids.append(pack_ints(np.frombuffer(b"".join(found), dtype="<u4")))
            yield pa.record_batch([batch.column(0), batch.column(2), pa.array(lengths, pa.binary()), pa.array(ids, pa.binary())], names=["block", "numbers", "lengths", "ids"])

    dealt = words.select("block", "bucket", "numbers", "body").repartition("bucket").sortWithinPartitions("bucket")
    return dealt.mapInArrow(encode, schema)


def block_ids(words: pa.Table, documents: pa.Table) -> Iterator[tuple[list, list[np.ndarray]]]:
    """Document ids with their token ids, put together by position, for each row of documents."""
    numbers, lengths, ids = (
        np.concatenate([unpack_ints(v.as_py()) for v in words[c]] or [np.zeros(0, dtype=np.int64)]) for c in ("numbers", "lengths", "ids")
    )
    starts, sizes = np.zeros(len(numbers), dtype=np.int64), np.zeros(len(numbers), dtype=np.int64)
    starts[numbers], sizes[numbers] = np.cumsum(lengths) - lengths, lengths
    for doc_ids, counts, body in zip(documents["doc_ids"], documents["counts"], documents["body"]):
        at = unpack_ints(body.as_py())
        tokens = ids[ragged(starts[at], sizes[at])]
        per_doc = np.cumsum(counts.values.to_numpy())
        ends = np.concatenate([[0], np.cumsum(sizes[at])])[per_doc]
        yield doc_ids.values, np.split(tokens, ends[:-1])
