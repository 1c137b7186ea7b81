"""Byte-level BPE over a corpus: each distinct pre-token is encoded once, wherever it occurs."""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, IntegerType, LongType, StringType, StructField, StructType

from rankweave.llm.blocks import block_ids, encode_words, split_texts, staged_by_block

#: White space as the pre-token pattern means it; Python counts four control characters more.
DOUBLE_SPACE = re.compile(r"\s (?:\s|\Z)")


def encoding(vocabulary: str, pattern: str) -> tiktoken.Encoding:
    """Made once for each task or block: a cached function would travel by the name of this package, which
    executors need not have."""
    with open(vocabulary, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def token_bytes(vocabulary: str, pattern: str) -> list[bytes]:
    """The bytes of every id; the table is as large as the vocabulary, not the corpus."""
    table = encoding(vocabulary, pattern)._mergeable_ranks
    out = [b""] * (max(table.values()) + 1)
    for token, rank in table.items():
        out[rank] = token
    return out


def splitter(pattern: str) -> regex.Pattern:
    """The pattern with ``\\s`` written out, as libraries differ on control characters."""
    space = r"\t-\r \x85\xa0  -     　"
    return regex.compile(pattern.replace(r"[^\s", f"[^{space}").replace(r"\s", f"[{space}]"))


class TokenBlock:
    """Numbers the pre-tokens of some texts in order of appearance."""

    def __init__(self, pattern: str):
        self.find = splitter(pattern).findall
        self.numbers: dict[str, int] = {}
        self.chunks: dict[str, bytes] = {}

    def _number(self, tokens: list[str]) -> bytes:
        numbers = self.numbers
        return np.array([numbers.setdefault(t, len(numbers)) for t in tokens], dtype="<u4").tobytes()

    def weights(self) -> None:
        return None

    def add(self, doc_id: object, text: str) -> bytes:
        """The pre-token at each position of the text, as numbers.

        A space before a word starts a pre-token, so texts are cut there and what recurs between two
        spaces is split once. Only a space between two white-space characters (or before the end) may
        lie inside a pre-token; such texts are split as a whole.
        """
        if DOUBLE_SPACE.search(text):
            return self._number(self.find(text))
        first, *rest = text.split(" ")
        chunks = self.chunks
        parts = [self._number(self.find(first))]
        for piece in rest:
            part = chunks.get(piece)
            if part is None:
                part = chunks[piece] = self._number(self.find(" " + piece))
            parts.append(part)
        return b"".join(parts)


def decoded(ids: list[int], table: list[bytes]) -> bytes:
    return b"".join(map(table.__getitem__, ids))


def encode_documents(
    docs: DataFrame, vocabulary: str, pattern: str, digests: bool = False, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """(doc_id, ids) of every row, or with ``digests`` what ``op1`` reports instead of the ids.

    ``vocabulary`` is a rank file, ``pattern`` splits texts into pre-tokens, special tokens are plain
    text. A null or empty text has no ids. Rows that repeat an id are documents of their own; other
    columns are not read.

    Pre-tokens with their positions are held by block of about ``blocks.BLOCK_CHARS``: one list of its different words,
    and for each document their numbers in order. The words go to hash buckets, where each is encoded
    once for all blocks, and their ids back to the blocks, which put documents together by position. A
    very frequent word is one entry per block, so it costs a bucket no more rows than there are blocks.
    """
    spark = docs.sparkSession
    picked = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    blocks = staged_by_block(split_texts(picked, lambda: TokenBlock(pattern), buckets), "bpe-blocks")
    encoded = encode_words(blocks.where("bucket is not null"), lambda: encoding(vocabulary, pattern)._encode_single_piece)
    documents = blocks.where("bucket is null").select("block", "doc_ids", "counts", "body")
    id_field = picked.schema.fields[0]
    if digests:
        out = StructType([id_field, StructField("n_tokens", LongType()), StructField("ids_sha256", StringType()), StructField("decoded_sha256", StringType())])
    else:
        out = StructType([id_field, StructField("ids", ArrayType(IntegerType()))])

    def assemble(documents: pa.Table, words: pa.Table) -> pa.Table:
        names, columns = [], []
        table = token_bytes(vocabulary, pattern) if digests else []
        decimal = [str(i) for i in range(len(table))]
        for doc_ids, tokens in block_ids(words, documents):
            names.append(doc_ids)
            lists = [t.tolist() for t in tokens]
            if digests:
                said = [hashlib.sha256(" ".join(map(decimal.__getitem__, t)).encode()).hexdigest() for t in lists]
                back = [hashlib.sha256(decoded(t, table)).hexdigest() for t in lists]
                columns.append([pa.array([len(t) for t in lists], pa.int64()), pa.array(said), pa.array(back)])
            else:
                columns.append([pa.array(lists, pa.list_(pa.int32()))])
        merged = [pa.chunked_array(c) for c in ([names, *zip(*columns)])]
        return pa.table(merged, names=out.names)

    return documents.groupBy("block").cogroup(encoded.groupBy("block")).applyInArrow(assemble, out)


def decode_documents(encoded: DataFrame, vocabulary: str, pattern: str) -> DataFrame:
    """(doc_id, bytes) of rows (doc_id, ids): the ids joined with the token-byte table, which every task
    holds, as it is as large as the vocabulary. Null ids give null bytes."""
    schema = StructType([encoded.schema["doc_id"], StructField("bytes", BinaryType())])

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = token_bytes(vocabulary, pattern)
        for batch in batches:
            values = [None if ids is None else decoded(ids, table) for ids in batch.column(1).to_pylist()]
            yield pa.record_batch([batch.column(0), pa.array(values, pa.binary())], names=schema.names)

    return encoded.select("doc_id", "ids").mapInArrow(decode, schema)
