"""Hashed words of a text, as Arrow kernels.

Measured on the sf0.1 documents these need about a third of the core time of the same steps written with
higher-order SQL functions, which are interpreted lambda by lambda. Each batch is handled as
whole arrays; Python touches only the distinct words of a batch, to hash them. A word of a batch is held as
its four-byte code; the ten or so numbers it takes on its way are formed for ``PART_WORDS`` at a time.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

TERM_VECTOR = T.StructType(
    [
        T.StructField("terms", T.ArrayType(T.LongType())),
        T.StructField("tf", T.ArrayType(T.DoubleType())),
    ]
)
WORD_SETS = T.StructType(
    [
        T.StructField("words", T.ArrayType(T.LongType())),
        T.StructField("bigrams", T.ArrayType(T.LongType())),
    ]
)


#: Words of texts that are handled at once; a text with more is handled alone.
PART_WORDS = 1 << 17

#: From the number of texts, and row and code of every word, to one value for each text.
Part = Callable[[int, np.ndarray, np.ndarray], pa.Array]


def _by_part(texts: pa.Array, digits: int, encoder: Callable[[np.ndarray], Part]) -> pa.Array:
    """The values of ``texts``, made part by part from their coded words.

    ``encoder`` gets the hash (leading hex digits of md5) of every code. Arrow splits at Python's whitespace.
    """
    split = pc.utf8_split_whitespace(texts)
    lengths = pc.fill_null(pc.list_value_length(split), 0).to_numpy(zero_copy_only=False)
    coded = split.flatten().dictionary_encode()
    del split
    words = coded.dictionary.to_pylist()
    hashes = np.array(
        [int(hashlib.md5(w.encode()).hexdigest()[:digits], 16) for w in words], dtype=np.uint64
    )
    all_codes = coded.indices.to_numpy(zero_copy_only=False)
    blank = words.index("") if "" in words else -1  # from leading or trailing whitespace
    del words
    encode, parts = encoder(hashes), []
    ends = np.concatenate([[0], np.cumsum(lengths, dtype=np.int64)])
    cuts = [*np.flatnonzero(np.diff(ends[1:] // PART_WORDS)) + 1]
    for first, last in zip([0, *cuts], [*cuts, len(texts)]):
        codes = all_codes[ends[first] : ends[last]].astype(np.int64)
        row = np.repeat(np.arange(last - first), lengths[first:last])
        if blank >= 0:
            kept = codes != blank
            row, codes = row[kept], codes[kept]
        parts.append(encode(last - first, row, codes))
    return pa.concat_arrays(parts)


def _distinct(row: np.ndarray, code: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct codes (below ``size``) per row in ascending order, with their counts."""
    key = np.sort(row * size + code)
    starts = np.flatnonzero(np.diff(key, prepend=-1))
    return key[starts] // size, key[starts] % size, np.diff(np.append(starts, len(key)))


def _lists(rows: int, row: np.ndarray, values: pa.Array) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.searchsorted(row, np.arange(rows + 1)), pa.int32()), values)


def term_vector(text: Column, buckets: int | None = None) -> Column:
    """struct(terms, tf): the terms of the words, ascending, and how many words each stands for.

    The term of a word is the first 60 bits of its md5, so that a vocabulary of any size keeps its words
    apart; with ``buckets``, for dense vectors, it is that number modulo the bucket count.
    """

    def encoder(hashes: np.ndarray) -> Part:
        term_of = (hashes % buckets if buckets else hashes).astype(np.int64)
        known, place = np.unique(term_of, return_inverse=True)

        def encode(texts: int, row: np.ndarray, code: np.ndarray) -> pa.Array:
            row, term, count = _distinct(row, place[code], max(1, len(known)))
            terms = _lists(texts, row, pa.array(known[term], pa.int64()))
            tf = _lists(texts, row, pa.array(count.astype(np.float64)))
            return pa.StructArray.from_arrays([terms, tf], names=["terms", "tf"])

        return encode

    return F.arrow_udf(lambda texts: _by_part(texts, 15, encoder), TERM_VECTOR)(text)


def dense_terms(text: Column, dim: int) -> Column:
    """The counts of the words by bucket, ``dim`` of them, scaled to length one (zeros without words)."""

    def encoder(hashes: np.ndarray) -> Part:
        buckets = (hashes % np.uint64(dim)).astype(np.int64)

        def encode(texts: int, row: np.ndarray, code: np.ndarray) -> pa.Array:
            counts = np.bincount(row * dim + buckets[code], minlength=texts * dim).astype(np.float64).reshape(texts, dim)
            norms = np.sqrt(np.einsum("ij,ij->i", counts, counts))[:, None]
            unit = np.divide(counts, norms, out=np.zeros_like(counts), where=norms > 0)
            return pa.ListArray.from_arrays(pa.array(np.arange(texts + 1) * dim, pa.int32()), pa.array(unit.ravel()))

        return encode

    return F.arrow_udf(lambda texts: _by_part(texts, 15, encoder), T.ArrayType(T.DoubleType()))(text)


def word_sets(text: Column) -> Column:
    """struct(words, bigrams): the distinct words and adjacent word pairs as 64-bit hashes.

    Equal hashes stand for equal words; at 64 bits a chance collision inside one pair is negligible.
    """

    def encoder(hashes: np.ndarray) -> Part:
        size = len(hashes) + 1

        def encode(texts: int, row: np.ndarray, code: np.ndarray) -> pa.Array:
            at, word, _ = _distinct(row, code, size)
            words = _lists(texts, at, pa.array(hashes[word].view(np.int64)))
            adjacent = np.flatnonzero(row[1:] == row[:-1])
            at, pair, _ = _distinct(row[adjacent], code[adjacent] * size + code[adjacent + 1], size * size)
            mixed = hashes[pair // size] * np.uint64(0x9E3779B97F4A7C15) + hashes[pair % size]
            bigrams = _lists(texts, at, pa.array(mixed.view(np.int64)))
            return pa.StructArray.from_arrays([words, bigrams], names=["words", "bigrams"])

        return encode

    return F.arrow_udf(lambda texts: _by_part(texts, 16, encoder), WORD_SETS)(text)
