"""Vector arithmetic on array columns."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

SCORE_DECIMALS = 10


def _unit_rows(vectors: pa.Array) -> np.ndarray:
    lengths = vectors.value_lengths().to_numpy(zero_copy_only=False)
    if len(lengths) and (lengths != lengths[0]).any():
        raise ValueError("vectors of different lengths")
    flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    rows = flat.reshape(len(vectors), int(lengths[0]) if len(lengths) else 0)
    norms = np.sqrt(np.einsum("ij,ij->i", rows, rows))[:, None]
    return np.divide(rows, norms, out=np.zeros_like(rows), where=norms > 0)


def normalize(a: Column) -> Column:
    """Vectors of one length scaled to length one, as ``array<double>``; zeros stay zeros, null stays null."""

    def unit(vectors: pa.Array) -> pa.Array:
        known = vectors.drop_null()
        rows = _unit_rows(known)
        sizes = np.where(vectors.is_valid().to_numpy(zero_copy_only=False), rows.shape[1] if len(known) else 0, 0)
        offsets = pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32())
        return pa.ListArray.from_arrays(offsets, pa.array(rows.ravel()), mask=vectors.is_null() if vectors.null_count else None)

    return F.arrow_udf(unit, T.ArrayType(T.DoubleType()))(a)


def cosine(a: Column, b: Column) -> Column:
    """Cosine of two non-null vectors of one length, 0 where either is all zeros."""

    def cosines(left: pa.Array, right: pa.Array) -> pa.Array:
        return pa.array(np.einsum("ij,ij->i", _unit_rows(left), _unit_rows(right)))

    return F.arrow_udf(cosines, T.DoubleType())(a, b)


def weighted_dot(a: Column, b: Column, weights: Sequence[float]) -> Column:
    """sum(w * a * b) over the entries of two non-null vectors as long as ``weights``."""
    factors = np.array(weights, dtype=np.float64)

    def dots(left: pa.Array, right: pa.Array) -> pa.Array:
        rows = [v.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(v), -1) for v in (left, right)]
        return pa.array((rows[0] * rows[1]) @ factors if len(left) else np.zeros(0))

    return F.arrow_udf(dots, T.DoubleType())(a, b)


def term_cosine(a: Column, b: Column) -> Column:
    """Cosine of two structs of ``terms`` (ascending, distinct) and ``tf``, 0 where either has none."""

    def cosines(left: pa.Array, right: pa.Array) -> pa.Array:
        rows, terms, tf = [], [], []
        for side in (left, right):
            ids, counts = side.field("terms"), side.field("tf")
            lengths = ids.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
            rows.append(np.repeat(np.arange(len(side)), lengths))
            terms.append(ids.flatten().to_numpy(zero_copy_only=False))
            tf.append(counts.flatten().to_numpy(zero_copy_only=False))
        norms = [np.sqrt(np.bincount(r, weights=t * t, minlength=len(left))) for r, t in zip(rows, tf)]
        row, term, count = (np.concatenate(x) for x in (rows, terms, tf))
        order = np.lexsort((term, row))
        row, term, count = row[order], term[order], count[order]
        shared = np.flatnonzero((row[1:] == row[:-1]) & (term[1:] == term[:-1]))
        dots = np.bincount(row[shared], weights=count[shared] * count[shared + 1], minlength=len(left))
        scale = norms[0] * norms[1]
        return pa.array(np.divide(dots, scale, out=np.zeros(len(left)), where=scale > 0))

    return F.arrow_udf(cosines, T.DoubleType())(a, b)


def elementwise_product(a: Column, b: Column) -> Column:
    return F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))


def dense_from_terms(terms: Column, tf: Column, dim: int) -> Column:
    """Dense ``array<double>`` of ``dim`` entries from ascending buckets below ``dim`` and their counts."""
    n = F.size(terms)
    before = F.concat(F.array(F.lit(-1)), F.slice(terms, 1, F.greatest(n - 1, F.lit(0))))
    gaps = F.zip_with(terms, before, lambda t, p: t - p - 1)
    pieces = F.zip_with(gaps, tf, lambda g, v: F.concat(F.array_repeat(F.lit(0.0), g), F.array(v)))
    tail = F.array_repeat(F.lit(0.0), F.lit(dim - 1) - F.coalesce(F.get(terms, n - 1), F.lit(-1)))
    return F.when(n > 0, F.concat(F.flatten(pieces), tail)).otherwise(F.array_repeat(F.lit(0.0), dim))
