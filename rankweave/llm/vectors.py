"""Near-duplicate vectors by Euclidean p-stable hashing, each collision checked by its exact cosine."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from rankweave.llm.components import components
from rankweave.llm.forest import Forest
from rankweave.session import staged

COSINE = 0.98
#: Hash tables, projections in each, and the width of a projection's cells. Unit vectors with cosine 0.98
#: are 0.2 apart; a cell of 1.6 then holds both with probability 0.9, so one table with 0.9 ** 12 and at
#: least one of sixteen with 0.995. Nearer pairs are found more surely.
TABLES, PROJECTIONS, WIDTH = 16, 12, 1.6
SEED = 20
#: Members of a bucket that meet in one task; larger buckets are cut into tiles.
TILE = 2_048
#: Rows of a cosine block that are compared at a time.
STRIP = 256


def _family(dimension: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    rng = np.random.default_rng([SEED, dimension])
    directions = rng.normal(size=(dimension, TABLES * PROJECTIONS))
    shifts = rng.uniform(0, WIDTH, TABLES * PROJECTIONS)
    mixers = rng.integers(1, 1 << 62, size=PROJECTIONS, dtype=np.int64) * 2 + 1
    return directions, shifts, mixers


def buckets_of(vectors: np.ndarray) -> np.ndarray:
    """One bucket number per table for each row of ``vectors``."""
    directions, shifts, mixers = _family(vectors.shape[1])
    unit = vectors / np.linalg.norm(vectors, axis=1)[:, None]
    cells = np.floor((unit @ directions + shifts) / WIDTH).astype(np.int64)
    mixed = np.zeros((len(vectors), TABLES), dtype=np.int64)
    for i in range(PROJECTIONS):  # wraps around, which is what a hash wants
        mixed = (mixed ^ (mixed >> 29)) * mixers[i] + cells.reshape(-1, TABLES, PROJECTIONS)[:, :, i]
    return mixed


def vector_classes(rows: DataFrame, vec_id: str, vector: str, label: str) -> DataFrame:
    """(key, vec_id, label, vector) of the rows that can link: label and all components present and
    finite, and not all components zero. ``key`` is the same for equal vectors of one label."""
    values = F.col(vector).cast("array<double>")
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    fit = F.col(label).isNotNull() & F.coalesce(finite, F.lit(False)) & F.exists(vector, lambda x: x != 0)
    # -0.0 counts as 0.0
    key = F.md5(F.concat_ws(",", F.col(label).cast("string"), F.transform(values, lambda x: (x + 0.0).cast("string"))))
    return rows.select(F.col(vec_id).alias("vec_id"), F.when(fit, key).alias("key"), F.col(label).alias("label"), values.alias("vector"))


def _hashed(classes: DataFrame) -> DataFrame:
    schema = StructType([StructField("key", StringType()), StructField("buckets", ArrayType(LongType()))])

    def hash_batch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = batch.column(1).value_lengths().to_numpy(zero_copy_only=False)
            flat = batch.column(1).flatten().to_numpy(zero_copy_only=False)
            starts = np.cumsum(sizes) - sizes
            out = np.zeros((len(sizes), TABLES), dtype=np.int64)
            for size in np.unique(sizes):
                at = np.flatnonzero(sizes == size)
                out[at] = buckets_of(flat[starts[at][:, None] + np.arange(size)]) ^ size
            arrays = pa.ListArray.from_arrays(pa.array(np.arange(len(out) + 1) * TABLES, pa.int32()), pa.array(out.ravel()))
            yield pa.record_batch([batch.column(0), arrays], names=schema.names)

    return classes.select("key", "vector").mapInArrow(hash_batch, schema)


def _unit_links(frame: pd.DataFrame) -> pd.DataFrame:
    """For each class of a unit: the vectors it links with that no earlier table pairs it with, and the
    smallest class it is connected with."""
    keys, copies = frame["key"].to_numpy(), frame["copies"].to_numpy()
    order = np.argsort(keys)
    keys, copies, tile = keys[order], copies[order], frame["_tile"].to_numpy()[order]
    vectors = np.stack(frame["vector"].to_numpy())[order].astype(np.float64)
    buckets = np.stack(frame["buckets"].to_numpy())[order][:, : int(frame["_table"].iloc[0])]
    norms = np.linalg.norm(vectors, axis=1)
    same = frame["_i"].iloc[0] == frame["_j"].iloc[0]
    left = np.arange(len(keys)) if same else np.flatnonzero(tile == frame["_i"].iloc[0])
    right = left if same else np.flatnonzero(tile == frame["_j"].iloc[0])
    links, forest = np.zeros(len(keys), dtype=np.int64), Forest(len(keys))
    for at in range(0, len(left), STRIP):
        strip = left[at : at + STRIP]
        cosine = (vectors[strip] @ vectors[right].T) / (norms[strip][:, None] * norms[right])
        a, b = np.nonzero(cosine >= COSINE)
        a, b = strip[a], right[b]
        if same:
            a, b = a[a < b], b[a < b]
        new = ~(buckets[a] == buckets[b]).any(axis=1)
        a, b = a[new], b[new]
        np.add.at(links, a, copies[b])
        np.add.at(links, b, copies[a])
        forest.link(a, b)
    return pd.DataFrame({"key": keys, "links": links, "root": keys[forest.roots()]})


def _runs(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Units of sorted rows, each whole; the last of a batch may go on in the next."""
    names, kept = ["label", "_table", "_bucket", "_i", "_j"], None
    for batch in batches:
        frame = batch if kept is None else pd.concat([kept, batch], ignore_index=True)
        changes = np.ones(len(frame), dtype=bool)
        values = [frame[name].to_numpy() for name in names]  # compared as they are: hashes need all their bits
        changes[1:] = np.any([v[1:] != v[:-1] for v in values], axis=0)
        starts = np.flatnonzero(changes)
        for start, end in zip(starts, starts[1:]):
            yield frame.iloc[start:end]
        kept = frame.iloc[starts[-1] :] if len(starts) else kept
    if kept is not None and len(kept):
        yield kept


def _all_units(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    out, size = [], 0
    for unit in _runs(batches):
        found = _unit_links(unit)
        out.append(found[found["links"] > 0])
        size += len(unit)
        if size > 20_000:
            yield pd.concat(out)
            out, size = [], 0
    if out:
        yield pd.concat(out)


def near_vectors(rows: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label") -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every row of ``rows``.

    Vectors of one label with a cosine of at least ``COSINE`` link, if a hash table puts them in one
    bucket; copies always do. Rows that cannot link (see ``vector_classes``) stand alone, as do vectors of
    unlike dimension. ``component_id`` is the smallest id reachable, null if all are. Rows that repeat an
    id are vectors of their own. Other columns are not read.

    Equal vectors are one class with a count. Only buckets with two classes or more send vectors, one
    task takes at most two tiles of ``TILE`` classes, and returns a row per class, never per pair: a link
    is counted in the first table that pairs its ends.
    """
    marked = staged(vector_classes(rows, vec_id, vector, label), "vectors")
    grouped = marked.where("key is not null").groupBy("key").agg(
        F.min("vec_id").alias("first"), F.count(F.lit(1)).alias("copies"), F.first("label").alias("label"), F.first("vector").alias("vector")
    )
    classes = staged(grouped, "vector-classes")
    hashed = staged(classes.select("key", "label").join(_hashed(classes), "key"), "vector-buckets")
    places = hashed.select("key", "label", "buckets", F.posexplode("buckets").alias("_table", "_bucket"))
    bucket = ["label", "_table", "_bucket"]
    sizes = staged(places.groupBy(*bucket).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1"), "bucket-sizes")
    tiles = F.ceil(F.col("_n") / TILE).cast("int")
    tiled = places.join(sizes, bucket).withColumn("_tile", F.pmod(F.xxhash64("key"), tiles).cast("int"))
    met = tiled.withColumn("_other", F.explode(F.sequence(F.lit(0), tiles - 1)))
    units = met.select("key", "buckets", *bucket, F.least("_tile", "_other").alias("_i"), F.greatest("_tile", "_other").alias("_j"), "_tile")
    unit = [*bucket, "_i", "_j"]
    full = units.join(classes.select("key", "copies", "vector"), "key").repartition(*unit).sortWithinPartitions(*unit)
    found = staged(full.mapInPandas(_all_units, "key string, links long, root string"), "vector-links")
    linked = components(found.select("key", "root"), "key", "root")
    sums = found.groupBy("key").agg(F.sum("links").alias("links"))
    named = (
        classes.select("key", "first", "copies")
        .join(linked, classes["key"] == linked["vertex"], "left")
        .join(sums, "key", "left")
        .select("key", "first", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), F.coalesce("component", "key").alias("component"))
    )
    named = staged(named, "vector-components")
    smallest = staged(named.groupBy("component").agg(F.min("first").alias("component_id")), "vector-ids")
    ids = staged(named.join(smallest, "component").select("key", "n_links", "component_id"), "vector-results")
    alone = marked.where("key is null").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    together = marked.where("key is not null").select("key", "vec_id").join(ids, "key").select("vec_id", "n_links", "component_id")
    kept = F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)).alias("kept")
    return together.unionByName(alone).select("vec_id", "n_links", "component_id", kept)
