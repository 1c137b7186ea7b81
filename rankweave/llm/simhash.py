"""Near-duplicates by SimHash: a hierarchical index over fingerprints in Gray order."""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType
from pyspark.sql.window import Window

from rankweave.llm.components import components
from rankweave.llm.forest import Forest
from rankweave.session import staged

SHINGLE = 3
DISTANCE = 3
SEED = 42

#: Distinct fingerprints that a group should have, and the most that meet in one task.
GROUP, TILE = 2_048, 16_384
#: Codes under a leaf, nodes under a node, and node pairs expanded at a time.
FANOUT, PAIRS = 8, 4_096

_digest = partial(xxhash.xxh64_intdigest, seed=SEED)


def fingerprint(text: str | None) -> int:
    """A 64-bit fingerprint as a signed integer: a bit is 1 if set in over half the shingle hashes.

    A-Z is lower-cased; words are what ASCII white space separates. Fewer than three words are one
    shingle, none give fingerprint zero, as do null and empty texts.
    """
    words = (text or "").encode("utf-8", "replace").lower().split()
    if not words:
        return 0
    shingles = zip(*(words[i:] for i in range(SHINGLE))) if len(words) >= SHINGLE else [words]
    hashes = np.fromiter(map(_digest, map(b" ".join, shingles)), dtype="<u8")
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), 1 << 16):
        part = hashes[at : at + (1 << 16)].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * ones > len(hashes), bitorder="little")
    return int(bits.view("<i8")[0])


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, text_hash, fingerprint) for every row of ``docs``."""
    picked = docs.select(F.col(doc_id).alias("doc_id"), F.xxhash64(text).alias("text_hash"), F.col(text).alias("text"))
    schema = StructType([*picked.schema.fields[:2], StructField("fingerprint", LongType())])

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes = pa.array([fingerprint(t.as_py()) for t in batch.column(2)], pa.int64())
            yield pa.record_batch([batch.column(0), batch.column(1), codes], names=schema.names)

    return picked.mapInArrow(hashed, schema)


def gray_rank(codes: np.ndarray) -> np.ndarray:
    """Place of each code in the reflected Gray sequence, in which neighbours differ in one bit."""
    rank = codes.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(shift)
    return rank


class GrayIndex:
    """Codes in Gray order under a tree whose nodes hold the bit pattern all codes below share.

    ``mask`` marks a node's shared bits and ``bits`` their values; a parent's pattern is part of its
    children's. Two nodes differ at least in the bits both have fixed to unlike values, a sum that only
    grows on the way down, so a pair of groups is left as soon as it exceeds the distance.
    """

    def __init__(self, codes: np.ndarray):
        self.order = np.argsort(gray_rank(codes), kind="stable")
        self.codes = codes[self.order]
        self.levels = [(self.codes, np.full(len(codes), ~np.uint64(0)))]
        while len(self.levels[-1][0]) > FANOUT:
            bits, mask = self.levels[-1]
            starts = np.arange(0, len(bits), FANOUT)
            ones = np.bitwise_and.reduceat(bits & mask, starts)
            any_one = np.bitwise_or.reduceat(bits & mask, starts)
            shared = np.bitwise_and.reduceat(mask, starts) & ~(ones ^ any_one)
            self.levels.append((ones & shared, shared))

    def matches(self, other: GrayIndex, distance: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Index pairs (into the codes given) at most ``distance`` bits apart; each pair of one index once."""
        top = len(self.levels) - 1, len(other.levels) - 1
        a, b = (x.ravel() for x in np.meshgrid(*(np.arange(len(t.levels[n][0])) for t, n in zip((self, other), top)), indexing="ij"))
        stack = [(*top, a, b)]
        while stack:
            at_a, at_b, a, b = stack.pop()
            if len(a) > PAIRS:
                stack += [(at_a, at_b, a[i : i + PAIRS], b[i : i + PAIRS]) for i in range(0, len(a), PAIRS)]
                continue
            if other is self:
                a, b = a[a <= b], b[a <= b]
            (bits_a, mask_a), (bits_b, mask_b) = self.levels[at_a], other.levels[at_b]
            apart = np.bitwise_count((bits_a[a] ^ bits_b[b]) & mask_a[a] & mask_b[b])
            near = apart <= distance
            a, b = a[near], b[near]
            if at_a == at_b == 0:
                if other is self:
                    a, b = a[a < b], b[a < b]
                yield self.order[a], other.order[b]
                continue
            a, b = self._below(at_a, a, b)
            if other is self:
                b, a = other._below(at_b, b, a)
                at_a, at_b = at_a - 1, at_b - 1
            else:
                at_a = max(0, at_a - 1)
                b, a = other._below(at_b, b, a)
                at_b = max(0, at_b - 1)
            stack.append((at_a, at_b, a, b))

    def _below(self, level: int, nodes: np.ndarray, partners: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if level == 0:
            return nodes, partners
        children = (nodes[:, None] * FANOUT + np.arange(FANOUT)).ravel()
        kept = children < len(self.levels[level - 1][0])
        return children[kept], np.repeat(partners, FANOUT)[kept]


def linked(frame: pd.DataFrame) -> pd.DataFrame:
    """(code, root) for the codes of one unit that link with a smaller one; every link inside the unit
    is tested, and each set of linked codes is returned as a star."""
    same = bool((frame["_i"] == frame["_j"]).all())
    codes = frame["fingerprint"].to_numpy()
    unsigned = codes.view(np.uint64)
    order = np.argsort(codes, kind="stable")
    place = np.empty_like(order)
    place[order] = np.arange(len(order))
    forest = Forest(len(codes))
    if same:
        index = GrayIndex(unsigned)
        parts = [(np.arange(len(codes)), index, np.arange(len(codes)), index)]
    else:
        left = np.flatnonzero(frame["_tile"].to_numpy() == frame["_i"].to_numpy())
        right = np.flatnonzero(frame["_tile"].to_numpy() == frame["_j"].to_numpy())
        parts = [(left, GrayIndex(unsigned[left]), right, GrayIndex(unsigned[right]))] if len(left) and len(right) else []
    for ids_a, index_a, ids_b, index_b in parts:
        for a, b in index_a.matches(index_b, DISTANCE):
            forest.link(place[ids_a[a]], place[ids_b[b]])
    roots = codes[order][forest.roots()]
    found = pd.DataFrame({"code": codes[order], "root": roots})
    return found[found["code"] != found["root"]]


def near_links(codes: DataFrame) -> DataFrame:
    """(code, root) edges that connect exactly the fingerprints connected by links of ``DISTANCE`` bits.

    ``codes`` has distinct values of ``fingerprint``. Two codes at most three bits apart agree in one of
    four 16-bit blocks, so each code goes to four groups, by the leading bits of each block, as many bits
    as give groups of about ``GROUP``. A group above ``TILE`` codes is dealt into tiles, and every pair of
    tiles meets in a task of its own. The counts by group are at most ``4 * 2 ** 16`` rows.
    """
    number = codes.count()
    bits = min(16, max(0, int(np.ceil(np.log2(max(1, number / GROUP))))))
    blocks = F.array(*[F.shiftrightunsigned("fingerprint", 16 * t).bitwiseAND(0xFFFF) for t in range(4)])
    dealt = codes.select("fingerprint", F.posexplode(blocks).alias("_table", "_block"))
    dealt = dealt.select("fingerprint", "_table", F.shiftright("_block", 16 - bits).alias("_key"))
    sizes = dealt.groupBy("_table", "_key").agg(F.ceil(F.count(F.lit(1)) / TILE).cast("int").alias("_tiles"))
    tiled = dealt.join(F.broadcast(sizes), ["_table", "_key"]).withColumn(
        "_tile", F.pmod(F.xxhash64("fingerprint"), F.col("_tiles")).cast("int")
    )
    met = tiled.withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_tiles") - 1)))
    units = met.select("_table", "_key", F.least("_tile", "_other").alias("_i"), F.greatest("_tile", "_other").alias("_j"), "_tile", "fingerprint")
    return units.groupBy("_table", "_key", "_i", "_j").applyInPandas(linked, "code long, root long")


def near_duplicates(prints: DataFrame) -> DataFrame:
    """Add ``component_id`` to staged rows of ``fingerprints``: the smallest doc_id reachable by links, and
    ``component``, which tells components apart.

    Equal fingerprints are one vertex, so copies never become pairs. A component whose ids are all null
    has a null id.
    """
    classes = staged(prints.groupBy("fingerprint").agg(F.min("doc_id").alias("first")), "fingerprints")
    found = components(near_links(classes.select("fingerprint")), "code", "root")
    named = classes.join(found, classes["fingerprint"] == found["vertex"], "left").select(
        "fingerprint", "first", F.coalesce("component", "fingerprint").alias("component")
    )
    named = staged(named, "fingerprint-components")
    smallest = staged(named.groupBy("component").agg(F.min("first").alias("component_id")), "component-ids")
    ids = staged(named.join(smallest, "component").select("fingerprint", "component", "component_id"), "fingerprint-ids")
    return prints.join(ids, "fingerprint")


def near_duplicate_ids(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, fingerprint, component_id) for every row of ``docs``; other columns are not read."""
    prints = staged(fingerprints(docs, doc_id, text), "simhash")
    return near_duplicates(prints).select("doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one_of_each(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The row of ``docs`` with the smallest id of all whose fingerprints links connect, columns unchanged.

    Texts without words all have fingerprint zero, so one of them stays; so do null and empty ones.
    """
    named = near_duplicates(staged(fingerprints(docs, doc_id, text), "simhash"))
    return keep_first(named, ["component"], docs, doc_id, text)


def keep_first(named: DataFrame, component: list[str], docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The row of ``docs`` with the smallest id of every component, columns unchanged.

    ``named`` has doc_id, text_hash and the columns ``component`` for every row. Of rows that share this
    id, the one with the smallest text hash stays, of repeated rows any one. Null ids come last. Only the
    ids and hashes kept meet the texts, by id, so a large group of copies is never gathered.
    """
    ranked = named.withColumn("_first", F.struct(F.col("doc_id").isNull().alias("_null"), "doc_id", "text_hash"))
    kept = ranked.groupBy(*component).agg(F.min("_first").alias("_first"))
    keys = staged(kept.select(row_key("_first.doc_id", "_first.text_hash")).distinct(), "kept")
    keyed = docs.withColumns({"_hash": F.xxhash64(text), "_id": F.col(doc_id)}).withColumn("_key", row_key("_id", "_hash"))
    once = Window.partitionBy("_key").orderBy(text)
    wanted = keyed.join(keys, "_key", "left_semi").withColumn("_nth", F.row_number().over(once)).where("_nth = 1")
    return wanted.select(*[F.col(f"`{c}`") for c in docs.columns])


def row_key(doc_id: str, text_hash: str | Column) -> Column:
    """A key that is never null, so that the join and the numbering after it share one shuffle."""
    hashed = F.col(text_hash) if isinstance(text_hash, str) else text_hash
    return F.concat_ws("|", hashed.cast("string"), F.col(doc_id).cast("string")).alias("_key")
