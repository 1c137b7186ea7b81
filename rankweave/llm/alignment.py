"""Two tokenizers side by side: where their token ends agree, which tokens overlap, and how common each link is."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, IntegerType, LongType, StringType, StructField, StructType
from tokenizers import Tokenizer

from rankweave.llm.blocks import pack_ints, ragged, unpack_ints
from rankweave.llm.wordbpe import BYTE_CHARS
from rankweave.session import staged

#: Bytes of text in a block, of which a longer text is not cut, and segments aligned at a time.
BLOCK_BYTES, ALIGNED = 12 << 20, 10_000
SPACE, MARK = 0x20, "▁"
#: Above any id of B.
SHIFT = 1 << 24
COUNTS = ("n_a", "n_b", "n_groups", "n_links")


def gallop(ends: np.ndarray, wanted: np.ndarray, low: np.ndarray, last: np.ndarray) -> np.ndarray:
    """For each wanted end the first place from ``low`` to ``last`` whose end is not below it: doubling
    steps, then a binary search between the last two. The end at ``last`` is never below."""
    low, high, step = low.copy(), low.copy(), 1
    far = np.flatnonzero(ends[high] < wanted)
    while len(far):
        low[far] = high[far] + 1
        high[far] = np.minimum(high[far] + step, last[far])
        step *= 2
        far = far[ends[high[far]] < wanted[far]]
    open_ = np.flatnonzero(low < high)
    while len(open_):
        middle = (low[open_] + high[open_]) >> 1
        below = ends[middle] < wanted[open_]
        low[open_[below]] = middle[below] + 1
        high[open_[~below]] = middle[~below]
        open_ = open_[low[open_] < high[open_]]
    return low


@dataclass
class Alignment:
    """Of two token lists laid end to end by segment: the group of each token (slices between common ends,
    numbered through), and all pairs of tokens whose bytes overlap."""

    group_short: np.ndarray
    group_long: np.ndarray
    link_short: np.ndarray
    link_long: np.ndarray


def align(ends_short: np.ndarray, sizes_short: np.ndarray, ends_long: np.ndarray, sizes_long: np.ndarray) -> Alignment:
    """Ends of the tokens of both sides, counted through all segments, and how many tokens each segment has
    of them. The shorter list drives the search in the longer one.

    The rank of an end is how many of the other's ends lie below it. A token overlaps the other's tokens
    from where its start ranks (one further on if the start is a common end) to where its end ranks.
    """
    after_long = np.cumsum(sizes_long)
    begun, last = (np.repeat(v, sizes_short) for v in (after_long - sizes_long, after_long - 1))
    at = gallop(ends_long, ends_short, begun, last)
    common = ends_long[at] == ends_short
    first = np.empty_like(at)
    first[:1] = 0
    first[1:] = at[:-1] + common[:-1]
    many = at - first + 1
    marks = np.zeros(len(ends_long), dtype=np.int64)
    marks[at[common]] = 1
    groups = [np.cumsum(v) - v for v in (common.astype(np.int64), marks)]
    return Alignment(*groups, np.repeat(np.arange(len(at)), many), ragged(first, many))


class Tokens:
    """Both tokenizers and the bytes of their tokens."""

    def __init__(self, path_a: str, path_b: str):
        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        of_char = {c: b for b, c in BYTE_CHARS.items()}
        self.bytes_a = {}
        for token, number in self.a.get_vocab(with_added_tokens=True).items():
            known = all(c in of_char for c in token)
            self.bytes_a[number] = bytes(of_char[c] for c in token) if known else token.encode()
        self.bytes_b = []
        for number in range(self.b.get_piece_size()):
            piece = self.b.id_to_piece(number)
            self.bytes_b.append(bytes([int(piece[3:-1], 16)]) if self.b.is_byte(number) else piece.replace(MARK, " ").encode())

        table = [self.bytes_a[i] for i in range(max(self.bytes_a) + 1)]
        self.bytes_a = table
        self.widths = [np.array([len(v) for v in t], dtype=np.int64) for t in (self.bytes_a, self.bytes_b)]
        #: Each id of A with a comma and a bar, then each of B with a comma and a semicolon.
        self.said = [f"{i}{c}" for t, mark in ((self.bytes_a, "|"), (self.bytes_b, ";")) for i in range(len(t)) for c in f",{mark}"]
        self.said_from, self.said_width = (0, 2 * len(self.bytes_a)), np.array([len(v) for v in self.said], dtype=np.int64)
        if any(MARK in self.b.id_to_piece(i).lstrip(MARK) for i in range(self.b.get_piece_size())):
            raise ValueError("a piece reaches over the space between words")

    def encode(self, segments: list[bytes]) -> Iterator[tuple[bytes, list[int], list[int]]]:
        """Each segment begins with a space, which B adds by itself, though not to an empty text: a lone
        space is what a text may end with."""
        if not segments:
            return iter(())
        texts = [s.decode("utf-8", "replace") for s in segments]
        found_a = self.a.encode_batch_fast(texts, add_special_tokens=False)
        found_b = self.b.encode([t[1:] for t in texts], num_threads=1)
        lone = [self.b.piece_to_id(MARK)]
        return zip(segments, (e.ids for e in found_a), (ids if len(t) > 1 else lone for t, ids in zip(texts, found_b)))


@dataclass
class Segments:
    """What segments give to their documents. ``whole`` is false where the tokens of one side do not make up
    the segment's bytes; such a segment has nothing else. ``links`` are id pairs, A's id times ``SHIFT`` and
    B's, ``texts`` the groups as decimal ids, closed by a semicolon."""

    names: list[bytes]
    whole: np.ndarray
    counts: np.ndarray
    links: np.ndarray
    texts: list[str]


def aligned(tokens: Tokens, names: list[bytes]) -> Segments:
    names, *ids = zip(*tokens.encode(names))
    sizes = [np.fromiter(map(len, i), dtype=np.int64, count=len(names)) for i in ids]
    flat = [np.fromiter(chain.from_iterable(i), dtype=np.int64, count=int(n.sum())) for i, n in zip(ids, sizes)]
    lengths = np.fromiter(map(len, names), dtype=np.int64, count=len(names))
    whole = np.ones(len(names), dtype=bool)
    for i, n, table, width in zip(flat, sizes, (tokens.bytes_a, tokens.bytes_b), tokens.widths):
        whole &= _summed(width[i], np.concatenate([[0], np.cumsum(n)])) == lengths
    for side, table in enumerate((tokens.bytes_a, tokens.bytes_b)):
        fits = np.repeat(whole, sizes[side])
        made = np.frombuffer(b"".join([table[i] for i in flat[side][fits].tolist()]), dtype=np.uint8)
        asked = np.frombuffer(b"".join([s for s, w in zip(names, whole.tolist()) if w]), dtype=np.uint8)
        owner = np.repeat(np.flatnonzero(whole), lengths[whole])
        whole[owner[made != asked]] = False
    of = [np.repeat(np.arange(len(names)), n) for n in sizes]
    order, parts = [], []
    for swapped in (False, True):
        # The side with fewer tokens in a segment leads.
        mine = whole & ((sizes[0] > sizes[1]) == swapped)
        sides = [(1, 0), (0, 1)][not swapped]
        kept = [flat[k][mine[of[k]]] for k in sides]
        many = [sizes[k][mine] for k in sides]
        base = np.repeat(np.cumsum(lengths[mine]) - lengths[mine], many[0]), np.repeat(np.cumsum(lengths[mine]) - lengths[mine], many[1])
        ends = [_ends(tokens.widths[k][i], n) + b for k, i, n, b in zip(sides, kept, many, base)]
        found = align(ends[0], many[0], ends[1], many[1])
        groups = {sides[0]: found.group_short, sides[1]: found.group_long}
        links = {sides[0]: kept[0][found.link_short], sides[1]: kept[1][found.link_long]}
        after = {k: np.cumsum(n) for k, n in zip(sides, many)}
        per_segment = np.searchsorted(found.link_short, np.concatenate([[0], after[sides[0]]]))
        n_groups = _summed(np.diff(groups[0], append=groups[0][-1:] + 1), np.concatenate([[0], after[0]]))
        counts = np.stack([sizes[0][mine], sizes[1][mine], n_groups, np.diff(per_segment)], axis=1)
        texts = _texts(tokens, dict(zip(sides, kept)), groups, after)
        order.append(np.flatnonzero(mine))
        parts.append((counts, links[0] * SHIFT + links[1], texts))
    odd = np.flatnonzero(~whole)
    listed = np.concatenate([*order, odd])
    return Segments(
        [names[i] for i in listed.tolist()],
        whole[listed],
        np.concatenate([*[p[0] for p in parts], np.zeros((len(odd), 4), dtype=np.int64)]),
        np.concatenate([p[1] for p in parts]),
        [*parts[0][2], *parts[1][2], *[""] * len(odd)],
    )


def _ends(widths: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Ends of tokens inside their segments."""
    ends = np.cumsum(widths)
    firsts = np.cumsum(sizes) - sizes
    return ends - np.repeat(np.concatenate([[0], ends])[firsts], sizes)


def _texts(tokens: Tokens, ids: dict[int, np.ndarray], groups: dict[int, np.ndarray], after: dict[int, np.ndarray]) -> list[str]:
    """The groups of each segment: ids of A by commas, a bar, ids of B by commas, a semicolon."""
    number = int(groups[0][-1]) + 1 if len(groups[0]) else 0
    per_group = [np.bincount(groups[k], minlength=number) for k in (0, 1)]
    before = [np.concatenate([[0], np.cumsum(n)]) for n in per_group]
    code = np.empty(len(ids[0]) + len(ids[1]), dtype=np.int64)
    for k in (0, 1):
        last = np.diff(groups[k], append=number) > 0
        at = np.arange(len(ids[k])) + before[1 - k][groups[k] + k]
        code[at] = tokens.said_from[k] + 2 * ids[k] + last
    said = "".join([tokens.said[c] for c in code.tolist()])
    ends = np.concatenate([[0], np.cumsum(tokens.said_width[code])])[after[0] + after[1]].tolist()
    return [said[low:high] for low, high in zip([0, *ends], ends)]


def segments(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Segments of " " + text as bytes, and where each text's begin; empty and null texts have none.

    A segment begins at a space after anything but white space. Neither tokenizer has a token across such
    a place, nor looks further there, so what it makes of a text is what it makes of the segments in turn.
    """
    texts = texts.fill_null("")
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    data = np.frombuffer(texts.buffers()[2] or b"", dtype=np.uint8)[offsets[0] : offsets[-1]]
    offsets = offsets - offsets[0]
    filled = offsets[1:] > offsets[:-1]
    data = np.insert(data, offsets[:-1][filled], SPACE)
    begins = (offsets[:-1] + np.cumsum(filled) - filled)[filled]
    at = np.flatnonzero(data == SPACE)
    last, before = data[np.maximum(at - 1, 0)], data[np.maximum(at - 2, 0)]
    # White space beyond ASCII ends in these bytes; some other characters do as well, which does no harm.
    spaced = (last <= SPACE) | ((before == 0xC2) & ((last == 0x85) | (last == 0xA0))) | (np.isin(before, (0x80, 0x81, 0x9A)) & (last >= 0x80))
    cut = np.zeros(len(data) + 1, dtype=bool)
    cut[at[~spaced]] = True
    cut[begins] = True
    cut[len(data)] = len(data) > 0
    cuts = np.flatnonzero(cut)
    ends = cuts.astype(np.int32) if len(cuts) else np.zeros(1, dtype=np.int32)
    parts = pa.Array.from_buffers(pa.binary(), len(ends) - 1, [None, pa.py_buffer(ends), pa.py_buffer(data)])
    starts = np.full(len(texts), -1, dtype=np.int64)
    starts[filled] = np.searchsorted(cuts, begins)
    empty = np.flatnonzero(~filled)
    following = np.append(starts, len(parts))
    for k in empty[::-1].tolist():
        following[k] = following[k + 1]
    return parts, following


class _Block:
    """Segments of some texts by number, with their links as numbers of id pairs."""

    def __init__(self):
        self.numbers: dict[bytes, int] = {}
        self.pairs: dict[int, int] = {}
        self.whole, self.links = np.zeros(0, dtype=bool), np.zeros(0, dtype=np.int64)
        self.counts = np.zeros((0, 4), dtype=np.int64)
        self.texts: list[str] = []

    def add(self, found: Segments) -> None:
        numbers, pairs = self.numbers, self.pairs
        for name in found.names:
            numbers[name] = len(numbers)
        different, at = np.unique(found.links, return_inverse=True)
        named = np.array([pairs.setdefault(p, len(pairs)) for p in different.tolist()], dtype=np.int64)
        self.whole = np.concatenate([self.whole, found.whole])
        self.links = np.concatenate([self.links, named[at]])
        self.counts = np.concatenate([self.counts, found.counts])
        self.texts += found.texts

    def link_sizes(self) -> np.ndarray:
        return self.counts[:, 3]


def _summed(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Sums between neighbouring starts, of which there is one more than sums."""
    sums = np.concatenate([[0], np.cumsum(values)])
    return sums[starts[1:]] - sums[starts[:-1]]


def _blocks(docs: DataFrame, path_a: str, path_b: str, block_bytes: int) -> DataFrame:
    """Rows of three kinds: documents as segment numbers with what no other block adds to, the links of a
    block's segments, and its id pairs with the number of documents that hold them."""
    id_type = docs.schema["doc_id"].dataType
    longs = [StructField(c, ArrayType(LongType())) for c in (*COUNTS, "sizes")]
    blobs = [StructField(c, BinaryType()) for c in ("segments", "link_sizes", "links")]
    ints = [StructField(c, IntegerType()) for c in ("pair", "a", "b")]
    schema = StructType(
        [StructField("block", StringType()), StructField("doc_ids", ArrayType(id_type)), *longs, StructField("shas", ArrayType(StringType())), *blobs, *ints, StructField("docs", LongType())]
    )

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        tokens = Tokens(path_a, path_b)
        partition, serial, block, size = TaskContext.get().partitionId(), 0, _Block(), 0
        per_pair = np.zeros(0, dtype=np.int64)
        kinds = None

        def rows(number: int, **columns: pa.Array) -> pa.RecordBatch:
            full = {f.name: columns.get(f.name, pa.nulls(number, kinds[f.name])) for f in schema.fields[1:]}
            return pa.record_batch({"block": pa.array([f"{partition}-{serial}"] * number), **full})

        def documents(batch: pa.RecordBatch) -> pa.RecordBatch:
            nonlocal per_pair
            parts, starts = segments(batch.column(1))
            coded = parts.dictionary_encode()
            listed = coded.dictionary.to_pylist()
            new = [s for s in listed if s not in block.numbers]
            for low in range(0, len(new), ALIGNED):
                block.add(aligned(tokens, new[low : low + ALIGNED]))
            named = np.array([block.numbers[s] for s in listed], dtype=np.int64)
            at = named[coded.indices.to_numpy(zero_copy_only=False)] if len(listed) else np.zeros(0, dtype=np.int64)
            counts, texts, shas = block.counts, block.texts, []
            bad = _summed(~block.whole[at], starts) > 0
            for low, high, odd in zip(starts[:-1].tolist(), starts[1:].tolist(), bad.tolist()):
                said = "" if odd else "".join([texts[i] for i in at[low:high].tolist()])
                shas.append(hashlib.sha256(said[:-1].encode()).hexdigest() if said else "")
            sizes = np.where(bad, 0, starts[1:] - starts[:-1])
            at = at[ragged(starts[:-1], sizes)]
            begun = np.concatenate([[0], np.cumsum(sizes)])
            # Each document counts once for a pair, however often it links it.
            owner = np.repeat(np.arange(len(sizes)), sizes)
            owner, used = np.divmod(np.unique(owner * (len(texts) + 1) + at), len(texts) + 1)
            link_sizes, links = block.link_sizes(), block.links
            first = np.cumsum(link_sizes) - link_sizes
            held = links[ragged(first[used], link_sizes[used])]
            owner = np.repeat(owner, link_sizes[used])
            once = np.unique(owner * (len(block.pairs) + 1) + held) % (len(block.pairs) + 1)
            found = np.bincount(once, minlength=len(block.pairs))
            found[: len(per_pair)] += per_pair
            per_pair = found
            whole_batch = lambda v, k: pa.ListArray.from_arrays(pa.array([0, len(v)], pa.int32()), pa.array(v, k) if k else v)
            return rows(
                1,
                doc_ids=whole_batch(batch.column(0), None),
                **{c: whole_batch(_summed(counts[:, k][at], begun), pa.int64()) for k, c in enumerate(COUNTS)},
                sizes=whole_batch(sizes, pa.int64()),
                shas=whole_batch(shas, pa.string()),
                segments=pa.array([pack_ints(at)], pa.binary()),
            )

        def finished() -> Iterator[pa.RecordBatch]:
            yield rows(1, link_sizes=pa.array([pack_ints(block.link_sizes())], pa.binary()), links=pa.array([pack_ints(block.links)], pa.binary()))
            listed = np.flatnonzero(per_pair)
            codes = np.array(list(block.pairs), dtype=np.int64)[listed]
            pairs = np.stack(np.divmod(codes, SHIFT), axis=1).astype(np.int32)
            for low in range(0, len(listed), 50_000):
                part = slice(low, low + 50_000)
                yield rows(len(listed[part]), pair=pa.array(listed[part].astype(np.int32)), a=pa.array(pairs[part, 0]), b=pa.array(pairs[part, 1]), docs=pa.array(per_pair[listed[part]]))

        for batch in batches:
            if kinds is None:
                listed = pa.list_(pa.int64())
                kinds = {"doc_ids": pa.list_(batch.column(0).type), **dict.fromkeys((*COUNTS, "sizes"), listed), "shas": pa.list_(pa.string())}
                kinds |= dict.fromkeys(("segments", "link_sizes", "links"), pa.binary()) | dict.fromkeys(("pair", "a", "b"), pa.int32()) | {"docs": pa.int64()}
            yield documents(batch)
            size += batch.column(1).nbytes
            if size > block_bytes:
                yield from finished()
                serial, block, size, per_pair = serial + 1, _Block(), 0, np.zeros(0, dtype=np.int64)
        if size or block.numbers:
            yield from finished()

    return docs.mapInArrow(split, schema)


def align_documents(
    docs: DataFrame, path_a: str, path_b: str, doc_id: str = "doc_id", text: str = "text", block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """How the tokens of a byte-level vocabulary A and a sentence-piece vocabulary B lie over each other.

    A encodes " " + text, B the text, before which it puts the space itself; strings of special tokens are
    plain text. Returns doc_id, ``n_a`` and ``n_b`` tokens, ``n_groups`` (slices between common ends),
    ``n_links`` (pairs of tokens whose bytes overlap), ``n_best``, ``count_sum`` and ``groups_sha256``. The
    count of an id pair is the number of documents that link it; ``count_sum`` adds it over a document's
    links, and ``n_best`` counts those links whose count is the highest of their A id, ties included.

    Texts that are null or empty, or whose bytes one side's tokens do not give back, have no tokens: zeros
    and an empty digest, and they count for no pair. Rows that repeat an id are documents of their own;
    other columns are not read.

    A block is some ``block_bytes`` of text: its documents are runs of numbers into its different segments, which are
    aligned once. Its id pairs are rows with one count for each block, so that a pair of every document costs
    no more rows than there are blocks; totals go back to the blocks by a join.
    """
    picked = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    blocks = staged(_blocks(picked, path_a, path_b, block_bytes), "alignment")
    pairs = blocks.where("pair is not null").select("block", "pair", "a", "b", "docs")
    totals = pairs.groupBy("a", "b").agg(F.sum("docs").alias("count"))
    highest = totals.groupBy("a").agg(F.max("count").alias("_most"))
    rated = totals.join(highest, "a").select("a", "b", "count", (F.col("count") == F.col("_most")).alias("best"))
    back = pairs.select("block", "pair", "a", "b").join(rated, ["a", "b"]).select(F.col("block").alias("block"), "pair", "count", "best")
    texts = blocks.where("pair is null").drop("pair", "a", "b", "docs")
    id_field = picked.schema["doc_id"]
    schema = StructType([id_field, *[StructField(c, LongType()) for c in (*COUNTS, "n_best", "count_sum")], StructField("groups_sha256", StringType())])

    def summed(texts: pa.Table, back: pa.Table) -> pa.Table:
        own = texts.filter(texts["links"].is_valid())
        link_sizes, links = (unpack_ints(own[c][0].as_py()) for c in ("link_sizes", "links"))
        size = int(links.max(initial=-1)) + 1
        count, best = np.zeros(size, dtype=np.int64), np.zeros(size, dtype=np.int64)
        at = back["pair"].to_numpy()
        count[at], best[at] = back["count"].to_numpy(), back["best"].to_numpy()
        starts = np.concatenate([[0], np.cumsum(link_sizes)])
        per_segment = [_summed(v[links], starts) for v in (best, count)]
        out = []
        documents = texts.filter(texts["doc_ids"].is_valid())
        for k in range(len(documents)):
            row = {c: documents[c][k].values for c in ("doc_ids", *COUNTS, "sizes", "shas")}
            used = unpack_ints(documents["segments"][k].as_py())
            begun = np.concatenate([[0], np.cumsum(row["sizes"].to_numpy())])
            sums = [pa.array(_summed(v[used], begun)) for v in per_segment]
            out.append(pa.table([row["doc_ids"], *[row[c] for c in COUNTS], *sums, row["shas"]], names=schema.names))
        return pa.concat_tables(out)

    return texts.groupBy("block").cogroup(back.groupBy("block")).applyInArrow(summed, schema)
