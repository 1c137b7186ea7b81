"""Phrases whose words occur together more often than apart, for each language."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rankweave.llm.blocks import bucketed_words, pack_ints, unpack_ints, word_list
from rankweave.llm.hattrie import LONGEST, HatTrie, packed_rows, summed_rows, unpacked_rows
from rankweave.operators.joins import salted_join
from rankweave.session import staged

#: A phrase or word that occurs less often is no candidate, nor part of one. Phrases kept for a language.
LEAST, SHOWN = 100, 2000
UNKNOWN = "und"
#: Bytes of text in a block, words fed to a trie at a time, and rows that a merge holds before it adds up equal ones.
BLOCK_BYTES, FED, MERGED = 16 << 20, 1 << 18, 1_000_000
#: Word buckets, and prefix partitions, for each shuffle partition.
PARTS = 4
WORD, BLANK, BREAK = 0, 1, 2
KINDS = np.zeros(256, dtype=np.uint8)
KINDS[[0x20, 0x09]] = BLANK
KINDS[[*b".,;:!?", *range(0x0A, 0x0E)]] = BREAK
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32


def words_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The words of all texts, ASCII letters in lower case, and where one begins a piece. Null is empty."""
    texts = texts.fill_null("")
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    data = np.frombuffer(texts.buffers()[2] or b"", dtype=np.uint8)[offsets[0] : offsets[-1]]
    data = LOWER[np.insert(data, offsets[1:] - offsets[0], ord("\n"))]
    kinds = KINDS[data]
    inside = kinds == WORD
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    starts = np.flatnonzero(begins)
    pieces = np.cumsum(kinds == BREAK, dtype=np.int32)[starts]
    first = np.ones(len(starts), dtype=bool)
    first[1:] = pieces[1:] != pieces[:-1]
    kept = data[inside]
    ends = np.append(np.cumsum(inside, dtype=np.int64)[starts] - 1, len(kept)).astype(np.int32)
    return pa.Array.from_buffers(pa.string(), len(starts), [None, pa.py_buffer(ends), pa.py_buffer(kept)]), first


def _word_rows(numbers: dict[str, dict[str, int]], counts: np.ndarray, buckets: int) -> Iterator[tuple]:
    """(bucket, numbers, counts, words) of a block's different words, each with its language before it."""
    words = [f"{lang}\0{word}".encode() for lang, known in numbers.items() for word in known]
    at = np.fromiter((n for known in numbers.values() for n in known.values()), dtype=np.int64, count=len(words))
    yield from bucketed_words(words, at, counts, buckets)


def _blocks(docs: DataFrame, block_bytes: int, buckets: int) -> DataFrame:
    """Rows of two kinds: the words of a block's texts in order (``body``), as numbers above 0 and 0 where a
    piece begins, and for each hash bucket its different words with their numbers and counts."""
    names = ["block", "body", "bucket", "numbers", "counts", "words"]

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        partition, serial, size = TaskContext.get().partitionId(), 0, 0
        numbers: dict[str, dict[str, int]] = {}
        counts = np.zeros(1, dtype=np.int64)

        def row(body=None, bucket=None, *blobs: bytes) -> pa.RecordBatch:
            values = [f"{partition}-{serial}", body, bucket, *(blobs or [None] * 3)]
            kinds = [pa.string(), pa.binary(), pa.int32(), *[pa.binary()] * 3]
            return pa.record_batch([pa.array([v], k) for v, k in zip(values, kinds)], names=names)

        def finished() -> Iterator[pa.RecordBatch]:
            for found in _word_rows(numbers, counts, buckets):
                yield row(None, *found)

        for batch in batches:
            langs = pc.fill_null(batch.column(0), UNKNOWN)
            for lang in pc.unique(langs).to_pylist():
                texts = batch.column(1).filter(pc.equal(langs, lang))
                words, first = words_of(texts)
                coded = words.dictionary_encode()
                known = numbers.setdefault(lang, {})
                listed = coded.dictionary.to_pylist()
                total = sum(map(len, numbers.values()))
                new = [w for w in listed if w not in known]
                known.update(zip(new, range(total + 1, total + 1 + len(new))))
                named = np.array([known[w] for w in listed], dtype=np.int64)
                at = named[coded.indices.to_numpy(zero_copy_only=False)] if len(listed) else np.zeros(0, dtype=np.int64)
                found = np.bincount(at, minlength=total + 1 + len(new))
                found[: len(counts)] += counts
                counts = found
                if len(at):
                    yield row(pack_ints(np.insert(at, np.flatnonzero(first), 0)))
            size += batch.column(1).nbytes
            if size > block_bytes:
                yield from finished()
                serial, size, numbers, counts = serial + 1, 0, {}, np.zeros(1, dtype=np.int64)
        yield from finished()

    return docs.mapInArrow(split, "block string, body binary, bucket int, numbers binary, counts binary, words binary")


def _numbered(words: DataFrame, buckets: int, least: int) -> DataFrame:
    """Rows of three kinds, from the words of each hash bucket: for each block the numbers and ids of its
    frequent words (``body``), every frequent word (id, lang, word, a), and counts of all words of a
    language (lang, a).

    The words of one bucket are held until the next begins.
    """
    names = ["block", "body", "id", "lang", "word", "a"]
    kinds = [pa.string(), pa.binary(), pa.int64(), pa.string(), pa.string(), pa.int64()]

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, held, total = None, [], Counter()

        def rows(*columns: list) -> pa.RecordBatch:
            return pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

        def bucket() -> Iterator[pa.RecordBatch]:
            frequent = sorted(w for w, n in total.items() if n >= least)
            ids = {w: 1 + current + buckets * k for k, w in enumerate(frequent)}
            for block, at, body in held:
                own = [ids.get(w, 0) for w in word_list(body)]
                found = np.stack([unpack_ints(at), np.array(own, dtype=np.int64)], axis=1)
                yield rows([block], [packed_rows(found[found[:, 1] > 0])], *[[None]] * 4)
            split = [w.decode().split("\0", 1) for w in frequent]
            n = len(frequent)
            yield rows([None] * n, [None] * n, list(ids.values()), [p[0] for p in split], [p[1] for p in split], [total[w] for w in frequent])
            per_lang = Counter()
            for word, count in total.items():
                per_lang[word.split(b"\0", 1)[0].decode()] += count
            yield rows(*[[None] * len(per_lang)] * 3, list(per_lang), [None] * len(per_lang), list(per_lang.values()))

        for batch in batches:
            for block, at, counts, body, own in zip(*[c.to_pylist() for c in batch.columns]):
                if own != current:
                    if held:
                        yield from bucket()
                    current, held, total = own, [], Counter()
                held.append((block, at, body))
                for word, count in zip(word_list(body), unpack_ints(counts).tolist()):
                    total[word] += count
        if held:
            yield from bucket()

    dealt = words.select("block", "numbers", "counts", "words", "bucket").repartition("bucket").sortWithinPartitions("bucket")
    return dealt.mapInArrow(number, "block string, body binary, id long, lang string, word string, a long")


def _mixed(rows: np.ndarray, columns: int) -> np.ndarray:
    """A hash of the first ids of each row."""
    out = np.zeros(len(rows), dtype=np.uint64)
    for c in range(columns):
        out = (out ^ rows[:, c].astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        out ^= out >> np.uint64(29)
    return out


def paths_of(codes: np.ndarray, linked: np.ndarray | None = None, shortest: int = 2) -> np.ndarray:
    """From each place the longest path of codes above 0, ``LONGEST`` at most, filled up with 0; shorter ones
    than ``shortest`` are left out. ``linked`` tells which places may be followed by the next one."""
    longer = np.concatenate([codes, np.zeros(LONGEST - 1, dtype=codes.dtype)])
    links = np.ones(len(longer), dtype=bool)
    if linked is not None:
        links[: len(codes)] = linked
    columns = [codes]
    for k in range(1, LONGEST):
        columns.append(np.where((columns[-1] > 0) & links[k - 1 : k - 1 + len(codes)], longer[k : k + len(codes)], 0))
    kept = columns[shortest - 1] > 0
    return np.stack([c[kept] for c in columns], axis=1)


def _coded(texts: pa.Table, back: pa.Table) -> tuple[list[np.ndarray], np.ndarray]:
    """The words of a block as codes in the order of ids, 0 for rare words and gaps, and the ids by code."""
    found = [unpacked_rows(b.as_py()) for b in back["body"]]
    numbers, ids = np.concatenate([np.zeros((0, 2), dtype=np.int64), *found]).T
    order = np.argsort(ids)
    codes = np.zeros(int(numbers.max(initial=0)) + 1, dtype=np.uint32)
    codes[numbers[order]] = np.arange(1, len(ids) + 1)
    texts_of = []
    for body in texts["body"]:
        at = unpack_ints(body.as_py())
        texts_of.append(np.where(at < len(codes), codes[np.minimum(at, len(codes) - 1)], 0).astype(np.uint32))
    return texts_of, np.concatenate([[0], ids[order]])


def _counted(texts: list[np.ndarray], ids: np.ndarray, linked: list[np.ndarray] | None, prefix: int, parts: int) -> Iterator[tuple[int, bytes]]:
    """Sorted runs of a block's paths, from a trie, by the partition of their first ``prefix`` words. With no
    links only pairs are counted."""
    trie = HatTrie()

    def spilled(everything: bool) -> Iterator[tuple[int, bytes]]:
        run = trie.spilled(everything)
        run[:, :LONGEST] = ids[run[:, :LONGEST]]
        part = (_mixed(run, prefix) % np.uint64(parts)).astype(np.int64)
        by_part = np.argsort(part, kind="stable")
        ends = np.searchsorted(part[by_part], np.arange(parts + 1))
        kept = run if linked is not None else run[:, [0, 1, LONGEST]]
        for k in np.flatnonzero(np.diff(ends)).tolist():
            yield k, packed_rows(kept[by_part[ends[k] : ends[k + 1]]])

    for at, codes in enumerate(texts):
        for low in range(0, len(codes), FED):
            # Paths begin at these places and may reach beyond the last.
            piece = codes[low : low + FED + LONGEST - 1]
            links = None if linked is None else linked[at][low : low + len(piece)]
            paths = paths_of(piece, links, prefix)
            if len(piece) > FED:
                beyond = paths_of(piece[FED:], None if links is None else links[FED:], prefix)
                paths = paths[: len(paths) - len(beyond)]
            if linked is None:
                paths[:, 2:] = 0
            trie.add(paths)
            if trie.full():
                yield from spilled(False)
    yield from spilled(True)


RUNS = "block string, part int, body binary"


def _run_table(block: str, runs: Iterator[tuple[int, bytes]]) -> pa.Table:
    parts, bodies = [], []
    for part, body in runs:
        parts.append(part)
        bodies.append(body)
    return pa.table([pa.array([block] * len(parts), pa.string()), pa.array(parts, pa.int32()), pa.array(bodies, pa.binary())], names=["block", "part", "body"])


def _pair_runs(texts: DataFrame, back: DataFrame, parts: int) -> DataFrame:
    """The pairs of frequent words of each block, as sorted runs by a hash of the two."""

    def count(texts: pa.Table, back: pa.Table) -> pa.Table:
        if not len(texts):
            return _run_table("", iter(()))
        codes, ids = _coded(texts, back)
        return _run_table(texts["block"][0].as_py(), _counted(codes, ids, None, 2, parts))

    return texts.groupBy("block").cogroup(back.groupBy("block")).applyInArrow(count, RUNS)


def _path_runs(texts: DataFrame, back: DataFrame, parts: int) -> DataFrame:
    """Paths of three words and more whose pairs are all frequent, by a hash of the first three: all that
    follows a very common pair is dealt out as far as a third word tells it apart. ``back`` has a block's
    frequent words (kind 1) and pairs (kind 2)."""

    def count(texts: pa.Table, back: pa.Table) -> pa.Table:
        if not len(texts):
            return _run_table("", iter(()))
        kind = back["kind"].to_numpy()
        codes, ids = _coded(texts, back.filter(pa.array(kind == 1)))
        found = [unpacked_rows(b.as_py()) for b in back.filter(pa.array(kind == 2))["body"]]
        pairs = np.searchsorted(ids, np.concatenate([np.zeros((0, 2), dtype=np.int64), *found]))
        known = np.unique(pairs[:, 0] * len(ids) + pairs[:, 1])
        linked = []
        for c in codes:
            wide = np.append(c, 0).astype(np.int64)
            pair = wide[:-1] * len(ids) + wide[1:]
            place = np.minimum(np.searchsorted(known, pair), max(len(known) - 1, 0))
            linked.append(known[place] == pair if len(known) else np.zeros(len(c), dtype=bool))
        return _run_table(texts["block"][0].as_py(), _counted(codes, ids, linked, 3, parts))

    return texts.groupBy("block").cogroup(back.groupBy("block")).applyInArrow(count, RUNS)


def _keys(ids: np.ndarray) -> list[bytes]:
    return np.ascontiguousarray(ids.astype(">i8")).view(f"V{8 * ids.shape[1]}").ravel().tolist()


def _merged(runs: DataFrame, prefix: int, least: int) -> DataFrame:
    """Rows (key, size, a): phrases of ``prefix`` words and more that occur ``least`` times, the key eight bytes
    a word. For pairs also rows (block, body): the frequent ones among those that the block has.

    The runs of one partition are merged together; equal rows are added up whenever ``MERGED`` are held.
    """
    names = ["block", "body", "key", "size", "a"]
    kinds = [pa.string(), pa.binary(), pa.binary(), pa.int32(), pa.int64()]

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, held, size, bodies = None, [], 0, []

        def rows(*columns: list) -> pa.RecordBatch:
            return pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

        def phrases() -> Iterator[pa.RecordBatch]:
            merged = summed_rows(np.concatenate(held))
            changed = np.zeros(len(merged), dtype=bool)
            changed[:1] = True
            for k in range(merged.shape[1] - 1):
                changed[1:] |= merged[1:, k] != merged[:-1, k]
                if k + 1 < prefix:
                    continue
                starts = np.flatnonzero(changed)
                counts = np.add.reduceat(merged[:, -1], starts)
                kept = (counts >= least) & (merged[starts, k] > 0)
                found = merged[starts[kept], : k + 1]
                n = len(found)
                yield rows([None] * n, [None] * n, _keys(found), [k + 1] * n, counts[kept].tolist())
            if prefix == 2:
                frequent = set(_keys(found))
                for block, body in bodies:
                    own = unpacked_rows(body)[:, :2]
                    own = own[[key in frequent for key in _keys(own)]]
                    if len(own):
                        yield rows([block], [packed_rows(own)], [None], [None], [None])

        for batch in batches:
            for block, part, body in zip(*[c.to_pylist() for c in batch.columns]):
                if part != current:
                    if held:
                        yield from phrases()
                    current, held, size, bodies = part, [], 0, []
                if prefix == 2:
                    bodies.append((block, body))
                held.append(unpacked_rows(body))
                size += len(held[-1])
                if size > MERGED:
                    held = [summed_rows(np.concatenate(held))]
                    size = len(held[0])
        if held:
            yield from phrases()

    dealt = runs.repartition("part").sortWithinPartitions("part")
    return dealt.mapInArrow(merge, "block string, body binary, key binary, size int, a long")


def phrase_counts(docs: DataFrame, least: int = LEAST, text: str = "text", lang: str = "lang", block_bytes: int = BLOCK_BYTES) -> tuple[DataFrame, DataFrame]:
    """Words (id, lang, word, a, n) and phrases (key, size, a) that occur at least ``least`` times in a language.

    ``n`` counts all words of the language. A phrase is a run of two to five words inside a piece; its key
    is made of its words' ids. A phrase cannot occur more often than its words or pairs: only frequent words get
    an id, and longer phrases are counted only along frequent pairs. Each block counts its paths in a trie and spills
    sorted runs, which are merged by prefix partition; what is frequent goes back to the blocks that have it.
    """
    buckets = PARTS * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    picked = docs.select(F.col(lang).cast("string").alias("lang"), F.col(text).alias("text"))
    blocks = staged(_blocks(picked, block_bytes, buckets), "phrase-blocks")
    numbered = staged(_numbered(blocks.where("bucket is not null"), buckets, least), "phrase-words")
    per_lang = numbered.where("block is null and id is null").groupBy("lang").agg(F.sum("a").alias("n"))
    words = staged(salted_join(numbered.where("id is not null").select("lang", "id", "word", "a"), per_lang, "lang", "word"), "phrase-ids")
    texts = blocks.where("body is not null").select("block", "body")
    back = numbered.where("block is not null").select("block", "body")
    pairs = staged(_merged(_pair_runs(texts, back, buckets), 2, least), "phrase-pairs")
    both = back.withColumn("kind", F.lit(1)).unionByName(pairs.where("block is not null").select("block", "body", F.lit(2).alias("kind")))
    longer = staged(_merged(_path_runs(texts, both, buckets), 3, least), "phrase-paths")
    return words, pairs.where("key is not null").select("key", "size", "a").unionByName(longer.select("key", "size", "a"))


def _part(key: str, first: str, size: str) -> str:
    return f"substring({key}, 8 * ({first}) + 1, 8 * ({size}))"


def collocations(docs: DataFrame, least: int = LEAST, shown: int = SHOWN, text: str = "text", lang: str = "lang", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The first ``shown`` phrases of each language: lang, rank, phrase, a, l, r, n, score.

    Words are what blanks and tabs part inside pieces, which end at ``.,;:!?`` and line ends; A-Z in lower
    case. ``a`` counts a phrase of two to five words, ``n`` all words of its language (null: ``und``). Cut in
    two after k words, with parts that occur ``l`` and ``r`` times, it scores floor(1000 * a * n / (l * r));
    the lowest cut counts, the smallest k of equal ones. A phrase inside a longer one that occurs as often is
    left out: then it lies in one a word longer that does. Order is by score, count, then phrase. A null or
    empty text has no words. Repeated rows count each; other columns are not read.

    Scores are exact: products are decimals of 38 digits.
    """
    words, phrases = phrase_counts(docs, least, text, lang, block_bytes)
    longer = phrases.where("size > 2").select(
        F.explode(F.array(F.expr(_part("key", "0", "size - 1")), F.expr(_part("key", "1", "size - 1")))).alias("key"), "a"
    )
    covered = longer.groupBy("key").agg(F.max("a").alias("_longer"))
    kept = phrases.join(covered, "key", "left").where("_longer is null or _longer < a").drop("_longer")
    kept = staged(kept, "phrases-kept")
    ids = words.select(F.unhex(F.lpad(F.hex("id"), 16, "0")).alias("part"), F.col("a").alias("part_a"), "lang", "n")
    none = F.lit(None)
    counts = ids.unionByName(phrases.select(F.col("key").alias("part"), F.col("a").alias("part_a"), none.cast("string").alias("lang"), none.cast("long").alias("n")))
    cuts = kept.select("key", "size", "a", F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k"))
    left = cuts.withColumn("part", F.expr(_part("key", "0", "k")))
    with_left = salted_join(left, counts, "part", "key").select("key", "size", "a", "k", F.col("part_a").alias("l"), "lang", "n")
    with_left = staged(with_left, "phrase-cuts")
    right = with_left.withColumn("part", F.expr(_part("key", "k", "size - k")))
    both = salted_join(right, counts.select("part", F.col("part_a").alias("r")), "part", "key")
    # The cut after one word knows the language.
    named = Window.partitionBy("key")
    both = both.withColumn("lang", F.max("lang").over(named)).withColumn("n", F.max("n").over(named))
    whole = [f"cast({c} as decimal(38, 0))" for c in ("a", "n", "l", "r")]
    score = F.expr(f"(cast(1000 as decimal(38, 0)) * {whole[0]} * {whole[1]}) div ({whole[2]} * {whole[3]})").alias("score")
    scored = both.select("key", "size", "lang", "a", "n", F.struct(score, "k", "l", "r").alias("_cut"))
    lowest = scored.groupBy("key", "size", "lang", "a", "n").agg(F.min("_cut").alias("_cut")).select("*", "_cut.score", "_cut.l", "_cut.r").drop("_cut")
    order = [F.col("score").desc(), F.col("a").desc()]
    best = lowest.withColumn("_place", F.rank().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("_place") <= shown).drop("_place")
    best = staged(best, "phrases-best")
    spelt = best.select("key", F.posexplode(F.transform(F.sequence(F.lit(0), F.col("size") - 1), lambda i: F.expr("key"))).alias("_at", "_key"))
    spelt = spelt.select("key", "_at", F.conv(F.hex(F.expr(_part("_key", "_at", "1"))), 16, 10).cast("long").alias("id"))
    spelt = salted_join(spelt, words.select("id", "word"), "id", "key")
    joined = spelt.groupBy("key").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_at", "word"))), lambda w: w["word"]), " ").alias("phrase"))
    ranked = best.join(joined, "key")
    place = F.row_number().over(Window.partitionBy("lang").orderBy(*order, "phrase")).cast("long")
    return ranked.withColumn("rank", place).where(F.col("rank") <= shown).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
