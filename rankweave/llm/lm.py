"""Language-model scores of whole documents: word counts over the corpus and a recurrent model."""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from rankweave.llm.blocks import bucketed_words, pack_ints, ragged, staged_by_block, unpack_ints, word_list
from rankweave.llm.gru import HIDDEN, Gru, windows
from rankweave.session import scratch_path, staged

FOLDS, HELD_OUT = 7, 2
#: The fewest symbols for frequent words and document ends, of how many distinct training words one has a
#: symbol of its own where that is more, and symbols that all other words share by their ending.
WORDS, SHARE, REST = 4_095, 16, 64
#: A model larger than this is refused: it is held by the driver and every task. It would take some two million
#: symbols; then ``SHARE`` must be raised.
MODEL_BYTES = 1 << 29
END = b""
#: Training documents by slice: each is used once, in growing rounds with an average after each.
SLICES, ROUNDS = 16, (range(0, 1), range(1, 4), range(4, 9), range(9, 16))
TRAIN_LANES, TRAIN_STEPS, RATE = 1024, 24, 0.1
#: Lanes to score in at most, and steps times lanes of a window.
SCORE_LANES, SCORE_CELLS = 2048, 1 << 16
#: Symbols that a task lays out at a time.
CHUNK = 4_000_000
#: Ranges of a parameter's rows that are averaged apart, word buckets for each shuffle partition, and bytes of
#: text in a block.
PIECES, BUCKETS, BLOCK_BYTES = 16, 4, 16 << 20


def fold(doc_id: object) -> int:
    """crc32 of the id as text, of an empty text for null, by ``FOLDS``."""
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % FOLDS


def slice_of(doc_id: object) -> int:
    return zlib.crc32(b"slice%a" % (doc_id,)) % SLICES


def round_of(doc_id: object) -> int:
    """The round that a document is trained on in, -1 where it is held out."""
    if fold(doc_id) == HELD_OUT:
        return -1
    return next(k for k, slices in enumerate(ROUNDS) if slice_of(doc_id) in slices)


def own_symbols(distinct: int, buckets: int = 1) -> int:
    """Single words with a symbol, of a hash bucket with so many distinct training words."""
    return max(-(-WORDS // buckets), distinct // SHARE)


def rest_of(word: bytes) -> int:
    """Which of the ``REST`` symbols a word without its own has: a hash of its last two characters."""
    return zlib.crc32(word.decode("utf-8", "replace")[-2:].encode()) % REST


def training_windows(documents: list[np.ndarray], end: int) -> tuple[int, Iterator[tuple]]:
    """Lanes and windows to train on whole documents, the state kept to each one's end. There are no more
    lanes than end together: windows of one document alone would pull the model its way."""
    number = max(1, min(TRAIN_LANES, sum(map(len, documents)) // max(map(len, documents), default=1)))
    return number, windows(documents, number, TRAIN_STEPS, end)


def scoring_windows(documents: list[np.ndarray], end: int) -> Iterator[tuple]:
    """Windows to score whole documents by. Lanes end together, as narrow windows cost nearly as much as wide ones,
    and few lanes have longer windows."""
    number = max(1, min(SCORE_LANES, sum(map(len, documents)) // max(map(len, documents), default=1)))
    return windows(documents, number, max(TRAIN_STEPS, SCORE_CELLS // number), end)


LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32
BLANK = np.zeros(256, dtype=bool)
BLANK[[0x20, *range(0x09, 0x0E)]] = True


def words_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The words of all texts, which ASCII white space parts, A-Z in lower case, and how many each text has.
    Null is empty."""
    texts = texts.fill_null("")
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    data = np.frombuffer(texts.buffers()[2] or b"", dtype=np.uint8)[offsets[0] : offsets[-1]]
    offsets = offsets[1:] - offsets[0] + np.arange(len(texts))
    data = LOWER[np.insert(data, offsets - np.arange(len(texts)), ord("\n"))]
    inside = ~BLANK[data]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    starts = np.flatnonzero(begins)
    kept = data[inside]
    ends = np.append(np.cumsum(inside, dtype=np.int64)[starts] - 1, len(kept)).astype(np.int32)
    words = pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(ends), pa.py_buffer(kept)])
    return words, np.diff(np.searchsorted(starts, offsets), prepend=0)


def _blocks(docs: DataFrame, buckets: int) -> DataFrame:
    """Rows of two kinds for each block: documents as word numbers (0 for the end), and for each hash bucket the
    block's different words with their numbers and how often training documents have them."""
    id_type = docs.schema["doc_id"].dataType
    names = ["block", "bucket", "doc_ids", "sizes", "numbers", "weights", "body"]
    schema = f"block string, bucket int, doc_ids array<{id_type.simpleString()}>, sizes array<int>, numbers binary, weights binary, body binary"

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        partition, serial, size = TaskContext.get().partitionId(), 0, 0
        known, weights = {END: 0}, np.zeros(1, dtype=np.int64)
        kinds = [pa.string(), pa.int32(), pa.list_(to_arrow_type(id_type)), pa.list_(pa.int32()), *[pa.binary()] * 3]

        def row(*values) -> pa.RecordBatch:
            return pa.record_batch([pa.array([v], k) for v, k in zip([f"{partition}-{serial}", *values], kinds)], names=names)

        def finished() -> Iterator[pa.RecordBatch]:
            for bucket, *blobs in bucketed_words(list(known), np.arange(len(known)), weights, buckets):
                yield row(bucket, None, None, *blobs)

        for batch in batches:
            ids = batch.column(0).to_pylist()
            words, sizes = words_of(batch.column(1))
            coded = words.dictionary_encode()
            listed = coded.dictionary.to_pylist()
            numbers = np.array([known.setdefault(w, len(known)) for w in listed], dtype=np.int64)
            at = numbers[coded.indices.to_numpy(zero_copy_only=False)] if len(listed) else np.zeros(0, dtype=np.int64)
            at = np.insert(at, np.cumsum(sizes), 0)
            sizes = sizes + 1
            trained = np.repeat([fold(i) != HELD_OUT for i in ids], sizes) if ids else np.zeros(0, dtype=bool)
            found = np.bincount(at[trained], minlength=len(known))
            found[: len(weights)] += weights
            weights = found
            if ids:
                yield row(None, ids, sizes.tolist(), None, None, pack_ints(at))
            size += batch.column(1).nbytes
            if size > BLOCK_BYTES:
                yield from finished()
                serial, size, known, weights = serial + 1, 0, {END: 0}, np.zeros(1, dtype=np.int64)
        yield from finished()

    return docs.mapInArrow(split, schema)


def _counted(words: DataFrame, buckets: int) -> DataFrame:
    """For each block the counts over all blocks of its words of a bucket, and the bucket's totals.

    The words of one bucket are held, packed, until the next begins. Its most frequent words get a symbol of
    their own (``top``); ``rest`` has the others by ending.
    """
    schema = "block string, numbers binary, counts binary, words binary, tokens long, known long, ends long, rest array<struct<symbol:int,tokens:long,words:long>>, top array<struct<word:binary,count:long>>"
    names = [part.split()[0] for part in schema.split(", ")]
    rest_type = pa.list_(pa.struct([("symbol", pa.int32()), ("tokens", pa.int64()), ("words", pa.int64())]))
    top_type = pa.list_(pa.struct([("word", pa.binary()), ("count", pa.int64())]))
    kinds = [pa.string(), *[pa.binary()] * 3, *[pa.int64()] * 3, rest_type, top_type]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, held, total = None, [], Counter()

        def row(*values) -> pa.RecordBatch:
            return pa.record_batch([pa.array([v], k) for v, k in zip(values, kinds)], names=names)

        def bucket() -> Iterator[pa.RecordBatch]:
            for block, numbers, body in held:
                yield row(block, numbers, pack_ints(np.array([total[w] for w in word_list(body)])), body, *[None] * 5)
            seen = [(c, w) for w, c in total.items() if c and w != END]
            own = sorted(seen, key=lambda cw: (-cw[0], cw[1]))[: own_symbols(len(seen), buckets)]
            named = {w for _, w in own}
            tokens, different = np.zeros((2, REST), dtype=np.int64)
            for c, word in seen:
                if word not in named:
                    tokens[rest_of(word)] += c
                    different[rest_of(word)] += 1
            rest = [{"symbol": k, "tokens": int(tokens[k]), "words": int(different[k])} for k in range(REST)]
            ends = total.get(END, 0)
            yield row(*[None] * 4, sum(total.values()), len(seen) + (ends > 0), ends, rest, [{"word": w, "count": c} for c, w in own])

        for batch in batches:
            for block, numbers, weights, body, number in zip(*[c.to_pylist() for c in batch.columns]):
                if number != current:
                    if held:
                        yield from bucket()
                    current, held, total = number, [], Counter()
                held.append((block, numbers, body))
                for word, weight in zip(word_list(body), unpack_ints(weights).tolist()):
                    total[word] += weight
        if held:
            yield from bucket()

    dealt = words.select("block", "numbers", "weights", "body", "bucket").repartition("bucket").sortWithinPartitions("bucket")
    return dealt.mapInArrow(count, schema)


def _encoded(documents: DataFrame, counted: DataFrame, symbols: dict[bytes, int], own_number: int, tokens: int, words: int, rest: np.ndarray) -> DataFrame:
    """Documents as symbols by round, with what their words alone give to the scores."""
    id_type = documents.schema["doc_ids"].dataType.simpleString()
    names = ["round", "doc_ids", "sizes", "known", "base", "rest", "symbols"]
    schema = f"round int, doc_ids {id_type}, sizes array<int>, known array<long>, base array<double>, rest array<double>, symbols binary"
    shared = documents.sparkSession.sparkContext.broadcast(symbols)

    def encode(documents: pa.Table, counted: pa.Table) -> pa.Table:
        symbols = shared.value
        numbers, counts, symbol, own = [], [], [], []
        for n, c, body in zip(counted["numbers"], counted["counts"], counted["words"]):
            numbers.append(unpack_ints(n.as_py()))
            counts.append(unpack_ints(c.as_py()))
            for word in word_list(body.as_py()):
                found = symbols.get(word)
                own.append(found is not None)
                symbol.append(own_number + rest_of(word) if found is None else found)
        order = np.argsort(np.concatenate(numbers))
        count, symbol, own = np.concatenate(counts)[order], np.array(symbol)[order], np.array(own)[order]
        base = np.log10((count + 1) / (tokens + words + 1))
        inside = np.where(own, 0, np.log10((count + 1) / (rest[np.where(own, 0, symbol - own_number)] + 1)))
        rows = []
        for doc_ids, sizes, body in zip(documents["doc_ids"], documents["sizes"], documents["body"]):
            at, sizes, ids = unpack_ints(body.as_py()), sizes.values.to_numpy().astype(np.int64), doc_ids.values.to_pylist()
            starts = np.cumsum(sizes) - sizes
            sums = [np.add.reduceat(v[at], starts) for v in ((count > 0).astype(np.int64), base, inside)]
            rounds = np.array([round_of(i) for i in ids])
            for number in np.unique(rounds).tolist():
                mine = np.flatnonzero(rounds == number)
                held = symbol[at[ragged(starts[mine], sizes[mine])]]
                rows.append((number, [ids[k] for k in mine.tolist()], sizes[mine].tolist(), *[v[mine].tolist() for v in sums], pack_ints(held)))
        kinds = [pa.int32(), documents["doc_ids"].type, pa.list_(pa.int32()), pa.list_(pa.int64()), *[pa.list_(pa.float64())] * 2, pa.binary()]
        return pa.table([pa.array(c, k) for c, k in zip(zip(*rows) if rows else [[]] * 7, kinds)], names=names)

    return documents.groupBy("block").cogroup(counted.groupBy("block")).applyInArrow(encode, schema)


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[dict[str, list], list[np.ndarray]]]:
    """Documents of some rows together, about ``CHUNK`` symbols, so that the lanes are of use; with the
    other columns by document."""
    held, documents, size = {}, [], 0
    for batch in batches:
        for row in batch.to_pylist():
            symbols = unpack_ints(row.pop("symbols"))
            documents += np.split(symbols, np.cumsum(row["sizes"])[:-1])
            for name, values in row.items():
                held.setdefault(name, []).extend(values)
            size += len(symbols)
            if size >= CHUNK:
                yield held, documents
                held, documents, size = {}, [], 0
    if documents:
        yield held, documents


def _moved(own: Gru, begun: Gru) -> Iterator[tuple[str, int, np.ndarray, np.ndarray]]:
    """(parameter, range, rows, difference) of the rows that training has changed."""
    for name in own.rowed:
        rows = np.flatnonzero(own.squares[name] != begun.squares[name])
        span = -(-len(own.p[name]) // PIECES)
        for piece in np.unique(rows // span).tolist():
            mine = rows[rows // span == piece]
            yield name, piece, mine, own.rows(name, mine) - begun.rows(name, mine)


def _train_round(encoded: DataFrame, model: Gru, end: int) -> None:
    """Move the model to where the tasks' models are on average, after each has trained on its documents.

    A task sends the rows that it has changed, as differences in half precision. A row moves by the average,
    by tokens seen, over the tasks that changed it.
    """
    spark = encoded.sparkSession
    shared = spark.sparkContext.broadcast(model.arrays())
    schema = "name string, piece int, tokens double, rows binary, body binary"
    names = ["name", "piece", "tokens", "rows", "body"]
    widths = {n: model.p[n].size // len(model.p[n]) + 1 for n in model.rowed}
    spans = {n: -(-len(model.p[n]) // PIECES) for n in model.rowed}

    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begun = Gru.of(shared.value)
        own, seen = Gru.of(shared.value), 0
        for _, documents in _chunks(batches):
            state, (number, laid) = None, training_windows(documents, end)
            for inputs, starts, targets, owner in laid:
                state = own.blank(inputs) if state is None else state
                state = own.train(inputs, starts, targets, owner >= 0, state, RATE, number * TRAIN_STEPS)
                seen += int((owner >= 0).sum())
        if seen:
            out = [(n, k, float(seen), rows.astype("<u4").tobytes(), by.astype(np.float16).tobytes()) for n, k, rows, by in _moved(own, begun)]
            out.append(("", 0, float(seen), b"", (own.whole() - begun.whole()).astype(np.float32).tobytes()))
            kinds = [pa.string(), pa.int32(), pa.float64(), pa.binary(), pa.binary()]
            yield pa.record_batch([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=names)

    def average(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name = key[0].as_py()
        total, by = 0.0, None
        for batch in batches:
            for tokens, rows, body in zip(*[batch.column(c).to_pylist() for c in ("tokens", "rows", "body")]):
                if not name:
                    change = np.frombuffer(body, dtype=np.float32) * tokens
                    by, total = change if by is None else by + change, total + tokens
                    continue
                if by is None:
                    by, total = np.zeros((spans[name], widths[name]), dtype=np.float32), np.zeros(spans[name])
                at = np.frombuffer(rows, dtype="<u4") % spans[name]
                by[at] += np.frombuffer(body, dtype=np.float16).reshape(len(at), -1).astype(np.float32) * tokens
                total[at] += tokens
        mean = by / np.maximum(total, 1)[:, None] if name else by / total
        columns = [[name], [key[1].as_py()], [0.0], [b""], [mean.astype(np.float32).tobytes()]]
        kinds = [pa.string(), pa.int32(), pa.float64(), pa.binary(), pa.binary()]
        yield pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

    # What is sent grows with the tasks, so there are no more than run at a time.
    workers = encoded.select("sizes", "symbols").repartition(spark.sparkContext.defaultParallelism)
    moved = workers.mapInArrow(train, schema).groupBy("name", "piece").applyInArrow(average, schema)
    found = moved.toArrow()
    for name, piece, body in zip(*[found[c] for c in ("name", "piece", "body")]):
        name, by = name.as_py(), np.frombuffer(body.as_buffer(), dtype=np.float32)
        if not name:
            model.load_whole(model.whole() + by)
            continue
        first = piece.as_py() * spans[name]
        rows = np.arange(first, min(first + spans[name], len(model.p[name])))
        model.shift(name, rows, by.reshape(-1, widths[name])[: len(rows)])
    shared.destroy()


def _scored(encoded: DataFrame, model: Gru, end: int, tokens: int) -> DataFrame:
    shared = encoded.sparkSession.sparkContext.broadcast(model.arrays())
    id_type = encoded.schema["doc_ids"].dataType.elementType.simpleString()
    id_kind = to_arrow_type(encoded.schema["doc_ids"].dataType.elementType)
    schema = f"doc_id {id_type}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Gru.of(shared.value)
        for columns, documents in _chunks(batches):
            ids, total, state = columns["doc_ids"], np.array(columns["rest"]), None
            for inputs, starts, targets, owner in scoring_windows(documents, end):
                state = own.blank(inputs) if state is None else state
                found, state = own.log_probabilities(inputs, starts, targets, state)
                live = owner >= 0
                total += np.bincount(owner[live], weights=found[live], minlength=len(total)) / np.log(10)
            arrays = [
                pa.array(ids, id_kind),
                pa.array([fold(i) == HELD_OUT for i in ids]),
                pa.array(columns["sizes"], pa.int64()),
                pa.array(columns["known"], pa.int64()),
                pa.array([tokens] * len(ids), pa.int64()),
                pa.array(columns["base"], pa.float64()),
                pa.array(total, pa.float64()),
            ]
            yield pa.record_batch(arrays, names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    return encoded.mapInArrow(score, schema)


def score_documents(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Log10 probabilities of every text: (doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score).

    Documents of one fold of their ids are held out: they are scored by counts and a model that come
    from all the others. ``base_score`` is the add-one unigram score. ``score`` is that of the recurrent
    model: symbols for single frequent words (``own_symbols``), and ``REST`` symbols for all others, inside
    each of which a word has its add-one share, with one share for all unknown words. Null and empty texts are an end alone. Rows that repeat an id are documents of
    their own; other columns are not read.

    Counts are made once for each different word in its hash bucket. Every training document is used for
    training once: tasks train on their share of a round's documents, and what they change is averaged after each of
    the growing ``ROUNDS``. The words with a symbol of their own (the most frequent of each hash bucket), totals and
    the model reach the driver, ``MODEL_BYTES`` of it at most.
    """
    spark = docs.sparkSession
    buckets = BUCKETS * int(spark.conf.get("spark.sql.shuffle.partitions"))
    picked = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    blocks = staged_by_block(_blocks(picked, buckets), "lm-blocks")
    counted = staged(_counted(blocks.where("bucket is not null"), buckets), "lm-counts")
    totals = counted.where("block is null").agg(F.sum("tokens"), F.sum("known"), F.sum("ends"), F.sum(F.size("top"))).first()
    tokens, words, ends, own_number = (int(v or 0) for v in totals)
    own_number += 1  # and the end
    if own_number * 4 * 5 * HIDDEN > MODEL_BYTES:
        raise ValueError(f"{own_number} symbols make a model beyond {MODEL_BYTES} bytes; raise SHARE")
    top = counted.where("block is null").select(F.inline("top")).orderBy(F.desc("count"), "word").toArrow()
    symbols = {END: 0} | {word: i for i, word in enumerate(top["word"].to_pylist(), 1)}
    often = top["count"].to_numpy()
    # What each rest symbol has of tokens and different words.
    rest = np.zeros((2, REST), dtype=np.int64)
    for r in counted.where("block is null").select(F.inline("rest")).groupBy("symbol").agg(F.sum("tokens"), F.sum("words")).collect():
        rest[:, r[0]] = r[1:]
    documents = blocks.where("bucket is null").select("block", "doc_ids", "sizes", "body")
    rows = counted.where("block is not null").select("block", "numbers", "counts", "words")
    place = scratch_path(spark, "lm-symbols")
    encoded = _encoded(documents, rows, symbols, own_number, tokens, words, rest.sum(axis=0))
    encoded.write.partitionBy("round").parquet(place)
    del symbols, top  # the tasks have had them
    encoded = spark.read.schema(encoded.schema).parquet(place)
    counts = np.zeros(own_number + REST)
    counts[0], counts[1 : len(often) + 1] = ends, often
    counts[own_number:] = rest[0]
    model = Gru(counts, own_number, REST)
    for number in range(len(ROUNDS)):
        _train_round(encoded.where(F.col("round") == number), model, 0)
    return _scored(encoded.drop("round"), model, 0, tokens)
