"""The operators on documents against brute force, on a table of odd rows, and on an empty one."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import xxhash
from tokenizers import Tokenizer

from rankweave.llm import byte_bpe, gru, lm, packing, pipeline, quality, simhash, sharding
from rankweave.llm.queries import QUERIES

SPACES = "[^\x20\x09-\x0d]+"


def words_of(text):
    return re.findall(SPACES, re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))


def rows_of(spark, name, path):
    return [r.asDict() for r in QUERIES[name](spark, path).collect()]


def ordered(rows, *keys):
    return sorted(rows, key=lambda r: tuple(str(r[k]) for k in keys))


@pytest.mark.parametrize("name", [n for n in QUERIES if n not in ("op6_vectors", "op9_urls")])
def test_an_empty_table_gives_no_rows(spark, no_documents, name):
    assert rows_of(spark, name, no_documents) == []


def test_byte_bpe(spark, documents):
    path, rows = documents
    enc = byte_bpe.encoding(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    want = []
    for i, t in rows:
        ids = enc.encode_ordinary(t or "")
        want.append((i, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()))
    got = [tuple(r.values()) for r in rows_of(spark, "op1_byte_bpe", path)]
    assert sorted(got, key=str) == sorted(want, key=str)


def test_byte_bpe_round_trip(spark):
    names = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    texts = ["", "a  b\n c", "déjà vu <|endoftext|>", " \t \n", "1234 x's 'll"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    encoded = byte_bpe.encode_documents(docs, *names)
    back = {r.doc_id: bytes(r.bytes).decode() for r in byte_bpe.decode_documents(encoded, *names).collect()}
    assert back == dict(enumerate(texts))


def test_packing(spark, documents):
    path, rows = documents
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = []
    for i, t in rows:
        ids = tokenizer.encode(t or "", add_special_tokens=False).ids + [1]
        for piece, start in enumerate(range(0, len(ids), 4096)):
            part = ids[start : start + 4096]
            want.append((i, piece, start, len(part), zlib.crc32(np.array(part, dtype="<u4").tobytes())))
    got = rows_of(spark, "op2_packing", path)
    assert sorted(((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got), key=str) == sorted(want, key=str)
    filled = defaultdict(list)
    for r in got:
        filled[r["sequence_id"]].append((r["offset"], r["length"]))
    for held in filled.values():
        end = 0
        for offset, length in sorted(held):
            assert offset == end
            end += length
        assert end <= 4096
    assert len(filled) == -(-sum(r["length"] for r in got) // 4096)


def test_packing_takes_added_tokens_as_the_library_does(spark):
    texts = ["hello <|endoftext|> world", "a<|startoftext|>b", "<|ENDOFTEXT|> x", "<|endoftext|>", "<| endoftext |>", "Plain"]
    path = public_tokenizers.path("word_bpe_49k.json")
    library = Tokenizer.from_file(path)
    want = {}
    for i, t in enumerate(texts):
        ids = library.encode(t, add_special_tokens=False).ids + [1]
        want[i] = len(ids), zlib.crc32(np.array(ids, dtype="<u4").tobytes())
    pieces = packing.token_pieces(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), path)
    assert {r.doc_id: (r.length, r.ids_crc32) for r in pieces.collect()} == want


def test_pieces_are_cut_where_their_documents_lie(spark):
    docs = spark.createDataFrame([(1, "one two " * 9), (2, None), (2, "three")], "doc_id long, text string")
    pieces = packing.token_pieces(docs, public_tokenizers.path("word_bpe_49k.json"), 8)
    assert "Exchange" not in pieces._jdf.queryExecution().executedPlan().toString()
    got = sorted((r.doc_id, r.piece, r.start, r.length) for r in pieces.collect())
    assert got == [(1, 0, 0, 8), (1, 1, 8, 8), (1, 2, 16, 3), (2, 0, 0, 1), (2, 0, 0, 2)]


def test_configurations_hold_every_piece_once():
    rng = np.random.default_rng(3)
    lengths, counts = np.unique(np.minimum(rng.geometric(0.004, 3000), 512), return_counts=True)
    histogram = {int(n): int(c) for n, c in zip(lengths, counts)}
    plan = packing.configurations(histogram, 512, 40)
    held = Counter()
    for times, lengths_held in plan:
        assert sum(n * k for n, k in lengths_held.items()) <= 512
        held.update({n: times * k for n, k in lengths_held.items()})
    assert dict(held) == histogram
    total = sum(n * c for n, c in histogram.items())
    assert sum(t for t, _ in plan) <= 1.01 * total / 512 + 1
    assert packing.priced(np.array([3, 5]), np.array([3.0, 5.5]), 11) == {5: 1, 3: 2} or packing.priced(np.array([3, 5]), np.array([3.0, 5.5]), 11) == {3: 2, 5: 1}


def test_the_program_places_most_pieces():
    rng = np.random.default_rng(5)
    lengths, counts = np.unique(np.minimum(np.exp(rng.normal(3.2, 1.0, 20_000)).astype(int) + 1, 512), return_counts=True)
    program = packing.fractional(lengths, counts, 512)
    covered = Counter()
    for amount, held in program:
        assert amount > 0 and sum(n * k for n, k in held.items()) <= 512
        for n, k in held.items():
            covered[n] += amount * k
    for n, c in zip(lengths.tolist(), counts.tolist()):
        assert (1 - packing.UNCOVERED) * c - 1e-6 <= covered[n] <= c + 1e-6
    left = dict(zip(lengths.tolist(), counts.tolist()))
    uses = packing.rounded(program, left, 512)
    placed = sum(times * sum(held.values()) for times, held in uses)
    assert placed + sum(left.values()) == 20_000 and min(left.values()) >= 0
    assert placed > 10_000
    plan = packing.configurations(dict(zip(lengths.tolist(), counts.tolist())), 512)
    assert sum(times for times, _ in plan) <= -(-int(lengths @ counts) // 512) + 1


def test_language_model(spark, documents):
    path, rows = documents
    counts = Counter()
    texts = []
    for i, t in rows:
        tokens = [*words_of(t), ""]
        held_out = zlib.crc32(b"" if i is None else str(i).encode()) % 7 == 2
        texts.append((i, held_out, tokens))
        if not held_out:
            counts.update(tokens)
    n, v = sum(counts.values()), len(counts)
    want = [(i, h, len(ts), sum(counts[t] > 0 for t in ts), n, round(sum(math.log10((counts[t] + 1) / (n + v + 1)) for t in ts), 5)) for i, h, ts in texts]
    got = rows_of(spark, "op3_lm", path)
    shown = [(r["doc_id"], r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 5)) for r in got]
    assert sorted(shown, key=str) == sorted(want, key=str)
    assert all(math.isfinite(r["score"]) and r["score"] < 0 for r in got)


def test_language_model_beats_the_unigram_score_on_held_out_documents(spark):
    scored = QUERIES["op3_lm"](spark, "/root/testdata/sf0.01").where("held_out")
    model, base = scored.selectExpr("sum(score)", "sum(base_score)").first()
    assert model > base


def test_own_symbols_grow_with_the_words_and_training_keeps_the_state_of_long_documents():
    assert lm.own_symbols(10) == 4_095 and lm.own_symbols(10_000_000) == 625_000
    assert lm.own_symbols(10, 32) == 128
    grown = gru.Gru(np.ones(8_064), 8_000, 64)
    assert grown.branches == 20 and grown.top == 20
    lengths = [5_000, 7, 2_100]
    number, laid = lm.training_windows([np.arange(n) for n in lengths], 0)
    begun, seen = 0, np.zeros(3, dtype=int)
    for inputs, starts, _, owner in laid:
        assert len(inputs) <= 24
        begun += int((starts & (owner >= 0)).sum())
        seen += np.bincount(owner[owner >= 0], minlength=3)
    assert begun == 3 and seen.tolist() == lengths and number == 1


def test_scoring_lays_out_few_wide_windows_and_scores_as_one_document_at_a_time():
    rng = np.random.default_rng(2)
    model = gru.Gru(np.arange(1.0, 301.0)[::-1], 290, 10)
    for name in ("classes", "mid", "leaf"):
        model.p[name] = rng.normal(0, 0.3, model.p[name].shape).astype(np.float32)
    docs = [rng.integers(0, 300, n) for n in (3_000, *[20] * 600, 1)]

    def scored(laid):
        total, state, laid = np.zeros(len(docs)), None, list(laid)
        for inputs, starts, targets, owner in laid:
            state = model.blank(inputs) if state is None else state
            found, state = model.log_probabilities(inputs, starts, targets, state)
            total += np.bincount(owner[owner >= 0], weights=found[owner >= 0], minlength=len(docs))
        return total, laid

    total, laid = scored(lm.scoring_windows(docs, 0))
    assert len(laid) == 1 and sum(w[0].size for w in laid) < 1.1 * sum(map(len, docs))
    alone, _ = scored(gru.windows(docs, 1, 1_000, 0))
    assert np.allclose(total, alone, rtol=1e-4)


def test_a_training_step_moves_each_parameter_by_its_gradient():
    rng = np.random.default_rng(3)
    begun = gru.Gru(np.arange(1.0, 81.0)[::-1], 70, 10)
    for name in ("classes", "mid", "leaf"):
        begun.p[name] = rng.normal(0, 0.3, begun.p[name].shape).astype(np.float32)
    inputs, targets, starts = *rng.integers(0, 80, (2, 6, 40)), rng.random((6, 40)) < 0.2
    live = rng.random((6, 40)) < 0.9
    moved = gru.Gru.of(begun.arrays())
    moved.train(inputs, starts, targets, live, moved.blank(inputs), 0.1, 240)

    def loss(model):
        return -model.log_probabilities(inputs, starts, targets, model.blank(inputs))[0][live].sum() / 240

    for name in begun.p:
        # Where a step of one parameter goes, the loss falls as its gradient says.
        rows = begun.squares[name] != moved.squares[name]
        at = np.unravel_index(np.abs(np.where(rows.reshape(rows.shape + (1,) * (begun.p[name].ndim - rows.ndim)), moved.p[name] - begun.p[name], 0)).argmax(), begun.p[name].shape)
        lower, upper = gru.Gru.of(begun.arrays()), gru.Gru.of(begun.arrays())
        lower.p[name][at] -= 0.03
        upper.p[name][at] += 0.03
        slope = (loss(upper) - loss(lower)) / 0.06
        assert slope * (moved.p[name] - begun.p[name])[at] < 0


def test_the_recurrent_model_is_a_distribution_and_its_gradient_is_right():
    model = gru.Gru(np.arange(1.0, 81.0)[::-1], 70, 10)
    rng = np.random.default_rng(1)
    for name in ("classes", "mid", "leaf"):
        model.p[name] = rng.normal(0, 0.3, model.p[name].shape).astype(np.float32)
    inputs, starts = rng.integers(0, 80, (4, 3)), np.zeros((4, 3), dtype=bool)
    total = sum(np.exp(model.log_probabilities(inputs, starts, np.full((4, 3), s), model.blank(inputs))[0]) for s in range(80))
    assert np.allclose(total, 1, atol=1e-4)
    targets = rng.integers(0, 80, (4, 3))

    def loss():
        return -model.log_probabilities(inputs, starts, targets, model.blank(inputs))[0].mean()

    before = loss()
    for _ in range(30):
        model.train(inputs, starts, targets, np.ones((4, 3), dtype=bool), model.blank(inputs), 0.05, 12)
    assert loss() < before - 0.5


def test_a_word_of_a_large_vocabulary_costs_a_few_narrow_softmaxes():
    rng = np.random.default_rng(4)
    model = gru.Gru(np.arange(1.0, 30_065.0)[::-1], 30_000, 64)
    assert model.branches <= 24
    assert model.p["classes"].shape[1] + model.branches * len(model.levels) < 64  # 160 as three levels, each rest symbol a class
    for name in ("classes", "others", *model.levels):
        model.p[name] = rng.normal(0, 0.3, model.p[name].shape).astype(np.float32)
    # One step from the same state to each symbol: the shares are those of a distribution.
    every = np.arange(30_064)[None]
    same, begins = np.zeros_like(every), np.ones(every.shape, dtype=bool)
    assert np.isclose(np.exp(model.log_probabilities(same, begins, every, model.blank(same))[0]).sum(), 1, atol=1e-4)
    inputs, targets = rng.integers(0, 30_000, (2, 6, 40))
    targets[0] = rng.integers(30_000, 30_064, 40)
    starts, live = np.zeros((6, 40), dtype=bool), np.ones((6, 40), dtype=bool)
    begun = gru.Gru.of(model.arrays())

    def loss(of):
        return -of.log_probabilities(inputs, starts, targets, of.blank(inputs))[0].mean()

    model.train(inputs, starts, targets, live, model.blank(inputs), 0.05, 240)
    for name in ("others", *model.levels):
        # Each level alone, where it has gone, makes the texts likelier.
        part = gru.Gru.of(begun.arrays())
        part.p[name] = model.p[name]
        assert loss(part) < loss(begun)


def test_sharding(spark, documents):
    path, rows = documents
    got = rows_of(spark, "op5_sharding", path)
    want = Counter((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in rows)
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in got) == want
    slots = defaultdict(list)
    for r in got:
        slots[r["shard"]].append(r["slot"])
    assert set(slots) <= set(range(16)) and all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert {r["law"] for r in got} == {"bytes"}


def test_sharding_deals_out_a_group_larger_than_a_shard(spark):
    rows = [(i, "same text") for i in range(3000)] + [(i, f"text {i}") for i in range(3000, 9000)]
    placed = sharding.shard(spark.createDataFrame(rows, "doc_id long, text string"))
    sizes = [r["count"] for r in placed.groupBy("shard").count().collect()]
    assert len(sizes) == 16 and max(sizes) - min(sizes) <= 0.03 * 9000 / 16


def test_vector_packing_balances_every_column():
    items = np.random.default_rng(2).pareto(2.0, (4000, 3)) + 0.1
    placed = sharding.pack_vectors(items, 8)
    loads = np.stack([items[placed == s].sum(axis=0) for s in range(8)])
    assert (loads.max(axis=0) / loads.mean(axis=0)).max() < 1.05


def brute_print(text):
    words = words_of(text)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hashes = np.array([xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles], dtype=np.uint64)
    return sum(1 << b for b in range(64) if 2 * int((hashes >> np.uint64(b) & np.uint64(1)).sum()) > len(shingles))


def brute_components(ids, codes):
    codes = np.array(codes, dtype=np.uint64)
    label = np.arange(len(codes))
    near = [np.flatnonzero(np.bitwise_count(codes ^ c) <= 3) for c in codes]
    while True:
        new = np.array([label[n].min() for n in near])
        if (new == label).all():
            break
        label = new
    smallest = {}
    for i, root in zip(ids, label):
        smallest[root] = min((x for x in (i, smallest.get(root)) if x is not None), default=None)
    return [smallest[root] for root in label]


def test_simhash(spark, documents):
    path, rows = documents
    ids, codes = [i for i, _ in rows], [brute_print(t) for _, t in rows]
    want = [(i, format(c, "016x"), k) for i, c, k in zip(ids, codes, brute_components(ids, codes))]
    got = [(r["doc_id"], r["fingerprint"], r["component_id"]) for r in rows_of(spark, "op7_simhash", path)]
    assert sorted(got, key=str) == sorted(want, key=str)


@pytest.mark.parametrize("group,tile", [(2048, 16384), (64, 50)])
def test_gray_index_finds_every_link(spark, monkeypatch, group, tile):
    monkeypatch.setattr(simhash, "GROUP", group)
    monkeypatch.setattr(simhash, "TILE", tile)
    rng = np.random.default_rng(4)
    codes = rng.integers(0, 1 << 63, 300, dtype=np.uint64) * np.uint64(2)
    chain = codes[:60].repeat(5) ^ (np.uint64(1) << rng.integers(0, 64, 300).astype(np.uint64))
    codes = np.unique(np.concatenate([codes, chain, chain ^ np.uint64(7), np.array([0, 1, 2**64 - 1], dtype=np.uint64)]))
    frame = spark.createDataFrame([(int(c),) for c in codes.view(np.int64)], "fingerprint long")
    found = {(r.vertex, r.component) for r in simhash.components(simhash.near_links(frame), "code", "root").collect()}
    want = brute_components(codes.view(np.int64).tolist(), codes)
    size = Counter(want)
    assert found == {(int(c), k) for c, k in zip(codes.view(np.int64), want) if size[k] > 1}


def test_quality_counts(spark, documents):
    path, rows = documents
    want = []
    for i, t in rows:
        words = re.findall(SPACES, t or "")
        windows = [tuple(words[k : k + 3]) for k in range(len(words) - 2)]
        seen = Counter(windows)
        covered = {k + d for k, w in enumerate(windows) if seen[w] > 1 for d in range(3)}
        lines = [line for line in (t or "").split("\n") if re.search(SPACES, line)]
        failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
        want.append((i, len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in t or ""), len(lines) - len(set(lines)), len(covered), failed))
    got = rows_of(spark, "op10_quality", path)
    names = ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    assert sorted((tuple(r[n] for n in names) for r in got), key=str) == sorted(want, key=str)
    assert all(not r["kept"] for r in got if r["base_failed"])
    assert all(r["kept"] for r in got if r["doc_id"] is not None and r["doc_id"] < 40)


def test_quality_agrees_with_the_labels(spark):
    judged = QUERIES["op10_quality"](spark, "/root/testdata/sf0.01").where("not base_failed").drop("quality")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    rows = judged.join(labels, "doc_id").select("kept", "quality").collect()
    assert sum(r.kept == (r.quality == 1) for r in rows) >= 0.98 * len(rows)


def test_label_model_without_junk_keeps_everything():
    assert min(quality.fit_label_model({"--------gg": 500, "---------g": 3}).values()) > 0.5
    assert quality.fit_label_model({}) == {}


def test_pipeline_stages(spark, documents):
    path, rows = documents
    docs = spark.read.parquet(f"{path}/documents.parquet").select(*pipeline.DOCUMENTS)
    for name, stage in pipeline.STAGES[:-1]:
        out = stage(spark, docs, path)
        assert out.columns == docs.columns, name
        ids = {r.doc_id for r in out.select("doc_id").collect()}
        assert set(range(10)) <= ids, name  # clean documents stay
        if name == "line_dedup":
            assert out.count() == docs.count()
        if name == "simhash_near_dedup":
            assert out.where("doc_id between 10 and 13").count() == 1 and out.where("doc_id = 0").count() == 1
    assert QUERIES["pipeline"](spark, path).count() > 0
