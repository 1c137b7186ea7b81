"""Token files against the library's ids, round trips of grammars, and random access."""

import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from rankweave.llm import repair, tokenfile, wordbpe
from rankweave.llm.queries import QUERIES

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")


def ids_of(text, own=Tokenizer.from_file(VOCABULARY)):
    return [*own.encode(text or "", add_special_tokens=False).ids, 1]


def crc(ids):
    return zlib.crc32(np.array(ids, dtype="<u4").tobytes())


def test_documents_come_back_in_order_with_their_places(spark, documents):
    path, rows = documents
    got = sorted(QUERIES["op13_token_files"](spark, path).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in got] == sorted((i for i, _ in rows), key=lambda i: (i is not None, i))
    place = 0
    for r in got:
        assert r.start == place
        place += r.n_tokens
    want = sorted((str(i), len(ids_of(t)), crc(ids_of(t))) for i, t in rows)
    assert sorted((str(r.doc_id), r.n_tokens, r.ids_crc32) for r in got) == want


def test_any_slice_of_the_corpus(spark, documents, tmp_path):
    path, rows = documents
    docs = spark.read.parquet(f"{path}/documents.parquet").where("doc_id > 0")
    tokenfile.write_ids(docs, VOCABULARY, f"{tmp_path}/ids", shard_ids=3000)
    texts = dict(r for r in rows if r[0])
    every = [i for k in sorted(texts) for i in ids_of(texts[k])]
    for start, length in ((0, 10), (17, 40_000), (len(every) - 3, 3), (len(every) - 3, 50), (len(every), 5)):
        pieces = sorted((r.start, r.ids) for r in tokenfile.read_ids(spark, f"{tmp_path}/ids", start, length).collect())
        assert [i for _, ids in pieces for i in ids] == every[start : start + length]
    back = {r.doc_id: r.ids for r in tokenfile.read_documents(spark, f"{tmp_path}/ids").collect()}
    assert back == {k: ids_of(t) for k, t in texts.items()}


@pytest.mark.parametrize("kind", ["repeats", "runs", "random", "short"])
def test_grammars_expand_to_what_they_were_made_of(kind):
    rng = np.random.default_rng(7)
    ids = {
        "repeats": np.tile([5, 6, 7, 8, 6, 7, 9], 3000),
        "runs": np.repeat([3, 3, 4], 4000),
        "random": rng.integers(0, 40, 20_000),
        "short": np.array([2, 2, 2]),
    }[kind].astype(np.uint32)
    starts = np.unique(np.append(0, rng.integers(0, len(ids), 50)))
    grammar, places = repair.compress(ids, starts, 50)
    assert (grammar.expand() == ids).all()
    sizes = grammar.sizes(grammar.symbols)
    assert (np.cumsum(sizes)[places] - sizes[places] == starts).all()
    again = repair.Grammar.unpack(50, grammar.pack())
    for start, length in ((0, 3), (len(ids) // 3, 500), (len(ids) - 1, 1)):
        assert (again.slice(start, length) == ids[start : start + length]).all()
    if kind == "repeats":
        assert len(grammar.symbols) < len(ids) / 5


def test_no_pair_of_a_document_is_left_twice():
    rng = np.random.default_rng(11)
    cases = [(rng.integers(0, k, n), 6) for n, k in [(1, 1), (9, 1), (60, 2), (70, 4), (300, 6)] for _ in range(40)]
    rare = np.arange(3000)  # pairs of symbols beyond the thousand most frequent ones, each of them twice
    for ids, terminals in [*cases, (np.concatenate([rare, rare]), 3000)]:
        starts = np.unique(np.append(0, rng.integers(0, len(ids), 3)))
        grammar, places = repair.compress(ids.astype(np.uint32), starts, terminals)
        assert (grammar.expand() == ids).all()
        met, overlapped = Counter(), False
        for at, pair in enumerate(zip(grammar.symbols[:-1].tolist(), grammar.symbols[1:].tolist())):
            inside = at + 1 not in places
            overlapped = inside and pair[0] == pair[1] and at > 0 and at not in places and grammar.symbols[at - 1] == pair[0] and not overlapped
            if inside and not overlapped:
                met[pair] += 1
        assert max(met.values(), default=0) < 2
    assert len(grammar.symbols) < 20


def test_words_are_encoded_as_the_library_does():
    rng = random.Random(3)
    parts = [*"abcXYZ'sStdlmrev019.,!?-  \t\n\r\x0b\x1c\x1f\x85\xa0éÉßçŒ«»×İıΑΣς 　中ﬁ\x00W🙂́", "<|endoftext|>", "<|startoftext|>", "'re", "'LL"]
    texts = ["".join(rng.choices(parts, k=rng.randint(0, 25))) for _ in range(4000)] + [None, ""]
    words = tokenfile.WordIds(VOCABULARY)
    for low in range(0, len(texts), 900):
        ids, sizes = words.encode(pa.array(texts[low : low + 900], pa.string()))
        found = [v.tolist() for v in np.split(ids, np.cumsum(sizes)[:-1])]
        assert found == [ids_of(t) for t in texts[low : low + 900]]


def test_latin_words_are_taken_apart_as_arrays(monkeypatch):
    texts = ["Ärger ÉLAN, Œuvre naïve Straße!", "ŸÿſŊŋ 12½x² µm", "«Ça» ×3"]
    monkeypatch.setattr(wordbpe, "PIECE", None)  # the pattern is for words one at a time
    ids, sizes = wordbpe.WordIds(VOCABULARY).encode(pa.array(texts))
    assert [v.tolist() for v in np.split(ids, np.cumsum(sizes)[:-1])] == [ids_of(t) for t in texts]
