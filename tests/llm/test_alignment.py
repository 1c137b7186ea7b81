"""The alignment of two tokenizers against whole-text encoding and pairwise comparison."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from tokenizers import Tokenizer

from rankweave.llm import alignment
from rankweave.llm.queries import QUERIES
from rankweave.llm.wordbpe import BYTE_CHARS

PATHS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def overlaps(ends_a, ends_b):
    """Groups and links of two lists of ends by comparing every token with every other."""
    begins_a, begins_b = [0, *ends_a[:-1]], [0, *ends_b[:-1]]
    links = [
        (i, j)
        for i, (a, b) in enumerate(zip(begins_a, ends_a))
        for j, (c, d) in enumerate(zip(begins_b, ends_b))
        if a < d and c < b
    ]
    groups, i, j = [], 0, 0
    for end in sorted({*ends_a} & {*ends_b}):
        groups.append((i, ends_a.index(end) + 1, j, ends_b.index(end) + 1))
        i, j = groups[-1][1], groups[-1][3]
    return groups, links


def test_galloping_finds_every_group_and_link():
    rng = random.Random(2)
    for _ in range(300):
        every, base = [], 0
        for _ in range(rng.randint(1, 6)):  # segments, of which the first side has fewer tokens or as many
            n = rng.randint(1, 40)
            ends = sorted((sorted({*rng.sample(range(1, n + 1), rng.randint(1, n)), n}) for _ in range(2)), key=len)
            every.append([[e + base for e in side] for side in ends])
            base += n
        flat = [np.array([e for ends in every for e in ends[k]]) for k in (0, 1)]
        sizes = [np.array([len(ends[k]) for ends in every]) for k in (0, 1)]
        found = alignment.align(flat[0], sizes[0], flat[1], sizes[1])
        groups, links = overlaps(*[side.tolist() for side in flat])
        assert list(zip(found.link_short.tolist(), found.link_long.tolist())) == links
        for number, (i, j, k, n) in enumerate(groups):
            assert found.group_short[i:j].tolist() == [number] * (j - i)
            assert found.group_long[k:n].tolist() == [number] * (n - k)


def test_segments_are_encoded_as_the_whole_text_is():
    tokens = alignment.Tokens(*PATHS)
    rng = random.Random(5)
    parts = [*"abXY'stre01.,!- \t\n\r\x0b\x1c\x85\xa0éßç«ÿ  　中ﬁ́▁\x00🙂", "<|endoftext|>", "<s>", "</s>", "  ", "   ", " the", "\n\n", "<0x0A>"]
    texts = ["".join(rng.choices(parts, k=rng.randint(0, 20))) for _ in range(3000)]
    segments, starts = alignment.segments(pa.array(texts))
    every = segments.to_pylist()
    found = alignment.aligned(tokens, list(dict.fromkeys(every)))
    made_whole = dict(zip(found.names, found.whole.tolist()))
    known = {s: (a, b, made_whole[s]) for s, a, b in tokens.encode(list(dict.fromkeys(every)))}
    for k, text in enumerate(texts):
        own = every[starts[k] : starts[k + 1]]
        assert b"".join(own) == ((" " + text).encode() if text else b"")
        if text:
            a, b = tokens.a.encode(" " + text, add_special_tokens=False).ids, tokens.b.encode(text)
            whole = b"".join(tokens.bytes_b[i] for i in b) == (" " + text).encode()
            assert all(known[s][2] for s in own) == whole
            if whole:
                assert [i for s in own for i in known[s][0]] == a
                assert [i for s in own for i in known[s][1]] == b


def brute(rows):
    """The rows of the operator, from whole texts."""
    a, b = Tokenizer.from_file(PATHS[0]), sentencepiece.SentencePieceProcessor(model_file=PATHS[1])
    a.encode_special_tokens = True
    back = {c: n for n, c in BYTE_CHARS.items()}
    found, documents = [], Counter()
    for doc_id, text in rows:
        ids_a, ids_b, groups, links = [], [], [], []
        if text:
            ids_a, ids_b = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
            parts = [
                [bytes(back[c] for c in a.id_to_token(i)) for i in ids_a],
                [bytes([int(b.id_to_piece(i)[3:-1], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in ids_b],
            ]
            if any(b"".join(p) != (" " + text).encode() for p in parts):
                ids_a = ids_b = []
            else:
                ends = [[sum(map(len, p[: k + 1])) for k in range(len(p))] for p in parts] if len(text) < 3000 else [list(_sums(p)) for p in parts]
                cut, pairs = overlaps(*ends) if len(text) < 3000 else alignment_by_bytes(*ends)
                groups = [(ids_a[i:j], ids_b[k:n]) for i, j, k, n in cut]
                links = [(ids_a[i], ids_b[j]) for i, j in pairs]
        found.append((doc_id, ids_a, ids_b, groups, links))
        documents.update(set(links))
    best = defaultdict(int)
    for (i, _), n in documents.items():
        best[i] = max(best[i], n)
    out = []
    for doc_id, ids_a, ids_b, groups, links in found:
        said = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        sha = hashlib.sha256(said.encode()).hexdigest() if said else ""
        tops = sum(documents[p] == best[p[0]] for p in links)
        out.append((doc_id, len(ids_a), len(ids_b), len(groups), len(links), tops, sum(documents[p] for p in links), sha))
    return out


def _sums(parts):
    total = 0
    for part in parts:
        total += len(part)
        yield total


def alignment_by_bytes(ends_a, ends_b):
    """As ``overlaps``, from the token numbers of each byte."""
    owner = [[k for k, (low, high) in enumerate(zip([0, *ends], ends)) for _ in range(high - low)] for ends in (ends_a, ends_b)]
    links = sorted(set(zip(*owner)))
    common, groups, i, j = sorted({*ends_a} & {*ends_b}), [], 0, 0
    places = [{e: k for k, e in enumerate(ends)} for ends in (ends_a, ends_b)]
    for end in common:
        groups.append((i, places[0][end] + 1, j, places[1][end] + 1))
        i, j = groups[-1][1], groups[-1][3]
    return groups, links


def test_alignment_of_documents(spark, documents):
    path, rows = documents
    got = [tuple(r) for r in QUERIES["op12_alignment"](spark, path).collect()]
    assert sorted(got, key=str) == sorted(brute(rows), key=str)


@pytest.mark.parametrize("block_bytes", [1, 4000])
def test_blocks_do_not_matter(spark, documents, block_bytes):
    path, rows = documents
    short = [r for r in rows if r[1] is None or len(r[1]) < 3000] + [(7, "a▁b"), (8, "<s> x </s>"), (9, "ends ")]
    docs = spark.createDataFrame(short, "key long, body string").repartition(2)
    got = alignment.align_documents(docs, *PATHS, doc_id="key", text="body", block_bytes=block_bytes).collect()
    assert sorted(map(tuple, got), key=str) == sorted(brute(short), key=str)
