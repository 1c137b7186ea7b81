"""Token ids of whole texts by a lower-casing word BPE, each different piece encoded once in a task."""

from __future__ import annotations

import re
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from tokenizers import Tokenizer

from rankweave.llm.blocks import ragged

#: The splitting pattern of the vocabulary file, and the byte characters of byte-level BPE (fixed values).
PIECE = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
SHOWN = [*range(33, 127), *range(161, 173), *range(174, 256)]
BYTE_CHARS = {b: chr(b) for b in SHOWN} | {b: chr(256 + i) for i, b in enumerate(sorted({*range(256)} - {*SHOWN}))}
BYTE_CODES = np.array([ord(BYTE_CHARS[b]) for b in range(256)], dtype="<u4")
#: str.split() parts words here, the tokenizer does not.
NOT_SPACE = "\x1c\x1d\x1e\x1f"
#: Below this code point, lower-casing and normal form work on each character alone.
PLAIN = "\u0250"
#: Marks words that the tokenizer itself takes apart. Pieces are lower-case, so none begins with it.
WHOLE = "W"
END = 1
#: Different pieces that are remembered.
REMEMBERED = 1_000_000

LETTER, DIGIT, OTHER = 0, 1, 2
#: Characters of one or two bytes that are taken apart as arrays, but for those that lower-casing makes two of or
#: that are white space.
SHORT = 0x180
APART = [c for c in range(128, SHORT) if len(chr(c).lower()) > 1 or chr(c).isspace()]
#: What kind each of them is for the splitting pattern (an apostrophe may begin a piece with letters), and its lower case.
KINDS = np.array([LETTER if regex.match(r"\p{L}", chr(c)) else DIGIT if regex.match(r"\p{N}", chr(c)) else OTHER for c in range(SHORT)], dtype=np.uint8)
SMALL = np.array([c if c in APART else ord(chr(c).lower()) for c in range(SHORT)], dtype=np.uint16)


def tokenizer(path: str) -> Tokenizer:
    return Tokenizer.from_file(path)


def added_tokens(path: str) -> list[str]:
    """What the tokenizer looks for in a text before anything else, exactly as written."""
    return [t.content for t in tokenizer(path).get_added_tokens_decoder().values()]


class WordIds:
    """Ids of texts by a lower-casing word BPE.

    White space always parts words, and words consist of pieces, each of which is encoded by itself: a batch
    is taken apart as whole arrays, and only pieces not met before go to the tokenizer.
    """

    def __init__(self, vocabulary: str):
        self.own = tokenizer(vocabulary)
        self.terminals = self.own.get_vocab_size()
        self.whole = "|".join(re.escape(c) for c in [*NOT_SPACE, *added_tokens(vocabulary)])
        self._forget()

    def _forget(self) -> None:
        self.numbers: dict[str, int] = {}
        self.ids: list[np.ndarray] = [np.zeros(0, dtype=np.uint32)]
        self.sizes: list[np.ndarray] = [np.zeros(0, dtype=np.int64)]

    def _numbered(self, pieces: list[str]) -> np.ndarray:
        """Numbers of pieces into the tables of ids, which grow by those that are new."""
        numbers = self.numbers
        new = list(dict.fromkeys(p for p in pieces if p not in numbers))
        numbers.update(zip(new, range(len(numbers), len(numbers) + len(new))))
        found = np.fromiter(map(numbers.__getitem__, pieces), dtype=np.int64, count=len(pieces))
        # No piece holds a line end. All are put in byte characters together.
        joined = "\n".join(["" if p.startswith(WHOLE) else p for p in new]).encode()
        shown = BYTE_CODES[np.frombuffer(joined, dtype=np.uint8)].tobytes().decode("utf-32-le").split(BYTE_CHARS[10])
        # Ids go into one list, as a list for each piece is much for Python to keep track of.
        said, ends, tokenize = [], [0], self.own.model.tokenize
        for piece, chars in zip(new, shown):
            said += [t.id for t in tokenize(chars)] if chars else self.own.encode(piece[len(WHOLE) :], add_special_tokens=False).ids
            ends.append(len(said))
        self.ids.append(np.array(said, dtype=np.uint32))
        self.sizes.append(np.diff(np.array(ends, dtype=np.int64)))
        return found

    def _pieces(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Piece numbers, and where each word's begin and how many they are."""
        offsets = np.frombuffer(words.buffers()[1], dtype=np.int32)[words.offset : words.offset + len(words) + 1]
        low, high = int(offsets[0]), int(offsets[-1])
        data = np.frombuffer(words.buffers()[2] or b"", dtype=np.uint8)[low:high].copy()
        offsets = offsets - low
        slow = np.zeros(len(words), dtype=bool)
        word_of = np.repeat(np.arange(len(words), dtype=np.int32), np.diff(offsets))
        # Characters of two bytes become small letters; their second byte has the kind of the first.
        leads = np.flatnonzero((data >= 0xC2) & (data < 0xC0 | SHORT >> 6))
        seconds = leads + 1
        code = (data[leads] & 31).astype(np.uint16) << 6 | data[seconds] & 63
        slow[word_of[(data == ord("'")) | (data >= 0xC0 | SHORT >> 6)]] = True
        slow[word_of[leads[np.isin(code, APART)]]] = True
        kind = KINDS[np.minimum(data, 127)]
        kind[leads] = kind[seconds] = KINDS[code]
        code = SMALL[code]
        data[leads], data[seconds] = 0xC0 | code >> 6, 0x80 | code & 63
        begins = np.empty(len(data), dtype=bool)
        begins[:1] = True
        begins[1:] = (kind[1:] != kind[:-1]) | (kind[1:] == DIGIT)
        begins[seconds] = False
        begins[offsets[:-1][offsets[:-1] < len(data)]] = True
        cuts = np.flatnonzero(begins)
        owner = word_of[cuts]
        parts = pa.Array.from_buffers(pa.string(), len(cuts), [None, pa.py_buffer(np.append(cuts, len(data)).astype(np.int32)), pa.py_buffer(data)])
        fast = ~slow[owner]
        if slow.any():
            parts = parts.filter(pa.array(fast))
        coded = parts.dictionary_encode()
        named, lists = coded.dictionary.to_numpy(zero_copy_only=False).tolist(), []
        for word in words.filter(pa.array(slow)).to_pylist():
            lists.append(PIECE.findall(word.lower()) if max(word) < PLAIN else [WHOLE + word])
        numbers = self._numbered([*named, *chain.from_iterable(lists)])
        pieces = np.concatenate([numbers[coded.indices.to_numpy(zero_copy_only=False)], numbers[len(named) :]])
        counts = np.bincount(owner[fast], minlength=len(words))
        firsts = np.cumsum(counts) - counts
        sizes = np.array([len(v) for v in lists], dtype=np.int64)
        counts[slow], firsts[slow] = sizes, int(fast.sum()) + np.cumsum(sizes) - sizes
        return pieces, firsts, counts

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, an end after each, and how many each has. Null is empty."""
        if len(self.numbers) > REMEMBERED:
            self._forget()
        texts = pc.fill_null(texts, "")
        odd = pc.match_substring_regex(texts, self.whole)
        split = pc.utf8_split_whitespace(pc.ascii_lower(pc.if_else(odd, "", texts)))
        coded = split.flatten().dictionary_encode()
        pieces, firsts, counts = self._pieces(coded.dictionary)
        # Texts that the tokenizer must see whole are one word; so is the end.
        whole = np.flatnonzero(odd.to_numpy(zero_copy_only=False))
        apart = self._numbered([WHOLE + texts[int(i)].as_py() for i in whole])
        firsts = np.concatenate([firsts, len(pieces) + np.arange(len(whole))])
        counts = np.concatenate([counts, np.ones(len(whole), dtype=np.int64)])
        pieces = np.concatenate([pieces, apart])
        self.ids, self.sizes = [np.concatenate(self.ids)], [np.concatenate(self.sizes)]
        flat, sizes = self.ids[0], self.sizes[0]
        starts = np.cumsum(sizes) - sizes
        pieces = pieces[ragged(firsts, counts)]
        at = np.cumsum(counts) - counts
        piece_ends = np.concatenate([[0], np.cumsum(sizes[pieces])])
        word_sizes = np.append(piece_ends[at + counts] - piece_ends[at], 1)
        of_words = np.append(flat[ragged(starts[pieces], sizes[pieces])], np.uint32(END))
        word_starts = np.cumsum(word_sizes) - word_sizes
        offsets = split.offsets.to_numpy().astype(np.int64)
        offsets -= offsets[0] if len(offsets) else 0
        code = np.insert(coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), offsets[1:], len(word_sizes) - 1)
        first = offsets[:-1] + np.arange(len(texts))
        code[first[whole]] = len(coded.dictionary) + np.arange(len(whole))  # an odd text was one empty word
        ids = of_words[ragged(word_starts.astype(np.int32)[code], word_sizes[code])]
        return ids, np.add.reduceat(word_sizes[code], first) if len(first) else np.zeros(0, dtype=np.int64)
