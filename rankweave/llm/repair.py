"""Re-Pair grammars of token ids: repeated pairs become nonterminals, with expansion lengths for random access."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

from rankweave.llm.blocks import pack_ints, unpack_ints

#: How often a pair must occur to become a nonterminal.
LEAST = 2


@dataclass
class Grammar:
    """``symbols`` below ``terminals`` are token ids; symbol ``terminals + i`` stands for the two symbols of
    rule ``i``, which are older than it, and for ``lengths[i]`` ids."""

    terminals: int
    left: np.ndarray
    right: np.ndarray
    lengths: np.ndarray
    symbols: np.ndarray

    def pack(self) -> list[bytes]:
        return [pack_ints(v) for v in (self.left, self.right, self.lengths, self.symbols)]

    @classmethod
    def unpack(cls, terminals: int, parts: list[bytes]) -> Grammar:
        return cls(terminals, *map(unpack_ints, parts))

    def sizes(self, symbols: np.ndarray) -> np.ndarray:
        """How many ids each of the symbols stands for."""
        return np.concatenate([np.ones(self.terminals, dtype=np.int64), self.lengths])[symbols]

    def expand(self, first: int = 0, last: int | None = None) -> np.ndarray:
        """The ids of the symbols from place ``first`` to before ``last``: nonterminals give way to their two
        symbols until none is left."""
        symbols = self.symbols[first:last].astype(np.int64)
        sizes = np.concatenate([np.ones(self.terminals, dtype=np.int64), self.lengths])
        ends = np.cumsum(sizes[symbols])
        out = np.empty(int(ends[-1]) if len(ends) else 0, dtype=np.uint32)
        places = ends - sizes[symbols]
        while len(symbols):
            rule = symbols - self.terminals
            done = rule < 0
            out[places[done]] = symbols[done]
            rule, places = rule[~done], places[~done]
            left = self.left[rule]
            symbols = np.concatenate([left, self.right[rule]])
            places = np.concatenate([places, places + sizes[left]])
        return out

    def slice(self, start: int, length: int) -> np.ndarray:
        """``length`` ids from ``start`` on: expansion lengths lead to the symbols that hold them, and only
        those are expanded."""
        ends = np.cumsum(self.sizes(self.symbols))
        first = int(np.searchsorted(ends, start, side="right"))
        last = int(np.searchsorted(ends, start + length, side="left")) + 1
        before = int(ends[first - 1]) if first else 0
        return self.expand(first, last)[start - before : start - before + length]


def grouped(values: np.ndarray, counted: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Different values in order, how many of each are ``counted``, and each value's place among them."""
    # A value and its position are sorted as one number, which is far faster than an argsort.
    bits = len(values).bit_length()
    if int(values.max()).bit_length() + bits < 64:
        packed = np.sort((values << bits) | np.arange(len(values)))
        order, values = packed & ((1 << bits) - 1), packed >> bits
    else:
        order = np.argsort(values)
        values = values[order]
    fresh = np.append(True, values[1:] != values[:-1])
    place = np.empty(len(values), dtype=np.int32)
    place[order] = np.cumsum(fresh, dtype=np.int32) - np.int32(1)
    firsts = np.flatnonzero(fresh)
    counts = np.diff(np.append(firsts, len(values)))
    if not counted.all():
        counts -= np.bincount(place[~counted], minlength=len(counts))
    return values[firsts], counts, place


def chosen_pairs(lefts: np.ndarray, rights: np.ndarray, counts: np.ndarray, size: int) -> np.ndarray:
    """Which of the pairs to replace in one round; the most frequent one is always among them.

    A symbol is only left, only right or only doubled in a round, as in its most frequent pair, so no two
    occurrences overlap.
    """
    order = np.argsort(-counts, kind="stable")[::-1]
    rank = np.arange(len(counts))[::-1]
    double = lefts == rights
    first = np.full((3, size), len(counts), dtype=np.int32)
    # Of several assignments to one symbol the last stays: its most frequent pair.
    for at, symbols, pairs in ((0, lefts, ~double), (1, rights, ~double), (2, lefts, double)):
        mine = pairs[order]
        first[at, symbols[order[mine]]] = rank[mine]
    side = (first[1] < first[0]).astype(np.int8)
    side[first[2] < np.minimum(first[0], first[1])] = 2
    return np.where(double, side[lefts] == 2, (side[lefts] == 0) & (side[rights] == 1))


def compress(ids: np.ndarray, starts: np.ndarray, terminals: int) -> tuple[Grammar, np.ndarray]:
    """The grammar of ``ids`` and the places of ``starts`` (where documents begin) among its symbols.

    No nonterminal crosses a document's start, so a document is a run of whole symbols. Rounds go on until
    no pair occurs ``LEAST`` times in it. A round counts pairs exactly; a run of one symbol has every other
    of its pairs. Only places are looked at whose pair may still repeat: counts of known pairs never rise,
    so one that occurs less often stays out until a replacement changes it.
    """
    n = len(ids)
    symbols = np.append(ids, 0).astype(np.int32)
    begins = np.zeros(n + 1, dtype=bool)
    begins[starts] = begins[n] = True
    there = np.ones(n + 1, dtype=bool)
    # Places in 32 bits: most of the time goes into fetching from these arrays.
    after, before = np.arange(1, n + 2, dtype=np.int32), np.arange(-1, n, dtype=np.int32)
    left, right, size = [], [], terminals
    live = np.flatnonzero(~begins[1:]).astype(np.int32)
    while len(live):
        a, b = symbols[live], symbols[after[live]]
        # In a run of one symbol every other place counts; those between overlap the place before.
        same = np.flatnonzero(a == b)
        counted = np.ones(len(live), dtype=bool)
        if len(same):
            run = np.arange(len(same))
            joined = after[live[same[:-1]]] == live[same[1:]]
            first = np.maximum.accumulate(np.where(np.append(False, joined), 0, run))
            counted[same[(run - first) % 2 == 1]] = False
        found, counts, pair = grouped(a.astype(np.int64) * size + b, counted)
        often = counts >= LEAST
        if not often.any():
            break
        lefts, rights = np.divmod(found[often], size)
        chosen = chosen_pairs(lefts, rights, counts[often], size)
        names = np.full(len(found), -1, dtype=np.int32)
        names[np.flatnonzero(often)[chosen]] = size + np.arange(int(chosen.sum()))
        named = names[pair]
        hit = np.flatnonzero((named >= 0) & counted)
        live, where = live[often[pair]], live[hit]
        left.append(lefts[chosen])
        right.append(rights[chosen])
        size += len(left[-1])
        gone = after[where]
        symbols[where] = named[hit]
        there[gone] = False
        after[where] = after[gone]
        before[after[gone]] = where
        # The place before a new symbol has a new pair, too.
        earlier = before[where]
        earlier = earlier[earlier >= 0]
        live = live[there[live]]
        if len(live) > n >> 5:  # marking all places is less work than sorting
            marked = np.zeros(n, dtype=bool)
            marked[live] = marked[earlier] = True
            live = np.flatnonzero(marked).astype(np.int32)
        else:
            live = np.unique(np.concatenate([live, earlier]))
        live = live[~begins[after[live]]]
    symbols, begins = symbols[:n][there[:n]], begins[:n][there[:n]]
    lengths = np.ones(size, dtype=np.int64)
    at = terminals
    for a, b in zip(left, right):
        lengths[at : at + len(a)] = lengths[a] + lengths[b]
        at += len(a)
    empty = np.zeros(0, dtype=np.int64)
    grammar = Grammar(terminals, np.concatenate([empty, *left]), np.concatenate([empty, *right]), lengths[terminals:], symbols)
    return grammar, np.flatnonzero(begins)
