"""Counts of word-id paths: a shallow trie over the first ids with burstable hash containers below it."""

from __future__ import annotations

from collections import Counter

import numpy as np
import zstandard

#: Ids of a path; different paths in a container before it bursts; trie levels above containers; and
#: different paths in memory before whole subtrees are spilled, the largest first, until half is free.
LONGEST, BURST, LEVELS, HELD = 5, 2048, 3, 400_000
ID = np.dtype(">u4")


def packed_rows(rows: np.ndarray) -> bytes:
    """A matrix of unsigned numbers, as the byte planes that its columns need, compressed."""
    rows = np.ascontiguousarray(rows.T, dtype="<u8")
    widths = [max(1, (int(c.max(initial=0)).bit_length() + 7) // 8) for c in rows]
    planes = [c.view(np.uint8).reshape(-1, 8).T[:w].tobytes() for c, w in zip(rows, widths)]
    return bytes([len(widths), *widths]) + zstandard.compress(b"".join(planes), 1)


def unpacked_rows(body: bytes) -> np.ndarray:
    widths = list(body[1 : 1 + body[0]])
    planes = np.frombuffer(zstandard.decompress(body[1 + body[0] :]), dtype=np.uint8)
    length = len(planes) // sum(widths)
    out = np.zeros((len(widths), length, 8), dtype=np.uint8)
    at = 0
    for column, width in zip(out, widths):
        column[:, :width] = planes[at : at + width * length].reshape(width, length).T
        at += width * length
    return out.view("<i8")[:, :, 0].T


def row_order(rows: np.ndarray, columns: int = LONGEST) -> np.ndarray:
    """What sorts the rows by their first columns. As many ids as fit go into one key."""
    bits = max(1, int(rows[:, :columns].max(initial=0)).bit_length())
    fit = max(1, 63 // bits)
    keys = []
    for low in range(0, columns, fit):
        key = np.zeros(len(rows), dtype=np.int64)
        for c in range(low, min(low + fit, columns)):
            key = (key << bits) | rows[:, c]
        keys.append(key)
    return np.lexsort(keys[::-1]) if len(keys) > 1 else np.argsort(keys[0], kind="stable")


def summed_rows(rows: np.ndarray) -> np.ndarray:
    """Rows of ids and a count, sorted, with the counts of equal ids added."""
    if not len(rows):
        return rows
    rows = rows[row_order(rows, rows.shape[1] - 1)]
    new = np.ones(len(rows), dtype=bool)
    new[1:] = (rows[1:, :-1] != rows[:-1, :-1]).any(axis=1)
    starts = np.flatnonzero(new)
    out = rows[starts]
    out[:, -1] = np.add.reduceat(rows[:, -1], starts)
    return out


class HatTrie:
    """Counts of paths of up to ``LONGEST`` ids above 0, shorter ones filled up with 0.

    A first id leads to a hash container of the rest of its paths, as bytes; a container of more than
    ``BURST`` different ones becomes a node with a container for each next id.
    """

    def __init__(self, burst: int = BURST, held: int = HELD):
        self.burst, self.held = burst, held
        self.root: dict[int, Counter | dict] = {}
        self.sizes: Counter = Counter()

    def add(self, paths: np.ndarray) -> None:
        """Count the rows of a matrix of ids."""
        if not len(paths):
            return
        paths = paths[np.argsort((paths[:, 0].astype(np.int64) << 32) | paths[:, 1], kind="stable")]
        bytes_of = np.ascontiguousarray(paths.astype(ID)).view(np.uint8).reshape(len(paths), -1)
        self.rests = [np.ascontiguousarray(bytes_of[:, 4 * k :]).view(f"V{4 * (LONGEST - k)}").ravel() for k in range(1, LEVELS + 1)]
        self.paths = paths
        for first, low, high in self._runs(0, 0, len(paths)):
            node = self.root.get(first)
            if node is None:
                node = self.root[first] = Counter()
            before = len(node) if isinstance(node, Counter) else 0
            node, grown = self._fed(node, 1, low, high, before)
            self.root[first] = node
            self.sizes[first] += grown
        del self.rests, self.paths

    def _runs(self, column: int, low: int, high: int) -> list[tuple[int, int, int]]:
        """Equal ids of a column from ``low`` to ``high``."""
        values = self.paths[low:high, column]
        if column > 1:  # rows are sorted by two columns only
            order = np.argsort(values, kind="stable")
            self.paths[low:high] = self.paths[low:high][order]
            for rest in self.rests:
                rest[low:high] = rest[low:high][order]
        cuts = (np.flatnonzero(values[1:] != values[:-1]) + low + 1).tolist()
        starts = [low, *cuts]
        return list(zip(values[np.array(starts) - low].tolist(), starts, [*cuts, high]))

    def _fed(self, node: Counter | dict, level: int, low: int, high: int, before: int) -> tuple[Counter | dict, int]:
        """The node with the rows added, and by how many different paths it grew."""
        if isinstance(node, Counter):
            node.update(self.rests[level - 1][low:high].tolist())
            grown = len(node) - before
            if len(node) > self.burst and level < LEVELS:
                children: dict[int, Counter] = {}
                for rest, count in node.items():
                    children.setdefault(int.from_bytes(rest[:4], "big"), Counter())[rest[4:]] = count
                return children, grown
            return node, grown
        grown = 0
        for following, start, end in self._runs(level, low, high):
            child = node.get(following)
            if child is None:
                child = node[following] = Counter()
            node[following], more = self._fed(child, level + 1, start, end, len(child) if isinstance(child, Counter) else 0)
            grown += more
        return node, grown

    def full(self) -> bool:
        return self.sizes.total() > self.held

    def _listed(self, node: Counter | dict, path: list[int], out: list[np.ndarray]) -> None:
        if isinstance(node, Counter):
            rest = np.frombuffer(b"".join(node), dtype=ID).reshape(len(node), LONGEST - len(path))
            rows = np.empty((len(node), LONGEST + 1), dtype=np.int64)
            rows[:, : len(path)] = path
            rows[:, len(path) : LONGEST] = rest
            rows[:, LONGEST] = np.fromiter(node.values(), dtype=np.int64, count=len(node))
            out.append(rows)
        else:
            for following, child in node.items():
                self._listed(child, [*path, following], out)

    def spilled(self, everything: bool = False) -> np.ndarray:
        """A sorted run of whole subtrees, ids and a count in each row, which leave the trie."""
        out, goal = [], 0 if everything else self.held // 2
        left = self.sizes.total()
        for first, size in self.sizes.most_common():
            if left <= goal:
                break
            self._listed(self.root.pop(first), [first], out)
            del self.sizes[first]
            left -= size
        rows = np.concatenate(out) if out else np.zeros((0, LONGEST + 1), dtype=np.int64)
        return rows[row_order(rows)]
