"""URL filter: a broadcast trie over reversed host labels, then path segments."""

from __future__ import annotations

import pickle
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Largest pickled trie that is broadcast.
MAX_TRIE_BYTES = 256 << 20

LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}


class Rule(NamedTuple):
    """``verdict`` (allow or block) for ``host`` with its subdomains, where the path starts with ``path``."""

    verdict: str
    host: str
    path: str


def split_url(url: str | None) -> tuple[str, str]:
    """(host, path): what stands between the first ``://`` and ``/?#``, then up to ``?#``."""
    at = -1 if url is None else url.find("://")
    if at < 0:
        return "", ""
    rest = url[at + 3 :]
    cut = min((p for p in (rest.find("?"), rest.find("#")) if p >= 0), default=len(rest))
    rest = rest[:cut]
    slash = rest.find("/")
    host, path = (rest, "") if slash < 0 else (rest[:slash], rest[slash:])
    return host.translate(LOWER), path


class _Node:
    __slots__ = ("below", "ends", "paths")

    def __init__(self):
        self.below: dict[str, _Node] = {}  # by host label, or by path segment
        self.ends: dict[str, tuple] = {}  # by the start of the next segment: the rule that ends there
        self.paths: _Node | None = None  # of a host: its path segments


class UrlTrie:
    """Longest matching rule of a host and path.

    Longest means most characters of host and path; of equally long ones the longer host wins, and block
    wins over allow.
    """

    def __init__(self, rules: Iterable[Rule]):
        self.root = _Node()
        for rule in rules:
            node = self.root
            for label in reversed(rule.host.translate(LOWER).split(".")):
                node = node.below.setdefault(label, _Node())
            node.paths = node.paths or _Node()
            node = node.paths
            *whole, last = rule.path.split("/")
            for segment in whole:
                node = node.below.setdefault(segment, _Node())
            name = rule.host.translate(LOWER) + rule.path
            entry = ((len(name), len(rule.host), rule.verdict == "block"), name, rule.verdict)
            node.ends[last] = max(entry, node.ends.get(last, entry))

    def match(self, host: str, path: str) -> tuple[str | None, str | None]:
        """(rule, verdict), or (None, None) where no rule fits."""
        best, node, segments = None, self.root, path.split("/")
        for label in reversed(host.split(".")):
            node = node.below.get(label)
            if node is None:
                break
            if node.paths is not None:
                best = self._longest(node.paths, segments, best)
        return (best[1], best[2]) if best else (None, None)

    @staticmethod
    def _longest(node: _Node, segments: list[str], best: tuple | None) -> tuple | None:
        for segment in segments:
            for size in {len(start) for start in node.ends}:
                entry = node.ends.get(segment[:size]) if size <= len(segment) else None
                if entry and (best is None or entry > best):
                    best = entry
            node = node.below.get(segment)
            if node is None:
                break
        return best


def judge_urls(pages: DataFrame, rules: Iterable[Rule], url: str = "url", default: str = "allow") -> DataFrame:
    """Add ``judged``: struct of host, path, rule and verdict of each ``url``; every row is kept.

    A null url, or one without ``://``, has an empty host and path, so only a rule with an empty host and path
    could fit. Where no rule fits, ``rule`` is null and the verdict ``default``. An existing column
    ``judged`` is replaced, other columns stay. The trie grows with the rule list alone and is refused
    above ``MAX_TRIE_BYTES``.
    """
    trie = UrlTrie(rules)
    packed = cloudpickle.dumps(trie)  # with its classes, which executors need not have
    if len(packed) > MAX_TRIE_BYTES:
        raise ValueError(f"the rules take {len(packed)} bytes, more than the {MAX_TRIE_BYTES} that are broadcast")
    shared = pages.sparkSession.sparkContext.broadcast(packed)

    @F.pandas_udf("host string, path string, rule string, verdict string")
    def judge(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        own = pickle.loads(shared.value)
        for urls in batches:
            rows = []
            for value in urls:
                host, path = split_url(value)
                rule, verdict = own.match(host, path)
                rows.append((host, path, rule, verdict or default))
            yield pd.DataFrame(rows, columns=["host", "path", "rule", "verdict"])

    return pages.withColumn("judged", judge(F.col(url)))
