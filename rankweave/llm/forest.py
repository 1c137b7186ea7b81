"""Union-find over numpy arrays, for the links found inside one task."""

from __future__ import annotations

import numpy as np


class Forest:
    """Sets of ``0 .. size - 1`` that links join; ``roots()`` gives the smallest member of each one's set."""

    def __init__(self, size: int):
        self.parent = np.arange(size)

    def roots(self) -> np.ndarray:
        while True:
            above = self.parent[self.parent]
            if np.array_equal(above, self.parent):
                return self.parent
            self.parent = above

    def link(self, a: np.ndarray, b: np.ndarray) -> None:
        while len(a):
            roots = self.roots()
            a, b = roots[a], roots[b]
            apart = a != b
            a, b = a[apart], b[apart]
            np.minimum.at(self.parent, np.maximum(a, b), np.minimum(a, b))
