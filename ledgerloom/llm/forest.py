"""Spanning forests of link lists inside a task."""

from __future__ import annotations

import numpy as np


class Forest:
    """Labels of n nodes under links that come in portions; the smallest node names a component."""

    def __init__(self, n: int):
        self.parent = np.arange(n)

    def link(self, i: np.ndarray, j: np.ndarray) -> None:
        while True:
            a, b = self.parent[i], self.parent[j]
            apart = a != b
            if not apart.any():
                return
            i, j, a, b = i[apart], j[apart], a[apart], b[apart]
            np.minimum.at(self.parent, np.maximum(a, b), np.minimum(a, b))
            while True:
                up = self.parent[self.parent]
                if np.array_equal(up, self.parent):
                    break
                self.parent = up

    def edges(self) -> tuple[np.ndarray, np.ndarray]:
        """Each node that isn't the smallest of its component, and that smallest node."""
        child = np.flatnonzero(self.parent != np.arange(len(self.parent)))
        return child, self.parent[child]
