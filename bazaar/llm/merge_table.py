"""Byte-pair merges of many equally long pieces at once."""

from __future__ import annotations

import numpy as np

_NONE = np.int32(1 << 30)


class Merges:
    """A merge list as sorted pair keys; ``pairs`` are (left id, right id, made id) by rank."""

    def __init__(self, pairs: list[tuple[int, int, int]], size: int) -> None:
        self.size = size
        keys = np.array([a * size + b for a, b, _ in pairs], np.int64)
        made = np.array([c for *_, c in pairs], np.int64)
        order = np.argsort(keys)
        self.keys, self.rank, self.made = keys[order], order.astype(np.int32), made

    def _ranks(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank of the merge of each pair, or _NONE."""
        k = a * self.size + b
        at = np.minimum(np.searchsorted(self.keys, k), len(self.keys) - 1)
        return np.where(self.keys[at] == k, self.rank[at], _NONE)

    def merged(self, ids: np.ndarray):
        """Merges the rows of a matrix; yields (row numbers, ids) of finished rows.

        Every unfinished row loses one id in a round, so all have the same width.
        """
        rows = np.arange(len(ids))
        rank = self._ranks(ids[:, :-1], ids[:, 1:])
        while ids.shape[1] > 1:
            j = rank.argmin(1)
            best = rank[np.arange(len(rows)), j]
            go = best < _NONE
            if not go.all():
                yield rows[~go], ids[~go]
                rows, ids, rank, j, best = rows[go], ids[go], rank[go], j[go], best[go]
            if not len(rows):
                return
            at, col = np.arange(len(rows)), np.arange(ids.shape[1] - 1)
            ids[at, j] = self.made[best]
            ids = np.take_along_axis(ids, col + (col > j[:, None]), 1)
            if ids.shape[1] == 1:
                break
            rank = np.take_along_axis(rank, col[:-1] + (col[:-1] >= j[:, None]), 1)
            left = np.flatnonzero(j > 0)
            rank[left, j[left] - 1] = self._ranks(ids[left, j[left] - 1], ids[left, j[left]])
            right = np.flatnonzero(j < ids.shape[1] - 1)
            rank[right, j[right]] = self._ranks(ids[right, j[right]], ids[right, j[right] + 1])
        if len(rows):
            yield rows, ids
