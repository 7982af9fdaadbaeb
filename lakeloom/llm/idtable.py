"""A worker's table of piece → token ids, filled in batches by a tokenizer."""

from __future__ import annotations

from collections.abc import Callable, Hashable
from itertools import chain, repeat

import numpy as np

#: Pieces in a table before it is started anew (a cache: results don't depend on it); about 200 bytes each.
TABLE_PIECES = 800_000


class IdTable:
    """Ids of texts that are given as lists of pieces which a tokenizer encodes apart.

    ``learn`` encodes a list of new pieces. Each distinct piece is encoded once; the ids of whole
    texts are then gathered from one flat array.
    """

    def __init__(self, learn: Callable[[list], list[list[int]]]):
        self.learn = learn
        self.clear()

    def clear(self) -> None:
        self.at: dict[Hashable, int] = {}
        self.ids = np.empty(1 << 16, np.int32)
        self.starts = np.empty(1 << 16, np.int64)
        self.sizes = np.empty(1 << 16, np.int64)
        self.used = 0

    def _add(self, new: list) -> None:
        found = self.learn(new)
        sizes = np.fromiter(map(len, found), np.int64, len(found))
        lo, hi, end = len(self.at), len(self.at) + len(new), self.used + int(sizes.sum())
        while end > len(self.ids):
            self.ids = np.concatenate([self.ids, np.empty_like(self.ids)])
        while hi > len(self.starts):
            self.starts = np.concatenate([self.starts, np.empty_like(self.starts)])
            self.sizes = np.concatenate([self.sizes, np.empty_like(self.sizes)])
        self.ids[self.used:end] = np.fromiter(chain.from_iterable(found), np.int32, end - self.used)
        self.starts[lo:hi], self.sizes[lo:hi] = self.used + np.cumsum(sizes) - sizes, sizes
        self.used = end
        self.at.update(zip(new, range(lo, hi), strict=True))

    def _rows(self, keys: list) -> np.ndarray:
        """The table's row of each piece, after the new ones have been learned."""
        rows = np.fromiter(map(self.at.get, keys, repeat(-1)), np.int64, len(keys))
        lacking = np.flatnonzero(rows < 0)
        if len(lacking):
            pieces = [keys[i] for i in lacking.tolist()]
            self._add(list(dict.fromkeys(pieces)))
            rows[lacking] = np.fromiter(map(self.at.__getitem__, pieces), np.int64, len(pieces))
        return rows

    def encode(self, split: list[list], end_id: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Flat ids of all texts, each followed by ``end_id`` if given, and the texts' offsets in them."""
        counts = np.fromiter(map(len, split), np.int64, len(split))
        return self.gather(list(chain.from_iterable(split)), None, counts, end_id)

    def gather(self, keys: list, codes: np.ndarray | None, counts: np.ndarray, end_id: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """As ``encode``, for the pieces ``keys[codes]`` (all keys in order, if there are no codes) of texts of ``counts`` pieces."""
        if len(self.at) > TABLE_PIECES or self.used > 8 * TABLE_PIECES:
            self.clear()
        end, texts = int(end_id is not None), len(counts)
        which = self._rows(keys)
        if codes is not None:
            which = which[codes]
        sizes = self.sizes[which]
        text = np.repeat(np.arange(texts), counts)
        before = np.cumsum(sizes) - sizes
        total = int(sizes.sum())
        within = np.arange(total) - np.repeat(before, sizes)
        out = np.full(total + end * texts, end_id or 0, np.int32)
        # each earlier text has added its end id
        out[np.repeat(before + end * text, sizes) + within] = self.ids[np.repeat(self.starts[which], sizes) + within]
        per_text = np.bincount(text, weights=sizes, minlength=texts).astype(np.int64) + end
        return out, np.concatenate([[0], np.cumsum(per_text)])


def looked_up(keys: list, known: dict, learn: Callable[[list], None]) -> list:
    """The values of ``keys`` in ``known``, after ``learn`` has put in those that it lacks."""
    found = list(map(known.get, keys))
    if None in found:
        learn(list(dict.fromkeys(k for k, v in zip(keys, found, strict=True) if v is None)))
        found = list(map(known.__getitem__, keys))
    return found


def row_slices(sizes: list[int], most: int) -> list[tuple[int, int]]:
    """Ranges of rows of about ``most`` in all, each of one row at least."""
    out, lo, total = [], 0, 0
    for i, n in enumerate(sizes):
        if i > lo and total + n > most:
            out.append((lo, i))
            lo, total = i, 0
        total += n
    return [*out, (lo, len(sizes))] if lo < len(sizes) else out
