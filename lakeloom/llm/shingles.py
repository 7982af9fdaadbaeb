"""Shingle sets of texts as sorted 64-bit hashes, made with numpy inside Spark tasks.

Words are ``[^\\x20\\x09-\\x0D]+`` of the text with A-Z in lower case. A set holds the distinct
hashes of all runs of ``words`` words; a shorter text is one shingle, a text without words has
none. Two different shingles share a 64-bit hash with a chance of about 2^-60.

Hashing works on the UTF-8 bytes of an Arrow column: a word's hash is a polynomial over random
values of its bytes modulo 2^64, read off a running sum, so no word becomes an object.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text hashed at once; a longer text is a slice of its own, hashed in steps of as much.
SLICE_BYTES = 1 << 18
_RANDOM = np.random.default_rng(20240229)
_ODD = _RANDOM.integers(0, 1 << 63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BYTE = _RANDOM.integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BYTE[ord("A"):ord("Z") + 1] = _BYTE[ord("a"):ord("z") + 1]
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_BASE = 0x9E3779B97F4A7C15  # odd, 5 modulo 8
_INVERSE = pow(_BASE, -1, 1 << 64)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser of 64-bit integers (splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(base: int, n: int) -> np.ndarray:
    x = np.full(n, base, np.uint64)
    x[0] = 1
    return np.cumprod(x)


_POWER, _BACK = _powers(_BASE, SLICE_BYTES + 1), _powers(_INVERSE, SLICE_BYTES + 1)


def column_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column and the offsets of its texts in them (null: empty)."""
    if texts.null_count:
        texts = pc.fill_null(texts, "")
    wide = np.int64 if pa.types.is_large_string(texts.type) else np.int32
    offsets = np.frombuffer(texts.buffers()[1], wide)[texts.offset:texts.offset + len(texts) + 1].astype(np.int64) \
        if len(texts) else np.zeros(1, np.int64)
    data = np.frombuffer(texts.buffers()[2], np.uint8) if texts.buffers()[2] is not None else np.empty(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def slices(texts: pa.Array) -> Iterator[tuple[int, int]]:
    """Ranges of rows of about ``SLICE_BYTES`` in all, each of one row at least."""
    _, offsets = column_bytes(texts)
    lo = 0
    while lo < len(texts):
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + SLICE_BYTES, "right")) - 1)
        yield lo, hi
        lo = hi


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The hashes of all words in order, and how many each text has."""
    data, offsets = column_bytes(texts)
    inside = ~_SPACE[data]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    begins = offsets[:-1][offsets[:-1] < offsets[1:]]
    first[begins] = inside[begins]
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    last[begins[1:] - 1] = inside[begins[1:] - 1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    out = np.empty(len(starts), np.uint64)
    lo = 0
    while lo < len(starts):
        hi = max(lo + 1, int(np.searchsorted(ends, starts[lo] + SLICE_BYTES, "right")))
        a, b = starts[lo], ends[hi - 1]
        near = b - a <= SLICE_BYTES  # else it is one very long word
        power = _POWER[:b - a] if near else _powers(_BASE, int(b - a))
        sums = np.empty(b - a + 1, np.uint64)
        sums[0] = 0
        np.cumsum(_BYTE[data[a:b]] * power, out=sums[1:])
        s, e = starts[lo:hi] - a, ends[lo:hi] - a
        out[lo:hi] = mix((sums[e] - sums[s]) * (_BACK[s] if near else np.uint64(1)) + (e - s).astype(np.uint64))
        lo = hi
    return out, np.diff(np.searchsorted(starts, offsets))


def shingle_hashes(texts: pa.Array, words: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """The shingle hashes of all texts, in order and with repeats, and the texts' offsets in them."""
    h, counts = word_hashes(texts)
    k, n = words, len(h)
    ends = np.cumsum(counts)
    sizes = np.where(counts >= k, counts - k + 1, (counts > 0).astype(np.int64))
    offsets = np.concatenate([[0], np.cumsum(sizes)])
    # runs that start in the last k - 1 words of a text cross into the next one: left out
    sums = np.zeros(max(0, n - k + 1), np.uint64)
    for i in range(k if n >= k else 0):
        sums += h[i:n - k + 1 + i] * _ODD[i]
    out = np.empty(int(offsets[-1]), np.uint64)
    long = np.flatnonzero(counts >= k)
    own = np.arange(int(sizes[long].sum())) - np.repeat(np.cumsum(sizes[long]) - sizes[long], sizes[long])
    out[np.repeat(offsets[long], sizes[long]) + own] = mix(sums[np.repeat((ends - counts)[long], sizes[long]) + own])
    for t in np.flatnonzero((counts > 0) & (counts < k)):
        x = h[ends[t] - counts[t]:ends[t]]
        out[offsets[t]] = mix(np.array([(x * _ODD[k:k + len(x)]).sum() + np.uint64(len(x))], np.uint64))[0]
    return out, offsets


def sets(texts: pa.Array, words: int = 5) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    out = []
    for lo, hi in slices(texts):
        flat, at = shingle_hashes(texts.slice(lo, hi - lo), words)
        out += [np.unique(flat[a:b]) for a, b in zip(at[:-1], at[1:], strict=True)]
    return out


def overlap(a: np.ndarray, b: np.ndarray) -> int:
    """The size of the intersection of two sorted sets."""
    if len(a) > len(b):
        a, b = b, a
    if not len(a):
        return 0
    at = np.searchsorted(b, a)
    at[at == len(b)] = 0
    return int((b[at] == a).sum())
