"""Words and shingles of whole texts as 64-bit hashes, for a batch at a time.

Words are ``[^\\x20\\x09-\\x0D]+`` after lower-casing A-Z.  A word's hash is a
polynomial over its bytes, taken from running sums over the whole batch, so no
word becomes a Python object.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np

#: Bytes of text worked on at once (a longer single text is worked on alone).
CHUNK_BYTES = 1 << 20

_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words that spreads every bit."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= _M1
    x ^= x >> np.uint64(27)
    x *= _M2
    x ^= x >> np.uint64(31)
    return x


def seeds(n: int, salt: int) -> np.ndarray:
    """``n`` fixed pseudo-random 64-bit words."""
    return mix(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(_BASE) + np.uint64(salt))


LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
SPACES = np.zeros(256, bool)
SPACES[[0x20, *range(0x09, 0x0E)]] = True
_BYTE = seeds(256, 11)


@lru_cache(maxsize=1)
def _powers(n: int):
    up, down = np.full(n, _BASE, np.uint64), np.full(n, _INVERSE, np.uint64)
    up[0] = down[0] = 1
    return np.cumprod(up, dtype=np.uint64), np.cumprod(down, dtype=np.uint64)


def ranges(offsets: np.ndarray, most: int = CHUNK_BYTES):
    """(first, end) row ranges of at most ``most`` bytes, one row at least."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + most, "right")) - 1)
        yield i, j
        i = j


def words(body: np.ndarray, offsets: np.ndarray, solid_bytes: np.ndarray | None = None):
    """(row of each word, hash of each word, first byte, end byte);
    ``solid_bytes``: which bytes words are made of, all but white space if None."""
    n, rows = len(body), len(offsets) - 1
    if n == 0:
        e = np.empty(0, np.int64)
        return e, np.empty(0, np.uint64), e, e
    low = LOWER[body]
    solid = (~SPACES if solid_bytes is None else solid_bytes)[low]
    starts = np.empty(n, bool)
    starts[0] = True
    starts[1:] = ~solid[:-1]
    firsts = offsets[:-1][offsets[:-1] < n]
    starts[firsts] = True  # rows meet without white space between
    starts &= solid
    ends = np.empty(n, bool)
    ends[-1] = True
    ends[:-1] = ~solid[1:]
    last = offsets[1:][offsets[1:] > 0] - 1
    ends[last] = True
    ends &= solid
    a, b = np.flatnonzero(starts), np.flatnonzero(ends) + 1
    size = 1 << max(20, int(n).bit_length())
    up, down = _powers(size)
    run = np.empty(n + 1, np.uint64)
    run[0] = 0
    np.cumsum(_BYTE[low] * up[:n], dtype=np.uint64, out=run[1:])
    h = mix((run[b] - run[a]) * down[a] + (b - a).astype(np.uint64))
    row = np.searchsorted(offsets, a, "right") - 1
    return np.minimum(row, rows - 1), h, a, b


def ngrams(h: np.ndarray, k: int) -> np.ndarray:
    """Hash of the words i .. i+k-1 for every i that has so many after it."""
    n = len(h) - k + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for j, s in enumerate(seeds(k, 23) | np.uint64(1)):
        out += h[j:j + n] * s
    return mix(out)


def shingle_sets(body: np.ndarray, offsets: np.ndarray, k: int):
    """(sorted distinct shingles of all rows, bounds): row i has
    ``[bounds[i]:bounds[i+1]]``.  A row of fewer than ``k`` words is one
    shingle, its whole sequence; one without words is empty."""
    rows = len(offsets) - 1
    row, h, _, _ = words(body, offsets)
    count = np.bincount(row, minlength=rows)
    g = ngrams(h, k)
    own = row[:len(g)]
    inside = own == row[k - 1:] if len(g) else np.empty(0, bool)
    g, own = g[inside], own[inside]
    few = np.flatnonzero((count > 0) & (count < k))
    if len(few):
        first = np.concatenate([[0], np.cumsum(count)])
        short = np.array([mix(ngrams(h[first[i]:first[i] + count[i]], int(count[i])) + np.uint64(count[i]))[0] for i in few],
                         np.uint64)
        g, own = np.concatenate([g, short]), np.concatenate([own, few])
        order = np.argsort(own, kind="stable")
        g, own = g[order], own[order]
    bounds = np.concatenate([[0], np.cumsum(np.bincount(own, minlength=rows))])
    for i in range(rows):
        g[bounds[i]:bounds[i + 1]].sort()
    if len(g):
        new = np.empty(len(g), bool)
        new[0] = True
        new[1:] = (g[1:] != g[:-1]) | (own[1:] != own[:-1])
        g, own = g[new], own[new]
        bounds = np.concatenate([[0], np.cumsum(np.bincount(own, minlength=rows))])
    return g, bounds


def per_row(fold, values: np.ndarray, bounds: np.ndarray, empty):
    """``fold.reduceat`` over the rows' values; ``empty`` where a row has none."""
    out = np.full(len(bounds) - 1, empty, values.dtype)
    full = bounds[1:] > bounds[:-1]
    if full.any():
        out[full] = fold.reduceat(values, bounds[:-1][full])
    return out
