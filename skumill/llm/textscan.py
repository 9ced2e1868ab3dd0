"""Array scans over the bytes of an Arrow string column, shared by the text operators.

Whole texts are cut into words at byte level and every word gets a 64-bit hash
that depends on its bytes alone.  The work is a handful of numpy passes over a
bounded piece of the column, so memory follows the longest text of a batch and
not the number of rows.

The hash is a polynomial over the bytes modulo 2**64 with an odd base, passed
through a bit mixer.  Distinct words collide with a probability of about 2**-64
a pair; callers that need certainty compare the bytes as well.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

#: Bytes hashed in one numpy pass.
PIECE = 1 << 20
BASE = 0x9E3779B97F4A7C15 | 1
_MASK = (1 << 64) - 1
_U = np.uint64

#: Maps A-Z to a-z and leaves every other byte.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

#: Everything but space and tab to carriage return.
NON_SPACE = np.ones(256, dtype=bool)
NON_SPACE[[32, *range(9, 14)]] = False

#: Digits, a-z and every byte of a non-ASCII character.
WORD = np.zeros(256, dtype=bool)
WORD[48:58] = WORD[97:123] = WORD[128:] = True


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**0..base**n and the same for the inverse of the base, modulo 2**64."""
    if _powers.cache is None or len(_powers.cache[0]) <= n:
        both = []
        for base in (BASE, pow(BASE, -1, 1 << 64)):
            p = np.full(n + 1, base, dtype=_U)
            p[0] = 1
            both.append(np.cumprod(p, dtype=_U))
        if n > PIECE:
            return both[0], both[1]
        _powers.cache = (both[0], both[1])
    return _powers.cache


_powers.cache = None


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit (splitmix64's finaliser)."""
    h = h ^ (h >> _U(30))
    h = h * _U(0xBF58476D1CE4E5B9)
    h ^= h >> _U(27)
    h *= _U(0x94D049BB133111EB)
    h ^= h >> _U(31)
    return h


def column_bytes(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and its n + 1 offsets; a null has no bytes."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if col.null_count:
        col = col.fill_null("")
    wide = pa.types.is_large_string(col.type) or pa.types.is_large_binary(col.type)
    _, offs, data = col.buffers()
    o = np.frombuffer(offs, dtype=np.int64 if wide else np.int32)[col.offset : col.offset + len(col) + 1].astype(np.int64)
    if data is None:
        return np.zeros(0, np.uint8), np.zeros(len(col) + 1, np.int64)
    return np.frombuffer(data, dtype=np.uint8)[o[0] : o[-1]], o - o[0]


def slices(offs: np.ndarray, most: int = 4 * PIECE):
    """Row ranges of about `most` bytes: one long text makes a range of its own."""
    n, i = len(offs) - 1, 0
    while i < n:
        j = max(i + 1, int(np.searchsorted(offs, offs[i] + most, side="right")) - 1)
        yield i, min(j, n)
        i = min(j, n)


def word_spans(low: np.ndarray, offs: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end byte of each word, and the n + 1 bounds of each row's words.

    `low` are the (lower-cased) bytes, `inside` says which bytes belong to words.
    A word never crosses the bounds of its row.
    """
    if not len(low):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offs), np.int64)
    w = inside[low]
    before = np.empty_like(w)
    before[0], before[1:] = False, w[:-1]
    cuts = offs[:-1][offs[:-1] < len(low)]
    before[cuts] = False
    starts = np.flatnonzero(w & ~before)
    after = np.empty_like(w)
    after[-1], after[:-1] = False, w[1:]
    after[cuts[cuts > 0] - 1] = False
    ends = np.flatnonzero(w & ~after) + 1
    return starts, ends, np.searchsorted(starts, offs)


def span_hashes(low: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span of `low`; equal bytes give equal hashes."""
    out = np.empty(len(starts), dtype=_U)
    i = 0
    while i < len(starts):
        top = int(starts[i])
        j = max(i + 1, int(np.searchsorted(ends, top + PIECE, side="right")))
        n = int(ends[j - 1]) - top
        p, inv = _powers(n)
        s = np.zeros(n + 1, dtype=_U)
        np.cumsum((low[top : top + n].astype(_U) + _U(1)) * p[:n], out=s[1:])
        a, b = starts[i:j] - top, ends[i:j] - top
        out[i:j] = (s[b] - s[a]) * inv[a] + (b - a).astype(_U) * _U(0xD6E8FEB86659FD93)
        i = j
    return mix(out)


def window_hashes(h: np.ndarray, k: int, salt: int = 0) -> np.ndarray:
    """A hash of every run of `k` word hashes, in order; shorter by k - 1 than `h`."""
    n = len(h) - k + 1
    if n <= 0:
        return np.zeros(0, dtype=_U)
    out = np.full(n, (salt * BASE + k) & _MASK, dtype=_U)
    for j in range(k):
        out += h[j : j + n]
        out *= _U(0xD1342543DE82EF95)
        out ^= out >> _U(32)
    return mix(out)


def row_of(bounds: np.ndarray) -> np.ndarray:
    """The row of each element, from the n + 1 bounds of the rows' elements."""
    return np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
