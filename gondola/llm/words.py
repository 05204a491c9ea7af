"""Words of whole texts as 64-bit fingerprints, computed over Arrow buffers without a loop per word.

A word is a run of bytes other than 0x20 and 0x09-0x0D. Its fingerprint is a polynomial over random
64-bit byte values, mixed at the end; the chance that any two of n distinct words share one is about
n*n / 2**65 (one in a million for six million words), and sequences of words are combined alike.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_RNG = np.random.Generator(np.random.PCG64(20240517))
_BYTE = _RNG.integers(1, 2**63, size=256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
_SEP = np.zeros(256, dtype=bool)
_SEP[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_P = 0x9E3779B97F4A7C1B
_STEP = np.uint64(0xD1342543DE82EF95)
_powers = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}


def _power(kind: str, n: int) -> np.ndarray:
    if len(_powers[kind]) < n:
        base = _P if kind == "up" else pow(_P, -1, 2**64)
        a = np.full(max(n, 1 << 20), base, np.uint64)
        a[0] = 1
        _powers[kind] = np.multiply.accumulate(a)
    return _powers[kind]


def mix(h: np.ndarray) -> np.ndarray:
    """Scramble 64-bit values one to one."""
    h = h ^ (h >> np.uint64(31))
    h = h * np.uint64(0x7FB5D329728EA185)
    h ^= h >> np.uint64(27)
    h = h * np.uint64(0x81DADEF4BC2DD44D)
    return h ^ (h >> np.uint64(33))


def utf8(column) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a string column and the n+1 offsets of its rows; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[at[0]:at[-1]], at - at[0]


def pieces(offsets: np.ndarray, limit: int = 1 << 20) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``limit`` bytes (a longer row stands alone)."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + limit, "right")) - 1)
        yield i, j
        i = j


def words(data: np.ndarray, offsets: np.ndarray, fold: bool = False):
    """(fingerprints, starts, ends, first): row i holds words first[i] to first[i+1]."""
    n = len(data)
    if fold:
        data = _FOLD[data]
    gap = np.ones(n + 1, bool)
    gap[:n] = _SEP[data]
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    before = np.ones(n, bool)
    before[1:] = gap[:n - 1] if n else True
    starts = np.flatnonzero(~gap[:n] & (before | edge[:n]))
    ends = np.flatnonzero(~gap[:n] & (gap[1:] | edge[1:])) + 1
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(_BYTE[data] * _power("up", n + 1)[:n], out=total[1:])
    h = mix((total[ends] - total[starts]) * _power("down", n + 1)[starts])
    return h, starts, ends, np.searchsorted(starts, offsets)


def chain(h: np.ndarray, k: int) -> np.ndarray:
    """Fingerprints of all k-word sequences, regardless of row ends (len(h) - k + 1 of them)."""
    m = max(0, len(h) - k + 1)
    out = np.zeros(m, np.uint64)
    for j in range(k):
        out = out * _STEP + h[j:j + m]
    return mix(out + np.uint64(k))
