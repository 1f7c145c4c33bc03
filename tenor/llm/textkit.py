"""Vectorised words and shingles of many texts (numpy helpers used inside tasks).

A word is a maximal run of ``[^\\x20\\x09-\\x0D]`` bytes, A-Z lower-cased. Words
are 64-bit hashes: a sum of per-byte constants times per-position odd
constants, mixed with the length. Texts are handled in slices of bounded bytes
that end at text boundaries; only a single longer text makes a longer slice.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 21
U = np.uint64
_BYTE = np.random.default_rng(20240601).integers(1, 1 << 63, 256, dtype=np.uint64) | U(1)
_BYTE[65:91] = _BYTE[97:123]  # A-Z count as a-z
_SEP = np.zeros(256, dtype=bool)
_SEP[[32, 9, 10, 11, 12, 13]] = True
_STEP = U(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """64-bit finaliser (splitmix constants)."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def _powers(n: int) -> np.ndarray:
    return mix(np.arange(1, n + 1, dtype=np.uint64) * _STEP) | U(1)


_POW = _powers(4096)


def powers(n: int) -> np.ndarray:
    return _POW[:n] if n <= len(_POW) else _powers(n)


def buffers(texts) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a column of texts; nulls are empty."""
    arr = pa.array(texts, type=pa.large_string()) if not isinstance(texts, (pa.Array, pa.ChunkedArray)) else texts
    if isinstance(arr, pa.ChunkedArray):
        arr = arr.combine_chunks()
    arr = arr.cast(pa.large_string()).fill_null("")
    if len(arr) == 0:
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    _, off, data = arr.buffers()
    offsets = np.frombuffer(off, dtype=np.int64, count=len(arr) + 1 + arr.offset)[arr.offset:]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.empty(0, np.uint8)
    return raw[offsets[0]:offsets[-1]], offsets - offsets[0]


def slices(offsets: np.ndarray, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of texts holding at most ``limit`` bytes together (one text at least)."""
    lo, n = 0, len(offsets) - 1
    while lo < n:
        hi = int(np.searchsorted(offsets, offsets[lo] + limit, side="right")) - 1
        hi = min(max(hi, lo + 1), n)
        yield lo, hi
        lo = hi


def word_hashes(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(hash per word, first word of each text [n + 1], word start, word end) of one slice."""
    n = len(raw)
    if n == 0:
        return np.empty(0, U), np.zeros(len(offsets), np.int64), np.empty(0, np.int64), np.empty(0, np.int64)
    word = ~_SEP[raw]
    first = word.copy()
    first[1:] &= ~word[:-1]
    edge = offsets[(offsets > 0) & (offsets < n)]
    first[edge] |= word[edge]  # a word starts anew at a text's first byte
    starts = np.flatnonzero(first)
    if len(starts) == 0:
        return np.empty(0, U), np.zeros(len(offsets), np.int64), starts, starts
    at = np.flatnonzero(word)
    before = np.searchsorted(at, starts)  # index of each word's first byte among word bytes
    lens = np.diff(np.append(before, len(at)))
    pos = np.arange(len(at)) - np.repeat(before, lens)
    h = np.add.reduceat(_BYTE[raw[at]] * powers(int(lens.max()))[pos], before)
    return mix(h + lens.astype(U) * _STEP), np.searchsorted(starts, offsets), starts, starts + lens


def shingles(h: np.ndarray, first: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash of k consecutive words at every word of the slice that has them in its text,
    text index). Texts with fewer words have none."""
    n = len(h) - k + 1
    if n <= 0:
        return np.empty(0, U), np.empty(0, np.int64)
    acc = np.zeros(n, U)
    for j in range(k):
        acc += h[j:j + n] * U((2 * j + 1) * 0xD6E8FEB86659FD93 & 0xFFFFFFFFFFFFFFFF | 1)
    acc = mix(acc)
    text = np.repeat(np.arange(len(first) - 1), np.diff(first))
    keep = text[:n] == text[k - 1:]
    return acc[keep], text[:n][keep]


def unique_sorted(values: np.ndarray) -> np.ndarray:
    """Sorted distinct values."""
    if len(values) == 0:
        return values
    v = np.sort(values)
    return v[np.concatenate(([True], v[1:] != v[:-1]))]
