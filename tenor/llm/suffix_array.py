"""Suffix arrays by two-stage sorting (numpy, inside one task's bounded text).

A suffix smaller than its successor is sorted directly, by its first ``depth``
symbols in 8-byte steps where only ties go on. All other suffixes are induced:
scanning the buckets of first symbols from the smallest, the suffix before each
scanned one goes to the next free place of its own bucket. A bucket is scanned
in whole segments, since what it induces lies behind what induced it.
"""

from __future__ import annotations

import numpy as np

U = np.uint64


def words8(text: np.ndarray, pad: int) -> np.ndarray:
    """Big-endian 8-symbol keys at every position, zero-padded by ``pad`` positions."""
    n = len(text)
    wide = np.zeros(n + pad + 8, dtype=U)
    wide[:n] = text
    keys = np.zeros(n + pad, dtype=U)
    for j in range(8):
        keys = (keys << U(8)) | wide[j:j + n + pad]
    return keys


def smaller_than_successor(text: np.ndarray) -> np.ndarray:
    """True where suffix i < suffix i + 1 (the end of the text is smallest)."""
    n = len(text)
    out = np.zeros(n, dtype=bool)
    if n > 1:
        differs = text[:-1] != text[1:]
        far = np.where(differs, np.arange(n - 1), n)
        nearest = np.minimum.accumulate(far[::-1])[::-1]
        less = np.append(text[:-1] < text[1:], [False, False])
        out[:-1] = less[nearest]
    return out


def sort_directly(keys: np.ndarray, at: np.ndarray, depth: int) -> np.ndarray:
    """Positions ``at`` in the order of their first ``depth`` symbols."""
    idx, where, group, done = at.copy(), np.arange(len(at)), np.zeros(len(at), np.int64), 0
    while done < depth and len(where):
        key = keys[idx[where] + done]
        order = np.lexsort((key, group)) if done else np.argsort(key, kind="stable")
        idx[where] = idx[where][order]
        key = key[order]
        new = np.ones(len(key), dtype=bool)
        new[1:] = (key[1:] != key[:-1]) | (group[1:] != group[:-1])
        tied = ~new
        tied[:-1] |= ~new[1:]
        group = np.cumsum(new)[tied]
        where = where[tied]
        done += 8
    return idx


def suffix_array(text: np.ndarray, keys: np.ndarray, depth: int) -> np.ndarray:
    """All suffixes in the order of (at least) their first ``depth`` symbols."""
    n = len(text)
    out = np.full(n, -1, dtype=np.int64)
    if n == 0:
        return out
    rising = smaller_than_successor(text)
    direct = sort_directly(keys, np.flatnonzero(rising), depth)
    count = np.bincount(text, minlength=256)
    own = np.bincount(text[direct], minlength=256) if len(direct) else np.zeros(256, np.int64)
    start = np.cumsum(count) - count
    end = start + count
    out[np.arange(len(direct)) + np.repeat(end - own - (np.cumsum(own) - own), own)] = direct
    head = start.copy()

    def induce(scanned: np.ndarray) -> None:
        before = scanned - 1
        before = before[before >= 0]
        before = before[~rising[before]]
        if not len(before):
            return
        symbol = text[before]
        order = np.argsort(symbol, kind="stable")
        symbol = symbol[order].astype(np.int64)
        many = np.bincount(symbol, minlength=256)
        rank = np.arange(len(order)) - np.repeat(np.cumsum(many) - many, many)
        out[head[symbol] + rank] = before[order]
        head[:] += many

    last = int(text[n - 1])
    out[head[last]] = n - 1
    head[last] += 1
    for c in np.flatnonzero(count):
        lo = start[c]
        while lo < head[c]:
            hi = head[c]
            induce(out[lo:hi])
            lo = hi
        induce(out[end[c] - own[c]:end[c]])
    return out


def common_prefixes(keys: np.ndarray, order: np.ndarray, length: int) -> np.ndarray:
    """True at i > 0 where neighbours i - 1 and i share their first ``length`` (>= 8) symbols."""
    same = np.zeros(len(order), dtype=bool)
    alive = np.arange(1, len(order))
    for step in [*range(0, length - 7, 8), length - 8]:
        alive = alive[keys[order[alive] + step] == keys[order[alive - 1] + step]]
    same[alive] = True
    return same
