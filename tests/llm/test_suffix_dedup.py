"""Suffix arrays by two-stage sorting, and substring dedup against brute force."""

import hashlib
import random

import numpy as np
import pytest

from tenor.llm import blocks, suffix_dedup
from tenor.llm.suffix_array import common_prefixes, suffix_array, words8


@pytest.mark.parametrize("alphabet", [b"a", b"ab", b"abcdefgh", bytes(range(1, 255))])
def test_suffix_array(alphabet):
    rng = random.Random(len(alphabet))
    for n in (1, 2, 3, 17, 200):
        t = np.frombuffer(bytes(rng.choice(alphabet) for _ in range(n)), np.uint8)
        keys = words8(t, n + 8)
        got = suffix_array(t, keys, n + 8)
        b = t.tobytes()
        assert got.tolist() == sorted(range(n), key=lambda i: b[i:])
        same = common_prefixes(keys, got, 9)
        pad = b + bytes(16)
        want = [False] + [pad[x:x + 9] == pad[y:y + 9] for x, y in zip(got, got[1:])]
        assert same.tolist() == want


def brute(rows, length):
    """rows: (doc_id, text), unique ids. -> {doc_id: (n_bytes, n_removed, n_spans, sha)}"""
    seen, out = set(), {}
    for doc, text in sorted(rows, key=lambda r: r[0]):
        b = (text or "").encode()
        gone = [False] * len(b)
        for s in range(len(b) - length + 1):
            w = b[s:s + length]
            if w in seen:
                gone[s:s + length] = [True] * length
            seen.add(w)
        spans = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        kept = bytes(c for c, g in zip(b, gone) if not g)
        out[doc] = (len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest())
    return out


def corpus(seed):
    rng = random.Random(seed)
    word = lambda: rng.choice(["the", "of", "aé", "b", "cdefg", "hij", "\n"])
    shared = [" ".join(word() for _ in range(rng.randint(20, 60))) for _ in range(6)]
    rows = []
    for i in range(60):
        parts = [" ".join(word() for _ in range(rng.randint(0, 40))) for _ in range(3)]
        for _ in range(rng.randint(0, 3)):
            parts.insert(rng.randrange(len(parts) + 1), rng.choice(shared))
        rows.append((i, " ".join(parts)))
    rows += [(100 + i, rows[i][1]) for i in range(5)]           # exact copies
    rows += [(120, "a" * 500), (121, "a" * 99), (122, "ab" * 150), (123, ""), (124, None), (125, "x" * 100)]
    rows += [(126, "a" * 100), (130, rows[3][1][:-1] + "!"), (131, "é" * 120), (-5, rows[10][1])]
    return rows


@pytest.mark.parametrize("seed,hot", [(1, 50_000), (2, 1)])
def test_against_brute_force(spark, monkeypatch, seed, hot):
    monkeypatch.setattr(blocks, "BLOCK_BYTES", 3000)
    rows = corpus(seed)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256)
           for r in suffix_dedup.digest(df, hot=hot).collect()}
    assert got == brute(rows, suffix_dedup.LENGTH)


def test_empty_repeated_null(spark):
    schema = "doc_id long, text string, block int"
    assert suffix_dedup.digest(spark.createDataFrame([], schema)).count() == 0
    text = "word " * 40 + "end"
    rows = [(1, text, 7), (1, text, 7), (None, text, 7)]
    got = sorted((r.doc_id or 9, r.n_removed) for r in suffix_dedup.digest(spark.createDataFrame(rows, schema)).collect())
    n = len(text)
    first = got[0][1]
    assert got == [(1, first), (1, n), (9, n)] and 0 < first < n
