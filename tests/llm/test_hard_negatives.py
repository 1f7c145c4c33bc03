"""Hard negatives against brute force; the scan against exact products."""

import math

import numpy as np
import pytest

from tenor.llm import hard_negatives as H

SCHEMA = "vec_id long, embedding array<double>, label int"


def plain(rows, every=10, n_pos=5, n_neg=10, window=(30, 90)):
    """[(anchor_id, positive_id, rank, negative_id, positive_score, negative_score)], sorted."""
    fine = [(i, [math.floor(256 * x) for x in v], lab) for i, v, lab in rows
            if None not in (i, lab) and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for k, (i, v, lab) in enumerate(fine):
        if i % every:
            continue
        scored = sorted((-sum(a * b for a, b in zip(v, w)), j, other) for n, (j, w, other) in enumerate(fine) if n != k)
        for p, pid, _ in [s for s in scored if s[2] == lab][:n_pos]:
            hit = [s for s in scored if s[2] != lab and 30 * -p <= 100 * -s[0] <= 90 * -p][:n_neg]
            out += [(i, pid, r + 1, j, -p, -s) for r, (s, j, _) in enumerate(hit)]
    return sorted(out)


def got(df):
    return sorted(tuple(r) for r in df.collect())


def rows_of(seed, n, dims=12, labels=3):
    rng = np.random.default_rng(seed)
    centre = rng.normal(0, 1, (labels, dims))
    return [(int(i), (centre[i % labels] + rng.normal(0, 1.2, dims)).round(2).tolist(), int(rng.integers(labels))) for i in range(n)]


@pytest.mark.parametrize("block", [7, 64, 4096])
def test_equals_brute_force(spark, block):
    rows = rows_of(1, 300)
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA + ", block int, place string").repartition(3)
    want = plain(rows)
    assert len(want) > 500
    assert got(H.mine(df, every=10, block=block)) == want


def test_rows_that_take_no_part_and_repeats(spark):
    rows = rows_of(2, 80, 6)
    rows += [(None, rows[3][1], 1), (1000, None, 1), (1010, rows[3][1], None), (1020, [0.1, None], 1), (1030, [float("nan")], 0),
             (1040, [float("inf"), 1.0], 2), (1050, [], 1), (1060, [0.5], 1), (1070, [3.0] * 9, 2)]
    rows += [rows[10]] * 4 + [(20, rows[0][1], rows[20][2])] + [(i, [1.0, 1.0, 1.0], i % 2) for i in range(2000, 2060)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    for block in (16, 500):
        assert got(H.mine(df, every=10, block=block)) == plain(rows)
    assert H.mine(df.where("false")).count() == 0


def test_scores_beyond_doubles(spark):
    rows = [(i, [3e6 + i, 2e6 - 7 * i, float(i)], i % 2) for i in range(40)]
    assert got(H.mine(spark.createDataFrame(rows, SCHEMA), every=10, block=16)) == plain(rows)


def test_scan_shrinks_and_stays_exact():
    rng = np.random.default_rng(3)
    cells = np.floor(256 * rng.normal(0, 1, (64, 3000)) * (0.8 ** np.arange(64))[:, None])
    block = H.Block({"ids": np.arange(3000).tobytes(), "labels": np.zeros(3000, np.int64).tobytes(), "dims": 64, "kind": "int16",
                     "cells": cells.astype("int16").tobytes()})
    anchor = cells[:, 5]
    exact = anchor @ cells
    sizes = []

    def watched(shrink):
        def f(partial, least, most):
            stay = shrink(partial, least, most)
            sizes.append((len(partial), int(stay.sum())))
            return stay
        return f

    at, score = H.scan(block, anchor, np.arange(3000), watched(H.best(6)))
    assert set(np.argsort(-exact)[:6]) <= set(at) and (score == exact[at]).all()
    assert sizes[1][0] < 3000 and sizes[-1][1] < 300  # most rows leave before the last dimensions are read
    top = np.sort(exact)[-6:]
    windows = [(-(-30 * int(t) // 100), 90 * int(t) // 100) for t in top]
    at, score = H.scan(block, anchor, np.arange(3000), watched(H.in_windows(windows, 10)))
    for lo, hi in windows:
        inside = np.sort(exact[(exact >= lo) & (exact <= hi)])[::-1][:10]
        assert np.sort(score[(score >= lo) & (score <= hi)])[::-1][:10].tolist() == inside.tolist()
