"""The stretches of one anchor spread over the buckets of the ownership exchange."""

import random

import numpy as np

from tenor.llm import blocks, suffix_dedup

from .test_suffix_dedup import brute


def test_hot_anchor_spreads(spark, monkeypatch):
    monkeypatch.setattr(blocks, "BLOCK_BYTES", 4000)
    rng = random.Random(1)
    fresh = lambda n: "".join(rng.choices("abcdefghijklmnop", k=n))
    passage = fresh(60)  # shorter than a window: every text has stretches of its own around it
    rows = [(i, fresh(45) + passage + fresh(45)) for i in range(300)]
    rows += [(1000 + i, rows[i][1]) for i in range(20)] + [(2000 + i, fresh(20) + rows[i][1][10:140] + fresh(20)) for i in range(20)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    calls, exchange = [], blocks.exchange
    monkeypatch.setattr(blocks, "exchange", lambda *a: calls.append(a) or exchange(*a))
    for hot in (50_000, 2):
        got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffix_dedup.digest(df, hot=hot).collect()}
        assert got == brute(rows, suffix_dedup.LENGTH)
    docs, emit, sent = calls[0][:3]
    hottest, anchors = {}, {}
    for r in docs.groupBy("block").applyInArrow(emit, sent).collect():
        a = np.frombuffer(r.anchors, np.uint64).tolist()
        for x in a:
            anchors[x] = anchors.get(x, 0) + 1
            hottest[r.bucket, x] = hottest.get((r.bucket, x), 0) + 1
    top = max(anchors, key=anchors.get)
    assert anchors[top] > 100
    assert max(n for (_, x), n in hottest.items() if x == top) < 0.4 * anchors[top]
