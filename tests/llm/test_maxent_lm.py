"""Language-model scoring: counts, base score and the model's score by brute force, and the model's own laws."""

import math
import re
import zlib
from collections import Counter

import numpy as np

from tenor.llm import blocks, maxent_lm
from tenor.llm.queries import op8_lm_scoring

SF = "/root/testdata/sf0.001"


def brute(rows):
    words = lambda t: re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")) + [None]
    held = lambda d: zlib.crc32(("" if d is None else str(d)).encode()) % 7 == 2
    c = Counter(w for d, t in rows if not held(d) for w in words(t))
    n, v = sum(c.values()), len(c)
    return [(d, held(d), len(words(t)), sum(c[w] > 0 for w in words(t)), n,
             sum(math.log10((c[w] + 1) / (n + v + 1)) for w in words(t))) for d, t in rows]


def check(got, rows):
    want = brute(rows)
    key = lambda r: (r[0] is None, r[0] or 0, r[2], r[5])
    got = sorted([(r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in got], key=key)
    for g, w in zip(got, sorted(want, key=key), strict=True):
        assert g[:5] == w[:5] and abs(g[5] - w[5]) < 1e-6 * max(1, abs(w[5]))


def test_query_counts_and_held_out_score(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    got = op8_lm_scoring(spark, SF).collect()
    check(got, rows)
    out = [r for r in got if r.held_out]
    assert sum(r.score for r in out) > sum(r.base_score for r in out)  # beats the unigram base on held-out text


def test_edges(spark, monkeypatch):
    monkeypatch.setattr(blocks, "BLOCK_BYTES", 40)
    rows = [(1, "The the THE cat"), (2, None), (3, ""), (None, "dog"), (1, "The the THE cat"), (4, "x " * 400), (5, " \t")]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS block", "2 AS held_out")
    check(maxent_lm.score(df).collect(), rows)
    assert maxent_lm.score(df.where("false")).count() == 0


def test_scores_do_not_depend_on_the_partitions(spark, monkeypatch):
    """One or forty partitions, several blocks: the same scores; the blocks' shares of a feature are weighed by who saw it."""
    monkeypatch.setattr(blocks, "BLOCK_BYTES", 200_000)
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    one, many = ({r.doc_id: (r.score, r.n_tokens, r.base_score, r.held_out) for r in maxent_lm.score(docs.repartition(n)).collect()} for n in (1, 40))
    assert one.keys() == many.keys() and all(abs(one[d][0] - many[d][0]) < 1e-4 * one[d][1] for d in one)
    assert sum(s for s, _, _, held in many.values() if held) > sum(b for _, _, b, held in many.values() if held)


def test_probabilities_sum_to_one():
    """Over all words of a closed vocabulary and one unknown word per group, for a history with seen pairs."""
    rng = np.random.default_rng(5)
    groups = 3
    vocab = np.unique(rng.integers(0, 1 << 63, 400, dtype=np.uint64))
    count = rng.integers(1, 50, len(vocab))
    single = np.sort(vocab[:maxent_lm.SINGLES])
    y, g = maxent_lm.classes(vocab, single), maxent_lm.groups_of(vocab, groups)
    many = y >= maxent_lm.SINGLES
    group_n = np.bincount(g[many], weights=count[many], minlength=maxent_lm.HASHED * groups)
    group_v = np.bincount(g[many], minlength=maxent_lm.HASHED * groups)
    w = rng.normal(size=(maxent_lm.FEATURES * maxent_lm.ROWS, maxent_lm.CLASSES)).astype(np.float32)
    part = np.exp(maxent_lm.log_softmax(w, np.zeros(maxent_lm.CLASSES, np.float32), np.array([[3], [5000], [9000]])))[0]
    # one document that says every word twice in a row trains the pairs (v, v) and (v, next v); the held-out document asks
    # for every word after the first hashed one
    h = int(np.flatnonzero(many)[0])
    train = np.repeat(np.arange(len(vocab)), 2)
    ask = np.stack([np.full(len(vocab), h), np.arange(len(vocab))], axis=1).ravel()
    block = maxent_lm.Block(None, np.array([False, True]), np.array([0, len(train), len(train) + len(ask)]), vocab,
                            np.concatenate((train, ask)).astype(np.int32))
    p = maxent_lm.pairs_of(block, count, single, group_n, group_v)
    lam, log_z = maxent_lm.fit_pairs(p.parent, p.n, p.q.astype(np.float64))
    assert (lam[p.n > 0] > 0).all() and (lam[p.n == 0] == 0).all()
    word = dict(zip(p.at, p.prior + sum((lam - log_z)[e] for e in p.entry)))
    total = part[:maxent_lm.SINGLES].sum()
    at = len(train) + 1 + 2 * np.arange(len(vocab))
    total += sum(part[y[v]] * np.exp(word[at[v]]) for v in np.flatnonzero(many))
    # the unknown word of every group: priors and normalisers of the same history, without a feature
    room = group_n + group_v + 1
    unknown = np.setdiff1d(rng.integers(0, 1 << 63, 3000, dtype=np.uint64), vocab)
    ug, first = np.unique(maxent_lm.groups_of(unknown, groups), return_index=True)
    assert len(ug) == maxent_lm.HASHED * groups
    keys = np.concatenate((vocab, unknown[first]))
    order = np.argsort(keys)
    place = np.argsort(order)
    ids = np.concatenate((train, ask, np.stack([np.full(len(first), h), len(vocab) + np.arange(len(first))], axis=1).ravel()))
    block = maxent_lm.Block(None, np.array([False, True]), np.array([0, len(train), len(ids)]), keys[order], place[ids].astype(np.int32))
    p = maxent_lm.pairs_of(block, np.append(count, np.zeros(len(first), int))[order], single, group_n, group_v)
    lam, log_z = maxent_lm.fit_pairs(p.parent, p.n, p.q.astype(np.float64))
    word = dict(zip(p.at, p.prior + sum((lam - log_z)[e] for e in p.entry)))
    at = len(train) + len(ask) + 1 + 2 * np.arange(len(first))
    total += sum(part[maxent_lm.SINGLES + g0 // groups] * np.exp(word[a]) for g0, a in zip(ug, at))
    assert abs(total - 1) < 1e-4 and room.min() >= 1


def test_pair_weights_are_the_maximum():
    """The gradient of the regularised log likelihood is zero for every seen entry, group by group; entries never seen keep 0."""
    rng = np.random.default_rng(3)
    group = np.sort(rng.integers(0, 40, 300).astype(np.uint64))
    n = rng.integers(0, 4, 300) ** 3.0
    q = rng.random(300) / 400
    lam, log_z = maxent_lm.fit_pairs(group, n, q, 4.0, 60)
    for g in np.unique(group):
        at = group == g
        z = 1 + (q[at] * (np.exp(lam[at]) - 1)).sum()
        assert np.allclose(log_z[at], math.log(z))
        slope = n[at] - n[at].sum() * q[at] * np.exp(lam[at]) / z - lam[at] / 4
        assert np.abs(slope[n[at] > 0]).max(initial=0) < 1e-6 * max(1, n[at].sum()) and (lam[at][n[at] == 0] == 0).all()
    assert all(len(x) == 0 for x in maxent_lm.fit_pairs(np.empty(0, np.uint64), np.empty(0), np.empty(0)))


def test_score_by_brute_force(spark, monkeypatch):
    """The whole score, text by text, from dictionaries: given class weights, priors, and pair weights by plain ascent."""
    monkeypatch.setattr(blocks, "BLOCK_BYTES", 1_500)
    monkeypatch.setattr(maxent_lm, "GROUP_GROWTH", 2)
    rng = np.random.default_rng(11)
    weights = rng.normal(size=(maxent_lm.FEATURES * maxent_lm.ROWS, maxent_lm.CLASSES)).astype(np.float32)
    bias = rng.normal(size=maxent_lm.CLASSES).astype(np.float32)
    monkeypatch.setattr(maxent_lm, "train", lambda *a, **k: (weights, bias))
    names = [f"w{i}" for i in range(120)]
    rows = [(i, " ".join(names[j] for j in (rng.zipf(1.3, 60) - 1) % 120)) for i in range(120)] + [(121, None), (7, "w1 w1")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    n_blocks = blocks.block_count(df)
    groups = math.isqrt(n_blocks) // maxent_lm.GROUP_GROWTH
    assert groups > 1
    got = sorted((r.doc_id, r.n_tokens, r.score) for r in maxent_lm.score(df).collect())

    texts = []
    for d, t in rows:
        (_, _, tok, _), = maxent_lm.tokens([t])
        texts.append((d, zlib.crc32(str(d).encode()) % 7 == 2, tok))
    count = Counter(int(w) for _, held, tok in texts if not held for w in tok)
    single = np.sort(np.array(sorted(count, key=lambda w: (-count[w], np.uint64(w).view(np.int64)))[:maxent_lm.SINGLES], np.uint64))
    alone = {int(w) for w in single}
    group = lambda w: int(maxent_lm.groups_of(np.array([w], np.uint64), groups)[0])
    room = Counter({g: 1 for g in range(maxent_lm.HASHED * groups)})
    for w, c in count.items():
        if w not in alone:
            room[group(w)] += c + 1
    q_word = lambda w: (count[w] + 1) / room[group(w)]
    q_group = lambda g: room[g] / sum(room[x] for x in range(g // groups * groups, (g // groups + 1) * groups))
    seen = {}  # (history, parent) -> child -> [count, prior]
    for _, held, tok in texts:
        for h, w in zip([None, *map(int, tok)], map(int, tok)):
            if not held and w not in alone:
                g = group(w)
                for parent, child, q in (((h, "group", g // groups), g, q_group(g)), ((h, "word", g), w, q_word(w))):
                    seen.setdefault(parent, {}).setdefault(child, [0, q])[0] += 1
    fitted = {}
    for parent, kids in seen.items():
        n, q = np.array(list(kids.values())).T
        lam = np.zeros(len(n))
        for _ in range(4000):
            lam += 0.5 / (n.sum() + 1) * (n - n.sum() * q * np.exp(lam) / (1 + (q * np.expm1(lam)).sum()) - lam / maxent_lm.PAIR_VARIANCE)
        fitted[parent] = dict(zip(kids, lam)), math.log(1 + (q * np.expm1(lam)).sum())

    def pair(parent, child):
        lam, log_z = fitted.get(parent, ({}, 0.0))
        return lam.get(child, 0.0) - log_z

    want = []
    for d, _, tok in texts:
        f, y = maxent_lm.features(tok, np.array([0, len(tok)])), maxent_lm.classes(tok, single)
        total = maxent_lm.log_softmax(weights, bias, f)[np.arange(len(tok)), y].astype(float).sum()
        for h, w in zip([None, *map(int, tok)], map(int, tok)):
            if w not in alone:
                g = group(w)
                total += math.log(q_group(g)) + math.log(q_word(w)) + pair((h, "group", g // groups), g) + pair((h, "word", g), w)
        want.append((d, len(tok), total / math.log(10)))
    for a, b in zip(got, sorted(want), strict=True):
        assert a[:2] == b[:2] and abs(a[2] - b[2]) < 2e-3 * a[1], (a, b)


def test_seen_order_beats_shuffled_order(spark):
    """Held-out texts with their words shuffled score lower by at least 0.1 a token: words see their history."""
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    rng = np.random.default_rng(1)
    held = lambda d: zlib.crc32(str(d).encode()) % 7 == 2
    mixed = [(d, " ".join(rng.permutation((t or "").split())) if held(d) else t) for d, t in rows]
    mean = []
    for data in (rows, mixed):
        got = maxent_lm.score(spark.createDataFrame(data, "doc_id long, text string")).where("held_out").collect()
        mean.append(sum(r.score for r in got) / sum(r.n_tokens for r in got))
    assert mean[0] > mean[1] + 0.1


def test_steps_learn_a_pattern():
    """A next word fixed by the previous one is learnt."""
    tok = np.tile(np.arange(1, 5, dtype=np.uint64) * np.uint64(0x1234567890ABCDEF), 3000)
    edge = np.array([0, len(tok)])
    f, y = maxent_lm.features(tok, edge), maxent_lm.classes(tok, np.empty(0, np.uint64))
    w, b = np.zeros((maxent_lm.FEATURES * maxent_lm.ROWS, maxent_lm.CLASSES), np.float32), np.zeros(maxent_lm.CLASSES, np.float32)
    seen, seen_b = np.zeros_like(w), np.zeros_like(b)
    loss = lambda: -maxent_lm.log_softmax(w, b, f)[np.arange(len(y)), y].mean()
    before = loss()
    for s in range(0, len(tok), 500):
        maxent_lm.step(w, b, seen, seen_b, f[:, s:s + 500], y[s:s + 500])
    assert loss() < 0.2 < before
