"""Jaccard join against brute force over all pairs, with groups near the threshold and every switch exercised."""

import random
import re

import pytest

from tenor.llm import blocks, components, jaccard_join


def shingle_set(text, k):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", low)
    return {tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())


def brute(rows, k, percent):
    sets = [shingle_set(t, k) for _, t in rows]
    comp = list(range(len(rows)))

    def find(i):
        while comp[i] != i:
            i = comp[i]
        return i
    for i in range(len(rows)):
        for j in range(i):
            c = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * c >= percent * (len(sets[i]) + len(sets[j]) - c):
                comp[find(i)] = find(j)
    best = {}
    for i, (d, _) in enumerate(rows):
        r = find(i)
        if d is not None:
            best[r] = min(best.get(r, d), d)
    return sorted((d is None, d or 0, len(sets[i]), best.get(find(i)) if sets[i] else d) for i, (d, _) in enumerate(rows))


def corpus(seed):
    rng = random.Random(seed)
    vocab = [f"{a}{b}" for a in "abcdefgh" for b in ("la", "Mu", "né", "to", "ri")]
    text = lambda n: [rng.choice(vocab) for _ in range(n)]
    rows, common = [], text(12)
    for g in range(6):  # families around one base, edits on both sides of the threshold
        base = text(rng.choice((30, 80, 160)))
        for _ in range(rng.choice((3, 12, 25))):
            w = base[:]
            for _ in range(rng.randint(0, 4)):
                i = rng.randrange(len(w))
                w[i:i + rng.randint(0, 1)] = [rng.choice(vocab)] * rng.randint(0, 2)
            rows.append(" ".join(w))
    rows += [" ".join(text(rng.randint(3, 40)) + common + text(rng.randint(3, 20))) for _ in range(40)]
    chain = text(120)
    for _ in range(12):  # a chain: neighbours link, its ends do not
        rows.append(" ".join(chain))
        chain[rng.randrange(120)] = rng.choice(vocab) + "x"
    rows += ["", None, "one", "ONE", "one two", "one  two\n", "one two three", "x " * 50, "x x x x", " \t"]
    rng.shuffle(rows)
    out = [(i * 7 % 1009, t) for i, t in enumerate(rows)]
    return out + [out[3], (None, out[5][1]), (None, "lonely words " * 3)]


@pytest.mark.parametrize("seed,k,percent", [(1, 3, 90), (2, 5, 80), (3, 2, 95)])
def test_components(spark, monkeypatch, seed, k, percent):
    monkeypatch.setattr(blocks, "BLOCK_BYTES", 9000)
    rows = corpus(seed)
    df = spark.createDataFrame([(*r, 1, "n") for r in rows], "doc_id long, text string, block int, n string").repartition(4)
    got = jaccard_join.jaccard_components(df, k, percent).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0, r.n_shingles, r.component_id) for r in got) == brute(rows, k, percent)


def test_keep_one_and_empty(spark):
    text = " ".join(f"w{i}" for i in range(60))
    rows = [(5, text), (3, text.upper()), (9, text + " tail"), (4, "other words here and there now"), (7, ""), (8, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(r.doc_id for r in jaccard_join.keep_one(df, 5, 80).collect()) == [3, 4, 7, 8]
    assert jaccard_join.jaccard_components(df.where("false")).count() == 0


def test_large_family_is_not_expanded(spark):
    """300 near copies of one text: the pairs verified stay far below all pairs."""
    rng = random.Random(6)
    base = [f"w{i}" for i in range(120)]
    rows = []
    for i in range(300):
        w = base[:]
        w[rng.randrange(120)] = f"e{i}"
        rows.append((i, " ".join(w)))
    seen = []
    real = jaccard_join._overlaps
    jaccard_join._overlaps = lambda pairs, nodes: seen.append(pairs.count()) or real(pairs, nodes)
    try:
        got = jaccard_join.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    finally:
        jaccard_join._overlaps = real
    assert {r.component_id for r in got} == {0} and sum(seen) < 300 * 20


def test_components_of_links(spark):
    links = [(i, i + 1) for i in range(20)] + [(100, i) for i in range(101, 140)] + [(200, 201), (201, 200), (139, 20)]
    got = dict(components.components(spark.createDataFrame(links, "a long, b long")).collect())
    assert got == {i: 0 for i in [*range(21), *range(100, 140)]} | {200: 200, 201: 200}
