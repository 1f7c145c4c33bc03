"""Greedy string tiling against a direct implementation, and decontamination on planted passages."""

import random
import re

from tenor.llm import string_tiling
from tenor.llm.string_tiling import MIN_MATCH, tile


def plain_tiles(p, t, k):
    """Textbook greedy tiling: all longest unmarked matches, round after round."""
    fp, ft, tiles = [True] * len(p), [True] * len(t), []
    while True:
        best, found = k, []
        for i in range(len(p)):
            for j in range(len(t)):
                n = 0
                while i + n < len(p) and j + n < len(t) and fp[i + n] and ft[j + n] and p[i + n] == t[j + n]:
                    n += 1
                if n > best:
                    best, found = n, [(i, j)]
                elif n == best:
                    found.append((i, j))
        if not found:
            return tiles
        for i, j in found:
            if all(fp[i:i + best]) and all(ft[j:j + best]):
                fp[i:i + best] = ft[j:j + best] = [False] * best
                tiles.append((best, i, j))


def test_tiles_cover_like_the_textbook():
    rng = random.Random(4)
    for _ in range(150):
        p = [rng.randint(1, 6) for _ in range(rng.randint(5, 30))]
        t = [rng.randint(1, 6) for _ in range(rng.randint(0, 40))]
        for _ in range(rng.randint(0, 3)):
            a = rng.randrange(len(p))
            t[rng.randrange(len(t) + 1):0] = p[a:a + rng.randint(5, 12)]
        got = tile(p, t, 5)
        assert sorted(n for n, _, _ in got) == sorted(n for n, _, _ in plain_tiles(p, t, 5))
        for n, i, j in got:
            assert p[i:i + n] == t[j:j + n] and n >= 5
        for side in (1, 2):
            used = [x for m in got for x in range(m[side], m[side] + m[0])]
            assert len(used) == len(set(used))


def words(rng, n):
    return [rng.choice("alpha beta gamma delta eps zeta eta theta iota kappa".split()) + str(rng.randint(0, 99)) for _ in range(n)]


def test_planted_passages(spark):
    rng = random.Random(9)
    items = [(i, " ".join(words(rng, 30))) for i in range(8)]
    items += [(50, "too few words here"), (51, ""), (52, None), (53, "la " * 30), (0, items[0][1])]
    body = lambda n=80: " ".join(words(rng, n))
    w = items[1][1].split()
    docs = [(0, body()), (1, body() + " " + items[0][1].upper() + " " + body()),
            (2, " ".join([body(20), *w[20:], body(5), *w[:10], body(3), *w[10:20]])),     # reordered
            (3, body() + " " + " ".join(items[2][1].split()[:9])),                          # a short quote stays
            (4, items[3][1] + "\n" + items[4][1]), (5, None), (6, ""), (7, "x"), (8, "la " * 30),
            (9, body(5000) + " " + items[5][1] + " " + body(5000)), (4, items[3][1]), (None, items[6][1])]
    d = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "'z' AS words", "1 AS rid")
    b = spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "2 AS doc_id")
    got = {(r.doc_id, r.item_id): round(r.coverage, 3) for r in string_tiling.leaks(d, b).collect()}
    assert got == {(1, 0): 1.0, (2, 1): 1.0, (4, 3): 1.0, (4, 4): 1.0, (8, 53): 1.0, (9, 5): 1.0, (None, 6): 1.0}
    left = [r.doc_id for r in string_tiling.decontaminate(d, b).collect()]
    assert sorted(x for x in left if x is not None) == [0, 3, 5, 6, 7] and None in left
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert string_tiling.leaks(empty, b).count() == 0
    assert string_tiling.leaks(d, b.where("false")).count() == 0


def test_query_finds_every_contained_passage(spark):
    """Documents whose words hold a whole item of the given tables are all reported."""
    sf = "/root/testdata/sf0.001"
    from tenor.llm.queries import op9_decontamination
    got = {(r.doc_id, r.item_id) for r in op9_decontamination(spark, sf).collect()}
    norm = lambda t: " " + " ".join(re.findall(r"[^ \t-\r]+", (t or "").lower())) + " "
    docs = [(r.doc_id, norm(r.text)) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    items = [(r.item_id, norm(r.text)) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    whole = {(d, i) for d, t in docs for i, p in items if p in t}
    assert whole and whole <= got
    assert all(len(norm("").split()) == 0 or i is not None for _, i in got) and MIN_MATCH == 5
