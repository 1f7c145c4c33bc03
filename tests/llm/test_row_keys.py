"""Near duplicates and decontamination decide by row: repeated, null and shared doc_ids."""

import random

import corpus_pipeline
from tenor.llm import jaccard_join, string_tiling

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, None, "s", len(t or "")) for i, t in rows], DOCS).repartition(3)


def by_id(df):
    return sorted(((r.doc_id, r.text) for r in df.collect()), key=lambda r: (r[0] is None, r[0] or 0, r[1] or ""))


def test_near_duplicates_by_row(spark):
    rng = random.Random(5)
    fresh = lambda n=60: " ".join("".join(rng.choices("abcdefghij", k=7)) for _ in range(n))
    a, b, c, d, e, f = (fresh() for _ in range(6))
    rows = [(5, a)] * 4 + [(9, a + " tail")]         # repeated rows and a near copy: one stays
    rows += [(7, b), (3, b.upper()), (7, c)]          # 7 is a copy by one text, unique by the other
    rows += [(None, d), (20, d), (None, e), (None, e)]
    rows += [(30, f), (31, ""), (31, ""), (32, None), (None, None)]
    want = [(5, a), (3, b.upper()), (7, c), (20, d), (None, e), (30, f), (31, ""), (31, ""), (32, None), (None, None)]
    df = frame(spark, rows)
    got = corpus_pipeline.near_duplicates(spark, df, SF)
    assert got.schema == df.schema
    assert by_id(got) == by_id(frame(spark, want))


def test_decontamination_by_row(spark):
    rng = random.Random(6)
    items = [r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect() if len((r.text or "").split()) >= 10]
    fresh = lambda n=60: " ".join("".join(rng.choices("abcdefghij", k=7)) for _ in range(n))
    a, b, c = fresh(), fresh(), fresh()
    leak = f"{fresh()} {items[0]} {fresh()}"
    rows = [(1, a), (1, leak), (None, leak), (None, b), (4, leak), (4, leak), (5, c), (5, c), (6, None)]
    got = corpus_pipeline.decontamination(spark, frame(spark, rows), SF)
    assert by_id(got) == by_id(frame(spark, [(1, a), (None, b), (5, c), (5, c), (6, None)]))


def test_equal_rows_do_not_add_up(spark):
    """An item of one passage four times: a text with one of them covers a quarter, copied or not."""
    passage = "one two three four five six"
    item = spark.createDataFrame([(1, " ".join([passage] * 4))], "item_id long, text string")
    part, whole = f"x y {passage} z", f"x {passage} y {passage} z"
    df = frame(spark, [(1, part)] * 3 + [(2, part), (3, whole), (3, whole), (2, whole)])
    assert by_id(string_tiling.decontaminate_rows(df, item)) == [(1, part)] * 3 + [(2, part)]


def test_stages_with_internal_names_as_columns(spark):
    rng = random.Random(6)
    fresh = lambda n=60: " ".join("".join(rng.choices("abcdefghij", k=7)) for _ in range(n))
    a, b, leak = fresh(), fresh(), fresh(30)
    names = "doc_id long, text string, _row long, _comp string, _key int, _lead int, own_0 int"
    df = spark.createDataFrame([(1, a, 7, "c", 3, 4, 5), (2, a + " x", 8, "d", 3, 4, 5), (3, b, 9, "e", 3, 4, 5)], names)
    got = sorted(map(tuple, jaccard_join.keep_one(df, k=5, percent=80).collect()))
    assert got == [(1, a, 7, "c", 3, 4, 5), (3, b, 9, "e", 3, 4, 5)]
    items = spark.createDataFrame([(1, b[:300])], "item_id long, text string")
    assert sorted(map(tuple, string_tiling.decontaminate_rows(df, items).collect()))[0][:4] == (1, a, 7, "c")
    assert string_tiling.decontaminate_rows(df, items).count() == 2
    docs = spark.createDataFrame([(None, leak + " tail"), (None, leak + " tail"), (None, fresh()), (4, leak)], "doc_id long, text string")
    found = string_tiling.leaks(docs, spark.createDataFrame([(9, leak)], "item_id long, text string")).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0, r.item_id) for r in found) == [(False, 4, 9), (True, 0, 9)]
