"""Lines above the limits leave the texts, not only the counts."""

import random

import corpus_pipeline
from tenor.llm import quality_lines

SF = "/root/testdata/sf0.01"


def test_stage_removes_frequent_lines(spark):
    rng = random.Random(4)
    fresh = lambda n: " ".join("".join(rng.choices("abcdefghij", k=7)) for _ in range(n))
    rows, want = [], {}
    for i in range(8):  # the line comes twice, in other case, digits and spaces
        a, b, c = fresh(60), fresh(40), fresh(5)
        rows.append((i, f"{a}\n  Page {i} of\t900\n\n{b}\npage 7 OF 12 \r\n{c}\n", "en", "h", -1))
        want[i] = f"{a}\n\n{b}\n{c}\n"
    for i in range(20, 40):
        rows.append((i, fresh(70) + "\n\n" + fresh(3), None, "h", -1))
        want[i] = rows[-1][1]
    rows.append((90, fresh(60) + "\nPage 1 of 2", "en", "other", -1))  # frequent in another host only
    rows.append((91, fresh(60) + "\nPage 1 of 2", "en", None, -1))
    want |= {90: rows[-2][1], 91: rows[-1][1]}
    rows += [rows[0], (95, None, "en", "h", -1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    out = corpus_pipeline.quality(spark, df, SF)
    assert out.schema == df.schema
    got = out.collect()
    assert len(got) == len(want) + 1 and {r.doc_id: r.text for r in got} == want
    assert all(r.n_chars == (len(r.text) if r.doc_id < 8 else -1) for r in got)
    rules = quality_lines.quality_rules(df).collect()
    assert {r.doc_id: r.clean_text for r in rules if r.kept} == want
    assert [r.clean_text for r in rules if r.doc_id == 95] == [None]


def test_given_table_keeps_no_frequent_line(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rules = {r.doc_id: r for r in quality_lines.quality_rules(docs).collect()}
    cut = {i for i, r in rules.items() if r.removed_words and r.kept}
    got = {r.doc_id: r for r in corpus_pipeline.quality(spark, docs, SF).collect()}
    assert cut and set(got) == {i for i, r in rules.items() if r.kept}
    for i, r in got.items():
        left, before = r.text.split("\n"), rules[i].text.split("\n")
        assert (len(left) < len(before)) == (i in cut) and r.n_chars == len(r.text)
        assert [x for x in before if x in set(left)] == left


def test_own_columns_pass_through(spark):
    df = spark.createDataFrame([(1, "w" + " a b" * 3, "x", 7, "k")], "doc_id long, text string, source string, n_words int, kept string")
    df = df.unionByName(df.selectExpr("2L AS doc_id", "concat_ws(' ', transform(sequence(1, 60), x -> concat('w', x))) AS text",
                                      "source", "n_words", "kept"))
    got = quality_lines.clean(df)
    assert got.schema == df.schema and [(r.doc_id, r.n_words, r.kept) for r in got.collect()] == [(2, 7, "k")]


def test_internal_names_as_extra_columns(spark):
    names = ["_w", "_l", "_n", "_cut", "_host", "_doc", "_hash", "_words", "own_0", "a.b"]
    rng = random.Random(9)
    rows = [(i, "h", " ".join("".join(rng.choices("abcdefghij", k=7)) for _ in range(60)) + "\nshared line", *range(len(names))) for i in range(9)]
    df = spark.createDataFrame(rows, "doc_id long, source string, text string, " + ", ".join(f"`{n}` int" for n in names))
    for got in (quality_lines.quality_rules(df).collect(), quality_lines.clean(df).collect()):
        assert len(got) == 9 and all(r[n] == i for r in got for i, n in enumerate(names))
    assert all(r.removed_words == 2 for r in quality_lines.quality_rules(df).collect())
    assert quality_lines.clean(df).columns == df.columns


def test_limit_grows_far_slower_than_the_host(spark):
    """Boilerplate of one document in forty goes at both sizes of a host; lines of a few documents stay."""
    for n in (600, 4000):
        rng = random.Random(n)
        rows = []
        for i in range(n):
            lines = [" ".join("".join(rng.choices("abcdefghij", k=6)) for _ in range(55))]
            lines += ["our standard footer 2024"] * (i % 20 == 0 or i < 26) + [f"seen in a few {'xyz'[i % 3] * (i // 300 + 1)}"] * (i % 75 == 0)
            rows.append((i, "\n".join(lines), "hot"))
        df = spark.createDataFrame(rows, "doc_id long, text string, source string")
        got = {r.doc_id: r for r in quality_lines.quality_rules(df).collect()}
        assert all(got[i].kept and (got[i].removed_words == 4) == ("footer" in rows[i][1]) for i in got)
