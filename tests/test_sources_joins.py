"""Sources round trips with hostile text, and the skew-split join."""

import pytest
from pyspark.sql import functions as F

from tenor.session import scratch_path
from tenor.sources import files

from conftest import rows

HOSTILE = ['plain', 'comma, inside', 'quote " inside', 'new\nline', '  spaces  ', 'back\\slash', '"', 'end\n']


def test_labeled_csv_round_trip(spark):
    df = spark.createDataFrame([("hate", "women", t) for t in HOSTILE], "tone string, target string, text string")
    p = scratch_path(spark, "t-csv")
    files.write_csv(df, p, header=True)
    assert rows(files.read_labeled_csv(spark, p)) == rows(df)


def test_testset_keeps_alignment(spark):
    df = spark.createDataFrame([(i, i % 2, t) for i, t in enumerate(HOSTILE)], "doc_id long, label int, text string")
    p = scratch_path(spark, "t-testset")
    files.write_csv(df, p, header=False)
    assert rows(files.read_testset(spark, p)) == rows(df)


def test_scoring_input_dispatch(spark):
    base = scratch_path(spark, "t-score")
    df = spark.createDataFrame([(" a \n b",)], "text string")
    df.write.text(f"{base}/x.txt")
    assert rows(files.read_scoring_input(spark, f"{base}/x.txt")) == [("a",), ("b",)]
    files.write_csv(df, f"{base}/x.csv", header=False)
    assert rows(files.read_scoring_input(spark, f"{base}/x.csv")) == [(" a \n b",)]
    with pytest.raises(ValueError):
        files.read_scoring_input(spark, f"{base}/x.json")


def test_annotations_both_layouts(spark):
    schema = ("post_id long, annotators array<struct<label:string,target:array<string>>>, "
              "post_tokens array<string>")
    posts = spark.createDataFrame([(7, [("normal", ["Women"])], ["a", "b"]), (8, [], ["c"])], schema)
    p = scratch_path(spark, "t-json")
    files.write_annotations(posts, p)
    back = files.read_annotations(spark, p)
    assert rows(back, "post_id") == [(7,), (8,)]
    p2 = scratch_path(spark, "t-json-obj")
    spark.createDataFrame([('{"1": {"annotators": [{"label": "normal", "target": ["None"]}], "post_tokens": ["x"]},'
                            ' "2": {"annotators": [], "post_tokens": []}}',)], "value string").coalesce(1).write.text(p2)
    assert rows(files.read_annotations(spark, p2, layout="object"), "post_id") == [(1,), (2,)]


def test_delimited_records(spark):
    p = scratch_path(spark, "t-delim")
    spark.createDataFrame([("first\n-second\n- third\n-\n-",)], "value string").coalesce(1).write.text(p)
    assert rows(files.read_delimited(spark, p)) == [("first",), ("second",), ("third",)]


def test_prompts_named_by_folder(spark):
    p = scratch_path(spark, "t-prompts")
    df = spark.createDataFrame([("hate_native_american_1k.txt", "a-b\\nc"), ("neutral_women_1k.txt", "  ")],
                               "file_name string, text string")
    files.write_prompts(df, p)
    assert rows(files.read_prompts(spark, p)) == [("hate", "native_american", "ab"), ("hate", "native_american", "c"),
                                                 ("neutral", "women", "")]


def test_corpus_partition_pruning(spark):
    p = scratch_path(spark, "t-corpus")
    df = spark.createDataFrame([(1, "hate", "women", "x"), (2, "neutral", "jews", "y")],
                               "doc_id long, tone string, target string, text string")
    files.write_corpus(df, p)
    sel = files.read_corpus(spark, p, tone="hate")
    assert rows(sel, "doc_id") == [(1,)]
    plan = sel._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "tone" in plan


def test_labeled_csv_legacy_comma(spark):
    p = scratch_path(spark, "t-legacy")
    spark.createDataFrame([("tone,target,text",), ("hate,Women, first, second",), ('neutral,Jewish,"quoted, text"',),
                           ("tone,target,text",)],
                          "value string").coalesce(1).write.text(p)
    out = rows(files.read_labeled_csv(spark, p, legacy_comma=True))
    assert out == [("hate", "women", "first"), ("neutral", "jewish", '"quoted'),
                   ("tone", "target", "text")]  # only the first line is the header


def _hostile_object(n):
    import json
    words = ["plain", "brace } in", 'quote " and \\ back', "{", "}", "\\\\", "é}", "[", "}{", '\\"}', "", ",", '"1": {']
    return {str(i): {"annotators": [{"label": words[(i + j) % len(words)], "target": [words[(i * j) % len(words)], "x"]} for j in range(i % 4)],
                     "post_tokens": [words[(i * 7 + j) % len(words)] for j in range(i % 6)]} for i in range(n)}, json


@pytest.mark.parametrize("split", [7, 61, 1000, 1 << 20])
@pytest.mark.parametrize("indent", [None, 2])
def test_annotated_object_in_splits(spark, split, indent):
    """Equal to the whole-file reader, with splits inside strings, escapes and nested objects."""
    want, json = _hostile_object(40)
    path = scratch_path(spark, "t-object")
    spark.createDataFrame([(json.dumps(want, indent=indent, ensure_ascii=False),)], "value string").coalesce(1).write.text(path)
    settings = {"spark.sql.files.maxPartitionBytes": str(split), "spark.sql.files.openCostInBytes": "0", "spark.sql.files.minPartitionNum": "1"}
    old = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        df = files.read_annotations(spark, path, layout="object")
        got = {str(r.post_id): {"annotators": [{"label": a.label, "target": a.target} for a in r.annotators], "post_tokens": r.post_tokens}
               for r in df.collect()}
    finally:
        for k, v in old.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)
    assert got == want


def test_annotated_object_without_posts(spark):
    path = scratch_path(spark, "t-object")
    spark.createDataFrame([("{}",), (" {\n}\n",)], "value string").repartition(2).write.text(path)
    assert files.read_annotations(spark, path, layout="object").count() == 0


def test_corpus_files_by_name(spark):
    df = spark.createDataFrame([("hate", "native_american", t) for t in HOSTILE + ["NA", "null", ""]] + [("neutral", "women", "x")],
                               "tone string, target string, text string")
    p = scratch_path(spark, "t-corpus")
    files.write_corpus_csv(df, p)
    assert rows(files.read_corpus_csv(spark, p)) == rows(df)
    named = scratch_path(spark, "t-named") + "/hate_black.csv"  # the original names the file itself
    files.write_csv(spark.createDataFrame([("a, b",)], "text string"), named, header=False)
    assert rows(files.read_corpus_csv(spark, named)) == [("hate", "black", "a, b")]


def test_corpus_grown_in_batches(spark):
    """Any order of batches gives the set of one build; untouched folders keep their files; a batch run again changes nothing."""
    import itertools
    import os
    batches = [[("hate", "women", "a"), ("hate", "women", "a"), ("neutral", "jews", "b")],
               [("hate", "women", "a"), ("hate", "women", "c"), ("hate", "black", "a")], [("hate", "women", "c"), ("hate", "women", None)]]
    schema = "tone string, target string, text string"
    want = sorted({r for b in batches for r in b}, key=str)
    for order in itertools.permutations(range(3)):
        path = scratch_path(spark, "t-grown")
        for i in order:
            files.append_corpus(spark.createDataFrame(batches[i], schema), path, i)
        got = lambda: sorted((tuple(r) for r in files.read_grown_corpus(spark, path).collect()), key=str)  # noqa: B023, E731
        assert got() == want
    local = path.removeprefix("file:")
    listing = lambda: {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, fs in os.walk(f"{local}/data/tone=neutral") for f in fs}
    before = listing()
    assert before
    files.append_corpus(spark.createDataFrame([("hate", "women", "d"), ("hate", "women", "a")], schema), path, 7)
    files.append_corpus(spark.createDataFrame([("hate", "women", "d"), ("hate", "women", "a")], schema), path, 7)
    assert listing() == before and got() == sorted([*want, ("hate", "women", "d")], key=str)


def _document(path):
    """The part files put together by part number."""
    import glob
    import os
    parts = sorted(glob.glob(f"{path}/part-*"), key=lambda f: int(os.path.basename(f).split("-")[1]))
    return "".join(open(f, encoding="utf-8").read() for f in parts)


def test_probabilities_document_is_one_array_in_order(spark):
    import json
    data = [(i // 2, None if i % 7 == 0 else i / 3, i % 2) for i in range(500)]  # ties and nulls
    df = spark.createDataFrame(data, "vec_id long, score double, prediction int").repartition(7)
    p = scratch_path(spark, "t-document")
    files.write_probabilities_document(df, p, ("vec_id", "prediction"))
    assert [(e["vec_id"], e["score"], e["prediction"]) for e in json.loads(_document(p))] == sorted(data, key=lambda r: (r[0], r[2]))
    assert sorted(map(str, files.read_probabilities_document(spark, p).collect())) == sorted(map(str, df.collect()))


def test_probabilities_document_empty_and_hostile_texts(spark):
    import json
    p = scratch_path(spark, "t-document")
    files.write_probabilities_document(spark.createDataFrame([], files.PROBABILITIES), p)
    assert json.loads(_document(p)) == [] and files.read_probabilities_document(spark, p).count() == 0
    texts = HOSTILE + ["[", "]", ",", "{", ""]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "at long, value string")  # clashing names
    p = scratch_path(spark, "t-document")
    files.write_probabilities_document(df, p, ("at",))
    assert [e["value"] for e in json.loads(_document(p))] == texts
    assert rows(files.read_probabilities_document(spark, p, "at long, value string")) == rows(df)


def test_failed_probabilities_document_leaves_nothing(spark):
    import os
    df = spark.range(100).select(F.col("id").alias("vec_id"), F.when(F.col("id") == 77, F.raise_error(F.lit("lost"))).otherwise(0.5).alias("score"))
    p = scratch_path(spark, "t-document")
    with pytest.raises(Exception, match="lost"):
        files.write_probabilities_document(df, p)
    assert not os.path.exists(p) or not [f for f in os.listdir(p) if not f.startswith((".", "_temporary"))]
