"""Cleaning, taxonomy, consensus, dedup and labels on hand-written rows (quirks Q1-Q27)."""

from pyspark.sql import functions as F

from tenor import vocab
from tenor.functions import text as T
from tenor.operators import clean, consensus, corpus, labels, taxonomy

from conftest import rows


def _posts(spark, data):
    schema = ("post_id long, annotators array<struct<label:string,target:array<string>>>, "
              "post_tokens array<string>")
    return consensus.flatten_posts(spark.createDataFrame(data, schema))


def test_consensus_two_hatespeech_votes(spark):
    flat = _posts(spark, [
        (1, [("hatespeech", ["Women"]), ("hatespeech", ["Women"]), ("normal", ["Men"])], ["a", "b"]),
        (2, [("hatespeech", ["Women"]), ("offensive", ["Women"]), ("normal", [])], ["c"]),
    ])
    lab = {r["post_id"]: r["toxic"] for r in consensus.consensus_label(flat).collect()}
    assert lab == {1: 1, 2: 0}  # offensive does not count (Q1)


def test_consensus_targets_thresholds_and_repeats(spark):
    flat = _posts(spark, [
        # toxic: Women 2 votes survives, Men 1 vote dropped
        (1, [("hatespeech", ["Women"]), ("hatespeech", ["Women", "Men"]), ("normal", [])], ["x"]),
        # neutral: one vote is enough; repeats within one annotator count (Q2)
        (2, [("normal", ["Jewish", "Jewish"]), ("normal", []), ("normal", [])], ["y"]),
        # toxic without any target reaching 2 votes: the post vanishes
        (3, [("hatespeech", ["Asian"]), ("hatespeech", ["Black?"]), ("normal", [])], ["z"]),
    ])
    out = rows(consensus.consensus_targets(flat), "post_id", "target", "votes")
    assert out == [(1, "Women", 2), (2, "Jewish", 2)]


def test_consensus_one_and_four_annotators(spark):
    flat = _posts(spark, [
        (1, [("hatespeech", ["Women"])], ["a"]),
        (2, [("hatespeech", ["Women"]), ("normal", []), ("normal", []), ("hatespeech", ["Women"])], ["b"]),
    ])
    lab = {r["post_id"]: (r["n_annotators"], r["toxic"]) for r in consensus.consensus_label(flat).collect()}
    assert lab == {1: (1, 0), 2: (4, 1)}  # every annotator votes (Q3 fix)


def test_unknown_annotation_target_ignored(spark):
    flat = _posts(spark, [(1, [("normal", ["Martian"]), ("normal", ["Women"]), ("normal", [])], ["a"])])
    assert rows(consensus.consensus_targets(flat), "target") == [("Women",)]


def test_taxonomy_map_and_quarantine(spark):
    df = spark.createDataFrame([(1, "Middle_East"), (2, "arabs"), (3, "gay"), (4, "women")], "doc_id long, raw string")
    mapped = rows(taxonomy.map_taxonomy(df), "doc_id", "target")
    assert mapped == [(1, "arab"), (4, "women")]
    assert rows(taxonomy.taxonomy_quarantine(df), "doc_id") == [(2,), (3,)]


def test_clean_prompt_quirks(spark):
    df = spark.createDataFrame([("a - b\\nc-d\\n   \\n\\n-",)], "line string")
    out = df.select(clean.clean_prompt("line").alias("f")).first()["f"]
    # dashes removed, literal backslash-n splits, blank fragment survives as "" (Q13)
    assert out == ["a  b", "cd", ""]
    out2 = df.select(clean.clean_prompt("line", drop_blank=True).alias("f")).first()["f"]
    assert out2 == ["a  b", "cd"]


def test_parse_names(spark):
    df = spark.createDataFrame([("hate_native_american_1k.txt",), ("neutral_women_1k.txt",), ("hate_x.txt",)],
                               "n string")
    p = df.select(clean.parse_name("n", "prompt").alias("p")).select("p.tone", "p.raw")
    assert sorted(tuple(r) for r in p.collect()) == [("hate", ""), ("hate", "native_american"),
                                                     ("neutral", "women")]
    c = spark.createDataFrame([("hate_middle_east.csv",)], "n string").select(clean.parse_name("n", "corpus").alias("p"))
    assert tuple(c.select("p.tone", "p.raw").first()) == ("hate", "middle_east")  # Q12 fix


def test_known_group_filter_alias(spark):
    df = spark.createDataFrame([("hate_other.csv", "t1"), ("hate_women.csv", "t2"), ("hate_all.csv", "t3"),
                                ("hate_women.txt", "t4")], "file_name string, text string")
    out = rows(clean.known_group_filter(df), "text", "target")
    assert out == [("t1", "others"), ("t2", "women")]


def test_strip_matches_python(spark):
    spaces = [chr(c) for c in range(0x3001) if chr(c).isspace()]
    samples = ["  a b \n", "\t\nx", "y\r\n", "", "   ", *[f"{c}a{c}b{c}" for c in spaces], "\u200ba", "\u180eb"]
    df = spark.createDataFrame([(s,) for s in samples], "t string")
    got = [r[0] for r in df.select(T.strip_text("t")).collect()]
    assert got == [s.strip() for s in samples]


def test_legacy_comma_field(spark):
    df = spark.createDataFrame([("hate,women, a text, with commas",), ("x,y",)], "l string")
    assert [r[0] for r in df.select(clean.legacy_comma_field("l")).collect()] == ["a text", None]


def test_score_threshold_split(spark):
    df = spark.createDataFrame([(1, 0.5), (2, 0.50001), (3, None)], "k long, hate_speech_score double")
    assert rows(clean.score_threshold_split(df), "k", "tone") == [(1, "neutral"), (2, "hate")]


def test_encode_target_16_keeps_unknown(spark):
    df = spark.createDataFrame([("trans",), ("arabs",)], "target string")
    assert rows(clean.encode_target_16(df, "target"), "target") == [("15",), ("arabs",)]


def test_dedup_keep_first(spark):
    df = spark.createDataFrame([(5, 0, "a"), (2, 3, "a"), (2, 1, "a"), (9, 0, "b")], "doc_id long, seq int, text string")
    out = rows(corpus.dedup_keep_first(df), "text", "doc_id", "seq")
    assert out == [("a", 2, 1), ("b", 9, 0)]


def test_data_summary_lists_every_group(spark):
    df = spark.createDataFrame([("hate", "women", "x"), ("hate", "women", "x"), ("neutral", "jews", "x")],
                               "tone string, target string, text string")
    out = {r["target"]: (r["n_hate"], r["n_neutral"]) for r in corpus.data_summary(df).collect()}
    assert len(out) == 12 and out["women"] == (1, 0) and out["jews"] == (0, 1) and out["overall"] == (1, 1)


def test_multi_hot_and_join_agree(spark):
    df = spark.createDataFrame([
        ("hate", "women", "s1"), ("neutral", "jews", "s1"), ("hate", "others", "s2"), ("neutral", "women", "s1"),
    ], "tone string, target string, text string")
    mh = {(r["tone"], r["text"]): r["labels"] for r in labels.multi_hot(df).collect()}
    v1 = [0] * 11
    v1[0] = v1[1] = 1
    v2 = [0] * 11
    v2[10] = 1
    assert mh == {("hate", "s1"): v1, ("neutral", "s1"): v1, ("hate", "s2"): v2}
    j = labels.multi_hot_join(df).groupBy("tone", "text").agg(F.collect_set("target").alias("t"))
    assert {(r["tone"], r["text"]): sorted(r["t"]) for r in j.collect()} == {
        ("hate", "s1"): ["jews", "women"], ("neutral", "s1"): ["jews", "women"], ("hate", "s2"): ["others"]}


def test_class_weights_relative_and_inverse(spark):
    df = spark.createDataFrame([(0,), (0,), (0,), (1,)], "target_id int")
    w = {r["target_id"]: r["weight"] for r in labels.class_weights(df).collect()}
    assert w == {0: 0.75, 1: 0.25}  # Q22: rare classes weigh less
    wi = {r["target_id"]: r["weight"] for r in labels.class_weights(df, inverse=True).collect()}
    assert abs(wi[1] - 2.0) < 1e-12


def test_expected_combinations(spark):
    df = spark.createDataFrame([("hate", "trans"), ("hate", "women"), ("neutral", "women")], "tone string, raw string")
    out = rows(taxonomy.expected_combinations(df), "tone", "raw", "present")
    assert out == [("hate", "trans", True), ("hate", "women", True), ("neutral", "women", True)]
    # the tones are those found: a single tone implies no file of another, a third tone its own files
    df2 = spark.createDataFrame([("hate", "women")], "tone string, raw string")
    assert rows(taxonomy.missing_combinations(df2), "tone", "raw") == []
    df3 = spark.createDataFrame([("hate", "women"), ("sarcasm", "asian"), ("neutral", "asian")], "tone string, raw string")
    assert rows(taxonomy.missing_combinations(df3), "tone", "raw") == [
        ("hate", "asian"), ("neutral", "women"), ("sarcasm", "women")]


def test_tokens_and_encoding(spark):
    df = spark.createDataFrame([("Hello, World!  It's-fine",)], "t string")
    tk = df.select(T.tokens("t").alias("k")).first()["k"]
    assert tk == ["hello", "world", "it", "s", "fine"]
    ids = df.select(T.token_ids(T.tokens("t")).alias("i"))
    enc = ids.select(T.encode_windows("i", max_len=8).alias("e")).first()["e"]
    assert len(enc) == 1
    enc = enc[0]
    assert len(enc["input_ids"]) == 8 and enc["input_ids"][5:] == [0, 0, 0]
    assert enc["attention_mask"] == [1] * 5 + [0] * 3 and all(0 < i < T.VOCAB_SIZE for i in enc["input_ids"][:5])


def test_vocab_sizes():
    assert len(vocab.GROUPS) == 11 and len(vocab.ANNOTATION_TARGETS) == 18
    assert len(vocab.TAXONOMY) == 28 and len(vocab.PROMPT_TARGET_IDS) == 16


def test_encode_windows_cover_whole_text(spark):
    df = spark.createDataFrame([("a b c d e",), ("",)], "t string")
    ids = df.select(T.token_ids(T.tokens("t")).alias("ids"))
    out = ids.select("ids", T.encode_windows("ids", max_len=2).alias("w")).collect()
    full = out[0]
    assert [w["input_ids"] for w in full["w"]] == [full["ids"][0:2], full["ids"][2:4], [full["ids"][4], 0]]
    assert [sum(w["attention_mask"]) for w in full["w"]] == [2, 2, 1]
    assert [w["input_ids"] for w in out[1]["w"]] == [[0, 0]]  # empty text: one padding window
