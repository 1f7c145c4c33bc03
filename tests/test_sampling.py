"""Sampling, splitting and batching (E5-E7, F2, F3): exactness and partition invariance."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tenor import vocab
from tenor.functions.text import seeded_hash
from tenor.operators import sampling
from tenor.plans import bindings

from conftest import SF_MID, rows


def _corpus(spark):
    return bindings.corpus(spark, SF_MID).select("doc_id", "target", "tone", "text")


@pytest.mark.parametrize("bits", [1, 4, 12])
def test_exact_rank_equals_row_number(spark, bits):
    c = _corpus(spark)
    ours = sampling.exact_rank(c, ["target", "tone"], "doc_id", bits=bits).select("doc_id", "rank")
    w = Window.partitionBy("target", "tone").orderBy(seeded_hash(F.col("doc_id")), "doc_id")
    ref = c.select("doc_id", (F.row_number().over(w) - 1).alias("rank"))
    assert rows(ours) == rows(ref)


def test_balanced_counts_equal_or_untouched(spark):
    c = _corpus(spark)
    bal = sampling.balanced_downsample(c)
    before = {(r["target"], r["tone"]): r["count"] for r in c.groupBy("target", "tone").count().collect()}
    after = {(r["target"], r["tone"]): r["count"] for r in bal.groupBy("target", "tone").count().collect()}
    for g in {t for t, _ in before}:
        h, n = before.get((g, "hate"), 0), before.get((g, "neutral"), 0)
        if h and n:
            assert after[(g, "hate")] == after[(g, "neutral")] == min(h, n)
        else:  # Q15: an empty class switches balancing off
            assert after.get((g, "hate"), 0) == h and after.get((g, "neutral"), 0) == n


def test_results_unchanged_under_repartition(spark):
    c = _corpus(spark)
    base = rows(sampling.balanced_downsample(c).select("doc_id"))
    for n in (1, 3, 17):
        assert rows(sampling.balanced_downsample(c.repartition(n)).select("doc_id")) == base
    b1 = rows(sampling.assign_batches(c, 16).select("doc_id", "batch_id"))
    assert rows(sampling.assign_batches(c.repartition(5), 16).select("doc_id", "batch_id")) == b1


def test_split_disjoint_complete_and_fraction(spark):
    docs = bindings.table(spark, SF_MID, "documents").select("doc_id")
    s = sampling.train_test_split(docs)
    assert s.count() == docs.count()
    assert s.select("doc_id").distinct().count() == docs.count()
    frac = s.where(F.col("split") == "test").count() / docs.count()
    assert 0.15 < frac < 0.25


def test_mixed_batches_pair_equal_slices(spark):
    c = _corpus(spark)
    mb = sampling.mixed_batches(c, 16)
    per = mb.groupBy("target", "batch_id").agg(F.count_if(F.col("tone") == "hate").alias("h"),
                                               F.count_if(F.col("tone") == "neutral").alias("n"))
    assert per.where(F.col("h") != F.col("n")).count() == 0
    assert per.where(F.col("h") > 16).count() == 0


def test_sample_n_exact(spark):
    c = _corpus(spark)
    assert sampling.sample_n(c, 50).count() == 50
    assert rows(sampling.sample_n(c, 50).select("doc_id")) == rows(sampling.sample_n(c.repartition(7), 50).select("doc_id"))
    assert sampling.sample_n(c, 10 ** 6).count() == c.count()


def test_seeds_independent():
    assert len({vocab.SPLIT_SEED, vocab.SAMPLE_SEED, vocab.BATCH_SEED}) == 3


def test_balanced_then_split_has_both_labels(spark):
    """A balanced sample must not land on one side of the split (independent hashes)."""
    c = _corpus(spark)
    s = sampling.train_test_split(sampling.balanced_downsample(c))
    sides = {(r["split"], r["tone"]) for r in s.select("split", "tone").distinct().collect()}
    assert {("train", "hate"), ("train", "neutral")} <= sides


def test_exact_split_size_and_repartition(spark):
    import math
    c = _corpus(spark)
    s = sampling.train_test_split(c, exact=True)
    n = c.count()
    assert s.where(F.col("split") == "test").count() == math.ceil(0.2 * n)
    assert s.count() == n
    a = rows(s.select("doc_id", "split"))
    assert rows(sampling.train_test_split(c.repartition(5), exact=True).select("doc_id", "split")) == a


def test_head_split_keeps_or_removes_test_rows(spark):
    c = _corpus(spark)
    train, test = sampling.head_split(c, 30)
    assert test.count() == 30 and train.count() == c.count()
    train_d, _ = sampling.head_split(c, 30, disjoint=True)
    assert train_d.count() == c.count() - 30
    assert train_d.join(test, "doc_id").count() == 0
