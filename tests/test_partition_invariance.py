"""Results do not depend on partitioning: shuffle-heavy queries give the same rows
with 1, 3 and 17 shuffle partitions."""

import pytest

import __spark_entry__ as E

from conftest import SF_SMALL

NAMES = ["dedup_keep_first", "multi_hot", "multi_hot_join", "data_summary", "balanced_downsample",
         "mixed_batches", "assign_batches", "sample_n", "nb_score", "score_corpus", "batch_mean_metrics",
         "consensus_targets", "union_sources", "class_weights"]


def _rows(df):
    return sorted(tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in df.collect())


@pytest.mark.parametrize("name", NAMES)
def test_same_rows_for_any_shuffle_partitions(spark, name):
    key = "spark.sql.shuffle.partitions"
    old = spark.conf.get(key)
    results = []
    try:
        for n in ("1", "3", "17"):
            spark.conf.set(key, n)
            results.append(_rows(E.queries()[name](spark, SF_SMALL)))
    finally:
        spark.conf.set(key, old)
    assert results[0] == results[1] == results[2]
