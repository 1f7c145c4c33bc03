"""Scale properties of the executed plans (guards against regressions)."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as E  # noqa: E402
from plans import executed, summary  # noqa: E402

from conftest import SF_SMALL  # noqa: E402


def _plan(spark, name):
    df = E.queries()[name](spark, SF_SMALL)
    return summary(executed(df))


@pytest.mark.parametrize("name", ["score_routed", "softmax", "route_topk", "normalize_weights", "argmax_class",
                                  "score_stream", "strip_text", "tokenize"])
def test_row_local_queries_do_not_shuffle(spark, name):
    s = _plan(spark, name)
    assert s["shuffles"] == 0 and s["smj"] == 0 and s["python"] == 0


@pytest.mark.parametrize("name", ["multi_hot", "multi_hot_join", "dedup_keep_first"])
def test_one_shuffle(spark, name):
    s = _plan(spark, name)
    assert s["shuffles"] <= 1 and s["smj"] == 0


def test_exact_selection_reads_rows_without_recounting(spark):
    s = _plan(spark, "balanced_downsample")
    assert s["smj"] == 0 and s["windows"] <= 1  # only the cut bucket is ranked


def test_python_only_in_user_function_scorer(spark):
    assert _plan(spark, "score_udf")["python"] == 1
    assert _plan(spark, "consensus_targets")["python"] == 0
