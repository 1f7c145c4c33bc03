"""Every registered query with SQL equals it at sf0.001; the pipeline's stages obey their laws."""

import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))), "tools"))

import __spark_entry__ as E  # noqa: E402
import corpus_pipeline  # noqa: E402
from oracle_check import TABLES, digest  # noqa: E402
from tenor.llm import jaccard_join, quality_lines, registry, string_tiling  # noqa: E402

SF = "/root/testdata/sf0.001"


def test_one_query_per_operator():
    names = set(registry.queries())
    assert names <= set(E.queries()) and "pipeline" in names
    assert sorted(int(n[2:].split("_")[0]) for n in names if n != "pipeline") == list(range(1, 14))


@pytest.mark.parametrize("name", sorted(registry.oracles()))
def test_oracle(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df = registry.queries()[name](spark, SF)
    rel = con.execute(registry.oracles()[name])
    cols = [d[0] for d in rel.description]
    assert digest(df.columns, [tuple(r) for r in df.collect()])[0] == digest(cols, rel.fetchall())[0]


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    at, sizes = docs, []
    for name, stage in corpus_pipeline.STAGES:
        new = stage(spark, at, SF).persist()
        sizes.append(new.count())
        if name != "sharding":
            assert new.columns == docs.columns
        if name == "quality_rules":
            want = {r.doc_id for r in quality_lines.quality_rules(at).collect() if r.kept}
            assert {r.doc_id for r in new.collect()} == want
        if name == "jaccard_join":
            assert {r.doc_id for r in new.collect()} == {
                r.component_id for r in jaccard_join.jaccard_components(at, 5, 80).collect()}
        if name == "decontamination":
            leaks = {r.doc_id for r in string_tiling.leaks(at, spark.read.parquet(f"{SF}/benchmark.parquet")).collect()}
            assert {r.doc_id for r in new.collect()} == {r.doc_id for r in at.collect()} - leaks
        at = new
    assert sizes[0] > sizes[1] > 0 and sizes[3] == sizes[4]
    run = corpus_pipeline.run(spark, SF)
    assert sorted((r.doc_id, r.shard, r.slot) for r in run.collect()) == sorted((r.doc_id, r.shard, r.slot) for r in at.collect())


def test_pipeline_of_nothing(spark):
    at = spark.read.parquet(f"{SF}/documents.parquet").where("false")
    for _, stage in corpus_pipeline.STAGES:
        at = stage(spark, at, SF)
    assert at.count() == 0
