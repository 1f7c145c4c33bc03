"""Streaming scorer (J1): equals the batch scorer, and a re-run with the same
checkpoint picks up only files that arrived since (no duplicates)."""

from pyspark.sql import functions as F

from tenor.functions import text as text_fn
from tenor.operators import naive_bayes, routing
from tenor.plans import bindings
from tenor.plans.queries_learn import nb_train
from tenor.session import scratch_path
from tenor.streaming import stream

from conftest import SF_SMALL, rows
from test_models import _exchanged


def test_stream_incremental_and_equal_to_batch(spark):
    base = scratch_path(spark, "t-stream")
    src = bindings.proba(spark, SF_SMALL).select("vec_id", "router", "l0", "l1")
    first = src.where(F.col("vec_id") % 2 == 0)
    second = src.where(F.col("vec_id") % 2 == 1)
    first.write.mode("append").parquet(f"{base}/in")
    stream.score_stream(spark, f"{base}/in", f"{base}/out", f"{base}/ckpt")
    n1 = spark.read.schema(stream.SCORED_SCHEMA).parquet(f"{base}/out").count()
    assert n1 == first.count()
    second.write.mode("append").parquet(f"{base}/in")
    stream.score_stream(spark, f"{base}/in", f"{base}/out", f"{base}/ckpt")
    out = spark.read.schema(stream.SCORED_SCHEMA).parquet(f"{base}/out")
    assert out.count() == src.count() and out.select("vec_id").distinct().count() == src.count()
    batch = routing.score_routed(src, "vec_id", "router", "l0", "l1")
    assert rows(out.select("vec_id", "groups", F.round("score", 9).alias("s"))) == \
        rows(batch.select("vec_id", "groups", F.round("score", 9).alias("s")))


def test_sentences_through_the_fitted_model(spark):
    """The stream equals the batch scorer; files that arrive later are added; a replayed or unfinished batch changes nothing."""
    base = scratch_path(spark, "t-sentences")
    model = naive_bayes.nb_fit(nb_train(spark, SF_SMALL), f"{base}/model")
    docs = bindings.table(spark, SF_SMALL, "documents").select("doc_id", "text")
    want = rows(naive_bayes.score_corpus(docs, model).select("doc_id", "n_groups", "groups", F.round("score", 9).alias("s"), "prediction"))
    docs.where("doc_id % 3 > 0").repartition(4).write.parquet(f"{base}/in")
    run = lambda: stream.score_sentences(spark, f"{base}/in", f"{base}/out", f"{base}/ckpt", f"{base}/model", max_files_per_trigger=2)
    scored = lambda: rows(stream.read_scored_sentences(spark, f"{base}/out").select(
        "doc_id", "n_groups", "groups", F.round("score", 9).alias("s"), "prediction"))
    run()
    assert scored() == [r for r in want if r[0] % 3 > 0]
    docs.where("doc_id % 3 = 0").write.mode("append").parquet(f"{base}/in")
    run()
    assert scored() == want
    batches = sorted(r["batch"] for r in spark.read.parquet(f"{base}/out/ledger").select("batch").collect())
    assert batches == list(range(len(batches))) and len(batches) >= 3
    again = spark.read.parquet(f"{base}/out/scores").where("batch = 1").join(docs, "doc_id").select("doc_id", "text")
    stream.write_scored_batch(again, 1, naive_bayes.nb_load(spark, f"{base}/model"), f"{base}/replay")  # the same batch, read aside ...
    assert rows(spark.read.parquet(f"{base}/replay/scores").drop("batch")) == rows(spark.read.parquet(f"{base}/out/scores").where("batch = 1").drop("batch"))
    stream.write_scored_batch(spark.read.schema(again.schema).parquet(_kept(again, f"{base}/one")), 1, model, f"{base}/out")  # ... and replayed
    assert scored() == want
    naive_bayes.score_corpus(docs.limit(5), model).write.parquet(f"{base}/out/scores/batch=99")  # stopped before the ledger
    assert scored() == want


def test_sentences_through_a_model_larger_than_a_broadcast(spark, monkeypatch):
    """When only the frequent tokens of the stored model are broadcast, the stream gives the same scores, rows whose key repeats or is null
    included, and its shuffles move fewer rows than the documents have tokens."""
    base = scratch_path(spark, "t-sentences-large")
    model = naive_bayes.nb_fit(nb_train(spark, SF_SMALL), f"{base}/model")
    docs = bindings.table(spark, SF_SMALL, "documents").select("doc_id", "text")
    docs = docs.unionByName(docs.where("doc_id % 5 = 0")).unionByName(docs.where("doc_id % 7 = 0").selectExpr("NULL AS doc_id", "text"))
    scores = lambda df: sorted(str(tuple(r)) for r in df.select("doc_id", "n_groups", "groups", F.round("score", 9), "prediction").collect())
    want = scores(naive_bayes.score_corpus(docs, model))
    monkeypatch.setattr(naive_bayes, "PACK_BYTES", 0)
    monkeypatch.setattr(naive_bayes, "HEAD_BYTES", model["bytes"] // 4, raising=False)
    score, moved = naive_bayes.score_corpus, []

    def counted(batch, *args):
        out = score(batch, *args)
        out.collect()
        moved.append(sum(n for _, n in _exchanged(out._jdf.queryExecution().executedPlan())))
        return out

    monkeypatch.setattr(naive_bayes, "score_corpus", counted)
    docs.repartition(3).write.parquet(f"{base}/in")
    stream.score_sentences(spark, f"{base}/in", f"{base}/out", f"{base}/ckpt", f"{base}/model", max_files_per_trigger=2)
    assert scores(stream.read_scored_sentences(spark, f"{base}/out")) == want and len(want) == docs.count()
    held = docs.select(F.monotonically_increasing_id().alias("r"), F.explode(text_fn.tokens("text")).alias("t")).distinct().count()
    assert len(moved) == 2 and 0 < sum(moved) < held


def _kept(df, path):
    df.write.parquet(path)
    return path


def test_user_groups_and_models_loaded_once_per_worker(spark):
    """Thirteen groups of the caller's, each with a stored model; a worker loads a model once, whatever the batches."""
    import json
    import math
    import os
    import uuid

    import pytest
    base = scratch_path(spark, "t-models").removeprefix("file:")
    names = [f"g{i}" for i in range(13)]
    for i, g in enumerate(names):
        os.makedirs(f"{base}/{g}")
        with open(f"{base}/{g}/model.json", "w") as f:
            json.dump({"slope": 0.3 * i - 1, "bias": 0.1 * i}, f)

    def load(path):
        with open(f"{path}/model.json") as f:
            m = json.load(f)
        open(f"{path}/loaded-{os.getpid()}-{uuid.uuid4().hex}", "w").close()
        return lambda batch: 1 / (1 + np.exp(-(m["slope"] * batch["x"].to_numpy() + m["bias"])))

    import numpy as np
    rng = np.random.default_rng(4)
    data = [(i, rng.normal(0, 2.5 if i % 3 else 0.01, 13).tolist(), float(rng.normal())) for i in range(900)]
    df = spark.createDataFrame(data, "vec_id long, router array<double>, x double").repartition(6)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "40")
    try:
        got = {r.vec_id: r for r in stream.score_udf(df, stream.loaded_experts({g: f"{base}/{g}" for g in names}, load), names, names=names,
                                                     fallback="g12", pass_cols=("x",)).collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    for i, logits, x in data:
        p = np.exp(np.array(logits) - max(logits))
        p = p / p.sum()
        order = sorted(range(13), key=lambda k: (-p[k], k))
        kept, total = [], 0.0
        while len(kept) < 3 and total < 0.5:
            kept.append(order[len(kept)])
            total += p[kept[-1]]
        if p[order[0]] < 0.2:
            kept, total = [12], p[12]
        want = sum(p[k] / total / (1 + math.exp(-((0.3 * k - 1) * x + 0.1 * k))) for k in kept)
        assert got[i].groups == ",".join(names[k] for k in kept) and abs(got[i].score - want) < 1e-9
    for g in names:
        workers = [f.split("-")[1] for f in os.listdir(f"{base}/{g}") if f.startswith("loaded-")]
        assert workers and len(workers) == len(set(workers))
    with pytest.raises(ValueError):
        stream.score_udf(df, stream.binary_expert, ["g1", "unheard"], names=names, fallback="g12")
