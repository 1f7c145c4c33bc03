"""Streaming scoring (J1) and user-function scoring over Arrow batches."""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tenor import vocab
from tenor.functions import probs
from tenor.operators import naive_bayes, routing

PROBA_SCHEMA = T.StructType([
    T.StructField("vec_id", T.LongType()),
    T.StructField("router", T.ArrayType(T.DoubleType())),
    T.StructField("l0", T.ArrayType(T.DoubleType())),
    T.StructField("l1", T.ArrayType(T.DoubleType())),
])

SCORED_SCHEMA = T.StructType([
    T.StructField("vec_id", T.LongType()),
    T.StructField("n_groups", T.LongType()),
    T.StructField("groups", T.StringType()),
    T.StructField("score", T.DoubleType()),
    T.StructField("prediction", T.IntegerType()),
])


def score_stream(spark: SparkSession, in_dir: str, out_dir: str, checkpoint: str,
                 schema: T.StructType = PROBA_SCHEMA, max_files_per_trigger: int | None = None):
    """Routed mixture scoring as a stream: parquet files arriving in ``in_dir`` are
    scored row by row (array form: stateless, no shuffle) and appended to ``out_dir``.
    ``trigger(availableNow=True)`` processes what is there and stops; the checkpoint
    makes re-runs pick up only new files (exactly-once file sink)."""
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    src = reader.parquet(in_dir)
    routed = routing.add_routing(src.withColumn("_p", probs.softmax("router")), "_p", "_kept")
    cols = routing.score_routed_arrays("_kept", "l0", "l1")
    scored = routed.select("vec_id", *[c.alias(n) for n, c in cols.items()])
    q = (scored.writeStream.format("parquet").option("path", out_dir).option("checkpointLocation", checkpoint)
         .outputMode("append").trigger(availableNow=True).start())
    q.awaitTermination()
    return q


SENTENCES = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType())])


def write_scored_batch(batch: DataFrame, batch_id: int, model: dict, out_dir: str, key: str = "doc_id") -> None:
    """Score one micro-batch with a fitted model, replay-safe: the scores of a batch have a folder of their own, written
    anew when the batch is replayed, and the ledger names the batch only after its scores are complete."""
    naive_bayes.score_corpus(batch, model, key).write.mode("overwrite").parquet(f"{out_dir}/scores/batch={batch_id}")
    done = batch.sparkSession.read.parquet(f"{out_dir}/scores/batch={batch_id}")
    done.agg(F.count(F.lit(1)).alias("rows")).coalesce(1).write.mode("overwrite").parquet(f"{out_dir}/ledger/batch={batch_id}")


def score_sentences(spark: SparkSession, in_dir: str, out_dir: str, checkpoint: str, model_path: str, key: str = "doc_id",
                    max_files_per_trigger: int | None = None):
    """J1 on sentences: parquet files of (doc_id, text) arriving in ``in_dir`` are scored by the Naive-Bayes router and
    experts stored under ``model_path`` (I9), micro-batch by micro-batch. The checkpoint says which files a batch
    holds and the ledger which batches are complete, so a stop between the two loses and repeats nothing."""
    model = naive_bayes.nb_load(spark, model_path)
    reader = spark.readStream.schema(SENTENCES)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    q = (reader.parquet(in_dir).writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True)
         .foreachBatch(lambda batch, batch_id: write_scored_batch(batch, batch_id, model, out_dir, key)).start())
    q.awaitTermination()
    return q


def read_scored_sentences(spark: SparkSession, out_dir: str) -> DataFrame:
    """The scores of the batches in the ledger."""
    scores = spark.read.parquet(f"{out_dir}/scores")
    ledger = spark.read.parquet(f"{out_dir}/ledger").select("batch")
    return scores.join(F.broadcast(ledger), "batch", "left_semi").drop("batch")  # one row per batch


def dense_weights(kept, n: int = len(vocab.GROUPS)) -> F.Column:
    """ARRAY<DOUBLE>[n]: the routing weight of every group (0 when not retained)."""
    return F.transform(F.sequence(F.lit(0), F.lit(n - 1)),
                       lambda i: F.aggregate(F.filter(kept, lambda k: k["idx"] == i), F.lit(0.0),
                                             lambda acc, k: acc + k["weight"]))


Expert = Callable[[str, pd.DataFrame], np.ndarray]


def score_udf(df: DataFrame, fn: Expert, groups: Sequence[str] = tuple(vocab.GROUPS), key: str = "vec_id", router: str = "router",
              threshold: float = 0.5, pass_cols: Sequence[str] = ("l0", "l1"), names: Sequence[str] = tuple(vocab.GROUPS),
              fallback: str = vocab.FALLBACK_GROUP) -> DataFrame:
    """Routed mixture with user-supplied experts and the caller's own groups.

    ``names`` are the classes of the ``router`` logits, in order and of any number; ``fallback`` is the one taken when the
    router is unsure. Routing stays in the JVM (array expressions). ``fn(group, batch)`` receives the
    pandas rows of an Arrow batch that retained ``group`` and returns their P(hate)
    as an array; it is called once per group and batch, only for rows routed to it, and only for the ``groups`` given:
    a routed group outside them contributes 0. A group that the router does not know is an error. ``key`` names the id column.
    """
    unknown = [g for g in (*groups, fallback) if g not in names]
    if unknown:
        raise ValueError(f"groups that the router does not know: {unknown}")
    routed = routing.add_routing(df.withColumn("_p", probs.softmax(router)), "_p", "_kept", fallback=names.index(fallback))
    kept = F.col("_kept")
    prepared = routed.select(
        key, *pass_cols,
        dense_weights(kept, len(names)).alias("_w"),
        F.size(kept).cast("bigint").alias("n_groups"),
        F.array_join(probs.group_names(F.transform(kept, lambda k: k["idx"]), names), ",").alias("groups"))
    index = {g: names.index(g) for g in groups}
    schema = T.StructType([T.StructField(key, T.LongType()), *SCORED_SCHEMA.fields[1:]])

    def run(batches):
        for pdf in batches:
            w = np.stack(pdf["_w"].to_numpy()) if len(pdf) else np.zeros((0, len(names)))
            score = np.zeros(len(pdf))
            for g, gi in index.items():
                rows = w[:, gi] > 0
                if rows.any():
                    score[rows] += w[rows, gi] * np.asarray(fn(g, pdf.loc[rows]), dtype="float64")
            yield pd.DataFrame({key: pdf[key].astype("int64"), "n_groups": pdf["n_groups"].astype("int64"),
                                "groups": pdf["groups"], "score": score,
                                "prediction": (score > threshold).astype("int32")})

    return prepared.mapInPandas(run, schema)


_LOADED: dict[str, Callable[[pd.DataFrame], np.ndarray]] = {}


def loaded_experts(paths: dict[str, str], load: Callable[[str], Callable[[pd.DataFrame], np.ndarray]]) -> Expert:
    """An expert function for :func:`score_udf` over stored models: ``load(path)`` gives a group's predictor and is called the first time
    a Python worker meets the group; the worker keeps it for all batches and tasks that follow. ``paths``
    should lie in the shared folder."""
    def expert(group: str, batch: pd.DataFrame) -> np.ndarray:
        from tenor.streaming import stream  # the worker's own module holds the cache
        path = paths[group]
        if path not in stream._LOADED:
            stream._LOADED[path] = load(path)
        return stream._LOADED[path](batch)

    return expert


def binary_expert(group: str, batch: pd.DataFrame) -> np.ndarray:
    """A simple expert for :func:`score_udf`: softmax of the group's two logits, class 1."""
    gi = vocab.GROUPS.index(group)
    l0 = np.stack(batch["l0"].to_numpy())[:, gi].astype("float64")
    l1 = np.stack(batch["l1"].to_numpy())[:, gi].astype("float64")
    return 1.0 / (1.0 + np.exp(l0 - l1))
