"""Fitted models (I3-I7): teacher, distilled students, router, sweep, rounds.

The transformer networks of the original are re-aimed as linear classifiers over hashed words and word pairs,
trained in rounds on the original's own losses by ``tenor.operators.gradient``: cross-entropy for the teacher, class-
weighted cross-entropy for the router, and (1 - a) CE + a T^2 KL(teacher_T || student_T) for the students,
whose blocks (one per group) are one joint fit. Texts are hashed once, into a stored frame that every
round, evaluation and teacher pass reads; the teacher's logits are a column of the students' frame.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tenor import vocab
from tenor.functions import probs
from tenor.operators import gradient, labels, losses, metrics, routing, sampling
from tenor.operators.gradient import Model, Shape
from tenor.session import scratch_path

TEACHER = Shape(1, 2, 1 << 16)
STUDENTS = Shape(len(vocab.GROUPS), 2, 1 << 10)
ROUTER = Shape(1, len(vocab.GROUPS), 1 << 12)
ROUNDS = 5


def _stored(df: DataFrame, name: str) -> DataFrame:
    """Written once to the shared folder and read back: rounds read columns, not the plan that made them."""
    path = scratch_path(df.sparkSession, name)
    spread(df).write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def spread(df: DataFrame) -> DataFrame:
    """Round-robin over ``spark.sql.shuffle.partitions`` partitions: the joins and selections before may have left
    few or uneven ones, and every round scans the frame."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def _gold() -> Column:
    return (F.col("tone") == vocab.TONES[1]).cast("int").alias("gold")


def pooled_corpus(corpus: DataFrame) -> DataFrame:
    """hate_all / neutral_all: corpus texts pooled per tone, first doc_id kept."""
    return corpus.groupBy("tone", "text").agg(F.min("doc_id").alias("doc_id"))


def teacher_frame(corpus: DataFrame) -> DataFrame:
    """Balanced pooled corpus with a hash split, hashed and stored: (doc_id, gold, split, block, weight, idx)."""
    pooled = pooled_corpus(corpus).withColumn("_pool", F.lit("all"))
    bal = sampling.balanced_downsample(pooled, group_col="_pool", tone_col="tone", key="doc_id")
    rows = gradient.add_features(sampling.train_test_split(bal.select("doc_id", "text", _gold()), key="doc_id"))
    return _stored(rows.select("doc_id", "gold", "split", F.lit(0).alias("block"), F.lit(1.0).alias("weight"), "idx"), "teacher-rows")


def student_frame(corpus: DataFrame, teacher: Model) -> DataFrame:
    """Per-group balanced rows with a hash split, hashed once, next to the teacher's logits, stored:
    (doc_id, target, gold, split, block, weight, idx, teacher)."""
    bal = sampling.balanced_downsample(corpus.select("doc_id", "target", "tone", "text"))
    lab = sampling.train_test_split(bal.select("doc_id", "target", "text", _gold()), key="doc_id")
    rows = gradient.add_features(lab).join(F.broadcast(vocab.groups_df(corpus.sparkSession)), "target")
    rows = rows.select("doc_id", "target", "gold", "split", F.col("target_id").alias("group"), F.lit(0).alias("block"),
                       F.lit(1.0).alias("weight"), "idx")
    asked = gradient.logits(rows, teacher, out="teacher", features=True)
    return _stored(asked.select("doc_id", "target", "gold", "split", F.col("group").alias("block"), "weight", "idx", "teacher"), "student-rows")


def router_frame(group_ids: DataFrame, inverse: bool = False, disjoint: bool = False) -> DataFrame:
    """G5 rows with class weights (D5), hashed and stored; ``split`` = test for the head test set (F2),
    which the training part keeps unless ``disjoint`` (Q25). The group-id table is stored first: weights, test set and
    training part read it instead of splitting and deduplicating the lines once more each."""
    path = scratch_path(group_ids.sparkSession, "group-ids")
    group_ids.write.parquet(path)
    group_ids = group_ids.sparkSession.read.schema(group_ids.schema).parquet(path)
    w = labels.class_weights(group_ids, "target_id", inverse).select("target_id", "weight")
    keyed = group_ids.withColumn("_key", F.concat(F.col("target_id").cast("string"), F.lit(":"), F.col("text")))
    train, test = sampling.head_split(keyed, key="_key", disjoint=disjoint)
    both = train.withColumn("split", F.lit("train")).unionByName(test.withColumn("split", F.lit("test")))
    rows = gradient.add_features(both.join(F.broadcast(w), "target_id"))  # at most 11 classes
    return _stored(rows.select(F.col("target_id").alias("gold"), "split", F.lit(0).alias("block"), "weight", "idx"), "router-rows")


def _split(df: DataFrame, name: str) -> DataFrame:
    return df.where(F.col("split") == name)


def _sizes(frame: DataFrame) -> DataFrame:
    return frame.agg(F.count_if(F.col("split") == "train").alias("n_train"), F.count_if(F.col("split") == "test").alias("n_test"))


def _answers(frame: DataFrame, model: Model, **kw) -> DataFrame:
    """The frame with ``logits`` and ``prediction`` in place of its features."""
    return gradient.logits(frame, model, **kw).withColumn("prediction", probs.argmax("logits"))


def fit_teacher(corpus: DataFrame, rounds: int = ROUNDS, path: str | None = None) -> tuple[Model, DataFrame]:
    """Teacher over the whole pooled corpus; (model, report: n_train, n_test, loss, accuracy, precision,
    recall, f1, the last five on the test part)."""
    frame = teacher_frame(corpus)
    model = gradient.fit(_split(frame, "train"), TEACHER, gradient.cross_entropy, rounds, path)
    asked = _answers(_split(frame, "test"), model)
    scores = metrics.weighted_metrics(asked).drop("n").crossJoin(losses.cross_entropy(asked, "logits").select(F.col("ce").alias("loss")))
    return model, _sizes(frame).crossJoin(scores)  # one row each


def fitted_groups(frame: DataFrame) -> list[str]:
    """Groups whose training part holds both labels (at most 11 names)."""
    seen = _split(frame, "train").groupBy("target").agg(F.countDistinct("gold").alias("n")).where("n = 2")
    return sorted(r["target"] for r in seen.collect())


def fit_students(corpus: DataFrame, teacher: Model, alpha: float = vocab.DISTILL_ALPHA,
                 temperature: float = vocab.DISTILL_TEMPERATURE, rounds: int = ROUNDS, path: str | None = None):
    """I4: one student per group on the distillation loss, one joint fit; (model, frame of the fitted groups, report). The report has a
    row per group: n_train, n_test, fitted, and of fitted groups the training loss (D13) and accuracy and F1 on the test part."""
    spark = corpus.sparkSession
    frame = student_frame(corpus, teacher)
    mine = frame.where(F.col("target").isin(fitted_groups(frame)))
    model = gradient.fit(_split(mine, "train"), STUDENTS, gradient.distillation(alpha, temperature), rounds, path)
    asked = _answers(mine, model)
    lost = losses.distillation_loss(_split(asked, "train"), "logits", alpha=alpha, temperature=temperature, by=("target",))
    scores = metrics.binary_metrics_by(_split(asked, "test"), "target").drop("n")
    sizes = frame.groupBy("target").agg(F.count_if(F.col("split") == "train").alias("n_train"),
                                        F.count_if(F.col("split") == "test").alias("n_test"))
    groups = vocab.groups_df(spark).select("target")
    report = (groups.join(sizes, "target", "left").join(lost, "target", "left").join(scores, "target", "left")  # 11 rows each
              .select("target", F.coalesce("n_train", F.lit(0)).alias("n_train"), F.coalesce("n_test", F.lit(0)).alias("n_test"),
                      F.col("loss").isNotNull().alias("fitted"), "ce", "kl", "loss", "accuracy", "f1"))
    return model, mine, report


def round_scores(frame: DataFrame, model: Model) -> DataFrame:
    """The frame's rows once per round (``epoch``), with that round's logits and prediction: one pass over the features."""
    return _answers(frame, model, turns=list(range(1, model.rounds + 1)))


def distill_rounds(frame: DataFrame, model: Model, alpha: float = vocab.DISTILL_ALPHA,
                   temperature: float = vocab.DISTILL_TEMPERATURE) -> DataFrame:
    """(target, epoch, split, n, ce, kl, loss): D13 of every student after every round."""
    return losses.distillation_loss(round_scores(frame, model), "logits", alpha=alpha, temperature=temperature,
                                    by=("target", "epoch", "split"))


def evaluate_rounds(frame: DataFrame, model: Model, alpha: float = vocab.DISTILL_ALPHA,
                    temperature: float = vocab.DISTILL_TEMPERATURE) -> DataFrame:
    """(epoch, mode, metric, value) of the students' rounds over all groups, the layout of the metrics log: D13,
    accuracy and macro F1 on the training and on the test part."""
    by = ("epoch", "mode")
    rows = round_scores(frame, model).withColumn("mode", F.when(F.col("split") == "train", "train").otherwise("eval"))
    lost = losses.distillation_loss(rows, "logits", alpha=alpha, temperature=temperature, by=by).select(*by, "loss")
    both = metrics.macro_f1(rows, by=by).select(*by, "accuracy", "macro_f1").join(lost, list(by))  # 2 x rounds rows
    return both.select(*by, F.explode(F.array(*[F.struct(F.lit(m).alias("metric"), F.col(c).alias("value")) for m, c in (
        ("loss", "loss"), ("acc", "accuracy"), ("f1", "macro_f1"))])).alias("x")).select(*by, "x.metric", "x.value")


def fit_router(group_ids: DataFrame, rounds: int = ROUNDS, inverse: bool = False, disjoint: bool = False,
               path: str | None = None) -> tuple[Model, DataFrame]:
    """11-class router over the group-id table with class weights; (model, report: n_train, n_test, accuracy, macro_f1)."""
    frame = router_frame(group_ids, inverse, disjoint)
    model = gradient.fit(_split(frame, "train"), ROUTER, gradient.cross_entropy, rounds, path)
    scores = metrics.macro_f1(_answers(_split(frame, "test"), model)).select("accuracy", "macro_f1")
    return model, _sizes(frame).crossJoin(scores)  # one row each


def sweep(corpus: DataFrame, teacher: Model, group: str = vocab.SWEEP_GROUP, alphas=tuple(vocab.SWEEP_ALPHAS),
          temperature: float = vocab.SWEEP_TEMPERATURE, rounds: int = ROUNDS) -> DataFrame:
    """One student per alpha on one group, all settings as blocks of one fit (independent trials; each row appears once per
    setting): (config, alpha, temperature, loss, accuracy, f1), the last three on the test part, null where the group
    lacks rows of a label."""
    spark = corpus.sparkSession
    frame = student_frame(corpus.where(F.col("target") == group), teacher)
    settings = spark.createDataFrame([(i, f"hyper{i}", float(a), float(temperature)) for i, a in enumerate(alphas)],
                                     "block int, config string, alpha double, temperature double")
    if not fitted_groups(frame):
        return settings.select("config", "alpha", "temperature", *[F.lit(None).cast("double").alias(c) for c in ("loss", "accuracy", "f1")])
    each = frame.drop("block").withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(len(alphas) - 1))))
    model = gradient.fit(_split(each, "train"), Shape(len(alphas), 2, STUDENTS.features), gradient.distillation(alphas, temperature), rounds)
    asked = _answers(_split(each, "test"), model).join(F.broadcast(settings), "block")
    lost = losses.distillation_loss(asked, "logits", alpha=F.max("alpha"), temperature=temperature, by=("config",)).select("config", "loss")
    scores = metrics.binary_metrics_by(asked, "config").drop("n")
    return (settings.join(lost, "config", "left").join(scores, "config", "left")
            .select("config", "alpha", "temperature", "loss", "accuracy", "f1"))


def score_fitted(docs: DataFrame, router: Model, students: Model, key: str = "doc_id", text: str = "text",
                 threshold: float = 0.5) -> DataFrame:
    """(key, n_groups, groups, score, prediction): documents routed by the fitted router (E3, E4), each retained
    group's student asked, the answers mixed by weight (D7). Only retained (document, group) pairs meet a
    student; their features stay in the row, so nothing but the last sum is shuffled. Rows that share a key are one document.
    A score that differs from the threshold by rounding only (groups without a student answer 0.5) does not exceed it."""
    rows = gradient.add_features(docs.select(key, text), text).select(key, F.lit(0).alias("block"), "idx")
    routed = gradient.logits(rows, router, out="router", features=True).select(key, "idx", probs.softmax("router").alias("_p"))
    kept = routing.add_routing(routed, "_p", "kept").select(key, "idx", F.posexplode("kept").alias("rank", "k"))
    pairs = kept.select(key, "rank", F.col("k.idx").cast("int").alias("block"), F.col("k.weight").alias("weight"), "idx")
    asked = gradient.logits(pairs, students).withColumn("p", probs.p_binary(F.get("logits", 0), F.get("logits", 1)))
    names = F.array_sort(F.collect_list(F.struct("rank", F.get(vocab.groups_array(), F.col("block")).alias("g"))))  # three at most
    score = F.sum(F.col("weight") * F.col("p"))
    return asked.groupBy(key).agg(F.count(F.lit(1)).alias("n_groups"), F.array_join(F.transform(names, lambda x: x["g"]), ",").alias("groups"),
                                  score.alias("score"), (F.round(score, 12) > threshold).cast("int").alias("prediction"))


def corpus_models(spark: SparkSession, corpus: DataFrame, group_ids: DataFrame, path: str) -> tuple[Model, Model, Model]:
    """(teacher, students, router) fitted under ``path`` (or gone on with from the rounds found there)."""
    teacher, _ = fit_teacher(corpus, path=f"{path}/teacher")
    students, _, _ = fit_students(corpus, teacher, path=f"{path}/students")
    return teacher, students, fit_router(group_ids, path=f"{path}/router")[0]
