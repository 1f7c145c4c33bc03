"""Classification metrics (C7, D8-D11, D14) as aggregations.

Everything reduces to a per-class table (support, predicted, true positives)
built in one aggregation whose key is the class (plus an optional batch key):
partial aggregation leaves a handful of rows per task, so the shuffle is tiny
however many predictions there are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def align_labels(pred: DataFrame, gold: DataFrame, key: str) -> DataFrame:
    """Predictions next to gold labels, joined on the key (never on row order)."""
    return pred.join(gold, key)


def class_table(df: DataFrame, gold: str, pred: str, by: tuple[str, ...] = ()) -> DataFrame:
    """(by..., c, support, predicted, tp): one row per class present in gold or predictions."""
    g, p = F.col(gold), F.col(pred)
    both = F.array(
        F.struct(g.alias("c"), F.lit(1).alias("s"), F.lit(0).alias("q"), (g == p).cast("int").alias("t")),
        F.struct(p.alias("c"), F.lit(0).alias("s"), F.lit(1).alias("q"), F.lit(0).alias("t")))
    return (df.select(*by, F.explode(both).alias("x"))
            .groupBy(*by, F.col("x.c").alias("c"))
            .agg(F.sum("x.s").cast("bigint").alias("support"), F.sum("x.q").cast("bigint").alias("predicted"),
                 F.sum("x.t").cast("bigint").alias("tp")))


def _div(a: Column, b: Column) -> Column:
    """a / b, 0 when b is 0 (zero-division gives 0, as in the original metrics)."""
    return F.when(b == 0, F.lit(0.0)).otherwise(a.cast("double") / b)


def with_prf(ct: DataFrame) -> DataFrame:
    return ct.select("*",
                     _div(F.col("tp"), F.col("predicted")).alias("precision"),
                     _div(F.col("tp"), F.col("support")).alias("recall"),
                     _div(2 * F.col("tp"), F.col("support") + F.col("predicted")).alias("f1"))


def binary_metrics(df: DataFrame, gold: str = "gold", pred: str = "prediction", positive: int = 1) -> DataFrame:
    """N, accuracy, and precision / recall / F1 of the positive class."""
    ct = with_prf(class_table(df, gold, pred))
    pos = F.col("c") == F.lit(positive)
    return ct.agg(
        F.sum("support").alias("n"),
        _div(F.sum("tp"), F.sum("support")).alias("accuracy"),
        F.coalesce(F.max(F.when(pos, F.col("precision"))), F.lit(0.0)).alias("precision"),
        F.coalesce(F.max(F.when(pos, F.col("recall"))), F.lit(0.0)).alias("recall"),
        F.coalesce(F.max(F.when(pos, F.col("f1"))), F.lit(0.0)).alias("f1"))


def binary_metrics_by(df: DataFrame, by: str, gold: str = "gold", pred: str = "prediction",
                      positive: int = 1) -> DataFrame:
    """D8 per value of ``by`` (one aggregation for all groups)."""
    ct = with_prf(class_table(df, gold, pred, (by,)))
    pos = F.col("c") == F.lit(positive)
    return ct.groupBy(by).agg(
        F.sum("support").alias("n"),
        _div(F.sum("tp"), F.sum("support")).alias("accuracy"),
        F.coalesce(F.max(F.when(pos, F.col("f1"))), F.lit(0.0)).alias("f1"))


def weighted_metrics(df: DataFrame, gold: str = "gold", pred: str = "prediction") -> DataFrame:
    """Accuracy and support-weighted precision, recall, F1."""
    ct = with_prf(class_table(df, gold, pred))
    s = F.col("support")
    return ct.agg(
        F.sum("support").alias("n"),
        _div(F.sum("tp"), F.sum("support")).alias("accuracy"),
        _div(F.sum(s * F.col("precision")), F.sum(s)).alias("precision"),
        _div(F.sum(s * F.col("recall")), F.sum(s)).alias("recall"),
        _div(F.sum(s * F.col("f1")), F.sum(s)).alias("f1"))


def macro_f1(df: DataFrame, gold: str = "gold", pred: str = "prediction", by: tuple[str, ...] = ()) -> DataFrame:
    """Accuracy and the mean F1 over classes present in gold or predictions
    (the original names it "F1-weighted"; it is the macro mean)."""
    ct = with_prf(class_table(df, gold, pred, by))
    return ct.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_classes"),
        F.sum("support").alias("n"),
        _div(F.sum("tp"), F.sum("support")).alias("accuracy"),
        F.avg("f1").alias("macro_f1"))


def batch_mean_metrics(df: DataFrame, batch: str = "batch_id", gold: str = "gold", pred: str = "prediction",
                       by: tuple[str, ...] = ("epoch", "mode")) -> DataFrame:
    """Accuracy and macro F1 per batch, then their means over the batches of every (epoch, mode)."""
    per = macro_f1(df, gold, pred, by=(*by, batch))
    return per.groupBy(*by).agg(F.count(F.lit(1)).alias("n_batches"), F.avg("accuracy").alias("mean_accuracy"),
                                F.avg("macro_f1").alias("mean_macro_f1"))


SERIES = [("train", "loss"), ("train", "acc"), ("train", "f1"), ("eval", "loss"), ("eval", "acc"), ("eval", "f1")]


def log_series(log: DataFrame) -> DataFrame:
    """The metrics log pivoted into six series by epoch. The pivot values are
    fixed, so Spark needs no extra job to discover them."""
    names = [f"{m}_{k}" for m, k in SERIES]
    return (log.withColumn("_s", F.concat_ws("_", "mode", "metric"))
            .groupBy("epoch").pivot("_s", names).agg(F.first("value")))
