"""Multi-hot labels and class statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tenor import vocab
from tenor.operators import corpus

N_GROUPS = len(vocab.GROUPS)


def group_files(df: DataFrame) -> DataFrame:
    """The per-(tone, group) files: mapped rows, deduplicated per file, with target_id."""
    ids = F.broadcast(vocab.groups_df(df.sparkSession))
    return (corpus.distinct_rows(df.where(F.col("tone").isNotNull() & F.col("target").isNotNull()))
            .join(ids, "target"))


def multi_hot_join(df: DataFrame) -> DataFrame:
    """C4: every sentence of the pooled list (G4) joined to every group file holding it
    (either tone): (tone, text, file_tone, target).

    The join is an equi-join on the text in which both sides are already grouped
    by text, so it is computed as one aggregation: per text, the set of (tone,
    group) files holding it - at most 2 x 11 entries, bounded by the vocabulary -
    then each pooled tone of the text is paired with each of its files. One
    shuffle (partial aggregation first), no join on the long text."""
    files = df.where(F.col("tone").isNotNull() & F.col("target").isNotNull())
    per_text = files.groupBy(F.xxhash64("text").alias("_th"), "text").agg(
        F.collect_set(F.struct("tone", "target")).alias("_files"))
    tones = F.array_distinct(F.transform("_files", lambda f: f["tone"]))
    return (per_text.select("text", "_files", F.explode(tones).alias("tone"))
            .select("tone", "text", F.explode("_files").alias("_f"))
            .select("tone", "text", F.col("_f.tone").alias("file_tone"), F.col("_f.target").alias("target")))


def multi_hot(df: DataFrame) -> DataFrame:
    """One row per pooled (tone, text) with the 11-slot 0/1 vector of the groups
    whose files hold the text.

    One aggregation by text builds a bitmask (``bit_or``, a primitive buffer, partial
    aggregation before the shuffle) and the tones the text occurs in; the pooled rows
    are then re-expanded from it, so no join on the long text is needed. ``bit_or``
    and ``max`` ignore repeats, so the per-file dedup needs no shuffle of its own.
    """
    ids = F.broadcast(vocab.groups_df(df.sparkSession))
    files = df.where(F.col("tone").isNotNull() & F.col("target").isNotNull()).join(ids, "target")
    agg = files.groupBy(F.xxhash64("text").alias("_th"), "text").agg(
        F.bit_or(F.expr("shiftleft(1L, target_id)")).alias("_mask"),
        F.max((F.col("tone") == vocab.TONES[1]).cast("int")).alias("_in_hate"),
        F.max((F.col("tone") == vocab.TONES[0]).cast("int")).alias("_in_neutral"))
    tones = F.filter(F.array(F.when(F.col("_in_hate") == 1, F.lit(vocab.TONES[1])),
                             F.when(F.col("_in_neutral") == 1, F.lit(vocab.TONES[0]))),
                     lambda t: t.isNotNull())
    labels = F.transform(F.sequence(F.lit(0), F.lit(N_GROUPS - 1)),
                         lambda i: F.when(F.col("_mask").bitwiseAND(F.pow(F.lit(2), i).cast("bigint")) != 0, F.lit(1))
                         .otherwise(F.lit(0)))
    return agg.select(F.explode(tones).alias("tone"), "text", labels.alias("labels"))


def class_weights(df: DataFrame, class_col: str = "target_id", inverse: bool = False) -> DataFrame:
    """Relative frequency per class (rare classes weigh less, as in the original);
    ``inverse`` gives total / (k * count) instead. The global total is a window over
    the per-class table (one row per class)."""
    counts = df.groupBy(class_col).agg(F.count(F.lit(1)).alias("n"))
    total = F.sum("n").over(Window.partitionBy())
    k = F.count(F.lit(1)).over(Window.partitionBy())
    weight = (total / (k * F.col("n"))) if inverse else (F.col("n") / total)
    return counts.select(class_col, "n", weight.alias("weight"))


def sorted_class_counts(df: DataFrame, class_col: str = "target_id") -> DataFrame:
    """value counts ordered by class."""
    return df.groupBy(class_col).agg(F.count(F.lit(1)).alias("n")).orderBy(class_col)
