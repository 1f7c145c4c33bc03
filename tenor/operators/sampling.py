"""Hash-keyed sampling, splitting and batching.

Order is defined by ``h = md5('{seed}:{key}')`` (32 bits) then the key, so
results do not depend on partitioning, retries or run.

Exact ranks without a per-class window: the top ``bits`` of ``h`` cut every
class into up to ``2**bits`` buckets. Rows are counted per (class, bucket) -
a small table of at most ``n_classes * 2**bits`` rows, counted before it is
broadcast - whose running totals give each bucket's offset. A row's rank is
its bucket offset plus its position inside the bucket, so the only window
runs over one bucket (about ``1/2**bits`` of a class), never a whole class.
Selections of the first ``n`` rows rank only the single bucket that holds
the cut; rows of lower buckets are kept without any window.

Keys are expected to be unique per row (doc_id, vec_id, or a text key after
dedup): copies of one key share its hash and so its bucket. Deduplicate copies
first (E1 / G2), or rank on a key made unique with a content column.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tenor import vocab
from tenor.functions.text import seeded_hash
from tenor.session import shared_dir

DEFAULT_BITS = 12   # first cut; refined while a bucket holds more than BUCKET_ROWS rows
BUCKET_ROWS = 50_000
HASH_BITS = 32


def with_hash(df: DataFrame, key: str, seed: int = vocab.SPLIT_SEED, out: str = "_h") -> DataFrame:
    return df.withColumn(out, seeded_hash(F.col(key), seed))


def _bucket(h: str, bits: int):
    return F.shiftright(F.col(h), 32 - bits).cast("int")


def bucket_offsets(df: DataFrame, class_cols: list[str], h: str, bits: int) -> DataFrame:
    """(class..., _b, _cnt, _off, _total): per-bucket counts, offsets and class totals."""
    counts = df.groupBy(*class_cols, _bucket(h, bits).alias("_b")).agg(F.count(F.lit(1)).alias("_cnt"))
    w = Window.partitionBy(*class_cols) if class_cols else Window.partitionBy()
    running = w.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    return counts.select(*class_cols, "_b", "_cnt",
                         F.coalesce(F.sum("_cnt").over(running), F.lit(0)).alias("_off"),
                         F.sum("_cnt").over(w).alias("_total"))


def prepare(df: DataFrame, class_cols: list[str], key: str, seed: int, bits: int):
    """(hashed rows with ``_h``/``_b``, per-(class, bucket) offsets table). The offsets
    table also gives every class size, so no other pass over the rows is needed.

    The offsets table is checkpointed to the shared folder: one counting pass over the
    rows, and every later use - class sizes, cut buckets, the offsets join - reads the
    small stored table (and lineage is cut there). When its largest bucket holds more than
    ``BUCKET_ROWS`` rows the hash is cut finer and counted again, so the rows ordered
    together stay bounded at any class size. Joins to the table are Spark's choice by bytes."""
    shared_dir(df.sparkSession)
    while True:
        hashed = with_hash(df, key, seed).withColumn("_b", _bucket("_h", bits))
        offs = bucket_offsets(hashed, class_cols, "_h", bits).checkpoint(eager=True)
        largest = offs.agg(F.max("_cnt")).first()[0] or 0
        if largest <= BUCKET_ROWS or bits >= HASH_BITS:
            return hashed, offs
        bits = min(HASH_BITS, bits + max(1, (largest // BUCKET_ROWS).bit_length()))


def exact_rank(df: DataFrame, class_cols: list[str], key: str, seed: int = vocab.SPLIT_SEED,
               bits: int = DEFAULT_BITS, out: str = "rank",
               prepared=None) -> DataFrame:
    """0-based rank of every row within its class, ordered by (h, key); adds ``out``
    and ``_total`` (class size)."""
    hashed, offs = prepared or prepare(df, class_cols, key, seed, bits)
    joined = hashed.join(offs.drop("_cnt"), [*class_cols, "_b"])
    w = Window.partitionBy(*class_cols, "_b").orderBy("_h", key)
    return (joined.withColumn(out, (F.col("_off") + F.row_number().over(w) - 1).cast("bigint"))
            .drop("_h", "_b", "_off"))


def select_first(df: DataFrame, class_cols: list[str], key: str, n_keep: DataFrame, seed: int = vocab.SPLIT_SEED,
                 bits: int = DEFAULT_BITS, prepared=None) -> DataFrame:
    """Keep the first ``n`` rows of every class by (h, key). ``n_keep`` is a small
    (class..., n) table; classes missing from it keep nothing. Rows of buckets wholly
    below the cut are kept without a window; only the bucket holding the cut is ranked."""
    hashed, offs = prepared or prepare(df, class_cols, key, seed, bits)
    offs = offs.join(n_keep, class_cols)
    offs = offs.where(F.col("_off") < F.col("n")).select(
        *class_cols, "_b", "_off", "n", (F.col("_off") + F.col("_cnt") <= F.col("n")).alias("_whole"))
    joined = hashed.join(offs, [*class_cols, "_b"])
    whole = joined.where(F.col("_whole"))
    w = Window.partitionBy(*class_cols, "_b").orderBy("_h", key)
    cut = (joined.where(~F.col("_whole"))
           .withColumn("_r", F.col("_off") + F.row_number().over(w) - 1)
           .where(F.col("_r") < F.col("n")).drop("_r"))
    return whole.unionByName(cut).drop("_h", "_b", "_off", "n", "_whole")


def class_sizes(offs: DataFrame, class_cols: list[str]) -> DataFrame:
    """(class..., _n) from an offsets table (small-table work only)."""
    return offs.select(*class_cols, F.col("_total").alias("_n")).distinct()


def balanced_downsample(df: DataFrame, group_col: str = "target", tone_col: str = "tone", key: str = "doc_id",
                        seed: int = vocab.SAMPLE_SEED, bits: int = DEFAULT_BITS) -> DataFrame:
    """E5: within every group, both tones cut to the size of the smaller one; a group
    with an empty tone keeps everything (balancing off). Two passes over the rows:
    bucket counts, then the selection."""
    cls = [group_col, tone_col]
    prepared = prepare(df, cls, key, seed, bits)
    sizes = class_sizes(prepared[1], cls)
    per_group = sizes.groupBy(group_col).agg(
        F.min(F.when(F.col(tone_col) == vocab.TONES[1], F.col("_n"))).alias("_nh"),
        F.min(F.when(F.col(tone_col) == vocab.TONES[0], F.col("_n"))).alias("_nn"))
    n_keep = (sizes.join(per_group, group_col)
              .select(group_col, tone_col,
                      F.when(F.col("_nh").isNotNull() & F.col("_nn").isNotNull(), F.least("_nh", "_nn"))
                      .otherwise(F.col("_n")).alias("n")))
    return select_first(df, cls, key, n_keep, seed, bits, prepared=prepared)


def mixed_batches(df: DataFrame, batch_size: int = 16, group_col: str = "target", tone_col: str = "tone",
                  key: str = "doc_id", seed: int = vocab.SAMPLE_SEED, bits: int = DEFAULT_BITS) -> DataFrame:
    """Batch i of a group holds the i-th slice of ``batch_size`` rows of each tone;
    rows past the shorter tone are dropped (those batches are empty)."""
    cls = [group_col, tone_col]
    prepared = prepare(df, cls, key, seed, bits)
    ranked = exact_rank(df, cls, key, seed, bits, prepared=prepared)
    # the other tone's size for the same group, from the small offsets table
    other = class_sizes(prepared[1], cls).select(F.col(group_col).alias("_og"), F.col(tone_col).alias("_ot"),
                                                 F.col("_n").alias("_other"))
    paired = ranked.join(other,
                         (F.col(group_col) == F.col("_og")) & (F.col(tone_col) != F.col("_ot")))
    return (paired.where(F.col("rank") < F.col("_other"))
            .withColumn("batch_id", (F.col("rank") / F.lit(batch_size)).cast("bigint"))
            .drop("_total", "_other", "_ot", "_og"))


def assign_batches(df: DataFrame, batch_size: int = 16, key: str = "doc_id", seed: int = vocab.BATCH_SEED,
                   bits: int = DEFAULT_BITS) -> DataFrame:
    """Shuffled fixed-size batches: ``batch_id = rank(h, key) div batch_size``."""
    ranked = exact_rank(df, [], key, seed, bits)
    return (ranked.withColumn("batch_id", F.floor(F.col("rank") / F.lit(batch_size)).cast("bigint"))
            .drop("_total"))


def sample_n(df: DataFrame, n: int = vocab.HEAD_TEST_ROWS, key: str = "doc_id", seed: int = vocab.SAMPLE_SEED) -> DataFrame:
    """exactly ``n`` rows (all if fewer), the lowest (h, key), by the exact selection:
    only the bucket that holds the cut is ordered."""
    one = df.withColumn("_all", F.lit(0))
    keep = df.sparkSession.range(1).select(F.lit(0).alias("_all"), F.lit(n).cast("bigint").alias("n"))
    return select_first(one, ["_all"], key, keep, seed).drop("_all")


def train_test_split(df: DataFrame, test_fraction: float = vocab.TEST_FRACTION, key: str = "doc_id",
                     seed: int = vocab.SPLIT_SEED, exact: bool = False) -> DataFrame:
    """``split`` = test when h < fraction * 2^32, else train. Row-local: no shuffle."""
    if exact:
        return exact_split(df, test_fraction, key, seed)
    cut = int(test_fraction * (1 << 32))
    return (with_hash(df, key, seed)
            .withColumn("split", F.when(F.col("_h") < F.lit(cut), F.lit("test")).otherwise(F.lit("train")))
            .drop("_h"))


def exact_split(df: DataFrame, test_fraction: float = vocab.TEST_FRACTION, key: str = "doc_id",
                seed: int = vocab.SPLIT_SEED, bits: int = DEFAULT_BITS) -> DataFrame:
    """F3 ``exact=True``: exactly ceil(fraction x n) rows (as the original split sizes its
    test part) are ``test`` - the lowest (h, key) - the rest ``train``. Uses the
    exact selection (two passes, only the cut bucket ranked)."""
    one = df.withColumn("_all", F.lit(0))
    prepared = prepare(one, ["_all"], key, seed, bits)
    n_test = class_sizes(prepared[1], ["_all"]).select(
        "_all", F.ceil(F.col("_n") * F.lit(float(test_fraction))).cast("bigint").alias("n"))
    test = select_first(one, ["_all"], key, n_test, seed, bits, prepared=prepared).select(key).withColumn(
        "_t", F.lit(True))
    return (one.join(test, key, "left")
            .withColumn("split", F.when(F.col("_t"), F.lit("test")).otherwise(F.lit("train")))
            .drop("_all", "_t"))


def head_split(df: DataFrame, n: int = vocab.HEAD_TEST_ROWS, key: str = "doc_id", seed: int = vocab.SAMPLE_SEED,
               disjoint: bool = False) -> tuple[DataFrame, DataFrame]:
    """The router's (train, test): test = :func:`sample_n` rows drawn from the table;
    train = the whole table, test rows included, as in the original (Q25), or
    without them when ``disjoint``."""
    test = sample_n(df, n, key, seed)
    train = df.join(test.select(key), key, "left_anti") if disjoint else df
    return train, test
