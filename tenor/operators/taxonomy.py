"""Taxonomy joins (C1-C3, C5): raw target names to groups.

The dimensions are fixed vocabularies (28, 11 and 64 rows), so they are
broadcast: the large side is never shuffled for these joins.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tenor import vocab


def _tax(df: DataFrame) -> DataFrame:
    return F.broadcast(vocab.taxonomy_df(df.sparkSession).withColumnRenamed("raw", "_raw_key"))


def map_taxonomy(df: DataFrame, raw_col: str = "raw", keep_id: bool = False) -> DataFrame:
    """Add ``target`` (the group) for the lower-cased raw name; unmapped rows are
    dropped here and reported by :func:`taxonomy_quarantine`."""
    base = df.drop("target") if "target" in df.columns else df
    out = (base.join(_tax(df), F.lower(F.col(raw_col)) == F.col("_raw_key"), "inner").drop("_raw_key"))
    return out if keep_id else out.drop("target_id")


def taxonomy_quarantine(df: DataFrame, raw_col: str = "raw") -> DataFrame:
    """Rows whose raw name has no group (the original raised KeyError)."""
    return df.join(_tax(df), F.lower(F.col(raw_col)) == F.col("_raw_key"), "left_anti")


def melt_indicators(wide: DataFrame, positions: list[int], name_of, id_cols: list[str]) -> DataFrame:
    """B9 core: one row per (row, indicator position) whose indicator is true."""
    cols = sorted(set(positions))
    melted = wide.select(
        *id_cols,
        F.explode(F.array(*[F.struct(F.lit(p).alias("col_pos"), F.col(name_of(p)).alias("flag")) for p in cols]))
        .alias("m"))
    return melted.where(F.col("m.flag")).select(*id_cols, F.col("m.col_pos").alias("col_pos"))


def indicator_melt_join(wide: DataFrame, columns: dict[str, list[int]], name_of,
                        id_cols: list[str]) -> DataFrame:
    """Indicator position -> group, one to many; a row true in several columns of a
    group is emitted once per column (deduplicated later, as in the original)."""
    spark = wide.sparkSession
    dim = spark.createDataFrame([(p, g) for g, ps in columns.items() for p in ps], "col_pos int, target string")
    positions = [p for ps in columns.values() for p in ps]
    return melt_indicators(wide, positions, name_of, id_cols).join(F.broadcast(dim), "col_pos")


def expected_combinations(files: DataFrame, tone_col: str = "tone", raw_col: str = "raw") -> DataFrame:
    """Every (tone, target) the prompt builder opens - each distinct target with
    each tone found, minus the excluded pair - flagged ``present`` when a file exists.

    Two aggregations: the distinct tones (one array, as wide as the tone vocabulary),
    and per target the set of tones present, expanded over the first by a one-row join."""
    per_raw = files.groupBy(F.col(raw_col).alias("raw")).agg(F.collect_set(F.col(tone_col)).alias("_tones"))
    found = files.where(F.col(tone_col).isNotNull()).agg(F.collect_set(F.col(tone_col)).alias("_found"))
    expected = (per_raw.withColumn("_one", F.lit(1)).join(F.broadcast(found.withColumn("_one", F.lit(1))), "_one")
                .select("raw", "_tones", F.explode("_found").alias("tone")))
    for tone, raw in vocab.EXCLUDED_PROMPT_PAIRS:
        expected = expected.where(~((F.col("tone") == tone) & (F.col("raw") == raw)))
    return expected.select("tone", "raw", F.array_contains("_tones", F.col("tone")).alias("present"))


def missing_combinations(files: DataFrame, tone_col: str = "tone", raw_col: str = "raw") -> DataFrame:
    """C5 report: expected combinations without a file (the original raised on open)."""
    return expected_combinations(files, tone_col, raw_col).where(~F.col("present")).drop("present")
