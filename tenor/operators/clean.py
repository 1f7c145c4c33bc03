"""Projections, filters and predicates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tenor import vocab
from tenor.functions.text import strip_text

PROMPT_NAME = r"^([^_]+)_(.+)_[^_]+$"
CORPUS_NAME = r"^([^_]+)_(.+)[.]csv$"
GROUP_ALIASES = {"other": "others"}


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def parse_name(name, kind: str = "prompt") -> Column:
    """B1: STRUCT(tone, raw) from a file name.

    prompt files ``{tone}_{raw}_{suffix}``: raw is every middle segment (may hold ``_``);
    corpus files ``{tone}_{group}.csv``: raw is everything up to the extension.
    """
    n = _c(name)
    if kind == "prompt":
        tone = F.element_at(F.split(n, "_"), 1)
        raw = F.regexp_extract(n, PROMPT_NAME, 2)
    elif kind == "corpus":
        tone = F.regexp_extract(n, CORPUS_NAME, 1)
        raw = F.regexp_extract(n, CORPUS_NAME, 2)
    else:
        raise ValueError(f"unknown name kind {kind!r}")
    return F.struct(tone.alias("tone"), raw.alias("raw"))


def clean_prompt(line, drop_blank: bool = False) -> Column:
    """B2: fragments of a prompt line: split at the two characters backslash-n, remove
    every ``-``, drop empty fragments, strip. Whitespace-only fragments survive as
    empty text unless ``drop_blank``."""
    frags = F.split(_c(line), r"\\n")
    frags = F.transform(frags, lambda f: F.regexp_replace(f, "-", ""))
    frags = F.filter(frags, lambda f: f != F.lit(""))
    frags = F.transform(frags, lambda f: strip_text(f))
    if drop_blank:
        frags = F.filter(frags, lambda f: f != F.lit(""))
    return frags


def drop_tone(df: DataFrame) -> DataFrame:
    """B3."""
    return df.drop("tone")


def drop_matching_columns(df: DataFrame, needle: str = ":") -> DataFrame:
    """Drop every column whose name contains ``needle`` (index columns of old CSVs)."""
    return df.select(*[F.col(f"`{c}`") for c in df.columns if needle not in c])


def encode_target_16(df: DataFrame, raw_col: str = "target") -> DataFrame:
    """16 prompt names -> id as text; names outside the table are kept as they are."""
    ids = F.broadcast(vocab.prompt_ids_df(df.sparkSession))
    out = df.join(ids, F.col(raw_col) == ids["raw"], "left")
    return out.select(*[c for c in df.columns if c != raw_col],
                      F.coalesce(F.col("raw_id").cast("string"), F.col(raw_col)).alias(raw_col))


def _alias_group(col: Column) -> Column:
    out = col
    for k, v in GROUP_ALIASES.items():
        out = F.when(col == k, F.lit(v)).otherwise(out)
    return out


def encode_target_11(df: DataFrame, name_col: str = "target") -> DataFrame:
    """Group name (alias ``other`` -> ``others``) -> ``target_id``; unknown names drop."""
    groups = F.broadcast(vocab.groups_df(df.sparkSession).withColumnRenamed("target", "_g"))
    return (df.withColumn("_n", _alias_group(F.col(name_col)))
            .join(groups, F.col("_n") == F.col("_g")).drop("_n", "_g"))


def decode_target_11(df: DataFrame, id_col: str = "target_id", out_col: str = "target") -> DataFrame:
    """B6 inverse: id -> group name."""
    names = vocab.groups_array()
    return df.withColumn(out_col, F.get(names, F.col(id_col)))


def tone_label(tone) -> Column:
    """Hate -> 1, neutral -> 0."""
    inv = {v: k for k, v in vocab.TONES.items()}
    t = _c(tone)
    return F.when(t == vocab.TONES[1], F.lit(inv[vocab.TONES[1]])).when(t == vocab.TONES[0], F.lit(inv[vocab.TONES[0]]))


def label_tone(label) -> Column:
    """B7 inverse: 1 -> hate, 0 -> neutral."""
    lab = _c(label)
    return F.when(lab == 1, F.lit(vocab.TONES[1])).when(lab == 0, F.lit(vocab.TONES[0]))


def score_threshold_split(df: DataFrame, score_col: str = "hate_speech_score", threshold: float = 0.5) -> DataFrame:
    """tone = hate iff score > threshold, neutral iff <= threshold; a null score lands in neither."""
    s = F.col(score_col)
    return (df.where(s.isNotNull())
            .withColumn("tone", F.when(s > F.lit(threshold), F.lit(vocab.TONES[1])).otherwise(F.lit(vocab.TONES[0]))))


def known_group_filter(df: DataFrame, file_col: str = "file_name") -> DataFrame:
    """Keep rows of ``.csv`` files whose group (after aliasing) is one of the 11;
    adds ``target`` and ``target_id``."""
    parsed = parse_name(F.col(file_col), "corpus")
    with_group = df.where(F.col(file_col).endswith(".csv")).withColumn("_grp", _alias_group(parsed["raw"]))
    groups = F.broadcast(vocab.groups_df(df.sparkSession).withColumnRenamed("target", "_g"))
    return (with_group.join(groups, F.col("_grp") == F.col("_g"), "inner")
            .withColumnRenamed("_grp", "target").drop("_g"))


def legacy_comma_field(line, index: int = 2) -> Column:
    """Field ``index`` of a plain comma split (no CSV quoting), stripped."""
    return strip_text(F.get(F.split(_c(line), ","), index))
