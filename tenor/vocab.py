"""Fixed vocabularies and dimension tables.

The lists and maps below are FIXED VALUES that must equal the ones of the
original project for results to agree; they are stated plainly, in their
natural order. Everything else in this module only turns them into small
DataFrames (a few dozen rows each), which are safe to broadcast.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# FIXED VALUES (must match the original project)
# ---------------------------------------------------------------------------

# The 11 target groups, in model output order.
GROUPS = ["women", "jews", "asian", "black", "lgbtq", "latino", "muslim", "indigenous", "arab",
          "disabilities", "others"]

# The 18 target names of the annotated-posts dataset, in index order.
ANNOTATION_TARGETS = ["African", "Arabs", "Asian", "Caucasian", "Hispanic", "Buddhism", "Christian", "Hindu",
                      "Islam", "Jewish", "Men", "Women", "Heterosexual", "Gay", "Indigenous",
                      "Refugee/Immigrant", "None", "Others"]

# Raw (lower-cased) target name -> group: the 28-key taxonomy.
TAXONOMY = {
    "none": "others",
    "african": "black",
    "asian": "asian",
    "caucasian": "others",
    "women": "women",
    "jewish": "jews",
    "islam": "muslim",
    "hispanic": "latino",
    "indigenous": "indigenous",
    "men": "others",
    "christian": "others",
    "heterosexual": "others",
    "hindu": "others",
    "buddhism": "others",
    "bisexual": "lgbtq",
    "chinese": "asian",
    "black": "black",
    "immigrant": "others",
    "lgbt": "lgbtq",
    "mental_disability": "others",
    "mexican": "others",
    "middle_east": "arab",
    "muslim": "muslim",
    "native_american": "indigenous",
    "physical_disability": "others",
    "trans": "lgbtq",
    "lgbtq": "lgbtq",
    "latino": "latino",
}

# Prompt target name -> numeric id (16 names).
PROMPT_TARGET_IDS = {"middle_east": 0, "latino": 1, "chinese": 2, "muslim": 3, "bisexual": 4, "mexican": 5,
                     "lgbtq": 6, "physical_disability": 7, "mental_disability": 8, "asian": 9, "women": 10,
                     "jewish": 11, "immigrant": 12, "native_american": 13, "black": 14, "trans": 15}

# Tone label <-> tone name.
TONES = {1: "hate", 0: "neutral"}

# Survey-table indicator columns (by position) feeding each group.
SURVEY_COLUMNS = {
    "women": [51],
    "jews": [35],
    "asian": [22],
    "black": [23],
    "lgbtq": [47, 48, 49, 50, 54, 55, 56],
    "latino": [24],
    "muslim": [37],
    "indigenous": [26, 27],
    "arab": [25],
    "disabilities": [67, 68, 69, 70, 71, 72, 73, 74],
    "others": [28, 29, 30, 31, 32, 33, 34, 36, 38, 39, 40, 41, 42, 43, 44, 45, 46, 52, 53, 57, 58, 59, 60, 61,
               62, 63, 65, 66],
}

# Labels counted as a toxic vote, and the number of votes that make a post toxic.
TOXIC_LABELS = ["hatespeech"]
TOXIC_MIN_VOTES = 2

# The (tone, target) prompt combination that does not exist.
EXCLUDED_PROMPT_PAIRS = [("neutral", "trans")]

# Router defaults: at most 3 groups, stop at cumulative 0.5, fall back below 0.2.
ROUTER_MAX_GROUPS = 3
ROUTER_THRESHOLD = 0.5
ROUTER_MIN_PROBA = 0.2
FALLBACK_GROUP = "others"

# Distillation defaults and the sweep's alpha values (temperature fixed at 0.7).
DISTILL_ALPHA = 0.25
DISTILL_TEMPERATURE = 2.0
SWEEP_ALPHAS = [0.1, 0.3, 0.5, 0.7, 0.9, 0.2, 0.4, 0.6, 0.8]
SWEEP_TEMPERATURE = 0.7
SWEEP_GROUP = "muslim"

# Split and sampling defaults. The split seed is the original's; sampling (balancing,
# the head test set) and batching get seeds of their own, so that the hash orders
# they use are independent of the split (one shared hash would put a balanced
# sample, its lowest hashes, entirely on one side of the split).
SPLIT_SEED = 38
SAMPLE_SEED = 1
BATCH_SEED = 2
TEST_FRACTION = 0.2
HEAD_TEST_ROWS = 1000

# ---------------------------------------------------------------------------
# Dimension DataFrames
# ---------------------------------------------------------------------------


def groups_df(spark: SparkSession) -> DataFrame:
    """(target STRING, target_id INT) for the 11 groups."""
    return spark.createDataFrame([(g, i) for i, g in enumerate(GROUPS)],
                                 "target string, target_id int")


def taxonomy_df(spark: SparkSession) -> DataFrame:
    """(raw STRING, target STRING, target_id INT): the 28-key taxonomy."""
    rows = [(raw, grp, GROUPS.index(grp)) for raw, grp in TAXONOMY.items()]
    return spark.createDataFrame(rows, "raw string, target string, target_id int")


def annotation_targets_df(spark: SparkSession) -> DataFrame:
    """(ann_idx INT, ann_target STRING) for the 18 annotation target names."""
    return spark.createDataFrame(list(enumerate(ANNOTATION_TARGETS)), "ann_idx int, ann_target string")


def prompt_ids_df(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(PROMPT_TARGET_IDS.items()), "raw string, raw_id int")


def survey_columns_df(spark: SparkSession) -> DataFrame:
    """(col_pos INT, target STRING): one row per (indicator position, group)."""
    rows = [(pos, grp) for grp, cols in SURVEY_COLUMNS.items() for pos in cols]
    return spark.createDataFrame(rows, "col_pos int, target string")


def groups_array() -> F.Column:
    """The 11 group names as a literal array column (model output order)."""
    return F.array(*[F.lit(g) for g in GROUPS])


def sql_values(rows, cols) -> str:
    """A DuckDB ``(VALUES ...) t(cols)`` fragment for a small fixed table."""
    def lit(v):
        if isinstance(v, str):
            return "'" + v.replace("'", "''") + "'"
        return repr(v)
    body = ", ".join("(" + ", ".join(lit(v) for v in r) + ")" for r in rows)
    return f"(VALUES {body}) AS t({', '.join(cols)})"

