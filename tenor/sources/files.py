"""File sources and sinks (A1-A10) in the layouts the original project used.

Readers always pass an explicit schema (never inferred) and read splittable
layouts: prompt and sentence files line by line, CSV with RFC-4180 quoting
(``multiLine`` only where a field may hold newlines), annotated posts as
JSON lines of one keyed object each. The single-object JSON layout of the
original is split too, by a scan of string and depth states (``keyed_json``).
"""

from __future__ import annotations

import os

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tenor.operators import clean
from tenor.functions.text import strip_text
from tenor.session import scratch_path
from tenor.sources import keyed_json

ANNOTATOR = T.StructType([T.StructField("label", T.StringType()),
                          T.StructField("target", T.ArrayType(T.StringType()))])
POST = T.StructType([T.StructField("annotators", T.ArrayType(ANNOTATOR)),
                     T.StructField("post_tokens", T.ArrayType(T.StringType()))])
POSTS_MAP = T.MapType(T.StringType(), POST)

LABELED_CSV = T.StructType([T.StructField("tone", T.StringType()), T.StructField("target", T.StringType()),
                            T.StructField("text", T.StringType())])
TESTSET_CSV = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("label", T.IntegerType()),
                            T.StructField("text", T.StringType())])
LOG_CSV = T.StructType([T.StructField("epoch", T.IntegerType()), T.StructField("mode", T.StringType()),
                        T.StructField("metric", T.StringType()), T.StructField("value", T.DoubleType())])
SENTENCE_CSV = T.StructType([T.StructField("text", T.StringType())])
PROBABILITIES = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("score", T.DoubleType()),
                              T.StructField("prediction", T.IntegerType())])

# RFC-4180 quoting, whitespace kept: texts hold commas, quotes and newlines.
CSV_OPTS = {"quote": '"', "escape": '"', "ignoreLeadingWhiteSpace": "false",
            "ignoreTrailingWhiteSpace": "false", "lineSep": "\n"}


def _text_reader(spark: SparkSession, sep: str = "\n"):
    return spark.read.option("lineSep", sep).option("recursiveFileLookup", "true")


# --------------------------------------------------------------------------- A1 prompts


def write_prompts(df: DataFrame, path: str, name_col: str = "file_name", text_col: str = "text") -> None:
    """One folder per prompt file name (``{tone}_{raw}_1k.txt``), lines inside."""
    df.select(name_col, text_col).write.mode("overwrite").partitionBy(name_col).text(path)


def prompt_source_name(path_col) -> F.Column:
    """The prompt file name of a line: the file's own name when it follows the
    ``{tone}_{raw}_{suffix}.txt`` pattern, else its folder's (``key=`` stripped)."""
    own = F.regexp_extract(path_col, r"([^/]+)$", 1)
    folder = F.regexp_extract(path_col, r"([^/=]+)/[^/]+$", 1)
    return F.when(own.rlike(r"^[^_]+_.+_[^_]+[.]txt$"), own).otherwise(folder)


def read_prompts(spark: SparkSession, path: str, drop_blank: bool = False) -> DataFrame:
    """A1: (tone, target, text) of every cleaned fragment of every prompt line; tone and
    raw target come from the file name."""
    lines = _text_reader(spark).text(path).select(
        "value", prompt_source_name(F.col("_metadata.file_path")).alias("file_name"))
    parsed = clean.parse_name(F.col("file_name"), "prompt")
    return lines.select(parsed["tone"].alias("tone"), parsed["raw"].alias("target"),
                        F.explode(clean.clean_prompt("value", drop_blank)).alias("text"))


# --------------------------------------------------------------------------- A2 delimited records


def read_delimited(spark: SparkSession, path: str, sep: str = "\n-") -> DataFrame:
    """A2: records separated by ``sep`` (a multi-character line separator), stripped,
    empty ones dropped."""
    recs = _text_reader(spark, sep).text(path).select(strip_text("value").alias("text"))
    return recs.where(F.col("text") != "")


# --------------------------------------------------------------------------- A3 annotated posts


def write_annotations(posts: DataFrame, path: str) -> None:
    """JSON lines, each ``{"<post_id>": {"annotators": [...], "post_tokens": [...]}}``."""
    obj = F.to_json(F.create_map(F.col("post_id").cast("string"),
                                 F.struct("annotators", "post_tokens")))
    posts.select(obj.alias("value")).write.mode("overwrite").text(path)


def write_annotations_object(posts: DataFrame, path: str) -> None:
    """The original layout: one object keyed by post id. Every task writes a file of its own."""
    def run(batches):
        first = True
        for batch in batches:
            values = batch.column(0).to_pylist()
            if values:
                yield pa.RecordBatch.from_pydict({"value": [("{" if first else ",") + v[1:-1] if i == 0 else "," + v[1:-1]
                                                           for i, v in enumerate(values)]})
                first = False
        if not first:
            yield pa.RecordBatch.from_pydict({"value": ["}"]})

    obj = F.to_json(F.create_map(F.col("post_id").cast("string"), F.struct("annotators", "post_tokens")))
    posts.select(obj.alias("value")).mapInArrow(run, "value string").write.mode("overwrite").text(path)


def read_annotations(spark: SparkSession, path: str, layout: str = "lines") -> DataFrame:
    """A3: (post_id, annotators, post_tokens), one row per post.

    ``layout="lines"``: one keyed object per line. ``layout="object"``: the original single object keyed by
    post id per file, read in splits as well (``keyed_json``).
    """
    if layout == "lines":
        raw = _text_reader(spark).text(path)
    elif layout == "object":
        raw = keyed_json.read_records(spark, path)
    else:
        raise ValueError(f"unknown layout {layout!r}")
    m = raw.select(F.explode(F.from_json("value", POSTS_MAP)).alias("post_id", "post"))
    return m.select(F.col("post_id").cast("bigint").alias("post_id"),
                    F.col("post.annotators").alias("annotators"), F.col("post.post_tokens").alias("post_tokens"))


# --------------------------------------------------------------------------- A4, A6, A9, A10 CSV


def write_csv(df: DataFrame, path: str, header: bool) -> None:
    df.write.mode("overwrite").options(**CSV_OPTS).option("header", str(header).lower()).csv(path)


def read_csv(spark: SparkSession, path: str, schema: T.StructType, header: bool, multiline: bool = True) -> DataFrame:
    return (spark.read.schema(schema).options(**CSV_OPTS).option("header", str(header).lower())
            .option("multiLine", str(multiline).lower()).option("mode", "FAILFAST").csv(path))


def read_labeled_csv(spark: SparkSession, path: str, legacy_comma: bool = False) -> DataFrame:
    """A4: ``tone,target,text`` table with a header.

    ``legacy_comma=True`` reproduces the original line reader (Q4): every physical
    line after the header is split on every comma (no quoting), tone is field 0,
    target field 1 lower-cased, text field 2 stripped - so a text is cut at its
    first comma and a quoted text keeps its quote."""
    if not legacy_comma:
        return read_csv(spark, path, LABELED_CSV, header=True)
    fields = F.split(F.col("value"), ",")
    # one column per physical line; the reader drops the first line of each file and no other
    body = (spark.read.schema("value string").option("header", "true").option("sep", "\x01").option("quote", "")
            .option("lineSep", "\n").option("recursiveFileLookup", "true").csv(path))
    return body.select(F.get(fields, 0).alias("tone"), F.lower(F.get(fields, 1)).alias("target"),
                       clean.legacy_comma_field(F.col("value"), 2).alias("text"))


def write_corpus_csv(df: DataFrame, path: str) -> None:
    """A4: one header-less single-column file set per (tone, target), in a folder named ``{tone}_{target}.csv``."""
    name = F.concat_ws("_", "tone", "target")
    (df.select(F.concat(name, F.lit(".csv")).alias("file_name"), "text").write.mode("overwrite").partitionBy("file_name")
     .options(**CSV_OPTS).option("header", "false").option("emptyValue", '""').csv(path))


def corpus_source_name(path_col) -> F.Column:
    """The corpus file name of a row: the file's own name when it follows ``{tone}_{group}.csv``, else its
    folder's (``key=`` stripped)."""
    own = F.url_decode(F.regexp_extract(path_col, r"([^/]+)$", 1))
    folder = F.url_decode(F.regexp_extract(path_col, r"([^/=]+)/[^/]+$", 1))
    return F.when(own.rlike(r"^[^_]+_.+[.]csv$") & ~own.startswith("part-"), own).otherwise(folder)


def read_corpus_csv(spark: SparkSession, path: str) -> DataFrame:
    """A4: header-less single-column files of a folder, (tone, target, text): tone and group come from the
    file name ``{tone}_{group}.csv``; texts are literal (``NA``, quotes, commas and line ends included)."""
    rows = (spark.read.schema(SENTENCE_CSV).options(**CSV_OPTS).option("header", "false").option("multiLine", "true")
            .option("mode", "FAILFAST").option("emptyValue", "").option("nullValue", "\x00").option("recursiveFileLookup", "true").csv(path))
    parsed = clean.parse_name(F.col("_name"), "corpus")
    named = rows.select("text", corpus_source_name(F.col("_metadata.file_path")).alias("_name"))
    return named.select(parsed["tone"].alias("tone"), parsed["raw"].alias("target"), "text")


def read_testset(spark: SparkSession, path: str) -> DataFrame:
    """``(doc_id, label, text)`` without header; the key travels with the row, so
    labels stay aligned even when a text holds newlines."""
    return read_csv(spark, path, TESTSET_CSV, header=False)


def write_metrics_log(log: DataFrame, path: str) -> None:
    """``epoch,mode,metric,value`` rows, no header."""
    write_csv(log.select("epoch", "mode", "metric", "value"), path, header=False)


def read_metrics_log(spark: SparkSession, path: str) -> DataFrame:
    """A9."""
    return read_csv(spark, path, LOG_CSV, header=False, multiline=False)


def read_scoring_input(spark: SparkSession, path: str) -> DataFrame:
    """A10: sentences to score by extension: ``.txt`` one stripped line each, ``.csv``
    the first column of each record; any other extension is an error."""
    ext = os.path.splitext(path.rstrip("/"))[1].lower()
    if ext == ".txt":
        return _text_reader(spark).text(path).select(strip_text("value").alias("text"))
    if ext == ".csv":
        return read_csv(spark, path, SENTENCE_CSV, header=False).select("text")
    raise ValueError(f"unsupported scoring input extension {ext!r} (expected .txt or .csv)")


# --------------------------------------------------------------------------- A5, A7, A8 parquet / JSON


FOLDER_ROWS = 1_000_000


def write_corpus(df: DataFrame, path: str) -> None:
    """Corpus partitioned by tone and group (one folder per original file). Rows are
    dealt by folder and a salt, a salt for every ``FOLDER_ROWS`` rows of the largest
    folder (counted), so a task writes few folders and a hot folder many files."""
    largest = df.groupBy("tone", "target").count().agg(F.max("count")).first()[0] or 0
    salt = F.pmod(F.xxhash64(*[c for c in df.columns if c not in ("tone", "target")]), F.lit(1 + largest // FOLDER_ROWS))
    dealt = df.withColumn("_salt", salt).repartition("tone", "target", "_salt").drop("_salt")
    dealt.write.mode("overwrite").partitionBy("tone", "target").parquet(path)


def append_corpus(df: DataFrame, path: str, batch: int) -> None:
    """A7, growing: add the (tone, target, text) rows that the corpus under ``path`` does not hold yet, as batch number ``batch``.

    Next to the texts lies an index of their 128-bit hashes, by the same folders. New rows are made distinct, and those
    found in the index of other batches are left out by an anti-join that reads hashes of the touched
    folders only, never the texts there. Both tables are written by dynamic partition overwrite of this batch's folders: other
    folders keep their files, and a batch that is run again replaces itself. The corpus is the same set for any order of batches."""
    spark = df.sparkSession
    keys = ["tone", "target", "h1", "h2"]
    rows = (df.select("tone", "target", "text", F.xxhash64("text").alias("h1"), F.xxhash64(F.lit(1), "text").alias("h2"))
            .groupBy(*keys).agg(F.min("text").alias("text")))
    try:
        index = spark.read.schema(CORPUS_INDEX).parquet(f"{path}/index").where(F.col("batch") != batch)
    except AnalysisException:  # the first batch
        index = None
    if index is not None:
        touched = df.select("tone", "target").distinct()  # at most the folders there are
        known = index.join(F.broadcast(touched), ["tone", "target"], "left_semi").select(*keys)
        rows = rows.join(known, keys, "left_anti")
    fresh = scratch_path(spark, "fresh")
    rows.write.parquet(fresh)
    rows = spark.read.schema(rows.schema).parquet(fresh).withColumn("batch", F.lit(batch))
    for name, columns in (("data", ["text"]), ("index", ["h1", "h2"])):
        (rows.select(*columns, "tone", "target", "batch").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("tone", "target", "batch").parquet(f"{path}/{name}"))


CORPUS_INDEX = "h1 long, h2 long, tone string, target string, batch int"


def read_grown_corpus(spark: SparkSession, path: str) -> DataFrame:
    """(tone, target, text) of all batches of :func:`append_corpus`."""
    return spark.read.schema("text string, tone string, target string, batch int").parquet(f"{path}/data").select("tone", "target", "text")


def read_corpus(spark: SparkSession, path: str, tone: str | None = None, target: str | None = None) -> DataFrame:
    """Read back; filters on tone / target prune partition folders."""
    df = spark.read.parquet(path)
    if tone is not None:
        df = df.where(F.col("tone") == tone)
    if target is not None:
        df = df.where(F.col("target") == target)
    return df


def write_probabilities(df: DataFrame, path: str) -> None:
    """Scores as JSON lines keyed by document (not one array)."""
    df.select("vec_id", "score", "prediction").write.mode("overwrite").json(path)


def read_probabilities(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(PROBABILITIES).json(path)


def write_probabilities_document(df: DataFrame, path: str, order: tuple[str, ...] = ("vec_id",)) -> None:
    """A8, original layout: one JSON array with an object per row, in the order of ``order`` (ties in any order; an empty table is ``[]``).

    The array is written by many tasks: its part files, put together by part number, are the document. An
    element is a line, and only the first lacks the comma before it; which one that is, is known from the places that the sorted
    rows are stored with. Spark's commit protocol covers the parts: a failed task or job leaves no element behind, and ``_SUCCESS``
    says that the document is complete."""
    spark = df.sparkSession
    own = df.columns
    value = F.to_json(F.struct(*[F.col(c) for c in own]), {"ignoreNullFields": "false"}).alias("value")
    place = scratch_path(spark, "elements")
    ordered = df.orderBy(*order).select(value).withColumn("at", F.monotonically_increasing_id())
    ordered.write.parquet(place)
    rows = spark.read.schema("value string, at long").parquet(place)
    first = rows.agg(F.min("at")).first()[0]
    body = rows.select("at", F.concat(F.when(F.col("at") == first, "").otherwise(","), "value").alias("value")) if first is not None else rows
    marks = spark.createDataFrame([(-1, "["), ((1 << 63) - 1, "]")], "at long, value string")
    body.unionByName(marks).orderBy("at").select("value").write.mode("overwrite").text(path)


def read_probabilities_document(spark: SparkSession, path: str, schema: T.StructType | str = PROBABILITIES) -> DataFrame:
    """The elements of :func:`write_probabilities_document`, every line parsed on its own."""
    lines = _text_reader(spark).text(path).where(~F.col("value").isin("[", "]"))
    element = F.from_json(F.regexp_replace("value", "^,", ""), schema, {"mode": "FAILFAST"})
    return lines.select(element.alias("e")).select("e.*")


def read_indicator_table(spark: SparkSession, path: str) -> DataFrame:
    """A5: the wide survey table (text, score, boolean indicators)."""
    return spark.read.parquet(path)
