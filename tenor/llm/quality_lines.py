"""Quality rules with cross-document line frequency (DataFrame functions only).

Base rules are row-local. The method's verdict: lines are normalised
(lower-cased, digit runs as ``0``, white space collapsed) and hashed; for every
host (``source``) the distinct documents holding a line are counted; a line
above the host's limit (MIN_LINE_DOCS and the square root of the host's documents) is removed, and a document left with too small a share
of its line words is *depleted* and rejected. ``clean_text`` is the text without its
removed lines: every copy of them goes, all other lines stay as they are and in order.

Distinct documents of a host are distinct texts: exact copies count once, so a
copied document does not make its own lines frequent. Everything after the
explode is keyed by (host, text hash), so copies are aggregated before any
shuffle and expanded only in the last join, where AQE may split a hot key.

Null text: no words and no lines (fails the base rules). Null source: its own
host. Rows that repeat get one result row each.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tenor.llm.blocks import shielded, unshielded

SPACE = r"[\x20\x09-\x0D]"
MIN_WORDS = 50
REPEAT_PERCENT = 50
MIN_LINE_DOCS = 5         # a line must be in more documents of the host than this, and in more than the root of their number
LEFT_PERCENT = 30         # depleted below this share of line words left


def words(text: Column) -> Column:
    return F.array_remove(F.split(text, SPACE + "+"), "")


def _let(value: Column, body) -> Column:
    """``body`` of ``value`` computed once: as a lambda variable it stays so when the
    optimiser moves the expression (a filter on a result pushes whole expressions down)."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def repeat_words(text: Column) -> Column:
    """Positions inside a 3-word window that occurs twice or more. Window hashes are sorted
    with their positions, so equal windows are neighbours; texts without a repeat stop before."""
    def windows(w):
        return F.transform(F.sequence(F.lit(1), F.size(w) - 2),
                           lambda i: F.xxhash64(F.element_at(w, i), F.element_at(w, i + 1), F.element_at(w, i + 2)))

    def repeated(s):
        same = lambda x, j: F.coalesce(F.get(s, j)["h"] == x["h"], F.lit(False))
        return F.transform(F.filter(s, lambda x, i: same(x, i + 1) | same(x, F.when(i > 0, i - 1).otherwise(F.size(s)))),
                           lambda x: x["p"])

    def covered(d):
        return F.size(F.array_distinct(F.concat(d, F.transform(d, lambda p: p + 1), F.transform(d, lambda p: p + 2))))

    def count(h):
        placed = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("p"))))
        return F.when(F.size(F.array_distinct(h)) == F.size(h), 0).otherwise(
            _let(placed, lambda s: _let(repeated(s), covered)))

    return _let(words(text), lambda w: F.when(F.size(w) >= 3, _let(windows(w), count)).otherwise(0)).cast("long")


def base_rules(docs: DataFrame, text: str = "text") -> DataFrame:
    """Row-local counts and ``base_failed``; keeps the input's columns."""
    t = F.coalesce(F.col(text), F.lit(""))
    has_word = lambda line: F.rlike(line, F.lit(r"[^\x20\x09-\x0D]"))
    df = (docs.withColumn("_w", words(t))
          .withColumn("_l", F.filter(F.split(t, "\n"), has_word))
          .withColumn("n_words", F.size("_w").cast("long"))
          .withColumn("n_repeat_words", repeat_words(t)))
    return (df.withColumn("word_chars", F.length(F.array_join("_w", "")).cast("long"))
            .withColumn("n_symbols", F.regexp_count(t, F.lit("[#*$%&|<>]")).cast("long"))
            .withColumn("n_dup_lines", (F.size("_l") - F.size(F.array_distinct("_l"))).cast("long"))
            .withColumn("base_failed", (F.col("n_words") < MIN_WORDS)
                        | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words")))
            .drop("_w"))


OUTPUT = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "line_words", "removed_words",
          "base_failed", "kept")


def normalise(line: Column) -> Column:
    line = F.regexp_replace(F.lower(line), "[0-9]+", "0")
    return F.trim(F.regexp_replace(line, SPACE + "+", " "))


def quality_rules(docs: DataFrame, text: str = "text", host: str = "source", min_docs: int = MIN_LINE_DOCS,
                  left_percent: int = LEFT_PERCENT) -> DataFrame:
    """The input's columns plus the base counts, ``line_words`` (words of the distinct
    lines), ``removed_words`` (those in removed lines), ``base_failed``, ``kept`` and
    ``clean_text`` (null for a null text). Columns may have any name; one named like a result is replaced."""
    docs, names = shielded(docs)
    text, host = names[text], names[host]
    t = F.coalesce(F.col(text), F.lit(""))
    rows = base_rules(docs, text)
    rows = (rows.withColumn("_n", F.array_distinct(F.transform("_l", normalise)))
            .withColumn("_host", F.coalesce(F.col(host), F.lit("\x00")))
            .withColumn("_doc", F.xxhash64(t, F.length(t))))
    line_words = lambda line: F.size(F.split(line, " "))
    lines = (docs.select(F.coalesce(F.col(host), F.lit("\x00")).alias("_host"),
                         F.xxhash64(t, F.length(t)).alias("_doc"), F.explode(F.split(t, "\n")).alias("_line"))
             .select("_host", "_doc", normalise(F.col("_line")).alias("_line"))
             .where(F.col("_line") != "")
             .select("_host", "_doc", F.xxhash64("_line").alias("_hash"), line_words(F.col("_line")).alias("_words")))
    unique = lines.groupBy("_host", "_doc", "_hash").agg(F.max("_words").alias("_words"))
    sizes = (docs.select(F.coalesce(F.col(host), F.lit("\x00")).alias("_host"), F.xxhash64(t, F.length(t)).alias("_doc"))
             .distinct().groupBy("_host").agg(F.count(F.lit(1)).alias("_docs")))
    # the second aggregate keeps _words in use, so that both branches read one exchange
    frequent = (unique.groupBy("_host", "_hash").agg(F.count(F.lit(1)).alias("_in"), F.max("_words").alias("_most"))
                .where((F.col("_in") > min_docs) & (F.col("_most") > 0)).join(sizes, "_host")
                .where(F.col("_in") * F.col("_in") > F.col("_docs")).select("_host", "_hash"))
    removed = (unique.join(frequent, ["_host", "_hash"]).groupBy("_host", "_doc")
               .agg(F.sum("_words").cast("long").alias("removed_words"), F.collect_list("_hash").alias("_cut")))
    total = F.aggregate("_n", F.lit(0).cast("long"), lambda acc, line: acc + line_words(line))
    out = rows.withColumn("line_words", total).drop("_l", "_n").join(removed, ["_host", "_doc"], "left")
    out = out.withColumn("removed_words", F.coalesce("removed_words", F.lit(0).cast("long")))
    depleted = 100 * (F.col("line_words") - F.col("removed_words")) < left_percent * F.col("line_words")
    left = F.filter(F.split(F.col(text), "\n"), lambda line: ~F.array_contains("_cut", F.xxhash64(normalise(line))))
    out = out.withColumn("clean_text", F.when(F.col("_cut").isNull(), F.col(text)).otherwise(F.array_join(left, "\n")))
    out = out.withColumn("kept", ~F.col("base_failed") & ~depleted)
    return out.select(*unshielded(names, (*OUTPUT, "clean_text")), *OUTPUT, "clean_text")


def clean(docs: DataFrame, text: str = "text", host: str = "source", size: str = "n_chars", **options) -> DataFrame:
    """The kept documents without their removed lines, in the input's columns; ``size``, if
    there, follows a text that lost lines."""
    df, names = shielded(docs)
    rules = quality_rules(df, names[text], names[host], **options).where("kept")
    out = {c: F.col(own) for c, own in names.items()} | {text: F.col("clean_text")}
    if size in names:
        out[size] = F.when(F.col("removed_words") > 0, F.length("clean_text").cast(docs.schema[size].dataType)).otherwise(out[size])
    return rules.select(*[c.alias(name) for name, c in out.items()])


def digest(docs: DataFrame) -> DataFrame:
    slim = docs.select("doc_id", "text", "source")
    return quality_rules(slim).drop("text", "source", "clean_text")


ORACLE = f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(source, chr(1)) AS host, coalesce(text, '') AS t
           FROM documents),
w AS (SELECT rid, list_filter(regexp_split_to_array(t, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS ws,
             list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS ls FROM d),
tri AS (SELECT rid, unnest(range(1, len(ws) - 1)) AS p, ws FROM w WHERE len(ws) >= 3),
tk AS (SELECT rid, p, ws[p] || ' ' || ws[p + 1] || ' ' || ws[p + 2] AS k FROM tri),
dup AS (SELECT rid, p FROM (SELECT rid, p, count(*) OVER (PARTITION BY rid, k) AS c FROM tk) WHERE c > 1),
rep AS (SELECT rid, count(DISTINCT q) AS n FROM (SELECT rid, unnest([p, p + 1, p + 2]) AS q FROM dup) GROUP BY rid),
ln AS (SELECT DISTINCT d.rid, d.host, d.t, trim(regexp_replace(regexp_replace(lower(x.line), '[0-9]+', '0', 'g'),
         '[\\x20\\x09-\\x0D]+', ' ', 'g')) AS line
       FROM d JOIN (SELECT rid, unnest(ls) AS line FROM w) x ON x.rid = d.rid),
freq AS (SELECT host, line, count(DISTINCT t) AS n FROM ln GROUP BY host, line),
hosts AS (SELECT host, count(DISTINCT t) AS n FROM d GROUP BY host),
frequent AS (SELECT f.host, f.line FROM freq f JOIN hosts h ON h.host = f.host
             WHERE f.n > {MIN_LINE_DOCS} AND f.n * f.n > h.n),
lw AS (SELECT l.rid, sum(len(string_split(l.line, ' ')))::BIGINT AS line_words,
              coalesce(sum(CASE WHEN f.line IS NOT NULL THEN len(string_split(l.line, ' ')) END), 0)::BIGINT AS removed_words
       FROM ln l LEFT JOIN frequent f ON f.host = l.host AND f.line = l.line GROUP BY l.rid),
b AS (SELECT d.doc_id, len(w.ws)::BIGINT AS n_words,
        length(regexp_replace(d.t, '[\\x20\\x09-\\x0D]+', '', 'g'))::BIGINT AS word_chars,
        (length(d.t) - length(translate(d.t, '#*$%&|<>', '')))::BIGINT AS n_symbols,
        (len(w.ls) - len(list_distinct(w.ls)))::BIGINT AS n_dup_lines,
        coalesce(rep.n, 0)::BIGINT AS n_repeat_words,
        coalesce(lw.line_words, 0)::BIGINT AS line_words, coalesce(lw.removed_words, 0)::BIGINT AS removed_words
      FROM d JOIN w ON w.rid = d.rid LEFT JOIN rep ON rep.rid = d.rid LEFT JOIN lw ON lw.rid = d.rid),
f AS (SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {REPEAT_PERCENT} * n_words AS base_failed FROM b)
SELECT *, NOT base_failed AND NOT (100 * (line_words - removed_words) < {LEFT_PERCENT} * line_words) AS kept FROM f
"""
