"""Mixing sources to target weights by Poisson replication.

A source's mean repetition rate is ``target share x total bytes / own bytes``.
Each document's count inverts the Poisson distribution with that mean at a
uniform draw from a seeded hash of its doc_id: the number of k with
``cdf(k) <= u``. Documents are exploded by their count and the copies are
dealt over all partitions, and ordered inside them, by a hash of
(doc_id, copy): a global shuffle with one exchange and no sampling pass.

Default target: shares proportional to ``bytes ** alpha``. Explicit ``weights``
name shares per source; sources not named get no copies. A source without any
bytes has rate 0. Null source: a source of its own (key ````, shown as null).
Null doc_id draws as ``null``; repeated rows share a draw and are each replicated.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tenor.llm.blocks import shielded, stored, unshielded

ALPHA = 0.5
SEED = 17


def rates(docs: DataFrame, weights: dict[str, float] | None = None, alpha: float = ALPHA,
          source: str = "source", text: str = "text") -> DataFrame:
    """(_src, rate): one row per source."""
    sizes = docs.groupBy(F.coalesce(F.col(source), F.lit("")).alias("_src")).agg(
        F.sum(F.coalesce(F.octet_length(text), F.lit(0))).cast("double").alias("_bytes"))
    if weights is None:
        target = F.when(F.col("_bytes") > 0, F.pow("_bytes", F.lit(alpha))).otherwise(0.0)
    else:
        pairs = [F.lit(x) for kv in weights.items() for x in (kv[0], float(kv[1]))]
        target = F.coalesce(F.element_at(F.create_map(*pairs), F.col("_src")), F.lit(0.0))
    sizes = sizes.withColumn("_t", target)
    # one row of totals, joined by a constant
    totals = sizes.agg(F.sum("_t").alias("_sum_t"), F.sum("_bytes").alias("_sum_b")).withColumn("_one", F.lit(1))
    share = F.col("_t") / F.col("_sum_t") * F.col("_sum_b") / F.col("_bytes")
    return (sizes.withColumn("_one", F.lit(1)).join(F.broadcast(totals), "_one")
            .select("_src", F.when((F.col("_bytes") > 0) & (F.col("_t") > 0), share).otherwise(0.0).alias("rate")))


def cdf_tables(rate: DataFrame) -> DataFrame:
    """(_src, rate, _cdf): cdf(0..K) with K past the last step a 52-bit draw can reach."""
    last = F.ceil(F.col("rate") + 12 * F.sqrt("rate") + 40).cast("int")
    steps = rate.withColumn("_k", F.explode(F.sequence(F.lit(0), last)))
    w = Window.partitionBy("_src").orderBy("_k").rowsBetween(Window.unboundedPreceding, 0)
    log_fact = F.sum(F.when(F.col("_k") > 0, F.log(F.col("_k").cast("double"))).otherwise(0.0)).over(w)
    power = F.when(F.col("_k") > 0, F.col("_k") * F.log("rate")).otherwise(0.0)
    steps = steps.withColumn("_p", F.exp(power - F.col("rate") - log_fact))
    steps = steps.withColumn("_c", F.when(F.col("rate") > 0, F.sum("_p").over(w)).otherwise(1.0))
    return (steps.groupBy("_src", "rate").agg(F.sort_array(F.collect_list(F.struct("_k", "_c"))).alias("_l"))
            .select("_src", "rate", F.col("_l._c").alias("_cdf")))


def mix(docs: DataFrame, weights: dict[str, float] | None = None, alpha: float = ALPHA, seed: int = SEED,
        source: str = "source", text: str = "text", key: str = "doc_id") -> DataFrame:
    """The input's columns plus rate, copies (the document's count), copy (1..copies) and
    mix_key, one row per copy, globally shuffled. Other columns may have any name; one named like a new column is replaced.

    The table of the sources' distributions is stored, so Spark knows its bytes and broadcasts it only below the session's
    limit; otherwise both sides are shuffled and AQE splits a hot source. A document reads as many entries as
    its source's mean copies, so this work grows with the rows that come out."""
    docs, names = shielded(docs)
    source, text, key = names[source], names[text], names[key]
    table = stored(cdf_tables(rates(docs, weights, alpha, source, text)), "rates")
    k = F.coalesce(F.col(key).cast("string"), F.lit("null"))
    u = (F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), k)), 1, 13), 16, 10).cast("double") + 0.5) / float(1 << 52)
    df = (docs.withColumn("_src", F.coalesce(F.col(source), F.lit(""))).join(table, "_src")
          .withColumn("_u", u)
          .withColumn("copies", F.size(F.filter("_cdf", lambda c: c <= F.col("_u"))).cast("int")).drop("_cdf", "_u", "_src")
          .where(F.col("copies") > 0)
          .withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies")))))
    df = df.withColumn("mix_key", F.xxhash64(F.lit(seed), k, F.col("copy"), F.col(source)))
    new = ("rate", "copies", "copy", "mix_key")
    return df.repartition("mix_key").sortWithinPartitions("mix_key").select(*unshielded(names, new), *new)


def digest(docs: DataFrame) -> DataFrame:
    sized = docs.select("doc_id", "source", "text")
    return mix(sized).select("doc_id", "source", F.round("rate", 9).alias("rate"), "copies", "copy")


ORACLE = f"""
WITH s AS (SELECT coalesce(source, '') AS src, sum(strlen(coalesce(text, '')))::DOUBLE AS b FROM documents GROUP BY 1),
t AS (SELECT src, b, CASE WHEN b > 0 THEN pow(b, {ALPHA}) ELSE 0 END AS t FROM s),
r AS (SELECT src, CASE WHEN b > 0 AND t > 0 THEN t / (SELECT sum(t) FROM t) * (SELECT sum(b) FROM t) / b ELSE 0 END AS rate FROM t),
k AS (SELECT src, rate, unnest(range(0, ceil(rate + 12 * sqrt(rate) + 40)::BIGINT + 1)) AS k FROM r),
p AS (SELECT src, rate, k, exp(CASE WHEN k > 0 THEN k * ln(rate) ELSE 0 END - rate
        - sum(CASE WHEN k > 0 THEN ln(k::DOUBLE) ELSE 0 END) OVER (PARTITION BY src ORDER BY k)) AS p FROM k),
c AS (SELECT src, rate, k, CASE WHEN rate > 0 THEN sum(p) OVER (PARTITION BY src ORDER BY k) ELSE 1 END AS c FROM p),
d AS (SELECT row_number() OVER () AS rid, doc_id, source, coalesce(source, '') AS src,
        (('0x' || substr(md5('{SEED}:' || coalesce(doc_id::VARCHAR, 'null')), 1, 13))::BIGINT::DOUBLE + 0.5) / pow(2, 52) AS u
      FROM documents),
n AS (SELECT d.rid, d.doc_id, d.source, c.rate, count(*) FILTER (WHERE c.c <= d.u) AS copies
      FROM d JOIN c ON c.src = d.src GROUP BY ALL)
SELECT doc_id, source, round(rate, 9) AS rate, copies::INTEGER AS copies, unnest(range(1, copies + 1))::INTEGER AS copy
FROM n WHERE copies > 0
"""
