"""URL filters: rules first, gradient-boosted trees for the rest (DataFrame functions and Spark ML only).

Rules are (host, path prefix) with a verdict; a rule fits its host and all
subdomains, and the longest fitting rule wins. URLs that a rule judges are
also the labelled URLs: their lexical features (length, depth, digit ratio,
entropy, parameter counts) and smoothed block rates of their host suffixes
train the trees that judge all other URLs. Suffix statistics come from one half of the
labelled rows (by hash of page_id) and all of them; the trees are fitted on at
most ``FIT_ROWS`` rows of the other half, so no row meets its own label in a statistic.

A null URL, or one without ``://``, has an empty host and path and is judged on
those. Without labelled rows of both kinds every unruled URL is allowed.
"""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tenor.llm.blocks import shielded, unshielded

RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))
FIT_ROWS = 20_000
TREES, DEPTH = 10, 4
PRIOR_ROWS = 20.0
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
FEATURES = ["f_len", "f_host_len", "f_path_len", "f_depth", "f_labels", "f_digits", "f_host_digits", "f_hyphens",
            "f_entropy", "f_params", "f_fragment", "f_secure", "f_suffix1", "f_suffix2", "f_suffix3", "f_suffix4"]
SUFFIXES = (1, 2, 3, 4)


def parse(pages: DataFrame, url: str = "url") -> DataFrame:
    u = F.coalesce(F.col(url), F.lit(""))
    return (pages.withColumn("host", F.translate(F.regexp_extract(u, "://([^/?#]*)", 1), UPPER, LOWER))
            .withColumn("path", F.regexp_extract(u, "://[^/?#]*([^?#]*)", 1)))


def rule_columns(rules=RULES) -> tuple[Column, Column]:
    """(rule, its verdict) of a parsed row; null where none fits."""
    name = verdict = F.lit(None).cast("string")
    for kind, host, path in sorted(rules, key=lambda r: len(r[1] + r[2])):  # the longest is tested first
        fits = ((F.col("host") == host) | F.col("host").endswith("." + host)) & F.col("path").startswith(path)
        name, verdict = F.when(fits, F.lit(host + path)).otherwise(name), F.when(fits, F.lit(kind)).otherwise(verdict)
    return name, verdict


def _count(text: Column, pattern: str) -> Column:
    return F.regexp_count(text, F.lit(pattern)).cast("double")


def _entropy(text: Column) -> Column:
    """Bits per character."""
    n = F.length(text)
    signs = F.array_distinct(F.array_remove(F.split(text, ""), ""))
    share = lambda c: (n - F.length(F.replace(text, c))) / n
    bits = F.aggregate(signs, F.lit(0.0), lambda acc, c: acc - share(c) * F.log2(share(c)))
    return F.when(n > 0, bits).otherwise(0.0)


def lexical(parsed: DataFrame, url: str = "url") -> DataFrame:
    """Adds the lexical features and the suffixes: the host's last one, two and three labels,
    and its last two with the first path segment."""
    u, labels = F.coalesce(F.col(url), F.lit("")), F.split("host", r"\.")
    query = F.regexp_extract(u, r"://[^?#]*\?([^#]*)", 1)
    tail = lambda k: F.array_join(F.slice(labels, -F.least(F.lit(k), F.size(labels)), F.lit(k)), ".")
    out = (parsed.withColumn("f_len", F.length(u).cast("double")).withColumn("f_host_len", F.length("host").cast("double"))
           .withColumn("f_path_len", F.length("path").cast("double")).withColumn("f_depth", _count(F.col("path"), "/[^/]"))
           .withColumn("f_labels", F.size(labels).cast("double"))
           .withColumn("f_digits", _count(u, "[0-9]") / F.greatest(F.length(u), F.lit(1)))
           .withColumn("f_host_digits", _count(F.col("host"), "[0-9]") / F.greatest(F.length("host"), F.lit(1)))
           .withColumn("f_hyphens", _count(F.col("host"), "-")).withColumn("f_entropy", _entropy(F.col("host")))
           .withColumn("f_params", _count(query, "[^&]+")).withColumn("f_fragment", F.contains(u, F.lit("#")).cast("double"))
           .withColumn("f_secure", F.startswith(u, F.lit("https")).cast("double")))
    for k in (1, 2, 3):
        out = out.withColumn(f"_s{k}", F.concat(F.lit(f"{k}:"), tail(k)))
    return out.withColumn("_s4", F.concat(F.lit("4:"), tail(2), F.regexp_extract("path", "^(/[^/]*/?)", 1)))


def suffix_rates(labelled: DataFrame) -> DataFrame:
    """(_s, _rate): smoothed block rate of every suffix among labelled rows."""
    rows = labelled.select("_y", F.explode(F.array(*[f"_s{k}" for k in SUFFIXES])).alias("_s"))
    return rows.groupBy("_s").agg(((F.sum("_y") + PRIOR_ROWS / 2) / (F.count(F.lit(1)) + PRIOR_ROWS)).alias("_rate"))


def with_rates(df: DataFrame, rates: DataFrame) -> DataFrame:
    """Every suffix meets the suffixes of its own kind only, so a kind with few of them is a small table whatever the number of hosts."""
    for k in SUFFIXES:
        table = rates.where(F.startswith("_s", F.lit(f"{k}:"))).select(F.col("_s").alias(f"_s{k}"), F.col("_rate").alias(f"f_suffix{k}"))
        df = df.join(table, f"_s{k}", "left").withColumn(f"f_suffix{k}", F.coalesce(f"f_suffix{k}", F.lit(0.5)))
    return df


def fit(labelled: DataFrame, rates: DataFrame, key: str, fit_rows: int = FIT_ROWS):
    """The trees, or None unless both verdicts are present. ``labelled``: lexical rows with _y."""
    half = labelled.where(F.pmod(F.xxhash64(key, F.lit("half")), F.lit(2)) == 1)
    n, blocked = half.agg(F.count(F.lit(1)), F.sum("_y")).first()
    if not n or blocked in (0, n):
        return None
    share = min(1.0, fit_rows / n)
    picked = half.where(F.pmod(F.xxhash64(key, F.lit("pick"), "host"), F.lit(1 << 30)) < F.lit(int(share * (1 << 30))))
    train = with_rates(picked, rates).select(*FEATURES, F.col("_y").cast("double").alias("label"))
    trees = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, seed=11, maxBins=32)
    return Pipeline(stages=[VectorAssembler(inputCols=FEATURES, outputCol="features"), trees]).fit(train)


def judge(pages: DataFrame, rules=RULES, key: str = "page_id", url: str = "url", fit_rows: int = FIT_ROWS) -> DataFrame:
    """The input's columns plus host, path, rule and verdict. Other columns may have any name; one named like a new column is replaced."""
    pages, names = shielded(pages)
    key, url, own = names[key], names[url], pages.columns
    name, verdict = rule_columns(rules)
    rows = lexical(parse(pages, url).withColumn("rule", name).withColumn("_ruled", verdict), url)
    labelled = rows.where(F.col("rule").isNotNull()).withColumn("_y", (F.col("_ruled") == "block").cast("double"))
    labelled = labelled.drop(*[c for c in own if c != key])
    rates = suffix_rates(labelled.where(F.pmod(F.xxhash64(key, F.lit("half")), F.lit(2)) == 0))
    model = fit(labelled, rates, key, fit_rows)
    if model is None:
        method = F.lit("allow")
    else:
        rows = model.transform(with_rates(rows, rates))
        method = F.when(F.col("prediction") > 0.5, "block").otherwise("allow")
    new = ("host", "path", "rule", "verdict")
    return rows.withColumn("verdict", F.coalesce("_ruled", method)).select(*unshielded(names, new), *new)


def digest(pages: DataFrame) -> DataFrame:
    return judge(pages.select("page_id", "url")).drop("url")
