"""Multinomial Naive Bayes as relational jobs.

Fitting is counting: tokens per (group, label), an aggregation with partial
combine, then one row per token holding all 11 groups. Scoring has two ways, chosen by the counted
bytes of the model: packed as arrays and broadcast (texts and tokens never leave their task), or, where
it is too large for that, its frequent tokens so and the others joined as a table. Either way the router
comes first and only the groups it retains are asked.

Experts (one per group, hate vs neutral), add-one smoothing over the group's
distinct tokens V_g:
    ll_{g,y}(t) = log((c_{g,y}(t) + 1) / (N_{g,y} + V_g)),  prior_{g,y} = (n_{g,y} + 1) / (n_g + 2)
    logit_g(x)  = log(prior_{g,1} / prior_{g,0}) + sum over tokens t of x in V_g of ll_{g,1}(t) - ll_{g,0}(t)
Tokens outside V_g are skipped. A group without training rows has logit 0.

Router (11 classes, label = group), smoothing over the global vocabulary V:
    s_g(x) = (log((m_g + 1) / (M + 11)) + sum over tokens t of x in V of log((C_g(t) + 1) / (T_g + V))) / max(n_x, 1)
with n_x the number of tokens of x in V; p = softmax(s). Dividing by n_x keeps
long documents from saturating the softmax.
"""

from __future__ import annotations

import json
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tenor import vocab
from tenor.functions.text import tokens
from tenor.operators import routing
from tenor.operators.gradient import sliced
from tenor.session import batches_of, scratch_path, shared_dir

G = len(vocab.GROUPS)
PACK_BYTES = 64 << 20  # largest part of a model that is collected and broadcast as arrays: the driver holds a few copies of it
HEAD_BYTES = 32 << 20  # the frequent tokens of a larger model, beside which a task holds the tokens that it passes on
COUNT_BITS = 29        # a count of a token outside the head; more frequent tokens are always in the head
BATCH_ROWS = 1000      # whole texts that a task takes in at once beside the head


def token_counts(train: DataFrame) -> DataFrame:
    """(target, label, token, n): token occurrences per (group, label); one aggregation
    with partial combine (a hot token collapses map-side)."""
    occ = train.select("target", "label", F.explode(tokens("text")).alias("token"))
    return occ.groupBy("target", "label", "token").agg(F.count(F.lit(1)).alias("n"))


def with_loglik(counts: DataFrame) -> DataFrame:
    """Add the smoothed log-likelihood log((n + 1) / (N_{g,y} + V_g)) to stored counts."""
    totals = counts.groupBy("target", "label").agg(F.sum("n").alias("_N"))
    vg = counts.select("target", "token").distinct().groupBy("target").agg(F.count(F.lit(1)).alias("_V"))
    small = totals.join(F.broadcast(vg), "target")  # at most 2 x 11 rows
    return (counts.join(F.broadcast(small), ["target", "label"])
            .select("target", "label", "token", "n",
                    F.log((F.col("n") + 1) / (F.col("_N") + F.col("_V"))).alias("loglik")))


def nb_counts(train: DataFrame) -> DataFrame:
    """(target, label, token, n, loglik) with the smoothed log-likelihood of every
    observed (group, label, token). ``train`` has (target, label, text). The counts are
    checkpointed once (shared folder), so the totals and vocabulary sizes read the
    stored table instead of re-tokenising the corpus."""
    shared_dir(train.sparkSession)
    return with_loglik(token_counts(train).checkpoint(eager=True))


def _dense_model(counts: DataFrame) -> DataFrame:
    """One row per token, 11 groups wide, in scalar columns: ``a{g}`` = log(c1 + 1) -
    log(c0 + 1), ``k{g}`` = token in V_g, ``r{g}`` = log(C_g + 1), the raw ``c1_{g}`` /
    ``c0_{g}`` and ``n_tok`` (all occurrences). One aggregation by token with
    primitive conditional sums (hash aggregate)."""
    ids = F.broadcast(vocab.groups_df(counts.sparkSession))
    c = counts.join(ids, "target")
    gid, lab, n = F.col("target_id"), F.col("label"), F.col("n")
    aggs = []
    for g in range(G):
        aggs.append(F.sum(F.when((gid == g) & (lab == 1), n).otherwise(F.lit(0))).alias(f"c1_{g}"))
        aggs.append(F.sum(F.when((gid == g) & (lab == 0), n).otherwise(F.lit(0))).alias(f"c0_{g}"))
        aggs.append(F.max(F.when(gid == g, F.lit(1)).otherwise(F.lit(0))).alias(f"k{g}"))
    t = c.groupBy("token").agg(*aggs, F.sum(n).alias("n_tok"))
    c1, c0 = (lambda g: F.col(f"c1_{g}")), (lambda g: F.col(f"c0_{g}"))
    return t.select(
        "token", "n_tok",
        *[(F.log(c1(g) + 1) - F.log(c0(g) + 1)).alias(f"a{g}") for g in range(G)],
        *[F.col(f"k{g}") for g in range(G)],
        *[F.log(c1(g) + c0(g) + 1).alias(f"r{g}") for g in range(G)],
        *[c1(g) for g in range(G)], *[c0(g) for g in range(G)])


def _group_constants(train: DataFrame, dense: DataFrame) -> dict:
    """Per-group scalars (11 groups x a few numbers), collected as a fixed-size vocabulary,
    in two small jobs: documents per (group, label) from the training rows, and one
    aggregation over the stored model for token totals, vocabulary sizes and the
    total token count."""
    docs = {r["target"]: (r["n1"], r["n0"]) for r in train.groupBy("target").agg(
        F.count_if(F.col("label") == 1).alias("n1"), F.count_if(F.col("label") == 0).alias("n0")).collect()}
    t = dense.agg(F.count(F.lit(1)).alias("v_all"), F.sum("n_tok").alias("n_all"),
                  *[F.sum(f"k{g}").alias(f"v{g}") for g in range(G)],
                  *[F.sum(f"c1_{g}").alias(f"N1_{g}") for g in range(G)],
                  *[F.sum(f"c0_{g}").alias(f"N0_{g}") for g in range(G)]).first()
    v_all = t["v_all"]
    m_all = sum(a + b for a, b in docs.values())
    out = {"prior_logit": [], "kconst": [], "log_prior": [], "log_denom": [], "v_all": float(v_all),
           "n_all": float(t["n_all"] or 0)}
    for i, g in enumerate(vocab.GROUPS):
        n1, n0 = docs.get(g, (0, 0))
        big_n1, big_n0, v = t[f"N1_{i}"] or 0, t[f"N0_{i}"] or 0, t[f"v{i}"] or 0
        if n1 + n0 > 0:
            out["prior_logit"].append(math.log((n1 + 1) / (n1 + n0 + 2)) - math.log((n0 + 1) / (n1 + n0 + 2)))
            out["kconst"].append(math.log(big_n0 + v) - math.log(big_n1 + v))
        else:
            out["prior_logit"].append(0.0)
            out["kconst"].append(0.0)
        out["log_prior"].append(math.log((n1 + n0 + 1) / (m_all + G)))
        out["log_denom"].append(math.log(big_n1 + big_n0 + v_all))
    return out


def nb_fit(train: DataFrame, path: str | None = None) -> dict:
    """Fit both models. The token counts and the per-token model are written once
    under ``path`` (default: a fresh folder in the shared checkpoint folder) and read
    back, so the constants and the scoring read the small model instead of
    re-tokenising the corpus, and lineage is cut at the model."""
    spark = train.sparkSession
    path = path or scratch_path(spark, "nb-model")
    token_counts(train).write.mode("overwrite").parquet(f"{path}/counts")
    counts = spark.read.parquet(f"{path}/counts")
    _dense_model(counts).write.mode("overwrite").parquet(f"{path}/dense")
    dense = spark.read.parquet(f"{path}/dense")
    const = _group_constants(train, dense)
    spark.createDataFrame([(json.dumps(const),)], "const string").coalesce(1).write.mode("overwrite").parquet(f"{path}/const")
    return {"path": path, "counts": counts, "dense": _scoring_columns(dense), "const": const}


def _scoring_columns(dense: DataFrame, *kinds: str) -> DataFrame:
    return dense.select("token", "n_tok", *[f"{p}{g}" for p in kinds or ("a", "k", "r", "c1_", "c0_") for g in range(G)])


def nb_load(spark: SparkSession, path: str) -> dict:
    """A model that :func:`nb_fit` stored under ``path``."""
    return {"path": path, "counts": spark.read.parquet(f"{path}/counts"), "dense": _scoring_columns(spark.read.parquet(f"{path}/dense")),
            "const": json.loads(spark.read.parquet(f"{path}/const").first()["const"])}


# --------------------------------------------------------------------------- the packed model


class Packed:
    """The model as arrays: tokens, and per token the router's and the experts' weights of every group."""

    def __init__(self, dense: pa.Table):
        column = lambda p: np.stack([dense.column(f"{p}{g}").to_numpy() for g in range(G)], axis=1)
        self.tokens = dense.column("token").combine_chunks()
        self.router, self.expert, self.known = column("r"), column("a"), column("k").astype(bool)

    def ids(self, tokens: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of the model's tokens in a column of token lists, row of each)."""
        found = pc.index_in(tokens.flatten(), self.tokens)
        row = np.repeat(np.arange(len(tokens)), tokens.value_lengths().fill_null(0).to_numpy())
        have = found.is_valid().to_numpy(zero_copy_only=False)
        return found.drop_null().to_numpy(), row[have]

    def sums(self, values: np.ndarray, ids: np.ndarray, row: np.ndarray, n: int) -> np.ndarray:
        """(n, groups): the tokens' rows of ``values`` added up by document."""
        return np.stack([np.bincount(row, weights=values[ids, g], minlength=n) for g in range(values.shape[1])], axis=1)


def _row_bytes():
    return F.octet_length("token") + 12 + G * 20


def pack(model: dict, limit: int | None = None) -> Packed | None:
    """The model as arrays for a broadcast, or None when its stored rows exceed ``limit`` bytes (PACK_BYTES):
    then scoring broadcasts its head (:func:`head_and_rest`). The size is counted before anything is collected."""
    limit = PACK_BYTES if limit is None else limit
    if "bytes" not in model:  # counted and collected once for all batches scored with this model
        model["bytes"] = model["dense"].agg(F.sum(_row_bytes())).first()[0] or 0
    if model["bytes"] > limit:
        return None
    if "packed" not in model:
        model["packed"] = Packed(_scoring_columns(model["dense"], "a", "k", "r").toArrow())
    return model["packed"]


def _doubles(values: np.ndarray) -> pa.Array:
    flat = pa.array(np.ascontiguousarray(values, np.float64).ravel())
    return pa.ListArray.from_arrays(pa.array(np.arange(len(values) + 1, dtype=np.int32) * values.shape[1]), flat)


def _token_lists(docs: DataFrame, key: str, text: str) -> DataFrame:
    return docs.select(F.col(key).alias("_key"), tokens(F.coalesce(F.col(text), F.lit(""))).alias("_tokens"))


def _router_probabilities(sums: np.ndarray, n_x: np.ndarray, const: dict) -> np.ndarray:
    z = (np.array(const["log_prior"]) + sums - n_x[:, None] * np.array(const["log_denom"])) / np.maximum(n_x, 1)[:, None]
    p = np.exp(z - z.max(axis=1, keepdims=True, initial=-np.inf))
    return p / p.sum(axis=1, keepdims=True)


def routing_pass(docs: DataFrame, shared, const: dict, key: str, text: str = "text") -> DataFrame:
    """(key, p ARRAY[11], ids ARRAY<INT>): a document's known tokens as ids and the router's probabilities, row by row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, "_tokens"):
            packed, n = shared.value, batch.num_rows
            ids, row = packed.ids(batch.column("_tokens"))
            n_x = np.bincount(row, minlength=n)
            p = _router_probabilities(packed.sums(packed.router, ids, row, n), n_x, const)
            lists = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(n_x))).astype(np.int32)), pa.array(ids.astype(np.int32)))
            yield pa.RecordBatch.from_arrays([batch.column("_key"), _doubles(p), lists], names=[key, "p", "ids"])

    rows = _token_lists(docs, key, text)
    kind = rows.schema["_key"].dataType.simpleString()
    return rows.mapInArrow(run, f"`{key}` {kind}, p array<double>, ids array<int>")


def all_experts(docs: DataFrame, shared, const: dict, key: str, text: str = "text") -> DataFrame:
    """(key, logits ARRAY[11]): every expert's answer on every document, row by row."""
    prior, shift = np.array(const["prior_logit"]), np.array(const["kconst"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packed = shared.value
        values = np.where(packed.known, packed.expert + shift, 0.0)
        for batch in sliced(batches, "_tokens"):
            ids, row = packed.ids(batch.column("_tokens"))
            yield pa.RecordBatch.from_arrays([batch.column("_key"), _doubles(prior + packed.sums(values, ids, row, batch.num_rows))],
                                             names=[key, "logits"])

    rows = _token_lists(docs, key, text)
    return rows.mapInArrow(run, f"`{key}` {rows.schema['_key'].dataType.simpleString()}, logits array<double>")


def expert_pass(pairs: DataFrame, shared, const: dict) -> DataFrame:
    """Adds ``logit`` to (..., idx, ids): the answer of expert ``idx``; drops ids. Only the pairs given are evaluated."""
    keep = [c for c in pairs.columns if c != "ids"]
    schema = T.StructType([pairs.schema[c] for c in keep] + [T.StructField("logit", T.DoubleType())])
    prior, shift = np.array(const["prior_logit"]), np.array(const["kconst"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, "ids"):
            packed, column = shared.value, lambda c: batch.column(batch.schema.get_field_index(c))  # noqa: B023
            group, lists = column("idx").to_numpy(), column("ids")
            row = np.repeat(np.arange(batch.num_rows), lists.value_lengths().to_numpy())
            ids, g = lists.flatten().to_numpy(), group[row]
            known = packed.known[ids, g]
            terms = np.where(known, packed.expert[ids, g] + shift[g], 0.0)
            logit = prior[group] + np.bincount(row, weights=terms, minlength=batch.num_rows)
            yield pa.RecordBatch.from_arrays([*(column(c) for c in keep), pa.array(logit)], names=schema.names)

    return pairs.mapInArrow(run, schema)


# --------------------------------------------------------------------------- a model larger than a broadcast

# The frequent tokens, as many as fit, are the head: packed and broadcast as above, they hold nearly all occurrences. What
# the head does not hold is collected by token in the tasks, one row per token and batch with the documents that
# hold it, and meets the rest of the stored table once; sums of head and rest are added by document.

PART_SCHEMA = "n_x long, sums array<double>, ids array<int>, token string, rows array<long>, tfs array<int>"


def head_cut(model: dict, limit: int) -> int:
    """The least number of occurrences of a token so that all tokens of so many or more take at most ``limit`` bytes."""
    level = F.floor(F.log2("n_tok") * 8)  # a few hundred levels at most, whatever the model's size
    rows = (model["dense"].groupBy(level.alias("level")).agg(F.sum(_row_bytes()).alias("bytes"), F.min("n_tok").alias("least"))
            .orderBy(F.desc("level")).collect())
    cut, size = (1 << 62), 0
    for r in rows:
        size += r["bytes"]
        if size > limit:
            break
        cut = r["least"]
    return cut


def head_and_rest(model: dict, limit: int | None = None) -> tuple[Packed, DataFrame]:
    """(the frequent tokens as arrays, the rows of all other tokens)."""
    limit = HEAD_BYTES if limit is None else limit
    if ("head", limit) not in model:  # collected once for all batches scored with this model
        cut = min(head_cut(model, limit), 1 << COUNT_BITS)
        head = _scoring_columns(model["dense"].where(F.col("n_tok") >= cut), "a", "k", "r")
        model["head", limit] = Packed(head.toArrow()), model["dense"].where(F.col("n_tok") < cut)
    return model["head", limit]


def _postings(tokens: pa.Array, row: np.ndarray, keys: np.ndarray) -> tuple[pa.Array, pa.Array, pa.Array]:
    """(token, documents that hold it, occurrences in each) of the given tokens of a batch; ``row`` is the place of each one's document."""
    coded, n = tokens.dictionary_encode(), max(len(keys), 1)
    pair, tf = np.unique(coded.indices.to_numpy().astype(np.int64) * n + row, return_counts=True)
    ends = np.concatenate(([0], np.cumsum(np.bincount(pair // n, minlength=len(coded.dictionary))))).astype(np.int32)
    lists = lambda x: pa.ListArray.from_arrays(pa.array(ends), pa.array(x))
    return coded.dictionary, lists(keys[pair % n]), lists(tf.astype(np.int32))


def head_pass(docs: DataFrame, shared, weigh, ids: bool, key: str, text: str = "text") -> DataFrame:
    """Two kinds of rows, stored in the shared folder: (key, _row, n_x, sums, ids) of every document, from the head, ``weigh(packed)``
    being the weights that are added up; and (token, rows, tfs) of the tokens that the head does not hold."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packed, values = shared.value, weigh(shared.value)
        for batch in sliced(batches, "_tokens"):
            n, lists = batch.num_rows, batch.column("_tokens")
            flat, row = lists.flatten(), np.repeat(np.arange(batch.num_rows), lists.value_lengths().to_numpy())
            found = pc.index_in(flat, packed.tokens)
            known, have = found.drop_null().to_numpy(), found.is_valid().to_numpy(zero_copy_only=False)
            n_x, sums = np.bincount(row[have], minlength=n), packed.sums(values, known, row[have], n)
            kept = (pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(n_x))).astype(np.int32)), pa.array(known.astype(np.int32)))
                    if ids else pa.nulls(n, pa.list_(pa.int32())))
            yield pa.RecordBatch.from_arrays([
                batch.column("_key"), batch.column("_row"), pa.array(n_x.astype(np.int64)), _doubles(sums), kept,
                *(pa.nulls(n, t) for t in (pa.string(), pa.list_(pa.int64()), pa.list_(pa.int32())))], names=names)
            token, rows, tfs = _postings(flat.filter(pa.array(~have)), row[~have], batch.column("_row").to_numpy())
            m = len(token)
            yield pa.RecordBatch.from_arrays([
                *(pa.nulls(m, t) for t in (batch.column("_key").type, pa.int64(), pa.int64(), pa.list_(pa.float64()), pa.list_(pa.int32()))),
                token.cast(pa.string()), rows, tfs], names=names)

    names = [key, "_row", "n_x", "sums", "ids", "token", "rows", "tfs"]
    rows = _token_lists(docs, key, text).withColumn("_row", F.monotonically_increasing_id())
    out = rows.mapInArrow(run, f"`{key}` {rows.schema['_key'].dataType.simpleString()}, _row long, {PART_SCHEMA}")
    path = scratch_path(docs.sparkSession, "doc-sums")
    with batches_of(docs.sparkSession, BATCH_ROWS):
        out.write.parquet(path)
    return docs.sparkSession.read.schema(out.schema).parquet(path)


def _known_counts():
    """ARRAY<BIGINT>: the groups that know a token of the rest, each as one number of 4 bits of the group and its two counts. The counts
    move instead of the weights, which are made of them where they are added up."""
    code = lambda g: (F.shiftleft(F.col(f"c0_{g}"), COUNT_BITS + 4).bitwiseOR(F.shiftleft(F.col(f"c1_{g}"), 4)).bitwiseOR(F.lit(g).cast("bigint")))
    return F.filter(F.array(*[F.when(F.col(f"k{g}") == 1, code(g)) for g in range(G)]), lambda x: x.isNotNull())


def rest_sums(parts: DataFrame, rest: DataFrame, const: dict, *sums: str) -> DataFrame:
    """(_row, n, and ARRAY[11] columns) of the documents that hold tokens of ``rest``: their number, and per name of ``sums`` the
    experts' (``a``) or the router's (``r``) weights added up. One row per document and token moves, whatever number of groups knows the token."""
    met = (parts.where(F.col("token").isNotNull()).select("token", "rows", "tfs")
           .join(rest.select("token", _known_counts().alias("known")), "token"))
    pairs = met.select(F.explode(F.arrays_zip("rows", "tfs")).alias("at"), "known").select(F.col("at.rows").alias("_row"), F.col("at.tfs").alias("tf"), "known")
    # dealt out by document first: a document's entries lie in many tasks, so that sums made there would only be wider
    each = (pairs.repartition("_row").select("_row", "tf", F.get("known", 0).alias("first"), F.explode("known").alias("code"))
            .select("_row", "tf", (F.col("first") == F.col("code")).alias("once"), F.col("code").bitwiseAND(F.lit(15)).cast("int").alias("g"),
                    F.shiftright("code", 4).bitwiseAND(F.lit((1 << COUNT_BITS) - 1)).alias("c1"), F.shiftright("code", COUNT_BITS + 4).alias("c0")))
    weight = {"a": F.log(F.col("c1") + 1) - F.log(F.col("c0") + 1) + F.get(_lit_array(const["kconst"]), F.col("g")),
              "r": F.log(F.col("c1") + F.col("c0") + 1)}
    each = each.select("_row", "g", F.when(F.col("once"), F.col("tf")).otherwise(F.lit(0)).alias("n"), *[(F.col("tf") * weight[s]).alias(s) for s in sums])
    total = lambda s: F.array(*[F.sum(F.when(F.col("g") == g, F.col(s)).otherwise(F.lit(0.0))) for g in range(G)])
    return each.groupBy("_row").agg(F.sum("n").alias("n"), *[total(s).alias(s) for s in sums])


def whole_sums(parts: DataFrame, rest: DataFrame, key: str, *also: str) -> DataFrame:
    """The documents of :func:`head_pass` (key, _row, n_x, sums, and the columns of ``also``) next to the sums of the rest, null where none."""
    return parts.where(F.col("token").isNull()).select(key, "_row", "n_x", "sums", *also).join(rest, "_row", "left")


def routed_sums(whole: DataFrame, const: dict, key: str) -> DataFrame:
    """(key, _row, p ARRAY[11], ids, a): the router's probabilities from the sums of head and rest; ``a`` (the rest's part of the experts'
    sums) is null where a document holds no token of the rest."""
    keep = [key, "_row", "ids", "a"]
    schema = T.StructType([whole.schema[c] for c in keep] + [T.StructField("p", T.ArrayType(T.DoubleType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = lambda c: batch.column(batch.schema.get_field_index(c))  # noqa: B023,E731
            sums, more = column("sums").flatten().to_numpy().reshape(-1, G).copy(), column("r")
            sums[more.is_valid().to_numpy(zero_copy_only=False)] += more.flatten().to_numpy().reshape(-1, G)
            n_x = column("n_x").to_numpy() + column("n").fill_null(0).to_numpy()
            yield pa.RecordBatch.from_arrays([*(column(c) for c in keep), _doubles(_router_probabilities(sums, n_x, const))], names=schema.names)

    return whole.select(*keep, "sums", "r", "n_x", "n").mapInArrow(run, schema)


def _added(a: str, b: str):
    """ARRAY<DOUBLE>[11]: two array columns added up, the second one null for zeros."""
    return F.when(F.col(b).isNull(), F.col(a)).otherwise(F.zip_with(a, b, lambda x, y: x + y))


def _lit_array(values: list[float]):
    return F.array(*[F.lit(float(v)) for v in values])


def nb_score(docs: DataFrame, model: dict, key: str = "doc_id", limit: int | None = None) -> DataFrame:
    """(key, target, p_hate) for every document and group."""
    packed = pack(model, limit)
    if packed is not None:
        shared = docs.sparkSession.sparkContext.broadcast(packed)
        out = all_experts(docs, shared, model["const"], key).select(key, F.posexplode("logits").alias("idx", "logit"))
    else:
        head, rest = head_and_rest(model, limit)
        prior, shift = np.array(model["const"]["prior_logit"]), np.array(model["const"]["kconst"])
        parts = head_pass(docs, docs.sparkSession.sparkContext.broadcast(head), lambda m: np.where(m.known, m.expert + shift, 0.0), False, key)
        sums = whole_sums(parts, rest_sums(parts, rest, model["const"], "a"), key).withColumn("_s", _added("sums", "a"))
        out = sums.select(key, F.posexplode(F.zip_with("_s", _lit_array(prior), lambda x, y: x + y)).alias("idx", "logit"))
    return out.select(key, F.get(vocab.groups_array(), F.col("idx")).alias("target"),
                      (F.lit(1.0) / (F.lit(1.0) + F.exp(-F.col("logit")))).alias("p_hate"))


def retained_pairs(routed: DataFrame, *keep: str) -> DataFrame:
    """(keep..., rank, idx, weight): the groups the router retains (E3, E4), from its probabilities ``p``."""
    kept = routing.add_routing(routed, "p", "kept").select(*keep, F.posexplode("kept").alias("rank", "k"))
    return kept.select(*keep, "rank", F.col("k.idx").cast("int").alias("idx"), F.col("k.weight").alias("weight"))


def score_corpus(docs: DataFrame, model: dict, key: str = "doc_id", threshold: float = 0.5, limit: int | None = None) -> DataFrame:
    """Routed mixture with fitted parts: NB router -> top groups -> NB experts of those groups only.

    While the packed model fits a broadcast, texts stay where they are read: tokens become ids and router sums
    row by row, and the retained (document, group) pairs carry the ids to their expert; the one exchange
    adds up at most three numbers per document. Of a larger model the frequent tokens are broadcast; the rest meets
    the documents by token, once for router and experts, and only its sums move on."""
    packed = pack(model, limit)
    if packed is not None:
        shared = docs.sparkSession.sparkContext.broadcast(packed)
        routed = routing_pass(docs, shared, model["const"], key).withColumn("_row", F.monotonically_increasing_id())
        asked = expert_pass(retained_pairs(routed, key, "_row", "ids"), shared, model["const"])
    else:
        head, rest = head_and_rest(model, limit)
        shared = docs.sparkSession.sparkContext.broadcast(head)
        parts = head_pass(docs, shared, lambda m: m.router, True, key)
        sums = whole_sums(parts, rest_sums(parts, rest, model["const"], "r", "a"), key, "ids")
        pairs = retained_pairs(routed_sums(sums, model["const"], key), key, "_row", "ids", "a")
        more = F.coalesce(F.get("a", "idx"), F.lit(0.0)).alias("_a")
        asked = expert_pass(pairs.select(key, "_row", "rank", "idx", "weight", "ids", more), shared, model["const"])
        asked = asked.withColumn("logit", F.col("logit") + F.col("_a"))
    by = [key, "_row"]
    names = F.array_sort(F.collect_list(F.struct("rank", F.get(vocab.groups_array(), F.col("idx")).alias("g"))))  # three at most
    score = F.sum(F.col("weight") / (F.lit(1.0) + F.exp(-F.col("logit"))))
    out = asked.groupBy(*by).agg(F.count(F.lit(1)).alias("n_groups"), F.array_join(F.transform(names, lambda x: x["g"]), ",").alias("groups"),
                                 score.alias("score"))
    # a group without training rows answers 0.5: a score above the threshold by rounding only does not count
    return out.select(key, "n_groups", "groups", "score", (F.round("score", 12) > F.lit(threshold)).cast("int").alias("prediction"))
