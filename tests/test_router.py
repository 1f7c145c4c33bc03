"""Router (E2-E4, F1, H6-H8): quirk cases on hand-written probability rows."""

import math

from pyspark.sql import functions as F

from tenor import vocab
from tenor.functions import probs
from tenor.operators import routing
from tenor.plans import bindings

from conftest import SF_MID

G = vocab.GROUPS


def _route(spark, p):
    df = spark.createDataFrame([(1, [float(x) for x in p])], "k long, p array<double>")
    r = df.select(probs.normalize_weights(probs.route("p")).alias("w")).first()["w"]
    return [(G[x["idx"]], x["weight"]) for x in r]


def _p(**kw):
    p = [0.0] * 11
    for g, v in kw.items():
        p[G.index(g)] = v
    rest = 1.0 - sum(kw.values())
    free = [i for i in range(11) if G[i] not in kw]
    for i in free:
        p[i] = rest / len(free)
    return p


def test_fallback_when_top_below_min(spark):
    p = [1 / 11] * 11
    assert _route(spark, p) == [("others", 1.0)]


def test_top_exactly_min_proba_is_not_fallback(spark):
    p = _p(women=0.2, jews=0.19, asian=0.18)
    out = _route(spark, p)
    assert out[0][0] == "women" and len(out) == 3


def test_cumulative_exactly_half_stops(spark):
    # 0.25 + 0.25 = 0.5 -> the third class is not taken (total must be < 0.5)
    p = _p(black=0.25, lgbtq=0.25, latino=0.2)
    out = _route(spark, p)
    assert [g for g, _ in out] == ["black", "lgbtq"]
    assert abs(sum(w for _, w in out) - 1.0) < 1e-12


def test_at_most_three(spark):
    p = _p(women=0.21, jews=0.1, asian=0.1, black=0.1)
    out = _route(spark, p)
    assert len(out) == 3


def test_ties_in_vocabulary_order(spark):
    # two classes tie at 0.5: the lower class index is taken, then the total reaches 0.5
    p = [0.0] * 11
    p[G.index("arab")] = 0.5
    p[G.index("jews")] = 0.5
    assert _route(spark, p) == [("jews", 1.0)]


def test_ties_take_both_until_threshold(spark):
    out = _route(spark, _p(arab=0.3, jews=0.3))
    assert [g for g, _ in out] == ["jews", "arab"]
    assert all(abs(w - 0.5) < 1e-12 for _, w in out)


def test_single_dominant_group(spark):
    out = _route(spark, _p(muslim=0.9))
    assert out == [("muslim", 1.0)]


def test_softmax_sums_to_one_and_matches_python(spark):
    logits = [0.5, -1.0, 3.0, 2.0, 0.0, 0.1, -0.2, 1.5, 2.5, -3.0, 0.7]
    df = spark.createDataFrame([(logits,)], "l array<double>")
    p = df.select(probs.softmax("l").alias("p")).first()["p"]
    m = max(logits)
    e = [math.exp(x - m) for x in logits]
    ref = [x / sum(e) for x in e]
    assert all(abs(a - b) < 1e-12 for a, b in zip(p, ref))
    t = df.select(probs.softmax("l", 2.0).alias("p")).first()["p"]
    e2 = [math.exp((x - m) / 2.0) for x in logits]
    assert all(abs(a - b / sum(e2)) < 1e-12 for a, b in zip(t, e2))


def test_argmax_first_on_ties(spark):
    df = spark.createDataFrame([([1.0, 3.0, 3.0, 0.0],)], "a array<double>")
    assert df.select(probs.argmax("a").alias("i")).first()["i"] == 1


def test_p_binary(spark):
    df = spark.createDataFrame([(0.3, 1.2)], "a double, b double")
    v = df.select(probs.p_binary("a", "b").alias("p")).first()["p"]
    assert abs(v - math.exp(1.2) / (math.exp(0.3) + math.exp(1.2))) < 1e-12


def test_weights_properties_on_binding(spark):
    p = bindings.proba(spark, SF_MID).withColumn("p", probs.softmax("router"))
    w = routing.normalize_weights(p, "vec_id", "p")
    agg = w.groupBy("vec_id").agg(F.sum("weight").alias("s"), F.count("*").alias("n"))
    bad = agg.where((F.abs(F.col("s") - 1) > 1e-9) | (F.col("n") > 3) | (F.col("n") < 1)).count()
    assert bad == 0


def test_array_form_equals_window_form(spark):
    """E3 by array expressions == E3 by row_number + running-sum window."""
    from pyspark.sql import Window as W
    base = bindings.proba(spark, SF_MID).withColumn("p", probs.softmax("router"))
    arr = routing.route_topk(base, "vec_id", "p").select("vec_id", "target", "p")
    long = base.select("vec_id", F.posexplode("p").alias("idx", "p"))
    w = W.partitionBy("vec_id").orderBy(F.col("p").desc(), "idx")
    ranked = (long.withColumn("rn", F.row_number().over(w) - 1)
              .withColumn("before", F.coalesce(F.sum("p").over(w.rowsBetween(W.unboundedPreceding, -1)), F.lit(0.0)))
              .withColumn("top", F.max("p").over(W.partitionBy("vec_id"))))
    kept = ranked.where((F.col("top") >= 0.2) & (F.col("rn") < 3) & (F.col("before") < 0.5)) \
        .select("vec_id", F.get(vocab.groups_array(), F.col("idx")).alias("target"), "p")
    fb = ranked.where((F.col("top") < 0.2) & (F.col("idx") == 10)).select(
        "vec_id", F.lit("others").alias("target"), F.lit(1.0).alias("p"))
    win = kept.unionByName(fb)
    a = sorted((r[0], r[1], round(r[2], 9)) for r in arr.collect())
    b = sorted((r[0], r[1], round(r[2], 9)) for r in win.collect())
    assert a == b


def test_mixture_join_form_equals_array_form(spark):
    base = bindings.proba(spark, SF_MID).withColumn("p", probs.softmax("router"))
    weights = routing.normalize_weights(base, "vec_id", "p")
    experts = routing.expert_scores_long(base, "vec_id", "l0", "l1")
    m = routing.mixture_score(routing.route_expert_join(weights, experts, "vec_id"), "vec_id")
    a = routing.score_routed(bindings.proba(spark, SF_MID), "vec_id", "router", "l0", "l1")
    x = {r["vec_id"]: (round(r["score"], 9), r["prediction"]) for r in m.collect()}
    y = {r["vec_id"]: (round(r["score"], 9), r["prediction"]) for r in a.collect()}
    assert x == y
