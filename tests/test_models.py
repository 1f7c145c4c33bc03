"""Models: NB against a brute-force Python fit on a small fixture; Spark ML fits."""

import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from tenor import vocab
from tenor.functions import text as text_fn
from tenor.operators import gradient, naive_bayes
from tenor.plans import bindings, models

from tenor.session import scratch_path

from conftest import SF_SMALL

TOK = re.compile(r"[\s!\"#$%&'()*+,\-./:;<=>?@\[\\\]^_`{|}~]+")


def _tok(t):
    return [x for x in TOK.split(t.lower()) if x]


def test_nb_expert_matches_brute_force(spark):
    train = [("women", 1, "bad words here"), ("women", 0, "good words"), ("women", 0, "fine day"),
             ("jews", 1, "awful"), ("jews", 0, "nice nice day")]
    docs = [(1, "bad day nice"), (2, "unknown"), (3, "")]
    tdf = spark.createDataFrame(train, "target string, label int, text string")
    ddf = spark.createDataFrame(docs, "doc_id long, text string")
    model = naive_bayes.nb_fit(tdf)
    got = {(r["doc_id"], r["target"]): r["p_hate"] for r in naive_bayes.nb_score(ddf, model).collect()}
    for g in ("women", "jews"):
        rows = [(y, _tok(t)) for gg, y, t in train if gg == g]
        c = {y: Counter(w for yy, ws in rows for w in ws if yy == y) for y in (0, 1)}
        vg = set(c[0]) | set(c[1])
        n = {y: sum(1 for yy, _ in rows if yy == y) for y in (0, 1)}
        big = {y: sum(c[y].values()) for y in (0, 1)}
        for d, text in docs:
            logit = math.log((n[1] + 1) / (len(rows) + 2)) - math.log((n[0] + 1) / (len(rows) + 2))
            for w in _tok(text):
                if w in vg:
                    logit += math.log((c[1][w] + 1) / (big[1] + len(vg))) - math.log((c[0][w] + 1) / (big[0] + len(vg)))
            assert abs(got[(d, g)] - 1 / (1 + math.exp(-logit))) < 1e-12
    # a group without training rows is uninformed
    assert abs(got[(1, "asian")] - 0.5) < 1e-12


def test_score_corpus_weights_and_coverage(spark):
    c = bindings.corpus(spark, SF_SMALL)
    train = c.select("target", (F.col("tone") == "hate").cast("int").alias("label"), "text")
    docs = bindings.table(spark, SF_SMALL, "documents").select("doc_id", "text")
    out = naive_bayes.score_corpus(docs, naive_bayes.nb_fit(train))
    assert out.count() == docs.count()
    assert out.where((F.col("n_groups") < 1) | (F.col("n_groups") > 3)).count() == 0
    assert out.where((F.col("score") < 0) | (F.col("score") > 1)).count() == 0


def _nb_case(spark):
    c = bindings.corpus(spark, SF_SMALL)
    train = c.select("target", (F.col("tone") == "hate").cast("int").alias("label"), "text")
    docs = bindings.table(spark, SF_SMALL, "documents").select("doc_id", "text").unionByName(
        spark.range(900, 1400).selectExpr("id AS doc_id", "IF(id % 3 = 0, NULL, IF(id % 2 = 0, '', 'zzunknown')) AS text"))
    return docs, naive_bayes.nb_fit(train)


def test_nb_packed_and_joined_models_agree(spark):
    """The broadcast arrays and the joined table give the same scores, also of null, empty and unknown texts."""
    docs, model = _nb_case(spark)
    score = lambda n: {(r["doc_id"], r["target"]): r["p_hate"] for r in naive_bayes.nb_score(docs, model, limit=n).collect()}
    a, b = score(None), score(0)
    assert len(a) == 11 * docs.count() and a.keys() == b.keys() and all(abs(a[k] - b[k]) < 1e-9 for k in a)
    whole = lambda n: {r["doc_id"]: tuple(r)[1:] for r in naive_bayes.score_corpus(docs, model, limit=n).collect()}
    a, b = whole(None), whole(0)
    assert a.keys() == b.keys() and all(a[k][:2] == b[k][:2] and a[k][3] == b[k][3] and abs(a[k][2] - b[k][2]) < 1e-9 for k in a)


def test_nb_head_and_rest_agree_with_the_packed_model(spark):
    """A model of which only the frequent tokens fit a broadcast gives every row its scores, also rows whose key repeats or is null,
    and what is joined is the rest of the model, not every token of every (document, group)."""
    docs, model = _nb_case(spark)
    docs = docs.unionByName(docs.where("doc_id % 5 = 0")).unionByName(docs.where("doc_id % 7 = 0").selectExpr("NULL AS doc_id", "text"))
    rounded = lambda df: sorted(tuple(str(round(x, 9) if isinstance(x, float) else x) for x in r) for r in df.collect())
    naive_bayes.pack(model)
    want = rounded(naive_bayes.nb_score(docs, model)), rounded(naive_bayes.score_corpus(docs, model))
    assert len(want[0]) == 11 * docs.count() and len(want[1]) == docs.count()
    for limit in (0, model["bytes"] // 10):
        head, rest = naive_bayes.head_and_rest(model, limit)
        assert len(head.tokens) + rest.count() == model["dense"].count() and (len(head.tokens) > 0) == (limit > 0)
        scored = naive_bayes.nb_score(docs, model, limit=limit)
        assert rounded(scored) == want[0]
        assert rounded(naive_bayes.score_corpus(docs, model, limit=limit)) == want[1]
    held = docs.select(F.monotonically_increasing_id().alias("r"), F.explode(text_fn.tokens("text")).alias("t")).distinct().count()
    met = [n for name, _, n in _nodes(scored._jdf.queryExecution().executedPlan()) if name.endswith("Join")]
    assert met and max(met) < held


def _exchanged(plan):
    """(own text, rows written) of every shuffle of an executed plan."""
    seq, out = plan.children(), []
    if plan.nodeName() == "AdaptiveSparkPlan":
        return _exchanged(plan.executedPlan())
    if plan.nodeName().endswith("QueryStage"):
        return _exchanged(plan.plan())
    if plan.nodeName() == "Exchange":
        out.append((plan.verboseString(1000), plan.metrics().get("shuffleRecordsWritten").get().value()))
    for i in range(seq.size()):
        out += _exchanged(seq.apply(i))
    return out


def test_rest_of_a_model_moves_one_row_per_document_and_token(spark):
    """What the rest of a large model sends to the documents does not grow with the groups that know a token, and adds up to the same weights."""
    docs, model = _nb_case(spark)
    pairs = docs.select("doc_id", F.explode(text_fn.tokens("text")).alias("t")).distinct()
    known = pairs.join(model["counts"].select(F.col("token").alias("t"), "target").distinct(), "t")
    want, wide = known.select("doc_id", "t").distinct().count(), known.count()
    assert docs.count() == docs.select("doc_id").distinct().count() and wide > 2 * want
    for scored in (naive_bayes.nb_score(docs, model, limit=0), naive_bayes.score_corpus(docs, model, limit=0)):
        scored.collect()
        moved = [n for text, n in _exchanged(scored._jdf.queryExecution().executedPlan()) if "hashpartitioning(_row" in text]
        assert max(moved) == want


def test_rest_counts_are_exact_up_to_their_limit(spark):
    """Counts travel as bits: the largest that a token outside the head may have come back as they were."""
    top = (1 << naive_bayes.COUNT_BITS) - 1
    zero = {f"{c}{g}": 0 for c in ("k", "c1_", "c0_") for g in range(naive_bayes.G)}
    rest = spark.createDataFrame([{"token": "t"} | zero | {"k0": 1, "c1_0": top, "k10": 1, "c0_10": top, "c1_10": 3}],
                                 "token string, " + ", ".join(f"{c} long" for c in zero))
    parts = spark.createDataFrame([("t", [7, 8], [1, 2]), ("u", [9], [1])], "token string, rows array<long>, tfs array<int>")
    shift = [0.5 + g for g in range(naive_bayes.G)]
    got = {r["_row"]: r for r in naive_bayes.rest_sums(parts, rest, {"kconst": shift}, "a", "r").collect()}
    assert got.keys() == {7, 8} and [got[k]["n"] for k in (7, 8)] == [1, 2]
    for k, tf in ((7, 1), (8, 2)):
        want_a = [0.0] * naive_bayes.G
        want_r = [0.0] * naive_bayes.G
        want_a[0], want_a[10] = tf * (math.log(top + 1) + 0.5), tf * (math.log(4) - math.log(top + 1) + 10.5)
        want_r[0], want_r[10] = tf * math.log(top + 1), tf * math.log(top + 4)
        assert np.allclose(got[k]["a"], want_a, atol=1e-12) and np.allclose(got[k]["r"], want_r, atol=1e-12)


def test_head_pass_takes_in_a_bounded_number_of_texts(spark):
    """Beside the head of a large model a task holds few whole texts: a token of all rows is collected once a batch; the setting is set back."""
    _, model = _nb_case(spark)
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    docs = spark.range(0, 2 * naive_bayes.BATCH_ROWS + 1, 1, 1).selectExpr("id AS doc_id", "'zzunknown' AS text")
    head, _ = naive_bayes.head_and_rest(model, model["dense"].count())
    parts = naive_bayes.head_pass(docs, spark.sparkContext.broadcast(head), lambda m: m.router, True, "doc_id")
    assert [parts.where(f"token IS {x} NULL").count() for x in ("", "NOT")] == [docs.count(), 3] and spark.conf.get(name) == before


def _nodes(plan):
    """(name, own text, rows out) of every node of an executed plan."""
    out, seq = [], plan.children()
    if plan.nodeName() == "AdaptiveSparkPlan":
        return _nodes(plan.executedPlan())
    if plan.nodeName().endswith("QueryStage"):
        return _nodes(plan.plan())
    m = plan.metrics().get("numOutputRows")
    out.append((plan.nodeName(), plan.verboseString(1000), m.get().value() if m.isDefined() else None))
    for i in range(seq.size()):
        out += _nodes(seq.apply(i))
    return out


def test_experts_meet_retained_pairs_only_and_no_text_moves(spark):
    """Rows that reach the experts = rows of E3 (from the plan's metrics); the exchange holds neither texts nor tokens."""
    docs, model = _nb_case(spark)
    for limit in (None, 0):
        out = naive_bayes.score_corpus(docs, model, limit=limit)
        want = sum(r["n_groups"] for r in out.collect())
        nodes = _nodes(out._jdf.queryExecution().executedPlan())
        pairs = [n for name, text, n in nodes if name == "Generate" and "posexplode" in text]
        assert pairs and set(pairs) == {want}
        if limit is None:
            moved = [text for name, text, _ in nodes if name == "Exchange"]
            assert len(moved) == 1 and "hashpartitioning(doc_id" in moved[0]
    assert want < 11 * docs.count() / 3


def signal_corpus(spark, n=600):
    rows = []
    for i in range(n):
        g, y = ("women", "jews", "asian")[i % 3], (i // 3) % 2
        rows.append((i, "hate" if y else "neutral", g, f"{'awful bad' if y else 'kind nice'} {g} word{i % 17} id{i}"))
    return spark.createDataFrame(rows, "doc_id long, tone string, target string, text string")


def test_router_frame_makes_the_group_ids_once(spark):
    """Class weights, test set and training part read the stored group-id table: the job that makes it runs once."""
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    ids = signal_corpus(spark, 60).join(vocab.groups_df(spark), "target").select("target_id", "text")
    frame = models.router_frame(ids.mapInArrow(count, ids.schema))
    assert frame.where("split = 'train'").count() == 60 and seen.value == 60


def test_tasks_work_on_slices_and_features_travel_once(spark):
    """A batch is worked on in slices of a bounded number of features; a scored row carries its features once."""
    sizes = [gradient.ENTRIES // 2, gradient.ENTRIES // 2, 7, 0, 2 * gradient.ENTRIES, 1]
    batch = pa.RecordBatch.from_pydict({"id": list(range(6)), "idx": [np.zeros(n, np.int32) for n in sizes]})
    parts = list(gradient.sliced(iter([batch]), "idx"))
    assert [i for p in parts for i in p.column("id").to_pylist()] == list(range(6))
    assert all(p.num_rows == 1 or len(p.column("idx").flatten()) <= gradient.ENTRIES for p in parts) and len(parts) > 3
    c = signal_corpus(spark, 60)
    router = models.fit_router(c.join(vocab.groups_df(spark), "target").select("target_id", "text"), rounds=1)[0]
    rows = gradient.add_features(c).select("doc_id", F.lit(0).alias("block"), "idx")
    kept = {r["doc_id"]: r["idx"] for r in gradient.logits(rows, router, features=True).collect()}
    assert kept == {r["doc_id"]: r["idx"] for r in rows.collect()}


def test_fits_beat_the_majority(spark):
    """Teacher, students, router, sweep and rounds on a corpus with a signal: better than the majority class."""
    c = signal_corpus(spark)
    model, report = models.fit_teacher(c)
    r = report.first()
    assert r["n_train"] + r["n_test"] == 600 and r["accuracy"] > 0.9 and r["loss"] < math.log(2)
    fitted, frame, students = models.fit_students(c, model)
    students = {r["target"]: r for r in students.collect()}
    assert len(students) == len(vocab.GROUPS)
    assert all(students[g]["fitted"] and students[g]["accuracy"] > 0.8 for g in ("women", "jews", "asian"))
    assert not students["arab"]["fitted"] and students["arab"]["loss"] is None
    ids = c.join(vocab.groups_df(spark), "target").select("target_id", "text")
    router, rep = models.fit_router(ids)
    assert rep.first()["accuracy"] > 0.6  # three equal classes
    scored = {r["doc_id"]: r for r in models.score_fitted(c, router, fitted).collect()}
    assert len(scored) == 600 and all(1 <= r["n_groups"] <= 3 for r in scored.values())
    assert sum(scored[i]["prediction"] == (i // 3) % 2 for i in range(600)) > 500
    sweep = models.sweep(c, model, group="women").collect()
    assert len(sweep) == len(vocab.SWEEP_ALPHAS) and all(r["accuracy"] > 0.8 for r in sweep)
    log = {(r["epoch"], r["mode"], r["metric"]): r["value"] for r in models.evaluate_rounds(frame, fitted).collect()}
    assert len(log) == models.ROUNDS * 6 and log[5, "train", "loss"] < log[1, "train", "loss"]
    assert all(models.sweep(c, model, group="arab").select("accuracy").first()[0] is None for _ in range(1))


def _rows(spark, n=300, features=50, seed=1, blocks=3):
    import numpy as np
    rng = np.random.default_rng(seed)
    out = []
    for i in range(n):
        idx = rng.integers(0, features, rng.integers(0, 12)).tolist()
        out.append((i, int(rng.integers(blocks)), int(sum(idx) % 2), float(rng.uniform(0.5, 2)), idx, rng.normal(0, 2, 2).tolist()))
    return spark.createDataFrame(out, "id long, block int, gold int, weight double, idx array<int>, teacher array<double>").repartition(5)


def test_slopes_equal_finite_differences():
    import numpy as np
    rng = np.random.default_rng(2)
    z, teacher = rng.normal(0, 3, (40, 2)), rng.normal(0, 3, (40, 2))
    gold, block = rng.integers(0, 2, 40), rng.integers(0, 3, 40)
    for loss in (gradient.cross_entropy, gradient.distillation(0.25, 2.0), gradient.distillation([0.1, 0.5, 0.9], 0.7)):
        value, slope = loss(z, gold, teacher, block)
        for k in range(2):
            d = np.zeros((40, 2))
            d[:, k] = 1e-6
            got = (loss(z + d, gold, teacher, block)[0] - loss(z - d, gold, teacher, block)[0]) / 2e-6
            assert np.abs(got - slope[:, k]).max() < 1e-6


def test_summed_gradient_equals_finite_differences(spark):
    import numpy as np
    shape, loss = gradient.Shape(3, 2, 50), gradient.distillation(0.25, 2.0)
    rows = _rows(spark)
    w = np.random.default_rng(3).normal(0, 0.3, (3 * 51, 2))
    g, lost, weight = gradient.gradient(rows, shape, loss, w)
    data = rows.collect()
    assert abs(weight.sum() - sum(r["weight"] for r in data)) < 1e-9

    def plain(w):
        """Mean loss by block, row by row."""
        total = np.zeros(3)
        for r in data:
            at = [r["block"] * 51 + i for i in r["idx"]]
            z = w[r["block"] * 51 + 50] + (w[at].sum(axis=0) / math.sqrt(len(at)) if at else 0)
            total[r["block"]] += r["weight"] * loss(z[None], np.array([r["gold"]]), np.array([r["teacher"]]), np.array([r["block"]]))[0][0]
        return total / weight

    assert np.abs(lost - plain(w)).max() < 1e-9
    for at, k in [(0, 0), (7, 1), (50, 0), (51 + 3, 1), (101, 1), (152, 0), (120, 0)]:
        d = np.zeros_like(w)
        d[at, k] = 1e-5
        want = (plain(w + d) - plain(w - d))[at // 51] / 2e-5
        assert abs(g[at, k] - want) < 1e-7


def test_joint_fit_equals_separate_fits_and_any_partitioning(spark):
    import numpy as np
    loss = gradient.distillation(0.25, 2.0)
    rows = _rows(spark).persist()
    joint = gradient.fit(rows, gradient.Shape(3, 2, 50), loss, 4).weights(spark).reshape(3, 51, 2)
    again = gradient.fit(rows.repartition(1), gradient.Shape(3, 2, 50), loss, 4).weights(spark).reshape(3, 51, 2)
    assert np.abs(joint - again).max() < 1e-9
    for b in range(3):
        alone = rows.where(F.col("block") == b).withColumn("block", F.lit(0))
        assert np.abs(gradient.fit(alone, gradient.Shape(1, 2, 50), loss, 4).weights(spark) - joint[b]).max() < 1e-9
    plain = gradient.fit(rows, gradient.Shape(3, 2, 50), gradient.cross_entropy, 3).weights(spark)
    assert np.abs(plain - gradient.fit(rows, gradient.Shape(3, 2, 50), gradient.distillation(0.0, 2.0), 3).weights(spark)).max() < 1e-9


def test_interrupted_fit_goes_on(spark):
    import numpy as np
    shape, loss, rows = gradient.Shape(3, 2, 50), gradient.distillation(0.25, 2.0), _rows(spark).persist()
    whole = gradient.fit(rows, shape, loss, 5)
    path = scratch_path(spark, "t-rounds")
    calls = []

    def counted(*a):
        calls.append(1)
        if len(calls) > 2:
            raise RuntimeError("lost")
        return real(*a)

    real = gradient.gradient
    gradient.gradient = counted
    try:
        gradient.fit(rows, shape, loss, 5, path=path)
    except RuntimeError:
        pass
    finally:
        gradient.gradient = real
    spark.createDataFrame([], gradient.STATE).write.parquet(f"{path}/round-3")  # a round that was not written as a whole
    calls.clear()
    gradient.gradient = lambda *a: (calls.append(1), real(*a))[1]
    try:
        resumed = gradient.fit(rows, shape, loss, 5, path=path)
    finally:
        gradient.gradient = real
    assert len(calls) == 3 and np.abs(resumed.weights(spark) - whole.weights(spark)).max() < 1e-9
    series = lambda m: [(r.epoch, r.block, round(r.loss, 9)) for r in m.history(spark).orderBy("epoch", "block").collect()]
    assert series(resumed) == series(whole) and len(series(whole)) == 15


def test_rounds_follow_the_stored_logits(spark):
    """D13 in DuckDB SQL over the stored logits of every round equals the loss each gradient was taken at."""
    import duckdb
    c = signal_corpus(spark, 240)
    teacher, _ = models.fit_teacher(c)
    model, frame, _ = models.fit_students(c, teacher)
    path = scratch_path(spark, "t-scores")
    models.round_scores(frame.where("split = 'train'"), model).select("epoch", "block", "gold", "logits", "teacher").write.parquet(path)
    sql = f"""
    WITH l AS (SELECT epoch, block, gold, logits[1] AS s0, logits[2] AS s1, teacher[1] AS t0, teacher[2] AS t1 FROM read_parquet('{path}/*.parquet')),
    p AS (SELECT epoch, block, CASE WHEN gold = 1 THEN ln(1 + exp(s0 - s1)) ELSE ln(1 + exp(s1 - s0)) END AS ce,
                 1 / (1 + exp((t0 - t1) / 2)) AS q, 1 / (1 + exp((s0 - s1) / 2)) AS u FROM l)
    SELECT epoch, block, avg(0.75 * ce + 0.25 * 4 * (q * ln(q / u) + (1 - q) * ln((1 - q) / (1 - u)))) FROM p GROUP BY epoch, block"""
    want = {(e, b): x for e, b, x in duckdb.sql(sql).fetchall()}
    history = {(r["epoch"], r["block"]): r["loss"] for r in model.history(spark).collect()}
    assert len(history) == 3 * models.ROUNDS
    for (e, b), x in history.items():  # a round's gradient is taken at the weights of the round before
        if e > 1:
            assert abs(x - want[e - 1, b]) < 1e-9
    assert all(want[e + 1, b] < want[e, b] for e, b in want if e < models.ROUNDS)


def test_plan_of_routed_scoring_has_no_text_shuffle(spark):
    c = signal_corpus(spark, 60)
    teacher, _ = models.fit_teacher(c, rounds=1)
    students = models.fit_students(c, teacher, rounds=1)[0]
    router = models.fit_router(c.join(vocab.groups_df(spark), "target").select("target_id", "text"), rounds=1)[0]
    plan = models.score_fitted(c, router, students)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(doc_id") == 1 and plan.count("Exchange") == 1
