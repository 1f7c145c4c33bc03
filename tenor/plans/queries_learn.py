"""Registered model queries: Naive-Bayes experts and router (I1, I2, I9), and the models fitted in rounds."""

from __future__ import annotations

from tenor import vocab
from tenor.operators import clean, metrics, naive_bayes
from tenor.operators import corpus as corpus_ops
from tenor.plans import bindings, models
from tenor.plans.contract import r6, register
from tenor.plans.oracle import tokens_sql, with_ctes
from tenor.plans.oracle_fit import DEFS
from tenor.plans.queries_scoring import class_table_sql
from tenor.session import scratch_path


def nb_train(spark, sf_dir):
    """Training rows of the NB models: the mapped corpus, label 1 = hate."""
    c = bindings.corpus(spark, sf_dir)
    return c.select("target", clean.tone_label("tone").alias("label"), "text")


def nb_docs(spark, sf_dir):
    """Documents to score: every document, whole text. Scoring shuffles no text, so a table of a few files or
    row groups, which would keep a few cores busy, is dealt out first; a large one has splits enough."""
    docs, cores = bindings.table(spark, sf_dir, "documents").select("doc_id", "text"), spark.sparkContext.defaultParallelism
    return docs.repartition(2 * cores) if docs.rdd.getNumPartitions() < 4 * cores else docs


_NB = {
    "train": "SELECT target, CASE WHEN tone = 'hate' THEN 1 ELSE 0 END AS label, text FROM corpus",
    "tk": f"SELECT target, label, unnest({tokens_sql('text')}) AS token FROM train",
    "cnt": "SELECT target, label, token, count(*) AS n FROM tk GROUP BY target, label, token",
    "tot": "SELECT target, label, sum(n) AS big_n FROM cnt GROUP BY target, label",
    "vg": "SELECT target, count(DISTINCT token) AS v FROM cnt GROUP BY target",
    "gc": """
        SELECT g.target, g.target_id, coalesce(d.n1, 0) AS n1, coalesce(d.n0, 0) AS n0,
               coalesce(s.big_n1, 0) AS big_n1, coalesce(s.big_n0, 0) AS big_n0, coalesce(v.v, 0) AS v
        FROM groups g
        LEFT JOIN (SELECT target, count_if(label = 1) AS n1, count_if(label = 0) AS n0 FROM train GROUP BY target) d
          ON g.target = d.target
        LEFT JOIN (SELECT target, sum(CASE WHEN label = 1 THEN n ELSE 0 END) AS big_n1,
                          sum(CASE WHEN label = 0 THEN n ELSE 0 END) AS big_n0 FROM cnt GROUP BY target) s
          ON g.target = s.target
        LEFT JOIN vg v ON g.target = v.target""",
    "gk": """
        SELECT target, target_id,
               CASE WHEN n1 + n0 > 0 THEN ln((n1 + 1) / (n1 + n0 + 2)) - ln((n0 + 1) / (n1 + n0 + 2)) ELSE 0.0 END AS pl,
               CASE WHEN n1 + n0 > 0 THEN ln(big_n0 + v) - ln(big_n1 + v) ELSE 0.0 END AS kc,
               ln((n1 + n0 + 1) / ((SELECT count(*) FROM train) + 11)) AS lp,
               ln(big_n1 + big_n0 + (SELECT count(DISTINCT token) FROM cnt)) AS ld
        FROM gc""",
    "model": """
        SELECT target, token, ln(sum(CASE WHEN label = 1 THEN n ELSE 0 END) + 1)
                              - ln(sum(CASE WHEN label = 0 THEN n ELSE 0 END) + 1) AS a,
               ln(sum(n) + 1) AS r
        FROM cnt GROUP BY target, token""",
    "occ": f"SELECT doc_id, unnest({tokens_sql('text')}) AS token FROM documents",
    "sums": """
        SELECT o.doc_id, m.target, sum(m.a) AS sa, count(*) AS k, sum(m.r) AS sr
        FROM occ o JOIN model m ON o.token = m.token GROUP BY o.doc_id, m.target""",
    "nx": "SELECT doc_id, count(*) AS n_x FROM occ WHERE token IN (SELECT token FROM cnt) GROUP BY doc_id",
    "el": """
        SELECT d.doc_id, gk.target, gk.target_id,
               gk.pl + coalesce(s.sa, 0.0) + coalesce(s.k, 0) * gk.kc AS expert_logit,
               (gk.lp + coalesce(s.sr, 0.0) - coalesce(nx.n_x, 0) * gk.ld) / greatest(coalesce(nx.n_x, 0), 1) AS router
        FROM documents d CROSS JOIN gk
        LEFT JOIN sums s ON s.doc_id = d.doc_id AND s.target = gk.target
        LEFT JOIN nx ON nx.doc_id = d.doc_id""",
}


@register("nb_counts", with_ctes("""
SELECT c.target, c.label, c.token, c.n, round(ln((c.n + 1) / (t.big_n + v.v)), 6) AS loglik
FROM cnt c JOIN tot t ON c.target = t.target AND c.label = t.label JOIN vg v ON c.target = v.target""",
                                 "corpus", extra={k: _NB[k] for k in ("train", "tk", "cnt", "tot", "vg")}))
def nb_counts_q(spark, sf_dir):
    """Token counts per (group, label) and their smoothed log-likelihoods."""
    out = naive_bayes.nb_counts(nb_train(spark, sf_dir))
    return out.select("target", "label", "token", "n", r6("loglik").alias("loglik"))


@register("nb_score", with_ctes(
    "SELECT doc_id, target, round(1.0 / (1.0 + exp(-expert_logit)), 6) AS p_hate FROM el",
    "corpus", "groups", extra=_NB))
def nb_score_q(spark, sf_dir):
    """P(hate) of every document under every group's expert."""
    model = naive_bayes.nb_fit(nb_train(spark, sf_dir))
    out = naive_bayes.nb_score(nb_docs(spark, sf_dir), model)
    return out.select("doc_id", "target", r6("p_hate").alias("p_hate"))


_NB_DEPS = {"train": ("corpus",), "tk": ("train",), "cnt": ("tk",), "tot": ("cnt",), "vg": ("cnt",),
            "gc": ("groups", "train", "cnt", "vg"), "gk": ("gc", "train", "cnt"), "model": ("cnt",), "occ": (),
            "sums": ("occ", "model"), "nx": ("occ", "cnt"), "el": ("gk", "sums", "nx")}
_NB_DEFS = {k: (_NB_DEPS[k], v) for k, v in _NB.items()}
_I9_LONG = (("el",), """
    SELECT doc_id AS vec_id, target_id AS idx, router AS logit, 0.0 AS l0, expert_logit AS l1,
           0 AS gold, 0 AS label FROM el""")


@register("score_corpus", with_ctes("""
SELECT vec_id AS doc_id, n_groups, groups, round(score, 6) AS score, CAST(round(score, 12) > 0.5 AS INTEGER) AS prediction
FROM scored""", "scored", replace=dict(_NB_DEFS, proba_long=_I9_LONG)))
def score_corpus_q(spark, sf_dir):
    """Routed mixture over documents with fitted NB router and experts."""
    model = naive_bayes.nb_fit(nb_train(spark, sf_dir))
    out = naive_bayes.score_corpus(nb_docs(spark, sf_dir), model)
    return out.select("doc_id", "n_groups", "groups", r6("score").alias("score"), "prediction")


# --------------------------------------------------------------------------- I3-I7
# The oracles fit the same models round by round in SQL (``oracle_fit``), so losses, metrics and scores are checked as such.


def _fits(body: str, *names: str, extra: dict[str, str] | None = None) -> str:
    return with_ctes(body, *names, extra=extra, replace=DEFS, keep=True)


def _sizes_sql(rows: str, by: str = "") -> str:
    return f"SELECT {by}CAST(count_if(train) AS BIGINT) AS n_train, CAST(count_if(NOT train) AS BIGINT) AS n_test FROM {rows}"


_T, _A = vocab.DISTILL_TEMPERATURE, vocab.DISTILL_ALPHA
_MIX = f"(1 - {_A!r}::DOUBLE) * ce + {_A * _T * _T!r}::DOUBLE * kl"


@register("fit_teacher", _fits("""
SELECT s.n_train, s.n_test, round((SELECT avg(nll) FROM t_scored), 6) AS loss, round(sum(tp) / sum(support), 6) AS accuracy,
       round(sum(support * precision) / sum(support), 6) AS precision, round(sum(support * recall) / sum(support), 6) AS recall,
       round(sum(support * f1) / sum(support), 6) AS f1
FROM ct, n s GROUP BY s.n_train, s.n_test""", "corpus", "t_scored",
                               extra={"ct": class_table_sql("t_scored", "gold", "prediction"), "n": _sizes_sql("t_rows")}))
def fit_teacher_q(spark, sf_dir):
    """Binary teacher over the balanced pooled corpus: sizes, and loss and weighted metrics on the test part."""
    report = models.fit_teacher(bindings.corpus(spark, sf_dir))[1]
    return report.select("n_train", "n_test", *[r6(c).alias(c) for c in ("loss", "accuracy", "precision", "recall", "f1")])


def _distilled(spark, sf_dir):
    """(corpus, students, their frame, report)."""
    c = bindings.corpus(spark, sf_dir)
    return models.fit_students(c, models.fit_teacher(c)[0])


_LAST = {"last": f"""
    SELECT r.target, r.train, r.gold, l.ce, l.kl, l.prediction FROM s_scored l JOIN s_rows r ON l.rid = r.rid WHERE epoch = {models.ROUNDS}""",
         "lost": f"SELECT target, avg(ce) AS ce, avg(kl) AS kl, avg({_MIX}) AS loss FROM last WHERE train GROUP BY target",
         "ct": class_table_sql("(SELECT * FROM last WHERE NOT train)", "gold", "prediction", by="target"),
         "seen": "SELECT target, sum(tp) / sum(support) AS accuracy, coalesce(max(CASE WHEN c = 1 THEN f1 END), 0.0) AS f1 FROM ct GROUP BY target",
         "n": _sizes_sql("s_all GROUP BY target", "target, ")}


@register("fit_students", _fits("""
SELECT g.target, coalesce(n.n_train, 0) AS n_train, coalesce(n.n_test, 0) AS n_test, l.loss IS NOT NULL AS fitted,
       round(l.ce, 6) AS ce, round(l.kl, 6) AS kl, round(l.loss, 6) AS loss, round(a.accuracy, 6) AS accuracy, round(a.f1, 6) AS f1
FROM groups g LEFT JOIN n ON g.target = n.target LEFT JOIN lost l ON g.target = l.target LEFT JOIN seen a ON g.target = a.target""",
                                "corpus", "groups", "s_scored", extra=_LAST))
def fit_students_q(spark, sf_dir):
    """I4: one student per group on (1 - a) CE + a T^2 KL (alpha 0.25, T 2): sizes, the parts of the training loss, test metrics."""
    report = _distilled(spark, sf_dir)[2]
    return report.select("target", "n_train", "n_test", "fitted", *[r6(c).alias(c) for c in ("ce", "kl", "loss", "accuracy", "f1")])


@register("distill_rounds", _fits(f"""
SELECT r.target, l.epoch, CASE WHEN r.train THEN 'train' ELSE 'test' END AS split, count(*) AS n, round(avg(ce), 6) AS ce,
       round(avg(kl), 6) AS kl, round(avg({_MIX}), 6) AS loss
FROM s_scored l JOIN s_rows r ON l.rid = r.rid GROUP BY r.target, l.epoch, r.train""", "corpus", "groups", "s_scored"))
def distill_rounds_q(spark, sf_dir):
    """D13 of every student after every round, from the stored weights of that round."""
    model, frame, _ = _distilled(spark, sf_dir)
    out = models.distill_rounds(frame, model)
    return out.select("target", "epoch", "split", "n", *[r6(c).alias(c) for c in ("ce", "kl", "loss")])


@register("fit_router", _fits("""
SELECT (SELECT count(*) FROM r_rows) AS n_train, (SELECT count(*) FROM r_scored) AS n_test,
       round(sum(tp) / sum(support), 6) AS accuracy, round(avg(f1), 6) AS macro_f1 FROM ct""", "lines", "groups", "r_scored",
                              extra={"ct": class_table_sql("r_scored", "gold", "prediction")}))
def fit_router_q(spark, sf_dir):
    """11-class router with class weights over the group-id table; sizes, and metrics on the head test set."""
    report = models.fit_router(corpus_ops.gather_group_ids(bindings.lines(spark, sf_dir)))[1]
    return report.select("n_train", "n_test", r6("accuracy").alias("accuracy"), r6("macro_f1").alias("macro_f1"))


@register("score_fitted", _fits("""
SELECT vec_id AS doc_id, n_groups, groups, round(score, 6) AS score, CAST(round(score, 12) > 0.5 AS INTEGER) AS prediction
FROM scored""", "corpus", "lines", "scored"))
def score_fitted_q(spark, sf_dir):
    """Every document scored by the fitted router and students, from the weights they stored."""
    c = bindings.corpus(spark, sf_dir)
    _, students, router = models.corpus_models(spark, c, corpus_ops.gather_group_ids(bindings.lines(spark, sf_dir)), scratch_path(spark, "fitted"))
    out = models.score_fitted(bindings.table(spark, sf_dir, "documents"), router, students)
    return out.select("doc_id", "n_groups", "groups", r6("score").alias("score"), "prediction")


_ALPHAS = ", ".join(f"({i}, CAST({a} AS DOUBLE))" for i, a in enumerate(vocab.SWEEP_ALPHAS))
_ST = vocab.SWEEP_TEMPERATURE


@register("sweep", _fits(f"""
SELECT 'hyper' || v.i AS config, v.alpha, CAST({_ST} AS DOUBLE) AS temperature, round(l.loss, 6) AS loss,
       round(a.accuracy, 6) AS accuracy, round(a.f1, 6) AS f1
FROM (VALUES {_ALPHAS}) v(i, alpha) LEFT JOIN lost l ON v.i = l.block LEFT JOIN seen a ON v.i = a.block""", "corpus", "groups", "h_scored", extra={
    "last": "SELECT r.block, r.alpha, r.gold, l.ce, l.kl, l.prediction FROM h_scored l JOIN h_rows r ON l.rid = r.rid WHERE NOT r.train",
    "lost": f"SELECT block, avg((1 - alpha) * ce + alpha * {_ST * _ST!r}::DOUBLE * kl) AS loss FROM last GROUP BY block",
    "ct": class_table_sql("last", "gold", "prediction", by="block"),
    "seen": "SELECT block, sum(tp) / sum(support) AS accuracy, coalesce(max(CASE WHEN c = 1 THEN f1 END), 0.0) AS f1 FROM ct GROUP BY block"}))
def sweep_q(spark, sf_dir):
    """Nine alpha settings on one group (T 0.7), independent trials: test loss, accuracy and F1 of each."""
    c = bindings.corpus(spark, sf_dir)
    out = models.sweep(c, models.fit_teacher(c)[0])
    return out.select("config", "alpha", "temperature", *[r6(x).alias(x) for x in ("loss", "accuracy", "f1")])


_SERIES_SQL = {"rows_": """
    SELECT l.epoch, CASE WHEN r.train THEN 'train' ELSE 'eval' END AS mode, r.gold, l.prediction, l.ce, l.kl
    FROM s_scored l JOIN s_rows r ON l.rid = r.rid""",
               "keyed": "SELECT *, epoch || ':' || mode AS em FROM rows_",
               "ct": class_table_sql("keyed", "gold", "prediction", by="em"),
               "scores": "SELECT em, sum(tp) / sum(support) AS acc, avg(f1) AS f1 FROM ct GROUP BY em",
               "series": f"""
    SELECT k.epoch, k.mode, avg({_MIX}) AS loss, any_value(s.acc) AS acc, any_value(s.f1) AS f1
    FROM keyed k JOIN scores s ON k.em = s.em GROUP BY k.epoch, k.mode"""}


@register("evaluate_per_round", _fits("SELECT epoch, " + ", ".join(
    f"round(max(CASE WHEN mode = '{m}' THEN {x} END), 6) AS {m}_{x}" for m in ("train", "eval") for x in ("loss", "acc", "f1"))
    + " FROM series GROUP BY epoch", "corpus", "groups", "s_scored", extra=_SERIES_SQL))
def evaluate_per_round_q(spark, sf_dir):
    """The distilled students after every round: six series from the stored weights of the rounds."""
    model, frame, _ = _distilled(spark, sf_dir)
    s = metrics.log_series(models.evaluate_rounds(frame, model))
    return s.select("epoch", *[r6(c).alias(c) for c in s.columns if c != "epoch"])
