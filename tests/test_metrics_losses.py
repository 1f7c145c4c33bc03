"""Metrics (D8-D11, D14) and losses (D12, D13) against plain-Python references."""

import math

from tenor.operators import losses, metrics


def _ref_prf(gold, pred):
    classes = sorted(set(gold) | set(pred))
    out = {}
    for c in classes:
        tp = sum(1 for g, p in zip(gold, pred) if g == c and p == c)
        sup = sum(1 for g in gold if g == c)
        prd = sum(1 for p in pred if p == c)
        pr = tp / prd if prd else 0.0
        rc = tp / sup if sup else 0.0
        f = 2 * tp / (sup + prd) if sup + prd else 0.0
        out[c] = (sup, pr, rc, f)
    return out


def test_weighted_and_macro(spark):
    gold = [0, 0, 1, 1, 1, 2, 2, 0]
    pred = [0, 1, 1, 1, 0, 2, 1, 3]
    df = spark.createDataFrame(list(zip(gold, pred)), "gold int, prediction int")
    ref = _ref_prf(gold, pred)
    n = len(gold)
    w = metrics.weighted_metrics(df).first()
    assert abs(w["accuracy"] - sum(g == p for g, p in zip(gold, pred)) / n) < 1e-12
    assert abs(w["f1"] - sum(v[0] * v[3] for v in ref.values()) / n) < 1e-12
    m = metrics.macro_f1(df).first()
    assert m["n_classes"] == 4  # class 3 only predicted: counted (present in predictions)
    assert abs(m["macro_f1"] - sum(v[3] for v in ref.values()) / 4) < 1e-12


def test_binary_zero_division(spark):
    df = spark.createDataFrame([(0, 0), (0, 0)], "gold int, prediction int")
    b = metrics.binary_metrics(df).first()
    assert b["accuracy"] == 1.0 and b["f1"] == 0.0 and b["precision"] == 0.0


def test_batch_means(spark):
    df = spark.createDataFrame([(0, 1, 1), (0, 0, 1), (1, 1, 1)], "batch_id int, gold int, prediction int")
    r = metrics.batch_mean_metrics(df, by=()).first()
    assert r["n_batches"] == 2 and abs(r["mean_accuracy"] - 0.75) < 1e-12
    both = df.selectExpr("*", "1 AS epoch", "'train' AS mode").unionByName(df.selectExpr("batch_id", "gold", "gold AS prediction", "1 AS epoch", "'eval' AS mode"))
    got = {(r["epoch"], r["mode"]): r["mean_accuracy"] for r in metrics.batch_mean_metrics(both).collect()}
    assert got == {(1, "train"): 0.75, (1, "eval"): 1.0}


def test_log_series(spark):
    log = spark.createDataFrame([(0, "train", "loss", 1.0), (0, "eval", "f1", 0.5), (1, "train", "loss", 0.5)],
                                "epoch int, mode string, metric string, value double")
    out = {r["epoch"]: r for r in metrics.log_series(log).collect()}
    assert out[0]["train_loss"] == 1.0 and out[0]["eval_f1"] == 0.5 and out[1]["eval_f1"] is None
    assert metrics.log_series(log).columns == ["epoch", "train_loss", "train_acc", "train_f1", "eval_loss",
                                               "eval_acc", "eval_f1"]


def _sm(v, t=1.0):
    m = max(v)
    e = [math.exp((x - m) / t) for x in v]
    return [x / sum(e) for x in e]


def test_cross_entropy(spark):
    data = [([0.2, 1.0], [1.0, -1.0], 1), ([0.5, 0.1], [0.3, 0.2], 0), ([2.0, 0.0], [0.0, 2.0], 0)]
    df = spark.createDataFrame(data, "student array<double>, teacher array<double>, gold int")
    nll = [-math.log(_sm(s)[g]) for s, _, g in data]
    ce = losses.cross_entropy(df).first()
    assert abs(ce["ce"] - sum(nll) / 3) < 1e-12
    # class weights = relative frequency: class 0 weight 2/3, class 1 weight 1/3
    w = [1 / 3 if g == 1 else 2 / 3 for _, _, g in data]
    assert abs(ce["ce_weighted"] - sum(a * b for a, b in zip(w, nll)) / sum(w)) < 1e-12


def test_distillation_forms(spark):
    data = [([0.2, 1.0], [1.0, -1.0], 1), ([0.5, 0.1], [0.3, 0.2], 0)]
    df = spark.createDataFrame(data, "student array<double>, teacher array<double>, gold int")
    a, t = 0.25, 2.0
    ce = sum(-math.log(_sm(s)[g]) for s, _, g in data) / 2
    kl = sum(sum(q * (math.log(q) - math.log(p)) for q, p in zip(_sm(tt, t), _sm(s, t))) for s, tt, _ in data) / 2
    klr = sum(sum(q * (math.log(q) - p) for q, p in zip(_sm(tt, t), _sm(s, t))) for s, tt, _ in data) / 2
    r = losses.distillation_loss(df, alpha=a, temperature=t).first()
    assert abs(r["kl"] - kl) < 1e-12 and abs(r["kl_raw"] - klr) < 1e-12
    assert abs(r["loss"] - ((1 - a) * ce + a * t * t * kl)) < 1e-12
    assert abs(r["loss_raw"] - ((1 - a) * ce + a * t * t * klr)) < 1e-12


def test_distillation_loss_with_an_underflowed_teacher(spark):
    """A teacher probability of 0 adds nothing and the row stays in the mean."""
    import math

    from tenor.operators import losses
    rows_ = [([2000.0, 0.0], [0.0, 1.0], 0), ([0.5, -0.5], [0.2, 0.1], 1)]
    df = spark.createDataFrame(rows_, "teacher array<double>, student array<double>, gold int")
    got = losses.distillation_loss(df, temperature=2.0).first()

    def soft(z):
        m = max(z)
        e = [math.exp((x - m) / 2.0) for x in z]
        return [x / sum(e) for x in e]
    kl = [sum(q * (math.log(q) - math.log(p)) for q, p in zip(soft(t), soft(s)) if q > 0) for t, s, _ in rows_]
    assert abs(got["kl"] - sum(kl) / 2) < 1e-9
