"""The fits of ``tenor.plans.models`` written in DuckDB SQL: features, logits, slopes and updates of every round as
CTEs, so that fitted scores, losses and metrics have an independent oracle."""

from __future__ import annotations

from tenor import vocab
from tenor.operators import gradient as G
from tenor.plans.models import ROUNDS, ROUTER, STUDENTS, TEACHER
from tenor.plans.oracle import hash_sql, tokens_sql

Defs = dict[str, tuple[tuple[str, ...], str]]
_A, _B = G.PAIR


def grams(source: str) -> str:
    """(rid, n, g): hashed words and word pairs of (rid, text)."""
    return f"""
    SELECT rid, CAST(len(gr) AS DOUBLE) AS n, unnest(gr) AS g FROM (
      SELECT rid, list_concat(list_transform(h, lambda x: x % {G.HASHED}),
                              list_transform(range(1, len(h)), lambda i: ((h[i] % {_A}) * {_B} + h[i + 1]) % {G.HASHED})) AS gr
      FROM (SELECT rid, list_transform({tokens_sql('text')}, lambda t: ('0x' || substring(md5(t), 1, 8))::BIGINT) AS h FROM {source}))"""


def features(rows: str, gram: str, d: int) -> str:
    return f"""
    SELECT r.rid, r.block, CAST(g.g % {d} AS BIGINT) AS idx, count(*) / sqrt(any_value(g.n)) AS x
    FROM {gram} g JOIN {rows} r ON g.rid = r.rid GROUP BY r.rid, r.block, g.g % {d}
    UNION ALL SELECT rid, block, {d}, 1.0 FROM {rows}"""


def linear(feats: str, weights: str) -> str:
    return f"""
    SELECT f.rid, w.k, sum(f.x * w.w) AS z FROM {feats} f JOIN {weights} w ON f.block = w.block AND f.idx = w.idx
    GROUP BY f.rid, w.k"""


def softmax(z: str, t: float = 1.0) -> str:
    """(rid, k, p, lp) of logits (rid, k, z) at a temperature."""
    return f"""
    SELECT rid, k, exp(u) / sum(exp(u)) OVER (PARTITION BY rid) AS p, u - ln(sum(exp(u)) OVER (PARTITION BY rid)) AS lp
    FROM (SELECT rid, k, (z - max(z) OVER (PARTITION BY rid)) / {t!r}::DOUBLE AS u FROM {z})"""


def rounds(p: str, features_n: int, classes: int, slope: str, deps: tuple[str, ...]) -> Defs:
    """CTEs of a fit over ``{p}_rows`` (rid, block, gold, weight, train, ...) and ``{p}_g``: weights ``{p}_w{r}`` and
    logits ``{p}_z{r}`` after every round. ``slope`` gives (rid, k, s) from ``{p}_rows`` and {z}."""
    rate, b1, b2 = G.RATE, G.BETA1, G.BETA2
    out: Defs = {
        f"{p}_f": ((f"{p}_rows", f"{p}_g"), features(f"{p}_rows", f"{p}_g", features_n)),
        f"{p}_n": ((f"{p}_rows",), f"SELECT block, sum(weight) AS n FROM {p}_rows WHERE train GROUP BY block"),
        f"{p}_w0": ((f"{p}_f",), f"""
    SELECT DISTINCT f.block, CAST(k AS BIGINT) AS k, f.idx, 0.0::DOUBLE AS w, 0.0::DOUBLE AS m, 0.0::DOUBLE AS v
    FROM {p}_f f JOIN {p}_rows r ON f.rid = r.rid, range({classes}) t(k) WHERE r.train"""),
        f"{p}_z0": ((f"{p}_w0",), linear(f"{p}_f", f"{p}_w0"))}
    for r in range(1, ROUNDS + 1):
        z, w = f"{p}_z{r - 1}", f"{p}_w{r - 1}"
        out[f"{p}_s{r}"] = ((z, *deps), slope.format(z=z, hard=softmax(z), soft=softmax(z, vocab.DISTILL_TEMPERATURE),
                                                     sweep=softmax(z, vocab.SWEEP_TEMPERATURE)))
        out[f"{p}_w{r}"] = ((f"{p}_s{r}", f"{p}_n"), f"""
    SELECT block, k, idx, m, v, w - {rate!r}::DOUBLE * ((m / {1 - b1 ** r!r}::DOUBLE) / (sqrt(v / {1 - b2 ** r!r}::DOUBLE) + {G.EPS!r}::DOUBLE)
           + {G.DECAY!r}::DOUBLE * w) AS w
    FROM (SELECT w.block, w.k, w.idx, w.w, {b1!r}::DOUBLE * w.m + {1 - b1!r}::DOUBLE * g.g AS m,
                 {b2!r}::DOUBLE * w.v + {1 - b2!r}::DOUBLE * g.g * g.g AS v
          FROM {w} w JOIN (SELECT f.block, s.k, f.idx, sum(s.s * f.x) / any_value(n.n) AS g
                           FROM {p}_f f JOIN {p}_s{r} s ON f.rid = s.rid JOIN {p}_n n ON f.block = n.block
                           GROUP BY f.block, s.k, f.idx) g ON w.block = g.block AND w.k = g.k AND w.idx = g.idx)""")
        out[f"{p}_z{r}"] = ((f"{p}_w{r}",), linear(f"{p}_f", f"{p}_w{r}"))
    return out


def _hard(p: str) -> str:
    return f"""
    SELECT c.rid, c.k, r.weight * (c.p - CASE WHEN c.k = r.gold THEN 1 ELSE 0 END) AS s
    FROM ({{hard}}) c JOIN {p}_rows r ON c.rid = r.rid WHERE r.train"""


def _mixed(p: str, soft: str, t: float) -> str:
    return f"""
    SELECT c.rid, c.k, (1 - r.alpha) * (c.p - CASE WHEN c.k = r.gold THEN 1 ELSE 0 END) + r.alpha * {t!r}::DOUBLE * (u.p - q.p) AS s
    FROM ({{hard}}) c JOIN ({{{soft}}}) u ON c.rid = u.rid AND c.k = u.k JOIN {p}_q q ON c.rid = q.rid AND c.k = q.k
    JOIN {p}_rows r ON c.rid = r.rid WHERE r.train"""


def taught(p: str, t: float) -> Defs:
    """The fitted teacher's logits and probabilities at a temperature for ``{p}_rows``."""
    return {f"{p}_tf": ((f"{p}_rows", f"{p}_g"), f"SELECT rid, 0 AS block, idx, x FROM ({features(f'{p}_rows', f'{p}_g', TEACHER.features)})"),
            f"{p}_tz": ((f"{p}_tf", f"t_w{ROUNDS}"), linear(f"{p}_tf", f"t_w{ROUNDS}")),
            f"{p}_q": ((f"{p}_tz",), softmax(f"{p}_tz", t))}


def distill_rows(p: str, epochs: str, t: float) -> str:
    """(epoch, rid, ce, kl, prediction) from logits (epoch, rid, k, z)."""
    return f"""
    SELECT epoch, l.rid, sum(CASE WHEN l.k = r.gold THEN -hard ELSE 0 END) AS ce, sum(q.p * (q.lp - soft)) AS kl,
           CAST(arg_max(l.k, (l.z, -l.k)) AS INTEGER) AS prediction
    FROM (SELECT epoch, rid, k, z, u - ln(sum(exp(u)) OVER w) AS hard, u / {t!r}::DOUBLE - ln(sum(exp(u / {t!r}::DOUBLE)) OVER w) AS soft
          FROM (SELECT *, z - max(z) OVER (PARTITION BY epoch, rid) AS u FROM ({epochs})) WINDOW w AS (PARTITION BY epoch, rid)) l
    JOIN {p}_rows r ON l.rid = r.rid JOIN {p}_q q ON l.rid = q.rid AND l.k = q.k GROUP BY epoch, l.rid"""


_H = hash_sql("doc_id")
_HS = hash_sql("doc_id", vocab.SAMPLE_SEED)
_CUT = int(vocab.TEST_FRACTION * (1 << 32))
_GOLD = "CASE WHEN tone = 'hate' THEN 1 ELSE 0 END AS gold"
_KEY = "CAST(target_id AS VARCHAR) || ':' || text"


def _epochs(p: str, first: int = 1) -> str:
    return " UNION ALL ".join(f"SELECT {r} AS epoch, rid, k, z FROM {p}_z{r}" for r in range(first, ROUNDS + 1))


DEFS: Defs = {
    # teacher: pooled, balanced, split
    "t_pool": (("corpus",), "SELECT tone, text, min(doc_id) AS doc_id FROM corpus GROUP BY tone, text"),
    "t_ranked": (("t_pool",), f"""
    SELECT *, row_number() OVER (PARTITION BY tone ORDER BY {_HS}, doc_id) AS r, count(*) OVER (PARTITION BY tone) AS n FROM t_pool"""),
    "t_rows": (("t_ranked",), f"""
    SELECT row_number() OVER () AS rid, 0 AS block, {_GOLD}, 1.0::DOUBLE AS weight, NOT {_H} < {_CUT} AS train, text FROM t_ranked
    WHERE (SELECT count(DISTINCT tone) FROM t_pool) < 2 OR r <= (SELECT min(n) FROM t_ranked)"""),
    "t_g": (("t_rows",), grams("t_rows")),
    **rounds("t", TEACHER.features, 2, _hard("t"), ("t_rows",)),
    "t_scored": ((f"t_z{ROUNDS}",), f"""
    SELECT r.rid, r.gold, CAST(arg_max(c.k, (c.p, -c.k)) AS INTEGER) AS prediction, sum(CASE WHEN c.k = r.gold THEN -c.lp ELSE 0 END) AS nll
    FROM ({softmax(f't_z{ROUNDS}')}) c JOIN t_rows r ON c.rid = r.rid WHERE NOT r.train GROUP BY r.rid, r.gold"""),
    # students: balanced per group, split; only groups with both labels are fitted
    "s_ranked": (("corpus",), f"""
    SELECT doc_id, target, tone, text, row_number() OVER (PARTITION BY target, tone ORDER BY {_HS}, doc_id) AS r,
           count(*) OVER (PARTITION BY target, tone) AS n FROM corpus"""),
    "s_least": (("s_ranked",), """
    SELECT target, min(CASE WHEN tone = 'hate' THEN n END) AS nh, min(CASE WHEN tone = 'neutral' THEN n END) AS nn
    FROM s_ranked GROUP BY target"""),
    "s_all": (("s_ranked", "s_least", "groups"), f"""
    SELECT row_number() OVER () AS rid, a.doc_id, a.target, g.target_id AS block, {_GOLD}, 1.0::DOUBLE AS weight,
           NOT {_H} < {_CUT} AS train, a.text, {vocab.DISTILL_ALPHA!r}::DOUBLE AS alpha
    FROM s_ranked a JOIN s_least l ON a.target = l.target JOIN groups g ON a.target = g.target
    WHERE a.r <= CASE WHEN nh IS NOT NULL AND nn IS NOT NULL THEN least(nh, nn) ELSE n END"""),
    "s_fitted": (("s_all",), "SELECT target FROM s_all WHERE train GROUP BY target HAVING count(DISTINCT gold) = 2"),
    "s_rows": (("s_all", "s_fitted"), "SELECT * FROM s_all WHERE target IN (SELECT target FROM s_fitted)"),
    "s_g": (("s_rows",), grams("s_rows")),
    **taught("s", vocab.DISTILL_TEMPERATURE),
    **rounds("s", STUDENTS.features, 2, _mixed("s", "soft", vocab.DISTILL_TEMPERATURE), ("s_rows", "s_q")),
    "s_scored": ((f"s_z{ROUNDS}", "s_q"), distill_rows("s", _epochs("s"), vocab.DISTILL_TEMPERATURE)),
    # sweep: the rows of one group once per alpha
    "h_rows": (("s_rows",), f"""
    SELECT s.rid * {len(vocab.SWEEP_ALPHAS)} + i AS rid, i AS block, s.gold, s.weight, s.train, s.text, a AS alpha
    FROM s_rows s, (SELECT unnest(range({len(vocab.SWEEP_ALPHAS)})) AS i, unnest({vocab.SWEEP_ALPHAS}::DOUBLE[]) AS a)
    WHERE s.target = '{vocab.SWEEP_GROUP}'"""),
    "h_g": (("h_rows",), grams("h_rows")),
    **taught("h", vocab.SWEEP_TEMPERATURE),
    **rounds("h", STUDENTS.features, 2, _mixed("h", "sweep", vocab.SWEEP_TEMPERATURE), ("h_rows", "h_q")),
    "h_scored": ((f"h_z{ROUNDS}", "h_q"), distill_rows("h", _epochs("h", ROUNDS), vocab.SWEEP_TEMPERATURE)),
    # router: class-weighted group-id table; the head test set stays in the training part
    "r_ids": (("lines", "groups"), "SELECT DISTINCT g.target_id, l.text FROM lines l JOIN groups g ON l.target = g.target"),
    "r_rows": (("r_ids",), f"""
    SELECT row_number() OVER () AS rid, 0 AS block, target_id AS gold, count(*) OVER (PARTITION BY target_id) / count(*) OVER () AS weight,
           TRUE AS train, text, row_number() OVER (ORDER BY {hash_sql(_KEY, vocab.SAMPLE_SEED)}, {_KEY}) <= {vocab.HEAD_TEST_ROWS} AS test
    FROM r_ids"""),
    "r_g": (("r_rows",), grams("r_rows")),
    **rounds("r", ROUTER.features, ROUTER.classes, _hard("r"), ("r_rows",)),
    "r_scored": ((f"r_z{ROUNDS}",), f"""
    SELECT r.rid, r.gold, CAST(arg_max(z.k, (z.z, -z.k)) AS INTEGER) AS prediction
    FROM r_z{ROUNDS} z JOIN r_rows r ON z.rid = r.rid WHERE r.test GROUP BY r.rid, r.gold"""),
    # every document under the router and under every student
    "d_rows": ((), "SELECT doc_id AS rid, 0 AS block, text FROM documents"),
    "d_g": (("d_rows",), grams("d_rows")),
    "d_rf": (("d_g",), features("d_rows", "d_g", ROUTER.features)),
    "d_r": (("d_rf", f"r_w{ROUNDS}"), linear("d_rf", f"r_w{ROUNDS}")),
    "d_sf": (("d_g",), features("d_rows", "d_g", STUDENTS.features)),
    "d_s": (("d_sf", f"s_w{ROUNDS}"), f"""
    SELECT f.rid, w.block AS idx, sum(CASE WHEN k = 0 THEN f.x * w.w END) AS l0, sum(CASE WHEN k = 1 THEN f.x * w.w END) AS l1
    FROM d_sf f JOIN s_w{ROUNDS} w ON f.idx = w.idx GROUP BY f.rid, w.block"""),
    "proba_long": (("d_r", "d_s"), """
    SELECT r.rid AS vec_id, CAST(r.k AS INTEGER) AS idx, r.z AS logit, coalesce(s.l0, 0.0) AS l0, coalesce(s.l1, 0.0) AS l1,
           0 AS gold, 0 AS label
    FROM d_r r LEFT JOIN d_s s ON r.rid = s.rid AND r.k = s.idx"""),
}
