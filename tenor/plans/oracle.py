"""DuckDB SQL for the bindings, so every oracle query is written independently
of the Spark code. ``with_ctes(body, *names)`` prefixes the needed CTEs in
dependency order."""

from __future__ import annotations

from tenor import vocab
from tenor.functions.text import PY_SPACE
from tenor.plans import bindings

ANN_LIST = "[" + ", ".join(f"'{a}'" for a in vocab.ANNOTATION_TARGETS) + "]"
GROUP_LIST = "[" + ", ".join(f"'{g}'" for g in vocab.GROUPS) + "]"


def _hash(expr: str, seed: int = vocab.SPLIT_SEED) -> str:
    return f"('0x' || substring(md5('{seed}:' || CAST({expr} AS VARCHAR)), 1, 8))::BIGINT"


def strip_sql(expr: str) -> str:
    return f"regexp_replace({expr}, '^{PY_SPACE}+|{PY_SPACE}+$', '', 'g')"


def tokens_sql(expr: str) -> str:
    return f"list_filter(regexp_split_to_array(lower({expr}), '[\\s[:punct:]]+'), lambda x: x <> '')"


def _wide_select() -> str:
    cols = [f"embedding[{i + 1}]::DOUBLE > {bindings.INDICATOR_THRESHOLD} AS {bindings.indicator_name(i)}"
            for i in range(bindings.N_INDICATORS)]
    return ("SELECT vec_id, 'v' || CAST(vec_id AS VARCHAR) AS text, embedding[64]::DOUBLE * 5.0 AS hate_speech_score, "
            + ", ".join(cols) + " FROM embeddings")


def _scaled(start0: int, n: int) -> str:
    return f"list_transform(embedding[{start0 + 1}:{start0 + n}], lambda x: x::DOUBLE * {bindings.LOGIT_SCALE})"


CTES: dict[str, tuple[tuple[str, ...], str]] = {
    "src_dim": ((), "SELECT * FROM " + vocab.sql_values(
        [(f"src{i}", r) for i, r in enumerate(bindings.SOURCE_RAW)], ["source", "raw"])),
    "taxonomy": ((), "SELECT * FROM " + vocab.sql_values(
        [(r, g, vocab.GROUPS.index(g)) for r, g in vocab.TAXONOMY.items()], ["raw", "target", "target_id"])),
    "groups": ((), "SELECT * FROM " + vocab.sql_values(
        [(g, i) for i, g in enumerate(vocab.GROUPS)], ["target", "target_id"])),
    "prompt_ids": ((), "SELECT * FROM " + vocab.sql_values(
        list(vocab.PROMPT_TARGET_IDS.items()), ["raw", "raw_id"])),
    "corpus_raw": (("src_dim",), """
        SELECT d.doc_id, 0 AS seq, CASE WHEN l.toxic = 1 THEN 'hate' ELSE 'neutral' END AS tone, s.raw, d.text
        FROM documents d JOIN labels l ON d.doc_id = l.doc_id JOIN src_dim s ON d.source = s.source"""),
    "corpus": (("corpus_raw", "taxonomy"), """
        SELECT c.doc_id, c.seq, c.tone, c.raw, t.target, c.text
        FROM corpus_raw c JOIN taxonomy t ON lower(c.raw) = t.raw"""),
    "lines": (("src_dim", "taxonomy"), """
        SELECT doc_id, CAST(seq AS INTEGER) AS seq, tone, raw, target, text FROM (
          SELECT d.doc_id,
                 CASE WHEN l.toxic IS NULL THEN NULL WHEN l.toxic = 1 THEN 'hate' ELSE 'neutral' END AS tone,
                 s.raw, t.target,
                 unnest(string_split(d.text, chr(10))) AS text,
                 unnest(generate_series(0, len(string_split(d.text, chr(10))) - 1)) AS seq
          FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
          JOIN src_dim s ON d.source = s.source LEFT JOIN taxonomy t ON s.raw = t.raw)"""),
    "votes": ((), f"""
        SELECT event_id // 3 AS post_id, CAST(event_id % 3 AS INTEGER) AS annotator,
               CASE WHEN event_type IN ('error', 'purchase') THEN 'hatespeech'
                    WHEN event_type = 'click' THEN 'offensive' ELSE 'normal' END AS label,
               [{ANN_LIST}[CAST(user_id % 5 AS INTEGER) + 1],
                {ANN_LIST}[5 + CAST(floor(value) AS BIGINT) % 4 + 1]] AS targets,
               [event_type, CAST(user_id AS VARCHAR)] AS tokens
        FROM events"""),
    "wide": ((), _wide_select()),
    "proba": ((), f"""
        SELECT vec_id, {_scaled(0, 11)} AS router, {_scaled(11, 11)} AS l0, {_scaled(22, 11)} AS l1,
               CAST(label >= 5 AS INTEGER) AS gold, label
        FROM embeddings"""),
    "proba_long": ((), f"""
        SELECT vec_id, CAST(i - 1 AS INTEGER) AS idx, embedding[i]::DOUBLE * {bindings.LOGIT_SCALE} AS logit,
               embedding[11 + i]::DOUBLE * {bindings.LOGIT_SCALE} AS l0,
               embedding[22 + i]::DOUBLE * {bindings.LOGIT_SCALE} AS l1,
               CAST(label >= 5 AS INTEGER) AS gold, label
        FROM embeddings, range(1, 12) AS r(i)"""),
    "router_p": (("proba_long",), """
        SELECT vec_id, idx, l0, l1, gold, label, e / sum(e) OVER (PARTITION BY vec_id) AS p FROM (
          SELECT *, exp(logit - max(logit) OVER (PARTITION BY vec_id)) AS e FROM proba_long)"""),
    "router_ranked": (("router_p",), """
        SELECT *, CAST(row_number() OVER w - 1 AS INTEGER) AS rnk,
               coalesce(sum(p) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0) AS before,
               max(p) OVER (PARTITION BY vec_id) AS top
        FROM router_p WINDOW w AS (PARTITION BY vec_id ORDER BY p DESC, idx)"""),
    "routed": (("router_ranked",), f"""
        SELECT vec_id, rnk, idx, p, l0, l1 FROM router_ranked
        WHERE top >= {vocab.ROUTER_MIN_PROBA} AND rnk < {vocab.ROUTER_MAX_GROUPS} AND before < {vocab.ROUTER_THRESHOLD}
        UNION ALL
        SELECT vec_id, 0 AS rnk, idx, 1.0 AS p, l0, l1 FROM router_ranked
        WHERE top < {vocab.ROUTER_MIN_PROBA} AND idx = {vocab.GROUPS.index(vocab.FALLBACK_GROUP)}"""),
    "weighted": (("routed",), """
        SELECT vec_id, rnk, idx, p / sum(p) OVER (PARTITION BY vec_id) AS weight,
               1.0 / (1.0 + exp(l0 - l1)) AS p_hate
        FROM routed"""),
    "scored": (("weighted",), f"""
        SELECT vec_id, count(*) AS n_groups,
               string_agg({GROUP_LIST}[idx + 1], ',' ORDER BY rnk) AS groups,
               sum(weight * p_hate) AS score
        FROM weighted GROUP BY vec_id"""),
    "logits": ((), f"""
        SELECT vec_id, {_scaled(33, 2)} AS teacher, {_scaled(35, 2)} AS student, CAST(label >= 5 AS INTEGER) AS gold
        FROM embeddings"""),
    "mlog": ((), """
        SELECT CAST(day(ts) AS INTEGER) AS epoch, CASE WHEN user_id % 2 = 0 THEN 'train' ELSE 'eval' END AS mode,
               CASE event_type WHEN 'view' THEN 'loss' WHEN 'click' THEN 'acc' WHEN 'signup' THEN 'f1' END AS metric,
               avg(value) AS value
        FROM events WHERE event_type IN ('view', 'click', 'signup') GROUP BY ALL"""),
    "testset": ((), """
        SELECT d.doc_id, l.toxic AS label, d.text FROM documents d JOIN labels l ON d.doc_id = l.doc_id"""),
}


def with_ctes(body: str, *names: str, extra: dict[str, str] | None = None,
              replace: dict[str, tuple[tuple[str, ...], str]] | None = None, keep: bool = False) -> str:
    """``WITH`` clause holding ``names`` and their dependencies, then ``body``.
    ``extra`` adds query-local CTEs after the bindings (in the given order);
    ``replace`` swaps a binding's definition (dependencies, SQL) for this query;
    ``keep`` has every CTE computed once."""
    defs = dict(CTES, **(replace or {}))
    order: list[str] = []

    def visit(n: str):
        if n in order:
            return
        for dep in defs[n][0]:
            visit(dep)
        order.append(n)

    for n in names:
        visit(n)
    how = "AS MATERIALIZED" if keep else "AS"
    parts = [f"{n} {how} ({defs[n][1]})" for n in order]
    for k, v in (extra or {}).items():
        parts.append(f"{k} {how} ({v})")
    head = ("WITH " + ",\n".join(parts) + "\n") if parts else ""
    return head + body


def hash_sql(expr: str, seed: int = vocab.SPLIT_SEED) -> str:
    return _hash(expr, seed)
