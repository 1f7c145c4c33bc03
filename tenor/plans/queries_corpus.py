"""Registered queries over B-CORPUS, B-LINES, B-VOTES and B-WIDE: cleaning,
taxonomy, consensus, dedup, set operations, sampling, labels and text codecs."""

from __future__ import annotations

from pyspark.sql import functions as F

from tenor import vocab
from tenor.functions import text as T
from tenor.operators import clean, consensus, corpus, labels, sampling, taxonomy
from tenor.plans import bindings
from tenor.sources import files
from tenor.session import scratch_path
from tenor.plans.contract import ORACLES, r6, register
from tenor.plans.oracle import ANN_LIST, hash_sql, strip_sql, tokens_sql, with_ctes

HATE, NEUTRAL = vocab.TONES[1], vocab.TONES[0]


def _lines(spark, sf_dir):
    return bindings.lines(spark, sf_dir)


def _prompt_lines(spark, sf_dir):
    return _lines(spark, sf_dir).where(F.col("tone").isNotNull())


def _flat_posts(spark, sf_dir):
    return consensus.flatten_posts(bindings.posts(spark, sf_dir))


# --------------------------------------------------------------------------- H1-H5


@register("strip_text", f"SELECT doc_id, {strip_sql('text')} AS text FROM documents")
def strip_text_q(spark, sf_dir):
    """H1: Python-style strip of every document."""
    docs = bindings.table(spark, sf_dir, "documents")
    return docs.select("doc_id", T.strip_text("text").alias("text"))


_POST_SQL = {"posts": """
    SELECT post_id, string_agg(label, ',' ORDER BY annotator) AS labels,
           string_agg(array_to_string(targets, ','), ',' ORDER BY annotator) AS targets,
           string_agg(array_to_string(tokens, ' '), ' ' ORDER BY annotator) AS sentence,
           CAST(count(*) AS INTEGER) AS n_annotators,
           CAST(count_if(label = 'hatespeech') AS INTEGER) AS toxic_votes
    FROM votes GROUP BY post_id"""}


@register("join_tokens", with_ctes("SELECT post_id, sentence FROM posts", "votes", extra=_POST_SQL))
def join_tokens_q(spark, sf_dir):
    """H2: post tokens joined by a space."""
    p = bindings.posts(spark, sf_dir)
    return p.select("post_id", T.join_tokens("post_tokens").alias("sentence"))


@register("flatten_targets", with_ctes("SELECT post_id, targets FROM posts", "votes", extra=_POST_SQL))
def flatten_targets_q(spark, sf_dir):
    """H3: every annotator's target list flattened (repeats kept), shown comma-joined."""
    p = bindings.posts(spark, sf_dir)
    flat = T.flatten_targets(F.transform("annotators", lambda a: a["target"]))
    return p.select("post_id", F.array_join(flat, ",").alias("targets"))


@register("tokenize", f"""
SELECT doc_id, CAST(len(tk) AS INTEGER) AS n_tokens, array_to_string(tk, ' ') AS tokens
FROM (SELECT doc_id, {tokens_sql('text')} AS tk FROM documents)""")
def tokenize_q(spark, sf_dir):
    """H4: lower-case word tokens of every document (whole text)."""
    docs = bindings.table(spark, sf_dir, "documents")
    tk = T.tokens("text")
    return docs.select("doc_id", F.size(tk).alias("n_tokens"), F.array_join(tk, " ").alias("tokens"))


_ENC = f"""
SELECT doc_id, CAST(w AS INTEGER) AS window, CAST(len(tk) AS INTEGER) AS n_tokens,
       array_to_string(list_concat(part, list_transform(range({T.MAX_LEN} - len(part)), lambda x: 0)), ',')
         AS input_ids,
       array_to_string(list_transform(range({T.MAX_LEN}), lambda i: CASE WHEN i < len(part) THEN 1 ELSE 0 END), ',') AS attention_mask,
       array_to_string(list_transform(range({T.MAX_LEN}), lambda i: 0), ',') AS token_type_ids
FROM (SELECT doc_id, tk, w, ids[w * {T.MAX_LEN} + 1 : w * {T.MAX_LEN} + {T.MAX_LEN}] AS part
      FROM (SELECT doc_id, tk, ids,
                   unnest(range(0, greatest(1, CAST(ceil(len(ids) / {T.MAX_LEN}) AS BIGINT)))) AS w
            FROM (SELECT doc_id, tk, list_transform(tk,
                    lambda t: CAST(1 + ('0x' || substring(md5(t), 1, 8))::BIGINT % {T.VOCAB_SIZE - 1} AS INTEGER)) AS ids
                  FROM (SELECT doc_id, {tokens_sql('text')} AS tk FROM documents))))"""


@register("encode_pad", with_ctes(_ENC))
def encode_pad_q(spark, sf_dir):
    """H5: hashed token ids in model-length windows, padded, with attention mask and token type ids (one segment) -
    the whole text, window by window."""
    c = bindings.table(spark, sf_dir, "documents")
    ids = c.select("doc_id", T.tokens("text").alias("_tk")).select(
        "doc_id", F.size("_tk").alias("n_tokens"), T.token_ids("_tk").alias("_ids"))
    out = ids.select("doc_id", "n_tokens", F.posexplode(T.encode_windows("_ids")).alias("window", "e"))
    return out.select("doc_id", F.col("window").cast("int").alias("window"), "n_tokens",
                      *[F.array_join(f"e.{c}", ",").alias(c) for c in ("input_ids", "attention_mask", "token_type_ids")])


# --------------------------------------------------------------------------- D1, D2


@register("consensus_label", with_ctes(
    "SELECT post_id, n_annotators, toxic_votes, CAST(toxic_votes >= 2 AS INTEGER) AS toxic FROM posts",
    "votes", extra=_POST_SQL))
def consensus_label_q(spark, sf_dir):
    """Toxic iff at least two annotators say hatespeech (all annotators vote)."""
    out = consensus.consensus_label(_flat_posts(spark, sf_dir))
    return out.select("post_id", "n_annotators", "toxic_votes", "toxic")


_TARGETS_SQL = dict(_POST_SQL)
_TARGETS_SQL["cnt"] = f"""
    SELECT post_id, target, CAST(count(*) AS INTEGER) AS votes
    FROM (SELECT post_id, unnest(targets) AS target FROM votes)
    WHERE list_contains({ANN_LIST}, target) GROUP BY post_id, target"""


@register("consensus_targets", with_ctes("""
SELECT p.post_id, CAST(p.toxic_votes >= 2 AS INTEGER) AS toxic, c.target, c.votes, p.sentence
FROM cnt c JOIN posts p ON c.post_id = p.post_id
WHERE c.votes >= CASE WHEN p.toxic_votes >= 2 THEN 2 ELSE 1 END""", "votes", extra=_TARGETS_SQL))
def consensus_targets_q(spark, sf_dir):
    """Surviving targets per post (2 votes if toxic, else 1)."""
    return consensus.consensus_targets(_flat_posts(spark, sf_dir))


# --------------------------------------------------------------------------- B1-B11


@register("parse_name", with_ctes("""
SELECT DISTINCT tone || '_' || raw || '_1k.txt' AS file_name, tone, raw FROM lines WHERE tone IS NOT NULL""", "lines"))
def parse_name_q(spark, sf_dir):
    """B1: tone and raw target parsed back from the prompt file names."""
    names = _prompt_lines(spark, sf_dir).select(
        bindings.prompt_file_name(F.col("tone"), F.col("raw")).alias("file_name")).distinct()
    p = clean.parse_name(F.col("file_name"), "prompt")
    return names.select("file_name", p["tone"].alias("tone"), p["raw"].alias("raw"))


_CLEAN = f"""
SELECT doc_id, seq, {strip_sql('f')} AS text FROM (
  SELECT doc_id, seq, unnest(list_filter(list_transform(string_split(text, '\\n'), lambda x: replace(x, '-', '')),
                                         lambda x: x <> '')) AS f
  FROM lines)"""


@register("clean_prompt", with_ctes(_CLEAN, "lines"))
def clean_prompt_q(spark, sf_dir):
    """B2: prompt lines cut at literal backslash-n, dashes removed, empties dropped, stripped."""
    ln = _lines(spark, sf_dir)
    return ln.select("doc_id", "seq", F.explode(clean.clean_prompt("text")).alias("text"))


@register("drop_tone", with_ctes(
    "SELECT doc_id, seq, raw AS target, text FROM lines", "lines"))
def drop_tone_q(spark, sf_dir):
    """The prompt table without its tone column."""
    t = _lines(spark, sf_dir).select("doc_id", "seq", "tone", F.col("raw").alias("target"), "text")
    return clean.drop_tone(t)


@register("drop_matching_columns", with_ctes(
    "SELECT doc_id, seq, raw AS target, text FROM lines", "lines"))
def drop_matching_columns_q(spark, sf_dir):
    """A saved index column (``Unnamed: 0``) dropped by name pattern."""
    t = _lines(spark, sf_dir).select("doc_id", "seq", F.col("seq").alias("Unnamed: 0"),
                                     F.col("raw").alias("target"), "text")
    return clean.drop_matching_columns(t, ":")


@register("encode_target_16", with_ctes("""
SELECT l.doc_id, l.seq, coalesce(CAST(p.raw_id AS VARCHAR), l.raw) AS target
FROM lines l LEFT JOIN prompt_ids p ON l.raw = p.raw""", "lines", "prompt_ids"))
def encode_target_16_q(spark, sf_dir):
    """The 16 prompt names to ids; other names kept."""
    t = _lines(spark, sf_dir).select("doc_id", "seq", F.col("raw").alias("target"))
    return clean.encode_target_16(t, "target").select("doc_id", "seq", "target")


@register("encode_target_11", with_ctes("""
SELECT l.doc_id, l.seq, l.target, g.target_id, g.target AS decoded
FROM lines l JOIN groups g ON l.target = g.target""", "lines", "groups"))
def encode_target_11_q(spark, sf_dir):
    """Group names to ids and back."""
    t = _lines(spark, sf_dir).where(F.col("target").isNotNull()).select("doc_id", "seq", "target")
    enc = clean.encode_target_11(t, "target")
    return clean.decode_target_11(enc, "target_id", "decoded").select("doc_id", "seq", "target", "target_id", "decoded")


@register("tone_label", with_ctes("""
SELECT doc_id, tone, CASE tone WHEN 'hate' THEN 1 WHEN 'neutral' THEN 0 END AS label,
       CASE CASE tone WHEN 'hate' THEN 1 WHEN 'neutral' THEN 0 END WHEN 1 THEN 'hate' WHEN 0 THEN 'neutral' END AS tone_back
FROM corpus""", "corpus"))
def tone_label_q(spark, sf_dir):
    """Tone to 0/1 label and back."""
    c = bindings.corpus(spark, sf_dir).select("doc_id", "tone")
    c = c.withColumn("label", clean.tone_label("tone"))
    return c.withColumn("tone_back", clean.label_tone("label"))


@register("score_threshold_split", with_ctes("""
SELECT vec_id, text, round(hate_speech_score, 6) AS hate_speech_score,
       CASE WHEN hate_speech_score > 0.5 THEN 'hate' ELSE 'neutral' END AS tone
FROM wide WHERE hate_speech_score IS NOT NULL""", "wide"))
def score_threshold_split_q(spark, sf_dir):
    """Survey rows to hate (> 0.5) or neutral (<= 0.5)."""
    w = bindings.wide(spark, sf_dir).select("vec_id", "text", "hate_speech_score")
    out = clean.score_threshold_split(w)
    return out.select("vec_id", "text", r6("hate_speech_score").alias("hate_speech_score"), "tone")


# The oracle's own statement of the binding (column of the 64 values, group), apart from the code's map.
_WIDE_SQL = """
SELECT unnest(cols) AS col_pos, target FROM (VALUES
  ([51], 'women'), ([35], 'jews'), ([22], 'asian'), ([23], 'black'), ([47, 48, 49, 50, 54, 55, 56], 'lgbtq'), ([24], 'latino'),
  ([37], 'muslim'), ([26, 27], 'indigenous'), ([25], 'arab'), ([0, 1, 2, 3, 4, 5, 6, 7], 'disabilities'),
  ([28, 29, 30, 31, 32, 33, 34, 36, 38, 39, 40, 41, 42, 43, 44, 45, 46, 52, 53, 57, 58, 59, 60, 61, 62, 8, 9, 10], 'others')) t(cols, target)"""
_MELT_SQL = {"wdim": _WIDE_SQL, "melt": f"""
    SELECT e.vec_id, 'v' || CAST(e.vec_id AS VARCHAR) AS text, e.embedding[64]::DOUBLE * 5.0 AS hate_speech_score,
           d.col_pos, d.target
    FROM embeddings e JOIN wdim d ON e.embedding[d.col_pos + 1]::DOUBLE > {bindings.INDICATOR_THRESHOLD}"""}


@register("indicator_filter", with_ctes("SELECT DISTINCT vec_id, col_pos FROM melt", extra=_MELT_SQL))
def indicator_filter_q(spark, sf_dir):
    """(row, indicator) pairs whose indicator is true, mapped columns only."""
    cols = bindings.wide_columns()
    positions = [p for ps in cols.values() for p in ps]
    return taxonomy.melt_indicators(bindings.wide(spark, sf_dir), positions, bindings.indicator_name, ["vec_id"])


@register("indicator_melt_join", with_ctes(
    "SELECT vec_id, text, round(hate_speech_score, 6) AS hate_speech_score, col_pos, target FROM melt",
    extra=_MELT_SQL))
def indicator_melt_join_q(spark, sf_dir):
    """Indicator columns to groups (one row per true mapped column)."""
    out = taxonomy.indicator_melt_join(bindings.wide(spark, sf_dir), bindings.wide_columns(), bindings.indicator_name,
                                       ["vec_id", "text", "hate_speech_score"])
    return out.select("vec_id", "text", r6("hate_speech_score").alias("hate_speech_score"), "col_pos", "target")


@register("known_group_filter", with_ctes("""
SELECT c.doc_id, g.target, g.target_id FROM (
  SELECT doc_id, regexp_extract(tone || '_' || raw || '.csv', '^([^_]+)_(.+)[.]csv$', 2) AS grp FROM corpus_raw) c
JOIN groups g ON (CASE WHEN c.grp = 'other' THEN 'others' ELSE c.grp END) = g.target""", "corpus_raw", "groups"))
def known_group_filter_q(spark, sf_dir):
    """Rows of files named after one of the 11 groups."""
    c = bindings.corpus_raw(spark, sf_dir).withColumn(
        "file_name", F.concat(F.col("tone"), F.lit("_"), F.col("raw"), F.lit(".csv")))
    return clean.known_group_filter(c, "file_name").select("doc_id", "target", "target_id")


@register("legacy_comma_field", with_ctes(f"""
SELECT doc_id, {strip_sql("string_split(tone || ',' || raw || ',' || text, ',')[3]")} AS field FROM corpus_raw""",
                                          "corpus_raw"))
def legacy_comma_field_q(spark, sf_dir):
    """Third field of a plain comma split of ``tone,target,text`` lines."""
    c = bindings.corpus_raw(spark, sf_dir)
    line = F.concat_ws(",", "tone", "raw", "text")
    return c.select("doc_id", clean.legacy_comma_field(line, 2).alias("field"))


# --------------------------------------------------------------------------- C1, C2, C5


@register("map_taxonomy", with_ctes("SELECT doc_id, tone, raw, target FROM corpus", "corpus"))
def map_taxonomy_q(spark, sf_dir):
    """Raw target to group through the 28-key taxonomy."""
    return bindings.corpus(spark, sf_dir).select("doc_id", "tone", "raw", "target")


@register("taxonomy_quarantine", with_ctes("""
SELECT c.doc_id, c.tone, c.raw FROM corpus_raw c WHERE lower(c.raw) NOT IN (SELECT raw FROM taxonomy)""",
                                           "corpus_raw", "taxonomy"))
def taxonomy_quarantine_q(spark, sf_dir):
    """Rows whose raw target has no group."""
    return taxonomy.taxonomy_quarantine(bindings.corpus_raw(spark, sf_dir)).select("doc_id", "tone", "raw")


@register("expected_combinations", with_ctes("""
SELECT e.tone, e.raw, (p.raw IS NOT NULL) AS present
FROM (SELECT t.tone, r.raw FROM (SELECT DISTINCT raw FROM lines WHERE tone IS NOT NULL) r,
                                (SELECT DISTINCT tone FROM lines WHERE tone IS NOT NULL) t
      WHERE NOT (t.tone = 'neutral' AND r.raw = 'trans')) e
LEFT JOIN (SELECT DISTINCT tone, raw FROM lines WHERE tone IS NOT NULL) p ON e.tone = p.tone AND e.raw = p.raw""",
                                             "lines"))
def expected_combinations_q(spark, sf_dir):
    """Every expected (tone, target) prompt file, flagged when present."""
    return taxonomy.expected_combinations(_prompt_lines(spark, sf_dir))


# --------------------------------------------------------------------------- E1, G2-G5, D3, D4


@register("dedup_keep_first", with_ctes("""
SELECT doc_id, seq, text FROM (
  SELECT doc_id, seq, text, row_number() OVER (PARTITION BY text ORDER BY doc_id, seq) AS rn FROM lines)
WHERE rn = 1""", "lines"))
def dedup_keep_first_q(spark, sf_dir):
    """One row per line text, the first (lowest doc_id, seq) kept."""
    ln = bindings.line_texts(spark, sf_dir)
    return corpus.dedup_keep_first(ln, "text", ("doc_id", "seq")).select("doc_id", "seq", "text")


@register("distinct_rows", with_ctes("SELECT DISTINCT tone, target, text FROM corpus", "corpus"))
def distinct_rows_q(spark, sf_dir):
    """Duplicates removed per (tone, group)."""
    return corpus.distinct_rows(bindings.corpus(spark, sf_dir))


@register("combine_groups", with_ctes("SELECT DISTINCT tone, text FROM corpus", "corpus"))
def combine_groups_q(spark, sf_dir):
    """Groups pooled per tone, deduplicated per tone."""
    return corpus.combine_groups(bindings.corpus(spark, sf_dir))


@register("concat_all", with_ctes("""
SELECT CASE WHEN tone = 'hate' THEN 0 ELSE 1 END AS part, tone, text FROM (SELECT DISTINCT tone, text FROM corpus)""",
                                  "corpus"))
def concat_all_q(spark, sf_dir):
    """Pooled hate then pooled neutral; cross-tone duplicates kept."""
    return corpus.concat_all(bindings.corpus(spark, sf_dir))


_G5 = "SELECT DISTINCT g.target_id, l.text FROM lines l JOIN groups g ON l.target = g.target"


@register("gather_group_ids", with_ctes(_G5, "lines", "groups"))
def gather_group_ids_q(spark, sf_dir):
    """Distinct (group id, text) over every group file."""
    return corpus.gather_group_ids(_lines(spark, sf_dir))


@register("data_summary", with_ctes("""
SELECT g.target, CAST(coalesce(s.n_hate, 0) AS BIGINT) AS n_hate, CAST(coalesce(s.n_neutral, 0) AS BIGINT) AS n_neutral
FROM groups g LEFT JOIN (
  SELECT target, count_if(tone = 'hate') AS n_hate, count_if(tone = 'neutral') AS n_neutral
  FROM (SELECT DISTINCT tone, target, text FROM corpus) GROUP BY target) s ON g.target = s.target
UNION ALL
SELECT 'overall', CAST(count_if(tone = 'hate') AS BIGINT), CAST(count_if(tone = 'neutral') AS BIGINT)
FROM (SELECT DISTINCT tone, text FROM corpus)""", "corpus", "groups"))
def data_summary_q(spark, sf_dir):
    """D3: per-group hate / neutral counts and the pooled overall line."""
    return corpus.data_summary(bindings.corpus(spark, sf_dir))


@register("distinct_tones_targets", with_ctes("""
SELECT DISTINCT 'tone' AS kind, tone AS value FROM lines WHERE tone IS NOT NULL
UNION SELECT DISTINCT 'target' AS kind, raw AS value FROM lines WHERE tone IS NOT NULL""", "lines"))
def distinct_tones_targets_q(spark, sf_dir):
    """Distinct tones and targets of the prompt file names."""
    names = _prompt_lines(spark, sf_dir).select(
        bindings.prompt_file_name(F.col("tone"), F.col("raw")).alias("file_name")).distinct()
    return corpus.distinct_tones_targets(names)


@register("union_sources", with_ctes("""
SELECT 'annotations' AS origin, CASE WHEN p.toxic_votes >= 2 THEN 'hate' ELSE 'neutral' END AS tone, t.target,
       p.sentence AS text
FROM cnt c JOIN posts p ON c.post_id = p.post_id JOIN taxonomy t ON lower(c.target) = t.raw
WHERE c.votes >= CASE WHEN p.toxic_votes >= 2 THEN 2 ELSE 1 END
UNION ALL SELECT 'prompts', tone, target, text FROM corpus
UNION ALL SELECT 'survey', CASE WHEN hate_speech_score > 0.5 THEN 'hate' ELSE 'neutral' END, target, text
FROM melt WHERE hate_speech_score IS NOT NULL""", "votes", "corpus", "taxonomy",
                                     extra=dict(_TARGETS_SQL, **_MELT_SQL)))
def union_sources_q(spark, sf_dir):
    """G1: annotations + prompts + survey in one corpus (unmapped annotation targets dropped)."""
    ann = consensus.consensus_targets(_flat_posts(spark, sf_dir))
    prompts = bindings.corpus_raw(spark, sf_dir)
    survey = clean.score_threshold_split(taxonomy.indicator_melt_join(
        bindings.wide(spark, sf_dir), bindings.wide_columns(), bindings.indicator_name,
        ["vec_id", "text", "hate_speech_score"]))
    return corpus.union_sources(ann, prompts, survey)


@register("grow_corpus", f"SELECT DISTINCT tone, target, text FROM ({ORACLES['union_sources']})")
def grow_corpus_q(spark, sf_dir):
    """A7 / G2 in batches: the three sources added one after the other to a stored corpus, only new rows written."""
    path, rows = scratch_path(spark, "grown"), union_sources_q(spark, sf_dir)
    for i, origin in enumerate(("prompts", "survey", "annotations")):
        files.append_corpus(rows.where(F.col("origin") == origin), path, i)
    return files.read_grown_corpus(spark, path)


_ALL_ROWS = """
SELECT 'annotations' AS origin, CASE WHEN p.toxic_votes >= 2 THEN 'hate' ELSE 'neutral' END AS tone, lower(c.target) AS raw,
       p.sentence AS text
FROM cnt c JOIN posts p ON c.post_id = p.post_id WHERE c.votes >= CASE WHEN p.toxic_votes >= 2 THEN 2 ELSE 1 END
UNION ALL SELECT 'prompts', tone, lower(raw), unnest(list_filter(list_transform(string_split(text, '\\n'),
       lambda x: replace(x, '-', '')), lambda x: x <> '')) FROM lines WHERE tone IS NOT NULL"""
_SURVEY_ROWS = """
SELECT CASE WHEN hate_speech_score > 0.5 THEN 'hate' ELSE 'neutral' END AS tone, target, text
FROM melt WHERE hate_speech_score IS NOT NULL"""
_BUILD_EXTRA = dict(_TARGETS_SQL, **_MELT_SQL, allrows=_ALL_ROWS, surveyrows=_SURVEY_ROWS)


def _build(spark, sf_dir):
    survey = clean.score_threshold_split(taxonomy.indicator_melt_join(
        bindings.wide(spark, sf_dir), bindings.wide_columns(), bindings.indicator_name,
        ["vec_id", "text", "hate_speech_score"]))
    return corpus.build_corpus(consensus.consensus_targets(_flat_posts(spark, sf_dir)), _prompt_lines(spark, sf_dir), survey)


@register("setup_data", with_ctes(f"""
SELECT DISTINCT tone, target, text FROM (
  SELECT a.tone, t.target, {strip_sql('a.text')} AS text FROM allrows a JOIN taxonomy t ON a.raw = t.raw
  UNION ALL SELECT tone, target, {strip_sql('text')} FROM surveyrows) WHERE text <> ''""",
                                  "votes", "lines", "taxonomy", extra=_BUILD_EXTRA))
def setup_data_q(spark, sf_dir):
    """The corpus build as one job: three sources cleaned, mapped, stripped, deduplicated per
    (tone, group), written by folder and read back."""
    path = scratch_path(spark, "setup")
    files.write_corpus(_build(spark, sf_dir)[0], path)
    return files.read_corpus(spark, path).select("tone", "target", "text")


@register("setup_quarantine", with_ctes("""
SELECT a.origin, a.raw, CAST(count(*) AS BIGINT) AS n FROM allrows a
WHERE a.raw NOT IN (SELECT raw FROM taxonomy) GROUP BY a.origin, a.raw""", "votes", "lines", "taxonomy", extra=_BUILD_EXTRA))
def setup_quarantine_q(spark, sf_dir):
    """Rows of the corpus build whose raw name has no group, counted by source and name."""
    return _build(spark, sf_dir)[1]


# --------------------------------------------------------------------------- C4, D5, D6, F4

_FILES = {"files": """
    SELECT DISTINCT l.tone, l.target, g.target_id, l.text FROM lines l JOIN groups g ON l.target = g.target
    WHERE l.tone IS NOT NULL"""}


@register("multi_hot_join", with_ctes("""
SELECT p.tone, p.text, f.tone AS file_tone, f.target
FROM (SELECT DISTINCT tone, text FROM files) p JOIN files f ON p.text = f.text""", "lines", "groups", extra=_FILES))
def multi_hot_join_q(spark, sf_dir):
    """C4: pooled sentences joined to every group file holding them."""
    return labels.multi_hot_join(_lines(spark, sf_dir))


@register("multi_hot", with_ctes("""
SELECT p.tone, p.text,
       array_to_string(list_transform(range(0, 11), lambda i: CASE WHEN list_contains(m.ids, i) THEN 1 ELSE 0 END), ',')
         AS labels
FROM (SELECT DISTINCT tone, text FROM files) p
JOIN (SELECT text, list(DISTINCT target_id) AS ids FROM files GROUP BY text) m ON p.text = m.text""",
                                 "lines", "groups", extra=_FILES))
def multi_hot_q(spark, sf_dir):
    """11-slot multi-hot group vector per pooled sentence."""
    out = labels.multi_hot(_lines(spark, sf_dir))
    return out.select("tone", "text", F.array_join(F.transform("labels", lambda x: x.cast("string")), ",").alias("labels"))


@register("class_weights", with_ctes("""
SELECT target_id, n, round(n / sum(n) OVER (), 6) AS weight
FROM (SELECT target_id, count(*) AS n FROM g5 GROUP BY target_id)""", "lines", "groups", extra={"g5": _G5}))
def class_weights_q(spark, sf_dir):
    """Relative class frequencies of the group-id table."""
    out = labels.class_weights(corpus.gather_group_ids(_lines(spark, sf_dir)))
    return out.select("target_id", "n", r6("weight").alias("weight"))


@register("sorted_class_counts", with_ctes(
    "SELECT target_id, count(*) AS n FROM g5 GROUP BY target_id ORDER BY target_id", "lines", "groups",
    extra={"g5": _G5}))
def sorted_class_counts_q(spark, sf_dir):
    """value counts of the group-id table, ordered by class."""
    return labels.sorted_class_counts(corpus.gather_group_ids(_lines(spark, sf_dir)))


# --------------------------------------------------------------------------- E5-E7, F2, F3

_H = hash_sql("doc_id")
_HS = hash_sql("doc_id", vocab.SAMPLE_SEED)
_HB = hash_sql("doc_id", vocab.BATCH_SEED)
_RANKED = {"rk": f"""
    SELECT doc_id, target, tone, row_number() OVER (PARTITION BY target, tone ORDER BY {_HS}, doc_id) - 1 AS r,
           count(*) OVER (PARTITION BY target, tone) AS n
    FROM corpus""",
           "pg": """
    SELECT target, min(CASE WHEN tone = 'hate' THEN n END) AS nh, min(CASE WHEN tone = 'neutral' THEN n END) AS nn
    FROM rk GROUP BY target"""}


@register("balanced_downsample", with_ctes("""
SELECT rk.doc_id, rk.target, rk.tone FROM rk JOIN pg ON rk.target = pg.target
WHERE rk.r < CASE WHEN pg.nh IS NOT NULL AND pg.nn IS NOT NULL THEN least(pg.nh, pg.nn) ELSE rk.n END""",
                                           "corpus", extra=_RANKED))
def balanced_downsample_q(spark, sf_dir):
    """E5: both tones of each group cut to the smaller size (hash order, sampling seed)."""
    c = bindings.corpus(spark, sf_dir).select("doc_id", "target", "tone")
    return sampling.balanced_downsample(c).select("doc_id", "target", "tone")


@register("mixed_batches", with_ctes("""
SELECT rk.doc_id, rk.target, rk.tone, CAST(rk.r // 16 AS BIGINT) AS batch_id FROM rk JOIN pg ON rk.target = pg.target
WHERE rk.r < least(coalesce(pg.nh, 0), coalesce(pg.nn, 0))""", "corpus", extra=_RANKED))
def mixed_batches_q(spark, sf_dir):
    """Batch i of a group pairs the i-th 16 hate rows with the i-th 16 neutral rows."""
    c = bindings.corpus(spark, sf_dir).select("doc_id", "target", "tone")
    return sampling.mixed_batches(c, 16).select("doc_id", "target", "tone", "batch_id")


@register("assign_batches", with_ctes(f"""
SELECT doc_id, CAST((row_number() OVER (ORDER BY {_HB}, doc_id) - 1) // 16 AS BIGINT) AS batch_id FROM corpus""",
                                      "corpus"))
def assign_batches_q(spark, sf_dir):
    """Shuffled batches of 16 over the corpus."""
    c = bindings.corpus(spark, sf_dir).select("doc_id")
    return sampling.assign_batches(c, 16).select("doc_id", "batch_id")


_KEY_SQL = "CAST(target_id AS VARCHAR) || ':' || text"


@register("sample_n", with_ctes(f"""
SELECT target_id, text FROM g5 ORDER BY {hash_sql(_KEY_SQL, vocab.SAMPLE_SEED)}, {_KEY_SQL}
LIMIT {vocab.HEAD_TEST_ROWS}""",
                                "lines", "groups", extra={"g5": _G5}))
def sample_n_q(spark, sf_dir):
    """the 1,000-row head test set drawn from the group-id table."""
    g5 = corpus.gather_group_ids(_lines(spark, sf_dir))
    keyed = g5.withColumn("row_key", F.concat(F.col("target_id").cast("string"), F.lit(":"), F.col("text")))
    return sampling.sample_n(keyed, vocab.HEAD_TEST_ROWS, key="row_key").select("target_id", "text")


@register("train_test_split", with_ctes(f"""
SELECT doc_id, CASE WHEN {_H} < {int(vocab.TEST_FRACTION * (1 << 32))} THEN 'test' ELSE 'train' END AS split
FROM corpus""", "corpus"))
def train_test_split_q(spark, sf_dir):
    """80/20 hash split, seed 38."""
    c = bindings.corpus(spark, sf_dir).select("doc_id")
    return sampling.train_test_split(c).select("doc_id", "split")
