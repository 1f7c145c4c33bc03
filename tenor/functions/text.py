"""Text column expressions (H1-H5) and the stable hash used for sampling.

All are built-in Spark expressions, so they stay inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tenor import vocab

# Word-piece vocabularies are not available; token ids are hashed into a
# vocabulary of the public BERT size, 0 is the padding id.
VOCAB_SIZE = 30522
MAX_LEN = 512

# The white space of Python's ``str.strip()``, as a regex class.
PY_SPACE = r"[\t\n\x0b\x0c\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
_WS_EDGES = rf"^{PY_SPACE}+|{PY_SPACE}+$"
_TOKEN_SPLIT = r"[\s\p{Punct}]+"


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def strip_text(col) -> Column:
    """Python-style ``str.strip()``: whitespace removed at both ends (``trim`` only removes spaces)."""
    return F.regexp_replace(_c(col), _WS_EDGES, "")


def join_tokens(col, sep: str = " ") -> Column:
    """Tokens joined by a space (the sentence of an annotated post)."""
    return F.array_join(_c(col), sep)


def flatten_targets(col) -> Column:
    """List of per-annotator target lists flattened into one list (repeats kept)."""
    return F.flatten(_c(col))


def tokens(col) -> Column:
    """Lower-case word tokens: split at whitespace and ASCII punctuation, empties removed."""
    return F.filter(F.split(F.lower(_c(col)), _TOKEN_SPLIT), lambda t: t != F.lit(""))


def hash32(col) -> Column:
    """First 32 bits of the md5 of a string, as a non-negative BIGINT."""
    return F.conv(F.substring(F.md5(_c(col).cast("string")), 1, 8), 16, 10).cast("bigint")


def seeded_hash(key, seed: int = vocab.SPLIT_SEED) -> Column:
    """Stable per-key hash ``md5('{seed}:{key}')``; independent of partitioning and run."""
    return hash32(F.concat(F.lit(f"{seed}:"), _c(key).cast("string")))


def token_id(tok: Column, vocab_size: int = VOCAB_SIZE) -> Column:
    """Hashed token id in 1 .. vocab_size-1 (0 is padding)."""
    return (F.lit(1) + F.pmod(hash32(tok), F.lit(vocab_size - 1))).cast("int")


def token_ids(tok_col, vocab_size: int = VOCAB_SIZE) -> Column:
    """ARRAY<INT>: hashed id of every token."""
    return F.transform(_c(tok_col), lambda t: token_id(t, vocab_size))


def encode_windows(ids_col, max_len: int = MAX_LEN) -> Column:
    """ARRAY<STRUCT(input_ids, attention_mask, token_type_ids)>: a whole id sequence
    (see :func:`token_ids`; pass it as its own column, it is read once per window)
    encoded as consecutive ``max_len`` windows, the last one padded, so no token is
    cut off; an empty text gives one all-padding window."""
    ids = _c(ids_col)
    n_windows = F.greatest(F.lit(1), F.ceil(F.size(ids) / F.lit(max_len)).cast("int"))

    def window(w):
        part = F.slice(ids, w * max_len + 1, max_len)
        pad = F.lit(max_len) - F.size(part)
        return F.struct(
            F.concat(part, F.array_repeat(F.lit(0), pad)).alias("input_ids"),
            F.concat(F.array_repeat(F.lit(1), F.size(part)), F.array_repeat(F.lit(0), pad)).alias("attention_mask"),
            F.array_repeat(F.lit(0), F.lit(max_len)).alias("token_type_ids"))

    return F.transform(F.sequence(F.lit(0), n_windows - 1), window)
