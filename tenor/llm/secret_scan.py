"""Secrets in texts: fixed patterns, and sliding-window entropy over candidate strings.

Patterns (``assign``, ``access``, ``hex``) are matched leftmost and without overlap, per
kind, on the whole text. The entropy part adds spans of kind ``entropy``:

* A candidate is a maximal run of one character class (CLASSES) at least as long as the
  class's window. All candidates of a batch lie behind each other in one byte array.
* A window slides over that array. Its entropy is ``log2 W - sum(c log2 c) / W`` over the
  counts c of its characters, and a step changes two of them: that of the leaving and
  that of the entering character. The sum is kept in integers (2^-32 bits), so it is
  exact and does not depend on where a batch begins.
* A window counts when it lies in one candidate, reaches its class's threshold and holds both
  digits and letters; windows that touch or overlap are one span.
* Allow-list: spans inside a match of ALLOW (identifiers, dates and digests that are public by
  their form), spans whose text is in ``allow``, spelled-out alphabets, and spans that a
  pattern has found already are left out.

A null text is empty; an empty text has no span; repeated rows and rows without an id are
scanned like any other. Positions are code points, ends exclusive. Other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_KEYWORDS = ("password", "passwd", "secret", "token")
_ANY_CASE = "|".join("".join(f"[{c.upper()}{c}]" for c in w) for w in _KEYWORDS) + "|[Aa][Pp][Ii]_?[Kk][Ee][Yy]"
#: kind -> (pattern, group whose length counts, least length), in the order of equal starts
PATTERNS = {
    "assign": (re.compile(rf"({_ANY_CASE})[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"), 2, 6),
    "access": (re.compile(r"AKIA[A-Z0-9]+"), 0, 20),
    "hex": (re.compile(r"[0-9a-f]{24,}"), 0, 24),  # a run is maximal, so shorter ones need no match
}
KINDS = (*PATTERNS, "entropy")
#: class -> (characters, window, least bits per character)
CLASSES = {"hex": ("0-9A-Fa-f", 24, 3.0), "base64": ("A-Za-z0-9+/_=-", 24, 3.9)}
#: Strings that are public by their form.
ALLOW = re.compile("|".join((
    r"[0-9A-Fa-f]{8}(?:-[0-9A-Fa-f]{4}){3}-[0-9A-Fa-f]{12}",   # UUID
    r"sha(?:1|256|384|512)[-:][A-Za-z0-9+/=]+",                # checksums of packages
    r"https?://[^\s\"'<>?]+",                                  # paths of links; their parameters are scanned
    r"data:[a-z]+/[a-z0-9.+-]+;base64,[A-Za-z0-9+/=]+",        # embedded pictures
    r"[A-Za-z0-9_-]*EXAMPLE[A-Za-z0-9_-]*")))                  # documentation keys
CHUNK = 1 << 20
SPANS = "array<struct<kind:string,start:bigint,stop:bigint>>"
_BITS = 1 << 32


def pattern_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, stop, kind) of every pattern match that is long enough."""
    return [(m.start(), m.end(), kind) for kind, (pattern, group, least) in PATTERNS.items()
            for m in pattern.finditer(text) if m.end(group) - m.start(group) >= least]


def window_sums(x: np.ndarray, window: int) -> np.ndarray:
    """Sum of c log2 c (in 2^-32) over the character counts of every window of ``x``."""
    table = np.arange(window + 1, dtype=np.float64)
    table[1:] = np.round(table[1:] * np.log2(table[1:]) * _BITS)
    table = table.astype(np.int64)
    first = table[np.bincount(x[:window], minlength=256)].sum()
    n = len(x) - window  # steps
    left, right = np.zeros(n, np.int64), np.zeros(n, np.int64)
    for j in range(1, window):
        left += x[:n] == x[j:j + n]                                    # the leaving character, elsewhere in the window
        right += x[window:] == x[window - j:window - j + n]            # the entering one, what it leaves excluded
    steps = table[left] - table[left + 1] + table[right + 1] - table[right]
    return np.concatenate(([first], first + np.cumsum(steps)))


def entropy_windows(x: np.ndarray, run: np.ndarray, window: int, bits: float) -> np.ndarray:
    """Starts of the windows of ``x`` that count; ``run`` numbers the candidate of every character."""
    if len(x) < window:
        return np.empty(0, np.int64)
    whole = run[window - 1:] == run[:len(run) - window + 1]
    digits = np.concatenate(([0], np.cumsum((x >= 48) & (x <= 57))))
    signs = np.concatenate(([0], np.cumsum(~(((x >= 48) & (x <= 57)) | ((x | 32) >= 97) & ((x | 32) <= 122)))))
    d, s = digits[window:] - digits[:-window], signs[window:] - signs[:-window]
    most = int((np.log2(window) - bits) * window * _BITS)
    return np.flatnonzero(whole & (d > 0) & (d + s < window) & (window_sums(x, window) <= most))


def candidates(texts: list[str], pattern: re.Pattern) -> Iterator[tuple[list[tuple[int, int]], bytes, np.ndarray]]:
    """(text and start of every candidate, their bytes, number of each byte's candidate), in
    chunks of about CHUNK bytes; a longer candidate is one chunk."""
    at, parts, size = [], [], 0

    def chunk():
        run = np.repeat(np.arange(len(parts)), [len(p) for p in parts])
        return at, "".join(parts).encode(), run

    for i, text in enumerate(texts):
        for m in pattern.finditer(text):
            at.append((i, m.start()))
            parts.append(m.group())
            size += len(parts[-1])
            if size >= CHUNK:
                yield chunk()
                at, parts, size = [], [], 0
    if parts:
        yield chunk()


def merged(spans: Iterable[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for lo, hi in sorted(spans):
        if out and lo <= out[-1][1]:
            out[-1] = (out[-1][0], max(hi, out[-1][1]))
        else:
            out.append((lo, hi))
    return out


def alphabet(s: str, share: float = 0.75) -> bool:
    """A spelled-out alphabet: most neighbours follow each other in the code table."""
    return sum(ord(b) - ord(a) == 1 for a, b in zip(s, s[1:])) >= share * (len(s) - 1)


def entropy_spans(texts: list[str]) -> list[list[tuple[int, int]]]:
    """Merged entropy spans of every text, before the allow-list."""
    found: list[list[tuple[int, int]]] = [[] for _ in texts]
    for chars, window, bits in CLASSES.values():
        for at, raw, run in candidates(texts, re.compile(f"[{chars}]{{{window},}}")):
            x = np.frombuffer(raw, np.uint8)
            starts = entropy_windows(x, run, window, bits)
            if len(starts) == 0:
                continue
            cut = np.flatnonzero((np.diff(starts) > window) | (np.diff(run[starts]) > 0)) + 1
            begin = np.searchsorted(run, np.arange(len(at)))
            for lo, hi in zip(starts[np.concatenate(([0], cut))], starts[np.concatenate((cut, [len(starts)])) - 1]):
                i, pos = at[run[lo]]
                offset = pos - int(begin[run[lo]])
                found[i].append((int(lo) + offset, int(hi) + window + offset))
    return [merged(f) for f in found]


def suppressed(text: str, spans: list[tuple[int, int]], base: list[tuple[int, int, str]], allow: frozenset) -> list[tuple[int, int]]:
    """The entropy spans of a text that neither the allow-list nor a pattern covers."""
    if not spans:
        return []
    known = merged([(lo, hi) for lo, hi, _ in base])
    known = merged(known + [m.span() for m in ALLOW.finditer(text)])
    starts = np.array([lo for lo, _ in known] or [0])
    out = []
    for lo, hi in spans:
        k = int(np.searchsorted(starts, lo, side="right")) - 1
        covered = bool(known) and k >= 0 and known[k][1] >= hi
        if not covered and text[lo:hi] not in allow and not alphabet(text[lo:hi]):
            out.append((lo, hi))
    return out


def scan(docs: DataFrame, key: str = "doc_id", text: str = "text", allow: Iterable[str] = ()) -> DataFrame:
    """(doc_id, spans ARRAY<STRUCT<kind, start, stop>>) per row, by start, then kind (KINDS).
    ``allow``: strings that are no secret although they look like one (a short list)."""
    listed = frozenset(allow)
    rank = {k: i for i, k in enumerate(KINDS)}

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind_type = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("stop", pa.int64())]))
        for batch in batches:
            texts = batch.column("text").to_pylist()
            rows = []
            for t, extra in zip(texts, entropy_spans(texts)):
                base = pattern_spans(t)
                every = base + [(lo, hi, "entropy") for lo, hi in suppressed(t, extra, base, listed)]
                every.sort(key=lambda s: (s[0], rank[s[2]], s[1]))
                rows.append([{"kind": k, "start": lo, "stop": hi} for lo, hi, k in every])
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(rows, kind_type)], names=["doc_id", "spans"])

    slim = docs.select(F.col(key).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    return slim.mapInArrow(find, f"doc_id long, spans {SPANS}")


def redact(text: Column, spans: Column, mark: str = "[secret]") -> Column:
    """The text with every span replaced by ``mark``; spans that overlap are replaced once."""
    step = F.aggregate(spans, F.struct(F.lit(1).cast("long").alias("at"), F.lit("").alias("out")), lambda acc, s: F.when(
        s["start"] + 1 >= acc["at"], F.struct((s["stop"] + 1).alias("at"), F.concat(
            acc["out"], F.substr(text, acc["at"].cast("int"), (s["start"] + 1 - acc["at"]).cast("int")), F.lit(mark)).alias("out"))
    ).otherwise(F.struct(F.greatest(acc["at"], s["stop"] + 1).alias("at"), acc["out"].alias("out"))))
    return F.concat(step["out"], F.substr(text, step["at"].cast("int")))


def digest(docs: DataFrame, **options) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans (as ``kind:start:stop``, comma-joined)."""
    def line(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["stop"])), ",")

    def only(*kinds: str) -> Column:
        return F.filter("spans", lambda s: s["kind"].isin(*kinds))

    return scan(docs, **options).select(
        "doc_id", *[F.size(only(k)).cast("long").alias(f"n_{k}") for k in PATTERNS],
        F.sha2(line(only(*PATTERNS)), 256).alias("base_sha256"), line(F.col("spans")).alias("spans"))
