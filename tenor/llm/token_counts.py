"""Token counts of whole texts under a public word-BPE vocabulary.

Method: a vocabulary string is *whole* when merging its own symbols ends in
that one token. This is proved once, on the driver, for every entry
(``WordBpe.prove_whole``). At run time a text is cut at ASCII white space, a
chunk into pre-tokens by the vocabulary's own normaliser and splitter; a
pre-token in the proved set counts one, and only the rest is merged (by the
library's merge step alone).

The counts equal the public library's (no begin / end tokens added, special
strings inside a text are one token each, no truncation). Cutting at ASCII
white space first is exact: the splitter drops white space, so no pre-token
spans it, and neither composition nor lower-casing looks across it.

Null and empty texts count 0 tokens; equal chunks are counted once per worker
through a bounded memo (an entry count, never a limit on what is counted).
"""

from __future__ import annotations

import heapq
import json
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WORD_FILE = "word_bpe_49k.json"
TOKEN_LIMIT = 2048
MEMO_ENTRIES = 400_000
MEMO_CHARS = 64
SHORT = 32
_SPACES = "\t\n\r\x0b\x0c"
# The vocabulary's splitter on lower-cased printable ASCII without white space.
_ASCII_PIECES = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^a-z0-9]+")
# Fixed values of the tokenizer file that the cuts above rely on.
_NORMAL = ["NFC", "Replace", "Lowercase"]
_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_PLAIN_MODEL = {"type": "BPE", "dropout": None, "unk_token": None, "continuing_subword_prefix": None, "fuse_unk": False,
                "byte_fallback": False, "ignore_merges": False}
_PLAIN_TOKEN = {"single_word": False, "lstrip": False, "rstrip": False, "normalized": False}


def default_path() -> str:
    import public_tokenizers
    return public_tokenizers.path(WORD_FILE)


def refuse_others(spec: dict, path: str) -> None:
    """An error for a file whose normaliser, splitter, merges or special strings work otherwise than the count assumes:
    its texts would be counted wrongly."""
    normal = (spec["normalizer"] or {}).get("normalizers", [])
    split = (spec["pre_tokenizer"] or {}).get("pretokenizers", [{}])
    spaces = [n.get("pattern") for n in normal if n["type"] == "Replace"]
    fits = ([n["type"] for n in normal] == _NORMAL and spaces == [{"Regex": r"\s+"}]
            and [p.get("type") for p in split] == ["Split", "ByteLevel"] and split[0]["pattern"] == {"Regex": _SPLIT}
            and split[0]["behavior"] == "Removed" and split[0]["invert"]
            and not split[1]["add_prefix_space"] and not split[1]["use_regex"]
            and all(spec["model"].get(k) == v for k, v in _PLAIN_MODEL.items())
            and all(t[k] == v for t in spec["added_tokens"] for k, v in _PLAIN_TOKEN.items()))
    if not fits:
        raise ValueError(f"{path}: not a lower-casing word vocabulary of the kind whose tokens this operator counts")


class WordBpe:
    """Vocabulary, merge ranks and special strings of one tokenizer file (bounded by the file)."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        refuse_others(spec, path)
        self.path = path
        self.suffix = model["end_of_word_suffix"] or ""
        self.vocab = set(model["vocab"])
        pairs = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        self.ranks = {p: i for i, p in enumerate(pairs)}
        self.special = [t["content"] for t in spec["added_tokens"]]

    def merge(self, piece: str) -> list[str]:
        """Tokens of one pre-token: the lowest-ranked pair first, leftmost on ties."""
        sym = list(piece)
        if not sym:
            return []
        sym[-1] += self.suffix
        if len(sym) > SHORT:
            return self._merge_long(sym)
        get, none = self.ranks.get, len(self.ranks)
        while len(sym) > 1:
            order = [get(p, none) for p in zip(sym, sym[1:])]
            best = min(order)
            if best == none:
                break
            i = order.index(best)
            sym[i:i + 2] = [sym[i] + sym[i + 1]]
        return [s for s in sym if s in self.vocab]

    def _merge_long(self, sym: list[str | None]) -> list[str]:
        """The same with a heap over a linked list (n log n)."""
        n = len(sym)
        nxt, prv = list(range(1, n + 1)), list(range(-1, n - 1))
        ranks = self.ranks
        heap = [(r, i, sym[i], sym[i + 1]) for i in range(n - 1) if (r := ranks.get((sym[i], sym[i + 1]))) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, a, b = heapq.heappop(heap)
            j = nxt[i]
            if sym[i] != a or j >= n or sym[j] != b:
                continue  # one side was merged meanwhile
            sym[i], sym[j] = a + b, None
            nxt[i] = nxt[j]
            if nxt[j] < n:
                prv[nxt[j]] = i
            p, q = prv[i], nxt[i]
            if p >= 0 and (r := ranks.get((sym[p], sym[i]))) is not None:
                heapq.heappush(heap, (r, p, sym[p], sym[i]))
            if q < n and (r := ranks.get((sym[i], sym[q]))) is not None:
                heapq.heappush(heap, (r, i, sym[i], sym[q]))
        return [s for s in sym if s is not None and s in self.vocab]

    def prove_whole(self) -> frozenset[str]:
        """Pre-tokens (without the word-end mark) that encode alone as exactly one token."""
        cut = len(self.suffix)
        ends = [v[:-cut] if cut else v for v in self.vocab if v.endswith(self.suffix) and len(v) > cut]
        return frozenset(p for p in ends if self.merge(p) == [p + self.suffix])


class ChunkCounter(dict):
    """Memo of tokens per white-space free chunk."""

    def __init__(self, bpe: WordBpe, whole: frozenset[str]):
        super().__init__({"": 0})
        from tokenizers import Tokenizer
        lib = Tokenizer.from_file(bpe.path)
        self.normalize, self.split = lib.normalizer.normalize_str, lib.pre_tokenizer.pre_tokenize_str
        self.merge = lib.model.tokenize  # the vocabulary's merges, run natively
        self.bpe, self.whole = bpe, whole

    def plain(self, chunk: str) -> int:
        if chunk.isascii() and chunk.isprintable():
            pieces = _ASCII_PIECES.findall(chunk.lower())
        else:
            pieces = [p for p, _ in self.split(self.normalize(chunk))]
        n = 0
        for p in pieces:
            n += 1 if p in self.whole else len(self.merge(p))
        return n

    def cut_special(self, chunk: str) -> int:
        """A chunk with special strings: each is one token, the parts between are ordinary text."""
        found = [(i, -len(s), s) for s in self.bpe.special if (i := chunk.find(s)) >= 0]
        n = 0
        while found:
            i, _, s = min(found)
            n += 1 + (self.plain(chunk[:i]) if i else 0)
            chunk = chunk[i + len(s):]
            found = [(i, -len(s), s) for s in self.bpe.special if (i := chunk.find(s)) >= 0]
        return n + (self.plain(chunk) if chunk else 0)

    def __missing__(self, chunk: str) -> int:
        n = self.cut_special(chunk) if any(s in chunk for s in self.bpe.special) else self.plain(chunk)
        if len(chunk) <= MEMO_CHARS:
            if len(self) > MEMO_ENTRIES:
                self.clear()
                self[""] = 0
            self[chunk] = n
        return n

    def text(self, text: str) -> int:
        for c in _SPACES:
            if c in text:
                text = text.replace(c, " ")
        return sum(map(self.__getitem__, text.split(" ")))


def count_tokens(df: DataFrame, text: str = "text", out: str = "n_tokens", path: str | None = None) -> DataFrame:
    """Add ``out``: the library's token count of every whole text (null: 0). Row-local, no shuffle;
    the broadcast holds the proved vocabulary strings, bounded by the tokenizer file."""
    bpe = WordBpe(path or default_path())
    shared = df.sparkSession.sparkContext.broadcast((bpe, bpe.prove_whole()))

    @F.pandas_udf("long")
    def tokens(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        counter = ChunkCounter(*shared.value)
        for texts in batches:
            yield pd.Series([counter.text(t) for t in texts], dtype="int64")

    return df.withColumn(out, tokens(F.coalesce(F.col(text), F.lit(""))))


def digest(docs: DataFrame, limit: int = TOKEN_LIMIT, path: str | None = None) -> DataFrame:
    """Per document: doc_id, n_bytes, n_tokens, over_limit."""
    base = docs.select("doc_id", "text", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"))
    return count_tokens(base, path=path).select(
        "doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > F.lit(limit)).alias("over_limit"))
