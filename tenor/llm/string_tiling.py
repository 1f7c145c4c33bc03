"""Benchmark decontamination by greedy string tiling.

Words are lower-cased (A-Z) runs of non-space bytes with leading and trailing
ASCII punctuation left in place. A *seed* is a run of MIN_MATCH (five) words.

1. Benchmark seeds fill a bitmap of fixed size (2**BITS bits, whatever the
   benchmark's size); documents are scanned once and keep only the stretches of words
   whose seeds hit it, so almost nothing of a clean document is shuffled.
2. Seeds join documents and items. A pair needs at least the seeds that tiles of
   MIN_MATCH words must bring to reach the coverage; other pairs stop here.
3. Every remaining pair is tiled: running Karp-Rabin with search lengths from the
   item's length downwards (halving, at least MIN_MATCH) finds the longest
   non-overlapping matches first and marks their words in the document and the item, so
   passages whose sentences were reordered are covered piece by piece.
4. A pair is a leak when at least COVERAGE of the item's words are marked.

Items of fewer than MIN_MATCH words never match (five common words in a row would
not prove a leak). Null and empty texts have no words. Repeated items are tiled each;
rows with one doc_id count as one document, whose stretches come from all its rows.
"""

from __future__ import annotations

from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tenor.llm import textkit
from tenor.llm.blocks import row_hash, shielded, stored, unshielded

MIN_MATCH = 5
COVERAGE = 0.5
BITS = 24
U = np.uint64
_P, _M = 1_000_003, (1 << 61) - 1


def _words_and_seeds(column, k: int):
    """Per slice: (first text, texts, word hashes, first word of each text, seeds, seed start)."""
    raw, offsets = textkit.buffers(column)
    for lo, hi in textkit.slices(offsets):
        h, first, _, _ = textkit.word_hashes(raw[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo])
        seeds, text = textkit.shingles(h, first, k)
        # seed j of a text starts at its word j
        start = np.arange(len(seeds)) + (first[text] - np.searchsorted(text, text)) if len(seeds) else np.empty(0, np.int64)
        yield lo, hi - lo, h, first, seeds, start


def item_words(items: DataFrame, k: int, key: str, text: str) -> DataFrame:
    """(item_id, rid, words, seeds) of every item with at least k words."""
    def parse(batches):
        for batch in batches:
            table = pa.Table.from_batches([batch])
            ids, rid = table.column("item_id").to_pylist(), table.column("rid").to_pylist()
            out = {"item_id": [], "rid": [], "words": [], "seeds": []}
            for lo, n, h, first, seeds, start in _words_and_seeds(table.column("text"), k):
                for i in range(n):
                    words = h[first[i]:first[i + 1]]
                    if len(words) >= k:
                        at = (start >= first[i]) & (start < first[i + 1])
                        out["item_id"].append(ids[lo + i])
                        out["rid"].append(rid[lo + i])
                        out["words"].append(words.view(np.int64))
                        out["seeds"].append(seeds[at].view(np.int64))
            ls = pa.list_(pa.int64())
            yield pa.RecordBatch.from_pydict({"item_id": pa.array(out["item_id"], pa.int64()),
                                              "rid": pa.array(out["rid"], pa.int64()),
                                              "words": pa.array(out["words"], ls), "seeds": pa.array(out["seeds"], ls)})

    rows = items.select(F.col(key).cast("long").alias("item_id"), F.xxhash64(key, text).alias("rid"),
                        F.coalesce(F.col(text), F.lit("")).alias("text")).dropDuplicates(["rid", "item_id"])
    return rows.mapInArrow(parse, "item_id long, rid long, words array<long>, seeds array<long>")


def _bitmap(items: DataFrame, bits: int) -> np.ndarray:
    """2**bits flags; at most 2**bits / 64 rows reach the driver."""
    slot = F.expr(f"pmod(shiftrightunsigned(s, {64 - bits}), {1 << bits})")
    parts = (items.select(F.explode("seeds").alias("s")).select(slot.alias("b"))
             .groupBy(F.shiftright("b", 6).alias("w"))
             .agg(F.bit_or(F.expr("shiftleft(1L, cast(b & 63 as int))")).alias("v")).toArrow())
    words = np.zeros(1 << (bits - 6), np.int64)
    words[parts.column("w").to_numpy()] = parts.column("v").to_numpy()
    return np.unpackbits(words.view(np.uint8), bitorder="little").view(bool)


def _stretches(docs: DataFrame, shared, bits: int, k: int) -> DataFrame:
    """(doc_id, words, seeds): maximal runs of words whose seeds all hit the bitmap."""
    def scan(batches):
        flags = shared.value
        for batch in batches:
            table = pa.Table.from_batches([batch])
            ids = table.column("doc_id").to_pylist()
            out = {"doc_id": [], "words": [], "seeds": []}
            for lo, n, h, first, seeds, start in _words_and_seeds(table.column("text"), k):
                hit = np.flatnonzero(flags[(seeds >> U(64 - bits)).astype(np.int64)])
                if not len(hit):
                    continue
                s = start[hit]
                doc = np.searchsorted(first, s, side="right") - 1
                cut = np.flatnonzero((np.diff(s) != 1) | (np.diff(doc) != 0)) + 1
                for part in np.split(np.arange(len(hit)), cut):
                    a, b = s[part[0]], s[part[-1]] + k
                    out["doc_id"].append(ids[lo + doc[part[0]]])
                    out["words"].append(h[a:b].view(np.int64))
                    out["seeds"].append(seeds[hit[part]].view(np.int64))
            ls = pa.list_(pa.int64())
            yield pa.RecordBatch.from_pydict({"doc_id": pa.array(out["doc_id"], pa.int64()),
                                              "words": pa.array(out["words"], ls), "seeds": pa.array(out["seeds"], ls)})

    return docs.mapInArrow(scan, "doc_id long, words array<long>, seeds array<long>")


def _matches(pattern: np.ndarray, free_p: np.ndarray, text: np.ndarray, free_t: np.ndarray, s: int):
    """Longest matches of at least ``s`` unmarked words (start in pattern, start in text, length)."""
    def windows(seq, free):
        """Karp-Rabin hashes of unmarked windows of s words."""
        if len(seq) < s:
            return
        top, h, run = pow(_P, s - 1, _M), 0, 0
        for i, (x, f) in enumerate(zip(seq, free)):
            if not f:
                h, run = 0, 0
                continue
            if run >= s:
                h -= seq[i - s] * top
            h = (h * _P + x) % _M
            run += 1
            if run >= s:
                yield h, i - s + 1

    at = defaultdict(list)
    for h, i in windows(text, free_t):
        at[h].append(i)
    found = []
    for h, p in windows(pattern, free_p):
        for t in at.get(h, ()):
            n = 0
            while (p + n < len(pattern) and t + n < len(text) and free_p[p + n] and free_t[t + n]
                   and pattern[p + n] == text[t + n]):
                n += 1
            if n >= s:
                found.append((n, p, t))
    return found


def tile(pattern: list[int], text: list[int], k: int) -> list[tuple[int, int, int]]:
    """Tiles (length, start in pattern, start in text): longest first, non-overlapping."""
    free_p, free_t, tiles = [True] * len(pattern), [True] * len(text), []
    s = max(k, len(pattern))
    while True:
        found = _matches(pattern, free_p, text, free_t, s)
        longest = max((n for n, _, _ in found), default=0)
        if longest > 2 * s:  # look again with the longer search length
            s = longest
            continue
        for n, p, t in sorted(found, key=lambda m: (-m[0], m[1], m[2])):
            if all(free_p[p:p + n]) and all(free_t[t:t + n]):
                free_p[p:p + n] = [False] * n
                free_t[t:t + n] = [False] * n
                tiles.append((n, p, t))
        if s == k:
            if found and any(True for _ in _matches(pattern, free_p, text, free_t, s)):
                continue  # parts of matches cut by longer tiles
            return tiles
        s = max(k, s // 2)


def leaks(docs: DataFrame, items: DataFrame, k: int = MIN_MATCH, coverage: float = COVERAGE, bits: int = BITS,
          key: str = "doc_id", text: str = "text", item_key: str = "item_id", item_text: str = "text",
          copies: DataFrame | None = None) -> DataFrame:
    """(doc_id, item_id, item_words, covered_words, coverage, n_tiles, longest_tile) of every
    document and item whose coverage reaches the threshold. ``copies``: (doc_id, copies) of the
    keys whose rows are all equal and count as one of them. A row without an id is judged by its text and reported with a null id."""
    spark = docs.sparkSession
    bench = stored(item_words(items, k, item_key, item_text), "items")
    shared = spark.sparkContext.broadcast(_bitmap(bench, bits))
    body = F.coalesce(F.col(text), F.lit(""))
    unnamed = F.xxhash64(F.lit("no id"), body)  # stands for a null id until the end
    slim = docs.select(F.coalesce(F.col(key).cast("long"), unnamed).alias("doc_id"), body.alias("text"))
    runs = stored(_stretches(slim, shared, bits, k), "stretches")
    by_seed = (bench.select("rid", F.size("words").alias("n"), F.explode("seeds").alias("s"))
               .groupBy("rid", "n", "s").agg(F.count(F.lit(1)).alias("many")))
    pairs = (runs.select("doc_id", F.explode(F.array_distinct("seeds")).alias("s")).distinct()
             .join(by_seed, "s").groupBy("doc_id", "rid", "n").agg(F.sum("many").alias("_seeds"))
             .where(F.col("_seeds") * k >= F.ceil(coverage * F.col("n"))).select("doc_id", "rid"))
    # the stretches that share a seed with the item, and the item itself
    use = (runs.withColumn("_run", F.xxhash64("words")).select("doc_id", "_run", F.explode(F.array_distinct("seeds")).alias("s"))
           .join(by_seed.select("rid", "s"), "s").select("doc_id", "_run", "rid").distinct().join(pairs, ["doc_id", "rid"]))
    # equal stretches of a document travel once, with their number
    words = runs.withColumn("_run", F.xxhash64("words")).groupBy("doc_id", "_run").agg(
        F.first("words").alias("words"), F.count(F.lit(1)).cast("int").alias("times"))
    if copies is not None:
        words = words.join(copies, "doc_id", "left").select(
            "doc_id", "_run", "words", F.expr("cast(times div coalesce(copies, 1) as int)").alias("times"))
    work = (use.join(words, ["doc_id", "_run"]).groupBy("doc_id", "rid")
            .agg(F.sort_array(F.collect_list(F.struct("_run", "times", "words"))).alias("runs"))
            .join(bench.select("rid", "item_id", F.col("words").alias("item")), "rid"))

    def tiles(batches):
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                joined: list[int] = []
                for i, run in enumerate(row["runs"]):
                    for j in range(min(run["times"], len(row["item"]) // k)):  # an item holds no more tiles
                        joined += run["words"]
                        joined.append(-(i * 1_000_003 + j + 1) - (1 << 64))  # equal to no word
                got = tile(row["item"], joined, k)
                n = sum(t[0] for t in got)
                out.append((row["doc_id"], row["item_id"], len(row["item"]), n, n / len(row["item"]), len(got),
                            max((t[0] for t in got), default=0)))
            cols = list(zip(*out)) or [[]] * 7
            names = ["doc_id", "item_id", "item_words", "covered_words", "coverage", "n_tiles", "longest_tile"]
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds)], names=names)

    done = work.mapInArrow(tiles, "doc_id long, item_id long, item_words long, covered_words long, coverage double, "
                                  "n_tiles long, longest_tile long")
    nameless = docs.where(F.col(key).isNull()).select(unnamed.alias("doc_id")).distinct().withColumn("_null", F.lit(True))
    found = done.where(F.col("coverage") >= coverage).join(nameless, "doc_id", "left")
    return found.withColumn("doc_id", F.when(F.col("_null").isNull(), F.col("doc_id"))).drop("_null")


def decontaminate(docs: DataFrame, items: DataFrame, key: str = "doc_id", **options) -> DataFrame:
    """Documents without a leak (null doc_id stays)."""
    found = leaks(docs, items, key=key, **options).select(F.col("doc_id").alias(key)).distinct()
    return docs.join(found, key, "left_anti")


def decontaminate_rows(docs: DataFrame, items: DataFrame, **options) -> DataFrame:
    """Rows without a leak, each judged by its own text, whatever its doc_id. Columns may have any name."""
    own, names = shielded(docs)
    rows = own.withColumn("_row", row_hash(own))
    copies = (rows.groupBy(F.col("_row").alias("doc_id")).agg(F.count(F.lit(1)).alias("copies")).where("copies > 1"))
    text = names[options.pop("text", "text")]
    return decontaminate(rows, items, key="_row", text=text, copies=copies, **options).select(*unshielded(names))
