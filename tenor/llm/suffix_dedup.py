"""Exact substring dedup: remove every byte covered by a string of LENGTH bytes
that also starts earlier (smaller doc_id, or same document and earlier start).

How a corpus-wide suffix comparison is cut into bounded parts:

* Every LENGTH-byte window has an *anchor*: its smallest GRAM-byte substring by
  hash (leftmost on ties). Equal windows have equal anchors at equal offsets.
  Neighbouring windows with one anchor form a *stretch* (at most 2 LENGTH - GRAM bytes).
* Blocks send the distinct (anchor, stretch) hashes once each, bucketed by the stretch;
  the earliest document that holds a stretch owns it. Equal stretches are thus collapsed
  before any text moves: all windows of a stretch that is not the owner's start earlier there.
* A second exchange, by anchor, adds up the distinct stretches that the buckets counted
  for it, so an anchor meets one number a bucket, however many stretches it has.
* Owners' stretches whose anchor also occurs in a different stretch meet in a
  part (by anchor hash). There the suffix array over these texts, built by
  two-stage sorting, and its adjacent common prefixes give the equal windows;
  all but the earliest are removed.
* An anchor in more than HOT_STRETCHES different stretches is split: its windows
  travel one by one, keyed by their own hash, collapsed per block first.

Only strings judged on the input count. Null texts are empty; texts below
LENGTH bytes keep everything. A null doc_id orders last; rows with equal doc_id
are ordered by block and text. Windows never cross documents.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tenor.llm import blocks, textkit
from tenor.llm.suffix_array import common_prefixes, suffix_array, words8

LENGTH = 100
GRAM = 32
HOT_STRETCHES = 50_000
LAST = np.iinfo(np.int64).max
U = np.uint64
_BASES = (0x9E3779B97F4A7C15 | 1, 0xD1342543DE82EF95 | 1)


class Prefixes:
    """Hashes of any substring of one slice (polynomial prefix sums modulo 2**64)."""

    def __init__(self, raw: np.ndarray, base: int):
        n = len(raw)
        inverse = pow(base, -1, 1 << 64)
        steps = np.full(n + 1, U(base))
        steps[0] = 1
        self.sums = np.zeros(n + 1, U)
        np.cumsum((raw.astype(U) + U(1)) * np.multiply.accumulate(steps)[:n], out=self.sums[1:])
        steps[1:] = U(inverse)
        self.back = np.multiply.accumulate(steps)

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return textkit.mix((self.sums[end] - self.sums[start]) * self.back[start])


class Slice:
    """Stretches of consecutive documents: arrays anchor, stretch, lo, hi (window starts), doc."""

    def __init__(self, raw: np.ndarray, offsets: np.ndarray, length: int, gram: int, anchors_only: bool = False):
        self.raw, self.offsets, self.length = raw, offsets, length
        n = len(raw)
        self.lo = self.hi = self.doc = np.empty(0, np.int64)
        self.anchor = self.stretch = np.empty(0, U)
        if n < length:
            return
        prefix = Prefixes(raw, _BASES[0])
        at = np.arange(n - gram + 1)
        grams = prefix.of(at, at + gram)
        least = (grams & U(0xFFFFFFFF00000000)) | at.astype(U)
        width, size = length - gram + 1, 1
        while size * 2 <= width:
            least = np.minimum(least[:-size], least[size:])
            size *= 2
        windows = n - length + 1
        least = np.minimum(least[:windows], least[width - size:width - size + windows])
        place = (least & U(0xFFFFFFFF)).astype(np.int64)
        ends = np.repeat(offsets[1:], np.diff(offsets))
        start = np.flatnonzero(np.arange(windows) + length <= ends[:windows])
        if not len(start):
            return
        place = place[start]
        new = np.ones(len(start), bool)
        new[1:] = (place[1:] != place[:-1]) | (start[1:] != start[:-1] + 1)
        first = np.flatnonzero(new)
        self.lo, self.hi = start[first], start[np.append(first[1:], len(start)) - 1]
        place = place[first]
        self.anchor = grams[place]
        if anchors_only:
            return
        self.second = Prefixes(raw, _BASES[1])
        shape = ((self.hi - self.lo) << 16 | (place - self.lo)).astype(U)
        self.stretch = textkit.mix(self.second.of(self.lo, self.hi + length) + shape * U(_BASES[0]))
        self.doc = np.searchsorted(offsets, self.lo, side="right") - 1


class Block:
    """The stretches of a block's documents, in (doc_id, text) order of its rows."""

    def __init__(self, table: pa.Table, length: int, gram: int):
        table = table.sort_by([("doc_id", "ascending"), ("text", "ascending")])
        self.number = table.column("block")[0].as_py()
        ids = table.column("doc_id").fill_null(LAST).to_numpy()
        self.null_id = table.column("doc_id").is_null().to_numpy(zero_copy_only=False)
        self.ids = ids
        raw, offsets = textkit.buffers(table.column("text"))
        self.slices = []
        for lo, hi in textkit.slices(offsets):
            part = Slice(raw[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo], length, gram)
            part.first = lo
            self.slices.append(part)
        # all stretches: row (document) and slice
        join = lambda f, kind: np.concatenate([f(p) for p in self.slices]) if self.slices else np.empty(0, kind)
        self.anchor, self.stretch = join(lambda p: p.anchor, U), join(lambda p: p.stretch, U)
        self.row = join(lambda p: p.doc + p.first, np.int64)
        self.lo, self.hi = join(lambda p: p.lo, np.int64), join(lambda p: p.hi, np.int64)
        self.slice = join(lambda p: np.full(len(p.lo), self.slices.index(p)), np.int64)
        # order of distinct keys; the first of each is the block's earliest (rows are in doc_id order)
        self.order = np.lexsort((self.lo, self.slice, self.row, self.stretch, self.anchor))
        a, s = self.anchor[self.order], self.stretch[self.order]
        new = np.ones(len(a), bool)
        new[1:] = (a[1:] != a[:-1]) | (s[1:] != s[:-1])
        self.keyed = self.order[new]              # earliest stretch per distinct key, in key order
        self.key_of = np.empty(len(a), np.int64)  # distinct key of every stretch
        self.key_of[self.order] = np.cumsum(new) - 1
        a, s = a[new], s[new]
        self.by_stretch = np.lexsort((a, s))      # distinct keys in the order of the first exchange
        self.anchor_of = np.unique(textkit.mix(a), return_inverse=True)[1]  # place in block_anchors

    def text(self, i: int, lo: int, hi: int) -> bytes:
        part = self.slices[self.slice[i]]
        return part.raw[lo:hi + part.length].tobytes()


def block_anchors(table: pa.Table, length: int, gram: int) -> np.ndarray:
    """The distinct anchors of a block. An anchor is a least hash, so small ones abound; they
    are mixed again for even buckets."""
    raw, offsets = textkit.buffers(table.column("text"))
    parts = [Slice(raw[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo], length, gram, True).anchor
             for lo, hi in textkit.slices(offsets)]
    return np.unique(textkit.mix(np.concatenate([np.empty(0, U), *parts])))


OWNER, CONTESTED, HOT = 1, 2, 4
_PIECES = {"part": pa.int32(), "block": pa.int32(), "doc_id": pa.int64(), "row": pa.int32(), "slice": pa.int32(),
           "lo": pa.int64(), "text": pa.binary()}


def _hot_windows(block: Block, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Windows of the stretches ``chosen``: (stretch, start, hash, is the block's earliest)."""
    many = block.hi[chosen] - block.lo[chosen] + 1
    owner = np.repeat(chosen, many)
    start = block.lo[owner] + np.arange(len(owner)) - np.repeat(np.cumsum(many) - many, many)
    h = np.empty(len(owner), U)
    for k, part in enumerate(block.slices):
        at = block.slice[owner] == k
        if at.any():
            h[at] = part.second.of(start[at], start[at] + part.length)
    order = np.lexsort((start, block.slice[owner], block.row[owner], h))
    first = np.zeros(len(owner), bool)
    if len(order):
        new = np.ones(len(order), bool)
        new[1:] = h[order][1:] != h[order][:-1]
        first[order[new]] = True
    return owner, start, h, first


def repeated_spans(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, hot: int = HOT_STRETCHES,
                   key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_bytes, starts, ends, kept): the removed spans as byte ranges and the
    remaining bytes, one row per input row."""
    n_blocks = blocks.block_count(docs, text)
    rows = blocks.with_block(docs.select(F.col(key).cast("long").alias("doc_id"),
                                         F.coalesce(F.col(text), F.lit("")).alias("text")), n_blocks)
    n_parts = 4 * n_blocks

    def emit(table: pa.Table) -> pa.Table:
        b = Block(table, length, gram)
        keyed = b.keyed[b.by_stretch]
        keys = b.stretch[keyed]
        return blocks.pack(b.number, blocks.bucket_edges64(keys, n_blocks),
                           {"anchors": b.anchor[keyed], "stretches": keys, "ids": b.ids[b.row[keyed]]})

    def merge(table: pa.Table) -> pa.Table:
        a, sizes = blocks.unpack(table.column("anchors"), U)
        s, _ = blocks.unpack(table.column("stretches"), U)
        ids, _ = blocks.unpack(table.column("ids"), np.int64)
        block = np.repeat(table.column("block").to_numpy(), sizes)
        order = np.lexsort((block, ids, a, s))
        a, s = a[order], s[order]
        new = np.ones(len(a), bool)
        new[1:] = (a[1:] != a[:-1]) | (s[1:] != s[:-1])
        flag = np.empty(len(a), np.uint8)
        flag[order] = new * OWNER
        ends = np.cumsum(sizes)
        found, kinds = np.unique(textkit.mix(a[new]), return_counts=True)
        counts = blocks.pack(-1, blocks.bucket_edges64(found, n_blocks), {"anchors": found, "kinds": kinds.astype(np.int64)})
        flags = pa.table({"block": table.column("block"), "bucket": table.column("bucket"),
                          "flags": pa.array([flag[e - n:e].tobytes() for n, e in zip(sizes, ends)], pa.binary())})
        return pa.concat_tables([flags, counts], promote_options="default").select(
            ["block", "bucket", "flags", "anchors", "kinds"])

    owned = blocks.stored(blocks.exchange(
        rows, emit, "bucket int, block int, anchors binary, stretches binary, ids binary",
        merge, "block int, bucket int, flags binary, anchors binary, kinds binary"), "owners")

    def emit_anchors(table: pa.Table) -> pa.Table:
        keys = block_anchors(table, length, gram)
        return blocks.pack(table.column("block")[0].as_py(), blocks.bucket_edges64(keys, n_blocks), {"anchors": keys})

    def merge_anchors(table: pa.Table) -> pa.Table:
        """Per block: is an anchor in several stretches, in very many?"""
        counted = pc.equal(table.column("block"), -1)
        counts, asked = table.filter(counted), table.filter(pc.invert(counted))
        anchors, inverse = np.unique(blocks.unpack(counts.column("anchors"), U)[0], return_inverse=True)
        kinds = np.zeros(len(anchors), np.int64)
        np.add.at(kinds, inverse, blocks.unpack(counts.column("kinds"), np.int64)[0])
        a, sizes = blocks.unpack(asked.column("anchors"), U)
        kinds = kinds[np.searchsorted(anchors, a)]
        flag = ((kinds > 1) * CONTESTED + (kinds > hot) * HOT).astype(np.uint8)
        ends = np.cumsum(sizes)
        return pa.table({"block": asked.column("block"), "bucket": asked.column("bucket"),
                         "kind_flags": pa.array([flag[e - n:e].tobytes() for n, e in zip(sizes, ends)], pa.binary())})

    asked = rows.groupBy("block").applyInArrow(emit_anchors, "bucket int, block int, anchors binary")
    anchored = blocks.stored(asked.withColumn("kinds", F.lit(None).cast("binary"))
                             .unionByName(owned.where("block = -1").select("bucket", "block", "anchors", "kinds"))
                             .groupBy("bucket").applyInArrow(merge_anchors, "block int, bucket int, kind_flags binary"),
                             "anchors")
    replies = (owned.where("block >= 0").select("block", "bucket", "flags", F.lit(None).cast("binary").alias("kind_flags"))
               .unionByName(anchored.select("block", "bucket", F.lit(None).cast("binary").alias("flags"), "kind_flags")))

    def owners(b: Block, answer: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(flag per distinct key, contested owners' stretches, hot owners' stretches)."""
        flag = np.empty(len(b.keyed), np.uint8)
        flag[b.by_stretch] = blocks.answers(answer.filter(answer.column("flags").is_valid()), "flags", np.uint8)
        kinds = answer.filter(answer.column("kind_flags").is_valid())
        flag |= blocks.answers(kinds, "kind_flags", np.uint8)[b.anchor_of]
        mine = (flag & (OWNER | CONTESTED)) == (OWNER | CONTESTED)
        is_hot = (flag & HOT) > 0
        return flag, b.keyed[mine & ~is_hot], b.keyed[mine & is_hot]

    def pieces(table: pa.Table, answer: pa.Table) -> pa.Table:
        b = Block(table, length, gram)
        _, plain, heated = owners(b, answer)
        w_owner, w_start, w_hash, w_first = _hot_windows(b, heated)
        stretch = np.concatenate((plain, w_owner[w_first]))
        lo = np.concatenate((b.lo[plain], w_start[w_first]))
        hi = np.concatenate((b.hi[plain], w_start[w_first]))
        part = np.concatenate((b.anchor[plain], w_hash[w_first])) % U(n_parts)
        data = {"part": part.astype(np.int32), "block": np.full(len(lo), b.number, np.int32),
                "doc_id": b.ids[b.row[stretch]], "row": b.row[stretch].astype(np.int32),
                "slice": b.slice[stretch].astype(np.int32), "lo": lo,
                "text": [b.text(i, x, y) for i, x, y in zip(stretch, lo, hi)]}
        return pa.table({c: pa.array(data[c], t) for c, t in _PIECES.items()})

    schema = "part int, block int, doc_id long, row int, slice int, lo long, text binary"
    texts = rows.groupBy("block").cogroup(replies.groupBy("block")).applyInArrow(pieces, schema)

    def compare(table: pa.Table) -> pa.Table:
        """Windows of a part's texts that start earlier elsewhere in it: (block, slice, lo)."""
        parts = [np.frombuffer(x.as_py(), np.uint8) for x in table.column("text")]
        sizes = np.array([len(p) for p in parts])
        start = np.cumsum(sizes + 1) - (sizes + 1)
        whole = np.zeros(int(sizes.sum() + len(sizes)), np.uint8)  # zero ends every text
        for s, p in zip(start, parts):
            whole[s:s + len(p)] = p + np.uint8(1)
        keys = words8(whole, length + 8)
        owner = np.repeat(np.arange(len(parts)), sizes + 1)
        offset = np.arange(len(whole)) - start[owner]
        order = suffix_array(whole, keys, length)
        order = order[offset[order] + length <= sizes[owner[order]]]
        same = common_prefixes(keys, order, length)
        group = np.cumsum(~same)
        col = {c: table.column(c).to_numpy() for c in ("block", "doc_id", "row", "slice", "lo")}
        own = owner[order]
        at = col["lo"][own] + offset[order]
        rank = np.lexsort((at, col["slice"][own], col["row"][own], col["block"][own], col["doc_id"][own], group))
        later = np.zeros(len(order), bool)
        later[rank[1:]] = group[rank][1:] == group[rank][:-1]
        return pa.table({"block": pa.array(col["block"][own][later], pa.int32()),
                         "slice": pa.array(col["slice"][own][later], pa.int32()),
                         "lo": pa.array(at[later], pa.int64())})

    later = texts.groupBy("part").applyInArrow(compare, "block int, slice int, lo long")
    both = replies.select("block", "bucket", "flags", "kind_flags", F.lit(None).cast("int").alias("slice"),
                          F.lit(None).cast("long").alias("lo")).unionByName(
        later.select("block", F.lit(None).cast("int").alias("bucket"), F.lit(None).cast("binary").alias("flags"),
                     F.lit(None).cast("binary").alias("kind_flags"), "slice", "lo"))

    def finish(table: pa.Table, answer: pa.Table) -> pa.Table:
        b = Block(table, length, gram)
        is_flag = answer.column("bucket").is_valid()
        flag, _, heated = owners(b, answer.filter(is_flag))
        found = answer.filter(pc.invert(is_flag))
        f_slice, f_lo = found.column("slice").to_numpy(), found.column("lo").to_numpy()
        not_owner = np.ones(len(b.lo), bool)
        not_owner[b.keyed[(flag & OWNER) > 0]] = False
        w_owner, w_start, _, w_first = _hot_windows(b, heated)
        out = {c: [] for c in ("n_bytes", "starts", "ends", "kept")}
        for k, part in enumerate(b.slices):
            delta = np.zeros(len(part.raw) + 1, np.int64)
            gone = not_owner & (b.slice == k)
            np.add.at(delta, b.lo[gone], 1)
            np.add.at(delta, b.hi[gone] + length, -1)
            again = w_start[~w_first & (b.slice[w_owner] == k)]
            for at in (f_lo[f_slice == k], again):
                np.add.at(delta, at, 1)
                np.add.at(delta, at + length, -1)
            covered = np.cumsum(delta)[:-1] > 0
            for i in range(len(part.offsets) - 1):
                s, e = part.offsets[i], part.offsets[i + 1]
                c = np.diff(np.concatenate(([0], covered[s:e].astype(np.int8), [0])))
                out["n_bytes"].append(int(e - s))
                out["starts"].append(np.flatnonzero(c == 1))
                out["ends"].append(np.flatnonzero(c == -1))
                out["kept"].append(part.raw[s:e][~covered[s:e]].tobytes())
        ids = pa.array(b.ids, pa.int64(), mask=b.null_id)
        types = {"n_bytes": pa.int64(), "starts": pa.list_(pa.int64()), "ends": pa.list_(pa.int64()), "kept": pa.binary()}
        return pa.table({"doc_id": ids} | {c: pa.array(out[c], t) for c, t in types.items()})

    return rows.groupBy("block").cogroup(both.groupBy("block")).applyInArrow(
        finish, "doc_id long, n_bytes long, starts array<long>, ends array<long>, kept binary")


def digest(docs: DataFrame, **options) -> DataFrame:
    """Per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256."""
    spans = repeated_spans(docs, **options)
    return spans.select("doc_id", "n_bytes", (F.col("n_bytes") - F.octet_length("kept")).alias("n_removed"),
                        F.size("starts").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))
