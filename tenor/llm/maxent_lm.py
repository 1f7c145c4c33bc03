"""Language-model scoring by a hashed maximum-entropy model.

``log P(word | history) = log P(class | history) + log P(group | class, previous word) + log P(word | group, previous word)``

* The class is a softmax over CLASSES classes with hashed features of the previous word, the previous two words and the
  skip (second-last word alone). The SINGLES most frequent training tokens are classes of their own; all other
  words hash into the rest, and there into groups, whose number grows with the root of the input.
* Groups and words are maximum-entropy models over an add-one prior q (a group keeps one place for unknown words), with one hashed
  feature for every (previous word, group) and (previous word, word) that occurs in training:
  ``P(x | h) = q(x) exp(l[h, x]) / (1 + sum over seen x' of q(x') (exp(l[h, x']) - 1))``. These features grow with the distinct pairs of
  the corpus and are never gathered anywhere: a pair lives in the bucket of its history and group, which takes the
  gradient steps and answers the blocks that asked.

Work in Spark:

* Blocks of documents are written once as token ids; every later pass reads those and not the texts.
* Token counts of all training documents come from the block exchange: exact, one packed entry per distinct token and block.
* Class weights (a fixed size): ROUNDS rounds over disjoint parts of the training documents, together all of them. A block
  takes adaptive gradient steps on minibatches from the current weights; a row of the weights moves by the mean of the blocks'
  changes, weighted by their tokens that touched it. Tasks add up their blocks, lanes the tasks, parts the lanes.
* Pairs go through a second exchange; scoring is a cogroup of blocks with their answers, in numpy batches.

A document trains when ``crc32(doc_id as text) mod 7 != 2`` (a null doc_id counts as the empty string). Null and empty texts
are one end token; repeated rows count as often as they occur; other columns, whatever their names, are not read. A text is held
whole by one task at about 20 bytes a token. Pairs are told apart by a hash of history and parent, whose bits grow with the blocks, and a 24-bit hash of the
child: two that collide share a feature. All logs are base 10.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from contextlib import contextmanager
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tenor.llm import blocks, textkit
from tenor.session import scratch_path

U = np.uint64
CLASSES, SINGLES, BITS, ROUNDS = 48, 24, 12, 2
HASHED = CLASSES - SINGLES
FEATURES, ROWS = 3, 1 << BITS
BATCH, RATE = 8192, 0.2
WEIGHT_BLOCK, LANES = 1024, 64
PAIR_STEPS, PAIR_VARIANCE = 14, 8.0
END, START = U(0x0E4D0E4D0E4D0E4D), U(0x57A2757A2757A271)
CHILD_BYTES = 3
GROUP_GROWTH, BLOCKS_A_BUCKET = 8, 8
PACKED = "block int, doc_id array<long>, held_out array<boolean>, sizes binary, keys binary, ids binary, counts binary"
_ZSTD = pa.Codec("zstd", compression_level=1)


def squeeze(values: np.ndarray, width: int | None = None) -> bytes:
    """Non-negative integers or floats as compressed byte planes (the low ``width`` bytes): length, then planes."""
    raw = np.ascontiguousarray(values).view(np.uint8).reshape(len(values), values.dtype.itemsize)
    planes = np.ascontiguousarray(raw[:, :width or raw.shape[1]].T).tobytes()
    return len(values).to_bytes(8, "little") + (_ZSTD.compress(planes, asbytes=True) if planes else b"")


def expand(cell: bytes, dtype, width: int | None = None) -> np.ndarray:
    n, dtype = int.from_bytes(cell[:8], "little"), np.dtype(dtype)
    width = width or dtype.itemsize
    out = np.zeros((n, dtype.itemsize), np.uint8)
    if n:
        out[:, :width] = np.frombuffer(_ZSTD.decompress(cell[8:], n * width, asbytes=True), np.uint8).reshape(width, n).T
    return out.reshape(-1).view(dtype)


def expand_all(column: pa.ChunkedArray, dtype, width: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(all values, values per row) of a squeezed column."""
    rows = [expand(x.as_py(), dtype, width) for x in column]
    return (np.concatenate(rows) if rows else np.empty(0, dtype)), np.array([len(r) for r in rows], np.int64)


def deltas(sorted_keys: np.ndarray) -> np.ndarray:
    return np.diff(sorted_keys, prepend=U(0)) if len(sorted_keys) else sorted_keys


def answers(replies: pa.Table, dtype) -> np.ndarray:
    """A block's answers in the order of its sorted keys."""
    order = np.argsort(replies.column("bucket").to_numpy(), kind="stable")
    return expand_all(replies.column("values").take(pa.array(order)), dtype)[0]


def held_out(key: Column) -> Column:
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % 7 == 2


def tokens(column):
    """Per slice: (first text, texts, token hashes with ends, first token of each text)."""
    raw, offsets = textkit.buffers(column)
    for lo, hi in textkit.slices(offsets):
        h, first, _, _ = textkit.word_hashes(raw[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo])
        n = hi - lo
        edge = first + np.arange(n + 1)
        out = np.empty(len(h) + n, U)
        is_end = np.zeros(len(out), bool)
        is_end[edge[1:] - 1] = True
        out[is_end], out[~is_end] = END, h
        yield lo, n, out, edge


def features(tok: np.ndarray, edge: np.ndarray) -> np.ndarray:
    """(FEATURES, tokens) rows of the weights for every token's history."""
    one, two = np.full(len(tok), START, U), np.full(len(tok), START, U)
    one[1:], two[2:] = tok[:-1], tok[:-2]
    one[edge[:-1]] = two[edge[:-1]] = START
    second = edge[:-1] + 1
    two[second[second < edge[1:]]] = START
    cut = U(64 - BITS)
    mixed = (textkit.mix(one + U(1)), textkit.mix(one * U(0x9E3779B97F4A7C15) + textkit.mix(two)), textkit.mix(two + U(7)))
    return np.stack([(m >> cut).astype(np.int64) + k * ROWS for k, m in enumerate(mixed)])


def classes(tok: np.ndarray, single: np.ndarray) -> np.ndarray:
    """Class of every token; ``single``: sorted hashes of the tokens that are classes alone."""
    out = SINGLES + ((tok >> U(20)) % U(HASHED)).astype(np.int64)
    if len(single):
        at = np.minimum(np.searchsorted(single, tok), len(single) - 1)
        out = np.where(single[at] == tok, at, out)
    return out


def log_softmax(weights: np.ndarray, bias: np.ndarray, f: np.ndarray) -> np.ndarray:
    z = bias + weights[f[0]]
    for row in f[1:]:
        z += weights[row]
    z -= z.max(axis=1, keepdims=True)
    return z - np.log(np.exp(z).sum(axis=1, keepdims=True))


def step(weights, bias, seen, seen_bias, f, y) -> None:
    """One adaptive gradient step on a minibatch, in place."""
    error = bias + weights[f[0]]
    for row in f[1:]:
        error += weights[row]
    error -= error.max(axis=1, keepdims=True)
    np.exp(error, out=error)
    error /= error.sum(axis=1, keepdims=True)
    error[np.arange(len(y)), y] -= 1
    grad = error.sum(axis=0)
    seen_bias += grad * grad
    bias -= RATE * grad / np.sqrt(seen_bias + 1)
    for row in f:
        order = np.argsort(row.astype(np.uint16), kind="stable")  # FEATURES * ROWS fits in 16 bits
        r = row[order]
        begin = np.flatnonzero(np.concatenate(([True], r[1:] != r[:-1])))
        grad, at = np.add.reduceat(error[order], begin, axis=0), r[begin]
        total = seen[at] + grad * grad
        seen[at] = total
        weights[at] -= RATE * grad / np.sqrt(total + 1)


class Block(NamedTuple):
    """One block of documents as token ids: ``keys[ids]`` are the tokens, ``edge`` the first token of each document."""

    doc_id: pa.Array
    held_out: np.ndarray
    edge: np.ndarray
    keys: np.ndarray
    ids: np.ndarray


def block_of(table: pa.Table | pa.RecordBatch, i: int = 0) -> Block:
    cell = {c: table.column(c)[i] for c in ("doc_id", "held_out", "sizes", "keys", "ids", "counts")}
    sizes, keys = expand(cell["sizes"].as_py(), np.int64), np.cumsum(expand(cell["keys"].as_py(), U), dtype=U)
    order = np.argsort(-expand(cell["counts"].as_py(), np.int64), kind="stable")
    return Block(cell["doc_id"].values, cell["held_out"].values.to_numpy(zero_copy_only=False).astype(bool),
                 np.concatenate(([0], np.cumsum(sizes))), keys, order[expand(cell["ids"].as_py(), np.int32)])


def _packed(rows: DataFrame, n_blocks: int) -> DataFrame:
    """Stored by block, so that later passes need no shuffle of it: one row per block, its documents in the order of their ids, with the sorted distinct tokens and their training counts."""
    def pack(table: pa.Table) -> pa.Table:
        table = table.sort_by([("doc_id", "ascending"), ("text", "ascending")])
        held = table.column("held_out").to_numpy(zero_copy_only=False).astype(bool)
        parts, sizes = [], []
        for _, _, tok, edge in tokens(table.column("text")):
            parts.append(tok)
            sizes.append(np.diff(edge))
        sizes = np.concatenate(sizes).astype(np.int64)
        keys, ids = np.unique(np.concatenate(parts), return_inverse=True)
        counts = np.bincount(ids, weights=np.repeat(~held, sizes), minlength=len(keys)).astype(np.int64)
        rank = np.empty(len(keys), np.int32)  # frequent tokens have small ids, which pack well
        rank[np.argsort(-counts, kind="stable")] = np.arange(len(keys))
        cells = {"sizes": sizes, "keys": deltas(keys), "ids": rank[ids], "counts": counts}
        return pa.table({"block": table.column("block")[:1], "doc_id": pa.array([table.column("doc_id").to_pylist()], pa.list_(pa.int64())),
                         "held_out": pa.array([held.tolist()], pa.list_(pa.bool_())),
                         **{c: pa.array([squeeze(v)], pa.binary()) for c, v in cells.items()}})

    spark = rows.sparkSession
    path = scratch_path(spark, "token-blocks")
    name = "token_blocks_" + path.rstrip("/").rsplit("/", 1)[-1].replace("-", "_")
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), n_blocks // BLOCKS_A_BUCKET)
    # rows are megabytes: row groups are closed by bytes, checked at every row
    with shuffles_freed(spark):
        (rows.repartition(buckets, "block").groupBy("block").applyInArrow(pack, PACKED).write.option("compression", "none")
         .option("parquet.block.size", 16 << 20).option("parquet.block.size.row.check.min", 1).option("parquet.block.size.row.check.max", 1)
         .bucketBy(buckets, "block").option("path", path).saveAsTable(name))
    return spark.table(name)


@contextmanager
def shuffles_freed(spark):
    """Shuffle files of what is written inside are removed at its end, and not only when the driver's heap is next cleaned."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, "false")
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def groups_of(tok: np.ndarray, groups: int) -> np.ndarray:
    """Group of every token: its hashed class (of ``classes``), cut into ``groups``."""
    return ((tok >> U(20)) % U(HASHED)).astype(np.int64) * groups + ((textkit.mix(tok) >> U(16)) % U(groups)).astype(np.int64)


def _counts(packed: DataFrame, n_blocks: int, groups: int) -> DataFrame:
    """Stored answers: per block its tokens' training counts; per bucket (block -1) its totals:
    tokens, distinct tokens, the same per group, and its most frequent tokens."""
    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, keys, counts in zip(*(batch.column(c) for c in ("block", "keys", "counts"))):
                keys, counts = np.cumsum(expand(keys.as_py(), U), dtype=U), expand(counts.as_py(), np.int64)
                edges = blocks.bucket_edges64(keys, n_blocks)
                used = np.flatnonzero(np.diff(edges)).tolist()
                yield pa.RecordBatch.from_pydict({
                    "bucket": pa.array(used, pa.int32()), "block": pa.array([block.as_py()] * len(used), pa.int32()),
                    "keys": pa.array([squeeze(deltas(keys[edges[b]:edges[b + 1]])) for b in used], pa.binary()),
                    "counts": pa.array([squeeze(counts[edges[b]:edges[b + 1]]) for b in used], pa.binary())})

    def merge(table: pa.Table) -> pa.Table:
        keys = np.concatenate([np.cumsum(expand(x.as_py(), U), dtype=U) for x in table.column("keys")])
        counts, sizes = expand_all(table.column("counts"), np.int64)
        distinct, inverse = np.unique(keys, return_inverse=True)
        total = np.zeros(len(distinct), np.int64)
        np.add.at(total, inverse, counts)
        ends, mine = np.cumsum(sizes), total[inverse]
        known = total > 0
        group, n = groups_of(distinct[known], groups), HASHED * groups
        stats = np.concatenate(([total.sum(), known.sum()], np.bincount(group, weights=total[known], minlength=n),
                                np.bincount(group, minlength=n))).astype(np.int64)
        top = np.lexsort((distinct, -total))[:SINGLES]
        kinds = {"block": pa.int32(), "bucket": pa.int32(), "values": pa.binary(), "stats": pa.list_(pa.int64()),
                 "top": pa.list_(pa.int64()), "top_n": pa.list_(pa.int64())}
        cols = {"block": table.column("block").to_pylist() + [-1], "bucket": table.column("bucket").to_pylist() + [0],
                "values": [squeeze(mine[e - s:e]) for s, e in zip(sizes, ends)] + [None],
                "stats": [None] * len(sizes) + [stats], "top": [None] * len(sizes) + [distinct[top].view(np.int64)],
                "top_n": [None] * len(sizes) + [total[top]]}
        return pa.table({c: pa.array(v, kinds[c]) for c, v in cols.items()})

    out = (packed.select("block", "keys", "counts").mapInArrow(emit, "bucket int, block int, keys binary, counts binary").groupBy("bucket")
           .applyInArrow(merge, "block int, bucket int, values binary, stats array<long>, top array<long>, top_n array<long>"))
    with shuffles_freed(packed.sparkSession):
        return blocks.stored(out, "counts")


def train(packed: DataFrame, single: np.ndarray, rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray]:
    """(weights, bias) of the classes after all rounds.

    A block is learnt on its own from the shared weights, its documents in the order of their ids, so neither the
    partitions of the input nor their number matter. A row of the weights then moves by the mean of the
    blocks' changes, each weighted by its tokens that touched the row: blocks that never saw a feature have no say in it."""
    spark = packed.sparkSession
    weights, bias = np.zeros((FEATURES * ROWS, CLASSES), np.float32), np.zeros(CLASSES, np.float32)
    sent = "part int, lane int, touched binary, change binary"

    def parts(lane: int, touched: np.ndarray, change: np.ndarray) -> pa.RecordBatch:
        at = range(0, len(change), WEIGHT_BLOCK)
        return pa.RecordBatch.from_pydict({
            "part": pa.array([s // WEIGHT_BLOCK for s in at], pa.int32()), "lane": pa.array([lane] * len(at), pa.int32()),
            "touched": pa.array([touched[s:s + WEIGHT_BLOCK].tobytes() for s in at], pa.binary()),
            "change": pa.array([change[s:s + WEIGHT_BLOCK].astype(np.float32).tobytes() for s in at], pa.binary())})

    def add(table: pa.Table) -> pa.Table:
        total, n = 0.0, 0.0
        for t, c in zip(table.column("touched"), table.column("change")):
            touched = np.frombuffer(t.as_buffer(), np.float64)
            total, n = total + np.frombuffer(c.as_buffer(), np.float32).astype(np.float64).reshape(len(touched), -1), n + touched
        return pa.table({"part": table.column("part")[:1], "lane": table.column("lane")[:1], "touched": pa.array([n.tobytes()], pa.binary()),
                         "change": pa.array([total.astype(np.float32).tobytes()], pa.binary())})

    for turn in range(rounds):
        shared = spark.sparkContext.broadcast((weights, bias, single))

        def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            w0, b0, alone = shared.value  # noqa: B023 (pickled with this round's weights)
            total, n = np.zeros((len(w0) + 1, CLASSES)), np.zeros(len(w0) + 1)
            for batch in batches:
                for i in range(batch.num_rows):
                    block = block_of(batch, i)
                    dealt = textkit.mix(block.doc_id.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64).view(U)) % U(rounds)
                    use, sizes = ~block.held_out & (dealt == U(turn)), np.diff(block.edge)  # noqa: B023
                    if not use.any():
                        continue
                    ids = block.ids[np.repeat(use, sizes)]
                    tok, y = block.keys[ids], classes(block.keys, alone)[ids]
                    f = features(tok, np.concatenate(([0], np.cumsum(sizes[use]))))
                    w, b, seen, seen_b = w0.copy(), b0.copy(), np.zeros_like(w0), np.zeros_like(b0)
                    for s in range(0, len(tok), BATCH):
                        step(w, b, seen, seen_b, f[:, s:s + BATCH], y[s:s + BATCH])
                    touched = np.append(np.bincount(f.ravel(), minlength=len(w)), len(tok)).astype(np.float64)
                    total += np.concatenate((w - w0, (b - b0)[None])) * touched[:, None]
                    n += touched
            if n[-1]:
                yield parts(TaskContext.get().partitionId() % LANES, n, total)

        with shuffles_freed(spark):
            moved = (packed.mapInArrow(learn, sent)
                     .groupBy("part", "lane").applyInArrow(add, sent).groupBy("part").applyInArrow(add, sent).toArrow().sort_by("part"))
        if moved.num_rows:
            n = np.concatenate([np.frombuffer(x.as_buffer(), np.float64) for x in moved.column("touched")])
            change = np.concatenate([np.frombuffer(x.as_buffer(), np.float32) for x in moved.column("change")]).reshape(-1, CLASSES)
            change = (change / np.maximum(n, 1)[:, None]).astype(np.float32)
            weights, bias = weights + change[:-1], bias + change[-1]
        shared.unpersist()
    return weights, bias


def fit_pairs(group: np.ndarray, n: np.ndarray, q: np.ndarray, variance: float = PAIR_VARIANCE, steps: int = PAIR_STEPS) -> tuple[np.ndarray, np.ndarray]:
    """(weight per entry, log normaliser per entry). ``group``: sorted group of each entry, ``n``: its training count, ``q``: its prior.

    Ascent on the groups' log likelihood under a Gaussian prior of the weights, along the gradient scaled by the inverse curvature
    (diagonal less one outer product a group, so it is inverted in closed form); a weight moves by one a step at
    most. Entries that were not seen keep the weight 0."""
    begin = np.flatnonzero(np.concatenate(([True], group[1:] != group[:-1]))) if len(group) else np.empty(0, np.int64)
    if not len(begin):
        return np.empty(0), np.empty(0)
    size, seen = np.diff(np.append(begin, len(group))), n > 0
    total = np.add.reduceat(n, begin)
    spread = np.repeat(total, size)
    lam = np.zeros(len(n))

    def normaliser():
        return np.repeat(1 + np.add.reduceat(q * np.expm1(lam), begin), size)

    for _ in range(steps):
        p = np.where(seen, q * np.exp(lam) / normaliser(), 0)
        flat = spread * p + 1 / variance
        move, pull = (n - spread * p - lam / variance) / flat, p / flat
        shift = total * np.add.reduceat(p * move, begin) / (1 - total * np.add.reduceat(p * pull, begin))
        move += np.repeat(shift, size) * pull
        lam += np.where(seen, np.clip(move, -1, 1), 0)
    return lam, np.log(normaliser())


class Pairs(NamedTuple):
    """What a block asks of the pair features, and where the answers go."""

    parent: np.ndarray    # entries sorted by the hash of history and parent ...
    child: np.ndarray     # ... and the hash of the child
    n: np.ndarray         # training count here
    q: np.ndarray         # prior of the child within its parent
    at: np.ndarray        # tokens (positions) that have a hashed class
    prior: np.ndarray     # their log priors, all levels together
    entry: list           # per level: their entries


def parent_shift(n_blocks: int) -> int:
    """Low bits of a parent's hash that are not used: what is left tells a bucket's parents apart by 39 to 40 bits, so that an entry of a bucket is
    one 64-bit number."""
    return max(0, 64 - 39 - (n_blocks.bit_length() - 1))


def pairs_of(block: Block, count: np.ndarray, single: np.ndarray, group_n: np.ndarray, group_v: np.ndarray, shift: int = 16) -> Pairs:
    """``count``: training counts of ``block.keys``; ``group_n``, ``group_v``: tokens and distinct tokens per group."""
    groups = len(group_n) // HASHED
    cls, group = classes(block.keys, single), groups_of(block.keys, groups)
    room = group_n + group_v + 1
    q_group_of = room / np.repeat(room.reshape(HASHED, groups).sum(axis=1), groups)
    q_word = (count + 1) / room[group]
    width = len(block.keys) + 1
    before = np.empty(len(block.ids), np.int64)
    before[1:] = block.ids[:-1]
    before[block.edge[:-1]] = width - 1
    at = np.flatnonzero(cls[block.ids] >= SINGLES)
    codes, word = np.unique(before[at] * width + block.ids[at], return_inverse=True)
    trains = np.repeat(~block.held_out, np.diff(block.edge))[at]
    n = np.bincount(word, weights=trains, minlength=len(codes))

    def entries(history, parent, child, salt):
        mixed = textkit.mix(textkit.mix(np.append(block.keys, START)[history] + U(salt)) + parent.astype(U))
        return mixed >> U(shift) << U(shift), textkit.mix(child) >> U(64 - 8 * CHILD_BYTES)

    h, w = codes // width, codes % width
    levels = [(*entries(h, group[w], block.keys[w], 1), n, q_word[w], word)]
    prior = np.log(q_word[w])
    if groups > 1:  # with one group a class, the group says nothing
        above, part = np.unique(h * len(group_n) + group[w], return_inverse=True)
        g = above % len(group_n)
        levels.append((*entries(above // len(group_n), g // groups, g.astype(U) + U(3), 2),
                       np.bincount(part, weights=n, minlength=len(above)), q_group_of[g], part[word]))
        prior += np.log(q_group_of[group[w]])
    parent, child, n, q = (np.concatenate([x[i] for x in levels]) for i in range(4))
    order = np.argsort(parent)
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    starts = np.cumsum([0] + [len(x[0]) for x in levels])
    return Pairs(parent[order], child[order], n[order], q[order].astype(np.float32), at, prior[word],
                 [place[x[4] + start] for x, start in zip(levels, starts)])


def score(docs: DataFrame, key: str = "doc_id", text: str = "text", rounds: int = ROUNDS) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) per row."""
    spark = docs.sparkSession
    slim = docs.select(F.col(key).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"),
                       held_out(F.col(key)).alias("held_out"))
    n_blocks = blocks.block_count(slim)
    groups = max(1, math.isqrt(n_blocks) // GROUP_GROWTH)
    packed = _packed(blocks.with_block(slim, n_blocks), n_blocks)
    counts = _counts(packed, n_blocks, groups)
    stats = counts.where("block = -1")
    summed = dict(stats.select(F.posexplode("stats")).groupBy("pos").agg(F.sum("col")).collect())
    n_tokens, n_types = summed.get(0, 0), summed.get(1, 0)
    m = HASHED * groups
    group_n = np.array([summed.get(2 + i, 0) for i in range(m)], np.float64)
    group_v = np.array([summed.get(2 + m + i, 0) for i in range(m)], np.float64)
    top = (stats.select(F.explode(F.arrays_zip("top", "top_n")).alias("t")).select("t.top", "t.top_n")
           .where("top_n > 0").orderBy(F.desc("top_n"), "top").limit(SINGLES).collect())
    single = np.sort(np.array([r.top for r in top], np.int64).view(U))
    for r in top:  # a class of its own leaves its group
        g = int(groups_of(np.array([r.top], np.int64).view(U), groups)[0])
        group_n[g] -= r.top_n
        group_v[g] -= 1
    weights, bias = train(packed, single, rounds)
    shared = spark.sparkContext.broadcast((weights, bias, single, group_n, group_v))
    shift = parent_shift(n_blocks)

    def ask(table: pa.Table, answer: pa.Table) -> pa.Table:
        p = pairs_of(block_of(table), answers(answer, np.int64), *shared.value[2:], shift)
        edges = blocks.bucket_edges64(p.parent, n_blocks)
        used = np.flatnonzero(np.diff(edges)).tolist()
        out = {"bucket": pa.array(used, pa.int32()), "block": pa.array(table.column("block").to_pylist() * len(used), pa.int32())}
        parts = [slice(edges[b], edges[b + 1]) for b in used]
        out["parent"] = pa.array([squeeze(deltas(p.parent[x])) for x in parts], pa.binary())
        out["child"] = pa.array([squeeze(p.child[x], CHILD_BYTES) for x in parts], pa.binary())
        out["n"] = pa.array([squeeze(p.n[x].astype(np.int32)) for x in parts], pa.binary())
        out["q"] = pa.array([squeeze(p.q[x]) for x in parts], pa.binary())
        return pa.table(out)

    def fit(table: pa.Table) -> pa.Table:
        table = table.sort_by("block")
        parent = np.concatenate([np.cumsum(expand(x.as_py(), U), dtype=U) for x in table.column("parent")])
        child, sizes = expand_all(table.column("child"), U, CHILD_BYTES)
        entry, inverse = np.unique((parent - parent.min() >> U(shift) << U(8 * CHILD_BYTES)) | child, return_inverse=True)
        n = np.bincount(inverse, weights=expand_all(table.column("n"), np.int32)[0], minlength=len(entry))
        q = np.zeros(len(entry))
        q[inverse] = expand_all(table.column("q"), np.float32)[0]
        lam, log_z = fit_pairs(entry >> U(8 * CHILD_BYTES), n, q)
        mine, ends = (lam - log_z).astype(np.float32)[inverse], np.cumsum(sizes)
        return pa.table({"block": table.column("block"), "bucket": table.column("bucket"), "kind": pa.array([1] * len(sizes), pa.int32()),
                         "values": pa.array([squeeze(mine[e - s:e]) for s, e in zip(sizes, ends)], pa.binary())})

    def finish(table: pa.Table, answer: pa.Table) -> pa.Table:
        w, b, alone, in_group, kinds = shared.value
        block, kind = block_of(table), answer.column("kind").to_numpy()
        total = answers(answer.filter(pa.array(kind == 0)), np.int64)
        p = pairs_of(block, total, alone, in_group, kinds, shift)
        gain = answers(answer.filter(pa.array(kind == 1)), np.float32)
        word = np.zeros(len(block.ids))
        word[p.at] = p.prior + sum(gain[e].astype(np.float64) for e in p.entry)
        tok, c = block.keys[block.ids], total[block.ids]
        f, y = features(tok, block.edge), classes(block.keys, alone)[block.ids]
        for s in range(0, len(tok), BATCH):
            part = log_softmax(w, b, f[:, s:s + BATCH])
            word[s:s + BATCH] += part[np.arange(part.shape[0]), y[s:s + BATCH]]
        n, first = len(block.doc_id), block.edge[:-1]
        return pa.table({"doc_id": block.doc_id, "held_out": pa.array(block.held_out),
                         "n_tokens": pa.array(np.diff(block.edge)), "n_known": pa.array(np.add.reduceat(c > 0, first, dtype=np.int64)),
                         "train_tokens": pa.array(np.full(n, n_tokens, np.int64)),
                         "base_score": pa.array(np.add.reduceat(np.log10((c + 1) / (n_tokens + 1 * (n_types + 1))), first)),
                         "score": pa.array(np.add.reduceat(word, first) / np.log(10))})

    known = counts.where("block >= 0").select("block", "bucket", F.lit(0).alias("kind"), "values")
    asked = packed.groupBy("block").cogroup(known.groupBy("block")).applyInArrow(
        ask, "bucket int, block int, parent binary, child binary, n binary, q binary")
    with shuffles_freed(spark):
        gains = blocks.stored(asked.groupBy("bucket").applyInArrow(fit, "block int, bucket int, kind int, values binary"), "gains")
    return packed.groupBy("block").cogroup(known.unionByName(gains).groupBy("block")).applyInArrow(
        finish, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")
