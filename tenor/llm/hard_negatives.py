"""Hard-negative mining by a vertical (dimension by dimension) scan of blocks of vectors.

For every anchor: its POSITIVES best other rows of the same label, by inner product; then for every such pair the
NEGATIVES best rows of other labels whose score lies in a window given by the positive's score.

* Vectors are quantised (floor of SCALE times a component) and packed into blocks of about BLOCK rows,
  columnar: one array per dimension, with the least and the greatest value of each. The packed table is stored
  once in the shared folder; both scans and the anchors read it.
* A scan takes an anchor's dimensions in descending magnitude. After each step a row's score lies
  between its partial sum plus the least, and plus the greatest, that the remaining dimensions can add in this
  block. The candidate set starts as the rows with the right label and shrinks: for
  positives a row stays while its upper bound reaches the k-th best lower bound, for negatives while
  it can lie in a window and reach the k-th best lower bound of the rows surely inside. What is
  left after the last dimension has its exact score.
* The anchors are a stated share of all rows, so every block meets every anchor *group* (GROUP blocks' anchors) in
  a cogroup of packed rows; each answer is at most k rows per anchor, and the best of all
  blocks are kept by a ranked window that cuts before its shuffle.

Rows with a null id, label or vector, or with a null or non-finite component take no part. Missing
trailing components count as 0. Repeated rows are rows of their own (an anchor's own row is left out once); ties go to
the smaller id. Scores are exact integers; one beyond 64 bits raises an OverflowError. Other columns are ignored; an
empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tenor.llm.blocks import stored

SCALE, POSITIVES, NEGATIVES = 256.0, 5, 10
WINDOW = (30, 90)  # per cent of the positive's score
EVERY = 100        # rows whose id it divides are anchors
BLOCK, GROUP = 4096, 32
STEP = 8           # dimensions of the first step; later steps read as many as were read before
_PACKED = "block int, ids binary, labels binary, dims int, kind string, cells binary"


# ------------------------------------------------------------------ packed blocks


def _matrix(vectors: pa.Array, n: int) -> tuple[np.ndarray, np.ndarray]:
    """((dims, rows) quantised components, rows that take part)."""
    vectors = vectors.cast(pa.list_(pa.float64()))
    good = vectors.is_valid().to_numpy(zero_copy_only=False)
    flat = vectors.flatten()
    size = vectors.value_lengths().fill_null(0).to_numpy()
    owner = np.repeat(np.arange(n), size)
    values = flat.fill_null(np.nan).to_numpy(zero_copy_only=False)
    bad = ~np.isfinite(values)
    good[owner[bad]] = False
    place = np.arange(len(values)) - np.repeat(np.cumsum(size) - size, size)
    out = np.zeros((int(size[good].max()) if good.any() else 0, n))
    fine = good[owner]
    out[place[fine], owner[fine]] = np.floor(SCALE * values[fine])
    return out, good


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows = [b for b in batches if b.num_rows]
    if not rows:
        return
    table = pa.Table.from_batches(rows).combine_chunks()
    cells, good = _matrix(table.column("vector").chunk(0), table.num_rows)
    if not good.any():
        return
    cells = cells[:, good]
    kind = next((k for k in ("int16", "int32") if np.abs(cells).max(initial=0) < np.iinfo(k).max), "float64")
    yield pa.RecordBatch.from_pydict({
        "block": pa.array([TaskContext.get().partitionId()], pa.int32()), "dims": pa.array([len(cells)], pa.int32()), "kind": [kind],
        "ids": [table.column("id").to_numpy()[good].astype(np.int64).tobytes()],
        "labels": [table.column("label").to_numpy()[good].astype(np.int64).tobytes()],
        "cells": [np.ascontiguousarray(cells.astype(kind)).tobytes()]}, schema=pa.schema([
            ("block", pa.int32()), ("ids", pa.binary()), ("labels", pa.binary()), ("dims", pa.int32()), ("kind", pa.string()),
            ("cells", pa.binary())]))


def packed(rows: DataFrame, block: int = BLOCK) -> tuple[DataFrame, int]:
    """(stored blocks, their number). ``rows``: (id, vector, label) without null ids, labels and vectors."""
    n = max(1, -(-rows.count() // block))
    return stored(rows.repartition(n).mapInArrow(_pack, _PACKED), "vertical"), n


class Block:
    """A packed block: ids, labels, the (dims, rows) components and their range per dimension."""

    def __init__(self, row: dict):
        self.ids = np.frombuffer(row["ids"], np.int64)
        self.labels = np.frombuffer(row["labels"], np.int64)
        self.cells = np.frombuffer(row["cells"], row["kind"]).reshape(row["dims"], len(self.ids)).astype(np.float64)
        self.low, self.high = (f(axis=1) for f in (self.cells.min, self.cells.max))
        self.whole: np.ndarray | None = None

    def exact(self) -> np.ndarray:
        """Components as Python integers, for scores that doubles cannot hold."""
        if self.whole is None:
            self.whole = np.array([[int(v) for v in r] for r in self.cells], dtype=object).reshape(self.cells.shape)
        return self.whole


# ------------------------------------------------------------------ the scan


def _kth(values: np.ndarray, k: int):
    """The k-th greatest value."""
    return np.sort(values)[-k] if values.dtype == object else np.partition(values, len(values) - k)[-k]


def scan(block: Block, anchor: np.ndarray, alive: np.ndarray, shrink) -> tuple[np.ndarray, np.ndarray]:
    """(rows left, their exact scores). ``alive``: rows to begin with; ``shrink(partial, least, most)`` says
    which rows stay when the remaining dimensions add at least ``least`` and at most ``most``."""
    d = min(len(anchor), len(block.cells))
    anchor, cells = anchor[:d], block.cells
    ends = np.stack([anchor * block.low[:d], anchor * block.high[:d]])
    if d and np.abs(ends).max(axis=0).sum() >= 2 ** 53:
        cells, anchor = block.exact(), np.array([int(v) for v in anchor], dtype=object)
        ends = np.stack([anchor * [int(v) for v in x[:d]] for x in (block.low, block.high)])
    order = np.argsort(-np.abs(anchor).astype(np.float64), kind="stable")
    partial = np.zeros(len(alive), cells.dtype)
    least, most = ends.min(axis=0)[order], ends.max(axis=0)[order]
    at = 0
    while at < d and len(alive):
        step = order[at:at + max(STEP, at)]
        partial = partial + anchor[step] @ cells[step][:, alive]
        at += len(step)
        stay = shrink(partial, least[at:].sum(), most[at:].sum())
        if not stay.all():
            alive, partial = alive[stay], partial[stay]
    return alive, partial


def best(k: int):
    """``shrink`` for the k greatest scores."""
    def shrink(partial, least, most):
        if len(partial) <= k:
            return np.ones(len(partial), bool)
        return (partial + most >= _kth(partial, k) + least).astype(bool)
    return shrink


def in_windows(windows: list[tuple[int, int]], k: int):
    """``shrink`` for the k greatest scores of every window (both ends inside)."""
    def shrink(partial, least, most):
        low, high = partial + least, partial + most
        stay = np.zeros(len(partial), bool)
        for lo, hi in windows:
            inside = ((high >= lo) & (low <= hi)).astype(bool)
            sure = ((low >= lo) & (high <= hi)).astype(bool)
            if np.count_nonzero(sure) >= k:
                inside &= (high >= _kth(low[sure], k)).astype(bool)
            stay |= inside
        return stay
    return shrink


def _top(ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    return np.lexsort((ids, -scores))[:k] if scores.dtype != object else np.array(
        sorted(range(len(ids)), key=lambda i: (-scores[i], ids[i]))[:k], dtype=np.int64)


# ------------------------------------------------------------------ jobs


def _pairs(blocks: DataFrame, anchors: DataFrame, n: int, work, out: str) -> DataFrame:
    """``work(block, anchors rows)`` for every block and every group of anchor rows."""
    groups = -(-n // GROUP)
    left = blocks.withColumn("g", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
    right = (anchors.withColumn("g", F.expr(f"block div {GROUP}").cast("int"))
             .withColumn("b", F.explode(F.sequence(F.lit(0), F.lit(n - 1)))))

    def run(data: pa.Table, asked: pa.Table) -> pa.Table:
        if data.num_rows == 0 or asked.num_rows == 0:
            return pa.table({c: pa.array([], pa.int64()) for c in names})
        return pa.table(dict(zip(names, (pa.array(v, pa.int64()) for v in work(Block(data.to_pylist()[0]), asked.to_pylist())))))

    names = [c.split()[0] for c in out.split(", ")]
    return left.groupBy(F.col("block"), F.col("g")).cogroup(right.groupBy(F.col("b"), F.col("g"))).applyInArrow(run, out)


def _anchors(blocks: DataFrame, every: int) -> DataFrame:
    """Per block its anchors: the packed form with the anchors' rows only, and their places in the block."""
    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ids, labels = (np.frombuffer(row[c], np.int64) for c in ("ids", "labels"))
                cells = np.frombuffer(row["cells"], row["kind"]).reshape(row["dims"], len(ids))
                at = np.flatnonzero(ids % every == 0)
                if len(at):
                    yield pa.RecordBatch.from_pylist([row | {
                        "ids": ids[at].tobytes(), "labels": labels[at].tobytes(), "places": at.astype(np.int64).tobytes(),
                        "cells": np.ascontiguousarray(cells[:, at]).tobytes()}], schema=schema)

    schema = pa.schema([("block", pa.int32()), ("ids", pa.binary()), ("labels", pa.binary()), ("dims", pa.int32()),
                        ("kind", pa.string()), ("cells", pa.binary()), ("places", pa.binary())])
    return blocks.mapInArrow(pick, _PACKED + ", places binary")


def _each(row: dict):
    """(place, id, label, vector) of the anchors in a packed row."""
    ids, labels, places = (np.frombuffer(row[c], np.int64) for c in ("ids", "labels", "places"))
    cells = np.frombuffer(row["cells"], row["kind"]).reshape(row["dims"], len(ids)).astype(np.float64)
    for j in range(len(ids)):
        yield int(places[j]), int(ids[j]), int(labels[j]), cells[:, j]


def _ranked(rows: DataFrame, by: tuple[str, ...], k: int) -> DataFrame:
    order = Window.partitionBy(*by).orderBy(F.desc("score"), "id")
    return rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def positives(blocks: DataFrame, anchors: DataFrame, n: int, k: int = POSITIVES) -> DataFrame:
    """(block, place, anchor_id, rank, positive_id, positive_score): the first k other rows of each anchor's label."""
    def work(block: Block, asked: list[dict]):
        out = [[] for _ in range(6)]
        by_label = {label: np.flatnonzero(block.labels == label) for label in np.unique(block.labels)}
        for row in asked:
            for place, anchor, label, vector in _each(row):
                alive = by_label.get(label)
                if alive is None:
                    continue
                at, score = scan(block, vector, alive, best(k + 1))  # the anchor's own row may be among them
                top = _top(block.ids[at], score, k + 1)
                self_score = sum(int(v) * int(v) for v in vector)
                for column, values in zip(out, ([row["block"]] * len(top), [place] * len(top), [anchor] * len(top),
                                                [self_score] * len(top), block.ids[at][top].tolist(), [int(s) for s in score[top]])):
                    column += values
        return out

    found = _pairs(blocks, anchors, n, work, "block long, place long, anchor_id long, self_score long, id long, score long")
    top = _ranked(found, ("block", "place"), k + 1)
    own = (F.col("id") == F.col("anchor_id")) & (F.col("score") == F.col("self_score"))
    first_own = F.min(F.when(own, F.col("rank"))).over(Window.partitionBy("block", "place"))
    kept = top.withColumn("own", first_own).where(F.col("own").isNull() | (F.col("rank") != F.col("own")))
    rank = F.when(F.col("rank") > F.col("own"), F.col("rank") - 1).otherwise(F.col("rank"))
    return kept.select("block", "place", "anchor_id", rank.alias("rank"), F.col("id").alias("positive_id"),
                       F.col("score").alias("positive_score")).where(F.col("rank") <= k)


def negatives(blocks: DataFrame, anchors: DataFrame, found: DataFrame, n: int, k: int = NEGATIVES,
              window: tuple[int, int] = WINDOW) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score)."""
    low, high = window

    def work(block: Block, asked: list[dict]):
        out = [[] for _ in range(8)]
        for row in asked:
            pairs: dict[int, list] = {}
            for p in row["pairs"]:
                pairs.setdefault(p["place"], []).append((p["rank"], p["positive_id"], p["positive_score"]))
            for place, anchor, label, vector in _each(row):
                mine = [(r, i, s, -(-low * s // 100), high * s // 100) for r, i, s in pairs.get(place, ())]
                mine = [m for m in mine if m[3] <= m[4]]
                if not mine:
                    continue
                at, score = scan(block, vector, np.flatnonzero(block.labels != label), in_windows([m[3:] for m in mine], k))
                for r, i, s, lo, hi in mine:
                    inside = np.flatnonzero((score >= lo) & (score <= hi))
                    top = inside[_top(block.ids[at][inside], score[inside], k)]
                    for column, values in zip(out, ([row["block"]] * len(top), [place] * len(top), [anchor] * len(top), [r] * len(top),
                                                    [i] * len(top), [s] * len(top), block.ids[at][top].tolist(),
                                                    [int(v) for v in score[top]])):
                        column += values
        return out

    pairs = found.groupBy("block").agg(F.collect_list(F.struct("place", "rank", "positive_id", "positive_score")).alias("pairs"))
    asked = anchors.join(pairs.withColumn("block", F.col("block").cast("int")), "block")  # at most a block's anchors times k
    got = _pairs(blocks, asked, n, work, "block long, place long, anchor_id long, pair long, positive_id long, positive_score long, "
                                         "id long, score long")
    return _ranked(got, ("block", "place", "pair"), k).select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias("negative_id"), "positive_score",
        F.col("score").alias("negative_score"))


def mine(rows: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label", every: int = EVERY, n_positives: int = POSITIVES,
         n_negatives: int = NEGATIVES, window: tuple[int, int] = WINDOW, block: int = BLOCK) -> DataFrame:
    """Hard negatives of every anchor (rows whose id ``every`` divides)."""
    slim = rows.select(F.col(key).cast("long").alias("id"), F.col(vector).alias("vector"), F.col(label).cast("long").alias("label"))
    blocks, n = packed(slim.where("id IS NOT NULL AND label IS NOT NULL AND vector IS NOT NULL"), block)
    anchors = stored(_anchors(blocks, every), "anchors")
    found = stored(positives(blocks, anchors, n, n_positives), "positives")
    return negatives(blocks, anchors, found, n, n_negatives, window)


def digest(embeddings: DataFrame) -> DataFrame:
    """The rule of the query: where 7 divides vec_id, the label is the next one of ten."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine(embeddings.select("vec_id", "embedding", label.alias("label")))


ORACLE = f"""
WITH e AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v, row_number() OVER () AS r
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS anchor_id, a.r AS a, o.r AS o, o.vec_id AS id, a.label = o.label AS same,
             list_dot_product(a.v, o.v)::BIGINT AS score
      FROM e a JOIN e o ON a.r <> o.r WHERE a.vec_id % {EVERY} = 0),
p AS (SELECT anchor_id, a, o AS p, id AS positive_id, score AS positive_score FROM s WHERE same
      QUALIFY row_number() OVER (PARTITION BY a ORDER BY score DESC, id) <= {POSITIVES})
SELECT p.anchor_id, positive_id, (row_number() OVER w)::INTEGER AS rank, id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s ON s.a = p.a AND NOT same AND {WINDOW[0]} * positive_score <= 100 * score AND 100 * score <= {WINDOW[1]} * positive_score
WINDOW w AS (PARTITION BY p.a, p.p ORDER BY score DESC, id) QUALIFY row_number() OVER w <= {NEGATIVES}
"""
