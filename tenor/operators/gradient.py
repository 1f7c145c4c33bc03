"""Block-wise linear classifiers trained in rounds on a loss of the caller's choice.

A model is ``blocks`` independent linear classifiers of one shape (a group's student, a setting of
a sweep, ...): ``logits = x W[block] + bias[block]``, x being hashed token counts over the square root of their
number. A loss is a function of the logits that returns its value and its slope:

    loss(z [n, classes], gold [n], teacher [n, classes] or None, block [n]) -> (value [n], slope [n, classes])

A round is one pass over the stored training rows. Every task adds up slope times feature for its rows in one
array the size of the weights, and sends it in parts of PART numbers; Spark adds each part up over all tasks.
The update (Adam with decoupled weight decay) needs the weights and two accumulators, whose size is
blocks x classes x (features + 1) numbers by construction and does not grow with the rows. Weights, accumulators and the
round's loss are written per round; a fit that finds rounds of its path goes on from the last complete one.

Blocks never mix: a block's mean gradient is over its own rows, and the update is per weight, so one joint
fit is the fits of all blocks, and a block holding most rows is spread over all tasks.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tenor.functions.text import hash32, tokens
from tenor.session import scratch_path

Loss = Callable[[np.ndarray, np.ndarray, "np.ndarray | None", np.ndarray], "tuple[np.ndarray, np.ndarray]"]

HASHED = 1 << 16             # features of the stored rows; a smaller model takes them modulo its own number
PAIR = (65521, 40503)        # a pair of words is ((h1 mod 65521) * 40503 + h2) mod HASHED
RATE, BETA1, BETA2, EPS, DECAY = 0.1, 0.9, 0.999, 1e-4, 0.01
PART = 1 << 14
ENTRIES = 1 << 18            # features worked on together in a task
STATE = "part int, w binary, m binary, v binary"


@dataclass(frozen=True)
class Shape:
    blocks: int
    classes: int
    features: int

    @property
    def size(self) -> int:
        return self.blocks * (self.features + 1) * self.classes


@dataclass(frozen=True)
class Model:
    """Weights of every round, stored under ``path``."""

    path: str
    shape: Shape
    rounds: int

    def weights(self, spark: SparkSession, turn: int | None = None) -> np.ndarray:
        """(blocks * (features + 1), classes) after a round (the last by default)."""
        return _read_state(spark, self.path, self.shape, self.rounds if turn is None else turn)[0].reshape(-1, self.shape.classes)

    def history(self, spark: SparkSession) -> DataFrame:
        """(epoch, block, loss, weight): the mean training loss that each round's gradient was taken at; blocks without rows left out."""
        out = []
        for r in range(1, self.rounds + 1):
            lost, weight = _read_state(spark, self.path, self.shape, r)[3:]
            out += [(r, b, float(lost[b]), float(weight[b])) for b in range(self.shape.blocks) if weight[b] > 0]
        return spark.createDataFrame(out, "epoch int, block int, loss double, weight double")


# --------------------------------------------------------------------------- features


def add_features(df: DataFrame, text: str = "text") -> DataFrame:
    """Adds ``idx``: hashed words and pairs of neighbouring words of the text, one entry per occurrence."""
    a, b = PAIR
    hashed = df.withColumn("_h", F.transform(tokens(text), hash32))
    n = F.greatest(F.size("_h") - 1, F.lit(0))
    pairs = F.zip_with(F.slice("_h", 1, n), F.slice("_h", 2, n), lambda x, y: F.pmod(F.pmod(x, F.lit(a)) * b + y, F.lit(HASHED)))
    words = F.transform("_h", lambda x: F.pmod(x, F.lit(HASHED)))
    return hashed.withColumn("idx", F.concat(words, pairs).cast("array<int>")).drop("_h")


# --------------------------------------------------------------------------- losses


def _softmax(z: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(probabilities, their logs)."""
    z = z - z.max(axis=1, keepdims=True)
    log = z - np.log(np.exp(z).sum(axis=1, keepdims=True))
    return np.exp(log), log


def cross_entropy(z, gold, teacher, block):
    """-log p(gold)."""
    p, log = _softmax(z)
    at = np.arange(len(gold)), gold
    slope = p.copy()
    slope[at] -= 1
    return -log[at], slope


def distillation(alpha: float | Sequence[float], temperature: float) -> Loss:
    """(1 - alpha) CE + alpha T^2 KL(teacher_T || student_T); alpha may differ by block."""
    alphas = np.atleast_1d(np.asarray(alpha, np.float64))
    t = float(temperature)

    def loss(z, gold, teacher, block):
        a = alphas[block % len(alphas)]
        ce, hard = cross_entropy(z, gold, None, block)
        q, log_q = _softmax(teacher / t)
        p, log_p = _softmax(z / t)
        kl = np.where(q > 0, q * (log_q - log_p), 0.0).sum(axis=1)
        return (1 - a) * ce + a * t * t * kl, (1 - a)[:, None] * hard + (a * t)[:, None] * (p - q)

    return loss


# --------------------------------------------------------------------------- inside tasks


def _slices(sizes: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges of rows with about ENTRIES features together (one row at least)."""
    ends, lo = np.cumsum(sizes), 0
    while lo < len(sizes):
        before = ends[lo - 1] if lo else 0
        hi = max(lo + 1, int(np.searchsorted(ends, before + ENTRIES, side="right")))
        yield lo, hi
        lo = hi


def sliced(batches: Iterator[pa.RecordBatch], lists: str) -> Iterator[pa.RecordBatch]:
    """The batches in slices of rows whose ``lists`` hold a bounded number of entries together (one row at least): what a task
    works on at a time does not follow the length of the texts."""
    for batch in batches:
        sizes = batch.column(batch.schema.get_field_index(lists)).value_lengths().fill_null(0).to_numpy()
        for lo, hi in _slices(sizes):
            yield batch.slice(lo, hi - lo)


def _columns(batch: pa.RecordBatch, shape: Shape):
    """(block, features of all rows, features per row) of a batch."""
    idx = batch.column(batch.schema.get_field_index("idx"))
    sizes = idx.value_lengths().fill_null(0).to_numpy().astype(np.int64)
    block = batch.column(batch.schema.get_field_index("block")).to_numpy().astype(np.int64)
    return block, idx.flatten().to_numpy() % shape.features, sizes


def _row_logits(w: np.ndarray, shape: Shape, block, idx, sizes):
    """(logits, weight row of every feature, feature value of every row, row of every feature) of a slice of rows."""
    row = np.repeat(np.arange(len(sizes)), sizes)
    place = block[row] * (shape.features + 1) + idx
    x = 1.0 / np.sqrt(np.maximum(sizes, 1))
    z = w[block * (shape.features + 1) + shape.features].astype(np.float64)
    columns = np.ascontiguousarray(w.T)
    for k in range(shape.classes):
        z[:, k] += np.bincount(row, weights=columns[k].take(place), minlength=len(sizes)) * x
    return z, place, x, row


def _teacher(batch: pa.RecordBatch, n: int) -> np.ndarray | None:
    at = batch.schema.get_field_index("teacher")
    return None if at < 0 else batch.column(at).flatten().to_numpy().reshape(n, -1)


def _gradient(shape: Shape, loss: Loss, shared) -> Callable:
    """mapInArrow function: the sums of a task, in parts; the last part holds loss and weight by block."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = shared.value
        total, facts = np.zeros((len(w), shape.classes)), np.zeros((2, shape.blocks))
        for batch in sliced(batches, "idx"):
            b, idx, sizes = _columns(batch, shape)
            gold, weight = (batch.column(batch.schema.get_field_index(c)).to_numpy() for c in ("gold", "weight"))
            z, place, x, row = _row_logits(w, shape, b, idx, sizes)
            value, slope = loss(z, gold, _teacher(batch, len(b)), b)
            slope = slope * weight[:, None]
            bias = b * (shape.features + 1) + shape.features
            for k in range(shape.classes):
                total[:, k] += np.bincount(place, weights=(slope[:, k] * x).take(row), minlength=len(w))
                total[:, k] += np.bincount(bias, weights=slope[:, k], minlength=len(w))
            facts[0] += np.bincount(b, weights=value * weight, minlength=shape.blocks)
            facts[1] += np.bincount(b, weights=weight, minlength=shape.blocks)
        flat = np.concatenate((total.ravel(), facts.ravel()))
        parts = [(i, flat[s:s + PART]) for i, s in enumerate(range(0, len(flat), PART))]
        parts = [(i, p) for i, p in parts if p.any()]
        yield pa.RecordBatch.from_arrays([pa.array([i for i, _ in parts], pa.int32()),
                                          pa.array([p.tobytes() for _, p in parts], pa.binary())], names=["part", "total"])

    return run


def _add(table: pa.Table) -> pa.Table:
    total = sum(np.frombuffer(x.as_py(), np.float64) for x in table.column("total"))
    return pa.table({"part": table.column("part")[:1], "total": pa.array([total.tobytes()], pa.binary())})


# --------------------------------------------------------------------------- rounds


def gradient(rows: DataFrame, shape: Shape, loss: Loss, w: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(mean gradient [weights, classes], mean loss by block, weight by block) of the rows
    (block, gold, weight, idx[, teacher]) at the weights ``w``."""
    shared = rows.sparkSession.sparkContext.broadcast(w)
    have = [c for c in ("block", "gold", "weight", "idx", "teacher") if c in rows.columns]
    sums = (rows.select(*have).mapInArrow(_gradient(shape, loss, shared), "part int, total binary")
            .groupBy("part").applyInArrow(_add, "part int, total binary").collect())
    shared.unpersist()
    flat = np.zeros(shape.size + 2 * shape.blocks)
    for r in sums:
        values = np.frombuffer(r["total"], np.float64)
        flat[r["part"] * PART:r["part"] * PART + len(values)] = values
    lost, weight = flat[shape.size:].reshape(2, -1)
    per = np.maximum(weight, 1e-300)
    total = flat[:shape.size].reshape(shape.blocks, -1) / per[:, None]
    return total.reshape(-1, shape.classes), lost / per, weight


def _write_state(spark: SparkSession, path: str, turn: int, state: Sequence[np.ndarray]) -> None:
    """One row per PART numbers of (weights, accumulators), and one for the round's (loss, weight) by block."""
    *numbers, lost, weight = state
    parts = [(i, *(x[s:s + PART].tobytes() for x in numbers)) for i, s in enumerate(range(0, len(numbers[0]), PART))]
    columns = list(zip(*parts, (-1, lost.tobytes(), weight.tobytes(), b"")))
    table = pa.table({"part": pa.array(columns[0], pa.int32()), **{c: pa.array(x, pa.binary()) for c, x in zip("wmv", columns[1:])}})
    spark.createDataFrame(table).coalesce(1).write.mode("overwrite").parquet(f"{path}/round-{turn}")


def _read_state(spark: SparkSession, path: str, shape: Shape, turn: int) -> list[np.ndarray] | None:
    """[weights, first, second accumulator, loss, weight] of a round; None where it is not there as a whole."""
    if turn == 0:
        return [np.zeros(shape.size) for _ in range(3)] + [np.zeros(shape.blocks)] * 2
    try:
        rows = sorted(spark.read.schema(STATE).parquet(f"{path}/round-{turn}").collect())
    except AnalysisException:
        return None
    if not rows:
        return None
    facts, *parts = rows  # part -1 comes first
    state = [np.frombuffer(b"".join(bytes(r[c]) for r in parts), np.float64) for c in "wmv"]
    state += [np.frombuffer(bytes(facts[c]), np.float64) for c in "wm"]
    return state if all(len(x) == shape.size for x in state[:3]) else None


def fit(rows: DataFrame, shape: Shape, loss: Loss, rounds: int, path: str | None = None, rate: float = RATE) -> Model:
    """Train on ``rows`` (block, gold, weight, idx[, teacher]), which should be a stored table: every round reads it.
    With a ``path`` that holds rounds of the same fit, training goes on after the last complete one."""
    spark = rows.sparkSession
    done = 0
    if path is None:
        path = scratch_path(spark, "rounds")
    else:
        done = next((r for r in range(rounds, 0, -1) if _read_state(spark, path, shape, r) is not None), 0)
    w, m, v = _read_state(spark, path, shape, done)[:3]
    for turn in range(done + 1, rounds + 1):
        g, lost, weight = gradient(rows, shape, loss, w.reshape(-1, shape.classes))
        g = g.ravel()
        m, v = BETA1 * m + (1 - BETA1) * g, BETA2 * v + (1 - BETA2) * g * g
        step = (m / (1 - BETA1 ** turn)) / (np.sqrt(v / (1 - BETA2 ** turn)) + EPS)
        w = w - rate * (step + DECAY * w)
        _write_state(spark, path, turn, (w, m, v, lost, weight))
    return Model(path, shape, rounds)


def logits(rows: DataFrame, model: Model, turns: Sequence[int] | None = None, out: str = "logits",
           features: bool = False) -> DataFrame:
    """``rows`` (block, idx, ...) without idx (unless ``features``), with ``out``: the logits of each row's block; narrow, one pass.
    With ``turns`` a row appears once per round, with ``epoch``."""
    spark, shape = rows.sparkSession, model.shape
    shared = spark.sparkContext.broadcast([model.weights(spark, r) for r in (turns or [model.rounds])])
    keep = [c for c in rows.columns if features or c != "idx"]
    schema = T.StructType([rows.schema[c] for c in keep] + ([T.StructField("epoch", T.IntegerType())] if turns else [])
                          + [T.StructField(out, T.ArrayType(T.DoubleType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, "idx"):
            block, idx, sizes = _columns(batch, shape)
            for i, w in enumerate(shared.value):
                flat = _row_logits(w, shape, block, idx, sizes)[0].ravel()
                offsets = pa.array(np.arange(len(block) + 1, dtype=np.int32) * shape.classes, pa.int32())
                arrays = [batch.column(batch.schema.get_field_index(c)) for c in keep]
                if turns:
                    arrays.append(pa.array(np.full(len(block), turns[i], np.int32)))
                yield pa.RecordBatch.from_arrays([*arrays, pa.ListArray.from_arrays(offsets, pa.array(flat))], names=schema.names)

    return rows.mapInArrow(run, schema)
