"""Exchange of per-block key statistics, and stored intermediate tables.

Documents are dealt into blocks of a few megabytes by a hash of the row. A
block sends, per range of its sorted distinct keys (a *bucket*), one row with
the keys packed as bytes; a bucket merges what all blocks sent and answers each
block with one value per key, in the key order the block already has. The two
shuffles thus carry one packed number per distinct key and block, a key shared
by many rows costs a block one entry, and no key meets more rows than there are blocks.

Block and bucket counts grow with the counted bytes; nothing is capped.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tenor.session import scratch_path

BLOCK_BYTES = 4 << 20


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write to a fresh folder of the shared place and read back (cuts lineage)."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def shielded(df: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """The frame with its columns renamed by place (own_0, own_1, ...), and the new name of each, so that no
    column of the caller's can meet one that an operator adds."""
    return df.toDF(*[f"own_{i}" for i in range(len(df.columns))]), {c: f"own_{i}" for i, c in enumerate(df.columns)}


def unshielded(names: dict[str, str], drop: tuple[str, ...] = ()) -> list[Column]:
    """The caller's columns under their own names again, without those that the result defines anew."""
    return [F.col(own).alias(c) for c, own in names.items() if c not in drop]


def row_hash(docs: DataFrame) -> Column:
    """One key per distinct row, from all its columns; never null. Equal rows share it."""
    return F.xxhash64(*[x for c in docs.columns for x in (F.col(c), F.col(c).isNull())])


def block_count(docs: DataFrame, text: str = "text", block_bytes: int | None = None) -> int:
    total = docs.agg(F.sum(F.octet_length(text).cast("long"))).first()[0] or 0
    return max(1, -(-int(total) // (block_bytes or BLOCK_BYTES)))


def with_block(docs: DataFrame, n: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Add ``block``; rows with one doc_id and different texts spread."""
    return docs.withColumn("block", F.pmod(F.xxhash64(key, text), F.lit(n)).cast("int"))


def bucket_edges(keys: np.ndarray, n: int) -> np.ndarray:
    """Positions that cut sorted uint32 keys into ``n`` equal key ranges."""
    bounds = (np.arange(n + 1, dtype=np.uint64) << np.uint64(32)) // np.uint64(n)
    return np.searchsorted(keys.astype(np.uint64), bounds)


def bucket_edges64(keys: np.ndarray, n: int) -> np.ndarray:
    """The same for sorted uint64 keys, by their upper half."""
    return bucket_edges((keys >> np.uint64(32)).astype(np.uint32), n)


def pack(block: int, edges: np.ndarray, columns: dict[str, np.ndarray]) -> pa.Table:
    """One row per bucket that has keys: (bucket, block, packed columns)."""
    used = [b for b in range(len(edges) - 1) if edges[b + 1] > edges[b]]
    data = {"bucket": pa.array(used, pa.int32()), "block": pa.array([block] * len(used), pa.int32())}
    for name, values in columns.items():
        data[name] = pa.array([values[edges[b]:edges[b + 1]].tobytes() for b in used], pa.binary())
    return pa.table(data)


def unpack(column: pa.ChunkedArray, dtype) -> tuple[np.ndarray, np.ndarray]:
    """(all values, values per row) of a packed column."""
    rows = [np.frombuffer(x.as_py(), dtype=dtype) for x in column]
    sizes = np.array([len(r) for r in rows], dtype=np.int64)
    return (np.concatenate(rows) if rows else np.empty(0, dtype)), sizes


def answers(replies: pa.Table, column: str, dtype) -> np.ndarray:
    """A block's answers in the order of its sorted keys."""
    order = np.argsort(replies.column("bucket").to_numpy(), kind="stable")
    return unpack(replies.column(column).take(pa.array(order)), dtype)[0]


def exchange(docs: DataFrame, emit: Callable, sent: str, merge: Callable, replied: str) -> DataFrame:
    """``emit(docs of a block) -> rows with (bucket, block, ...)``, then
    ``merge(rows of a bucket) -> rows with (block, bucket, ...)``."""
    return (docs.groupBy("block").applyInArrow(emit, sent)
            .groupBy("bucket").applyInArrow(merge, replied))
