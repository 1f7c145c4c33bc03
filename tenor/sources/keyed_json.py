"""One large JSON object ``{"key": {...}, "key": {...}}``, read in splits.

Spark's text reader cuts the file at every ``}``, so a file splits by bytes like any text. A fragment alone does
not say whether it begins inside a string or how deep it is; that is a prefix scan over the file:

1. Every split gives, for each of the three ways it can begin (outside strings, inside one, after a backslash
   inside one), the way it ends and the change of depth: one row per split.
2. These rows are composed in file order, which tells every split's true beginning.
3. Every split is read again from its true beginning. A record ends where a ``}`` outside strings returns to depth
   1. Records that lie in one split leave it whole; what comes before a split's first record end, or
   after its last, leaves as a piece, and pieces of one record are put together in order: two per split at most.

Keys may be any string; values are objects. The tables of 1 and 2 hold one row per split (of
``spark.sql.files.maxPartitionBytes``), which bounds what is broadcast.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

OUTSIDE, INSIDE, ESCAPED = range(3)
_REST = re.compile(r'(?:[^"\\]|\\.)*', re.S)                       # the rest of a string
_TOKEN = re.compile(r'"(?:[^"\\]|\\.)*(?P<end>"|\\?\Z)|[{}]', re.S)  # a string, closed or cut off, or a brace


def follow(text: str, state: int) -> tuple[int, int]:
    """(state at the end of ``text``, change of depth), beginning in ``state``."""
    at = 0
    if state == ESCAPED:
        if not text:
            return ESCAPED, 0
        at, state = 1, INSIDE
    if state == INSIDE:
        at = _REST.match(text, at).end()
        if at >= len(text):
            return INSIDE, 0
        if text[at] == "\\":  # the last character
            return ESCAPED, 0
        at += 1
    depth = 0
    for m in _TOKEN.finditer(text, at):
        if m["end"] is None:
            depth += 1 if m[0] == "{" else -1
        elif m["end"] != '"':
            return (ESCAPED if m["end"] else INSIDE), depth
    return OUTSIDE, depth


def _splits(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple[str, int], str, pa.RecordBatch, int]]:
    """((file, first byte of its split), fragment with its brace, batch, row) in reading order."""
    for batch in batches:
        for i, (file, start, value) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("file", "start", "value")))):
            yield (file, start), value + "}", batch, i


def _facts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per split: for every way to begin, the way to end and the change of depth."""
    found: dict[tuple[str, int], list[list[int]]] = {}
    for split, text, _, _ in _splits(batches):
        ways = found.setdefault(split, [[s, 0] for s in range(3)])
        for way in ways:
            way[0], change = follow(text, way[0])
            way[1] += change
    yield pa.RecordBatch.from_pydict(
        {"file": [f for f, _ in found], "start": [s for _, s in found], "ends": [[w[0] for w in v] for v in found.values()],
         "depths": [[w[1] for w in v] for v in found.values()]},
        schema=pa.schema([("file", pa.string()), ("start", pa.int64()), ("ends", pa.list_(pa.int32())), ("depths", pa.list_(pa.int64()))]))


def _compose(table: pa.Table) -> pa.Table:
    """The splits of a file in order -> (file, start, state, depth) each truly begins in."""
    state, depth, rows = OUTSIDE, 0, []
    for r in sorted(table.to_pylist(), key=lambda r: r["start"]):
        rows.append({"file": r["file"], "start": r["start"], "state": state, "depth": depth})
        state, depth = r["ends"][state], depth + r["depths"][state]
    return pa.Table.from_pylist(rows, schema=pa.schema([("file", pa.string()), ("start", pa.int64()), ("state", pa.int32()), ("depth", pa.int64())]))


def _records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(file, start, kind, text): whole records, and a split's head and tail (null text: it holds no record end)."""
    schema = pa.schema([("file", pa.string()), ("start", pa.int64()), ("kind", pa.string()), ("text", pa.string())])
    current, out = None, []

    def leave(kind, parts):
        out.append({"file": current[0], "start": current[1], "kind": kind, "text": "".join(parts)})

    for split, text, batch, i in _splits(batches):
        if split != current:
            if current is not None:
                leave("tail" if ended else "through", parts)
            current, parts, ended = split, [], False
            state, depth = batch.column("state")[i].as_py(), batch.column("depth")[i].as_py()
        state, change = follow(text, state)
        depth += change
        parts.append(text)
        if state == OUTSIDE and depth == 1:
            leave("whole" if ended else "head", parts)
            parts, ended = [], True
        if len(out) >= 4096:
            yield pa.RecordBatch.from_pylist(out, schema=schema)
            out = []
    if current is not None:
        leave("tail" if ended else "through", parts)
    yield pa.RecordBatch.from_pylist(out, schema=schema)


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """(value): every top-level ``"key": {...}`` of the files, each as a JSON object of one key."""
    raw = (spark.read.option("lineSep", "}").option("recursiveFileLookup", "true").text(path)
           .select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), "value"))
    facts = raw.mapInArrow(_facts, "file string, start long, ends array<int>, depths array<long>")
    begins = facts.groupBy("file").applyInArrow(_compose, "file string, start long, state int, depth long")
    pieces = raw.join(F.broadcast(begins), ["file", "start"]).mapInArrow(_records, "file string, start long, kind string, text string")
    # a record that crosses splits: the tail of one, the splits it runs through, the head of the last
    cut = pieces.where("kind <> 'whole'").withColumn("turn", F.when(F.col("kind") == "tail", 1).otherwise(0))
    order = Window.partitionBy("file").orderBy("start", "turn")  # at most two rows per split
    opened = F.coalesce(F.sum("turn").over(order), F.lit(0))
    joined = (cut.withColumn("record", opened).groupBy("file", "record")
              .agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("start", "turn", "text"))), lambda p: p["text"]), "").alias("text")))
    text = pieces.where("kind = 'whole'").select("text").unionByName(joined.select("text"))
    body = F.regexp_replace("text", r"^[\s,{]+", "")
    return text.select(body.alias("body")).where(F.startswith("body", F.lit('"'))).select(F.concat(F.lit("{"), F.col("body"), F.lit("}")).alias("value"))
