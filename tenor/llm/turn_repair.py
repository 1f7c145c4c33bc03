"""Conversations repaired to ``(system? (user assistant)+)?`` at least cost (see ``turn_grammar``).

A row's fault is the first that holds: blank (no visible character), duplicate (its role and
text seen earlier in the conversation), truncated (the last visible character ends no
sentence). Blank and duplicate rows must go; a truncated row that stays costs extra.

Three passes, none of which gathers a conversation:

1. Rows are *range*-partitioned and sorted by (conv_id, turn, role, text), so a conversation of any
   share of the table spreads over tasks. Each task parses its runs of rows into
   segments: one parse cell per shape, counts, and the turns at both ends.
2. The segments of a conversation (one per task that met it, more for very long runs) are
   combined in order: counts added, cells parsed on. This gives cost and audit.
3. Rows meet the audit of their conversation as a sorted stream and are edited one at a
   time. The audit is one value of the result, so its length is the only memory that grows.

Whether a row was seen earlier is decided before pass 1 by an aggregate per (conversation, role and
text): the first turn that holds them. Equal rows of one turn lie next to each other.

Null roles and texts are one space, so they are blank. Null turns come first; rows that share a
turn are ordered by role and text. A null conv_id is a conversation of its own. Repeated rows are
duplicates. Other columns are ignored. An empty table gives no conversations.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tenor.llm import turn_grammar as G

VISIBLE_NOT = " \t\n\x0b\x0c\r"
ENDS = (".", "!", "?")
CHUNK = 1 << 15
ROLES = {"u": "user", "a": "assistant"}
COUNTS = ("blank", "duplicate", "truncated", "illegal")
SEGMENT = pa.schema([("conv_id", pa.int64()), ("part", pa.int32()), ("seq", pa.int32()), *[(c, pa.int64()) for c in COUNTS],
                     ("turns", pa.int64()), ("first_turn", pa.int64()), ("last_turn", pa.int64()), ("first", pa.string()),
                     ("last", pa.string()), ("costs", pa.list_(pa.int64())), ("audits", pa.list_(pa.string()))])
SEGMENT_SQL = ("conv_id long, part int, seq int, " + ", ".join(f"{c} long" for c in COUNTS)
               + ", turns long, first_turn long, last_turn long, first string, last string, costs array<long>, audits array<string>")
PARSED_SQL = "conv_id long, gaps long, " + ", ".join(f"{c} long" for c in COUNTS) + ", cost long, audit string"


def damage(turns: DataFrame) -> DataFrame:
    """Rows damaged by crc32(``conv_id:turn``) % 20; dropped rows stay as ``gone``, so that their conversation is known."""
    part = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    rows = rows_of(turns).withColumn("_how", F.crc32(F.concat(part("conv_id"), F.lit(":"), part("turn")).cast("binary")) % 20)
    how = F.col("_how")
    text = F.when(how <= 1, F.lit("")).when(how == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(how == 4, F.lit("user")).otherwise(F.col("role"))
    out = rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), (how == 0).alias("gone"), "_how")
    copies = F.explode(F.array_repeat(F.lit(0), F.when(F.col("_how") == 3, F.lit(2)).otherwise(F.lit(1))))
    return out.select("conv_id", "turn", "role", "text", "gone", copies.alias("_copy")).drop("_copy")


def rows_of(turns: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, gone): nulls as stated above; no row gone unless ``gone`` says so."""
    return turns.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                        F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"),
                        F.lit(False).alias("gone"))


def judged(rows: DataFrame) -> DataFrame:
    """Adds blank, truncated, the 128-bit hash (h1, h2) of role and text, and later: the same in an earlier turn."""
    seen = F.rtrim(F.col("text"), F.lit(VISIBLE_NOT))
    rows = rows.select("*", (seen == "").alias("blank"), (~F.substring(seen, -1, 1).isin(*ENDS)).alias("truncated"),
                       F.xxhash64("role", "text").alias("h1"), F.xxhash64(F.lit(1), "role", "text").alias("h2"))
    turn = F.struct("turn")  # a null turn is the least
    again = (rows.where(~F.col("gone")).groupBy(F.col("conv_id").alias("_c"), F.col("h1").alias("_1"), F.col("h2").alias("_2"))
             .agg(F.min(turn).alias("_first"), F.max(turn).alias("_last")).where(F.col("_first") != F.col("_last")))
    met = rows.join(again, F.col("conv_id").eqNullSafe(F.col("_c")) & (F.col("h1") == F.col("_1")) & (F.col("h2") == F.col("_2")), "left")
    return met.select(*rows.columns, F.coalesce(turn > F.col("_first"), F.lit(False)).alias("later"))


def _changes(values: np.ndarray, known: np.ndarray) -> np.ndarray:
    """True where a value differs from the one before (nulls are equal); the first is True."""
    out = np.ones(len(values), bool)
    out[1:] = (known[1:] != known[:-1]) | (known[1:] & (values[1:] != values[:-1]))
    return out


def _nullable(column: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    return column.fill_null(0).to_numpy(), column.is_valid().to_numpy()


def segment_rows(table: pa.Table, previous: tuple | None) -> tuple[dict[str, list], tuple | None]:
    """One segment per run of a conversation in ``table`` (sorted rows), as columns, and the last row that is
    not gone; ``previous``: that of the rows before."""
    conv, has_conv = _nullable(table.column("conv_id"))
    run = np.cumsum(_changes(conv, has_conv)) - 1
    starts = np.flatnonzero(np.diff(run, prepend=-1))
    alive = np.flatnonzero(~table.column("gone").to_numpy())
    here, runs = run[alive], len(starts)
    turn, has_turn = (x[alive] for x in _nullable(table.column("turn")))
    key = [table.column(h).to_numpy()[alive] for h in ("h1", "h2")]
    blank, cut, later = (table.column(c).to_numpy()[alive] for c in ("blank", "truncated", "later"))
    initial = np.array(table.column("initial").to_pylist(), dtype="U1")[alive] if len(alive) else np.empty(0, "U1")

    same = ~_changes(turn, has_turn)
    same[1:] &= (here[1:] == here[:-1]) & (key[0][1:] == key[0][:-1]) & (key[1][1:] == key[1][:-1])
    if len(alive):
        at = lambda i: tuple(x[i].item() for x in (has_conv[alive], conv[alive], has_turn, turn, *key))
        same[0] = at(0) == previous
        previous = at(-1)
    duplicate = (later | same) & ~blank
    cut = cut & ~blank & ~duplicate
    code = (initial == "s") * 1 + (initial == "u") * 2 + (initial == "a") * 3
    joined = here[1:] == here[:-1]
    legal = ((code[1:] == 2) & ((code[:-1] == 1) | (code[:-1] == 3))) | ((code[1:] == 3) & (code[:-1] == 2))
    total = lambda at: np.bincount(at, minlength=runs).tolist()

    dated = np.flatnonzero(has_turn)
    new_turn = np.ones(len(dated), bool)
    new_turn[1:] = (turn[dated][1:] != turn[dated][:-1]) | (here[dated][1:] != here[dated][:-1])
    first_turn, last_turn, first, last = ([None] * runs for _ in range(4))
    for r, t in zip(here[dated][::-1], turn[dated][::-1]):
        first_turn[r] = int(t)
    for r, t in zip(here[dated], turn[dated]):
        last_turn[r] = int(t)
    for r, c in zip(here[::-1], initial[::-1]):
        first[r] = str(c)
    for r, c in zip(here, initial):
        last[r] = str(c)

    cells = _parse_runs(here, runs, initial, blank | duplicate, cut)
    columns = {"conv_id": [int(c) if k else None for c, k in zip(conv[starts], has_conv[starts])],
               "blank": total(here[blank]), "duplicate": total(here[duplicate]), "truncated": total(here[cut]),
               "illegal": total(here[1:][joined & ~legal]), "turns": total(here[dated][new_turn]), "first_turn": first_turn,
               "last_turn": last_turn, "first": first, "last": last,
               "costs": [None if c is None else [x and x[0] for x in c] for c in cells],
               "audits": [None if c is None else [x and x[1] for x in c] for c in cells]}
    return columns, previous


def _parse_runs(here: np.ndarray, runs: int, initial: np.ndarray, deleted: np.ndarray, cut: np.ndarray) -> list:
    """The cell of every run (None without rows): pieces of equal length are parsed together."""
    begin = np.searchsorted(here, np.arange(runs))
    size = np.diff(np.append(begin, len(here)))
    starts = [np.arange(b, b + n, G.PIECE) for b, n in zip(begin, size)]
    start = np.concatenate(starts) if starts else np.empty(0, np.int64)
    owner = np.repeat(np.arange(runs), [len(s) for s in starts])
    length = np.minimum(G.PIECE, (begin + size)[owner] - start)
    cells: list = [None] * len(start)
    shifts = np.arange(62, -2, -2, dtype=np.uint64)
    letters = np.frombuffer(G.LETTERS.encode(), np.uint8)
    for n in np.unique(length):
        which = np.flatnonzero(length == n)
        at = start[which][:, None] + np.arange(n)
        done = G.parse_rows(initial[at], deleted[at], cut[at])
        text = letters[((done.audit[:, 0, :, None] >> shifts) & np.uint64(3)).astype(np.int64)]
        text[np.arange(32) >= done.size[:, 0, :, None]] = 0
        audits = np.ascontiguousarray(text).view("S32")[..., 0].astype("U32").tolist()
        for w, costs, row in zip(which, done.cost[:, 0].tolist(), audits):
            cells[w] = [(c, a) if c < G.NONE else None for c, a in zip(costs, row)]
    bounds = np.searchsorted(owner, np.arange(runs + 1))
    return [G.parse_all(cells[lo:hi]) for lo, hi in zip(bounds[:-1], bounds[1:])]


def _segments(batches: Iterator[pa.RecordBatch], chunk: int) -> Iterator[pa.RecordBatch]:
    """Segments of sorted rows; a run of more than ``chunk`` rows gives several."""
    part, seq = TaskContext.get().partitionId(), 0
    held: list[pa.RecordBatch] = []
    previous = None

    def emit(table: pa.Table):
        nonlocal seq, previous
        columns, previous = segment_rows(table, previous)
        n = len(columns["conv_id"])
        columns |= {"part": [part] * n, "seq": list(range(seq, seq + n))}
        seq += n
        return pa.RecordBatch.from_pydict(columns, schema=SEGMENT)

    for batch in batches:
        if batch.num_rows == 0:
            continue
        held.append(batch)
        table = pa.Table.from_batches(held)
        conv, known = _nullable(table.column("conv_id"))
        last = int(np.flatnonzero(_changes(conv, known))[-1])  # the last conversation may go on
        if table.num_rows - last >= chunk:
            last = table.num_rows
        if last:
            yield emit(table.slice(0, last))
        held = table.slice(last).to_batches() if last < table.num_rows else []
    if held:
        yield emit(pa.Table.from_batches(held))


def _combine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Segments in order -> one row per conversation (PARSED_SQL)."""
    names = ["conv_id", "gaps", *COUNTS, "cost", "audit"]
    state: dict | None = None

    def done(s):
        cost, audit = G.cheapest(G.parse_all(s["cells"]))
        gaps = 0 if s["low"] is None else s["high"] - s["low"] + 1 - s["turns"]
        return [s["conv_id"], min(gaps, (1 << 63) - 1), *[s[c] for c in COUNTS], cost, audit]

    def table(rows):
        kinds = [pa.int64()] * (len(names) - 1) + [pa.string()]
        cols = list(zip(*rows)) or [[]] * len(names)
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names=names)

    for batch in batches:
        out = []
        for r in batch.to_pylist():
            if state is None or state["conv_id"] != r["conv_id"]:
                if state is not None:
                    out.append(done(state))
                state = {"conv_id": r["conv_id"], **dict.fromkeys(COUNTS, 0), "turns": 0, "low": None, "high": None,
                         "last": None, "cells": []}
            for c in COUNTS:
                state[c] += r[c]
            if r["first"] is not None:
                if state["last"] is not None and state["last"] + r["first"] not in ("su", "ua", "au"):
                    state["illegal"] += 1
                state["last"] = r["last"]
            if r["first_turn"] is not None:
                state["turns"] += r["turns"] - (state["high"] == r["first_turn"])
                state["low"] = r["first_turn"] if state["low"] is None else state["low"]
                state["high"] = r["last_turn"]
            if r["costs"] is not None:
                state["cells"].append([None if c is None else (c, a) for c, a in zip(r["costs"], r["audits"])])
        yield table(out)
    if state is not None:
        yield table([done(state)])


def parse(rows: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit) per conversation of ``rows`` (:func:`rows_of`)."""
    order = ("conv_id", "turn", "role", "text")
    ranged = judged(rows).repartitionByRange(*order).sortWithinPartitions(*order)
    narrow = ranged.select("conv_id", "turn", F.substring("role", 1, 1).alias("initial"), "gone", "blank", "truncated", "later", "h1", "h2")
    return (narrow.mapInArrow(partial(_segments, chunk=chunk), SEGMENT_SQL).repartition("conv_id").sortWithinPartitions("conv_id", "part", "seq")
            .mapInArrow(_combine, PARSED_SQL))


EDITED = ("conv_id", "seq", "edit", "role", "text")
_FACTS = ("gaps", *COUNTS, "cost", "audit")


def _edits(rows: DataFrame, **options) -> DataFrame:
    """A sorted stream per conversation: its parse (seq -1), then its repaired turns (EDITED)."""
    nothing = lambda *names: [F.lit(None).cast("string" if n in ("role", "text", "audit") else "long").alias(n) for n in names]
    heads = parse(rows, **options).select("conv_id", F.lit(0).alias("kind"), *nothing("turn", "role", "text"), *_FACTS)
    body = rows.where(~F.col("gone")).select("conv_id", F.lit(1).alias("kind"), "turn", "role", "text", *nothing(*_FACTS))
    stream = heads.unionByName(body).repartition("conv_id").sortWithinPartitions("conv_id", "kind", "turn", "role", "text")

    def edit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("conv_id", pa.int64()), ("seq", pa.int64()), ("edit", pa.string()), ("role", pa.string()), ("text", pa.string()),
                            *[(f, pa.string() if f == "audit" else pa.int64()) for f in _FACTS]])
        audit, at, seq, odd, conv = "", 0, 0, False, None

        def expected():
            return ROLES["ua"[(seq - odd) % 2]]

        for batch in batches:
            out = []
            for r in batch.to_pylist():
                if r["kind"] == 0:
                    audit, at, seq, conv = r["audit"], 0, 0, r["conv_id"]
                    odd = (len(audit) - audit.count("D")) % 2
                    out.append({"conv_id": conv, "seq": -1, **{f: r[f] for f in _FACTS}})
                else:
                    letter = audit[at]
                    at += 1
                    if letter != "D":
                        out.append({"conv_id": conv, "seq": seq, "edit": letter, "text": r["text"],
                                    "role": r["role"] if letter == "K" else expected()})
                        seq += 1
                while at < len(audit) and audit[at] == "I":
                    out.append({"conv_id": conv, "seq": seq, "edit": "I", "role": expected(), "text": ""})
                    at, seq = at + 1, seq + 1
            yield pa.RecordBatch.from_pylist(out, schema=schema)

    kinds = ", ".join(f"{f} {'string' if f == 'audit' else 'long'}" for f in _FACTS)
    return stream.mapInArrow(edit, f"conv_id long, seq long, edit string, role string, text string, {kinds}")


def repair(turns: DataFrame) -> DataFrame:
    """(conv_id, seq, edit, role, text): the repaired conversations; edit is K, R or I."""
    return _edits(rows_of(turns)).where("seq >= 0").select(*EDITED)


def digest(rows: DataFrame, **options) -> DataFrame:
    """Per conversation of ``rows`` (:func:`damage` or :func:`rows_of`): conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit,
    repaired_sha256 (of ``role:text`` per repaired turn, newline-joined)."""
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["conv_id", *_FACTS, "repaired_sha256"]
        schema = pa.schema([(n, pa.string() if n in ("audit", "repaired_sha256") else pa.int64()) for n in names])
        head, sha = None, None
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                if r["seq"] < 0:
                    if head is not None:
                        out.append({**head, "repaired_sha256": sha.hexdigest()})
                    head, sha = {"conv_id": r["conv_id"], **{f: r[f] for f in _FACTS}}, hashlib.sha256()
                else:
                    sha.update(f"{chr(10) if r['seq'] else ''}{r['role']}:{r['text']}".encode())
            yield pa.RecordBatch.from_pylist(out, schema=schema)
        if head is not None:
            yield pa.RecordBatch.from_pylist([{**head, "repaired_sha256": sha.hexdigest()}], schema=schema)

    kinds = ", ".join(f"{f} {'string' if f == 'audit' else 'long'}" for f in _FACTS)
    return _edits(rows, **options).mapInArrow(read, f"conv_id long, {kinds}, repaired_sha256 string")


