"""Conversation repair against an automaton search and against every edit string."""

import hashlib
import itertools
import random
import re
import zlib

import numpy as np
import pytest

from tenor.llm import turn_grammar as G
from tenor.llm import turn_repair as T
from tenor.llm.queries import op13_turn_repair

SF = "/root/testdata/sf0.001"
LEGAL = re.compile("(s?(ua)+)?")
# automaton of (s?(ua)+)?: state -> {initial: state}; accepting: start and after a
STEPS = {"0": {"s": "1", "u": "2"}, "1": {"u": "2"}, "2": {"a": "3"}, "3": {"u": "2"}}


def search(rows):
    """Least (cost, audit) over rows (initial, must go, cut off), state by state of the automaton."""
    def inserted(best):
        for _ in range(4):
            for state, (cost, audit) in list(best.items()):
                for c, to in STEPS[state].items():
                    if c in "ua" and (to not in best or (cost + 5, audit + "I") < best[to]):
                        best[to] = (cost + 5, audit + "I")
        return best

    best = inserted({"0": (0, "")})
    for initial, gone, cut in rows:
        new = {}
        for state, (cost, audit) in best.items():
            options = [(state, cost + 2, audit + "D")]
            if not gone:
                options += [(to, cost + 5 * cut + (c != initial), audit + ("K" if c == initial else "R"))
                            for c, to in STEPS[state].items() if c in "ua" or c == initial]
            for to, *value in options:
                if to not in new or tuple(value) < new[to]:
                    new[to] = tuple(value)
        best = inserted(new)
    return min(best[s] for s in ("0", "3") if s in best)


def every(rows):
    """The same from all edit strings with at most two inserts."""
    found = []
    options = [[("D", "", 2)] + ([] if gone else [("K", i, 5 * cut), ("R", "u", 1 + 5 * cut), ("R", "a", 1 + 5 * cut)])
               for i, gone, cut in rows]
    for pick in itertools.product(*options):
        for n in range(3):
            for where in itertools.combinations_with_replacement(range(len(pick) + 1), n):
                for what in itertools.product("ua", repeat=n):
                    seq = []
                    for i in range(len(pick) + 1):
                        seq += [("I", c, 5) for w, c in zip(where, what) if w == i]
                        seq += [pick[i]] if i < len(pick) else []
                    if LEGAL.fullmatch("".join(c for _, c, _ in seq)):
                        found.append((sum(x for _, _, x in seq), "".join(e for e, _, _ in seq)))
    return min(found)


def random_rows(rng, n, roles="suasuat"):
    return [(rng.choice(roles), rng.random() < 0.2, rng.random() < 0.2) for _ in range(n)]


def arrays(rows):
    return (np.array([[r[0] for r in rows]]), np.array([[r[1] for r in rows]]), np.array([[r[2] for r in rows]]))


def cell_of(rows):
    done = G.parse_rows(*arrays(rows))
    return [(int(c), G.unpacked(int(a), int(n))) if c < G.NONE else None
            for c, a, n in zip(done.cost[0, 0], done.audit[0, 0], done.size[0, 0])]


def test_search_equals_every_edit_string():
    rng = random.Random(1)
    for _ in range(60):
        rows = random_rows(rng, rng.randint(0, 4))
        assert search(rows) == every(rows), rows


def test_pieces_equal_search():
    rng = random.Random(2)
    for _ in range(400):
        rows = random_rows(rng, rng.randint(1, 16), rng.choice(["suasuat", "ua", "u", "s", "tx", "sssua"]))
        assert G.cheapest(cell_of(rows)) == search(rows), rows


@pytest.mark.parametrize("piece", [2, 3, 16])
def test_levels_equal_search(monkeypatch, piece):
    monkeypatch.setattr(G, "PIECE", piece)
    rng = random.Random(piece)
    for n in (17, 33, 150):
        for _ in range(4):
            rows = random_rows(rng, n)
            cut = sorted({0, n, *[rng.randrange(n) for _ in range(n // 4)]})
            pieces = [cell_of(rows[a:b][i:i + 8]) for a, b in zip(cut, cut[1:]) for i in range(0, b - a, 8)]
            assert G.cheapest(G.parse_all(pieces)) == search(rows)
    assert G.cheapest(G.parse_all([])) == (0, "")


def test_shapes_of_one_row():
    keep = cell_of([("u", False, False)])
    assert keep[G.UU] == (0, "K") and keep[G.UA] == (5, "KI") and keep[G.AA] == (1, "R") and keep[G.E] == (2, "D")
    gone = cell_of([("s", True, False)])
    assert gone[G.S] is None and gone[G.UU] == (7, "DI")
    assert cell_of([("s", False, False)])[G.SA] == (10, "KII")


# ------------------------------------------------------------------ tables


def plain(rows):
    """{conv_id: result} of raw rows by the contract, in Python."""
    out = {}
    for conv in {r[0] for r in rows}:
        mine = []
        for c, turn, role, text in rows:
            if c != conv:
                continue
            how = zlib.crc32(f"{' ' if c is None else c}:{' ' if turn is None else turn}".encode()) % 20
            role, text = " " if role is None else role, " " if text is None else text
            if how:
                row = (turn, "user" if how == 4 else role, "" if how == 1 else re.sub("[.!?]", "", text) if how == 2 else text)
                mine += [row] * (2 if how == 3 else 1)
        mine.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        seen, marks, counts = set(), [], [0, 0, 0]
        for _, role, text in mine:
            shown = re.findall(r"[^\x20\x09-\x0D]", text)
            fault = 0 if not shown else 1 if (role, text) in seen else 2 if shown[-1] not in ".!?" else 3
            seen.add((role, text))
            marks.append((role[:1], fault < 2, fault == 2))
            if fault < 3:
                counts[fault] += 1
        turns = [t for t, _, _ in mine if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum(a[0] + b[0] not in ("su", "ua", "au") for a, b in zip(marks, marks[1:]))
        cost, audit = search(marks)
        kept, left = [], iter(mine)
        size = len(audit) - audit.count("D")
        roles = ["s"] * (size % 2) + ["user", "assistant"] * (size // 2)
        for e in audit:
            row = None if e == "I" else next(left)
            if e != "D":
                kept.append(f"{row[1] if e == 'K' else roles[len(kept)]}:{row[2] if row else ''}")
        out[conv] = (gaps, *counts, illegal, cost, audit, hashlib.sha256("\n".join(kept).encode()).hexdigest())
    return out


def result(df):
    got = df.collect()
    out = {r.conv_id: (r.gaps, r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit, r.repaired_sha256) for r in got}
    assert len(out) == len(got)
    return out


def raw(rng, conversations, longest):
    texts = ["Hi.", "no end", "Well!", "", " \t\n", None, "Ends? ", "é.", "Hi.", "x" * 50]
    rows = []
    for c in range(conversations):
        n = rng.randint(1, longest)
        rows += [(c if c else None, rng.choice([None, i, i, i, i, i // 2]), rng.choice(["user", "assistant", "system", "tool", "", None, "user", "assistant"]),
                  rng.choice(texts)) for i in range(n)]
    return rows


SCHEMA = "conv_id long, turn long, role string, text string"


def test_digest(spark):
    rows = raw(random.Random(3), 150, 12)
    dropped = [(1000 + c, t, "user", "Hi.") for c in range(400) for t in range(3) if zlib.crc32(f"{1000 + c}:{t}".encode()) % 20 == 0]
    rows += [r for r in dropped if sum(x[0] == r[0] for x in dropped) == 1] + [rows[0]] * 3
    df = spark.createDataFrame([(*r, 1, "z") for r in rows], SCHEMA + ", gone int, audit string").repartition(7)
    want = plain(rows)
    assert any(v[6] == "" for v in want.values())
    assert result(T.digest(T.damage(df))) == want
    assert T.digest(T.damage(df.where("false"))).count() == 0


@pytest.mark.parametrize("chunk", [16, 1 << 15])
def test_long_conversation_over_tasks(spark, chunk):
    rng = random.Random(4)
    texts = [f"text {i}." for i in range(300)] + ["cut", "", "Hi."]
    rows = [(7, i, rng.choice(["user", "assistant", "system"]), rng.choice(texts)) for i in range(1500)]
    rows += [(8, 5, "user", "Hi.")] * 300 + [(9, None, None, None)] * 40 + raw(rng, 20, 30)
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    assert result(T.digest(T.damage(df), chunk=chunk)) == plain(rows)


def test_repair_gives_legal_turns(spark):
    rows = raw(random.Random(6), 60, 9)
    by = {}
    for r in T.repair(spark.createDataFrame(rows, SCHEMA)).collect():
        by.setdefault(r.conv_id, []).append(r)
    for turns in by.values():
        turns.sort(key=lambda r: r.seq)
        assert [r.seq for r in turns] == list(range(len(turns))) and LEGAL.fullmatch("".join(r.role[0] for r in turns))


def test_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert result(op13_turn_repair(spark, SF)) == plain(rows)
