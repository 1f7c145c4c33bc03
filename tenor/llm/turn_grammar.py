"""Weighted CYK parsing of turn sequences with a repair grammar.

Target language: ``(s?(ua)+)?`` over role initials. Edits of a row and their letters:
delete D, keep K, rerole R, and I for an inserted turn. Nonterminals of the
grammar (Chomsky normal form) are the shapes a span of rows can take:

    E   all deleted            s   the system turn alone
    xy  an alternating run that begins with x and ends with y (uu, ua, au, aa)
    sy  the system turn, then an alternating run that ends with y (su, sa)

    E -> E E    X -> E X | X E    xy -> xv wy, sy -> s uy | sv wy   (v, w different turns)

A cell holds the least (cost, audit) of its shape over its span; audit is the string of edit
letters. *Insertion closure*: an inserted turn lengthens a shape on the left or the right, so
after a span's splits its cells are relaxed by these unit steps until none improves.
Start shapes: E, ua, sa.

Cells of equal cost over the same rows are never proper prefixes of each other (a longer one
would hold more paid inserts), so the least audit of a concatenation is the
concatenation of the least audits, and cells may be combined bottom-up.

Shapes are closed under cutting a sequence anywhere, so a span's cells say all that its
neighbours need: PIECE rows are parsed by spans of rows, then the pieces are the
letters of the next parse, and so on. Any length takes the memory of one
piece per level, and pieces of one conversation can be parsed in different tasks.
"""

from __future__ import annotations

import numpy as np

E, S, UU, UA, AU, AA, SU, SA = range(8)
SHAPES = 8
INSERT, DELETE, REROLE, UNFINISHED = 5, 2, 1, 5
PIECE = 16
LETTERS = "DIKR"  # in ASCII order: a packed audit compares like its string
NONE = 1 << 28    # cost of a cell without derivation

_FIRST = {UU: "u", UA: "u", AU: "a", AA: "a"}
_LAST = {UU: "u", UA: "a", AU: "u", AA: "a", SU: "u", SA: "a"}
_RUN = {("u", "u"): UU, ("u", "a"): UA, ("a", "u"): AU, ("a", "a"): AA}
_SYSTEM = {"u": SU, "a": SA}


def _rules() -> list[tuple[int, int, int]]:
    """(shape, left shape, right shape) of every binary rule."""
    out = [(E, E, E)]
    for x in range(1, SHAPES):
        out += [(x, E, x), (x, x, E)]
    for y, first in _FIRST.items():
        if first == "u":
            out.append((_SYSTEM[_LAST[y]], S, y))
        for x, last in _LAST.items():
            if last != first:
                out.append((_RUN[_FIRST[x], _LAST[y]] if x in _FIRST else _SYSTEM[_LAST[y]], x, y))
    return out


def _closure() -> list[tuple[int, int, bool]]:
    """(longer shape, shape, inserted on the left) of every unit step."""
    flip = {"u": "a", "a": "u"}
    out = [(UU, E, False), (AA, E, False), (SU, S, False)]  # beside a deleted row "DI" is less than "ID"
    for x, first in _FIRST.items():
        out += [(_RUN[flip[first], _LAST[x]], x, True), (_RUN[first, flip[_LAST[x]]], x, False)]
    return out + [(_SYSTEM[flip[_LAST[x]]], x, False) for x in (SU, SA)]


RULES, CLOSURE = _rules(), _closure()
START = (E, UA, SA)


# ------------------------------------------------------------------ pieces of rows (arrays)
# An audit is packed into 64 bits, two a letter from the top. A cell over m rows costs at most
# 2m + 15, so it holds at most m + (2m + 15) / 5 letters: 25 for PIECE rows.

class Cells:
    """cost, packed audit and audit length, each (pieces, spans of one length, SHAPES)."""

    def __init__(self, pieces: int, spans: int):
        self.cost = np.full((pieces, spans, SHAPES), NONE, np.int32)
        self.audit = np.zeros((pieces, spans, SHAPES), np.uint64)
        self.size = np.zeros((pieces, spans, SHAPES), np.uint8)

    def offer(self, shape: int, cost, audit, size) -> bool:
        """Take the candidate where it is less; says whether any was."""
        own, text = self.cost[..., shape], self.audit[..., shape]
        less = (cost < own) | ((cost == own) & (cost < NONE) & (audit < text))
        if not less.any():
            return False
        self.cost[..., shape][less] = np.broadcast_to(cost, less.shape)[less]
        self.audit[..., shape][less] = np.broadcast_to(audit, less.shape)[less]
        self.size[..., shape][less] = np.broadcast_to(size, less.shape)[less]
        return True

    def close(self) -> None:
        while any([self.offer(longer, np.minimum(self.cost[..., x] + INSERT, NONE), *self._inserted(x, left))
                   for longer, x, left in CLOSURE]):
            pass

    def _inserted(self, x: int, left: bool):
        a, n = self.audit[..., x], self.size[..., x]
        i = np.uint64(LETTERS.index("I"))
        if left:
            return (a >> np.uint64(2)) | (i << np.uint64(62)), n + 1
        return a | (i << (np.uint64(62) - np.uint64(2) * n.astype(np.uint64))), n + 1


def leaves(initial: np.ndarray, deleted: np.ndarray, unfinished: np.ndarray) -> Cells:
    """Cells of single rows: (pieces, rows) arrays of role initials (one character), rows that must go, and
    rows whose text is cut off."""
    out = Cells(*initial.shape)
    letter = {c: np.uint64(i) << np.uint64(62) for i, c in enumerate(LETTERS)}
    out.offer(E, np.full(initial.shape, DELETE, np.int32), letter["D"], 1)
    fine = np.where(unfinished, UNFINISHED, 0).astype(np.int32)
    for shape, role in ((S, "s"), (UU, "u"), (AA, "a")):
        out.offer(shape, np.where(~deleted & (initial == role), fine, NONE).astype(np.int32), letter["K"], 1)
    for shape in (UU, AA):
        out.offer(shape, np.where(deleted, NONE, fine + REROLE).astype(np.int32), letter["R"], 1)
    out.close()
    return out


def parse_rows(initial: np.ndarray, deleted: np.ndarray, unfinished: np.ndarray) -> Cells:
    """Cells of whole pieces (spans axis of length 1): CYK by span length over all pieces at once."""
    rows = initial.shape[1]
    by = {1: leaves(initial, deleted, unfinished)}
    for length in range(2, rows + 1):
        spans = rows - length + 1
        here = by[length] = Cells(len(initial), spans)
        for k in range(1, length):
            left, right = by[k], by[length - k]
            for shape, x, y in RULES:
                lc, rc = left.cost[:, :spans, x], right.cost[:, k:k + spans, y]
                ls = left.size[:, :spans, x]
                here.offer(shape, np.minimum(lc + rc, NONE),
                           left.audit[:, :spans, x] | (right.audit[:, k:k + spans, y] >> (np.uint64(2) * ls.astype(np.uint64))),
                           ls + right.size[:, k:k + spans, y])
        here.close()
    return by[rows]


def unpacked(audit: int, size: int) -> str:
    return "".join(LETTERS[(audit >> (62 - 2 * i)) & 3] for i in range(size))


# ------------------------------------------------------------------ pieces of pieces (strings)

Cell = list  # SHAPES entries: (cost, audit) or None


def _close(cell: Cell) -> None:
    moved = True
    while moved:
        moved = False
        for longer, x, left in CLOSURE:
            if cell[x] is not None:
                cost = cell[x][0] + INSERT
                if cell[longer] is None or cost <= cell[longer][0]:
                    new = (cost, "I" + cell[x][1] if left else cell[x][1] + "I")
                    if cell[longer] is None or new < cell[longer]:
                        cell[longer], moved = new, True


def parse_cells(cells: list[Cell]) -> Cell:
    """The cell of neighbouring spans: CYK by span length, their closed cells as letters."""
    n = len(cells)
    table = {(i, 1): c for i, c in enumerate(cells)}
    for length in range(2, n + 1):
        for i in range(n - length + 1):
            here: Cell = [None] * SHAPES
            for k in range(1, length):
                left, right = table[i, k], table[i + k, length - k]
                for shape, x, y in RULES:
                    a, b = left[x], right[y]
                    if a is None or b is None:
                        continue
                    cost, own = a[0] + b[0], here[shape]
                    if own is None or cost < own[0] or (cost == own[0] and a[1] + b[1] < own[1]):
                        here[shape] = (cost, a[1] + b[1])
            _close(here)
            table[i, length] = here
    return table[0, n]


def parse_all(cells: list[Cell]) -> Cell | None:
    """The cell of any number of neighbouring spans, PIECE at a time, level by level."""
    while len(cells) > 1:
        cells = [parse_cells(cells[i:i + PIECE]) for i in range(0, len(cells), PIECE)]
    return cells[0] if cells else None


def cheapest(cell: Cell | None) -> tuple[int, str]:
    """(cost, audit) of the start shapes; no rows: (0, "")."""
    return min((cell[x] for x in START if cell[x] is not None), default=(0, "")) if cell else (0, "")
