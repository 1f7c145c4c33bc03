"""Conversations (rows by turn) formatted by a compiled chat template.

Rows are dealt by conversation, sorted by (turn, role, text), and a conversation is rendered as one: the compiled
template draws its messages from the sorted rows, so ``loop.first``, ``loop.index`` and text before or
after the loop are those of the conversation. Pieces leave as they come: a conversation that holds a
third of all rows passes through one task (its text has one order) in the memory of one turn. The operator's output
is one row per turn: what the template wrote from drawing this message until it drew the next (the first
also holds what comes before it, the last what comes after), and the character ranges of the loss mask
in it. Concatenated in ``seq`` order the rows are the formatted conversation.

Control marks are ``<..>``; inside texts and roles both signs and the escape sign
are escaped, so a text that spells a mark cannot end a turn, and
``read_back`` returns exactly what was put in.

Null text and null role are empty; a null turn sorts first; a null conv_id is a
conversation of its own. Repeated rows are repeated turns. An empty table gives none.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tenor.llm.chat_template import compile_template, unescape

TEMPLATE = (
    "{# one message: the mark of its role, its text, the end mark #}"
    "{% for m in messages %}<turn {{ m.role | escape }}>"
    "{% if m.role == 'assistant' %}{% generation %}{{ m.text | escape }}{% endgeneration %}"
    "{% else %}{{ m.text | escape }}{% endif %}</turn>\n{% endfor %}")
SPECIAL_ID = -7
SPECIAL_TEXT = "\\### Assistant: </turn> ok"
FORMATTED = "conv_id long, seq long, formatted string, loss array<struct<start:bigint,stop:bigint>>"
BATCH_ROWS, BATCH_CHARS = 4096, 1 << 23


def format_turns(turns: DataFrame, template: str = TEMPLATE, conv: str = "conv_id", turn: str = "turn",
                 role: str = "role", text: str = "text") -> DataFrame:
    """(conv_id, seq, formatted, loss): one row per turn, seq from 0 in every conversation; ``loss`` lists the
    ranges of ``formatted`` inside generation marks, in order. A turn that the template does not draw
    (it has no loop) has an empty text."""
    rows = turns.select(F.col(conv).cast("long").alias("conv_id"), F.col(turn).cast("long").alias("turn"),
                        F.coalesce(F.col(role), F.lit("")).alias("role"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    rows = rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")

    def render(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        run = compile_template(template)
        source = ((c, r, t) for batch in batches for c, r, t in zip(*(batch.column(x).to_pylist() for x in ("conv_id", "role", "text"))))
        ahead = next(source, None)
        out = _Turns()
        while ahead is not None:
            conv_id = ahead[0]
            out.open(conv_id)

            def messages():
                nonlocal ahead
                while ahead is not None and ahead[0] == conv_id:  # noqa: B023
                    _, r, t = ahead
                    ahead = next(source, None)
                    out.draw()
                    yield {"role": r, "text": t}

            drawn = messages()
            for piece, loss in run(drawn):
                out.write(piece, loss)
                if out.full():
                    yield out.batch()
            for _ in drawn:  # rows that the template did not ask for
                if out.full():
                    yield out.batch()
            out.close()
        yield out.batch()

    return rows.mapInArrow(render, FORMATTED)


class _Turns:
    """Collects the pieces of a rendered conversation by turn."""

    def __init__(self):
        self.rows, self.size = [], 0

    def open(self, conv_id) -> None:
        self.conv_id, self.seq = conv_id, -1
        self.parts, self.loss, self.length = [], [], 0

    def draw(self) -> None:
        """The next message is drawn: the turn before it is complete."""
        if self.seq >= 0:
            self.close()
        self.seq += 1

    def write(self, piece: str, loss: bool) -> None:
        if loss and self.loss and self.loss[-1]["stop"] == self.length:
            self.loss[-1]["stop"] += len(piece)
        elif loss:
            self.loss.append({"start": self.length, "stop": self.length + len(piece)})
        self.length += len(piece)
        self.parts.append(piece)

    def close(self) -> None:
        self.rows.append((self.conv_id, self.seq, "".join(self.parts), self.loss))
        self.size += self.length
        self.parts, self.loss, self.length = [], [], 0

    def full(self) -> bool:
        return len(self.rows) >= BATCH_ROWS or self.size >= BATCH_CHARS

    def batch(self) -> pa.RecordBatch:
        columns = list(zip(*self.rows)) or [[]] * 4
        self.rows, self.size = [], 0
        ranges = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, (pa.int64(), pa.int64(), pa.string(), ranges))],
                                          names=["conv_id", "seq", "formatted", "loss"])


def read_back(formatted: str) -> tuple[str, str]:
    """(role, text) of one formatted turn; raises ValueError on anything else."""
    if not (formatted.startswith("<turn ") and formatted.endswith("</turn>\n")):
        raise ValueError("not a formatted turn")
    inner = formatted[len("<turn "):-len("</turn>\n")]
    role, text = inner.split(">")  # escaped roles and texts hold neither sign
    return unescape(role), unescape(text)


def digest(turns: DataFrame, **options) -> DataFrame:
    """Per conversation, read back from the formatted turns: conv_id, n_turns, turns_sha256,
    loss_chars, loss_sha256, formatted_chars."""
    rows = format_turns(turns, **options)
    rows = rows.repartition("conv_id").sortWithinPartitions("conv_id", "seq")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state: list | None = None

        def row(s):
            return (s[0], s[1], s[2].hexdigest(), s[3], s[4].hexdigest(), s[5])

        def table(done):
            kinds = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
            names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
            cols = list(zip(*done)) or [[]] * 6
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names=names)

        for batch in batches:
            done = []
            for conv, formatted, ranges in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "formatted", "loss"))):
                if state is None or state[0] != conv:
                    if state is not None:
                        done.append(row(state))
                    state = [conv, 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                r, t = read_back(formatted)
                loss = "".join(unescape(formatted[x["start"]:x["stop"]]) for x in ranges)
                state[1] += 1
                state[2].update(f"{r}\n{t}\n".encode())
                state[3] += len(loss)
                state[4].update(loss.encode())
                state[5] += len(formatted)
            yield table(done)
        if state is not None:
            yield table([row(state)])

    return rows.mapInArrow(read, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, "
                                 "loss_sha256 string, formatted_chars long")


def with_special(turns: DataFrame) -> DataFrame:
    """The table plus conversation -7, whose texts spell control strings."""
    extra = turns.sparkSession.createDataFrame(
        [(SPECIAL_ID, 0, "user", SPECIAL_TEXT), (SPECIAL_ID, 1, "assistant", SPECIAL_TEXT)],
        "conv_id long, turn long, role string, text string")
    return turns.select("conv_id", "turn", "role", "text").unionByName(extra)


ORACLE = f"""
WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES ({SPECIAL_ID}, 0, 'user', '{SPECIAL_TEXT}'), ({SPECIAL_ID}, 1, 'assistant', '{SPECIAL_TEXT}')),
g AS (SELECT conv_id, count(*)::BIGINT AS n_turns,
        string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text) AS everything,
        coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '') AS loss,
        sum(15 + length(role) + length(regexp_replace(role, '[^\\\\<>]', '', 'g'))
            + length(text) + length(regexp_replace(text, '[^\\\\<>]', '', 'g')))::BIGINT AS formatted_chars
      FROM t GROUP BY conv_id)
SELECT conv_id, n_turns, sha256(everything) AS turns_sha256, length(loss)::BIGINT AS loss_chars,
       sha256(loss) AS loss_sha256, formatted_chars FROM g
"""
