"""Chat formatting: a declared template and a machine over roles turn conversations into training text.

A conversation's turns, in order, drive a finite-state machine. Each arc emits three
segments: the role's opening (no loss), the escaped text (loss if the template says so for that
role) and the closing (no loss). A role the machine has no arc for breaks the order: the
machine stays broken, the conversation is formatted all the same and is marked as not well
ordered.

Texts hold no control string once they are escaped: a backslash becomes two, and ``\\.`` is put
after the first character of every control string, overlapping ones too. So the formatted text
is split at control strings alone, and escaping is undone from left to right.

Rows are dealt by conversation, sorted by turn and read as a stream, so that a conversation of
any length takes bounded memory: its formatted text comes in pieces of whole turns, numbered
from 0. Nothing else is split: the turns of one conversation are read by one task, because its
digests, and its state, follow the order of turns.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spokeline.llm.shared_files import ship
from spokeline.llm.tables import parts_for, text_bytes, text_of

BROKEN = "broken"
# Formatted characters after which a conversation goes on in another piece.
PIECE = 1 << 20
# Characters of output that go to the JVM at once.
FLUSH = 4 << 20
# Bytes of text a task sorts and reads.
SHARE = 64 << 20


@dataclass(frozen=True)
class Template:
    """How turns are marked, what is learnt, and which role may follow which.

    ``openings`` by role; a role without one gets ``other``, which holds its escaped name.
    ``arcs`` lead from a state and a role to a state; ``finals`` are the states a
    conversation may end in.
    """

    openings: dict[str, str]
    other: str
    closing: str
    controls: tuple[str, ...]
    learnt: frozenset[str]
    start: str
    arcs: dict[tuple[str, str], str]
    finals: frozenset[str]

    def after(self, state: str, role: str) -> str:
        return self.arcs.get((state, role), BROKEN)

    def escape(self, text: str) -> str:
        text = text.replace("\\", "\\\\")
        if any(c in text for c in self.controls):
            starts = "|".join(f"{re.escape(c[0])}(?={re.escape(c[1:])})" for c in self.controls)
            text = re.sub(starts, lambda m: m[0] + "\\.", text)
        return text

    def opening(self, role: str) -> str:
        found = self.openings.get(role)
        if found is not None:
            return found
        # The name ends at the colon and the line, so neither may stand in it.
        return self.other.format(self.escape(role).replace("\n", "\\n").replace(":", "\\c"))

    def segments(self, role: str, text: str) -> list[tuple[str, bool]]:
        """What an arc emits: texts, each with its loss flag."""
        return [(self.opening(role), False), (self.escape(text), role in self.learnt), (self.closing, False)]

    def turns(self, formatted: str) -> Iterator[tuple[str, str]]:
        """Role and text of every turn in a formatted text."""
        before, after = self.other.split("{}")
        parts = formatted.split(self.closing)
        if parts.pop():
            raise ValueError("a formatted text doesn't end with the closing of a turn")
        for part in parts:
            for role, opening in self.openings.items():
                if part.startswith(opening):
                    yield role, unescape(part[len(opening) :])
                    break
            else:
                name, found, text = part.removeprefix(before).partition(after)
                if not part.startswith(before) or not found:
                    raise ValueError("a turn has no opening")
                yield unescape(name), unescape(text)


_UNESCAPED = {"\\": "\\", ".": "", "n": "\n", "c": ":"}


def unescape(text: str) -> str:
    if "\\" not in text:
        return text
    return re.sub(r"\\(.)", lambda m: _UNESCAPED[m[1]], text)


# An optional system turn, then the user and the assistant in turns; the assistant's texts are learnt.
CHAT = Template(
    openings={"system": "### System:\n", "user": "### User:\n", "assistant": "### Assistant:\n"},
    other="### Role {}:\n",
    closing="</turn>\n",
    controls=("###", "</turn>"),
    learnt=frozenset({"assistant"}),
    start="start",
    arcs={
        ("start", "system"): "system",
        ("start", "user"): "user",
        ("system", "user"): "user",
        ("user", "assistant"): "assistant",
        ("assistant", "user"): "user",
    },
    finals=frozenset({"assistant"}),
)


def by_conversation(rows: DataFrame) -> DataFrame:
    """Rows dealt by conversation. A null conv_id is a conversation like any other."""
    return rows.repartition(parts_for(rows.sparkSession, text_bytes(rows), SHARE), "conv_id")


def format_chats(conversations: DataFrame, template: Template = CHAT) -> DataFrame:
    """The formatted text of every conversation, in pieces.

    ``conversations`` has conv_id, turn, role and text; other columns are left out, whatever
    their names. Turns go by number, nulls first, then by role and text, so that equal numbers
    have one order too; repeated rows are turns of their own. A null role or text is an empty
    one. An empty table gives no rows. A text may be of any length up to the 1 GB that is left of
    a Spark string when every character is escaped.

    Columns: conv_id, piece (from 0), last, n_turns (of the piece), formatted,
    loss_from and loss_to (code points of the piece's learnt spans, [from, to), one per learnt
    turn, empty ones too), well_ordered (no broken arc so far and, in the last piece, in a final
    state). The pieces of a conversation come one after the other.
    """
    ship(conversations.sparkSession)
    rows = conversations.select(
        "conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), text_of().alias("text")
    )
    schema = T.StructType(
        [
            T.StructField("conv_id", rows.schema["conv_id"].dataType),
            T.StructField("piece", T.LongType()),
            T.StructField("last", T.BooleanType()),
            T.StructField("n_turns", T.LongType()),
            T.StructField("formatted", T.StringType()),
            T.StructField("loss_from", T.ArrayType(T.LongType())),
            T.StructField("loss_to", T.ArrayType(T.LongType())),
            T.StructField("well_ordered", T.BooleanType()),
        ]
    )

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = _Rows(schema)
        for piece, last in pieces_of(batches, template):
            yield from out.add(piece.row(last=last), piece.chars)
        yield from out.rest()

    in_order = by_conversation(rows).sortWithinPartitions("conv_id", "turn", "role", "text")
    return in_order.mapInArrow(write, schema)


def pieces_of(batches: Iterator[pa.RecordBatch], template: Template) -> Iterator[tuple[_Piece, bool]]:
    """Pieces of sorted rows, each with whether it is its conversation's last."""
    piece = None
    for batch in batches:
        for conv, role, text in zip(*(batch.column(n).to_pylist() for n in ("conv_id", "role", "text"))):
            if piece is None or conv != piece.conv:
                if piece is not None:
                    yield piece, True
                piece = _Piece(conv, template)
            elif piece.chars >= PIECE:
                yield piece, False
                piece = _Piece(conv, template, piece)
            piece.add(role, text)
    if piece is not None:
        yield piece, True


class _Piece:
    """A run of turns of one conversation on its way to a row."""

    def __init__(self, conv, template: Template, before: _Piece | None = None) -> None:
        self.conv, self.template = conv, template
        self.number = before.number + 1 if before else 0
        self.state = before.state if before else template.start
        self.texts, self.chars, self.turns, self.spans = [], 0, 0, []

    def add(self, role: str, text: str) -> None:
        self.state = self.template.after(self.state, role)
        self.turns += 1
        for segment, loss in self.template.segments(role, text):
            if loss:
                self.spans.append((self.chars, self.chars + len(segment)))
            self.texts.append(segment)
            self.chars += len(segment)

    def row(self, *, last: bool) -> tuple:
        ordered = self.state in self.template.finals if last else self.state != BROKEN
        starts, ends = [a for a, _ in self.spans], [b for _, b in self.spans]
        return self.conv, self.number, last, self.turns, "".join(self.texts), starts, ends, ordered


class _Rows:
    """Rows gathered into Arrow batches of bounded size."""

    def __init__(self, schema: T.StructType) -> None:
        from pyspark.sql.pandas.types import to_arrow_schema

        self.schema, self.rows, self.size = to_arrow_schema(schema), [], 0

    def add(self, row: tuple, size: int) -> Iterator[pa.RecordBatch]:
        self.rows.append(row)
        self.size += size + 100
        if self.size >= FLUSH:
            yield from self.rest()

    def rest(self) -> Iterator[pa.RecordBatch]:
        if self.rows:
            columns = [pa.array(c, f.type) for c, f in zip(zip(*self.rows), self.schema)]
            yield pa.RecordBatch.from_arrays(columns, schema=self.schema)
        self.rows, self.size = [], 0


def _in_order(formatted: DataFrame, in_order: bool) -> DataFrame:
    if in_order:
        return formatted
    named = by_conversation(formatted.withColumnRenamed("formatted", "text"))
    return named.withColumnRenamed("text", "formatted").sortWithinPartitions("conv_id", "piece")


def read_turns(formatted: DataFrame, template: Template = CHAT) -> DataFrame:
    """Turns read from formatted text: conv_id, piece, position in the piece, role, text, learnt.

    ``learnt`` is the unescaped text under the turn's loss span, null for turns without.
    """
    ship(formatted.sparkSession)
    schema = T.StructType(
        [
            T.StructField("conv_id", formatted.schema["conv_id"].dataType),
            T.StructField("piece", T.LongType()),
            T.StructField("position", T.LongType()),
            T.StructField("role", T.StringType()),
            T.StructField("text", T.StringType()),
            T.StructField("learnt", T.StringType()),
        ]
    )

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = _Rows(schema)
        for row in _pieces(batches):
            learnt = iter(_learnt(row))
            for at, (role, text) in enumerate(template.turns(row["formatted"])):
                under = next(learnt) if role in template.learnt else None
                yield from out.add((row["conv_id"], row["piece"], at, role, text, under), len(text))
        yield from out.rest()

    return formatted.select("conv_id", "piece", "formatted", "loss_from", "loss_to").mapInArrow(read, schema)


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        yield from batch.to_pylist()


def _learnt(row: dict) -> list[str]:
    """The unescaped texts under the loss mask of a piece."""
    return [unescape(row["formatted"][a:b]) for a, b in zip(row["loss_from"], row["loss_to"])]


def read_digests(formatted: DataFrame, template: Template = CHAT, *, in_order: bool = True) -> DataFrame:
    """What each conversation's formatted text says when it is read back, as counts and digests.

    Takes the rows of ``format_chats``, the pieces of a conversation one after the other;
    others are refused unless ``in_order`` is False, which sorts them first. Columns: conv_id,
    n_turns, turns_sha256 (of role, newline, text and newline of every turn), loss_chars and
    loss_sha256 (of the unescaped text under the loss mask), formatted_chars, well_ordered.
    """
    ship(formatted.sparkSession)
    schema = T.StructType(
        [
            T.StructField("conv_id", formatted.schema["conv_id"].dataType),
            T.StructField("n_turns", T.LongType()),
            T.StructField("turns_sha256", T.StringType()),
            T.StructField("loss_chars", T.LongType()),
            T.StructField("loss_sha256", T.StringType()),
            T.StructField("formatted_chars", T.LongType()),
            T.StructField("well_ordered", T.BooleanType()),
        ]
    )

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = _Rows(schema)
        conv, expected = None, 0
        for row in _pieces(batches):
            if row["piece"] != expected or (expected and row["conv_id"] != conv):
                raise ValueError("pieces of a conversation are not in order; read with in_order=False")
            if not expected:
                conv, turns, chars, learnt_chars = row["conv_id"], 0, 0, 0
                all_turns, all_learnt = hashlib.sha256(), hashlib.sha256()
            for role, text in template.turns(row["formatted"]):
                turns += 1
                all_turns.update(f"{role}\n{text}\n".encode())
            for text in _learnt(row):
                learnt_chars += len(text)
                all_learnt.update(text.encode())
            chars += len(row["formatted"])
            expected = 0 if row["last"] else expected + 1
            if row["last"]:
                digests = all_turns.hexdigest(), learnt_chars, all_learnt.hexdigest()
                yield from out.add((conv, turns, *digests, chars, row["well_ordered"]), 200)
        if expected:
            raise ValueError("the last piece of a conversation is missing; read with in_order=False")
        yield from out.rest()

    return _in_order(formatted.drop("n_turns"), in_order).mapInArrow(read, schema)
