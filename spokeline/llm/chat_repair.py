"""Conversation structure repair: the cheapest edits that give every conversation legal turns.

A legal conversation is empty, or an optional system turn and then a user and an assistant in
turns, the assistant last. Rows are kept, given another role or deleted, and empty turns are
inserted, each at a cost. What is cheapest is found in three steps, over all conversations of
an Arrow batch at once:

1. **Cost.** Nodes are (rows used, state of the grammar). Their cheapest completions are
   computed backwards, a row of every conversation at a time.
2. **Ranks.** Arcs that keep the cost least are the optimal ones. Every node is ranked by the
   first letter of its least optimal audit, then by its first 2, 4, 8, ... letters: the rank
   of 2n letters is that of the pair (rank of n letters, rank of the node n letters on), and
   the pointer to that node doubles with it. An audit that ended ranks below any longer one.
3. **Paths.** A node's arc is the one with the least letter and, after it, the least ranked
   node. The t-th node of an audit is reached by the doubled pointers of the bits of t.

A letter leaves a node by one arc at most (a row that is given another role gets the one the
state asks for), so equal prefixes of audits lead to the same node, which makes the pointers
of step 2 well defined.

Rows are dealt by conversation, sorted by turn and read as a stream. A conversation of more
than ``PIECE`` rows or ``PIECE_BYTES`` is taken in pieces: per state, the least audit up to the
end of a piece and the digest of its repaired turns are carried on, as whatever follows
depends on the state alone. So memory is bounded by a piece and the audit itself.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spokeline.llm.chat_format import by_conversation
from spokeline.llm.shared_files import ship
from spokeline.llm.tables import SPACES

PIECE = 50_000
PIECE_BYTES = 64 << 20

# States: nothing yet, after the system, after a user, after an assistant.
START, SYSTEM, USER, ASSISTANT = range(4)
FINALS = (START, ASSISTANT)
# The turn that a state asks for, and the state it leads to.
WANTED = ("user", "user", "assistant", "user")
TO = np.array([USER, USER, ASSISTANT, USER])
# Letters of edits in the order of their characters; 0 ends an audit.
LETTERS = b"\0DIKR"
DELETE, INSERT, KEEP, REROLE = range(1, 5)
DELETE_COST, INSERT_COST, REROLE_COST, TRUNCATED_COST = 2, 5, 1, 5
FAR = 1 << 50

NO_FAULT, BLANK, DUPLICATE, TRUNCATED = range(4)
# Initials of adjacent rows that may follow each other.
LEGAL = {("s", "u"), ("u", "a"), ("a", "u")}
_INITIALS = {"s": 0, "u": 1, "a": 2}


def faults() -> Column:
    """First fault of a row: no visible character, seen before, or no end of a sentence."""
    shown = F.rtrim(F.col("text"), F.lit(SPACES))
    return (
        F.when(shown == "", BLANK)
        .when(F.col("again"), DUPLICATE)
        .when(~F.right(shown, F.lit(1)).isin(".", "!", "?"), TRUNCATED)
        .otherwise(NO_FAULT)
        .cast("byte")
    )


def _sorted_rows(conversations: DataFrame, absent: str | None) -> DataFrame:
    """Rows with their faults, by conversation and turn. Both sorts are over one deal of the rows."""
    rows = conversations.select(
        "conv_id",
        F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", F.lit(" ")).alias("role"),
        F.coalesce("text", F.lit(" ")).alias("text"),
        (F.col(absent) if absent else F.lit(False)).alias("absent"),
    )
    same = Window.partitionBy("conv_id", "absent", "role", "text").orderBy(F.asc_nulls_first("turn"))
    marked = by_conversation(rows).withColumn("again", F.row_number().over(same) > 1).withColumn("fault", faults())
    return marked.drop("again").sortWithinPartitions("conv_id", "turn", "role", "text", "fault")


@dataclass
class _Pieces:
    """Rows of several conversations, one after the other: row ``bounds[c]`` up to ``bounds[c + 1]`` are c's."""

    bounds: np.ndarray
    initial: np.ndarray  # 0, 1, 2 for s, u, a and 3 for others
    delete: np.ndarray  # rows that must go
    extra: np.ndarray  # cost of not deleting a row

    @property
    def first(self) -> np.ndarray:
        """Node of each conversation's start in state 0. A conversation has a place more than rows."""
        return (self.bounds[:-1] + np.arange(len(self.bounds) - 1)) * 4


def least_costs(pieces: _Pieces, final: np.ndarray) -> np.ndarray:
    """Cost of the cheapest completion of every node; ``final`` has those of the states at the end."""
    lengths = np.diff(pieces.bounds)
    costs = np.full((pieces.bounds[-1] + len(lengths), 4), FAR, np.int64)
    end = pieces.first // 4 + lengths
    longest_first = np.argsort(-lengths, kind="stable")
    ordered = -lengths[longest_first]
    for back in range(int(lengths.max(initial=0)) + 1):
        now = longest_first[: np.searchsorted(ordered, -back, side="right")]
        if back == 0:
            cost = np.tile(final, (len(now), 1))
        else:
            row = pieces.bounds[now + 1] - back
            after = costs[end[now] - back + 1]
            cost = after + DELETE_COST
            stay = np.where(pieces.delete[row], FAR, pieces.extra[row])[:, None]
            same = np.where(np.array(TO) == USER, 1, 2) == pieces.initial[row][:, None]
            cost = np.minimum(cost, after[:, TO] + stay + np.where(same, 0, REROLE_COST))
            system = np.where(pieces.initial[row] == 0, after[:, SYSTEM] + stay[:, 0], FAR)
            cost[:, START] = np.minimum(cost[:, START], system)
        # Inserted turns: at most two are of use, as more would come back to a state for a cost.
        for _ in range(2):
            cost = np.minimum(cost, cost[:, TO] + INSERT_COST)
        costs[end[now] - back] = np.minimum(cost, FAR)
    return costs


def optimal_arcs(pieces: _Pieces, costs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per letter and node: where its arc leads, or -1 where it isn't optimal."""
    places = len(costs)
    lengths = np.diff(pieces.bounds)
    conv = np.repeat(np.arange(len(lengths)), lengths + 1)
    row = np.arange(places) - conv
    more = row < pieces.bounds[conv + 1]
    row = np.minimum(row, max(0, pieces.bounds[-1] - 1))
    if pieces.bounds[-1]:
        initial, delete, extra = pieces.initial[row], pieces.delete[row], pieces.extra[row]
    else:
        initial, delete, extra = (np.zeros(places, np.int64) for _ in range(3))
    node = np.arange(places * 4).reshape(places, 4)
    here, next_ = node - np.arange(4), node - np.arange(4) + 4
    stays = (more & ~delete.astype(bool))[:, None]
    wants = np.where(np.array(TO) == USER, 1, 2)
    keeps = initial[:, None] == wants
    system = (initial[:, None] == 0) & (np.arange(4) == START)
    arcs = {
        DELETE: (next_ + np.arange(4), DELETE_COST, more[:, None]),
        INSERT: (here + TO, INSERT_COST, np.ones((places, 1), bool)),
        KEEP: (next_ + np.where(system, SYSTEM, TO), extra[:, None], stays & (keeps | system)),
        REROLE: (next_ + TO, extra[:, None] + REROLE_COST, stays),
    }
    flat = np.append(costs.ravel(), np.full(4, FAR))  # the last places have no next one
    leads = np.full((len(LETTERS), places * 4), -1, np.int64)
    for letter, (to, cost, allowed) in arcs.items():
        best = allowed & (costs < FAR) & (flat[to] + cost == costs)
        leads[letter] = np.where(best, to, -1).ravel()
    return leads


def ranked(leads: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """Letter of every node's arc, and pointers over 1, 2, 4, ... letters.

    Nodes without an optimal arc are ends, and lead to themselves without a letter.
    """
    nodes = np.arange(leads.shape[1])
    letter = np.where((leads >= 0).any(0), (leads >= 0).argmax(0), 0)
    to = np.where(letter > 0, leads[letter, nodes], nodes)
    rank, pointers = letter.astype(np.int64), [to]
    while (letter[pointers[-1]] > 0).any():
        jump = pointers[-1]
        rank = np.unique(rank * (len(nodes) + len(LETTERS)) + rank[jump], return_inverse=True)[1]
        pointers.append(jump[jump])
    # Whole audits are ranked now: of the optimal arcs, the least letter and then the least rest.
    after = np.where(leads >= 0, rank[leads], 0)
    keys = np.where(leads >= 0, np.arange(len(leads))[:, None] * (len(nodes) + 1) + after, FAR)
    chosen = np.where((leads >= 0).any(0), keys.argmin(0), 0)
    if not np.array_equal(chosen, letter):
        raise AssertionError("a letter leaves a node by more than one arc")
    return chosen, pointers


def audits(pointers: list[np.ndarray], letter: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nodes of the audits that begin at ``entries``, one audit after the other, and their bounds."""
    distance = (letter > 0).astype(np.int64)
    for jump in pointers[:-1]:
        distance = distance + distance[jump]
    lengths = distance[entries]
    bounds = np.concatenate([[0], np.cumsum(lengths)])
    step = np.arange(bounds[-1]) - np.repeat(bounds[:-1], lengths)
    node = np.repeat(entries, lengths)
    for bit, jump in enumerate(pointers):
        hop = (step >> bit) & 1 == 1
        node[hop] = jump[node[hop]]
    return node, bounds


@dataclass
class _Rows:
    """Rows of a batch, without those that only name their conversation."""

    table: pa.Table
    conv: np.ndarray  # conversation of each row
    bounds: np.ndarray
    names: pa.Array  # conv_id of each conversation

    @classmethod
    def of(cls, table: pa.Table) -> _Rows:
        ids = table.column("conv_id").combine_chunks()
        begins = np.flatnonzero(np.concatenate([[True], _changes(ids)])) if len(ids) else np.empty(0, np.int64)
        conv = np.zeros(len(ids), np.int64)
        conv[begins[1:]] = 1
        conv = np.cumsum(conv)
        there = ~table.column("absent").to_numpy(zero_copy_only=False).astype(bool)
        counts = np.bincount(conv[there], minlength=len(begins))
        bounds = np.concatenate([[0], np.cumsum(counts)])
        return cls(table.filter(pa.array(there)), conv[there], bounds, ids.take(pa.array(begins)))


def _changes(values: pa.Array) -> np.ndarray:
    """Whether each value but the first differs from the one before it; nulls are equal."""
    a, b = values[1:], values[:-1]
    differ = pc.fill_null(pc.not_equal(a, b), False)
    return pc.or_(differ, pc.xor(pc.is_null(a), pc.is_null(b))).to_numpy(zero_copy_only=False)


@dataclass
class _Counts:
    """What is counted of a conversation, over its pieces."""

    least: int | None = None
    most: int | None = None
    distinct: int = 0
    faults: np.ndarray = field(default_factory=lambda: np.zeros(4, np.int64))
    illegal: int = 0
    initial: str | None = None  # of the last row

    def add(self, turns: list, faults_: np.ndarray, initials: list[str]) -> None:
        known = [t for t in turns if t is not None]
        if known:  # turns ascend
            again = self.most is not None and self.most == known[0]
            self.distinct += len(set(known)) - again
            self.least = known[0] if self.least is None else self.least
            self.most = known[-1]
        self.faults += np.bincount(faults_, minlength=4)
        before = ([self.initial] if self.initial is not None else []) + initials
        self.illegal += sum(pair not in LEGAL for pair in zip(before, before[1:]))
        if initials:
            self.initial = initials[-1]

    def gaps(self) -> int:
        return 0 if self.least is None else self.most - self.least + 1 - self.distinct


@dataclass
class _Path:
    """The least audit that ends in a state, and the digest of the turns it leaves."""

    cost: int
    audit: bytes = b""
    digest: object = field(default_factory=hashlib.sha256)
    begun: bool = False

    def on(self, cost: int, audit: bytes, turns: list[str]) -> _Path:
        digest = self.digest.copy()
        if turns:
            digest.update((("\n" if self.begun else "") + "\n".join(turns)).encode())
        return _Path(self.cost + cost, self.audit + audit, digest, self.begun or bool(turns))


def _solved(pieces: _Pieces, final: np.ndarray, states: np.ndarray):
    """Least audits from the given state of every conversation: costs, nodes, letters and bounds."""
    costs = least_costs(pieces, final)
    letter, pointers = ranked(optimal_arcs(pieces, costs))
    entries = pieces.first + states
    nodes, bounds = audits(pointers, letter, entries)
    return costs.ravel()[entries], nodes, letter[nodes], bounds


WHOLE = np.where(np.isin(np.arange(4), FINALS), 0, FAR)


def _pieces_of(rows: _Rows) -> tuple[_Pieces, list[str]]:
    initials = [r[:1] for r in rows.table.column("role").to_pylist()]
    fault = rows.table.column("fault").to_numpy().astype(np.int64)
    pieces = _Pieces(
        rows.bounds,
        np.array([_INITIALS.get(i, 3) for i in initials], np.int64),
        np.isin(fault, (BLANK, DUPLICATE)),
        np.where(fault == TRUNCATED, TRUNCATED_COST, 0),
    )
    return pieces, initials


def _edits(rows: _Rows, nodes: np.ndarray, letters: np.ndarray, bounds: np.ndarray):
    """(letter, role, text) of every step, by conversation; a deleted row has what it held."""
    conv = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    row = np.minimum(nodes // 4 - conv, max(0, len(rows.conv) - 1))
    roles, texts = rows.table.column("role").to_pylist(), rows.table.column("text").to_pylist()
    found = []
    for letter, state, r in zip(letters.tolist(), (nodes % 4).tolist(), row.tolist()):
        if letter == INSERT:
            found.append((letter, WANTED[state], ""))
        elif letter == REROLE:
            found.append((letter, WANTED[state], texts[r]))
        else:
            found.append((letter, roles[r], texts[r]))
    return [found[a:b] for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist())]


def _left(edits: list[tuple]) -> list[str]:
    return [f"{role}:{text}" for letter, role, text in edits if letter != DELETE]


def _audit(edits: list[tuple]) -> bytes:
    return bytes(LETTERS[letter] for letter, _, _ in edits)


class _Long:
    """A conversation in several pieces: counts so far, and a path to every state that can be reached."""

    def __init__(self) -> None:
        self.counts, self.paths = _Counts(), {START: _Path(0)}

    def add(self, rows: _Rows, finals: tuple[int, ...] = tuple(range(4))) -> None:
        pieces, initials = _pieces_of(rows)
        _count(self.counts, rows, initials, 0)
        paths = {}
        for end in finals:
            final = np.where(np.arange(4) == end, 0, FAR)
            for state, path in self.paths.items():
                cost, nodes, letters, bounds = _solved(pieces, final, np.array([state]))
                if cost[0] >= FAR:
                    continue
                edits = _edits(rows, nodes, letters, bounds)[0]
                found = (path.cost + int(cost[0]), path.audit + _audit(edits))
                if end not in paths or found < paths[end][:2]:
                    paths[end] = (*found, path, int(cost[0]), edits)
        self.paths = {
            end: path.on(cost, _audit(edits), _left(edits)) for end, (_, _, path, cost, edits) in paths.items()
        }


def _count(counts: _Counts, rows: _Rows, initials: list[str], c: int) -> None:
    a, b = rows.bounds[c], rows.bounds[c + 1]
    turns = rows.table.column("turn").slice(a, b - a).to_pylist()
    faults_ = rows.table.column("fault").slice(a, b - a).to_numpy().astype(np.int64)
    counts.add(turns, faults_, initials[a:b])


REPORT = (
    "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
)


def repairs(conversations: DataFrame, *, absent: str | None = None) -> DataFrame:
    """One row per conversation: what is wrong with it, and the cheapest repair.

    ``conversations`` has conv_id, turn, role and text; other columns are left out, whatever
    their names. A null role or text is one space. Turns go by number, nulls first, then by role
    and text. A null conv_id is a conversation like any other. ``absent`` names a column whose
    true rows only name their conversation; one without other rows has zeros, an empty audit and
    the digest of nothing. An empty table gives no rows. Texts may be of any length.

    Columns: conv_id, gaps (turn numbers missing between the least and the largest), blank,
    duplicate and truncated (rows by their first fault), illegal (adjacent rows whose roles may
    not follow each other), cost, audit (D, I, K and R for delete, insert, keep and give
    another role, in order; the least of the cheapest) and repaired_sha256 (of ``role:text``
    of the repaired turns, joined by newlines).
    """
    ship(conversations.sparkSession)
    schema = T.StructType([_conv_id(conversations), *T.StructType.fromDDL(REPORT)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow = to_arrow_schema(schema)
        for names, found in reports(batches):
            columns = [names, *(pa.array(c, f.type) for c, f in zip(zip(*found), list(arrow)[1:]))]
            yield pa.RecordBatch.from_arrays(columns, schema=arrow)

    return _sorted_rows(conversations, absent).mapInArrow(run, schema)


TURNS = "position long, edit string, role string, text string"


def repaired_turns(conversations: DataFrame, *, absent: str | None = None) -> DataFrame:
    """The turns of the repaired conversations: conv_id, position (from 0), edit, role, text.

    Rows and edits are those of ``repairs``, whose audit meets the conversation's rows here,
    ahead of them, and tells what becomes of each: no more than an audit and a row are held.
    """
    there = conversations.where(~F.coalesce(F.col(absent), F.lit(False))) if absent else conversations
    rows = there.select(
        "conv_id",
        F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", F.lit(" ")).alias("role"),
        F.coalesce("text", F.lit(" ")).alias("text"),
        F.lit(False).alias("is_audit"),
    )
    told = repairs(conversations, absent=absent).select(
        "conv_id", F.lit(None).cast("long"), F.lit(""), F.col("audit"), F.lit(True)
    )
    schema = T.StructType([_conv_id(conversations), *T.StructType.fromDDL(TURNS)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow = to_arrow_schema(schema)
        audit, conv, position, state = iter(""), None, 0, START
        for batch in batches:
            left = []
            columns = (batch.column(n).to_pylist() for n in ("conv_id", "role", "text", "is_audit"))
            for name, role, text, is_audit in zip(*columns):
                if is_audit:
                    left += _inserted(audit, conv, position, state)
                    audit, conv, position, state = iter(text), name, 0, START
                    continue
                for edit in audit:
                    if edit == "D":
                        break
                    as_ = role if edit == "K" else WANTED[state]
                    left.append((conv, position, edit, as_, "" if edit == "I" else text))
                    position, state = position + 1, SYSTEM if as_[:1] == "s" else int(TO[state])
                    if edit != "I":
                        break
            if left:
                yield _batch(left, arrow)
        left = _inserted(audit, conv, position, state)
        if left:
            yield _batch(left, arrow)

    dealt = by_conversation(rows.union(told))
    order = ("conv_id", F.desc("is_audit"), "turn", "role", "text")
    return dealt.sortWithinPartitions(*order).mapInArrow(run, schema)


def _inserted(audit: Iterator[str], conv, position: int, state: int) -> list[tuple]:
    """What an audit inserts after the last row."""
    left = []
    for edit in audit:
        left.append((conv, position, edit, WANTED[state], ""))
        position, state = position + 1, int(TO[state])
    return left


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


def _conv_id(conversations: DataFrame) -> T.StructField:
    return T.StructField("conv_id", conversations.schema["conv_id"].dataType)


def reports(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Array, list[tuple]]]:
    """conv_ids and reports of sorted rows, many conversations at a time."""
    for rows, long in _whole(batches):
        yield rows.names, _report(rows) if long is None else [_line(long.counts, *_finished(long))]


def _whole(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[_Rows, _Long | None]]:
    """Whole conversations, many at a time, or the last piece of a long one with what was before it."""
    held, long = None, None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        held = table if held is None else pa.concat_tables([held, table])
        ids = held.column("conv_id").combine_chunks()
        changes = np.flatnonzero(_changes(ids))
        if long is not None and len(changes):  # the long one ends here
            yield _ended(long, held.slice(0, changes[0] + 1))
            held, long = held.slice(changes[0] + 1), None
            changes = changes[1:] - changes[0] - 1
        if len(changes):
            yield _Rows.of(held.slice(0, changes[-1] + 1)), None
            held = held.slice(changes[-1] + 1)
        if len(held) > PIECE or held.nbytes > PIECE_BYTES:
            # The last row stays, so that the end of the conversation finds one.
            long = long or _Long()
            long.add(_Rows.of(held.slice(0, len(held) - 1)))
            held = held.slice(len(held) - 1)
    if held is not None and len(held):
        yield _ended(long, held) if long is not None else (_Rows.of(held), None)


def _ended(long: _Long, table: pa.Table) -> tuple[_Rows, _Long]:
    rows = _Rows.of(table)
    long.add(rows, FINALS)
    return rows, long


def _finished(long: _Long) -> tuple[int, bytes, str]:
    path = min(long.paths.values(), key=lambda p: (p.cost, p.audit))
    return path.cost, path.audit, path.digest.hexdigest()


def _line(counts: _Counts, cost: int, audit: bytes, digest: str) -> tuple:
    _, blank, duplicate, truncated = counts.faults.tolist()
    return counts.gaps(), blank, duplicate, truncated, counts.illegal, cost, audit.decode(), digest


def _report(rows: _Rows) -> list[tuple]:
    pieces, initials = _pieces_of(rows)
    cost, nodes, letters, bounds = _solved(pieces, WHOLE, np.zeros(len(rows.names), np.int64))
    found = []
    for c, edits in enumerate(_edits(rows, nodes, letters, bounds)):
        counts = _Counts()
        _count(counts, rows, initials, c)
        digest = hashlib.sha256("\n".join(_left(edits)).encode()).hexdigest()
        found.append(_line(counts, int(cost[c]), _audit(edits), digest))
    return found


def damaged(conversations: DataFrame) -> DataFrame:
    """Conversations with faults put into rows by ``crc32(conv_id:turn) % 20``, nulls as one space.

    0 drops a row, 1 empties its text, 2 takes its sentence ends, 3 repeats it, 4 makes it the
    user's. A dropped row stays as one that is ``absent`` and names its conversation only.
    """
    name = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")])
    rows = conversations.select(
        "conv_id",
        "turn",
        F.coalesce("role", F.lit(" ")).alias("role"),
        F.coalesce("text", F.lit(" ")).alias("text"),
        (F.crc32(name) % 20).alias("kind"),
    )
    kind = F.col("kind")
    text = (
        F.when(kind.isin(0, 1), "").when(kind == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    )
    return rows.select(
        "conv_id",
        "turn",
        F.when(kind == 4, "user").otherwise(F.col("role")).alias("role"),
        text.alias("text"),
        (kind == 0).alias("absent"),
        F.explode(F.when(kind == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"),
    ).drop("copy")
