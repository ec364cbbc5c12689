"""Chat formatting and repair against plain Python."""

import heapq
import random
import re
import zlib

import pyarrow as pa
import pytest
from hypothesis import given
from hypothesis import settings as hypothesis_settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from spokeline.llm import chat_format, chat_repair, queries
from tests.llm.conftest import as_dicts, sha256

SF = "/root/testdata/sf0.001"
# With columns named like those the operators make.
SCHEMA = "conv_id long, turn long, role string, text string, piece string, absent string, fault string, audit string"


@pytest.fixture(scope="session")
def chats(spark):
    def build(rows):
        return spark.createDataFrame([(*r, "p", "a", "f", "x") for r in rows], SCHEMA)

    return build


def _by_conv(rows):
    found = {}
    for conv, turn, role, text in rows:
        found.setdefault(conv, []).append((turn, role, text))
    for turns in found.values():
        turns.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
    return found


# -- formatting --------------------------------------------------------------------

CONTROLS = r"\### Assistant: </turn> ok"
CHATS = [
    (1, 0, "system", "Be brief."), (1, 1, "user", CONTROLS), (1, 2, "assistant", "####</turn></turn>\\\\.\\"),
    (2, 5, "user", None), (2, 3, None, "no role"), (2, 4, "odd: role\n###", "x"), (2, None, "assistant", "first"),
    (3, 1, "user", "a"), (3, 1, "user", "a"), (3, 1, "assistant", "b"), (None, 1, "user", ""), (None, 2, "assistant", ""),
    (4, 0, "user", "é" * 70_000), (4, 1, "assistant", "𝒳" * 70_000),
]


def _digests(rows):
    found = {}
    for conv, turns in _by_conv([(c, t, r or "", x or "") for c, t, r, x in rows]).items():
        learnt = "".join(x for _, r, x in turns if r == "assistant")
        said = "".join(f"{r}\n{x}\n" for _, r, x in turns)
        roles = "".join({"system": "s", "user": "u", "assistant": "a"}.get(r, "?") for _, r, _ in turns)
        found[conv] = (len(turns), sha256(said), len(learnt), sha256(learnt), bool(re.fullmatch("s?(ua)+", roles)))
    return found


NAMES = ("n_turns", "turns_sha256", "loss_chars", "loss_sha256", "well_ordered")


def test_what_is_formatted_reads_back(chats):
    formatted = chat_format.format_chats(chats(CHATS))
    rows = as_dicts(chat_format.read_digests(formatted))
    assert {r["conv_id"]: tuple(r[n] for n in NAMES) for r in rows} == _digests(CHATS)
    again = as_dicts(chat_format.read_digests(formatted.orderBy("formatted"), in_order=False))
    assert sorted(again, key=str) == sorted(rows, key=str)
    turns = [(r.conv_id, r.role, r.text, r.learnt) for r in chat_format.read_turns(formatted).collect()]
    plain = [(c, r or "", x or "", (x or "") if r == "assistant" else None) for c, _, r, x in CHATS]
    assert sorted(turns, key=str) == sorted(plain, key=str)


def test_controls_stand_between_turns_only(chats):
    for row in chat_format.format_chats(chats(CHATS)).collect():
        assert row.formatted.count("</turn>") == row.n_turns == row.formatted.count("###")


@given(st.text(alphabet="\\.#</turn>nc\n:é", max_size=30), st.text(alphabet="a#</turn>\\:\n.nc", max_size=12))
@hypothesis_settings(max_examples=400, deadline=None)
def test_escapes_are_undone(text, role):
    template = chat_format.CHAT
    escaped = template.escape(text)
    assert "###" not in escaped and "</turn>" not in escaped
    assert chat_format.unescape(escaped) == text
    formatted = "".join(s for s, _ in template.segments(role, text))
    assert list(template.turns(formatted * 2)) == [(role, text)] * 2


def test_long_conversations_come_in_pieces(monkeypatch):
    monkeypatch.setattr(chat_format, "PIECE", 60)
    rows = [(1, ("user", "assistant")[i % 2], f"say {i}") for i in range(50)] + [(2, "assistant", "?")]
    batches = [
        pa.RecordBatch.from_pydict(dict(zip(("conv_id", "role", "text"), map(list, zip(*rows[i : i + 7])))))
        for i in range(0, len(rows), 7)
    ]
    found = [piece.row(last=last) for piece, last in chat_format.pieces_of(iter(batches), chat_format.CHAT)]
    assert [r[1] for r in found if r[0] == 1] == list(range(len(found) - 1)) and len(found) > 10
    assert [r[2] for r in found][-2:] == [True, True] and not any(r[2] for r in found[:-2])
    assert found[-2][-1] and not found[-1][-1]  # well ordered, and not
    whole = "".join(r[4] for r in found if r[0] == 1)
    assert list(chat_format.CHAT.turns(whole)) == [(r, t) for c, r, t in rows if c == 1]


def test_pieces_out_of_order_are_refused(spark, chats):
    formatted = chat_format.format_chats(chats(CHATS)).where("conv_id = 1").withColumn("piece", F.lit(1).cast("long"))
    with pytest.raises(Exception, match="not in order"):
        chat_format.read_digests(formatted).collect()


def test_no_conversations(chats):
    assert chat_format.read_digests(chat_format.format_chats(chats([]))).count() == 0
    assert chat_repair.repairs(chats([])).count() == 0


def _table(spark):
    rows = spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text")
    return [tuple(r) for r in rows.collect()]


def test_op12_over_its_table(spark):
    rows = _table(spark) + [(-7, 0, "user", CONTROLS), (-7, 1, "assistant", CONTROLS)]
    found = {r["conv_id"]: tuple(r[n] for n in NAMES) for r in as_dicts(queries.op12_chat_format(spark, SF))}
    assert found == _digests(rows)


# -- repair --------------------------------------------------------------------------

SPACES = " \t\n\x0b\x0c\r"


def _damage(rows):
    out, ids = [], []
    for conv, turn, role, text in rows:
        ids.append(conv)
        role, text = " " if role is None else role, " " if text is None else text
        name = ":".join(" " if v is None else str(v) for v in (conv, turn))
        kind = zlib.crc32(name.encode()) % 20
        if kind == 1:
            text = ""
        if kind == 2:
            text = re.sub("[.!?]", "", text)
        if kind == 4:
            role = "user"
        out += [(conv, turn, role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    return out, ids


def _repair(turns):
    """Cheapest and then least, by a search that goes on from the cheapest unfinished audit."""
    seen, faults = set(), []
    for _, role, text in turns:
        shown = text.strip(SPACES)
        faults.append(
            "blank" if not shown else "duplicate" if (role, text) in seen else "" if shown[-1] in ".!?" else "truncated"
        )
        seen.add((role, text))
    heap, done = [(0, "", 0, "", ())], set()
    while True:
        cost, audit, i, state, left = heapq.heappop(heap)
        if i == len(turns) and state in ("", "a"):
            break
        if (i, state) in done:
            continue
        done.add((i, state))
        wanted = "assistant" if state == "u" else "user"
        heapq.heappush(heap, (cost + 5, audit + "I", i, wanted[0], (*left, f"{wanted}:")))
        if i < len(turns):
            _, role, text = turns[i]
            heapq.heappush(heap, (cost + 2, audit + "D", i + 1, state, left))
            if faults[i] in ("", "truncated"):
                more = cost + 5 * (faults[i] == "truncated")
                if role[:1] == wanted[0] or (role[:1] == "s" and state == ""):
                    heapq.heappush(heap, (more, audit + "K", i + 1, role[0], (*left, f"{role}:{text}")))
                heapq.heappush(heap, (more + 1, audit + "R", i + 1, wanted[0], (*left, f"{wanted}:{text}")))
    known = [t for t, _, _ in turns if t is not None]
    initials = [r[:1] for _, r, _ in turns]
    return {
        "gaps": max(known) - min(known) + 1 - len(set(known)) if known else 0,
        "blank": faults.count("blank"),
        "duplicate": faults.count("duplicate"),
        "truncated": faults.count("truncated"),
        "illegal": sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])),
        "cost": cost,
        "audit": audit,
        "repaired_sha256": sha256("\n".join(left)),
    }, left


def _repairs(rows, ids):
    turns = _by_conv(rows)
    return {c: _repair(turns.get(c, [])) for c in set(ids)}


def _odd_rows(n, seed=1):
    rng = random.Random(seed)
    roles = ["system", "user", "assistant", "tool", "", None, "sage"]
    texts = ["Yes.", "No!", "Why?", "and then", "", None, " \t", "Yes. \n", "a.\u00a0", "é"]
    rows = []
    for conv in range(n):
        for _ in range(rng.randrange(9)):
            turn = rng.choice([None, rng.randrange(8)])
            rows.append((conv if conv else None, turn, rng.choice(roles), rng.choice(texts)))
    return rows


def test_repairs_are_the_cheapest_and_least(chats):
    rows = _odd_rows(400)
    plain = [(c, t, " " if r is None else r, " " if x is None else x) for c, t, r, x in rows]
    expected = _repairs(plain, [r[0] for r in rows])
    found = as_dicts(chat_repair.repairs(chats(rows)))
    assert {r.pop("conv_id"): r for r in found} == {c: report for c, (report, _) in expected.items()}
    turns = {}
    for r in sorted(chat_repair.repaired_turns(chats(rows)).collect(), key=lambda r: r.position):
        turns.setdefault(r.conv_id, []).append(f"{r.role}:{r.text}")
    assert turns == {c: list(left) for c, (_, left) in expected.items() if left}


def test_damage_and_conversations_without_rows(spark, chats):
    rows = _odd_rows(150, seed=2) + [(c, 0, "user", "Alone.") for c in range(1000, 1100)]
    after, ids = _damage(rows)
    expected = _repairs(after, ids)
    assert set(ids) - {r[0] for r in after}  # some have lost all rows
    found = as_dicts(chat_repair.repairs(chat_repair.damaged(chats(rows)), absent="absent"))
    assert {r.pop("conv_id"): r for r in found} == {c: report for c, (report, _) in expected.items()}


def test_op13_over_its_table(spark):
    expected = _repairs(*_damage(_table(spark)))
    found = as_dicts(queries.op13_chat_repair(spark, SF))
    assert {r.pop("conv_id"): r for r in found} == {c: report for c, (report, _) in expected.items()}


@pytest.mark.parametrize("piece", [2, 3, 7])
def test_long_conversations_are_repaired_in_pieces(spark, chats, monkeypatch, piece):
    rows = [(c, t, r, x) for c, t, r, x in _odd_rows(60, seed=3)]
    rows += [(500, t, r, x) for _, t, r, x in _odd_rows(40, seed=4)]
    sorted_ = chat_repair._sorted_rows(chats(rows), None).toArrow()
    whole = pa.Table.from_batches(sorted_.to_batches())
    order = pa.compute.sort_indices(whole, [("conv_id", "ascending"), ("turn", "ascending"), ("role", "ascending"), ("text", "ascending"), ("fault", "ascending")], null_placement="at_start")
    whole = whole.take(order).combine_chunks()

    def run():
        return {
            name: line
            for names, lines in chat_repair.reports(iter(whole.to_batches(max_chunksize=5)))
            for name, line in zip(names.to_pylist(), lines)
        }

    plain = run()
    monkeypatch.setattr(chat_repair, "PIECE", piece)
    assert run() == plain
    filled = [(c, t, " " if r is None else r, " " if x is None else x) for c, t, r, x in rows]
    expected = _repairs(filled, [r[0] for r in rows])
    assert {c: line for c, line in plain.items()} == {c: tuple(report.values()) for c, (report, _) in expected.items()}


def test_an_audit_that_is_a_prefix_ranks_first():
    assert chat_repair.LETTERS == bytes(sorted(chat_repair.LETTERS))
