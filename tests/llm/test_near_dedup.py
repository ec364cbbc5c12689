"""Near duplicates against comparing all pairs."""

import random
from collections import defaultdict

import numpy as np
import pytest

from spokeline.llm import components, near_dedup

from .conftest import as_dicts, words

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingle_set(text, k):
    w = words((text or "").translate(LOWER))
    return {tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))} if w else set()


def brute(rows, k):
    sets = [(i, shingle_set(t, k)) for i, t in rows if i is not None]
    parent = {i: i for i, _ in sets}

    def top(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, (i, s) in enumerate(sets):
        for j, t in sets[:a]:
            if s and t and 100 * len(s & t) >= 80 * len(s | t):
                x, y = sorted((top(i), top(j)))
                parent[y] = x
    return sorted((i, len(s), top(i), top(i) == i) for i, s in sets)


def found(df):
    return sorted(tuple(r.values()) for r in as_dicts(df))


@pytest.mark.parametrize("k", [4, 5])
def test_near_duplicates(docs_of, k, monkeypatch):
    monkeypatch.setattr(near_dedup, "BLOCK", 16)
    rng = random.Random(k)
    vocabulary = [f"w{i}" for i in range(3000)]
    base = [[rng.choice(vocabulary) for _ in range(rng.choice([60, 120, 200]))] for _ in range(12)]
    rows = [(1000, None), (1001, ""), (1002, " \n"), (1003, "two words"), (1004, "TWO  words"), (1005, "two words more")]
    for i in range(180):
        w = list(base[0] if i % 3 == 0 else rng.choice(base))
        for _ in range(rng.choice([0, 0, 1, 2, 3, 4, 6, 9])):
            w[rng.randrange(len(w))] = rng.choice(vocabulary)
        rows.append((i, " ".join(w)))
    rows.append((5000, " ".join(rng.choice(vocabulary) for _ in range(20000))))
    rng.shuffle(rows)
    assert found(near_dedup.near_duplicates(docs_of(rows), k)) == brute(rows, k)


def test_repeated_rows_null_ids_and_nothing(docs_of):
    assert near_dedup.near_duplicates(docs_of([])).collect() == []
    rows = [(1, "a b c d e f"), (1, "a b c d e f"), (None, "a b c d e f"), (2, "A b c d e f"), (3, None)]
    df = near_dedup.near_duplicates(docs_of(rows))
    assert sorted((r["doc_id"] or 0, r["component_id"] or 0, r["kept"]) for r in as_dicts(df)) == [
        (0, 0, False), (1, 1, True), (1, 1, True), (2, 1, False), (3, 3, True),
    ]
    assert sorted(r["doc_id"] for r in near_dedup.representatives(docs_of(rows)).collect()) == [1, 1, 3]


def test_sketches_merge_and_estimate():
    rng = np.random.default_rng(1)
    a, b = (rng.integers(0, 2**64, 5000, dtype=np.uint64) for _ in range(2))
    whole = near_dedup.sketch(np.concatenate([a, b]))
    assert (whole == np.maximum(near_dedup.sketch(a), near_dedup.sketch(b))).all()
    for shared, expected in ((2000, True), (0, False)):
        x, y = near_dedup.sketch(a[:2000]), near_dedup.sketch(np.concatenate([a[:shared], b[shared:2000]]))
        size = np.array(2000.0)
        assert near_dedup.likely((x > y).sum(), (x < y).sum(), size, size, 0.5) == expected


def test_components(spark):
    rng = random.Random(9)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + [(400 + i, 401 + i) for i in range(90)]
    links += [(600, 600 + i) for i in range(1, 300)]
    near = defaultdict(set)
    for a, b in links:
        near[a].add(b)
        near[b].add(a)
    expected = {}
    for start in sorted(near):
        stack = [start] if start not in expected else []
        while stack:
            n = stack.pop()
            if n not in expected:
                expected[n] = start
                stack += near[n]
    alone = {a for a, b in links if a == b and near[a] == {a}}
    got = dict(tuple(r) for r in components.components(spark.createDataFrame(links, "a long, b long")).collect())
    assert got == {n: c for n, c in expected.items() if n not in alone}


def test_blocks_are_cut_by_bytes_too(spark, monkeypatch):
    monkeypatch.setattr(near_dedup, "BLOCK", 4)
    monkeypatch.setattr(near_dedup, "BLOCK_BYTES", 8000)
    rows = [(i // 10 * 10, i, i, int(i % 10 > 0)) for i in range(40)]
    members = spark.createDataFrame(rows, "group long, doc_id long, component long, side int")
    sizes = spark.createDataFrame([(i, 1 if i < 20 else 900) for i in range(50)], "doc_id long, n_shingles long")
    tasks = near_dedup._tasks(members, sizes).collect()
    for group, blocks in ((0, 3), (20, 9)):  # nine documents on side 1, by number and by bytes
        met = {r["other"] for r in ({"other": r["two"]} for r in tasks if r["group"] == group and r["doc_id"] == group)}
        assert met == set(range(blocks + 1))
        crowd = [r for r in tasks if r["group"] == group and r["doc_id"] != group]
        assert len(crowd) == 9 and {r["one"] for r in crowd} == {0}


def near_copies(n, seed=3):
    """Texts of 400 words, each with a word or two of its own, and some unlike all others."""
    rng = random.Random(seed)
    base = [f"w{rng.randrange(5000)}" for _ in range(400)]
    rows = []
    for i in range(n):
        w = list(base)
        for _ in range(2):
            w[rng.randrange(400)] = f"own{i}"
        rows.append((i, " ".join(w)))
    return rows + [(n + i, " ".join(f"x{i}y{j}" for j in range(60))) for i in range(5)]


def test_copied_sets_grow_with_the_group(docs_of, monkeypatch):
    monkeypatch.setattr(near_dedup, "BLOCK", 16)
    sent, run = [], near_dedup._run

    def counted(rows, *more):
        sent.append(rows.count())
        return run(rows, *more)

    monkeypatch.setattr(near_dedup, "_run", counted)
    totals = []
    for n in (250, 500, 1000):
        sent.clear()
        result = near_dedup.near_duplicates(docs_of(near_copies(n)), 5).collect()
        assert {r["component_id"] for r in result if r["doc_id"] < n} == {0}
        totals.append(sum(sent))
    # In proportion to the group, where blocks of all with all would take n / 16 copies of every set.
    assert totals[1] < 2.3 * totals[0] and totals[2] < 2.3 * totals[1] and totals[2] < 4 * 1000


def test_links_within_values_of_several_components(docs_of, monkeypatch):
    """Chains whose ends are not linked, several to a value, and hubs that link with few."""
    monkeypatch.setattr(near_dedup, "BLOCK", 8)
    rng = random.Random(11)
    base = [f"w{rng.randrange(4000)}" for _ in range(160)]
    rows, w = [], list(base)
    for i in range(120):
        if i % 30 == 0:  # a family that shares half of its words with the others
            w = base[:80] + [f"f{i}w{j}" for j in range(80)]
        for _ in range(3):
            w[rng.randrange(160)] = f"c{i}w{rng.randrange(50)}"
        rows.append((i, " ".join(w)))
    rng.shuffle(rows)
    rows = [(i, t) for i, (_, t) in enumerate(rows)]
    assert found(near_dedup.near_duplicates(docs_of(rows), 4)) == brute(rows, 4)


def test_representatives_decide_by_document(spark, docs_of):
    """Null and repeated doc_ids, the largest one, and columns named like the operator's own."""
    texts = [" ".join(f"t{k}w{j}" for j in range(40)) for k in range(5)]
    big = 2**63 - 1
    rows = [(big, texts[0]), (None, texts[0] + " more"), (None, texts[1]), (5, texts[2]), (5, texts[3]), (6, texts[3] + " x")]
    df = docs_of(rows)
    for name in ("key__", "id__", "digest__", "number", "kept", "salt", "digest"):
        df = df.withColumn(name, near_dedup.F.lit(7))
    out = near_dedup.representatives(df)
    assert out.columns == df.columns
    assert sorted((r["doc_id"] or 0, r["text"]) for r in out.collect()) == sorted(
        [(big, texts[0]), (0, texts[1]), (5, texts[2]), (5, texts[3])]
    )


def test_long_near_copies_in_several_blocks(docs_of, monkeypatch):
    monkeypatch.setattr(near_dedup, "BLOCK_BYTES", 4000)
    rng = random.Random(4)
    base = [f"w{rng.randrange(3000)}" for _ in range(300)]
    rows = []
    for i in range(30):
        w = list(base)
        for _ in range(rng.randrange(8)):
            w[rng.randrange(len(w))] = "other"
        rows.append((i, " ".join(w)))
    assert found(near_dedup.near_duplicates(docs_of(rows), 5)) == brute(rows, 5)
