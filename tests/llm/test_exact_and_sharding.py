"""Exact duplicates and shards against plain Python."""

import random
import zlib
from collections import Counter, defaultdict

import pytest

from spokeline.llm import exact_dedup, sharding

from .conftest import as_dicts, sha256

EDGE = [
    (1, None), (2, ""), (3, "Abc"), (4, "aBC"), (5, "abc "), (5, "abc "), (None, "q"), (None, "Q"), (6, "q"),
    (7, "ÄB"), (8, "äb"), (9, "ÄB"), (10, "x" * 70), (11, "x" * 69 + "y"), (12, "x" * 70), (13, "x" * 5000),
    (14, "X" * 5000), (15, "x" * 4999 + "z"),
]


def lowered(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


@pytest.mark.parametrize("depths", [exact_dedup.DEPTHS, (1, 2, 3, 5, 80, None), (None,)])
def test_exact_duplicates(docs_of, depths):
    groups = defaultdict(list)
    for doc_id, text in EDGE:
        groups[lowered(text)].append(doc_id)
    expected = []
    for doc_id, text in EDGE:
        ids = groups[lowered(text)]
        keep = max((i for i in ids if i is not None), default=None)
        expected.append((doc_id, keep, len(ids), doc_id == keep, sha256(lowered(text))))
    found = [tuple(r.values()) for r in as_dicts(exact_dedup.exact_duplicates(docs_of(EDGE), depths))]
    assert Counter(found) == Counter(expected)


def test_exact_duplicates_of_nothing(docs_of):
    assert exact_dedup.exact_duplicates(docs_of([])).collect() == []


def test_without_duplicates_keeps_columns(docs_of):
    kept = exact_dedup.without_duplicates(docs_of(EDGE[:4]))
    assert sorted(r["doc_id"] for r in kept.collect()) == [2, 4]
    assert kept.columns == docs_of([]).columns


def check_shards(rows, found, n):
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in found) == Counter(
        (i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in rows
    )
    sizes, slots = Counter(), defaultdict(list)
    for r in found:
        sizes[r["shard"]] += r["size"]
        slots[r["shard"]].append(r["slot"])
        assert r["law"] == "bytes" and r["grown_shard"] is None and 0 <= r["shard"] < n
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    share, largest = sum(sizes.values()) / n, max(r["size"] for r in found)
    assert all(abs(sizes[k] - share) <= largest for k in range(n))


@pytest.mark.parametrize("ranges", [2, 16, 256])
def test_shards_are_even_with_a_hot_group(docs_of, ranges):
    rng = random.Random(3)
    rows = [(i, "same text" if i % 3 == 0 else "w" * rng.randrange(200)) for i in range(3000)]
    rows += [(5000, None), (None, "n"), (None, "n"), (5001, ""), (5002, "big" * 900)]
    found = as_dicts(sharding.shards(docs_of(rows), 8, ranges))
    check_shards(rows, found, 8)
    assert as_dicts(sharding.shards(docs_of(rows).repartition(3), 8, ranges)) and True


def test_shards_do_not_depend_on_ranges_or_partitions(docs_of):
    rows = [(i, "t" * (i % 50)) for i in range(400)]
    one, other = (
        sorted((r["doc_id"], r["shard"], r["slot"]) for r in sharding.shards(d, 5, k).collect())
        for d, k in ((docs_of(rows), 4), (docs_of(rows).repartition(7), 64))
    )
    assert one == other


def test_equal_texts_stay_together_where_size_allows(docs_of):
    rows = [(i, f"text {i % 300}") for i in range(3000)]
    found = as_dicts(sharding.shards(docs_of(rows), 4))
    shards_of = defaultdict(set)
    for r in found:
        shards_of[r["text_crc32"]].add(r["shard"])
    assert sum(len(s) > 1 for s in shards_of.values()) <= 3


def test_shards_of_nothing_and_of_one(docs_of):
    assert sharding.shards(docs_of([])).collect() == []
    assert as_dicts(sharding.shards(docs_of([(1, "a")])))[0]["slot"] == 0
