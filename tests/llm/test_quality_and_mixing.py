"""Quality rules and the mix against plain Python."""

import random
from collections import Counter, defaultdict
from hashlib import md5

import pytest

from spokeline.llm import mixing, quality

from .conftest import as_dicts, words


def measured(text):
    text = text or ""
    w = words(text)
    windows = [tuple(w[i : i + 8]) for i in range(len(w) - 7)]
    often = Counter(windows)
    covered = {j for i, x in enumerate(windows) if often[x] > 1 for j in range(i, i + 8)}
    lines = [x for x in text.split("\n") if words(x)]
    return {
        "n_words": len(w),
        "word_chars": sum(map(len, w)),
        "n_symbols": sum(c in "#*$%&|<>" for c in text),
        "n_dup_lines": len(lines) - len(set(lines)),
        "n_repeat_words": len(covered),
    }


LONG = " ".join(f"w{i}" for i in range(40))
TEXTS = [
    None, "", "   \n\t", LONG, LONG + " " + LONG, "a " * 8, "a " * 9, "a " * 30, "x y\nx y\n\nx y \n \n",
    "# * $ <b>|</b> " + LONG, "ä ö 😀 " + LONG, "\n".join(["one two three four five six seven eight"] * 3),
    LONG + " z " + " ".join(f"w{i}" for i in range(10)), "a b " * 2000,
]


def test_measures(docs_of):
    found = {r["doc_id"]: r for r in as_dicts(quality.quality(docs_of(list(enumerate(TEXTS)))))}
    for i, text in enumerate(TEXTS):
        expected = measured(text)
        assert {k: found[i][k] for k in expected} == expected
        failed = expected["n_words"] < 20 or 100 * expected["n_repeat_words"] > 30 * expected["n_words"]
        assert found[i]["base_failed"] == failed


def test_bad_host_takes_its_good_documents_and_a_small_one_does_not(docs_of):
    rows = [(i, "short", "bad") for i in range(50)] + [(50, LONG, "bad")]
    rows += [(100 + i, LONG + f" {i}", f"good{i % 9}") for i in range(300)]
    rows += [(900, "short", "tiny"), (901, LONG, "tiny"), (902, LONG, None), (903, "short", None)]
    kept = {r["doc_id"]: r["kept"] for r in as_dicts(quality.quality(docs_of(rows)))}
    assert not kept[50] and not kept[900] and not kept[903]
    assert kept[901] and kept[902] and all(kept[100 + i] for i in range(300))


def test_quality_of_nothing_and_of_repeated_rows(docs_of):
    assert quality.quality(docs_of([])).collect() == []
    assert quality.passing(docs_of([])).collect() == []
    twice = quality.quality(docs_of([(1, LONG), (1, LONG), (None, LONG)]))
    assert [r["kept"] for r in as_dicts(twice)] == [True] * 3
    assert quality.passing(docs_of([(1, LONG), (1, LONG), (None, LONG), (2, "x")])).count() == 3


def fair_mix(rows):
    size = lambda t: len(words(t))
    by = defaultdict(list)
    for doc_id, text, source in rows:
        by[source].append((md5(f"mix:{doc_id}".encode()).hexdigest(), doc_id, size(text)))
    names = sorted((n for n in by if n is not None)) + [None] * (None in by)
    weight = {n: (5, 2, 1)[i % 3] for i, n in enumerate(names)}
    sizes = {n: sum(x[2] for x in by[n]) for n in names}
    total, stopped = sum(sizes.values()), set()
    while True:
        left = total - sum(3 * sizes[n] for n in stopped)
        open_ = sum(weight[n] for n in names if n not in stopped)
        target = {n: 3.0 * sizes[n] if n in stopped else left * weight[n] / open_ for n in names}
        above = {n for n in names if target[n] > 3 * sizes[n]}
        if not above:
            break
        stopped |= above
    turns = []
    for n in names:
        upto = 0
        for _, doc_id, s in sorted(by[n]):
            upto += s
            turns += [((k * sizes[n] + upto) / target[n], n is None, n or "", doc_id, k, s) for k in range(3) if s]
    taken, used = Counter(), 0
    for _, _, _, doc_id, _, s in sorted(turns):
        used += s
        if used > total:
            break
        taken[doc_id] += s
    return target, sizes, taken


@pytest.mark.parametrize("seed", range(4))
def test_mix_is_the_fair_queue(docs_of, seed):
    rng = random.Random(seed)
    rows = [
        (i, " ".join("w" * rng.randrange(1, 60)), rng.choice(["hot", "hot", "hot", "a", "b", "ü", None, "rare"[: seed + 1]]))
        for i in range(500)
    ]
    rows += [(600, None, "a"), (601, "", "empty"), (602, None, "empty")]
    target, sizes, taken = fair_mix(rows)
    found = as_dicts(mixing.mix(docs_of(rows)))
    assert len(found) == len(rows)
    for r in found:
        assert r["source_size"] == sizes[r["source"]]
        assert r["target"] == pytest.approx(target[r["source"]])
        assert r["taken"] == taken[r["doc_id"]]
    by = Counter()
    for r in found:
        by[r["source"]] += r["taken"]
    longest = max(r["size"] for r in found)
    assert all(abs(by[n] - target[n]) <= 2 * longest for n in sizes)


def test_mix_of_nothing_of_empty_texts_and_of_repeated_rows(docs_of):
    assert mixing.mix(docs_of([])).collect() == []
    assert [r["taken"] for r in as_dicts(mixing.mix(docs_of([(1, None), (2, " ")])))] == [0, 0]
    same = as_dicts(mixing.mix(docs_of([(1, "a b"), (1, "a b"), (None, "c")])))
    assert all(r["taken"] <= 3 * r["size"] for r in same)


def test_mixed_repeats_documents(docs_of):
    rows = [(i, "a b c", "poor") for i in range(4)] + [(10 + i, "d e f", "rich") for i in range(40)]
    out = mixing.mixed(docs_of(rows))
    times = Counter(r["doc_id"] for r in out.collect())
    taken = {r["doc_id"]: r["taken"] // 3 for r in as_dicts(mixing.mix(docs_of(rows)))}
    assert times == Counter({k: v for k, v in taken.items() if v})
    assert out.columns == docs_of([]).columns


def test_passing_judges_rows_by_their_own_texts(docs_of):
    rows = [(None, LONG), (None, "x"), (5, LONG + " more"), (5, "bad"), (6, LONG, None), (6, LONG, "t"), (7, None)]
    df = docs_of(rows)
    for name in ("name", "of", "doc", "kept", "salt"):
        df = df.withColumn(name, mixing.F.lit(1))
    out = quality.passing(df)
    assert out.columns == df.columns
    found = Counter((r["doc_id"], r["text"], r["source"]) for r in out.collect())
    assert found == Counter([(None, LONG, "s"), (5, LONG + " more", "s"), (6, LONG, None), (6, LONG, "t")])


def test_mixed_delivers_what_the_mix_takes(docs_of):
    """Rows without doc_id, and some that repeat one, keep to the budget."""
    rng = random.Random(6)
    text = lambda n: " ".join(f"w{rng.randrange(500)}" for _ in range(n))
    rows = [(None, text(rng.randrange(5, 30)), rng.choice(["rich", "poor", None])) for _ in range(62)]
    rows += [(1, text(20), "rich"), (1, text(9), "rich"), (1, text(9), "poor"), (2, "", "rich"), (3, None, "poor")]
    rows += [rows[0]] * 3
    df = docs_of(rows)
    for name in ("name", "times", "nth", "own", "rows", "doc", "order__"):
        df = df.withColumn(name, mixing.F.lit(1))
    out = mixing.mixed(df)
    assert out.columns == df.columns
    found = Counter((r["doc_id"], r["text"], r["source"]) for r in out.collect())
    assert set(found) <= set(rows)
    times = Counter(rows)
    assert all(n <= 3 * times[r] for r, n in found.items())
    total = sum(len(words(t)) for _, t, _ in rows)
    largest = max(len(words(t)) for _, t, _ in rows)
    assert total - largest < sum(n * len(words(t)) for (_, t, _), n in found.items()) <= total
    by_source = Counter()
    for (_, t, source), n in found.items():
        by_source[source] += n * len(words(t))
    sizes = mixing.targets(df.groupBy("source").agg(mixing.F.sum(mixing.word_count()).alias("source_size")))
    for r in sizes.collect():
        assert abs(by_source[r["source"]] - r["target"]) <= 3 * largest
    assert Counter((r["doc_id"], r["text"], r["source"]) for r in mixing.mixed(df).collect()) == found
