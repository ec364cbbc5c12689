"""Removed repeats against looking every window up."""

import random
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pytest

from spokeline.llm import batches, bwt, byte_repeats, text_hashes, word_repeats

from .conftest import as_dicts, sha256, words


def removed(items, width, doc_id, first):
    gone = [False] * len(items)
    for i in range(len(items) - width + 1):
        if first[tuple(items[i : i + width])] < doc_id:
            gone[i : i + width] = [True] * width
    return gone


def firsts(rows, width, split):
    first = {}
    for doc_id, text in rows:
        items = split(text)
        for i in range(len(items) - width + 1):
            key = tuple(items[i : i + width])
            first[key] = min(first.get(key, 2**70), 2**63 if doc_id is None else doc_id)
    return first


def brute_words(rows):
    first, out = firsts(rows, 13, words), []
    for doc_id, text in rows:
        items = words(text)
        gone = removed(items, 13, 2**63 if doc_id is None else doc_id, first)
        out.append((doc_id, len(items), sum(gone), sha256(" ".join(w for w, g in zip(items, gone) if not g))))
    return sorted(out, key=str)


def corpus(rng, n, sep=" "):
    vocabulary = [f"w{i}é" for i in range(400)]
    passages = [[rng.choice(vocabulary) for _ in range(k)] for k in (12, 13, 14, 20, 60)]
    rows = []
    for i in range(n):
        w = [rng.choice(vocabulary) for _ in range(rng.randrange(60))]
        for _ in range(rng.choice([0, 1, 1, 2])):
            at = rng.randrange(len(w) + 1)
            w[at:at] = rng.choice(passages)
        rows.append((i * 7 % 1000, sep.join(w)))
    rows += [(2000 + k, rows[3][1]) for k in range(20)] + [(3000, None), (3001, ""), (None, rows[4][1]), (None, rows[4][1])]
    rows += [(rows[5][0], rows[5][1]), (3002, "a " * 100), (1, "a " * 50), (3003, "word " * 12)]
    return rows


@pytest.mark.parametrize("size", [2500, 8 << 20])
def test_word_repeats(docs_of, monkeypatch, size):
    monkeypatch.setattr(batches, "BATCH_BYTES", size)
    rows = corpus(random.Random(size), 120)
    found = as_dicts(word_repeats.without_repeats(docs_of(rows)))
    assert sorted((tuple(r.values())[:4] for r in found), key=str) == brute_words(rows)
    assert all(sha256(r["kept_text"]) == r["kept_sha256"] for r in found)


def test_word_repeats_of_nothing(docs_of):
    assert word_repeats.without_repeats(docs_of([])).collect() == []


@pytest.mark.parametrize("operator", [word_repeats, byte_repeats])
def test_the_largest_doc_id_is_not_null(docs_of, operator):
    passage = " ".join(f"shared{i}" for i in range(20))
    rows = [(2**63 - 1, passage), (None, passage), (2**63 - 1, "alone"), (None, None), (-(2**63), "first"), (None, "")]
    found = as_dicts(operator.without_repeats(docs_of(rows)))
    # Those two count as one document, so neither loses the passage to the other.
    assert sorted(((r["doc_id"], r["n_removed"]) for r in found), key=str) == sorted(((i, 0) for i, _ in rows), key=str)
    found = as_dicts(operator.without_repeats(docs_of([*rows, (2**63 - 2, passage)])))
    removed = {(r["doc_id"], r["n_removed"] > 0) for r in found}
    assert removed == {(2**63 - 1, True), (None, True), (2**63 - 1, False), (None, False), (2**63 - 2, False), (-(2**63), False)}


def brute_bytes(rows):
    data = [(i, (t or "").encode()) for i, t in rows]
    first, out = firsts(data, 50, lambda b: b), []
    for doc_id, text in data:
        gone = removed(text, 50, 2**63 if doc_id is None else doc_id, first)
        spans = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        kept = bytes(b for b, g in zip(text, gone) if not g)
        out.append((doc_id, len(text), sum(gone), spans, sha256(kept)))
    return sorted(out, key=str)


@pytest.mark.parametrize("size", [2500, 8 << 20])
def test_byte_repeats(docs_of, monkeypatch, size):
    monkeypatch.setattr(batches, "BATCH_BYTES", size)
    monkeypatch.setattr(byte_repeats, "CHUNK", 700)
    rng = random.Random(size)
    rows = corpus(rng, 100) + [(5000 + k, "z" * rng.randrange(45, 130)) for k in range(9)]
    rows += [(6000, "q" * 300), (6, "q" * 49), (7, "x" + "q" * 60), (6001, "ab" * 200), (8, "ba" * 40)]
    found = as_dicts(byte_repeats.without_repeats(docs_of(rows)))
    assert sorted((tuple(r.values())[:5] for r in found), key=str) == brute_bytes(rows)


def test_byte_repeats_of_nothing(docs_of):
    assert byte_repeats.without_repeats(docs_of([])).collect() == []


@pytest.mark.parametrize("seed", range(6))
def test_merged_transforms_are_the_order_of_all_suffixes(seed):
    rng = random.Random(seed)
    shards = [
        [bytes(rng.choice(b"ab\x00\xf4") for _ in range(rng.randrange(1, 30))) for _ in range(rng.randrange(1, 8))]
        for _ in range(rng.choice([1, 2, 5]))
    ]
    transforms = [bwt.transform(*bwt.suffix_order(s)) for s in shards]
    string, left, length = bwt.walk(transforms)
    flat = [s for shard in shards for s in shard]
    assert length.tolist() == [len(s) for s in flat]
    suffix = [flat[k][len(flat[k]) - n :] for k, n in zip(string.tolist(), left.tolist())]
    assert sorted(map(len, suffix)) == sorted(n for s in flat for n in range(len(s) + 1))
    for depth in (1, 3, 50):
        at, block = bwt.merge(transforms, depth)
        cut = [suffix[i][:depth] for i in at.tolist()]
        ended = [len(suffix[i]) < depth for i in at.tolist()]
        assert all(x <= y for x, y in zip(cut, cut[1:]))
        assert sorted(at.tolist()) == list(range(len(suffix)))
        if depth < 50:
            same = [x == y and not e and not f for x, y, e, f in zip(cut, cut[1:], ended, ended[1:])]
            assert same == (np.diff(block) == 0).tolist()


def test_edges_of_a_hot_passage_do_not_meet_in_one_bucket(docs_of, monkeypatch):
    monkeypatch.setattr(batches, "BATCH_BYTES", 20000)
    rng = random.Random(3)

    def text(n):
        return "".join(rng.choice("abcdefghijklmnopqrstuvwxyz     ") for _ in range(n))

    passage, ends = text(200), [text(18) for _ in range(40)]
    rows = [(i, text(60) + passage + text(60)) for i in range(500)]
    rows += [(1000 + i, text(30) + rng.choice(ends) + passage + rng.choice(ends) + text(30)) for i in range(300)]
    rows += [(2000 + i, text(rng.randrange(9)) + "-" * rng.randrange(60, 900)) for i in range(60)]
    dealt, n = batches.dealt(docs_of(rows))
    held, size = {}, {}
    for row in byte_repeats._strings(dealt, n)[1].collect():
        strings = zlib.decompress(row["strings"]).split(byte_repeats.END)
        for name, string in zip(np.frombuffer(row["names"], "<u4").tolist(), strings, strict=True):
            held.setdefault((row["bucket"], name), []).append(string)
    for key, strings in held.items():
        size[key] = sum(map(len, strings))
    stretch = byte_repeats.WINDOW + byte_repeats.SPAN
    assert max(size.values()) <= (batches.CROWD + n) * stretch
    found = as_dicts(byte_repeats.without_repeats(docs_of(rows)))
    assert sorted((tuple(r.values())[:5] for r in found), key=str) == brute_bytes(rows)


def test_merge_sorts_few_suffixes(monkeypatch):
    rng = random.Random(8)
    shards = [[bytes(rng.choice(b"abcd") for _ in range(100)) * 2 for _ in range(20)] for _ in range(5)]
    transforms = [bwt.transform(*bwt.suffix_order(s)) for s in shards]
    sizes, argsort = [], np.argsort
    monkeypatch.setattr(bwt.np, "argsort", lambda a, *args, **more: sizes.append(len(a)) or argsort(a, *args, **more))
    at, _ = bwt.merge(transforms, 50)
    # Once to lay the shards, and once for every two of 50 symbols.
    assert sum(sizes) < 28 * len(at)


def test_shards_grow_with_strings_not_with_batches(monkeypatch):
    rng = random.Random(9)
    gram = bytes(rng.choice(b"abcdefgh") for _ in range(32))
    strings = [b"%020d" % i + gram + b"%020d" % (i % 3) for i in range(200)]
    pack = lambda values, kind: np.array(values, kind).tobytes()
    rows = [
        {
            "bucket": 0, "batch": i, "strings": zlib.compress(s), "names": pack([7], "<u4"),
            "least": zlib.compress(pack([i], "<i8")),
        }
        for i, s in enumerate(strings)
    ]
    made, order = [], bwt.suffix_order
    monkeypatch.setattr(bwt, "suffix_order", lambda some: made.append(len(some)) or order(some))
    answers = byte_repeats._merge(pa.Table.from_pylist(rows))
    assert sum(made) == len(strings) and len(made) < 5
    first, expected = {}, {}
    for i, s in enumerate(strings):
        for k in range(len(s) - 49):
            least = first.setdefault(s[k : k + 50], i)
            if least < i:
                expected.setdefault(i, {})[k] = least
    found = {}
    for row in answers.to_pylist():
        low, high, least = (np.frombuffer(row[c], t).tolist() for c, t in (("low", "<u4"), ("high", "<u4"), ("least", "<i8")))
        for a, b, c in zip(low, high, least):
            found.setdefault(row["batch"], {}).update(dict.fromkeys(range(a, b + 1), c))
    assert found == expected and expected


def test_words_are_digested_many_at_a_time():
    rng = random.Random(4)
    sizes = [1, 2, 7, 8, 9, 15, 16, 17, 40, 63, 64, 65, 200]
    known = ["".join(rng.choice("ab\x00é") for _ in range(n)) for n in sizes for _ in range(3)]
    known += ["a", "a\x00", "a" * 8, "a" * 9, "a" * 64, "a" * 65, "b" + "a" * 63, "a" * 63 + "b"]
    text = "".join(rng.choice(known) + rng.choice([" ", "\t", "\n\x0b", "\x0c \r"]) for _ in range(2000))
    for data in (text.encode(), text.strip().encode(), b"", b" ", b"x"):
        begins, ends = text_hashes.spans(data)
        found = [data[b:e] for b, e in zip(begins.tolist(), ends.tolist())]
        assert found == data.split()
        digests = text_hashes.span_digests(data, begins, ends).tolist()
        assert len(set(zip(found, digests))) == len(set(found)) == len(set(digests))


def test_chunks_of_a_batch_change_nothing(docs_of, monkeypatch):
    rows = corpus(random.Random(6), 120) + [(9000 + i, "\n\t" * i) for i in range(9)]
    rows += [(10000 + i, f"w{i} " + "語" * 40 + " é" * 13) for i in range(9)]
    batch = pa.table({
        "doc_id": pa.array([2**63 - 1 if i is None else i for i, _ in rows], pa.int64()),
        "text": [t or "" for _, t in rows], "batch": pa.array([0] * len(rows), pa.int32()),
    })
    asked = word_repeats._probe(4)(batch)
    for size in (1, 300):
        monkeypatch.setattr(word_repeats, "CHUNK", size)
        assert word_repeats._probe(4)(batch) == asked
    found = as_dicts(word_repeats.without_repeats(docs_of(rows)))
    assert sorted((tuple(r.values())[:4] for r in found), key=str) == brute_words(rows)


def test_words_are_made_only_for_what_is_kept(docs_of, monkeypatch):
    rows = corpus(random.Random(7), 40)
    batch = pa.table({
        "doc_id": pa.array([i or 0 for i, _ in rows], pa.int64()),
        "text": [t or "" for _, t in rows], "batch": pa.array([0] * len(rows), pa.int32()),
    })
    made = []
    monkeypatch.setattr(text_hashes, "words", lambda *a: made.append(a) or (a[0] or "").encode().split())
    answers = word_repeats._probe(4)(batch)
    hits = pa.table({c: answers.column(c) for c in ("batch", "bucket", "keys")})
    assert word_repeats._extend(4)(batch, hits).num_rows and not made


def grouped(tables, key):
    """Rows of tables by a key's value, as groupBy deals them."""
    table = pa.concat_tables(tables, promote_options="default")
    return {k: table.filter(pc.equal(table.column(key), k)) for k in table.column(key).unique().to_pylist()}


def batches_of(rows, n):
    rows = [(2**63 - 1 if i is None else i, i is not None, t or "", k % n) for k, (i, t) in enumerate(rows)]
    types = [("doc_id", pa.int64()), ("named", pa.bool_()), ("text", pa.string()), ("batch", pa.int32())]
    return grouped([pa.table([pa.array(c, t) for c, (_, t) in zip(zip(*rows), types)], [c for c, _ in types])], "batch")


def answered(answer, tables, key):
    return [answer(g) for g in grouped(tables, key).values()]


def cogrouped(run, batches, tables):
    """Each batch with its rows of the tables, if any."""
    of = grouped(tables, "batch")
    none = next(iter(of.values())).slice(0, 0)
    return [run(b, of.get(k, none)) for k, b in batches.items()]


@pytest.mark.parametrize("size", [1, 200, 5000])
def test_word_repeats_in_small_chunks(monkeypatch, size):
    # Constants of a module change here, not in Spark's workers, so the steps run here.
    monkeypatch.setattr(word_repeats, "CHUNK", size)
    rows = corpus(random.Random(size), 150) + [(9000 + i, "\n\t" * i) for i in range(9)]
    docs = batches_of(rows, 5)
    hits = answered(batches.shared(True), map(word_repeats._probe(3), docs.values()), "bucket")
    windows = cogrouped(word_repeats._extend(3), docs, hits)
    out = cogrouped(word_repeats._remove, docs, answered(word_repeats._least, windows, "bucket"))
    found = [tuple(r.values())[:4] for t in out for r in t.to_pylist()]
    assert sorted(found, key=str) == brute_words(rows)


@pytest.mark.parametrize("group, shard", [(1, 1), (2000, 300), (1 << 16, 500)])
def test_byte_repeats_in_small_groups_and_shards(monkeypatch, group, shard):
    monkeypatch.setattr(byte_repeats, "CHUNK", 700)
    monkeypatch.setattr(byte_repeats, "GROUP", group)
    monkeypatch.setattr(byte_repeats, "SHARD", shard)
    rng = random.Random(shard)
    rows = corpus(rng, 100) + [(5000 + k, "z" * rng.randrange(45, 130)) for k in range(9)]
    rows += [(6000, "q" * 300), (6, "q" * 49), (7, "x" + "q" * 60), (6001, "ab" * 200), (8, "ba" * 40)]
    docs, sizes, merge = batches_of(rows, 5), [], bwt.merge
    monkeypatch.setattr(bwt, "merge", lambda shards, depth: sizes.append(len(shards)) or merge(shards, depth))
    names = answered(batches.shared(False), map(byte_repeats._probe(2), docs.values()), "bucket")
    asked = cogrouped(byte_repeats._probe_windows(2), docs, names)
    windows = answered(batches.shared(False), asked, "bucket") if any(t.num_rows for t in asked) else []
    alone = pa.array([byte_repeats.ALONE], pa.int32())
    windows = [t.drop_columns(["kind"]).append_column("kind", pa.concat_arrays([alone] * t.num_rows)) for t in windows if t.num_rows]
    hits = names + windows
    answers = answered(byte_repeats._merge, cogrouped(byte_repeats._send(2), docs, hits), "bucket")
    out = cogrouped(byte_repeats._remove(2), docs, hits + answers)
    found = [tuple(r.values())[:5] for t in out for r in t.to_pylist()]
    assert sorted(found, key=str) == brute_bytes(rows)
    assert max(sizes) > 1  # some are merged
