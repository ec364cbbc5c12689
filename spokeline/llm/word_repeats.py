"""Repeated runs of words, found from anchors at fixed blocks.

Of any ``WINDOW`` consecutive words that occur in two documents, the occurrence in
the reference holds a whole block of ``BLOCK`` words at a multiple of ``BLOCK``,
since WINDOW = 2 * BLOCK - 1. So:

1. Blocks of every document, not overlapping, are the index, and every rolling
   run of BLOCK words of every document is a probe. Both are digests, matched in
   buckets; a run hits if several documents hold it, one of them as a block.
2. A hit is extended to the windows around it. Windows are matched by 96-bit
   digests of their words' 64-bit digests, and a bucket answers with the smallest doc_id that holds one.
3. A window whose answer is smaller than its own document is a repeat; adjacent
   ones join to maximal repeats, whose words are removed.

Every step matches sets of digests of batches, so a passage in a third of all
documents makes one entry a batch and no pairs.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spokeline.llm import text_hashes
from spokeline.llm.batches import ASKED, SHARED, Lookup, ask, codes, cut, dealt, shared, told

BLOCK = 7
WINDOW = 2 * BLOCK - 1
# Texts of a batch are looked at in chunks of about so many bytes.
CHUNK = 1 << 17
KEY = np.dtype([("a", "<u8"), ("b", "<u4")])
WINDOWS = "bucket int, batch int, keys binary, least binary, several binary"
ANSWERS = "batch int, keys binary, least binary"


@dataclass
class Chunk:
    """Some documents of a batch: the first one's place, the words of all in order, and whose they are."""

    first: int
    texts: list[bytes]
    words: np.ndarray  # digests
    owner: np.ndarray  # place of each word's document in the batch
    bounds: np.ndarray  # where each document's words begin, and where the last one's end

    def within(self, width: int) -> np.ndarray:
        """Whether the runs of so many words, by their first, lie in one document."""
        return self.owner[: max(0, len(self.owner) - width + 1)] == self.owner[width - 1 :]


def _chunks(table: pa.Table) -> Iterator[Chunk]:
    """The documents of a batch in their order, about ``CHUNK`` bytes at a time."""
    texts = table.column("text").cast(pa.binary()).to_pylist()
    first = 0
    while first < len(texts):
        last, size = first, 0
        while last < len(texts) and (size < CHUNK or last == first):
            size += len(texts[last])
            last += 1
        some = texts[first:last]
        data = b" ".join(some)
        begins, ends = text_hashes.spans(data)
        bounds = np.searchsorted(begins, np.cumsum([0] + [len(t) + 1 for t in some]))
        owner = np.repeat(np.arange(first, last), np.diff(bounds))
        yield Chunk(first, some, text_hashes.span_digests(data, begins, ends), owner, bounds)
        first = last


def _empty(schema: list[tuple[str, pa.DataType]]) -> pa.Table:
    return pa.schema(schema).empty_table()


def _probe(buckets: int):
    def run(table: pa.Table) -> pa.Table:
        digests, owners, marked = [np.empty(0, np.uint64)], [np.empty(0, np.int64)], [np.empty(0, bool)]
        ids = _ids(table)
        for chunk in _chunks(table):
            begin = chunk.bounds[:-1]
            run = np.flatnonzero(chunk.within(BLOCK))
            place = chunk.owner[run] - chunk.first
            several = np.diff(chunk.bounds)[place] >= WINDOW
            run, place = run[several], place[several]
            digests.append(text_hashes.runs(chunk.words, BLOCK)[run])
            owners.append(ids[chunk.first + place])
            marked.append((run - begin[place]) % BLOCK == 0)
        batch = table.column("batch")[0].as_py()
        return ask(batch, np.concatenate(digests), np.concatenate(owners), np.concatenate(marked), buckets)

    return run


def _ids(docs: pa.Table) -> np.ndarray:
    return np.array(docs.column("doc_id").to_pylist(), dtype=np.int64)


def _window_keys(words: np.ndarray) -> np.ndarray:
    keys = np.empty(max(0, len(words) - WINDOW + 1), dtype=KEY)
    keys["a"] = text_hashes.runs(words, WINDOW, seed=1)
    keys["b"] = text_hashes.runs(words, WINDOW, seed=2) & np.uint64(0xFFFFFFFF)
    return keys


def _sorted(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An order that puts equal keys together, ascending in ``a``, and where each begins."""
    order = np.argsort(np.ascontiguousarray(key["a"]))
    a, b = key["a"][order], key["b"][order]
    new = np.r_[True, a[1:] != a[:-1]]
    if (b[1:] != b[:-1])[~new[1:]].any():
        order = np.lexsort((key["b"], key["a"]))
        new = np.r_[True, key[order][1:] != key[order][:-1]]
    return order, np.flatnonzero(new)


def _extend(buckets: int):
    """Windows around the hits of a batch: distinct keys with the smallest document that holds them."""

    def run(docs: pa.Table, answers: pa.Table) -> pa.Table:
        hits, ids = told(answers), _ids(docs)
        lookup = Lookup(hits)
        keys, owners = [np.empty(0, KEY)], [np.empty(0, np.int64)]
        for chunk in _chunks(docs) if len(hits) else ():
            hit, _ = lookup(codes(text_hashes.runs(chunk.words, BLOCK), buckets))
            if not len(hit):
                continue
            # A window begins at most BLOCK - 1 words before a hit.
            total = np.zeros(len(chunk.words) - BLOCK + 2, dtype=np.int32)
            total[hit + 1] = 1
            total = np.cumsum(total)
            near = np.flatnonzero((total[BLOCK:] > total[:-BLOCK]) & chunk.within(WINDOW))
            keys.append(_window_keys(chunk.words)[near])
            owners.append(ids[chunk.owner[near]])
        schema = [("bucket", pa.int32()), ("batch", pa.int32()), ("keys", pa.binary()), ("least", pa.binary()), ("several", pa.binary())]
        key, owner = np.concatenate(keys), np.concatenate(owners)
        if not len(key):
            return _empty(schema)
        order, begins = _sorted(key)
        key, owner = key[order], owner[order]
        least = np.minimum.reduceat(owner, begins)
        several = np.maximum.reduceat(owner, begins) > least
        key, batch, rows = key[begins], docs.column("batch")[0].as_py(), []
        for bucket, s in cut(codes(key["a"], buckets)):
            rows.append({
                "bucket": bucket, "batch": batch, "keys": key[s].tobytes(),
                "least": least[s].astype("<i8").tobytes(), "several": several[s].tobytes(),
            })
        return pa.Table.from_pylist(rows, schema=pa.schema(schema))

    return run


def _least(table: pa.Table) -> pa.Table:
    """Tells batches the smallest document of a window, where it is smaller than one of theirs."""
    keys = [np.frombuffer(k, KEY) for k in table.column("keys").to_pylist()]
    least = [np.frombuffer(x, "<i8") for x in table.column("least").to_pylist()]
    several = [np.frombuffer(x, bool) for x in table.column("several").to_pylist()]
    key, own, many = np.concatenate(keys), np.concatenate(least), np.concatenate(several)
    order, begins = _sorted(key)
    lengths = np.diff(np.r_[begins, len(order)])
    of_all = np.empty(len(order), dtype=np.int64)
    of_all[order] = np.repeat(np.minimum.reduceat(own[order], begins), lengths)
    answer, begin, rows = (of_all < own) | many, 0, []
    for batch, k in zip(table.column("batch").to_pylist(), keys):
        mine = np.flatnonzero(answer[begin : begin + len(k)])
        if len(mine):
            rows.append({"batch": batch, "keys": k[mine].tobytes(), "least": of_all[begin + mine].astype("<i8").tobytes()})
        begin += len(k)
    return pa.Table.from_pylist(
        rows, schema=pa.schema([("batch", pa.int32()), ("keys", pa.binary()), ("least", pa.binary())])
    )


def _covered(starts: np.ndarray, width: int, size: int) -> np.ndarray:
    """Places within ``width`` of a start; starts are distinct, and what they cover lies inside."""
    edges = np.zeros(size + 1, dtype=np.int8)
    edges[starts] += 1
    edges[starts + width] -= 1
    return np.cumsum(edges[:-1], dtype=np.int8) > 0


def _remove(docs: pa.Table, answers: pa.Table) -> pa.Table:
    keys = [np.frombuffer(k, KEY) for k in answers.column("keys").to_pylist()]
    least = [np.frombuffer(x, "<i8") for x in answers.column("least").to_pylist()]
    key = np.concatenate(keys) if keys else np.empty(0, KEY)
    least = np.concatenate(least) if least else np.empty(0, np.int64)
    order = np.argsort(key["a"], kind="stable")
    key, least = key[order], least[order]
    lookup, ids, rows = Lookup(np.ascontiguousarray(key["a"])), _ids(docs), []
    named = docs.column("named").to_pylist()
    for chunk in _chunks(docs):
        windows = _window_keys(chunk.words) if len(key) else key
        starts, at = lookup(np.ascontiguousarray(windows["a"]))
        same = (key["b"][at] == windows["b"][starts]) & (least[at] < ids[chunk.owner[starts]])
        starts = starts[same & chunk.within(WINDOW)[starts]]
        gone = _covered(starts, WINDOW, len(chunk.words))
        bounds = chunk.bounds.tolist()
        removed = np.diff(np.r_[0, np.cumsum(gone)][bounds]).tolist()
        for k, text, begin, end, n in zip(range(chunk.first, len(named)), chunk.texts, bounds, bounds[1:], removed):
            kept = text.split()
            if n:
                kept = compress(kept, (~gone[begin:end]).tolist())
            text = b" ".join(kept)
            doc_id = int(ids[k]) if named[k] else None
            rows.append((doc_id, end - begin, n, hashlib.sha256(text).hexdigest(), text))
    columns = list(zip(*rows))
    types = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string())
    names = ["doc_id", "n_words", "n_removed", "kept_sha256", "kept_text"]
    return pa.table([pa.array(c, t) for c, t in zip(columns, types)], names)


def without_repeats(docs: DataFrame) -> DataFrame:
    """Every document without the words that repeat a document with a smaller doc_id.

    A word goes if some ``WINDOW`` consecutive words around it also begin in a
    document with a smaller doc_id; windows are those of the input. Returns
    doc_id, n_words, n_removed, kept_sha256 and kept_text (kept words joined by one space).

    * Null texts and those with fewer words than a window keep everything.
    * A null doc_id counts as 2^63-1, the largest there is. Rows with the same doc_id
      are not compared with each other.
    * An empty table gives no rows; further columns are ignored.
    """
    batches, n = dealt(docs)
    hits = batches.groupBy("batch").applyInArrow(_probe(n), ASKED).groupBy("bucket").applyInArrow(shared(True), SHARED)
    windows = batches.groupBy("batch").cogroup(hits.groupBy("batch")).applyInArrow(_extend(n), WINDOWS)
    answers = windows.groupBy("bucket").applyInArrow(_least, ANSWERS)
    return (
        batches.groupBy("batch")
        .cogroup(answers.groupBy("batch"))
        .applyInArrow(
            _remove, "doc_id long, n_words long, n_removed long, kept_sha256 string, kept_text string"
        )
        .where(F.col("n_words").isNotNull())
    )
