"""Repeated byte strings, found by merging Burrows-Wheeler transforms of shards.

1. A window of ``WINDOW`` bytes is named by the smallest digest of the ``GRAM``
   byte strings in it, so equal windows have equal names wherever they stand. A
   name that one document alone holds can't belong to a repeat; batches of
   documents ask buckets which names several hold.
2. Stretches of text whose windows share such a name are a batch's strings for the
   name's bucket, each distinct one once. The batch sends them with the smallest
   document that holds each. Where a passage begins or ends, each document has a
   stretch of its own, with some of its context, under a name that all share. Names
   with such a crowd of distinct stretches are therefore split: batches ask once more,
   with digests of their windows, and a window that several documents hold is a
   string by itself, for its own digest's bucket.
3. A bucket takes equal strings of several batches as one, which settles names that
   stand in one string only. The other strings are compared in groups of names, since
   equal windows have equal names. A group's strings are shards, each of some batches;
   the shards' Burrows-Wheeler transforms are merged by interleave refinement, to a depth
   of WINDOW symbols. Suffixes left in one block have a common prefix of WINDOW
   bytes; the smallest document in a block is the answer for its windows.
4. Batches mark the windows whose answer is smaller than their document.

So a bucket gets at most CROWD stretches (of SPAN windows) of a name, and one more
from each batch, or one window of each batch, though a third of all documents share
a passage.
"""

from __future__ import annotations

import hashlib
import zlib
from collections import defaultdict
from collections.abc import Iterator
from itertools import chain, count

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spokeline.llm import bwt
from spokeline.llm.batches import ASKED, CROWDED, NO_ID, SHARED, among, ask, codes, cut, dealt, shared, told
from spokeline.llm.text_hashes import mix

WINDOW = 50
GRAM = 32
SPAN = WINDOW - GRAM + 1
# A byte that UTF-8 never has.
END = b"\xff"
# Texts of a batch are looked at in chunks of about so many bytes.
CHUNK = 1 << 16
# Strings of a bucket are compared in groups of about so many bytes, made of shards of about so many.
GROUP, SHARD = 1 << 16, 1 << 14
# Odd factors of a gram's four words; fixed, so that digests agree between machines.
_FACTORS = [np.uint64(f) for f in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F)]
# Besides batches' kinds of answers: a window that several documents hold.
ALONE = 2

STRINGS = "bucket int, batch int, strings binary, names binary, least binary"
ANSWERS = "batch int, bucket int, strings binary, low binary, high binary, least binary"
ANSWER_TYPE = pa.schema(
    [("batch", pa.int32()), ("bucket", pa.int32())] + [(c, pa.binary()) for c in ("strings", "low", "high", "least")]
)


def _slide(values: np.ndarray, width: int, of) -> np.ndarray:
    """Least or greatest of every ``width`` consecutive values, by doubling."""
    done = 1
    while done < width:
        step = min(done, width - done)
        values = of(values[:-step], values[step:])
        done += step
    return values


def _chunks(docs: pa.Table):
    """Documents of a batch in order: ids, (id, text, whether it has the id), and groups as (first, texts)."""
    texts = docs.column("text").cast(pa.binary()).to_pylist()
    rows = sorted(zip(docs.column("doc_id").to_pylist(), texts, docs.column("named").to_pylist()))
    ids, texts = np.array([r[0] for r in rows], dtype=np.int64), [r[1] for r in rows]
    first = 0
    groups = []
    while first < len(texts):
        last, size = first, 0
        while last < len(texts) and (size < CHUNK or last == first):
            size += len(texts[last])
            last += 1
        groups.append((first, texts[first:last]))
        first = last
    return ids, rows, groups


def _names(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Digests of all grams, the name of each window (0 where it leaves its text), each byte's text."""
    data = b"".join(texts)
    owner = np.repeat(np.arange(len(texts), dtype=np.int32), [len(t) for t in texts])
    if len(data) < WINDOW:
        return np.empty(0, np.uint64), np.empty(0, np.uint64), owner
    words = np.ndarray((len(data) - 7,), "<u8", data, strides=(1,)).copy()
    n = len(data) - GRAM + 1
    with np.errstate(over="ignore"):
        words ^= words >> np.uint64(32)  # else last bytes would tell little
        grams = words[:n] * _FACTORS[0]
        for at, factor in zip(range(8, GRAM, 8), _FACTORS[1:], strict=True):
            grams += words[at : at + n] * factor
        grams = mix(grams)
        grams |= np.uint64(1)
    names = _slide(grams, SPAN, np.minimum)
    names[owner[: len(names)] != owner[WINDOW - 1 :]] = 0
    return grams, names, owner


def _numbered() -> defaultdict[bytes, int]:
    """Numbers strings from 0, each when it is first looked up."""
    return defaultdict(count().__next__)


def _runs(names: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last window of each stretch with one name."""
    change = np.flatnonzero(names[1:] != names[:-1])
    low, high = np.r_[0, change + 1], np.r_[change, len(names) - 1]
    inside = names[low] > 0
    return low[inside], high[inside]


def _ends(grams: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Digests of the grams that begin and end the windows from low to high; all of a single window's bytes."""
    with np.errstate(over="ignore"):
        return mix(mix(grams[low]) * np.uint64(3) + grams[high + SPAN - 1])


def _probe(buckets: int):
    def run(docs: pa.Table) -> pa.Table:
        ids, _, groups = _chunks(docs)
        digests, owners = [np.empty(0, np.uint64)], [np.empty(0, np.int64)]
        forms, weights = [np.empty(0, np.uint64)], [np.empty(0, np.int64)]
        for first, texts in groups:
            grams, names, owner = _names(texts)
            if not len(names):
                continue
            low, high = _runs(names)
            digests.append(mix(names[low]))  # small ones, spread again
            owners.append(ids[first + owner[low]])
            forms.append(_ends(grams, low, high) + (high - low).astype(np.uint64))
            weights.append(1 + (high - low) // SPAN)
        found, owner, *kinds = (np.concatenate(x) for x in (digests, owners, forms, weights))
        return ask(docs.column("batch")[0].as_py(), found, owner, None, buckets, kinds)

    return run


def _probe_windows(buckets: int):
    """Asks about the windows of crowded names."""

    def run(docs: pa.Table, answers: pa.Table) -> pa.Table:
        crowded = told(_of_kind(answers, CROWDED))
        digests, owners = [np.empty(0, np.uint64)], [np.empty(0, np.int64)]
        ids, _, groups = _chunks(docs) if len(crowded) else ((), (), ())
        for first, texts in groups:
            grams, names, owner = _names(texts)
            if not len(names):
                continue
            low, high = _runs(names)
            mine = among(codes(mix(names[low]), buckets), crowded)
            low, times = low[mine], (high - low + 1)[mine]
            window = np.repeat(low - np.cumsum(times) + times, times) + np.arange(times.sum())
            digests.append(_ends(grams, window, window))
            owners.append(ids[first + owner[window]])
        batch = docs.column("batch")[0].as_py() if len(crowded) else None
        return ask(batch, np.concatenate(digests), np.concatenate(owners), None, buckets)

    return run


def _of_kind(answers: pa.Table, kind: int) -> pa.Table:
    return answers.filter(pc.equal(answers.column("kind"), kind))


class Strings:
    """Distinct stretches of a batch, or windows of crowded ones, by bucket, and where they stand.

    Documents come in order, so each use of a batch numbers them alike.
    """

    def __init__(self, ids: np.ndarray, groups, answers: pa.Table, buckets: int):
        hits = told(answers.filter(pc.less(answers.column("kind"), ALONE)))
        numbers = _numbered()
        code, number, document, place = [np.empty(0, np.uint64)], [], [], []
        for first, texts in groups:
            _, names, owner = _names(texts)
            data = b"".join(texts)
            low, high = _runs(names) if len(names) else (names, names)
            spread = codes(mix(names[low]), buckets)
            hit = among(spread, hits)
            if not hit.any():
                continue
            low, high, spread = low[hit], high[hit], spread[hit]
            begins = np.r_[0, np.cumsum([len(t) for t in texts])]
            stretches = [data[s:e] for s, e in zip(low.tolist(), (high + WINDOW).tolist())]
            number += map(numbers.__getitem__, stretches)
            code.append(spread)
            document.append(first + owner[low])
            place.append(low - begins[owner[low]])
        none = [np.empty(0, np.int64)]
        number = np.array(number, dtype=np.int64)
        document, place = np.concatenate(none + document), np.concatenate(none + place)
        # Numbers are given in order, so a new one is where the greatest so far grows.
        new = np.diff(np.maximum.accumulate(number), prepend=-1) > 0
        strings, code = list(numbers), np.concatenate(code)[new]
        crowded = among(code, told(_of_kind(answers, CROWDED)))
        if crowded.any():
            strings, code, of, offset = _split(strings, code, crowded, told(_of_kind(answers, ALONE)), buckets)
            # of: the strings of each stretch, in order
            where = np.searchsorted(of[0], np.arange(len(numbers) + 1))
            times = (where[1:] - where[:-1])[number]
            part = np.repeat(where[number] - np.cumsum(times) + times, times) + np.arange(times.sum())
            document, place = np.repeat(document, times), np.repeat(place, times) + offset[part]
            number = of[1][part]
        order = np.argsort(code, kind="stable")
        self.code = code[order]
        self.strings = list(map(strings.__getitem__, order.tolist()))
        self.bucket = (self.code >> np.uint64(32)).astype(np.int64)
        renumbered = np.empty(len(order), dtype=np.int64)
        renumbered[order] = np.arange(len(order))
        self.number, self.document, self.place = renumbered[number], document, place
        self.length = np.fromiter(map(len, self.strings), dtype=np.int64, count=len(order))
        self.least = np.full(len(order), NO_ID, dtype=np.int64)
        np.minimum.at(self.least, self.number, ids[self.document])


def _split(strings: list[bytes], code: np.ndarray, crowded: np.ndarray, alone: np.ndarray, buckets: int):
    """Stretches, with the shared windows of crowded ones instead of them.

    Returns the strings and their codes, each stretch beside a string in it, and where that begins.
    """
    few, many = np.flatnonzero(~crowded), np.flatnonzero(crowded)
    texts = [strings[i] for i in many.tolist()]
    grams, names, owner = _names(texts)
    begins = np.cumsum([0] + [len(t) for t in texts])
    at = np.flatnonzero(names > 0)
    spread = codes(_ends(grams, at, at), buckets)
    hit = among(spread, alone)
    at, spread, data = at[hit], spread[hit], b"".join(texts)
    numbers = _numbered()
    windows = [data[i : i + WINDOW] for i in at.tolist()]
    part = np.fromiter(map(numbers.__getitem__, windows), dtype=np.int64, count=len(at))
    codes_ = np.empty(len(numbers), dtype=np.uint64)
    codes_[part] = spread
    stretch = np.r_[few, many[owner[at]]]
    string = np.r_[np.arange(len(few)), len(few) + part]
    offset = np.r_[np.zeros(len(few), np.int64), at - begins[owner[at]]]
    order = np.argsort(stretch, kind="stable")
    strings = [strings[i] for i in few.tolist()] + list(numbers)
    return strings, np.r_[code[few], codes_], (stretch[order], string[order]), offset[order]


def _send(buckets: int):
    def run(docs: pa.Table, answers: pa.Table) -> pa.Table:
        schema = pa.schema(
            [("bucket", pa.int32()), ("batch", pa.int32())] + [(c, pa.binary()) for c in ("strings", "names", "least")]
        )
        if not answers.num_rows:
            return schema.empty_table()
        ids, _, groups = _chunks(docs)
        found, rows = Strings(ids, groups, answers, buckets), []
        for bucket, some in cut(found.code):
            rows.append({
                "bucket": bucket, "batch": docs.column("batch")[0].as_py(),
                "strings": zlib.compress(END.join(found.strings[some]), 1),
                "names": found.code[some].astype("<u4").tobytes(),
                "least": zlib.compress(found.least[some].astype("<i8").tobytes(), 1),
            })
        return pa.Table.from_pylist(rows, schema=schema)

    return run


def _merge(table: pa.Table) -> pa.Table:
    """Answers of a bucket: runs of windows of a batch's strings that a smaller document holds."""
    sent = [zlib.decompress(x).split(END) for x in table.column("strings").to_pylist()]
    names = np.concatenate([np.frombuffer(x, "<u4") for x in table.column("names").to_pylist()])
    least = [zlib.decompress(x) for x in table.column("least").to_pylist()]
    local = np.concatenate([np.frombuffer(x, "<i8") for x in least])
    numbers = _numbered()
    number = np.fromiter(map(numbers.__getitem__, chain.from_iterable(sent)), dtype=np.int64, count=len(names))
    least = np.full(len(numbers), NO_ID, dtype=np.int64)
    np.minimum.at(least, number, local)
    length = np.fromiter(map(len, numbers), dtype=np.int64, count=len(numbers))
    name = np.empty(len(numbers), dtype=names.dtype)
    name[number] = names
    _, member, times = np.unique(name, return_inverse=True, return_counts=True)
    mixed = times[member] > 1
    # A string alone under its name answers for all its windows.
    whole = np.flatnonzero(~mixed)
    of, low, high, answer = whole, np.zeros(len(whole), np.int64), length[whole] - WINDOW, least[whole]
    if mixed.any():
        batch = np.repeat(np.arange(len(sent)), [len(x) for x in sent])
        first = np.full(len(numbers), len(sent))
        np.minimum.at(first, number, batch)
        strings, chosen = list(numbers), np.flatnonzero(mixed)
        groups = _groups(member[chosen], length[chosen], first[chosen])
        more = [_refined(strings, [chosen[i] for i in parts], least) for parts in groups]
        of, low, high, answer = (np.concatenate(x) for x in zip((of, low, high, answer), *more))
    order = np.argsort(of, kind="stable")
    of, low, high, answer = of[order], low[order], high[order], answer[order]
    begins = np.searchsorted(of, np.arange(len(numbers) + 1))
    rows, at, bucket = [], 0, table.column("bucket")[0].as_py()
    for batch, strings in zip(table.column("batch").to_pylist(), sent):
        mine = number[at : at + len(strings)]
        runs = begins[mine + 1] - begins[mine]
        nth = np.repeat(np.arange(len(strings)), runs)
        run = np.repeat(begins[mine] - np.cumsum(runs) + runs, runs) + np.arange(len(nth))
        told_ = answer[run] < local[at : at + len(strings)][nth]
        at += len(strings)
        nth, run = nth[told_], run[told_]
        if len(run):
            rows.append({
                "batch": batch, "bucket": bucket, "strings": nth.astype("<u4").tobytes(),
                "low": low[run].astype("<u4").tobytes(), "high": high[run].astype("<u4").tobytes(),
                "least": answer[run].astype("<i8").tobytes(),
            })
    return pa.Table.from_pylist(rows, schema=ANSWER_TYPE)


def _groups(member: np.ndarray, length: np.ndarray, first: np.ndarray) -> Iterator[list[np.ndarray]]:
    """Groups of the strings of some names, and shards of each: the strings of consecutive batches."""
    order = np.lexsort((first, member))
    total = np.cumsum(length[order])
    names = np.flatnonzero(np.diff(member[order], prepend=-1))
    group = np.repeat(total[names] // GROUP, np.diff(names, append=len(order)))
    for some in np.split(order, np.flatnonzero(np.diff(group)) + 1):
        some = some[np.argsort(first[some], kind="stable")]
        yield np.split(some, np.flatnonzero(np.diff(np.cumsum(length[some]) // SHARD)) + 1)


def _refined(strings: list[bytes], parts: list[np.ndarray], least: np.ndarray) -> tuple[np.ndarray, ...]:
    """Runs of windows (string, first, last) with one answer each, by merging the shards' transforms."""
    chosen = np.concatenate(parts)
    shards = [bwt.transform(*bwt.suffix_order([strings[i] for i in part.tolist()])) for part in parts]
    least = least[chosen]
    at, block = bwt.merge(shards, WINDOW)
    string, left, length = bwt.walk(shards)
    string, left = string[at], left[at]
    begins = np.flatnonzero(np.r_[True, block[1:] != block[:-1]])
    answer = np.minimum.reduceat(least[string], begins)[block]
    window = left >= WINDOW
    string, offset, answer = string[window].astype(np.int64), length[string[window]] - left[window], answer[window]
    order = np.lexsort((offset, string))
    string, offset, answer = string[order], offset[order], answer[order]
    first = np.flatnonzero(np.r_[True, (np.diff(string) > 0) | (np.diff(answer) != 0)])
    last = np.r_[first[1:], len(string)] - 1
    return chosen[string[first]], offset[first], offset[last], answer[first]


def _marks(ids: np.ndarray, found: Strings, answers: list[dict]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Document, begin and end of all bytes to remove."""
    own = ids[found.document] > found.least[found.number]
    document, begin = [found.document[own]], [found.place[own]]
    end = [found.place[own] + found.length[found.number[own]]]
    by_string = np.argsort(found.number, kind="stable")
    where = np.searchsorted(found.number[by_string], np.arange(len(found.strings) + 1))
    for row in answers:
        number = np.frombuffer(row["strings"], "<u4").astype(np.int64) + np.searchsorted(found.bucket, row["bucket"])
        times = where[number + 1] - where[number]
        run = np.repeat(np.arange(len(number)), times)
        nth = np.arange(len(run)) - np.repeat(np.cumsum(times) - times, times)
        seen = by_string[where[number][run] + nth]
        low, high = (np.frombuffer(row[c], "<u4").astype(np.int64)[run] for c in ("low", "high"))
        gone = np.frombuffer(row["least"], "<i8")[run] < ids[found.document[seen]]
        document.append(found.document[seen][gone])
        begin.append((found.place[seen] + low)[gone])
        end.append((found.place[seen] + high + WINDOW)[gone])
    return np.concatenate(document), np.concatenate(begin), np.concatenate(end)


RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary"


def _remove(buckets: int):
    def run(docs: pa.Table, answers: pa.Table) -> pa.Table:
        ids, documents, groups = _chunks(docs)
        rows = answers.to_pylist()
        document = np.empty(0, np.int64)
        if rows:
            found = Strings(ids, groups, answers.filter(pc.is_valid(answers.column("keys"))), buckets)
            document, begin, end = _marks(ids, found, [r for r in rows if r["strings"] is not None])
            order = np.argsort(document, kind="stable")
            document, begin, end = document[order], begin[order], end[order]
        out = []
        bounds = np.searchsorted(document, np.arange(len(documents) + 1)).tolist()
        for (doc_id, text, named), low, high in zip(documents, bounds, bounds[1:]):
            kept, removed, spans = text, 0, 0
            if low < high:
                edges = np.bincount(begin[low:high], minlength=len(text) + 1).astype(np.int64)
                edges -= np.bincount(end[low:high], minlength=len(text) + 1)
                gone = np.cumsum(edges[:-1]) > 0
                removed = int(gone.sum())
                spans = int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum())
                kept = np.frombuffer(text, np.uint8)[~gone].tobytes()
            out.append((doc_id if named else None, len(text), removed, spans, hashlib.sha256(kept).hexdigest(), kept))
        types = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary())
        names = [c.split()[0] for c in RESULT.split(", ")]
        return pa.table([pa.array(c, t) for c, t in zip(zip(*out), types)], names)

    return run


def without_repeats(docs: DataFrame) -> DataFrame:
    """Every document without the bytes that repeat a document with a smaller doc_id.

    A byte goes if some ``WINDOW`` bytes around it also begin in a document with a
    smaller doc_id; windows are those of the input and lie in one document.
    Returns doc_id, n_bytes, n_removed, n_spans (maximal removed runs),
    kept_sha256 and kept (remaining bytes, which may cut characters).

    * Null texts count as empty; texts shorter than a window keep everything.
    * A null doc_id counts as 2^63-1, the largest there is. Rows with the same doc_id
      are not compared with each other.
    * An empty table gives no rows; further columns are ignored.
    """
    batches, n = dealt(docs)
    hits, strings = _strings(batches, n)
    answers = strings.groupBy("bucket").applyInArrow(_merge, ANSWERS)
    both = hits.unionByName(answers, allowMissingColumns=True)
    return (
        batches.groupBy("batch")
        .cogroup(both.groupBy("batch"))
        .applyInArrow(_remove(n), RESULT)
        .where(F.col("n_bytes").isNotNull())
    )


def _strings(batches: DataFrame, n: int) -> tuple[DataFrame, DataFrame]:
    """Names and windows that several documents hold, and the strings of batches that buckets compare."""
    names = batches.groupBy("batch").applyInArrow(_probe(n), ASKED).groupBy("bucket").applyInArrow(shared(False), SHARED)
    names = names.repartition(n, "batch")  # answered once for all its uses
    asked = batches.groupBy("batch").cogroup(names.groupBy("batch")).applyInArrow(_probe_windows(n), ASKED)
    windows = asked.groupBy("bucket").applyInArrow(shared(False), SHARED).withColumn("kind", F.lit(ALONE))
    hits = names.unionByName(windows.repartition(n, "batch"))
    return hits, batches.groupBy("batch").cogroup(hits.groupBy("batch")).applyInArrow(_send(n), STRINGS)
