"""Batches of documents that ask each other about digests.

Documents are dealt into batches of about ``BATCH_BYTES`` by a hash. A batch
sends each of its distinct digests once, packed by bucket, however often it
holds it; so a digest that a third of all documents hold comes once per batch.
A bucket answers each batch about the digests that matter to it.

The dealt documents are used several times in one plan, which shuffles them
once and reuses the exchange.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spokeline.llm.shared_files import ship
from spokeline.llm.tables import parts_for, text_bytes, text_of

BATCH_BYTES = 8 << 20
# What a null doc_id counts as where documents are compared: no other is larger, and nothing is before another for it.
NO_ID = 2**63 - 1


def dealt(docs: DataFrame) -> tuple[DataFrame, int]:
    """doc_id, whether a row has one (``named``), text and batch, and the number of batches."""
    ship(docs.sparkSession)
    n = parts_for(docs.sparkSession, text_bytes(docs), BATCH_BYTES)
    doc_id = F.col("doc_id").cast("long")
    rows = docs.select(
        F.coalesce(doc_id, F.lit(NO_ID)).alias("doc_id"), doc_id.isNotNull().alias("named"), text_of().alias("text")
    )
    spread = F.xxhash64("doc_id", "text")
    return rows.withColumn("batch", F.pmod(spread, F.lit(n)).cast("int")).repartition(n, "batch"), n


def bucket_of(digests: np.ndarray, buckets: int) -> np.ndarray:
    """Bucket of 64-bit digests by their upper half; the lower half stays a free key."""
    return ((digests >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)


def codes(digests: np.ndarray, buckets: int) -> np.ndarray:
    """Bucket and lower half as one number, by which batches and buckets know a digest."""
    return bucket_of(digests, buckets) << np.uint64(32) | (digests & np.uint64(0xFFFFFFFF))


def cut(sorted_codes: np.ndarray) -> Iterator[tuple[int, slice]]:
    """Buckets in ascending codes, with where each begins and ends."""
    buckets = (sorted_codes >> np.uint64(32)).astype(np.int64)
    found, begins = np.unique(buckets, return_index=True)
    for bucket, begin, end in zip(found.tolist(), begins.tolist(), [*begins[1:].tolist(), len(buckets)]):
        yield bucket, slice(begin, end)


ASKED = "bucket int, batch int, keys binary, flags binary"
SHARED = "batch int, bucket int, keys binary, kind int"
# Flags of a key. What is above the two lowest bits counts its crowd, up to CROWD.
SEVERAL, MARKED = 1, 2
CROWD = 63
# Kinds of answers: a shared key, and one with a crowd.
FEW, CROWDED = 0, 1


def ask(
    batch: int,
    digests: np.ndarray,
    owners: np.ndarray,
    marked: np.ndarray | None,
    buckets: int,
    forms: tuple[np.ndarray, np.ndarray] | None = None,
) -> pa.Table:
    """One row per bucket: distinct keys, whether several documents hold one, whether one is marked.

    ``forms`` tells forms of a key apart and gives their weights; all the weight of a
    key's distinct forms above 1 is its crowd in this batch.
    """
    known = codes(digests, buckets)
    order = np.argsort(known)
    known, owners = known[order], owners[order]
    begins = np.flatnonzero(np.r_[True, known[1:] != known[:-1]]) if len(known) else np.empty(0, np.int64)
    flags = np.zeros(len(begins), dtype=np.uint8)
    if len(begins):
        several = np.minimum.reduceat(owners, begins) != np.maximum.reduceat(owners, begins)
        flags |= several.astype(np.uint8) * SEVERAL
        if marked is not None:
            flags |= np.maximum.reduceat(marked[order].astype(np.uint8), begins) * MARKED
        if forms is not None:
            flags |= (np.minimum(_crowds(begins, *(f[order] for f in forms)), CROWD) << 2).astype(np.uint8)
    known = known[begins]
    rows = [
        {"bucket": b, "batch": batch, "keys": known[s].astype("<u4").tobytes(), "flags": flags[s].tobytes()}
        for b, s in cut(known)
    ]
    return pa.Table.from_pylist(
        rows,
        schema=pa.schema([("bucket", pa.int32()), ("batch", pa.int32()), ("keys", pa.binary()), ("flags", pa.binary())]),
    )


def _crowds(begins: np.ndarray, form: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Weight of the distinct forms of each key, less 1."""
    sizes = np.diff(np.r_[begins, len(form)])
    total = weight[begins].astype(np.int64)
    key = np.repeat(np.arange(len(begins)), sizes)
    some = np.flatnonzero(sizes[key] > 1)
    some = some[np.lexsort((form[some], key[some]))]
    again = (key[some][1:] == key[some][:-1]) & (form[some][1:] == form[some][:-1])
    some = some[np.r_[True, ~again]] if len(some) else some
    total[sizes > 1] = np.bincount(key[some], weight[some], len(begins))[sizes > 1]
    return total - 1


def shared(need_mark: bool):
    """Answers of a bucket: keys that several documents hold and, if asked for, one marked."""

    def answer(table: pa.Table) -> pa.Table:
        keys = [np.frombuffer(k, "<u4") for k in table.column("keys").to_pylist()]
        flags = [np.frombuffer(f, np.uint8) for f in table.column("flags").to_pylist()]
        sizes = [len(k) for k in keys]
        found, member, count = np.unique(np.concatenate(keys), return_inverse=True, return_counts=True)
        flag = np.concatenate(flags)
        several = (count > 1) | (np.bincount(member, flag & SEVERAL, len(found)) > 0)
        if need_mark:
            several &= np.bincount(member, flag & MARKED, len(found)) > 0
        crowded = (np.bincount(member, flag >> 2, len(found)) >= CROWD)[member]
        hit, begin, rows = several[member], 0, []
        bucket = table.column("bucket")[0].as_py()
        for batch, k, size in zip(table.column("batch").to_pylist(), keys, sizes):
            own = slice(begin, begin + size)
            begin += size
            for kind, of_kind in ((FEW, hit[own] & ~crowded[own]), (CROWDED, hit[own] & crowded[own])):
                if of_kind.any():
                    rows.append({"batch": batch, "bucket": bucket, "keys": k[of_kind].tobytes(), "kind": kind})
        types = [("batch", pa.int32()), ("bucket", pa.int32()), ("keys", pa.binary()), ("kind", pa.int32())]
        return pa.Table.from_pylist(rows, schema=pa.schema(types))

    return answer


def told(table: pa.Table) -> np.ndarray:
    """Ascending codes of a batch's shared keys."""
    parts = [
        np.uint64(b) << np.uint64(32) | np.frombuffer(k, "<u4").astype(np.uint64)
        for b, k in zip(table.column("bucket").to_pylist(), table.column("keys").to_pylist())
    ]
    return np.sort(np.concatenate(parts)) if parts else np.empty(0, np.uint64)


def among(values: np.ndarray, ascending: np.ndarray) -> np.ndarray:
    """Which values are in an ascending array."""
    if not len(ascending):
        return np.zeros(len(values), dtype=bool)
    at = np.minimum(np.searchsorted(ascending, values), len(ascending) - 1)
    return ascending[at] == values


class Lookup:
    """Finds digests in an ascending array; most of those that aren't there are told by their lower bits alone."""

    def __init__(self, ascending: np.ndarray):
        self.ascending = ascending
        self.mask = np.uint64((1 << max(16, min(26, len(ascending).bit_length() + 4))) - 1)
        self.seen = np.zeros(int(self.mask) + 1, dtype=bool)
        self.seen[ascending & self.mask] = True

    def __call__(self, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which values are there, and the first place of each of them."""
        which = np.flatnonzero(self.seen[values & self.mask])
        if not len(which):
            return which, which
        some = values[which]
        at = np.minimum(np.searchsorted(self.ascending, some), len(self.ascending) - 1)
        found = self.ascending[at] == some
        return which[found], at[found]
