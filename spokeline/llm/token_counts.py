"""Exact token counts, with huge documents encoded in overlapping chunks.

A document of up to ``CHUNK`` characters is encoded as it is. A longer one is
dealt out as chunks, each of which shares ``OVERLAP`` characters with the next.
A chunk reports where its pre-tokens (the library's ``word_ids``) begin in what
it shares with its neighbours, and how many of its tokens come before.

Two neighbours are spliced at a place where a pre-token begins in both. That is
proven to be a boundary of the whole text: the pre-tokenizer looks at most
``MARGIN`` characters ahead (special strings are shorter too), and from one
boundary it goes on alike whatever stood before. So if the left chunk begins at
a boundary, its pre-tokens up to ``MARGIN`` before its end are those of the
whole text, and so are those of the right chunk from the common place on.

Where neighbours have no common place, as in a long run of one word, that
document is encoded again with overlaps that are widened until they have one.
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from spokeline.llm.shared_files import ship
from spokeline.llm.tables import checkpointed, text_of

CHUNK = 1 << 16
OVERLAP = 1 << 11
MARGIN = 64
BATCH_CHARS = 1 << 20
LIMIT = 1024


@lru_cache(maxsize=4)
def tokenizer(path: str):
    """The library's tokenizer without truncation and padding, once per worker."""
    # One task has one core; read before the library starts its threads.
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    found = Tokenizer.from_file(path)
    found.no_truncation()
    found.no_padding()
    return found


def _encode(tok, texts: list[str]):
    return tok.encode_batch(texts, add_special_tokens=False)


def _batched(texts: list[str]) -> Iterator[list[str]]:
    batch, chars = [], 0
    for text in texts:
        batch.append(text)
        chars += len(text)
        if chars >= BATCH_CHARS:
            yield batch
            batch, chars = [], 0
    if batch:
        yield batch


def starts(encoding) -> dict[int, int]:
    """Character at which each pre-token begins -> tokens before it."""
    found, last = {}, object()
    for nth, (word, (begin, _)) in enumerate(zip(encoding.word_ids, encoding.offsets, strict=True)):
        if word != last:
            found[begin] = nth
        last = word
    return found


def widened_count(tok, text: str, chunk: int = CHUNK, overlap: int = OVERLAP) -> int:
    """Tokens of a text, chunk after chunk, with overlaps widened where they fail."""
    total, at, skip = 0, 0, 0
    while True:
        size, shared = max(chunk, 2 * overlap), overlap
        while True:
            left = _encode(tok, [text[at : at + size]])[0]
            if at + size >= len(text):
                return total + len(left) - skip
            right_at = at + size - shared
            right = starts(_encode(tok, [text[right_at : right_at + 2 * shared]])[0])
            inner = {
                at + p: n
                for p, n in starts(left).items()
                if right_at + MARGIN <= at + p <= at + size - MARGIN and n >= skip
            }
            common = [p for p in inner if p - right_at in right and p > at]
            if common:
                break
            shared *= 2
            size = max(size, 2 * shared)
        place = max(common)
        total += inner[place] - skip
        at, skip = place, 0


def _short(path: str):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok = tokenizer(path)
        for batch in batches:
            counts = [len(e) for texts in _batched(batch.column("text").to_pylist()) for e in _encode(tok, texts)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("n_bytes"), pa.array(counts, pa.int64())],
                ["doc_id", "n_bytes", "n_tokens"],
            )

    return count


CHUNKS = "digest string, row string, part int, last boolean, text string"
ENCODED = "digest string, row string, part int, last boolean, n_tokens long, head array<int>, head_n array<int>, tail array<int>, tail_n array<int>"


def _chunks(chunk: int, overlap: int):
    """Chunks of long texts. A row is named by its task and place, which a rerun of the task repeats."""

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        nth, step = 0, chunk - overlap
        for batch in batches:
            for digest, text in zip(batch.column("digest").to_pylist(), batch.column("text").to_pylist()):
                row = f"{TaskContext.get().partitionId()}-{nth}"
                nth += 1
                begins = range(0, max(1, len(text) - overlap), step)
                for part, begin in enumerate(begins):
                    yield pa.RecordBatch.from_pylist(
                        [{
                            "digest": digest, "row": row, "part": part, "last": part == len(begins) - 1,
                            "text": text[begin : begin + chunk],
                        }],
                        schema=pa.schema([
                            ("digest", pa.string()), ("row", pa.string()), ("part", pa.int32()),
                            ("last", pa.bool_()), ("text", pa.string()),
                        ]),
                    )

    return split


def _encoded(path: str, chunk: int, overlap: int):
    """What each chunk knows: its tokens, and the starts it shares with its neighbours.

    Places are counted from where the right one of two neighbours begins.
    """
    step = chunk - overlap
    ints = pa.list_(pa.int32())

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok = tokenizer(path)
        for batch in batches:
            lists = {"n_tokens": [], "head": [], "head_n": [], "tail": [], "tail_n": []}
            for text in batch.column("text").to_pylist():
                encoding = _encode(tok, [text])[0]
                found = starts(encoding)
                head = {p: n for p, n in found.items() if MARGIN <= p <= overlap - MARGIN}
                tail = {p - step: n for p, n in found.items() if MARGIN <= p - step <= overlap - MARGIN}
                lists["n_tokens"].append(len(encoding))
                for name, places in (("head", head), ("tail", tail)):
                    lists[name].append(list(places))
                    lists[f"{name}_n"].append(list(places.values()))
            kept = [batch.column(c) for c in ("digest", "row", "part", "last")]
            made = [pa.array(lists["n_tokens"], pa.int64()), *[pa.array(v, ints) for v in list(lists.values())[1:]]]
            yield pa.RecordBatch.from_arrays(kept + made, ["digest", "row", "part", "last", *lists])

    return encode


def _spliced(encoded: DataFrame) -> DataFrame:
    """digest, n_tokens: null where some neighbours have no place in common."""
    follows = Window.partitionBy("digest", "row").orderBy("part")
    pairs = encoded.withColumn("next", F.lead(F.struct("head", "head_n")).over(follows))
    place = F.array_max(F.array_intersect("tail", "next.head"))

    def before(places: str, counts: str):
        return F.get(F.col(counts), F.array_position(F.col(places), F.col("place")).cast("int") - 1)

    return (
        pairs.withColumn("place", F.when(~F.col("last"), place))
        .withColumn(
            "own",
            F.when(F.col("last"), F.col("n_tokens")).otherwise(
                before("tail", "tail_n") - before("next.head", "next.head_n")
            ),
        )
        .groupBy("digest", "row")
        .agg(F.when(F.count("own") == F.count(F.lit(1)), F.sum("own")).alias("n_tokens"))
        .groupBy("digest")
        .agg(F.min("n_tokens").alias("n_tokens"))
    )


def _widened(path: str, chunk: int, overlap: int):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok = tokenizer(path)
        for batch in batches:
            counts = [widened_count(tok, t, chunk, 2 * overlap) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("digest"), pa.array(counts, pa.int64())], ["digest", "n_tokens"]
            )

    return count


def token_counts(
    docs: DataFrame, path: str, limit: int = LIMIT, chunk: int = CHUNK, overlap: int = OVERLAP
) -> DataFrame:
    """doc_id, n_bytes, n_tokens and over_limit of every document.

    Counts are those of the ``tokenizers`` library for the whole text, without
    added special tokens. ``path`` names a tokenizer file that every executor has.

    * Null texts count as empty: 0 bytes, 0 tokens. Repeated rows and null
      doc_ids are counted like others. An empty table gives no rows; further
      columns are ignored.
    """
    ship(docs.sparkSession)
    if overlap <= 2 * MARGIN or chunk < 2 * overlap:
        raise ValueError("chunks need an overlap of more than two margins, and twice the overlap themselves")
    sized = docs.select("doc_id", text_of().alias("text")).withColumn(
        "n_bytes", F.octet_length("text").cast("long")
    )
    fits = F.char_length("text") <= chunk
    short = sized.where(fits).mapInArrow(_short(path), "doc_id long, n_bytes long, n_tokens long")
    long = sized.where(~fits).withColumn("digest", F.sha2("text", 256))
    spliced = checkpointed(
        _spliced(
            long.select("digest", "text")
            .mapInArrow(_chunks(chunk, overlap), CHUNKS)
            .repartition(F.col("row"), F.col("part"))
            .mapInArrow(_encoded(path, chunk, overlap), ENCODED)
        )
    )
    failed = spliced.where("n_tokens is null").select("digest")
    again = (
        long.join(failed, "digest", "left_semi")
        .select("digest", "text")
        .mapInArrow(_widened(path, chunk, overlap), "digest string, n_tokens long")
        .distinct()
    )
    counts = spliced.where("n_tokens is not null").unionByName(again)
    counted = long.select("doc_id", "n_bytes", "digest").join(counts, "digest").drop("digest")
    return short.unionByName(counted).withColumn("over_limit", F.col("n_tokens") > limit)
