"""Token ids of all documents in binary files, in the order of doc_id.

Documents are dealt by ranges of doc_id; each task encodes its range in order and
writes files of about ``FILE_IDS`` ids (see ``elias_fano``). A file's name and
content follow from the range alone, so a task that is run again writes the same
files again. The table of files, with the number of ids in each, gives every file
its place in the whole.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from spokeline.llm import elias_fano
from spokeline.llm.shared_files import ship, write_file
from spokeline.llm.tables import parts_for, text_bytes, text_of
from spokeline.llm.token_counts import tokenizer

FILE_IDS = 1 << 22
PART_BYTES = 64 << 20
CACHED_WORDS, CACHED_LENGTH, TOGETHER = 400_000, 64, 256
TEXT_BYTES = 8 << 20

# Patterns of words as tokenizer files state them, none of which matches white space.
SPACELESS = {"'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"}
# Steps before the pattern that treat a word alike with and without its neighbours.
WORDWISE = {"NFC", "NFD", "NFKC", "NFKD", "Lowercase"}


def drops_spaces(declared: dict) -> bool:
    """Whether a tokenizer file says that a text's ids are those of its words, split at ASCII white space.

    Only what is known to be so counts; any other file's texts are encoded whole.
    """

    def steps(step: dict | None, inner: str) -> list[dict]:
        if step is None:
            return []
        return [s for part in step[inner] for s in steps(part, inner)] if step["type"] == "Sequence" else [step]

    normal, cuts = steps(declared["normalizer"], "normalizers"), steps(declared["pre_tokenizer"], "pretokenizers")
    one_space = {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}
    added = declared["added_tokens"]
    return (
        all(s["type"] in WORDWISE or s == one_space for s in normal)
        and len(cuts) > 0
        and cuts[0]["type"] == "Split"
        and (cuts[0]["behavior"], cuts[0]["invert"]) == ("Removed", True)
        and cuts[0]["pattern"].get("Regex") in SPACELESS
        and all(s["type"] == "ByteLevel" and not s["add_prefix_space"] and not s["use_regex"] for s in cuts[1:])
        and not any(t["lstrip"] or t["rstrip"] or t["single_word"] or len(t["content"].split()) != 1 for t in added)
        and declared["model"]["type"] == "BPE"
        and not declared["model"].get("dropout")
    )


class TextEncoder:
    """Ids of texts, each encoded whole by the library."""

    def __init__(self, path: str):
        self.tok = tokenizer(path)
        self.id_bytes = 2 if self.tok.get_vocab_size() <= 1 << 16 else 4

    def ids(self, texts: list[str]) -> list[bytes]:
        found, cuts = self.coded(pa.array(texts, pa.string()))
        return [bytes(found[low:high]) for low, high in zip(cuts, cuts[1:])]

    def coded(self, texts: pa.Array) -> tuple[memoryview, list[int]]:
        """Ids of all texts, and where each text's begin and end among their bytes."""
        found = self.tok.encode_batch(texts.to_pylist(), add_special_tokens=False)
        each = [np.array(e.ids, dtype=f"<u{self.id_bytes}").tobytes() for e in found]
        return memoryview(b"".join(each)), np.cumsum([0, *map(len, each)]).tolist()


class WordEncoder(TextEncoder):
    """The same for a tokenizer that ``drops_spaces``, word by word.

    A batch's distinct words are numbered by Arrow. Those seen lately are
    remembered, others are encoded by the library, many in one call: a full generation
    of them becomes the older one, which is dropped when the next is full.
    """

    def __init__(self, path: str):
        super().__init__(path)
        self.seen: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}

    def coded(self, texts: pa.Array) -> tuple[memoryview, list[int]]:
        words = pc.ascii_split_whitespace(texts.cast(pa.large_string()))
        numbered = words.flatten().dictionary_encode()
        each = pa.array(self._known(numbered.dictionary.cast(pa.large_binary()).to_pylist()), pa.large_binary())
        ids = each.take(numbered.indices)
        ends = np.frombuffer(ids.buffers()[1], np.int64, len(ids) + 1, 8 * ids.offset)
        begins = words.offsets.to_numpy(zero_copy_only=False)
        return memoryview(ids.buffers()[2] or b""), ends[begins - begins[0]].tolist()

    def _known(self, words: list[bytes]) -> list[bytes]:
        if len(self.seen) > CACHED_WORDS:
            self.seen, self.older = {}, self.seen
        seen, older, new = self.seen, self.older, []
        for word in words:
            if word not in seen:
                if word in older:
                    seen[word] = older[word]
                else:
                    new.append(word)
        for at in range(0, len(new), TOGETHER):
            some = new[at : at + TOGETHER]
            seen.update(zip(some, self._encoded(some), strict=True))
        out = [seen[word] for word in words]
        for word in new:  # long ones are rarely seen again
            if len(word) > CACHED_LENGTH:
                del seen[word]
        return out

    def _encoded(self, words: list[bytes]) -> list[bytes]:
        """Ids of each word from one call on all, cut where the words begin in it."""
        texts = [w.decode() for w in words]
        encoding = self.tok.encode(" ".join(texts), add_special_tokens=False)
        ids = np.array(encoding.ids, dtype=f"<u{self.id_bytes}").tobytes()
        begins = np.cumsum([0, *[len(t) + 1 for t in texts]])
        cuts = np.searchsorted([begin for begin, _ in encoding.offsets], begins) * self.id_bytes
        return [ids[a:b] for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist())]


def encoder_of(path: str) -> TextEncoder:
    declared = json.loads(tokenizer(path).to_str())
    return WordEncoder(path) if drops_spaces(declared) else TextEncoder(path)


_encoders: dict[str, TextEncoder] = {}


def _pieces(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Slices of about ``TEXT_BYTES`` of text, of a document at least."""
    ends = np.cumsum(pc.binary_length(batch.column("text")).to_numpy(zero_copy_only=False))
    at = 0
    while at < batch.num_rows:
        before = int(ends[at - 1]) if at else 0
        end = max(at + 1, int(np.searchsorted(ends, before + TEXT_BYTES, side="right")))
        yield batch.slice(at, end - at)
        at = end


def _writer(path: str, folder: str, end_id: int, file_ids: int):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if path not in _encoders:
            _encoders[path] = encoder_of(path)
        encoder = _encoders[path]
        end = end_id.to_bytes(encoder.id_bytes, "little")
        part, nth = TaskContext.get().partitionId(), 0
        names, lengths, ids = [], [], bytearray()

        def flush():
            nonlocal nth, names, lengths, ids
            name = f"tokens-{part:06d}-{nth:06d}.eft"
            write_file(folder, name, elias_fano.pack(names, lengths, bytes(ids), encoder.id_bytes))
            row = pa.RecordBatch.from_pylist(
                [{"file": name, "part": part, "nth": nth, "docs": len(names), "ids": sum(lengths)}],
                schema=pa.schema(
                    [("file", pa.string()), ("part", pa.int32()), ("nth", pa.int32()), ("docs", pa.int64()), ("ids", pa.int64())]
                ),
            )
            nth, names, lengths, ids = nth + 1, [], [], bytearray()
            return row

        for batch in batches:
            for some in _pieces(batch):
                found, cuts = encoder.coded(some.column("text"))
                for name, low, high in zip(some.column("doc_id").to_pylist(), cuts, cuts[1:]):
                    names.append(name)
                    ids += found[low:high]
                    ids += end
                    lengths.append((high - low) // encoder.id_bytes + 1)
                    if len(ids) >= file_ids * encoder.id_bytes:
                        yield flush()
        if names:
            yield flush()

    return write


def write_tokens(docs: DataFrame, path: str, folder: str, end_id: int = 1, file_ids: int = FILE_IDS) -> DataFrame:
    """Encode all texts, each followed by ``end_id``, into files below ``folder``.

    Returns the table of files, which is written there too. ``path`` names a
    tokenizer of the ``tokenizers`` library; where it is known to drop white space, words
    are encoded, and texts as a whole otherwise.

    * Null and empty texts have the end id alone. Null doc_ids come first, rows
      with equal doc_id in any order. An empty table gives no file.
    """
    spark = docs.sparkSession
    ship(spark)
    parts = parts_for(spark, text_bytes(docs), PART_BYTES)
    files = (
        docs.select("doc_id", text_of().alias("text"))
        .repartitionByRange(parts, "doc_id")
        .sortWithinPartitions("doc_id")
        .mapInArrow(
            _writer(path, f"{folder}/ids", end_id, file_ids),
            "file string, part int, nth int, docs long, ids long",
        )
    )
    files.write.mode("overwrite").parquet(f"{folder}/files")
    return spark.read.parquet(f"{folder}/files")


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for path, content in zip(batch.column("path").to_pylist(), batch.column("content")):
            name = path.rsplit("/", 1)[-1]
            rows = list(elias_fano.TokenFile(content.as_buffer()).rows())
            columns = list(zip(*rows)) or [[]] * 4
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * len(rows), pa.string()), *[pa.array(c, pa.int64()) for c in columns]],
                ["file", "doc_id", "begin", "n_tokens", "ids_crc32"],
            )


def read_tokens(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of every document, from the files alone."""
    ship(spark)
    files = spark.read.parquet(f"{folder}/files")
    earlier = Window.partitionBy("part").orderBy("nth").rowsBetween(Window.unboundedPreceding, -1)
    # One row per range of doc_id.
    parts = files.groupBy("part").agg(F.sum("ids").alias("ids"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("part", F.coalesce(F.sum("ids").over(before), F.lit(0)).alias("before"))
    starts = files.withColumn("earlier", F.coalesce(F.sum("ids").over(earlier), F.lit(0))).join(parts, "part")
    starts = starts.select("file", (F.col("earlier") + F.col("before")).alias("file_start"))
    if files.isEmpty():
        return starts.select(
            *[F.lit(None).cast("long").alias(c) for c in ("doc_id", "start", "n_tokens", "ids_crc32")]
        )
    stored = spark.read.format("binaryFile").option("pathGlobFilter", "*.eft").load(f"{folder}/ids")
    rows = stored.select("path", "content").mapInArrow(
        _rows, "file string, doc_id long, begin long, n_tokens long, ids_crc32 long"
    )
    return rows.join(starts, "file").select(
        "doc_id", (F.col("file_start") + F.col("begin")).alias("start"), "n_tokens", "ids_crc32"
    )
