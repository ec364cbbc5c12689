"""SentencePiece encoding and decoding with an Aho-Corasick automaton.

The automaton holds all pieces. It runs over a normalised text once; at each
position its output links name every piece that ends there, and each relaxes the
best segmentation up to that position:

* unigram models: the sum of piece scores, as in the Viterbi algorithm;
* merge (BPE) models: a segmentation is the model's own exactly if every two
  neighbours in it stay apart when merged by themselves. So a piece may follow
  the best segmentation up to its start if it stays apart from its last piece,
  and at most one piece can. Pairs are tried once and remembered.

Characters without a piece count as unknown; with byte fallback they become bytes.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spokeline.llm.shared_files import ship
from spokeline.llm.tables import text_of

SPACE = "▁"
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
UNIGRAM, BPE = 1, 2
# How much worse than the worst piece an unknown character scores, as in the library.
UNKNOWN_PENALTY = 10.0
CACHED_SEGMENTS, CACHED_LENGTH, CACHED_PAIRS = 400_000, 64, 1 << 20


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Field numbers and values of a protocol buffer message."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(data):
        tag = varint()
        kind = tag & 7
        if kind == 0:
            yield tag >> 3, varint()
        else:
            size = varint() if kind == 2 else {1: 8, 5: 4}[kind]
            yield tag >> 3, data[at : at + size]
            at += size


class Pieces:
    """A model's vocabulary as an automaton; ``encode`` and ``decode`` as the library does."""

    def __init__(self, path: str | None = None, proto: bytes | None = None):
        import sentencepiece

        source = {"model_file": path} if proto is None else {"model_proto": proto}
        # The library normalises texts; segmentation and decoding are done here.
        self.library = sentencepiece.SentencePieceProcessor(**source)
        model = list(_fields(self.library.serialized_model_proto()))
        trainer = dict(x for number, part in model if number == 2 for x in _fields(part))
        normalizer = dict(x for number, part in model if number == 3 for x in _fields(part))
        self.kind = trainer.get(3, UNIGRAM)
        self.byte_fallback = bool(trainer.get(35, 0))
        self.dummy_prefix = bool(normalizer.get(3, 1))
        if self.kind not in (UNIGRAM, BPE):
            raise ValueError("only unigram and merge models are known")
        self.piece, self.score, self.type = [], [], []
        for number, part in model:
            if number == 1:
                fields = dict(_fields(part))
                self.piece.append(fields.get(1, b"").decode())
                self.type.append(fields.get(3, NORMAL))
        self.score = [self.library.get_score(i) for i in range(len(self.piece))]
        self.id = {p: i for i, p in enumerate(self.piece) if self.type[i] == NORMAL}
        self.unknown = self.type.index(UNKNOWN)
        if USER in self.type or UNUSED in self.type:
            raise ValueError("user-defined and unused pieces are not supported")
        self.byte_id = {int(p[3:5], 16): i for i, p in enumerate(self.piece) if self.type[i] == BYTE}
        self.byte_of = {i: b for b, i in self.byte_id.items()}
        self.automaton = ahocorasick.Automaton()
        for piece, i in self.id.items():
            self.automaton.add_word(piece, (len(piece), i))
        self.automaton.make_automaton()
        self.floor = min((self.score[i] for i in self.id.values()), default=0.0) - UNKNOWN_PENALTY
        self.single = {p for p in self.id if len(p) == 1}
        # No piece goes on over a space mark once it has other characters, so texts split there.
        self.splits = not any(SPACE in p.lstrip(SPACE) for p in self.id)
        self.apart: dict[tuple[int, int], bool] = {}
        self.seen: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def merged(self, text: str) -> list[str]:
        """Segments of a short text by merging the best pair, the leftmost of equals, until none is left."""
        parts = list(text)
        while True:
            best = max(
                ((self.score[self.id[a + b]], -i) for i, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in self.id),
                default=None,
            )
            if best is None:
                return parts
            i = -best[1]
            parts[i : i + 2] = [parts[i] + parts[i + 1]]

    def _stays(self, one: int, other: int) -> bool:
        """Whether a piece stands as it is after another one (-1: after none) when both are merged."""
        parts = [self.piece[i] for i in (one, other) if i >= 0]
        known = self.apart[one, other] = self.merged("".join(parts)) == parts
        return known

    def _segment(self, text: str) -> list[int]:
        """Piece ids of a normalised text; -1 for each unknown character."""
        size = len(text)
        last, begins = [None] * (size + 1), [0] * (size + 1)  # the piece that ends here, and its start
        best = [0.0] * (size + 1)
        last[0] = -1
        plain, done = self.single.issuperset(text), 0
        merging, apart, score = self.kind == BPE, self.apart, self.score
        for at, (length, piece) in self.automaton.iter(text):
            end, begin = at + 1, at + 1 - length
            if not plain:
                self._settle(text, done, at, last, begins, best)
                done = at
            before = last[begin]
            if before is None:
                continue
            if merging:
                if last[end] is None:
                    stays = apart.get((before, piece))
                    if self._stays(before, piece) if stays is None else stays:
                        last[end], begins[end] = piece, begin
            else:
                total = best[begin] + score[piece]
                if last[end] is None or total > best[end]:
                    last[end], begins[end], best[end] = piece, begin, total
        if not plain:
            self._settle(text, done, size, last, begins, best)
        out, end = [], size
        while end:
            out.append(last[end])
            end = begins[end]
        return out[::-1]

    def _settle(self, text: str, done: int, upto: int, last: list, begins: list, best: list) -> None:
        """Positions after ``done`` that no piece ends at are reached by one unknown character."""
        for end in range(done + 1, upto + 1):
            if last[end] is None and last[end - 1] is not None and text[end - 1] not in self.id:
                last[end], begins[end], best[end] = -1, end - 1, best[end - 1] + self.floor

    def _ids(self, text: str) -> bytes:
        """Little-endian 32-bit ids of a normalised stretch."""
        out, at, was_unknown = [], 0, False
        for piece in self._segment(text):
            if piece >= 0:
                out.append(piece)
                at += len(self.piece[piece])
            elif self.byte_fallback:
                out += [self.byte_id[b] for b in text[at].encode()]
                at += 1
            else:
                out += [] if was_unknown else [self.unknown]
                at += 1
            was_unknown = piece < 0
        return b"".join(i.to_bytes(4, "little") for i in out)

    def encode(self, text: str) -> bytes:
        """Ids of a text as little-endian 32-bit numbers."""
        normal = self.library.normalize(text)
        if not normal:
            return b""
        if not self.splits:
            return self._ids(normal)
        if len(self.seen) > CACHED_SEGMENTS:  # a full generation becomes the older one
            self.seen, self.older = {}, self.seen
        if len(self.apart) > CACHED_PAIRS:
            self.apart = {}
        seen = self.seen
        return b"".join([seen.get(s) or self._stretch(s) for s in _stretches(normal)])

    def _stretch(self, text: str) -> bytes:
        found = self.older.get(text) or self._ids(text)
        if len(text) <= CACHED_LENGTH:
            self.seen[text] = found
        return found

    def decode(self, ids: list[int]) -> str:
        """The text of ids; bytes that are no UTF-8 become the replacement character."""
        out, run = [], bytearray()
        for i in ids:
            if i in self.byte_of:
                run.append(self.byte_of[i])
                continue
            if run:
                out.append(run.decode(errors="replace"))
                run = bytearray()
            if self.type[i] == NORMAL:
                out.append(self.piece[i])
            elif self.type[i] == UNKNOWN:
                out.append(" ⁇ ")
        out.append(run.decode(errors="replace"))
        text = "".join(out)
        if self.dummy_prefix and text.startswith(SPACE):
            text = text[1:]
        return text.replace(SPACE, " ")


def _stretches(normal: str) -> list[str]:
    """A normalised text cut before each run of space marks."""
    words = normal.split(SPACE)
    out, marks = ([words[0]] if words[0] else []), 0
    for word in words[1:]:
        marks += 1
        if word:
            out.append(SPACE * marks + word)
            marks = 0
    if marks:
        out.append(SPACE * marks)
    return out


@lru_cache(maxsize=2)
def pieces(path: str) -> Pieces:
    """The automaton of a model file, once per worker."""
    return Pieces(path)


def _coder(path: str, with_ids: bool):
    names = ["n_pieces", "ids_crc32", "decoded", "round_trip"] + ["ids"] * with_ids

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = pieces(path)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                some = batch.slice(at, 256)
                rows: dict[str, list] = {n: [] for n in names}
                for text in some.column("text").to_pylist():
                    packed = model.encode(text)
                    ids = memoryview(packed).cast("I").tolist()
                    decoded = model.decode(ids)
                    rows["n_pieces"].append(len(ids))
                    rows["ids_crc32"].append(zlib.crc32(packed))
                    rows["decoded"].append(decoded)
                    # The mark of a space is the one character that does not come back as it was.
                    rows["round_trip"].append(decoded == text.replace(SPACE, " "))
                    if with_ids:
                        rows["ids"].append(ids)
                types = {"n_pieces": pa.int64(), "ids_crc32": pa.int64(), "decoded": pa.string(),
                         "round_trip": pa.bool_(), "ids": pa.list_(pa.int32())}
                yield pa.RecordBatch.from_arrays(
                    [some.column("doc_id"), *[pa.array(rows[n], types[n]) for n in names]], ["doc_id", *names]
                )

    return code


def encode_decode(docs: DataFrame, path: str, with_ids: bool = False) -> DataFrame:
    """Every document's pieces under the model at ``path``, and the text they decode to.

    Returns doc_id, n_pieces, ids_crc32 (of the ids as little-endian 32-bit
    numbers), decoded and round_trip (the decoded text is the text, for models
    that keep white space); with ``with_ids`` also the ids. ``path`` names a
    file that every executor has.

    * Null and empty texts have no pieces. Repeated rows and null doc_ids count
      like others. An empty table gives no rows; further columns are ignored.
    """
    ship(docs.sparkSession)
    schema = "doc_id long, n_pieces long, ids_crc32 long, decoded string, round_trip boolean"
    schema += ", ids array<int>" * with_ids
    return docs.select(F.col("doc_id").cast("long"), text_of().alias("text")).mapInArrow(_coder(path, with_ids), schema)
