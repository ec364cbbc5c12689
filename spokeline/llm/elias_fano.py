"""Elias-Fano coding of ascending numbers, and the token file made of it.

n ascending numbers below u are kept as n * l low bits, l = log2(u / n) rounded
down, and a bit string of at most 3n bits in which the i-th one stands at
(number >> l) + i. Every 64th one's place is sampled, so that any number is
found by a short scan: about 2 + l bits a number in all, and no table of 64-bit
offsets.
"""

from __future__ import annotations

import struct
import zlib
from dataclasses import dataclass

import numpy as np

MAGIC = b"EFTOKENS"
EVERY = 64
STRETCH = 64 * EVERY
_HEAD = struct.Struct("<QQBII")  # count, universe, low bits, bytes of low part, bytes of high part
_FILE = struct.Struct("<8sBQQQq")  # magic, bytes of an id, documents, those without doc_id, ids, first doc_id


@dataclass
class Ascending:
    """Coded ascending numbers: ``select(i)`` finds one, ``all()`` decodes them."""

    count: int
    universe: int
    low_bits: int
    low: np.ndarray
    high: np.ndarray
    samples: np.ndarray

    @classmethod
    def of(cls, numbers: np.ndarray) -> Ascending:
        numbers = np.asarray(numbers, dtype=np.uint64)
        count = len(numbers)
        universe = int(numbers[-1]) + 1 if count else 0
        low_bits = max(0, (universe // count).bit_length() - 1) if count else 0
        places = (numbers >> np.uint64(low_bits)).astype(np.int64) + np.arange(count)
        marks = np.zeros(int(places[-1]) + 1 if count else 0, dtype=np.uint8)
        marks[places] = 1
        shifts = np.arange(low_bits, dtype=np.uint64)
        lows = ((numbers[:, None] >> shifts) & np.uint64(1)).astype(np.uint8)
        return cls(
            count, universe, low_bits,
            np.packbits(lows.ravel(), bitorder="little"), np.packbits(marks, bitorder="little"),
            places[::EVERY].astype("<u4"),
        )

    def _low(self, begin: int, end: int) -> np.ndarray:
        if not self.low_bits:
            return np.zeros(end - begin, dtype=np.uint64)
        first, last = begin * self.low_bits, end * self.low_bits
        bits = np.unpackbits(self.low[first // 8 : (last + 7) // 8], bitorder="little")
        bits = bits[first % 8 : first % 8 + last - first].reshape(-1, self.low_bits).astype(np.uint64)
        return bits @ (np.uint64(1) << np.arange(self.low_bits, dtype=np.uint64))

    def select(self, i: int) -> int:
        """The i-th number, reading the bits between two samples only."""
        return int(self.between(i, i + 1)[0])

    def between(self, first: int, last: int) -> np.ndarray:
        """Numbers from the first to before the last, reading the bits between their samples only."""
        if first >= last:
            return np.empty(0, np.uint64)
        begin = int(self.samples[first // EVERY])
        nxt = (last - 1) // EVERY + 1
        end = int(self.samples[nxt]) + 1 if nxt < len(self.samples) else 8 * len(self.high)
        bits = np.unpackbits(self.high[begin // 8 : (end + 7) // 8], bitorder="little")[begin % 8 :]
        places = begin + np.flatnonzero(bits)[first % EVERY : first % EVERY + last - first]
        high = (places - np.arange(first, last)).astype(np.uint64)
        return (high << np.uint64(self.low_bits)) + self._low(first, last)

    def all(self) -> np.ndarray:
        return self.between(0, self.count)

    def to_bytes(self) -> bytes:
        head = _HEAD.pack(self.count, self.universe, self.low_bits, len(self.low), len(self.high))
        return head + self.low.tobytes() + self.high.tobytes() + self.samples.tobytes()

    @classmethod
    def read(cls, data: memoryview, at: int) -> tuple[Ascending, int]:
        """From bytes at a place; also the place behind it."""
        count, universe, low_bits, n_low, n_high = _HEAD.unpack_from(data, at)
        at += _HEAD.size
        n_samples = -(-count // EVERY)
        low = np.frombuffer(data, np.uint8, n_low, at)
        high = np.frombuffer(data, np.uint8, n_high, at + n_low)
        samples = np.frombuffer(data, "<u4", n_samples, at + n_low + n_high)
        return cls(count, universe, low_bits, low, high, samples), at + n_low + n_high + 4 * n_samples


def pack(doc_ids: list[int | None], lengths: list[int], ids: bytes, id_bytes: int) -> bytes:
    """A token file: ascending documents (those without doc_id first), where each ends, all ids."""
    known = np.array([d for d in doc_ids if d is not None], dtype=np.int64)
    first = int(known[0]) if len(known) else 0
    # Differences of any two 64-bit numbers fit unsigned ones, which wrap alike.
    names = Ascending.of(known.view(np.uint64) - np.array([first], np.int64).view(np.uint64))
    ends = Ascending.of(np.cumsum(np.array(lengths, dtype=np.uint64), dtype=np.uint64))
    head = _FILE.pack(MAGIC, id_bytes, len(doc_ids), len(doc_ids) - len(known), len(ids) // id_bytes, first)
    return head + names.to_bytes() + ends.to_bytes() + ids


class TokenFile:
    """Reader of a packed file: any document's ids without decoding the others."""

    def __init__(self, data: bytes):
        view = memoryview(data)
        magic, self.id_bytes, self.n_docs, self.unnamed, self.n_ids, self.first = _FILE.unpack_from(view)
        if magic != MAGIC:
            raise ValueError("not a token file")
        self.names, at = Ascending.read(view, _FILE.size)
        self.ends, at = Ascending.read(view, at)
        self.ids = np.frombuffer(view, f"<u{self.id_bytes}", self.n_ids, at)

    def doc_id(self, i: int) -> int | None:
        if i < self.unnamed:
            return None
        return (self.names.select(i - self.unnamed) + self.first + (1 << 63)) % (1 << 64) - (1 << 63)

    def document(self, i: int) -> np.ndarray:
        return self.ids[self.ends.select(i - 1) if i else 0 : self.ends.select(i)]

    def rows(self):
        """doc_id, first id's place, number of ids and their crc32, of all documents in order.

        Boundaries are selected for a stretch of documents at a time: there is no table of them all.
        """
        begin = 0
        for at in range(0, self.n_docs, STRETCH):
            to = min(self.n_docs, at + STRETCH)
            unnamed = max(0, min(to, self.unnamed) - at)
            with np.errstate(over="ignore"):
                names = self.names.between(at + unnamed - self.unnamed, to - self.unnamed) if to > self.unnamed else []
                names = (names + np.array([self.first], np.int64).view(np.uint64)).view(np.int64) if len(names) else names
            ends = self.ends.between(at, to).astype(np.int64).tolist()
            for name, end in zip([None] * unnamed + list(map(int, names)), ends, strict=True):
                yield name, begin, end - begin, zlib.crc32(self.ids[begin:end].astype("<u4").tobytes())
                begin = end
