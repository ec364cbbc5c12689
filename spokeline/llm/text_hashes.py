"""Digests of words and of runs of words, many at a time."""

from __future__ import annotations

import numpy as np

LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
# Odd multipliers of 64-bit mixing (fixed values of a known finaliser).
_MIX = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))


def mix(x: np.ndarray) -> np.ndarray:
    """A one-to-one scrambling of 64-bit numbers."""
    x = x ^ (x >> np.uint64(30))
    x *= _MIX[0]
    x ^= x >> np.uint64(27)
    x *= _MIX[1]
    x ^= x >> np.uint64(31)
    return x


def words(text: str | None, lower: bool = False) -> list[bytes]:
    data = (text or "").encode()
    # White space of bytes is space and the controls 9 to 13.
    return (data.translate(LOWER) if lower else data).split()


class _Known(dict):
    """Digests of words seen lately."""

    def __missing__(self, word: bytes) -> int:
        import xxhash

        if len(self) > 1 << 19:
            self.clear()
        found = self[word] = xxhash.xxh3_64_intdigest(word)
        return found


_known = _Known()


def word_digests(found: list[bytes]) -> np.ndarray:
    """A 64-bit digest of each word's bytes, alike on every machine."""
    return np.fromiter(map(_known.__getitem__, found), dtype=np.uint64, count=len(found))


# An odd factor; fixed, so that digests agree between machines.
_FACTOR = np.uint64(0x9E3779B97F4A7C17)
# Longer words are digested one by one.
_LONG = 64
_FIRST = np.array([(1 << 8 * n) - 1 for n in range(9)], dtype=np.uint64)


def spans(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Where the words of UTF-8 text begin and end."""
    symbols = np.frombuffer(data, np.uint8)
    space = np.ones(len(data) + 2, dtype=bool)
    np.less(symbols - np.uint8(9), 5, out=space[1:-1])  # what is below 9 wraps
    space[1:-1] |= symbols == 32
    edges = np.flatnonzero(space[1:] != space[:-1])
    return edges[::2], edges[1::2]


def span_digests(data: bytes, begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit digest of the bytes of each span, alike on every machine, but others than ``word_digests``.

    Eight bytes at a time are mixed in one-to-one, so that spans of one length up to 8 never share a digest.
    """
    sizes = ends - begins
    padded = data + bytes(8)
    eights = np.ndarray((len(data) + 1,), "<u8", padded, strides=(1,))
    with np.errstate(over="ignore"):
        out = mix(sizes.astype(np.uint64) * _FACTOR)
        some, at = slice(None), 0
        while at < _LONG:
            left = sizes[some] - at
            word = eights[begins[some] + at] & _FIRST[np.minimum(left, 8)]
            out[some] = mix(out[some] * _FACTOR + word)
            at += 8
            some = np.flatnonzero((sizes > at) & (sizes <= _LONG))
            if not len(some):
                break
    long = np.flatnonzero(sizes > _LONG)
    if len(long):
        import xxhash

        at = zip(begins[long].tolist(), ends[long].tolist())
        out[long] = np.array([xxhash.xxh3_64_intdigest(data[b:e]) for b, e in at], dtype=np.uint64)
    return out


def runs(digests: np.ndarray, length: int, seed: int = 0) -> np.ndarray:
    """A digest of every ``length`` consecutive digests, in order."""
    n = len(digests) - length + 1
    if n <= 0:
        return np.empty(0, dtype=np.uint64)
    with np.errstate(over="ignore"):
        if seed:
            digests = mix(digests + np.uint64(seed))
        total = digests[:n].copy()
        for i in range(1, length):
            total *= _FACTOR
            total += digests[i : i + n]
        return mix(total)
