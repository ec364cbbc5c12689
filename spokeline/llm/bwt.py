"""Burrows-Wheeler transforms of string collections, and their merge.

Symbols are bytes plus one; 0 ends a string. The i-th string's end is smaller than
the (i + 1)-th's, so no two suffixes are equal. UTF-8 has no byte above 244, so a
transform is an array of bytes.
"""

from __future__ import annotations

import numpy as np


def suffix_order(strings: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes of all strings in order, as places in their concatenation, and the symbols there.

    Ranks of as many first symbols as a number holds are doubled until all suffixes differ.
    """
    joined = np.frombuffer(b"\xff".join(strings) + b"\xff", np.uint8)
    symbols = joined + np.uint8(1)  # 255 wraps to 0
    ends = np.flatnonzero(symbols == 0)
    rank = symbols.astype(np.int64) + len(ends)
    rank[ends] = np.arange(len(ends))
    # No two ends are equal, so what follows one decides nothing.
    ranks = 256 + len(ends)
    width, key = 1, rank + 1
    while ranks ** (width + 1) < 1 << 63:
        key *= ranks
        key[:-width] += rank[width:] + 1
        width += 1
    while True:
        order = np.argsort(key)
        new = np.r_[0, np.cumsum(np.diff(key[order]) != 0)]
        if new[-1] == len(key) - 1:
            return order, symbols
        rank = np.empty_like(key)
        rank[order] = new
        key = rank * (len(rank) + 1)
        key[:-width] += rank[width:] + 1
        width *= 2


def transform(order: np.ndarray, symbols: np.ndarray) -> np.ndarray:
    """The symbol before each suffix, in suffix order; 0 before a whole string."""
    return symbols[order - 1]  # before the first string stands the last one's end


def _laid(shards: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Shards one after the other: symbols, the place of each suffix with the symbol before it, places of the ends.

    Nothing is before a whole string; such a place is a string's end.
    """
    every = np.concatenate(shards)
    before = np.empty(len(every), dtype=np.int32)
    ends, begin = [], 0
    for shard in shards:
        # Suffixes that begin with one symbol are in the order of what follows.
        before[begin + np.argsort(shard, kind="stable")] = np.arange(begin, begin + len(shard), dtype=np.int32)
        ends.append(np.arange(begin, begin + np.count_nonzero(shard == 0), dtype=np.int32))
        begin += len(shard)
    return every, before, np.concatenate(ends)


def merge(shards: list[np.ndarray], depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Interleave shards' transforms by the first ``depth`` symbols of their suffixes.

    Starts from the shards one after the other. A round looks at the two symbols
    before the suffixes in the present order and deals the suffixes that begin
    with them into buckets by these symbols, keeping their order: that is the order by
    two more symbols, and no suffix is sorted. (An odd depth has a first round of one
    symbol.) Suffixes of one block have agreed so far.
    Ends when a round breaks no block, or after ``depth`` symbols.

    Returns, in merged order, each suffix's place in the shards laid one after
    the other, and its block.
    """
    every, before, ends = _laid(shards)
    n = len(every)
    at, block, blocks = np.arange(n, dtype=np.int32), np.zeros(n, dtype=np.int32), 1
    # Suffixes that no round deals: ends, and those of one symbol where a round takes two.
    one, one_symbol = before[ends], every[ends].astype(np.uint16) << np.uint16(8)
    one, one_symbol = one[one_symbol > 0], one_symbol[one_symbol > 0]
    two = every[before].astype(np.uint16) << np.uint16(8) | every
    two[(every == 0) | (two < 256)] = 0
    twice = before[before]
    new_block = np.empty(n, dtype=bool)
    new_block[: len(ends) + 1] = True
    done = 0
    while done < depth:
        if (depth - done) % 2:
            symbol, source, of = every[at], before[at], block
            order = np.argsort(symbol, kind="stable")[len(ends) :]
            done += 1
        else:
            symbol = np.concatenate([one_symbol, two[at]])
            source = np.concatenate([one, twice[at]])
            of = np.concatenate([np.arange(-len(one), 0, dtype=np.int32), block])
            order = np.argsort(symbol, kind="stable")[len(ends) + len(one) :]
            done += 2
        at = np.concatenate([ends, source[order]])
        symbol, of = symbol[order], of[order]
        np.not_equal(of[1:], of[:-1], out=new_block[len(ends) + 1 :])
        new_block[len(ends) + 1 :] |= symbol[1:] != symbol[:-1]
        block = np.cumsum(new_block, dtype=np.int32) - np.int32(1)
        if block[-1] + 1 == blocks:
            break
        blocks = int(block[-1]) + 1
    return at, block


def walk(shards: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each suffix of the shards: its string and the symbols left in it; and all strings' lengths.

    Strings are numbered through all shards. All are walked backwards at once,
    from their ends to their beginnings.
    """
    every, before, now = _laid(shards)
    number = np.arange(len(now))
    string = np.empty(len(every), dtype=np.int32)
    left = np.empty(len(every), dtype=np.int32)
    length = np.zeros(len(now), dtype=np.int64)
    steps = 0
    while len(now):
        string[now], left[now] = number, steps
        whole = every[now] == 0
        length[number[whole]] = steps
        now, number = before[now[~whole]], number[~whole]
        steps += 1
    return string, left, length
