"""Burrows-Wheeler transforms of small collections of strings, and their merge.

A collection's transform holds, for all suffixes of all strings in sorted
order, the byte before each suffix. The end of string i sorts before any byte
and before the end of string i + 1. ``merge`` finds equal windows across the
transforms of several shards without sorting their suffixes again: it only
steps through the transforms. All functions are plain numpy on one cell of
bounded size.
"""

from __future__ import annotations

import numpy as np

#: Bytes that the first sorting key of a suffix holds (9 bits each).
PACK = 7


def transform(strings: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(last, whole): the byte before each suffix in sorted order, and the rows
    whose suffix is a whole string (nothing is before it; ``last`` holds 0)."""
    count = len(strings)
    x = np.frombuffer(b"\0".join(strings) + b"\0", dtype=np.uint8).astype(np.int64) + 1
    size = np.fromiter(map(len, strings), dtype=np.int64, count=count)
    ends = np.cumsum(size + 1) - 1
    x[ends] = 0
    n = len(x)
    # bytes up to the string's end, zeros behind it
    left = np.repeat(ends, size + 1) - np.arange(n)
    padded = np.concatenate([x, np.zeros(PACK, dtype=np.int64)])
    key = np.zeros(n, dtype=np.int64)
    for i in range(PACK):
        key = (key << 9) | np.where(left >= i, padded[i:n + i], 0)
    order = np.argsort(key, kind="stable")
    # a key that reaches an end is a whole suffix: ties go by string
    fresh = np.concatenate([[True], (key[order][1:] != key[order][:-1]) | (left[order][1:] < PACK)])
    rank = np.empty(n, dtype=np.int64)
    rank[order] = np.maximum.accumulate(np.where(fresh, np.arange(n), 0))
    step = PACK
    open_rows = order[_in_groups(fresh)]
    while len(open_rows):  # ranks are first rows of groups; only groups of several are sorted on
        key = (rank[open_rows] << 32) | rank[open_rows + step]
        by = np.argsort(key, kind="stable")
        open_rows, key = open_rows[by], key[by]
        group = key >> 32
        at = np.arange(len(key))
        first = np.maximum.accumulate(np.where(np.concatenate([[True], group[1:] != group[:-1]]), at, 0))
        fresh = np.concatenate([[True], key[1:] != key[:-1]])
        rank[open_rows] = group + np.maximum.accumulate(np.where(fresh, at, 0)) - first
        open_rows = open_rows[_in_groups(fresh)]
        step *= 2
    place = np.empty(n, dtype=np.int64)
    place[rank] = np.arange(n)
    starts = ends - size
    last = (x[place - 1] - 1).astype(np.uint8)
    whole = rank[starts]
    last[whole] = 0
    return last, whole


def _in_groups(fresh: np.ndarray) -> np.ndarray:
    """Rows that are not alone in their group."""
    return ~(fresh & np.concatenate([fresh[1:], [True]]))


def stepping(last: np.ndarray, whole: np.ndarray) -> np.ndarray:
    """Row of the suffix that is one byte longer, per row (none for ``whole``)."""
    symbol = last.astype(np.uint16) + 1
    symbol[whole] = 0
    order = np.argsort(symbol, kind="stable")
    out = np.empty(len(last), dtype=np.int32)
    out[order] = np.arange(len(last), dtype=np.int32)
    return out


def merge(shards: list[tuple[np.ndarray, np.ndarray]], windows: list[np.ndarray], length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Equal windows of ``length`` bytes across the strings of all shards.

    ``windows``: per shard the number of windows of each string, i.e. its size
    less length - 1. Returns (block, string, window) for windows that another
    one equals; strings are counted through the shards.

    Iterative interleave refinement: round h holds the suffixes that begin h
    bytes before the windows' ends, interleaved from all shards in the order
    of their first h bytes, with a mark where the common prefix of neighbours
    is shorter than h. The next round is a stable distribution by the byte
    before; marks stay, and appear where that byte changes. A suffix that is
    alone between two marks can no longer equal another and leaves.
    """
    last, step, rows, string, window = [], [], [], [], []
    base = strings = 0
    for (one, whole), count in zip(shards, windows, strict=True):
        own = stepping(one, whole)
        at = np.arange(len(count), dtype=np.int32)  # the ends of strings are the first rows
        who = np.arange(len(count))
        for back in range(int(count.max(initial=0))):  # window ends from the last to the first
            alive = count[who] > back
            at, who = at[alive], who[alive]
            rows.append(at + base)
            string.append(who + strings)
            window.append(count[who] - 1 - back)
            at = own[at]
        last.append(one)
        step.append(own + base)
        base, strings = base + len(one), strings + len(count)
    last, step = np.concatenate(last), np.concatenate(step).astype(np.int32)
    rows, string, window = (np.concatenate(v).astype(np.int32) for v in (rows, string, window))
    me = np.arange(len(rows), dtype=np.int32)
    block = np.zeros(len(rows), dtype=np.int32)
    for done in range(1, length + 1):
        before = last[rows]
        by = np.argsort(before, kind="stable")
        before, block, me, rows = before[by], block[by], me[by], step[rows[by]]
        fresh = np.empty(len(rows), dtype=bool)
        fresh[:1] = True
        np.not_equal(before[1:], before[:-1], out=fresh[1:])
        fresh[1:] |= block[1:] != block[:-1]
        block = np.cumsum(fresh, dtype=np.int32)
        if done % 4 == 0 or done == length:
            kept = _in_groups(fresh)
            block, me, rows = block[kept], me[kept], rows[kept]
    return block, string[me], window[me]
