"""Exact medians per cluster and coordinate from a few counting passes over matrices of rows; nothing is ordered or shuffled.

A double's bits, turned so that they grow with the number, make a 64-bit key. A pass counts the keys of every range that still
holds a wanted rank in BINS equal parts; the part with the rank is the next range, so five passes find any rank. A range ends
sooner once it holds a single number, or so few rows that they are handed on themselves. Tasks hand on counts of fixed size.
"""

from __future__ import annotations

import numpy as np
from pyspark import RDD

from tidemark.functions.vectors import nearest_rows

BITS = 14  # of the number of parts a range is cut into
FEW = 1 << 14  # rows of a range that tasks hand on
SIGN = np.uint64(1 << 63)


def keys_of(x: np.ndarray) -> np.ndarray:
    bits = (np.ascontiguousarray(x) + 0.0).view(np.uint64)  # + 0.0: there is one zero
    return np.where(bits & SIGN, ~bits, bits | SIGN)


def number_of(key: int) -> float:
    bits = np.uint64(key)
    return float((bits ^ SIGN if bits & SIGN else ~bits).view(np.float64))


def limits(blocks: RDD) -> list[tuple[int, int] | None]:
    """(least, greatest) key of every coordinate; None without a number."""

    def run(parts):
        found: list = []
        for block in parts:
            found = found or [None] * block.shape[1]
            for i, column in enumerate(block.T):
                keys = keys_of(column[~np.isnan(column)])
                if len(keys):
                    found[i] = wider(found[i], (int(keys.min()), int(keys.max())))
        yield found

    return blocks.mapPartitions(run).treeReduce(lambda a, b: [wider(x, y) for x, y in zip(a, b, strict=True)] if a and b else a or b)


def wider(one, two):
    return (min(one[0], two[0]), max(one[1], two[1])) if one and two else one or two


def shift_of(low: int, high: int) -> int:
    return max(0, (high - low).bit_length() - BITS)


def counted(blocks: RDD, centers, ranges: dict) -> dict:
    """What lies in the ranges (word, i, low, high) -> rows or None (unknown): (least, greatest key, counts of parts or the keys)."""
    book = np.asarray(centers, dtype=float)

    def run(parts):
        out: dict = {}
        for block in parts:
            word = nearest_rows(block, book, "l1")[0]
            mine = [np.flatnonzero(word == w) for w in range(len(book))]
            keys = {}
            for at in ranges:
                w, i, low, high = at
                if (w, i) not in keys:
                    x = block[mine[w], i]
                    keys[w, i] = keys_of(x[~np.isnan(x)])
                held = keys[w, i]
                held = held[(held >= np.uint64(low)) & (held <= np.uint64(high))]
                if len(held):
                    part = held if few(ranges[at]) else np.bincount(
                        ((held - np.uint64(low)) >> np.uint64(shift_of(low, high))).astype(np.int64), minlength=1 << BITS
                    )
                    out[at] = added(out.get(at), (int(held.min()), int(held.max()), part), few(ranges[at]))
        yield out

    def together(a, b):
        return {at: added(a.get(at), b.get(at), few(ranges[at])) for at in a.keys() | b.keys()}

    return blocks.mapPartitions(run).treeReduce(together)


def few(rows: int | None) -> bool:
    return rows is not None and rows <= FEW


def added(one, two, listed: bool):
    if one is None or two is None:
        return one or two
    return *wider(one[:2], two[:2]), np.concatenate([one[2], two[2]]) if listed else one[2] + two[2]


def cluster_medians(blocks: RDD, centers, bounds: list) -> dict[tuple[int, int], float]:
    """(word, i) -> median of coordinate i of the rows nearest to center `word` by L1; numbers that are missing do not count.

    `bounds` are the `limits` of the coordinates.
    """
    found: dict = {}
    # A wanted rank (word, i, which of the middle two) -> its range, the rank within it, and the rows in it.
    wanted = {
        (w, i, side): ((w, i, *bound), None, None)
        for w in range(len(centers)) for i, bound in enumerate(bounds) if bound for side in (0, 1)
    }
    while wanted:
        held, left = counted(blocks, centers, {at: rows for at, _, rows in wanted.values()}), {}
        for name, (at, rank, rows) in wanted.items():
            if at not in held:  # no row is nearest to this center
                continue
            (least, greatest, part), (w, i, low, high) = held[at], at
            if rank is None:
                rank = (int(part.sum()) + 1 + name[2]) // 2
            if least == greatest:
                found[name] = number_of(least)
            elif few(rows):
                found[name] = number_of(int(np.partition(part, rank - 1)[rank - 1]))
            else:
                upto, shift = part.cumsum(), shift_of(low, high)
                bin_ = int(np.searchsorted(upto, rank))
                start = low + (bin_ << shift)
                if shift == 0:
                    found[name] = number_of(start)
                else:
                    span = (max(start, least), min(start + (1 << shift) - 1, greatest))
                    left[name] = (w, i, *span), rank - int(upto[bin_] - part[bin_]), int(part[bin_])
        wanted = left
    return {(w, i): (found[w, i, 0] + found[w, i, 1]) / 2 for w, i, side in found if side == 0}
