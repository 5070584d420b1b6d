"""Merging sorted lists of anchored suffixes by iterative interleave refinement.

A shard lists its suffixes in the order of what follows them, each with the bytes that precede it: its
Burrows-Wheeler transform. The merged order of all shards is refined: all suffixes of a group begin in one
interval, and each round splits every interval that still has two or more members by the next symbol (eight
bytes); only these members are sorted, by that symbol alone. The round and place at which two neighbours part is their common prefix.

Then the preceding bytes are read like the column of a transform: a step to the left keeps the order of the
suffixes within each byte (the last-to-first mapping), so each step refines the intervals by one byte, and
the common prefix of two neighbours of an interval is the least one between them in the merged order. After
``t`` steps two neighbours repeat a string of ``length`` if what follows agrees in ``length - t`` bytes.
"""

from __future__ import annotations

import numpy as np

SYMBOL = 8


class RangeMinimum:
    """Least value of any range, in constant time."""

    def __init__(self, values: np.ndarray):
        self.rows = [values]
        step = 1
        while 2 * step <= len(values):
            last = self.rows[-1]
            self.rows.append(np.minimum(last[:-step], last[step:]))
            step *= 2

    def get(self, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        """Minimum over first .. last (included)."""
        level = np.int64(np.log2(last - first + 1))
        out = np.empty(len(first), self.rows[0].dtype)
        for k in np.unique(level):
            at = level == k
            row = self.rows[k]
            out[at] = np.minimum(row[first[at]], row[last[at] - (1 << k) + 1])
        return out


def merged_order(group: np.ndarray, after: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows in merged order, and each one's common prefix (in bytes) with the row before it.

    ``group`` numbers the groups (grouped, ascending), ``after`` holds what follows each suffix, one row of
    bytes each. Rounds touch only intervals with two or more members.
    """
    m, width = after.shape
    symbols = np.ascontiguousarray(after).view(">u8").astype(np.uint64)
    order = np.arange(m)
    interval = np.concatenate([[0], np.cumsum(group[1:] != group[:-1])]) if m else np.empty(0, np.int64)
    common = np.full(m, width, np.int64)
    begins = np.ones(m, bool)
    begins[1:] = interval[1:] != interval[:-1]
    common[begins] = 0
    for depth in range(symbols.shape[1]):
        alone = begins & np.append(begins[1:], True)
        place = np.flatnonzero(~alone)
        if not len(place):
            break
        row = order[place]
        inside = np.cumsum(begins)[place]
        by = np.lexsort((symbols[row, depth], inside))
        order[place] = row = row[by]
        word = symbols[row, depth]
        parts = ~begins[place]  # neighbours of one interval that differ here
        parts[1:] &= word[1:] != word[:-1]
        parts[:1] = False
        at = np.flatnonzero(parts)
        odd = word[at] ^ word[at - 1]
        same = np.zeros(len(at), np.int64)
        for byte in range(1, SYMBOL):
            same += (odd >> np.uint64(8 * (SYMBOL - byte))) == 0
        common[place[at]] = depth * SYMBOL + same
        begins[place[at]] = True
    return order, common


def repeated_offsets(
    group: np.ndarray, after: np.ndarray, before: np.ndarray, least: np.ndarray, most: np.ndarray, length: int
) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (row, t) for which the string of ``length`` that begins ``t`` bytes left of the row's suffix also
    begins ``t`` bytes left of another suffix of its group.

    ``before`` holds the preceding bytes, nearest first; a row is asked for t from ``least`` to ``most``.
    """
    order, common = merged_order(group, after)
    lowest = RangeMinimum(common)
    rank = np.arange(len(order))  # places in merged order; kept in (interval, place) order
    interval = np.cumsum(np.concatenate([[True], group[order][1:] != group[order][:-1]])) if len(order) else rank
    rows, steps = [], []
    for t in range(int(most.max(initial=-1)) + 1):
        if t:
            byte = before[order[rank], t - 1].astype(np.int64)
            by = np.argsort(interval * 256 + byte, kind="stable")
            rank, interval, byte = rank[by], interval[by], byte[by]
            new = np.ones(len(rank), bool)
            new[1:] = (interval[1:] != interval[:-1]) | (byte[1:] != byte[:-1])
            interval = np.cumsum(new)
        new = np.ones(len(rank), bool)
        new[1:] = interval[1:] != interval[:-1]
        alone = new & np.append(new[1:], True)
        go = ~alone & (most[order[rank]] >= t)
        rank, interval = rank[go], interval[go]
        if not len(rank):
            break
        pair = np.flatnonzero(interval[1:] == interval[:-1])
        agree = lowest.get(rank[pair] + 1, rank[pair + 1]) >= length - t
        hit = np.zeros(len(rank), bool)
        hit[pair[agree]] = True
        hit[pair[agree] + 1] = True
        found = order[rank[hit]]
        found = found[least[found] <= t]
        rows.append(found)
        steps.append(np.full(len(found), t))
    return (np.concatenate(rows), np.concatenate(steps)) if rows else (rank[:0], rank[:0])
