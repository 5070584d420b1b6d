"""Periodic runs of words by recompression.

The words of a batch of texts, each text ended by a letter of its own, are compressed level by level until one
letter is left: block compression makes every maximal stretch of one letter a letter (letter, times), pair
compression then joins every "left" letter with a "right" one after it. Both depend on the letters alone, so
equal stretches are parsed alike but for their borders, and each level has about three quarters of the letters of
the one before. Letters are exact names: two are equal only if their words are.

``Grammar.extend`` answers longest common extensions on these levels for many pairs of places at once. Two
places climb while both begin letters of the next level, step over equal letters (blocks in one step), and after
a difference come down again, so that a pair takes a few steps a level. Extensions to the left use the same
levels read backwards.

A run of period q and length 4q or more has equal words q apart over 3q places or more, so one of them is a
multiple of 3q. The candidates are therefore the places 0, 3q, 6q, ... of each text with an equal word q later,
for every q up to a quarter of the text: n/3 * (1 + 1/2 + 1/3 + ...) places. Each is extended exactly both ways.
A stretch found under several periods keeps the smallest, which divides the others.

Defined cases: a null or empty text has no words and no runs; a run reaches ``LEAST_WORDS`` words and
``LEAST_PERIODS`` periods; of equally long runs the one that starts first is the longest, then that of the
smallest period; a word that follows the first period of any run goes, whatever else it stands in. Memory is in
proportion to the batch or to its longest text. Repeated rows give repeated results, an empty table an empty one;
columns other than those named are not read.
"""

from __future__ import annotations

from collections.abc import Callable
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from driftwell.llm.blocks import constants, mix64, spans_to_mask
from driftwell.llm.table import per_batch

LEAST_WORDS = 6
LEAST_PERIODS = 4
GRID = LEAST_PERIODS - 1  # periods between candidates
AT_ONCE = 1 << 20  # candidates

U = np.uint64
RUNS = "array<struct<start:bigint,length:bigint,period:bigint>>"


def named(first: np.ndarray, second: np.ndarray, after: int) -> np.ndarray:
    """A number from ``after`` on for each pair, equal for equal pairs only."""
    order = np.lexsort((second, first))
    a, b = first[order], second[order]
    new = np.ones(len(a), np.int64)
    new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    out = np.empty(len(a), np.int64)
    out[order] = after + np.cumsum(new) - 1
    return out


class Level:
    """Letters of a level: where each begins (in words), its first child on the level below, its parent above, and
    how many equal letters follow with it (on levels that blocks are made from)."""

    def __init__(self, letters: np.ndarray, begin: np.ndarray, child: np.ndarray | None):
        self.letters, self.begin, self.child = letters, begin, child
        self.parent = self.first = self.left = None

    def climb(self, starts: np.ndarray, blocks: bool) -> None:
        """Parents begin at the letters ``starts``."""
        n = len(self.letters)
        mark = np.zeros(n, np.int64)
        mark[starts] = 1
        self.first = mark.astype(bool)
        self.parent = np.cumsum(mark) - 1
        if blocks:
            ends = np.append(starts[1:], n)
            self.left = ends[self.parent] - np.arange(n)

    def backwards(self, below: int, above: int, words: int) -> Level:
        """The same level of the reversed text."""
        n = len(self.letters)
        ends = np.append(self.begin[1:], words)
        child = None
        if self.child is not None:
            child = below - np.append(self.child[1:], below)[::-1]
        out = Level(self.letters[::-1], words - ends[::-1], child)
        if self.parent is not None:
            out.parent = above - 1 - self.parent[::-1]
            out.first = np.append(self.first[1:], True)[::-1]
            if self.left is not None:
                at = np.flatnonzero(self.first)
                out.left = (np.arange(n) - at[self.parent] + 1)[::-1]
        return out


class Grammar:
    """The levels over a row of letters whose last one occurs nowhere else."""

    def __init__(self, letters: np.ndarray):
        self.words = len(letters)
        letters = np.asarray(letters, np.int64)
        names = int(letters.max()) + 1 if len(letters) else 0
        self.levels = [Level(letters, np.arange(len(letters)), None)]
        blocks, turn = True, 0
        while len(letters) > 1:
            turn += 1
            last, n = self.levels[-1], len(letters)
            if blocks:
                starts = np.flatnonzero(np.append(True, letters[1:] != letters[:-1]))
                times = np.diff(np.append(starts, n))
                now = letters[starts]
                many = times > 1
                now[many] = named(now[many], times[many], names)
            else:
                side = (mix64(letters.astype(U) * constants("side", 1)[0] + U(turn)) >> U(40)) & U(1)
                left, right = side[:-1] == 0, side[1:] == 1
                joined = left & right
                other = ~left & ~right  # the sides may change places
                if other.sum() > joined.sum():
                    joined = other
                first = np.append(joined, False)
                second = np.append(False, joined)
                starts = np.flatnonzero(~second)
                now = letters[starts]
                many = first[starts]
                now[many] = named(now[many], letters[starts[many] + 1], names)
            if len(starts) < n:
                last.climb(starts, blocks)
                self.levels.append(Level(now, last.begin[starts], starts))
                letters = now
                names = max(names, int(now.max()) + 1)
            blocks = not blocks
        sizes = [0, *(len(level.letters) for level in self.levels), 0]
        self.reversed = [level.backwards(sizes[i], sizes[i + 2], self.words) for i, level in enumerate(self.levels)]

    def extend(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """For how many words the places ``i`` < ``j`` go on alike."""
        return self._extend(self.levels, i, j)

    def extend_left(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """How many words before the places ``i`` < ``j`` are alike."""
        out = np.zeros(len(i), np.int64)
        some = np.flatnonzero(i > 0)
        # places count from the end, so the later one comes first
        got = self._extend(self.reversed, self.words - j[some], self.words - i[some])
        out[some] = got
        return out

    def _extend(self, levels: list[Level], i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """``i`` < ``j``; ``j`` reaches the end of the row first."""
        out = np.zeros(len(i), np.int64)
        a, b, who = i.astype(np.int64), j.astype(np.int64), np.arange(len(i))
        stopped = []
        for level in levels:
            stops = []
            n = len(level.letters)
            ups = []
            while len(who):
                inside = b < n
                same = np.zeros(len(who), bool)
                same[inside] = level.letters[a[inside]] == level.letters[b[inside]]
                stops.append((who[~same], a[~same], b[~same]))
                who, a, b = who[same], a[same], b[same]
                if level.parent is not None:
                    up = level.first[a] & level.first[b]
                    ups.append((who[up], level.parent[a[up]], level.parent[b[up]]))
                    who, a, b = who[~up], a[~up], b[~up]
                a, b = _over(level, a, b)
            stopped.append([np.concatenate(x) for x in zip(*stops, strict=True)] if stops else None)
            if not ups:
                break
            who, a, b = (np.concatenate(x) for x in zip(*ups, strict=True))
        who = a = b = np.empty(0, np.int64)
        for k in range(len(stopped) - 1, -1, -1):
            level = levels[k]
            if stopped[k] is not None:
                who, a, b = (np.concatenate([x, y]) for x, y in zip((who, a, b), stopped[k], strict=True))
            if k:
                child = np.append(level.child, len(levels[k - 1].letters))
                a, b = child[a], child[b]
                below = levels[k - 1]
                n = len(below.letters)
                go = np.flatnonzero(b < n)
                while len(go):
                    go = go[below.letters[a[go]] == below.letters[b[go]]]
                    a[go], b[go] = _over(below, a[go], b[go])
                    go = go[b[go] < n]
            else:
                out[who] = a - i[who]
        return out


def _over(level: Level, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Past equal letters; past as much of a block as both have left."""
    if level.left is None:
        return a + 1, b + 1
    step = np.minimum(level.left[a], level.left[b])
    return a + step, b + step


def _grid(counts: np.ndarray, first: np.ndarray):
    """Candidates of texts with these numbers of words, in bounded parts: places and periods."""
    periods = counts // LEAST_PERIODS
    ends = np.cumsum(periods)
    total = int(ends[-1]) if len(ends) else 0
    for low in range(0, total, AT_ONCE):
        flat = np.arange(low, min(low + AT_ONCE, total))
        text = np.searchsorted(ends, flat, side="right")
        q = flat - (ends[text] - periods[text]) + 1
        places = -(-(counts[text] - q) // (GRID * q))
        cuts = np.cumsum(places)
        begin = 0
        while begin < len(q):  # a part has places of one period at least
            end = max(begin + 1, int(np.searchsorted(cuts, (cuts[begin - 1] if begin else 0) + AT_ONCE)))
            own = places[begin:end]
            step = np.arange(own.sum()) - np.repeat(np.cumsum(own) - own, own)
            each = np.repeat(q[begin:end], own)
            yield np.repeat(first[text[begin:end]], own) + step * GRID * each, each
            begin = end


def runs(texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Text, start, length and period of every run, in that order; ``texts`` are rows of numbers from 0 on."""
    counts = np.array([len(t) for t in texts], np.int64)
    none = np.empty(0, np.int64)
    long = np.flatnonzero(counts >= LEAST_WORDS)
    if not len(long):
        return none, none, none, none
    names = 1 + max(int(texts[t].max()) for t in long)
    letters = np.concatenate([x for k, t in enumerate(long) for x in (texts[t], [names + k])])
    counts = counts[long]
    first = np.cumsum(counts + 1) - counts - 1
    grammar = Grammar(letters)
    found = []
    for place, q in _grid(counts, first):
        same = letters[place] == letters[place + q]
        place, q = place[same], q[same]
        after = grammar.extend(place, place + q)
        before = grammar.extend_left(place, place + q)
        length = before + after + q
        good = length >= np.maximum(LEAST_WORDS, LEAST_PERIODS * q)
        found.append(np.stack([(place - before)[good], length[good], q[good]]))
    start, length, q = np.concatenate(found, axis=1)
    order = np.lexsort((q, length, start))
    start, length, q = start[order], length[order], q[order]
    new = np.ones(len(start), bool)
    new[1:] = (start[1:] != start[:-1]) | (length[1:] != length[:-1])
    start, length, q = start[new], length[new], q[new]
    at = np.searchsorted(first, start, side="right") - 1
    order = np.lexsort((q, start))
    return tuple(x[order] for x in (long[at], start - first[at], length, q))


class _Names(dict):
    def __missing__(self, word):
        self[word] = n = len(self)
        return n


Edit = Callable[[list[bytes], int], list[bytes]]


def word_runs(docs: DataFrame, edit: Edit | None = None, key: Column | None = None) -> DataFrame:
    """``doc_id``, ``n_words``, ``runs`` (by start, then period) and ``collapsed``, the words that are left when every
    run keeps its first period, joined by blanks. No shuffle.

    ``edit`` changes the words of the texts whose ``key`` (a whole number) is not null before the search."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", "text", (F.lit(None) if key is None else key).cast("long").alias("key"))

    def each(batch: pa.RecordBatch) -> pa.RecordBatch:
        names = _Names()
        # bytes.split takes exactly the six blanks of the word pattern
        words = [(t or b"").split() for t in batch.column(1).cast(pa.binary()).to_pylist()]
        if edit is not None:
            words = [w if k is None else edit(w, k) for w, k in zip(words, batch.column(2).to_pylist(), strict=True)]
        numbers = [np.fromiter(map(names.__getitem__, w), np.int64, len(w)) for w in words]
        text, start, length, q = runs(numbers)
        cuts = np.searchsorted(text, np.arange(len(words) + 1))
        left = []
        for t, w in enumerate(words):
            mine = slice(cuts[t], cuts[t + 1])
            if cuts[t] < cuts[t + 1]:
                gone = spans_to_mask(len(w), start[mine] + q[mine], start[mine] + length[mine])
                w = compress(w, (~gone).tolist())
            left.append(b" ".join(w))
        found = pa.StructArray.from_arrays([pa.array(x) for x in (start, length, q)], ["start", "length", "period"])
        columns = [
            batch.column(0),
            pa.array([len(w) for w in words], pa.int64()),
            pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), found),
            pa.array(left, pa.binary()).cast(pa.string()),
        ]
        return pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_words", "runs", "collapsed"])

    return rows.mapInArrow(per_batch(lambda: each), f"doc_id {kind}, n_words long, runs {RUNS}, collapsed string")
