"""Periodic run detection by maximal pairs (operator 13).

A run is a stretch of consecutive words with smallest period q that holds q three times or
more (``min_periods``) and ``min_words`` words or more, and that no neighbouring word extends
with period q.  Two occurrences i < j of a stretch of l words form a maximal pair if the words
before them differ and the words after them differ; then the words [i, j + l) have period
j - i and cannot be extended, so the maximal pairs whose distance is short enough for their
length are exactly the runs (a multiple of the smallest period names the same stretch and
loses to it).  They are read off the LCP-interval tree, bottom up: every interval keeps its
positions by the word on their left, and when two intervals meet only positions of different
left words, close enough to each other, are paired.

Only intervals of l >= 16 words can hold a run of 24, so texts without a repeated stretch of
16 words (found by a rolling hash, which can only send too many texts on) are done at once.
Each text is worked on by itself, whole; Spark deals out the rows and nothing is shuffled.

Nulls and edges: a null or blank text has no words, no runs and the collapsed text '';
texts of any length are taken whole; rows are independent, so ties and repeated rows need
nothing; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right, insort
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from .common import slices

BATCH_CHARS = 2_000_000
RUNS_TYPE = "struct<n_words:long,runs:array<struct<start:long,length:long,period:long>>,collapsed:string>"

Run = tuple[int, int, int]


def words_of(text: str | None) -> list[bytes]:
    """The words ``[^\\x20\\x09-\\x0D]+`` of a text, as UTF-8."""
    return (text or "").encode("utf-8", "replace").split()


def shortest_pair(min_words: int, min_periods: int) -> int:
    """Fewest words that a maximal pair's two stretches share if it is a run."""
    shared = 1
    while shared + shared // (min_periods - 1) < min_words:
        shared += 1
    return max(shared, min_periods - 1)


def repeating(texts: list[list[bytes]], window: int) -> np.ndarray:
    """For each text, whether some stretch of ``window`` words may stand in it twice."""
    sizes = np.array([len(t) for t in texts], np.int64)
    found = np.zeros(len(texts), bool)
    n = int(sizes.sum())
    if n < window:
        return found
    rolled = np.fromiter((hash(w) for t in texts for w in t), np.int64, n).astype(np.uint64)
    width = 1
    while width * 2 <= window:
        rolled = rolled[:-width] * np.uint64(0x9E3779B97F4A7C15 + 2 * width) + rolled[width:]
        width *= 2
    doc = np.repeat(np.arange(len(texts)), sizes)[:len(rolled)]
    inside = np.arange(len(rolled)) + width <= np.cumsum(sizes)[doc]
    doc = doc[inside]
    keys = rolled[inside] ^ (doc.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
    order = np.argsort(keys)
    same = keys[order[1:]] == keys[order[:-1]]
    found[doc[order[1:][same]]] = True
    return found


def suffix_tree_leaves(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes of ``ids`` in order, and how many ids each shares with the one before."""
    n = len(ids)
    levels, width = [np.unique(ids, return_inverse=True)[1].astype(np.int64)], 1
    while width < n and levels[-1].max() < n - 1:
        rank = levels[-1]
        after = np.zeros(n, np.int64)
        after[:-width] = rank[width:] + 1
        levels.append(np.unique(rank * (n + 1) + after, return_inverse=True)[1])
        width *= 2
    order = np.argsort(levels[-1], kind="stable")
    i, j = order[:-1].copy(), order[1:].copy()
    shared = np.zeros(n, np.int64)
    for k in range(len(levels) - 1, -1, -1):
        rank = np.append(levels[k], -1)
        step = np.where((rank[np.minimum(i, n)] == rank[np.minimum(j, n)]) & (i < n) & (j < n), 1 << k, 0)
        shared[1:] += step
        i += step
        j += step
    return order, shared


class Interval:
    """An LCP interval: its positions in order, and in order for each word on their left."""

    __slots__ = ("places", "classes")

    def __init__(self, place: int, left: int):
        self.places, self.classes = [place], {left: [place]}


def meet(a: Interval, b: Interval, shared: int, reach: int, left: list[int], pairs: list[Run]) -> Interval:
    """Unite two children of an interval of ``shared`` words and note the maximal pairs between them.

    Places within ``reach`` (half of ``shared`` at most) of one another repeat with one period,
    so all but the first have the same left word: two classes at most need a look.
    """
    if len(a.places) < len(b.places):
        a, b = b, a
    places, classes = a.places, a.classes
    for x in b.places:
        lo, hi = bisect_left(places, x - reach), bisect_right(places, x + reach)
        if lo == hi:
            continue
        for c in {left[places[lo]], left[places[hi - 1]]}:
            if c != left[x]:
                own = classes[c]
                for y in own[bisect_left(own, x - reach):bisect_right(own, x + reach)]:
                    i, j = (x, y) if x < y else (y, x)
                    pairs.append((i, j - i + shared, j - i))
    for x in b.places:
        insort(places, x)
    for c, own in b.classes.items():
        if c in classes:
            for x in own:
                insort(classes[c], x)
        else:
            classes[c] = own
    return a


def maximal_pairs(order: list[int], shared: list[int], left: list[int], min_words: int, min_periods: int) -> list[Run]:
    """(start, length, distance) of the maximal pairs that are long enough for their distance."""
    pairs: list[Run] = []
    least = shortest_pair(min_words, min_periods)

    def unite(a: Interval, b: Interval, words: int) -> Interval:
        return meet(a, b, words, words // (min_periods - 1), left, pairs)

    open_: list[list] = []  # the intervals that a later suffix may join, the longest last
    node: Interval | None = None
    for place, words in zip(order, shared):
        if words < least:
            while open_:
                depth, first = open_.pop()
                node = unite(first, node, depth)
        else:
            while open_ and open_[-1][0] > words:
                depth, first = open_.pop()
                node = unite(first, node, depth)
            if open_ and open_[-1][0] == words:
                open_[-1][1] = unite(open_[-1][1], node, words)
            else:
                open_.append([words, node])
        node = Interval(place, left[place])
    while open_:
        depth, first = open_.pop()
        node = unite(first, node, depth)
    return [p for p in pairs if p[1] >= min_words]


def runs_of(texts: list[list[bytes]], min_words: int = 24, min_periods: int = 3) -> list[list[Run]]:
    """The runs (start, length, period) of each text's words, by start, then period."""
    if min_periods < 3:
        raise ValueError("a run holds its period three times or more")
    found: list[list[Run]] = [[] for _ in texts]
    chosen = np.flatnonzero(repeating(texts, shortest_pair(min_words, min_periods))).tolist()
    if not chosen:
        return found
    ids, left, begins = [], [], []
    for k in chosen:  # the texts one after another; no word of one equals a word of another
        number: dict[bytes, int] = {}
        base = len(ids)
        begins.append(base)
        ids += [base + number.setdefault(w, len(number)) for w in texts[k]]
        left += [-1, *ids[base:-1]]
    order, shared = suffix_tree_leaves(np.array(ids, np.int64))
    best: dict[tuple[int, int], int] = {}
    for start, length, period in maximal_pairs(order.tolist(), shared.tolist(), left, min_words, min_periods):
        if period < best.get((start, length), period + 1):
            best[start, length] = period
    places = np.array(begins)
    for (start, length), period in best.items():
        k = int(np.searchsorted(places, start, "right")) - 1
        found[chosen[k]].append((start - begins[k], length, period))
    for k in chosen:
        found[k].sort(key=lambda r: (r[0], r[2]))
    return found


def collapse(words: list[bytes], runs: list[Run]) -> str:
    """The words outside runs and the first period of every run, joined by spaces."""
    if runs:
        keep = np.ones(len(words), bool)
        for start, length, period in runs:
            keep[start + period:start + length] = False
        words = [w for w, k in zip(words, keep.tolist()) if k]
    return b" ".join(words).decode()


def periodic_runs(text: Column, min_words: int = 24, min_periods: int = 3) -> Column:
    """``n_words``, ``runs`` (start, length and period in words, by start, then period) and the
    ``collapsed`` text: every run keeps its first period, unless another run drops its words."""

    @F.pandas_udf(RUNS_TYPE)
    def apply(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = batch.tolist()
            n_words, runs, collapsed = [], [], []
            for lo, hi in slices([len(t or "") for t in texts], BATCH_CHARS):
                split = [words_of(t) for t in texts[lo:hi]]
                for words, own in zip(split, runs_of(split, min_words, min_periods)):
                    n_words.append(len(words))
                    runs.append([{"start": s, "length": n, "period": q} for s, n, q in own])
                    collapsed.append(collapse(words, own))
            yield pd.DataFrame({"n_words": n_words, "runs": pd.Series(runs, dtype=object), "collapsed": pd.Series(collapsed, dtype=object)})

    return apply(text)
