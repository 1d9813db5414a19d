"""Runs: stretches of words that repeat with a period, as maximal pairs of an LCP-interval tree.

The suffixes of a text are sorted over its words, and the intervals of equal prefixes are visited bottom-up. A node
holds the places of its suffixes in order, classed by the word on their left: a *head* is a place whose left word
is another than that of the place before. Where two children of a node of depth ``l`` meet, places ``i < j`` of different
left words are a maximal pair: ``l`` words agree behind both, and no more on either side. If ``j - i <= l`` the two
copies touch or overlap, so the words from ``i`` to ``j + l`` are a stretch of period ``j - i`` that no neighbouring
word extends: a run, without any extension. Of pairs that give the same stretch, the least distance is its period.

Only places within ``l`` of each other are asked for. Places of one left word that follow each other are passed over
at once, by the next head; what lies between them is then a pair, and the pairs so found are at most in proportion to
the words, as the sum of all exponents is. The smaller child goes into the larger one. Runs of at least ``least`` words need
pairs of depth ``least / 2``, so a text in which no such prefix comes twice has no tree at all.

Memory is in proportion to one text; rows don't depend on each other.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right, insort
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, functions as F

LEAST = 12
_ODD = 0x9E3779B97F4A7C15

#: Start, length, period; all in words.
Run = tuple[int, int, int]
#: Places in order, and those of them that are heads.
Node = tuple[list[int], list[int]]


def word_numbers(words: Sequence[bytes]) -> np.ndarray:
    seen: dict[bytes, int] = {}
    return np.fromiter((seen.setdefault(w, len(seen)) for w in words), np.int64, len(words))


def _prefix_hashes(numbers: np.ndarray, depth: int) -> np.ndarray:
    """A hash of the ``depth`` words at each place that has as many; equal words have equal hashes."""
    count = len(numbers) - depth + 1
    mixed = (numbers.astype(np.uint64) + np.uint64(1)) * np.uint64(_ODD)
    mixed ^= mixed >> np.uint64(29)
    total = np.zeros(count, np.uint64)
    for k in range(depth):
        total = total * np.uint64(0xD1342543DE82EF95) + mixed[k : k + count]
    return total


def suffix_order(numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places in the order of their suffixes, and the rank of each place; prefixes double until all ranks differ."""
    n, step = len(numbers), 1
    rank = numbers.astype(np.int64)
    while True:
        key = rank * (n + 1)
        key[: n - step] += rank[step:] + 1
        order = np.argsort(key)
        ordered = key[order]
        rank = np.empty(n, np.int64)
        rank[order] = np.concatenate(([0], np.cumsum(ordered[1:] != ordered[:-1])))
        if rank[order[-1]] == n - 1 or step >= n:
            return order, rank
        step *= 2


def _common(numbers: np.ndarray, order: np.ndarray, rank: np.ndarray, hashes: np.ndarray) -> list[int]:
    """Words each suffix shares with the one before it in order, where their first ones may agree; 0 elsewhere."""
    n, words = len(numbers), numbers.tolist()
    shared, before = [0] * n, order[:-1]
    fits = (order[1:] < len(hashes)) & (before < len(hashes))
    near = np.zeros(n, bool)
    near[1:][fits] = hashes[order[1:][fits]] == hashes[before[fits]]
    places = np.sort(order[near])
    same, last = 0, -2
    for i, r, j in zip(places.tolist(), rank[places].tolist(), order[rank[places] - 1].tolist()):
        # the next suffix shares one word less with its own neighbour at least
        same = same - 1 if i == last + 1 and same else 0
        most = n - max(i, j)
        while same < most and words[i + same] == words[j + same]:
            same += 1
        shared[r], last = same, i
    return shared


class _Tree:
    """Bottom-up visit of the intervals of depth ``depth`` or more."""

    def __init__(self, left: list[int], least: int):
        self._left, self._least = left, least
        self.found: dict[tuple[int, int], int] = {}

    def visit(self, order: list[int], shared: list[int], depth: int) -> None:
        open_: list[tuple[int, Node]] = []  # intervals that may still grow, by depth
        node: Node = ([order[0]], [order[0]])
        for place, l in zip([*order[1:], -1], [*shared[1:], 0]):
            l = l if l >= depth else 0
            while open_ and open_[-1][0] > l:
                deeper, others = open_.pop()
                node = self._merged(others, node, deeper)
            if l:
                if open_ and open_[-1][0] == l:
                    node = self._merged(open_.pop()[1], node, l)
                open_.append((l, node))
            node = ([place], [place])

    def _merged(self, a: Node, b: Node, depth: int) -> Node:
        small, large = (a, b) if len(a[0]) < len(b[0]) else (b, a)
        for i in small[0]:
            self._pairs(i, large, depth)
        for i in small[0]:
            self._insert(i, large)
        return large

    def _pairs(self, i: int, node: Node, depth: int) -> None:
        places, heads = node
        left, own, end = self._left, self._left[i], i + depth
        at, count = bisect_left(places, i - depth), len(places)
        while at < count and places[at] <= end:
            j = places[at]
            if left[j] == own:
                next_head = bisect_right(heads, j)
                if next_head == len(heads):
                    return
                at = bisect_left(places, heads[next_head], at)
                continue
            period = abs(i - j)
            if period + depth >= self._least:
                stretch = min(i, j), max(i, j) + depth
                known = self.found.get(stretch)
                if known is None or period < known:
                    self.found[stretch] = period
            at += 1

    def _insert(self, i: int, node: Node) -> None:
        places, heads = node
        left = self._left
        at = bisect_left(places, i)
        if at < len(places):
            following = places[at]
            was = at == 0 or left[places[at - 1]] != left[following]
            now = left[i] != left[following]
            if was != now:
                if now:
                    insort(heads, following)
                else:
                    del heads[bisect_left(heads, following)]
        if at == 0 or left[places[at - 1]] != left[i]:
            insort(heads, i)
        places.insert(at, i)


def find_runs(words: Sequence[bytes], least: int = LEAST) -> list[Run]:
    """Every run of the words of at least ``least`` words and two periods, by start and then period."""
    if least < 2:
        raise ValueError("a run has two words at least")
    depth = (least + 1) // 2
    if len(words) < max(least, 2):
        return []
    numbers = word_numbers(words)
    hashes = _prefix_hashes(numbers, depth)
    ordered = np.sort(hashes)
    if not (ordered[1:] == ordered[:-1]).any():
        return []
    order, rank = suffix_order(numbers)
    shared = _common(numbers, order, rank, hashes)
    tree = _Tree([-1, *numbers[:-1].tolist()], least)
    deep = np.flatnonzero(np.array(shared) >= depth)
    places = order.tolist()
    # consecutive ranks of deep suffixes are one subtree, with the suffix before them
    for group in np.split(deep, np.flatnonzero(np.diff(deep) > 1) + 1):
        if len(group):
            first, last = int(group[0]) - 1, int(group[-1]) + 1
            tree.visit(places[first:last], shared[first:last], depth)
    return sorted(((s, e - s, p) for (s, e), p in tree.found.items()), key=lambda r: (r[0], r[2]))


def collapsed(words: Sequence[bytes], runs: Sequence[Run]) -> bytes:
    """The words that no run holds behind its first period, joined by one blank."""
    if not runs:
        return b" ".join(words)
    change = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        change[start + period] += 1
        change[start + length] -= 1
    return b" ".join([words[i] for i in np.flatnonzero(np.cumsum(change[:-1]) == 0)])


def periodic(text: Column, least: int = LEAST) -> Column:
    """Struct of ``runs`` (array of start, length, period, as ``find_runs``) and ``collapsed`` (the text without repeats).

    Words are parted by \\x20 and \\x09-\\x0D. Null and empty texts have no run and collapse to an empty text. Each row stands for
    itself, so repeated rows, other columns and their names don't matter.
    """

    @F.arrow_udf("struct<runs:array<struct<start:bigint,length:bigint,period:bigint>>,collapsed:string>")
    def of(texts: pa.Array) -> pa.Array:
        rows, ends, kept = [], [0], []
        for value in _texts(texts):
            words = value.split()
            runs = find_runs(words, least)
            rows += runs
            ends.append(len(rows))
            kept.append(collapsed(words, runs))
        columns = np.array(rows, np.int64).reshape(-1, 3)
        parts = pa.StructArray.from_arrays([pa.array(columns[:, k]) for k in range(3)], ["start", "length", "period"])
        lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), parts)
        return pa.StructArray.from_arrays([lists, pa.array(kept, pa.binary()).cast(pa.string())], ["runs", "collapsed"])

    return of(text.cast("binary"))


def _texts(column: pa.Array) -> Iterator[bytes]:
    return (value.as_py() or b"" for value in column)


def listed(runs: Column) -> Column:
    """``start,length,period`` and a line feed for every run."""
    line = lambda r: F.concat(r["start"], F.lit(","), r["length"], F.lit(","), r["period"], F.lit("\n"))
    return F.array_join(F.transform(runs, line), "")


def longest(runs: Column) -> Column:
    """The run of greatest length, then smallest start, then smallest period; null without a run."""
    ordered = F.array_max(F.transform(runs, lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("s"), (-r["period"]).alias("p"))))
    return F.when(F.size(runs) > 0, F.struct((-ordered["s"]).alias("start"), ordered["length"].alias("length"), (-ordered["p"]).alias("period")))
