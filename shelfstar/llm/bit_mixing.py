"""Language-model scores by logistic context mixing over the bits of word codes.

Every word of the training texts is counted. The most frequent ones, as many as a table of ``TABLE_BYTES`` holds, have
a Huffman code each, and so have the end of a text and an escape for any other word; other words are spelled in bytes with codes of
their own, each distinct one once. So a text is a sequence of bits, each at a node of a code tree, and its
probability is the product of the probabilities of its bits. Divided by the text's bytes their logarithms are bits per byte.

A bit is predicted from several contexts, each the symbols at some distances before: context and node are
hashed to a place, and the zeros and ones that all training texts have there give a log odds. One more predictor has counts of
the text itself, from its start to the block before. A mixer adds the log odds with weights that a gate selects: the
longest context with evidence, whether the text itself has any, and the depth in the tree. The sum is refined by an
adaptive map from (gate, sum) to a probability. Weights, map and own counts start from the fitted ones with every text
and are updated after each block of it, blocks being short at its start. A text's score depends on that text and the model alone.

A model is fitted in passes: words; places over all training texts but every ``TUNE``-th; weights (Newton steps) and map over those,
which the places have not seen; then their places are added to the others. Tables of places have a fixed size and are what is
broadcast (``PLACES`` bytes a context); sums go through a shuffle, with salted keys first where tasks are many. Texts of a task
move on together, block by block, as array operations.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass, replace
from itertools import repeat
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..session import estimated_bytes
from .common import written

#: Distances of the symbols that make a context, one after the other: of words, and of the bytes of a spelled word.
WORD_CONTEXTS: tuple[tuple[int, ...], ...] = ((), (1,), (1, 2))
BYTE_CONTEXTS: tuple[tuple[int, ...], ...] = ((), (1,), (1, 2), (1, 2, 3))
#: Places of a context's table, and of a text's or a word's own counts.
PLACES, WORD_OWN, BYTE_OWN = 1 << 21, 1 << 12, 1 << 6
#: Bytes of the word table (a word weighs its bytes and ``ENTRY``), its longest word, and what a counting task holds.
TABLE_BYTES, ENTRY, LONGEST, HELD, HELD_BYTES = 32 << 20, 64, 256, 400_000, 32 << 20
#: Every which training text the weights are fitted on, in how many rounds, and the bytes a task counts places of.
TUNE, ROUNDS, TASK_BYTES = 16, 2, 32 << 20
#: Texts and bytes that move on together; symbols of a text's first and longest block.
TEXTS, TEXT_BYTES, FIRST_BLOCK, LONGEST_BLOCK = 4096, 1 << 20, 16, 512
#: Step of the weights, decisions that a map's start weighs, and weight of the last round in a Newton step.
STEP, MAP_START, RIDGE = 0.5, 64.0, 200.0

_DEPTHS = np.array([0, 1, 2, 2, 3, 3, 3, 3] + [4] * 8 + [5], np.uint32)
_STEPS, _SCALE, _CHUNK, _FIXED, _ROWS, _SORTED = 33, 16.0, 1 << 16, 1 << 20, 1 << 13, 1 << 20
_TURN = np.uint32(0x9E3779B1)
_SPACE = re.compile(rb"[\x20\x09-\x0D]")
_PIECE = 1 << 20


def words_in(text: bytes) -> Iterator[list[bytes]]:
    """The words of a text, A-Z lowered, some megabyte at a time."""
    start = 0
    while start < len(text):
        end = _SPACE.search(text, start + _PIECE) if len(text) - start > _PIECE else None
        stop = end.start() if end else len(text)
        yield text[start:stop].lower().split()
        start = stop


def huffman(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Parent and side of each entry of a binary tree over ``counts``; leaves come first, the root last, without a parent (-1).

    Equal counts are taken in their order, so the tree depends on the counts alone.
    """
    many = len(counts)
    order = np.argsort(counts, kind="stable")
    leaves, weights = order.tolist(), counts[order].tolist()
    parent, side, sums = [-1] * (2 * many - 1), bytearray(2 * many - 1), []
    first, inner = 0, 0
    for made in range(many, 2 * many - 1):
        total = 0
        for turn in (0, 1):
            if inner >= len(sums) or first < many and weights[first] <= sums[inner]:
                child, first, total = leaves[first], first + 1, total + weights[first]
            else:
                child, inner, total = many + inner, inner + 1, total + sums[inner]
            parent[child], side[child] = made, turn
        sums.append(total)
    return np.array(parent, np.int64), np.frombuffer(bytes(side), np.uint8)


class Codes:
    """Paths of symbols through a Huffman tree of their counts."""

    def __init__(self, counts: np.ndarray, contexts: Sequence[Sequence[int]], own: int):
        parent, side = huffman(np.asarray(counts, np.int64))
        self._tree = parent.astype(np.int32), side
        self.contexts, self.own = [tuple(c) for c in contexts], own
        self.levels, self.gates, self.inputs = 2 * len(contexts), 12 * len(contexts), len(contexts) + 2
        self.cells = self.levels * _STEPS
        self.scales = [1 / _SCALE] * len(contexts) + [1.0, 0.5]  # of the inputs: places, own counts, constant
        self._walk()
        #: Blocks in which no place of a text's own counts can be met more often than 16 bits tell.
        self.rest = max(1, 65_000 // (LONGEST_BLOCK * int(self.lengths.max(initial=1))))

    def _walk(self) -> None:
        """Every symbol's steps from the root on, ``lengths[s]`` of them from ``starts[s]`` on: node, class of depth and bit in one number."""
        parent, side = self._tree
        many = (len(parent) + 1) // 2
        self.lengths, at = np.zeros(many, np.int64), np.arange(many)
        while (up := parent[at]).max(initial=-1) >= 0:
            self.lengths += up >= 0
            at = np.where(up >= 0, up, at)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.steps = np.empty(int(self.lengths.sum()), np.uint32)
        at, place, starts = np.arange(many), self.starts + self.lengths - 1, self.starts
        while len(at):
            on = place >= starts
            at, place, starts = at[on], place[on], starts[on]
            depth = _DEPTHS.take(np.minimum(place - starts, len(_DEPTHS) - 1))
            self.steps[place] = (parent[at] - many).astype(np.uint32) << np.uint32(4) | depth << np.uint32(1) | side[at]
            at, place = parent[at], place - 1

    def path(self, symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """How many bits each of ``symbols`` has and which is its first one, and the steps of all bits."""
        lengths = _at(self.lengths, symbols)
        first = np.cumsum(lengths)
        first -= lengths
        at = np.repeat(_at(self.starts, symbols) - first, lengths)
        at += np.arange(len(at))
        return lengths, first, _at(self.steps, at)

    def __getstate__(self) -> dict[str, Any]:
        # tasks get the tree and walk it themselves, as all its paths are ten times its size
        return {k: v for k, v in self.__dict__.items() if k not in ("lengths", "starts", "steps")}

    def __setstate__(self, state: dict[str, Any]) -> None:
        self.__dict__.update(state)
        self._walk()


class Words(Codes):
    """Symbols: the words of the table from 0, then the end of a text, then the escape."""

    def __init__(self, words: Sequence[bytes], counts: Sequence[int], ends: int, escapes: int):
        super().__init__(np.append(np.asarray(counts, np.int64), [ends, escapes + 1]), WORD_CONTEXTS, WORD_OWN)
        self.counts = np.append(np.asarray(counts, np.int64), ends)
        self.table = dict(zip(words, range(len(words)))) | {b"": len(words)}
        self.escape = len(words) + 1

    def __getstate__(self) -> dict[str, Any]:
        words = zlib.compress(b"\n".join(list(self.table)[:-1]), 1)  # no word has a line feed
        return super().__getstate__() | {"table": words}

    def __setstate__(self, state: dict[str, Any]) -> None:
        words = zlib.decompress(state["table"])
        words = words.split(b"\n") if words else []
        super().__setstate__(state | {"table": dict(zip(words, range(len(words)))) | {b"": len(words)}})

    def read(self, text: bytes) -> tuple[np.ndarray, Counter[bytes]]:
        """The symbols of a text and its words outside the table."""
        parts: list[np.ndarray] = []
        others: Counter[bytes] = Counter()
        for words in words_in(text):
            parts.append(np.fromiter(map(self.table.get, words, repeat(self.escape)), np.int32, len(words)))
            others.update(words[k] for k in np.flatnonzero(parts[-1] == self.escape).tolist())
        return np.concatenate([*parts, np.array([self.escape - 1], np.int32)]), others

    def symbols(self, text: bytes) -> np.ndarray:
        parts = [np.fromiter(map(self.table.get, words, repeat(self.escape)), np.int32, len(words)) for words in words_in(text)]
        return np.concatenate([*parts, np.array([self.escape - 1], np.int32)])

    def each(self, texts: Sequence[bytes]) -> list[np.ndarray]:
        return [self.symbols(t) for t in texts]

    def others(self, text: bytes) -> Counter[bytes]:
        return self.read(text)[1]


class Spelling(Codes):
    """Symbols: bytes, and the end of a word."""

    def __init__(self, counts: Sequence[int]):
        super().__init__(np.asarray(counts, np.int64) + 1, BYTE_CONTEXTS, BYTE_OWN)

    def symbols(self, text: bytes) -> np.ndarray:
        return self.each([text])[0]

    def each(self, texts: Sequence[bytes]) -> list[np.ndarray]:
        stops = np.cumsum([len(t) + 1 for t in texts])
        row = np.frombuffer(b"\0".join([*texts, b""]), np.uint8).astype(np.int32)
        row[stops - 1] = 256
        return [row[a:b] for a, b in zip([0, *stops.tolist()], stops.tolist())]


def _at(table: np.ndarray, places: np.ndarray) -> np.ndarray:
    """What ``table`` has at ``places``, all within it: with "clip" numpy doesn't check them first, which takes longer than the look-up."""
    return table.take(places, mode="clip")


def _scrambled(x: np.ndarray) -> np.ndarray:
    """The numbers of an array of its own, mixed in place."""
    x ^= x >> np.uint32(15)
    x *= np.uint32(0x85EBCA6B)
    x ^= x >> np.uint32(13)
    return x


def _places(context: np.ndarray, lengths: np.ndarray, turned: np.ndarray) -> np.ndarray:
    """Places of bits, from their symbols' contexts and their nodes times ``_TURN``."""
    place = np.repeat(context, lengths)
    place += turned
    return _scrambled(place) >> np.uint32(33 - PLACES.bit_length())


@dataclass
class Decisions:
    """Bits of a row of symbols: how many each symbol has and its first one; the class of a bit's depth, its value and its place in every table."""

    lengths: np.ndarray
    first: np.ndarray
    depth: np.ndarray
    bit: np.ndarray
    places: list[np.ndarray]


class Together:
    """The symbols of some texts, in the order of their blocks."""

    def __init__(self, codes: Codes, texts: Sequence[np.ndarray]):
        self._codes = codes
        sizes = np.array([len(t) for t in texts], np.int64)
        symbols = np.concatenate(texts) if len(texts) else np.empty(0, np.int32)
        doc = np.repeat(np.arange(len(texts)), sizes)
        place = np.arange(len(symbols)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        doubled = np.frexp((place // FIRST_BLOCK).astype(np.float64))[1]
        most = LONGEST_BLOCK // FIRST_BLOCK
        block = np.where(place < LONGEST_BLOCK, doubled, most.bit_length() - 1 + place // LONGEST_BLOCK).astype(np.int32)
        if block.max(initial=0) < 1 << 16:
            block = block.astype(np.uint16)  # sorted by digits
        order = np.argsort(block, kind="stable")
        self.symbols, self.doc = symbols[order], doc[order]
        self.contexts = [self._hashed(symbols, place, lags)[order] for lags in codes.contexts]
        self.blocks = np.flatnonzero(np.diff(block[order].astype(np.int64), prepend=-1, append=-1)) if len(symbols) else np.zeros(1, np.int64)

    @staticmethod
    def _hashed(symbols: np.ndarray, place: np.ndarray, lags: Sequence[int]) -> np.ndarray:
        total = np.full(len(symbols), len(lags), np.uint32)
        for lag in lags:
            before = np.zeros(len(symbols), np.uint32)
            before[lag:] = np.where(place[lag:] >= lag, symbols[:-lag] + 1, 0)[: len(symbols[lag:])]
            total = _scrambled(total * _TURN + before)
        return total

    def decisions(self, start: int, stop: int) -> Decisions:
        lengths, first, steps = self._codes.path(self.symbols[start:stop])
        node = steps >> np.uint32(4)
        turned, places = node * _TURN, []
        for lags, context in zip(self._codes.contexts, self.contexts):
            places.append((_places(context[start:stop], lengths, turned) if lags else node).astype(np.int64))
        low = steps.astype(np.uint8)
        return Decisions(lengths, first, low >> np.uint8(1) & np.uint8(7), low & np.uint8(1), places)

    def pieces(self, start: int, stop: int) -> Iterator[tuple[int, int]]:
        """A block cut between texts into parts of some ``_ROWS`` symbols, as arrays that fit in a cache are faster."""
        firsts = np.flatnonzero(np.diff(self.doc[start:stop], prepend=-1))
        cuts = start + firsts[np.diff(firsts // _ROWS, prepend=-1) > 0]
        return zip(cuts.tolist(), [*cuts[1:].tolist(), stop])


_OWN_ODDS = np.log((np.arange(16)[None, :] + 0.4) / (np.arange(16)[:, None] + 0.4)).astype(np.float32).ravel()


@dataclass
class Mixer:
    """Log odds of places, and what weights and map start from."""

    codes: Codes
    odds: list[np.ndarray]
    weights: np.ndarray  # input, gate
    map: np.ndarray  # level, step: probability

    def __getstate__(self) -> dict[str, Any]:
        return self.__dict__ | {"odds": [zlib.compress(t.tobytes(), 1) for t in self.odds]}

    def __setstate__(self, state: dict[str, Any]) -> None:
        self.__dict__.update(state | {"odds": [np.frombuffer(zlib.decompress(t), np.int8) for t in state["odds"]]})

    def run(self, texts: Sequence[np.ndarray], learned: Learned | None = None) -> np.ndarray:
        """Bits of each text. With ``learned`` nothing is updated, and it takes what the texts show.

        Texts stand longest first, so those that go on after a block are the first ones in it; they alone have weights, a map and counts of
        their own, which start after their first block.
        """
        longest = np.argsort([-len(t) for t in texts], kind="stable")
        rows = Together(self.codes, [texts[k] for k in longest])
        ends = rows.blocks.tolist()
        present = [int(rows.doc[stop - 1]) + 1 for stop in ends[1:]] + [0, 0]
        first = Shown.of(self, 1, 0)
        shown = Shown.of(self, 1 if learned else present[1], present[1])
        bits = np.zeros(len(texts))
        for turn, (start, stop) in enumerate(zip(ends, ends[1:])):
            for low, high in rows.pieces(start, stop):
                self._move(rows, low, high, present[turn + 1], first if turn == 0 or learned else shown, shown, turn > 0, bits, learned)
            if (turn + 1) % self.codes.rest == 0:
                np.minimum(shown.own, 15, out=shown.own)  # before any count can pass its 16 bits
        back = np.empty(len(texts))
        back[longest] = bits
        return back

    def _move(self, rows: Together, start: int, stop: int, going: int, now: Shown, then: Shown, later: bool, bits: np.ndarray, learned: Learned | None) -> None:
        """Bits of some texts' next block by what is known ``now``; texts before ``going`` leave what it shows for ``then``."""
        codes, doc = self.codes, rows.doc[start:stop]
        from_, to = int(doc[0]), int(doc[-1]) + 1
        going = min(max(going - from_, 0), to - from_)
        d = rows.decisions(start, stop)
        inputs = [_at(table, place) for table, place in zip(self.odds, d.places)]
        level = np.zeros(len(d.bit), np.uint8)
        for k in range(1, len(codes.contexts)):
            np.maximum(level, (inputs[k] != 0).view(np.uint8) * np.uint8(2 * k), out=level)
        inputs = [x.astype(np.float32) for x in inputs]
        if going or later:
            each = np.repeat(doc - from_, d.lengths)
            kept = d.places[1] & (codes.own - 1)
            kept += each * codes.own
        if later:
            pair = then.own[from_ * codes.own * 2 : to * codes.own * 2].view(np.uint32)
            pair = _at(pair, kept)
            known = np.minimum(pair & np.uint32(0xFFFF), 15) << np.uint32(4) | np.minimum(pair >> np.uint32(16), 15)
            level += known != 0
            inputs.append(_at(_OWN_ODDS, known))
        gate = level * np.uint8(6) + d.depth
        weights, refined, at = now.weights, now.map, gate.astype(np.int64)
        if later and learned is None:
            at += each * codes.gates
            weights, refined = [w[from_ * codes.gates :] for w in weights], refined[from_ * codes.cells :]
        mixed = _at(weights[0], at)
        mixed *= inputs[0]
        for w, x in zip(weights[1:], inputs[1:]):
            x = _at(w, at) * x
            mixed += x
        mixed += _at(weights[-1], at)
        p = np.clip(mixed, -11.9, 11.9)
        np.negative(p, out=p)
        np.exp(p, out=p)
        p += 1
        np.reciprocal(p, out=p)
        share = np.clip(mixed, -7.99, 7.99, out=mixed)
        share += 8
        share *= 2
        low = share.astype(np.uint8)
        share -= low
        cell = level * np.uint16(_STEPS) + low
        own_cell = cell.astype(np.int64)
        if later and learned is None:
            own_cell += each * codes.cells
        least, told = _at(refined, own_cell), _at(refined[1:], own_cell)
        told -= least
        told *= share
        told += least
        told += p
        told *= 0.5
        one = d.bit.astype(np.float32)
        told += one
        told -= 1
        np.abs(told, out=told)
        bits[from_:to] -= np.add.reduceat(np.log2(told, out=told), d.first.take(np.flatnonzero(np.diff(doc, prepend=-1))), dtype=np.float64)
        near = share >= 0.5
        if learned is not None:
            learned.takes(gate, cell + near, inputs if later else [*inputs, np.float32(0)], p, one)
        if not going:
            return
        # what the block has shown is known from the next block on
        size = int(np.searchsorted(each, going))
        bit = d.bit[:size]
        kept = kept[:size] * 2
        kept += bit
        np.add.at(then.own[from_ * codes.own * 2 :], kept, np.uint16(1))
        if learned is not None:
            return
        at, own_cell = at[:size], own_cell[:size] + near[:size]
        if not later:
            at += each[:size] * codes.gates
            own_cell += each[:size] * codes.cells
        error = one[:size]
        error -= p[:size]
        gates, cells = slice(from_ * codes.gates, (from_ + going) * codes.gates), slice(from_ * codes.cells, (from_ + going) * codes.cells)
        pace = STEP / (np.bincount(at, minlength=going * codes.gates) + 16.0)
        for w, x, scale in zip(then.weights, inputs, codes.scales):
            w[gates] += pace * (scale * scale) * np.bincount(at, error * x[:size], len(pace))
        then.weights[-1][gates] += pace * codes.scales[-1] ** 2 * np.bincount(at, error, len(pace))
        own_cell *= 2
        own_cell += bit
        zeros, hits = np.bincount(own_cell, minlength=going * codes.cells * 2).reshape(-1, 2).T
        total = zeros + hits
        then.map[cells] += (hits - total * then.map[cells]) / (total + MAP_START)


@dataclass
class Shown:
    """Weights, map and own counts of some texts, one after the other. Weights are held times the scales of their inputs, powers of two."""

    weights: list[np.ndarray]
    map: np.ndarray
    own: np.ndarray

    @classmethod
    def of(cls, mixer: Mixer, many: int, counting: int) -> Shown:
        codes = mixer.codes
        weights = [np.tile((w * s).astype(np.float32), many) for w, s in zip(mixer.weights, codes.scales)]
        return cls(weights, np.tile(mixer.map.ravel().astype(np.float32), many), np.zeros(counting * codes.own * 2, np.uint16))


class Learned:
    """Sums over texts: slopes and curvatures of the loss by the weights, and what the map's cells have seen.

    They are kept in whole parts of ``_FIXED``, so that sums of tasks don't depend on their order.
    """

    def __init__(self, codes: Codes):
        n, gates = codes.inputs, codes.gates
        self._pairs, self._upper, self._scales = [(i, j) for i in range(n) for j in range(i, n)], np.triu_indices(n), codes.scales
        self.slopes, self.curves = np.zeros((n, gates)), np.zeros((len(self._pairs), gates))
        self.map = np.zeros((2, codes.levels * _STEPS))

    def takes(self, gate: np.ndarray, cell: np.ndarray, inputs: Sequence[np.ndarray], p: np.ndarray, one: np.ndarray) -> None:
        """Inputs are still to be scaled. Bits of one gate are brought together, so that its sums are matrix products."""
        order = np.argsort(gate, kind="stable")
        ends = np.cumsum(np.bincount(gate, minlength=self.slopes.shape[1])).tolist()
        x = np.empty((len(inputs) + 1, len(gate)))
        for row, told, scale in zip(x, [*inputs, np.float32(1)], self._scales):
            row[:] = _at(told, order) if told.ndim else told
            row *= scale
        p = _at(p, order).astype(np.float64)
        error, spread = _at(one, order) - p, p * (1 - p)
        for at, (start, stop) in enumerate(zip([0, *ends], ends)):
            if start < stop:
                part = x[:, start:stop]
                self.slopes[:, at] += part @ error[start:stop]
                self.curves[:, at] += ((part * spread[start:stop]) @ part.T)[self._upper]
        cells = self.map.shape[1]
        zeros, ones = np.bincount(cell.astype(np.int64) * 2 + (one > 0), minlength=cells * 2).reshape(-1, 2).T
        self.map += [zeros + ones, ones]

    def values(self) -> np.ndarray:
        return np.rint(np.concatenate([self.slopes.ravel(), self.curves.ravel(), self.map.ravel()]) * _FIXED).astype(np.int64)

    def applied(self, values: np.ndarray, mixer: Mixer) -> Mixer:
        """The mixer after a Newton step by the sums of all tasks; gates without evidence stay as they are."""
        slopes, curves, seen = (v.reshape(x.shape) for v, x in zip(
            np.split(values / _FIXED, [self.slopes.size, self.slopes.size + self.curves.size]), (self.slopes, self.curves, self.map)))
        weights = mixer.weights.copy()
        for gate in range(slopes.shape[1]):
            curve = np.zeros((len(slopes), len(slopes)))
            for (i, j), c in zip(self._pairs, curves[:, gate]):
                curve[i, j] = curve[j, i] = c
            weights[:, gate] += np.linalg.solve(curve + RIDGE * np.eye(len(slopes)), slopes[:, gate])
        total, ones = seen.reshape(2, -1, _STEPS)
        return Mixer(mixer.codes, mixer.odds, np.clip(weights, -4, 4), (ones + 8 * first_map(mixer.codes)) / (total + 8))


def first_map(codes: Codes) -> np.ndarray:
    return np.tile(1 / (1 + np.exp(-(np.arange(_STEPS) / 2 - 8))), (codes.levels, 1))


def first_mixer(codes: Codes, odds: list[np.ndarray]) -> Mixer:
    weights = np.full((codes.inputs, codes.gates), 1 / codes.inputs)
    weights[-1] = 0
    return Mixer(codes, odds, weights, first_map(codes))


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[list[bytes]]:
    """Texts that move on together: some of one size, or one long one."""
    held: list[bytes] = []
    size = 0
    for batch in batches:
        for value in batch.column(0):
            text = value.as_py() or b""
            held.append(text)
            size += len(text)
            if len(held) >= TEXTS or size >= TEXT_BYTES:
                yield held
                held, size = [], 0
    if held:
        yield held


def _binary(docs: DataFrame, text: str) -> DataFrame:
    return docs.select(F.coalesce(F.col(text).cast("binary"), F.lit(b"")).alias("text"))


def word_counts(docs: DataFrame, text: str = "text", most: int = HELD, most_bytes: int = HELD_BYTES) -> DataFrame:
    """``word`` (binary), ``n``: every word of all texts, A-Z lowered, and how often it occurs. An empty word stands for the ends."""

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[bytes] = Counter()
        size = 0

        def flush() -> pa.RecordBatch:
            rows = pa.RecordBatch.from_arrays([pa.array(held.keys(), pa.binary()), pa.array(held.values(), pa.int64())], ["word", "n"])
            held.clear()
            return rows

        for batch in batches:
            for value in batch.column(0):
                held[b""] += 1
                for words in words_in(value.as_py()):
                    held.update(words)
                    size += sum(map(len, words))
                    if len(held) > most or size > most_bytes:
                        yield flush()
                        size = 0
        yield flush()

    return _binary(docs, text).mapInArrow(add_up, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))


def frequent_words(counts: DataFrame, table_bytes: int = TABLE_BYTES) -> Column:
    """Whether a row of ``counts`` is one of the most frequent words that together weigh ``table_bytes`` at most.

    Frequencies fall into classes, eight for each power of two; classes are taken whole, from the most frequent one on. Words
    met once never are: they tell how often a word is a new one, and how new ones are spelled.
    """
    size, of = F.octet_length("word"), F.floor(F.log2("n") * 8)
    fits = size.between(1, LONGEST) & (F.col("n") > 1)
    weights = counts.filter(fits).groupBy(of.alias("class")).agg(F.sum(size + ENTRY).alias("weight")).orderBy(F.desc("class"))
    least, left = 1 << 30, table_bytes
    for row in weights.collect():
        left -= row["weight"]
        if left < 0:
            break
        least = row["class"]
    return fits & (of >= least)


def word_codes(counts: DataFrame, frequent: Column) -> Words:
    table = counts.filter(frequent).select("word", "n").toArrow().sort_by([("n", "descending"), ("word", "ascending")])
    rest = counts.filter(~frequent).agg(
        F.coalesce(F.sum(F.when(F.octet_length("word") == 0, F.col("n"))), F.lit(0)).alias("ends"),
        F.coalesce(F.sum(F.when(F.octet_length("word") > 0, F.col("n"))), F.lit(0)).alias("escapes")).first()
    return Words(table["word"].to_pylist(), table["n"].to_numpy(), rest["ends"], rest["escapes"])


def byte_codes(words: DataFrame) -> Spelling:
    """Codes of the bytes of ``word``, each row counted once."""

    def spelled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(257, np.int64)
        for batch in batches:
            total[:256] += np.bincount(np.frombuffer(b"".join(batch.column(0).to_pylist()), np.uint8), minlength=256)
            total[256] += batch.num_rows
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(257)), pa.array(total)], ["symbol", "n"])

    found = words.select("word").mapInArrow(spelled, "symbol long, n long").groupBy("symbol").agg(F.sum("n").alias("n")).collect()
    known = {r["symbol"]: r["n"] for r in found}
    return Spelling([known.get(k, 0) for k in range(257)])


def place_counts(docs: DataFrame, held: Broadcast[Codes], text: str = "text") -> DataFrame:
    """``chunk``, ``data``: zeros and ones at each place of every table over all bits of all texts, in compressed pieces."""
    codes = held.value

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, size = held.value, 0
        tables = np.zeros((len(known.contexts), PLACES * 2), np.int32)
        met = np.zeros(len(known.lengths), np.int64)
        rest: list[Together] = []
        for group in _groups(batches):
            rest.append(Together(known, known.each(group)))
            met += np.bincount(rest[-1].symbols, minlength=len(met))
            size += len(rest[-1].symbols)
            if size >= _SORTED:
                _add_places(tables, known, rest)
                rest, size = [], 0
        _add_places(tables, known, rest)
        for lags, table in zip(known.contexts, tables):
            if not lags:
                _add_nodes(table, known, met)
        for chunk, part in enumerate(tables.reshape(-1, _CHUNK)):
            if part.any():
                yield _packed([chunk], [part])

    size = estimated_bytes(docs)  # only says how many tasks count; what Spark can't estimate is 8 EB
    tasks = max(1, size // TASK_BYTES if size < 1 << 60 else 0, docs.sparkSession.sparkContext.defaultParallelism)
    counted = _binary(docs, text).coalesce(tasks).mapInArrow(count, "chunk long, data binary")
    salts = tasks // 256
    if salts > 1:
        salted = counted.withColumn("salt", F.spark_partition_id() % salts).repartition(_chunk_tasks(codes) * salts, "chunk", "salt")
        counted = salted.select("chunk", "data").mapInArrow(_added, "chunk long, data binary")
    return counted.repartition(_chunk_tasks(codes), "chunk").mapInArrow(_added, "chunk long, data binary")


def _add_places(tables: np.ndarray, codes: Codes, rows: Sequence[Together]) -> None:
    """Bits of ``rows`` at their places. A symbol that comes several times after one context has the same places each time, so it is done once."""
    for k, lags in enumerate(codes.contexts):
        if not lags or not rows:
            continue
        pairs = np.sort(np.concatenate([r.contexts[k].astype(np.uint64) << np.uint64(32) | r.symbols.astype(np.uint64) for r in rows]))
        first = np.flatnonzero(np.diff(pairs, prepend=~pairs[:1]))
        times, pairs = np.diff(first, append=len(pairs)).astype(np.int32), pairs[first]
        for start in range(0, len(pairs), _ROWS):
            some = pairs[start : start + _ROWS]
            lengths, _, steps = codes.path((some & np.uint64(0xFFFFFFFF)).astype(np.int64))
            at = _places((some >> np.uint64(32)).astype(np.uint32), lengths, (steps >> np.uint32(4)) * _TURN).astype(np.int64) * 2
            at += steps & np.uint32(1)
            np.add.at(tables[k], at, np.repeat(times[start : start + _ROWS], lengths))


def _add_nodes(table: np.ndarray, codes: Codes, met: np.ndarray) -> None:
    """Without a context a place is a node, met as often as the symbols below it."""
    symbols = np.flatnonzero(met)
    for start in range(0, len(symbols), _ROWS):
        some = symbols[start : start + _ROWS]
        lengths, _, steps = codes.path(some)
        np.add.at(table, (steps >> np.uint32(4)).astype(np.int64) * 2 + (steps & np.uint32(1)), np.repeat(met[some].astype(np.int32), lengths))


def _chunk_tasks(codes: Codes) -> int:
    return max(1, len(codes.contexts) * PLACES * 2 // _CHUNK // 16)


def _packed(chunks: Sequence[int], parts: Sequence[np.ndarray]) -> pa.RecordBatch:
    """Counts of a chunk as their places and, byte by byte, their values."""
    data = []
    for part in parts:
        at = np.flatnonzero(part)
        values = part[at].astype(np.int64).view(np.uint8).reshape(-1, 8).T
        data.append(zlib.compress(at.astype(np.uint16).tobytes() + values.tobytes(), 1))
    return pa.RecordBatch.from_arrays([pa.array(chunks, pa.int64()), pa.array(data, pa.binary())], ["chunk", "data"])


def _unpacked(data: bytes) -> np.ndarray:
    raw = zlib.decompress(data)
    many, part = len(raw) // 10, np.zeros(_CHUNK, np.int64)
    values = np.frombuffer(raw, np.uint8, offset=2 * many).reshape(8, many)
    part[np.frombuffer(raw, np.uint16, many)] = np.ascontiguousarray(values.T).view(np.int64).ravel()
    return part


def _added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces of one chunk as one; a task holds the sums of its own chunks."""
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        for chunk, data in zip(batch.column(0).to_pylist(), batch.column(1)):
            part = _unpacked(data.as_py())
            sums[chunk] = sums[chunk] + part if chunk in sums else part
    for chunk, total in sums.items():
        yield _packed([chunk], [total])


def odds_of(counts: DataFrame, codes: Codes) -> list[np.ndarray]:
    """Log odds of every place, in sixteenths; 0 where nothing was counted. A byte for each place comes to the driver."""

    def told(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _added(batches):
            zeros, ones = _unpacked(batch.column(1)[0].as_py()).reshape(-1, 2).T
            value = np.clip(np.rint(_SCALE * np.log((ones + 0.4) / (zeros + 0.4))), -127, 127).astype(np.int8)
            value[(value == 0) & (zeros > 0)] = 1  # evidence for neither side is told from none
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([value.tobytes()], pa.binary())], ["chunk", "data"])

    many, half = len(codes.contexts), _CHUNK // 2
    tables = np.zeros(many * PLACES, np.int8)
    for row in counts.repartition(_chunk_tasks(codes), "chunk").mapInArrow(told, "chunk long, data binary").collect():
        tables[row["chunk"] * half : (row["chunk"] + 1) * half] = np.frombuffer(row["data"], np.int8)
    return list(tables.reshape(many, PLACES))


def tuned(docs: DataFrame, held: Broadcast[Mixer], mixer: Mixer, text: str = "text") -> Mixer:
    """One round of weights and map over what is ``held``. At most one row for each sum comes to the driver."""
    weights, map_ = mixer.weights, mixer.map

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = replace(held.value, weights=weights, map=map_)
        learned = Learned(known.codes)
        for group in _groups(batches):
            known.run(known.codes.each(group), learned)
        values = learned.values()
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(values))), pa.array(values)], ["cell", "n"])

    learned = Learned(mixer.codes)
    values = learned.values()
    for row in _binary(docs, text).mapInArrow(learn, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).collect():
        values[row["cell"]] = row["n"]
    return learned.applied(values, mixer)


@contextmanager
def _sent(spark: SparkSession, value: Any) -> Iterator[Broadcast]:
    """``value`` at every task of the jobs within; it is taken back from disks and memory after them."""
    held = spark.sparkContext.broadcast(value)
    try:
        yield held
    finally:
        held.destroy()


def mixer_of(docs: DataFrame, codes: Codes, text: str = "text") -> Mixer:
    turn = F.pmod(F.xxhash64(F.col(text)), F.lit(TUNE))
    first, apart = docs.filter(turn.isNull() | (turn != 0)), docs.filter(turn == 0)
    with _sent(docs.sparkSession, codes) as held:
        most = written(place_counts(first, held, text))
        rest = written(place_counts(apart, held, text))
    mixer = first_mixer(codes, odds_of(most, codes))
    with _sent(docs.sparkSession, mixer) as held:
        for _ in range(ROUNDS):
            mixer = tuned(apart, held, mixer, text)
    return Mixer(codes, odds_of(most.union(rest), codes), mixer.weights, mixer.map)


@dataclass
class Model:
    words: Mixer
    spelling: Mixer
    counts: DataFrame  # word, n
    tokens: int  # of the training texts, ends included
    types: int


def fit(docs: DataFrame, text: str = "text", table_bytes: int = TABLE_BYTES) -> Model:
    """A model of all texts of ``docs``. Null texts are empty ones, repeated texts count as often as they come.

    Other columns don't matter. Without any text a model knows the end of a text only, and the bytes of words are even.
    """
    counts = written(word_counts(docs, text))
    told = counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("tokens"), F.count(F.lit(1)).alias("types")).first()
    frequent = frequent_words(counts, table_bytes)
    rare = counts.filter(~frequent & (F.octet_length("word") > 0)).select("word")
    return Model(mixer_of(docs, word_codes(counts, frequent), text), mixer_of(rare, byte_codes(rare), "word"), counts, told["tokens"], told["types"])


def _each_group(texts: pa.Array) -> Iterator[list[bytes]]:
    return _groups(iter([pa.RecordBatch.from_arrays([texts], ["text"])]))


def spelled_bits(word: Column, held: Broadcast[Mixer]) -> Column:
    @F.arrow_udf("double")
    def of(words: pa.Array) -> pa.Array:
        mixer = held.value
        return pa.array(np.concatenate([mixer.run(mixer.codes.each(group)) for group in _each_group(words)] or [np.zeros(0)]))

    return of(word)


def bits_and_words(text: Column, held: Broadcast[Mixer]) -> Column:
    """Struct of ``bits`` (spelling apart), ``n_tokens``, ``known`` and ``base`` (table words met in training, and the sum of log10 of
    their counts and one), and ``others``: the words outside the table with how often they occur."""

    @F.arrow_udf("struct<bits:double,n_tokens:bigint,known:bigint,base:double,others:array<struct<word:binary,times:bigint>>>")
    def of(texts: pa.Array) -> pa.Array:
        mixer = held.value
        codes = mixer.codes
        seen, logs = np.append(codes.counts > 0, False), np.append(np.log10(codes.counts + 1.0), 0.0)  # the escape last
        bits, sizes, known, base, words, times, ends = [], [], [], [], [], [], [0]
        for group in _each_group(texts):
            rows = []
            for value in group:
                symbols, others = codes.read(value)
                rows.append(symbols)
                sizes.append(len(symbols))
                known.append(int(seen[symbols].sum()))
                base.append(float(logs[symbols].sum()))
                words += others.keys()
                times += others.values()
                ends.append(len(words))
            bits += mixer.run(rows).tolist()
        pairs = pa.StructArray.from_arrays([pa.array(words, pa.binary()), pa.array(times, pa.int64())], ["word", "times"])
        others = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pairs)
        return pa.StructArray.from_arrays([pa.array(bits, pa.float64()), pa.array(sizes, pa.int64()), pa.array(known, pa.int64()), pa.array(base, pa.float64()), others],
                                          ["bits", "n_tokens", "known", "base", "others"])

    return of(F.coalesce(text.cast("binary"), F.lit(b"")))


def score(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text", keep: Sequence[str] = ()) -> DataFrame:
    """For each row of ``docs``: key, columns to ``keep``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score``, ``score``, ``bits_per_byte``.

    A null text is an empty one: its one token is the end, and its bits per byte are null. Repeated rows and null keys are rows like any other.
    Words outside the table, seldom ones, are joined by a shuffle to their counts and to the bits of their spelling.
    """
    kept = {c: f"kept{k}" for k, c in enumerate(keep)}
    told = docs.select(F.col(key).alias("key"), *(F.col(c).alias(n) for c, n in kept.items()), F.octet_length(F.col(text).cast("binary")).alias("bytes"), F.col(text).alias("body"))
    with _sent(docs.sparkSession, model.words) as held:
        told = told.withColumn("x", bits_and_words(F.col("body"), held))
        rows = written(told.select(F.monotonically_increasing_id().alias("row"), "key", *kept.values(), "bytes", "x.*"))
    others = rows.select("row", F.explode("others").alias("o")).select("row", "o.word", "o.times")
    each = others.select("word").distinct().join(model.counts, "word", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    with _sent(docs.sparkSession, model.spelling) as held:
        spelled = written(each.select("word", "n", spelled_bits(F.col("word"), held).alias("bits")))
    sums = others.join(spelled, "word").groupBy("row").agg(
        F.sum(F.when(F.col("n") > 0, F.col("times"))).alias("more_known"), F.sum(F.col("times") * F.log10(F.col("n") + 1)).alias("more_base"),
        F.sum(F.col("times") * F.col("bits")).alias("more_bits"))
    smooth = math.log10(model.tokens + model.types + 1)
    more = lambda c: F.col(c) + F.coalesce(f"more_{c}", F.lit(0))
    both = rows.drop("others").join(sums, "row", "left").withColumn("all_bits", more("bits"))
    return both.select(
        F.col("key").alias(key), *(F.col(n).alias(c) for c, n in kept.items()), "n_tokens", more("known").alias("n_known"),
        F.lit(model.tokens).cast("long").alias("train_tokens"), (more("base") - F.col("n_tokens") * F.lit(smooth)).alias("base_score"),
        (-F.col("all_bits") * F.lit(math.log10(2))).alias("score"), F.when(F.col("bytes") > 0, F.col("all_bits") / F.col("bytes")).alias("bits_per_byte"))
