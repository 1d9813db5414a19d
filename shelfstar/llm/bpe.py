"""Byte-level BPE as a lazily determinised finite-state transducer.

Merging is turned into reading left to right. The encoding of every prefix of a text ends with one token,
and dropping that token leaves the encoding of a shorter prefix; which token it is depends only on it and the
token before it, because merging must not join anything across their border. So a reader keeps, for each
place from which a token may still reach beyond what was read, where it stands in the token trie and which token
came before. That is a state of the transducer: finitely many, as the trie and the tokens are. States and
transitions are made when first met and kept. A token is sure as soon as all places agree on it; matches are
short, so tokens go out at their end, and in a long match whenever 4,096 bytes are pending.

Decoding feeds token bytes to an incremental UTF-8 machine that holds back an unfinished character.
"""

from __future__ import annotations

import base64
from array import array
from collections.abc import Iterable, Iterator
from itertools import accumulate
from operator import getitem

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, functions as F

#: Kept states, borders of two tokens, pieces of text with their ids, and the longest such piece. A full table becomes the
#: old one, from which what is met again comes back, so there are up to twice as many.
STATES, PAIRS, KEPT, LONGEST_KEPT = 160_000, 150_000, 240_000, 48
#: Bytes after which a long match starts to give out tokens.
PENDING = 4096
_BITS = 20
_NONE = (1 << _BITS) - 1
_START = (_NONE,)


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as file:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}


class Merges:
    """What the ranks say about two tokens side by side."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.octets = {rank: token for token, rank in ranks.items()}
        self._halves: dict[int, tuple[int, int] | None] = {}

    def halves(self, token: int) -> tuple[int, int] | None:
        """The two tokens that the merge giving ``token`` joins; None for a single byte."""
        if token not in self._halves:
            octets = self.octets[token]
            parts = [octets[i : i + 1] for i in range(len(octets))]
            while len(parts) > 2:
                joined = [self.ranks.get(a + b, token) for a, b in zip(parts, parts[1:])]
                at = min(range(len(joined)), key=joined.__getitem__)
                if joined[at] >= token:
                    raise ValueError(f"token {token} can't be merged from its bytes")
                parts[at : at + 2] = [parts[at] + parts[at + 1]]
            self._halves[token] = (self.ranks[parts[0]], self.ranks[parts[1]]) if len(parts) == 2 else None
        return self._halves[token]

    def apart(self, left: int, right: int) -> bool:
        """Whether merging leaves the border of the two tokens alone; found by undoing merges at it, latest first."""
        least = None  # merges of this rank and above had no turn before the one just undone
        ranks, octets, halves = self.ranks, self.octets, self._halves
        while True:
            joined = ranks.get(octets[left] + octets[right])
            if joined is not None and (least is None or joined < least):
                return False
            a = halves[left] if left in halves else self.halves(left)
            b = halves[right] if right in halves else self.halves(right)
            if a is None and b is None:
                return True
            if b is None or a is not None and left > right:
                least, left = left, a[1]
            else:  # of equal merges the left one comes first, and so does the one across the border
                least, right = right + 1, b[0]


class State(dict):
    """Places, and by byte the next state, made when first asked for. The last place is the token that ends here."""

    __slots__ = ("places", "_make")

    def __init__(self, places: tuple, make):
        self.places, self._make = places, make

    def __missing__(self, byte: int) -> "State":
        state = self[byte] = self._make(self.places, byte)
        return state


class Transducer:
    """Encodes the bytes of one match of the splitting pattern.

    A place is a trie node and the token before it, packed in one integer; a state is a tuple of places, the one
    that reaches back furthest first, and the one after the token that ends here last.
    """

    def __init__(self, ranks: dict[bytes, int]):
        self.merges = Merges(ranks)
        self._child: dict[int, int] = {}
        self._token: list[int | None] = [None]
        self._inner: list[bool] = [True]
        self._depth: list[int] = [0]
        self._width = {rank: len(octets) for octets, rank in ranks.items()}
        self._states: dict[tuple, State] = {}
        self._old: dict[tuple, State] = {}
        self._apart: dict[int, bool] = {}
        self._old_apart: dict[int, bool] = {}
        if max(ranks.values()) >= _NONE:
            raise ValueError("token ids must be below 2 to the 20th")
        for octets, rank in ranks.items():
            node = 0
            for byte in octets:
                self._inner[node] = True
                edge = node << 8 | byte
                if edge not in self._child:
                    self._child[edge] = len(self._token)
                    self._token.append(None)
                    self._inner.append(False)
                    self._depth.append(self._depth[node] + 1)
                node = self._child[edge]
            self._token[node] = rank
        self._make = self._step  # one bound method for all states
        self._root = self._state(_START)

    def _state(self, places: tuple) -> State:
        state = self._states.get(places)
        if state is None:
            if len(self._states) >= STATES:
                for old in self._old.values():
                    old.clear()  # states refer to each other in circles
                self._old, self._states = self._states, {}
                self._root = self._states[_START] = State(_START, self._make)
            state = self._states[places] = State(places, self._make)
        return state

    def _fits(self, left: int, right: int) -> bool:
        pair = left << _BITS | right
        fits = self._apart.get(pair)
        if fits is None:
            if len(self._apart) >= PAIRS:
                self._old_apart, self._apart = self._apart, {}
            fits = self._old_apart.get(pair)
            fits = self._apart[pair] = self.merges.apart(left, right) if fits is None else fits
        return fits

    def _step(self, places: tuple, byte: int) -> State:
        old = self._old.get(places)
        if old is not None and byte in old:
            return self._state(old[byte].places)
        ended, ahead, find, tokens, inner = None, [], self._child.get, self._token, self._inner
        for place in places:
            child = find(place >> _BITS << 8 | byte)
            if child is None:
                continue
            last = place & _NONE
            if ended is None and (token := tokens[child]) is not None and (last == _NONE or self._fits(last, token)):
                ended = token
            if inner[child]:
                ahead.append(child << _BITS | last)
        ahead.append(ended)
        return self._state(tuple(ahead))

    def _agreed(self, met: list[State]) -> int:
        """How many of the bytes read all places of the last state share the tokens of."""
        at = {len(met) - self._depth[place >> _BITS] for place in met[-1].places}
        while len(at) > 1:
            last = max(at)
            at = at - {last} | {last - self._width[met[last - 1].places[-1]]}
        return at.pop()

    def _tokens(self, met: list[State], at: int) -> list[int]:
        out, width = [], self._width
        while at:
            token = met[at - 1].places[-1]
            out.append(token)
            at -= width[token]
        out.reverse()
        return out

    def stream(self, octets: bytes, pending: int = PENDING) -> Iterator[list[int]]:
        """Tokens of one match. Beyond ``pending`` bytes, those that all places agree on go out before the end."""
        state, met = self._root, []
        for at in range(0, len(octets), pending):
            read = accumulate(octets[at : at + pending], getitem, initial=state)
            next(read)  # the state before
            met.extend(read)
            state = met[-1]
            if at + pending < len(octets) and (sure := self._agreed(met)):
                yield self._tokens(met, sure)
                del met[:sure]
        yield self._tokens(met, len(met))

    def encode(self, octets: bytes) -> list[int]:
        if len(octets) <= PENDING:
            _, *met = accumulate(octets, getitem, initial=self._root)
            return self._tokens(met, len(met))
        return [token for part in self.stream(octets) for token in part]


class _Kept(dict):
    """Ids of pieces of text as 32-bit integers. A full table becomes the old one, from which what is met again comes back."""

    def __init__(self, make, most: int):
        super().__init__()
        self._make, self._most, self._old = make, most, {}

    def __missing__(self, piece: str) -> bytes | None:
        ids = self._old.get(piece)
        if ids is None:
            ids = self._make(piece)
        if len(piece) <= LONGEST_KEPT:
            if len(self) >= self._most:
                self._old = dict(self)
                self.clear()
            self[piece] = ids
        return ids


class Encoder:
    """Ids of whole texts.

    A single blank between two characters that aren't white space always begins a match, so a text without other
    blanks is a sequence of blank-led chunks, each matched and encoded by itself and kept for the next time.
    A chunk of letters is one match, and so are letters before a full stop or comma, whatever the pattern
    makes of the rest.
    """

    def __init__(self, path: str, pattern: str):
        self._transducer = Transducer(read_ranks(path))
        self._matches = regex.compile(pattern).findall
        self._words = _Kept(self._encoded, KEPT // 4)
        self._chunks = _Kept(self._chunk, KEPT)
        self._plain = self._matches(" añ.") == [" añ", "."] == self._matches(" añ,")[:1] + ["."]

    def _encoded(self, match: str) -> bytes:
        return array("i", self._transducer.encode(match.encode())).tobytes()

    def _chunk(self, chunk: str) -> bytes | None:
        """None if white space at an end makes its neighbours matter."""
        if self._plain:
            if chunk.isalpha():
                return self._encoded(" " + chunk)
            if chunk[-1:] in (".", ",") and chunk[:-1].isalpha():
                return self._chunks[chunk[:-1]] + self._words[chunk[-1]]
        if not chunk or chunk[0].isspace() or chunk[-1].isspace():
            return None
        return self._all(" " + chunk)

    def _all(self, text: str) -> bytes:
        return b"".join(map(self._words.__getitem__, self._matches(text)))

    def encode(self, text: str | None) -> bytes:
        """Ids of the whole text, 4 bytes each; none for a null or empty one."""
        if not text:
            return b""
        first, *rest = text.split(" ")
        ids = [None] if not first or first[-1].isspace() else [self._all(first), *map(self._chunks.__getitem__, rest)]
        return self._all(text) if None in ids else b"".join(ids)


#: Leading bytes of UTF-8: first and last byte of the class, bytes that follow, bounds of the next one.
_LEADS = ((0xC2, 0xDF, 1, 0x80, 0xBF), (0xE0, 0xE0, 2, 0xA0, 0xBF), (0xE1, 0xEC, 2, 0x80, 0xBF), (0xED, 0xED, 2, 0x80, 0x9F),
          (0xEE, 0xEF, 2, 0x80, 0xBF), (0xF0, 0xF0, 3, 0x90, 0xBF), (0xF1, 0xF3, 3, 0x80, 0xBF), (0xF4, 0xF4, 3, 0x80, 0x8F))
_LEAD = {b: (more, low, high) for first, last, more, low, high in _LEADS for b in range(first, last + 1)}


class Utf8Machine:
    """Takes bytes piece by piece and gives back whole characters; what can't be one becomes U+FFFD."""

    def __init__(self) -> None:
        self.held = b""
        self._more, self._low, self._high = 0, 0x80, 0xBF

    def feed(self, octets: bytes) -> str:
        out = []
        for byte in octets:
            if self._more and self._low <= byte <= self._high:
                self.held += bytes((byte,))
                self._more, self._low, self._high = self._more - 1, 0x80, 0xBF
                if not self._more:
                    out.append(self.held.decode())
                    self.held = b""
                continue
            if self._more:
                out.append(self.finish())
            if byte < 0x80:
                out.append(chr(byte))
            elif byte in _LEAD:
                self._more, self._low, self._high = _LEAD[byte]
                self.held = bytes((byte,))
            else:
                out.append("�")
        return "".join(out)

    def finish(self) -> str:
        """What an unfinished character at the end gives."""
        cut, self.held, self._more = bool(self.held), b"", 0
        return "�" * cut


class Decoder:
    """Text of ids. A token of whole characters needs no machine while none is unfinished."""

    def __init__(self, path: str):
        self._octets = {rank: token for token, rank in read_ranks(path).items()}
        self._text: dict[int, str | None] = {}
        for rank, token in self._octets.items():
            machine = Utf8Machine()
            text = machine.feed(token)
            self._text[rank] = None if machine.held or "�" in text else text

    def stream(self, ids: Iterable[int]) -> Iterator[str]:
        """Pieces of text, each as soon as its characters are whole."""
        machine = Utf8Machine()
        for token in ids:
            text = None if machine.held else self._text[token]
            piece = machine.feed(self._octets[token]) if text is None else text
            if piece:
                yield piece
        yield machine.finish()

    def decode(self, ids: list[int]) -> str:
        pieces = list(map(self._text.__getitem__, ids))
        machine, at, parts = Utf8Machine(), 0, pieces.count(None)  # tokens that hold part of a character
        while parts:
            at = pieces.index(None, at)
            while at < len(ids) and (pieces[at] is None or machine.held):
                parts -= pieces[at] is None
                pieces[at] = machine.feed(self._octets[ids[at]])
                at += 1
        return "".join(pieces) + machine.finish()


_TABLES: dict[tuple, Encoder | Decoder] = {}


def _table(kind: type, *args: str):
    """One per worker process."""
    if (kind, *args) not in _TABLES:
        _TABLES[kind, *args] = kind(*args)
    return _TABLES[kind, *args]


def encode(text: Column, ranks_path: str, pattern: str) -> Column:
    """Array of token ids of the whole text; empty for a null or empty one. Special tokens are ordinary text."""

    @F.arrow_udf("array<int>")
    def of(texts: pa.Array) -> pa.Array:
        encoder, ids, ends = _table(Encoder, ranks_path, pattern), bytearray(), [0]
        for text in texts:
            ids += encoder.encode(text.as_py())
            ends.append(len(ids) // 4)
        return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.frombuffer(ids, np.int32)))

    return of(text)


def decode(ids: Column, ranks_path: str) -> Column:
    """Text of an array of token ids; null for null. An id outside the vocabulary is an error."""

    @F.arrow_udf("string")
    def of(arrays: pa.Array) -> pa.Array:
        decoder = _table(Decoder, ranks_path)
        values, ends, known = arrays.values.to_numpy(), arrays.offsets.to_numpy(), arrays.is_valid().to_pylist()
        # one document's ids become Python integers at a time
        texts = (decoder.decode(values[a:b].tolist()) if there else None for a, b, there in zip(ends, ends[1:], known))
        return pa.array(texts, pa.string(), size=len(arrays))

    return of(ids)
