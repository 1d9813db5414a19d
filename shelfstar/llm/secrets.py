"""Secret scan: fixed patterns, and dictionary-primed zstandard novelty.

Patterns find assignments, access keys and long hexadecimal runs. Beyond them, any other run of key
characters in a sensitive context is measured: how many bytes a zstandard frame grows by when the run is
added to the code around it, the compressor being primed with an identifier dictionary. A name made of
known parts, or one that its surroundings repeat, costs few bytes; a random key, be it of letters or digits alone,
costs nearly all of its entropy and is reported as ``novel``. Contexts are key words before or behind the run, in camelCase too. Only texts with a sensitive word or key characters reach the expressions.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import pandas as pd
import zstandard
from pyspark.sql import Column, functions as F

#: Patterns of the base kinds, in the order in which they are listed; least length of what counts.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
KINDS = ("assign", "access", "hex", "novel")

#: Parts of every word that the assignment pattern and the sensitive words begin from; a plain search is far cheaper than they are.
_HINTS = ("passw", "passphrase", "pwd", "secret", "token", "key", "private", "credential", "auth", "bearer", "signature", "session")
#: Key words stand after any name and a hyphen, an underscore or a hump. After a word, a capital begins the next
#: part of a camelCase name; after one in capitals, no letter may follow.
_SENSITIVE = re.compile(
    r"(?:pass(?:word|wd|phrase)|pwd|secret|token|credential|auth(?:orization|entication)?|bearer|signature|session"
    r"|(?:api|access|private|encryption|signing|master)\x20?key|(?<!public)[_-]key|(?<!public)(?-i:(?<=[a-z0-9])Key))s?"
    r"(?-i:(?![a-z])(?:(?<=[a-z])|(?![A-Z])))", re.I | re.A)
_KEY_CHARS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
_RUN = re.compile(r"[A-Za-z0-9+/_=-]{16,}")
REACH = 64
AROUND = 256
#: Bytes that a character of a run must cost; a random one of 64 kinds costs 0.75.
NOVELTY = 0.6
#: The same for a run of letters alone: long words of prose cost about 0.6 where they are new, random letters from 0.75 on.
LETTERS_NOVELTY = 0.75

#: Identifier dictionary: names and phrases that code and prose around keys commonly hold.
IDENTIFIERS = (
    "password passwd passphrase secret token api_key apikey access_key private_key public_key client_id client_secret "
    "credential credentials authorization authenticate bearer signature session cookie username user_name account "
    "connection_string database hostname localhost endpoint example configuration environment production staging development "
    "getAccessToken setAccessToken refresh_token access_token id_token generate_token validate_token token_type expires_in "
    "std::string const char* public static void private final String return new null true false import from class def self "
    "function var let const async await require module exports export default package include namespace template typename "
    "https://www. http:// .com/ .org/ .net/ /api/v1/ /api/v2/ /users/ /home/ /usr/local/ /etc/ .json .yaml .xml .html .properties "
    "abcdefghijklmnopqrstuvwxyz ABCDEFGHIJKLMNOPQRSTUVWXYZ 0123456789 0000000000000000 AAAAAAAAAAAAAAAA xxxxxxxxxxxxxxxx "
    "---------------- ================ ________________ ++++++++++++++++ //////////////// your_token_here your-secret-here "
    "placeholder changeme undefined SECRET_ACCESS_KEY ACCESS_KEY_ID SECRET_KEY_BASE AUTH_TOKEN API_TOKEN BEGIN PRIVATE KEY END"
).encode()


@dataclass(frozen=True)
class Span:
    kind: str
    start: int
    end: int


class Novelty:
    """Bytes by which a primed frame grows for a run; made once per task."""

    def __init__(self, identifiers: bytes = IDENTIFIERS):
        primed = zstandard.ZstdCompressionDict(identifiers, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        self._press = zstandard.ZstdCompressor(level=9, dict_data=primed, write_content_size=False, write_dict_id=False)

    def bytes_added(self, around: str, run: str) -> int:
        base = around.encode("utf-8", "replace")
        return len(self._press.compress(base + run.encode())) - len(self._press.compress(base))

    def is_novel(self, around: str, run: str) -> bool:
        return self.bytes_added(around, run) >= (NOVELTY if any(c.isdigit() for c in run) else LETTERS_NOVELTY) * len(run)


def hinted(text: str) -> bool:
    lower = text.lower()
    return any(hint in lower for hint in _HINTS)


def base_spans(text: str, assigned: bool = True) -> list[Span]:
    """``assigned``: whether the text may hold an assignment."""
    found = []
    if assigned:
        found += [Span("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        found += [Span("access", *m.span()) for m in ACCESS.finditer(text) if len(m[0]) >= 20]
    found += [Span("hex", *m.span()) for m in HEX.finditer(text)]
    return found


def runs_before(text: str, done: int, stop: int) -> Iterator[tuple[int, int]]:
    """Runs from ``done`` on that reach into the ``REACH`` characters before ``stop``, each from its beginning."""
    low, width = stop - REACH, AROUND
    while low > done:
        head = text[max(done, low - width) : low]
        own = len(head) - len(head.rstrip(_KEY_CHARS))
        if own < len(head) or low - width <= done:  # else a run longer than the window
            low -= own
            break
        width *= 2
    for m in _RUN.finditer(text, max(done, low), stop):
        yield m.span()


def runs_after(text: str, start: int, stop: int) -> Iterator[tuple[int, int]]:
    """Runs that begin from ``start`` to before ``stop``, each to its end."""
    while start < stop and (m := _RUN.search(text, start, stop + AROUND)) and m.start() < stop:
        end = m.end()
        if end == stop + AROUND:  # a run longer than the window: take all of it
            end = _RUN.match(text, m.start()).end()
        yield m.start(), end
        start = end


def novel_spans(text: str, base: list[Span], novelty: Novelty) -> list[Span]:
    """Runs of 16 or more key characters within ``REACH`` before or after a sensitive word that no base span touches.

    What goes on from the word, or up to it, without a separator is its own name unless letters and digits are mixed in it.
    """
    found, done = [], 0
    for word in _SENSITIVE.finditer(text):
        after = max(word.end(), done)
        for start, end in chain(runs_before(text, done, word.start()), runs_after(text, after, word.end() + REACH)):
            done = end
            run = text[start:end]
            named = end == word.start() or start == word.end() and "=" not in run.rstrip("=")
            mixed = any(c.isdigit() for c in run) and any(c.isalpha() for c in run)
            if (mixed or not named) and not any(s.start < end and start < s.end for s in base):
                around = text[max(0, start - AROUND) : start] + text[end : end + AROUND]
                if novelty.is_novel(around, run):
                    found.append(Span("novel", start, end))
    return found


def scan(text: str | None, novelty: Novelty) -> list[Span]:
    """All spans by start, then kind; none in a null or empty text."""
    if not text:
        return []
    sensitive = hinted(text)
    found = base_spans(text, sensitive)
    if sensitive:
        found += novel_spans(text, found, novelty)
    return sorted(found, key=lambda s: (s.start, KINDS.index(s.kind)))


def find_secrets(text: Column) -> Column:
    """Array of structs ``kind``, ``start``, ``end`` (code points, end exclusive)."""

    @F.pandas_udf("array<struct<kind:string,start:long,end:long>>")
    def of(texts: pd.Series) -> pd.Series:
        novelty = Novelty()
        return pd.Series([[{"kind": s.kind, "start": s.start, "end": s.end} for s in scan(t, novelty)] for t in texts], dtype=object)

    return of(text)


def redact(text: Column, mask: str = "<secret>") -> Column:
    """The text with every span of a secret, or of overlapping ones, replaced; null stays null."""

    @F.pandas_udf("string")
    def of(texts: pd.Series) -> pd.Series:
        novelty = Novelty()
        return pd.Series([masked(t, scan(t, novelty), mask) for t in texts], dtype=object)

    return of(text)


def masked(text: str | None, spans: list[Span], mask: str) -> str | None:
    if not spans:
        return text
    parts, at = [], 0
    for s in spans:
        if s.start >= at:
            parts += [text[at : s.start], mask]
        at = max(at, s.end)
    return "".join([*parts, text[at:]])


def joined(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
