"""Plain versions of the operators, written for clarity on small tables."""

from __future__ import annotations

import base64
import hashlib
import re
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import sentencepiece
import tiktoken
import xxhash

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def secret_spans(text):
    text, found = text or "", []
    for m in re.finditer(r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text):
        if len(m[2]) >= 6:
            found.append((m.start(), 0, f"assign:{m.start()}:{m.end()}"))
    found += [(m.start(), 1, f"access:{m.start()}:{m.end()}") for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    found += [(m.start(), 2, f"hex:{m.start()}:{m.end()}") for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return ",".join(s for _, _, s in sorted(found))


def sha(data):
    return hashlib.sha256(data if isinstance(data, bytes) else data.encode()).hexdigest()


def piece_counter():
    model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    return lambda text: len(model.encode(text or ""))


def bpe_encoder():
    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    own = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    return lambda text: own.encode_ordinary(text or "")


def quality(text):
    text = text or ""
    words = WORDS.findall(text)
    windows = Counter(zip(words, words[1:], words[2:]))
    held = {i + k for i, w in enumerate(zip(words, words[1:], words[2:])) if windows[w] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if WORDS.search(x)]
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(held),
            len(words) < 50 or 100 * len(held) > 50 * len(words))


def frequent_lines(rows, limit, least_left):
    """rows: (text, host). Whether each is depleted."""
    plain = lambda x: " ".join(WORDS.findall(re.sub("[A-Z]", lambda m: m[0].lower(), x)))
    texts = defaultdict(set)
    lines = [[plain(x) for x in (t or "").split("\n") if WORDS.search(x)] for t, _ in rows]
    for (t, host), found in zip(rows, lines):
        for x in found:
            texts[host, x].add(t)
    out = []
    for (t, host), found in zip(rows, lines):
        n = sum(len(x.split()) for x in found)
        gone = sum(len(x.split()) for x in found if len(texts[host, x]) > limit)
        out.append((gone, n - gone < least_left * n))
    return out


def groups(count, links):
    root = list(range(count))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in links:
        a, b = top(a), top(b)
        root[max(a, b)] = min(a, b)
    return [top(i) for i in range(count)]


def simhash(text):
    words = WORDS.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def simhash_groups(rows):
    """rows: (id, text) -> [(id, hex, component)]"""
    prints = np.array([simhash(t) for _, t in rows], np.uint64)
    links = []
    for i in range(len(prints)):
        apart = np.bitwise_count(prints[i + 1 :] ^ prints[i])
        links += [(i, i + 1 + int(k)) for k in np.flatnonzero(apart <= 3)]
    roots, least = groups(len(rows), links), {}
    for (key, _), r in zip(rows, roots):
        least[r] = min((x for x in (least.get(r), key) if x is not None), default=None)
    return [(key, f"{int(p):016x}", least[r]) for (key, _), p, r in zip(rows, prints, roots)]


def near_vectors(rows, least=0.95):
    """rows: (id, vector) -> [(id, links, component, kept)]"""
    usable = [i for i, (_, v) in enumerate(rows) if v is not None and len(v) and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    links = []
    for size in {len(rows[i][1]) for i in usable}:
        own = [i for i in usable if len(rows[i][1]) == size]
        x = np.array([rows[i][1] for i in own], float)
        x /= np.linalg.norm(x, axis=1, keepdims=True)
        a, b = np.nonzero(np.triu(x @ x.T >= least, 1))
        links += [(own[i], own[j]) for i, j in zip(a, b)]
    many, roots, named = Counter(i for link in links for i in link), groups(len(rows), links), {}
    for (key, _), r in zip(rows, roots):
        named[r] = min((k for k in (named.get(r), key) if k is not None), default=None)
    return [(key, many[i], named[r], key == named[r]) for i, ((key, _), r) in enumerate(zip(rows, roots))]


def runs(words, least):
    """Every stretch of one smallest period that can't grow: (start, length, period), by start and then period."""
    found = {}
    for q in range(1, len(words) // 2 + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            if j - i >= q and j - i + q >= least:
                found.setdefault((i, j + q - i), q)  # periods rise, so the first is the smallest
            i = j + 1
    return sorted(((s, n, q) for (s, n), q in found.items()), key=lambda r: (r[0], r[2]))


def without_repeats(words, found):
    gone = {i for s, n, q in found for i in range(s + q, s + n)}
    return [w for i, w in enumerate(words) if i not in gone]
