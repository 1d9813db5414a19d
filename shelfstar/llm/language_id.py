"""Language identification by error-correcting output codes.

Every language learned gets a codeword of bits. A bit splits the languages in two sides, and a binary
classifier over byte n-grams of the text predicts it: the log ratio of how often each side has the
n-gram, languages weighing alike within a side. Decoding adds up the losses of all bits for every codeword,
bits that part their languages better counting more, and takes the least; a close second is flagged.

The n-gram counts cover every labelled training text; each task adds up one vector per language, so
what is shuffled and collected is bounded by languages times ``BUCKETS``.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

BUCKETS = 1 << 13
UNKNOWN = "und"
#: A text speaks with at most so many n-grams: they aren't independent, and a score should not be 1 for every page.
EVIDENCE = 40
#: Under this score the decoding is ambiguous.
SURE = 0.5
_CHUNK = 1 << 20
_LETTERS = bytes(b if b >= 128 or chr(b).isalpha() else 32 for b in range(256))


def _codes(octets: np.ndarray) -> np.ndarray:
    x = octets[:-2] * np.uint32(0x9E3779B1) + octets[1:-1] * np.uint32(0x85EBCA77) + octets[2:] * np.uint32(0xC2B2AE3D)
    return (x ^ (x >> np.uint32(15))) & np.uint32(BUCKETS - 1)


_BLANK = int(_codes(np.full(3, 32, np.uint32))[0])


def ngram_counts(text: str) -> np.ndarray:
    """Hashed byte trigrams of the whole lower-cased text; what isn't a letter counts as blank."""
    octets = b" " + text.lower().encode("utf-8", "replace").translate(_LETTERS) + b" "
    counts = np.zeros(BUCKETS, np.int64)
    for at in range(0, len(octets) - 2, _CHUNK):
        part = np.frombuffer(octets, np.uint8, min(_CHUNK + 2, len(octets) - at), at).astype(np.uint32)
        counts += np.bincount(_codes(part), minlength=BUCKETS)
    counts[_BLANK] = 0
    return counts


def code_matrix(classes: int, seed: int = 7) -> np.ndarray:
    """A row of +1 and -1 for each class: all splits for up to 7 classes, else the best of 200 random codes."""
    if classes < 2:
        return np.zeros((classes, 0))
    if classes <= 7:
        columns = [[1, *(1 if m >> k & 1 else -1 for k in range(classes - 1))] for m in range(2 ** (classes - 1) - 1)]
        return np.array(columns, np.float64).T
    rng, best, width = np.random.default_rng(seed), None, math.ceil(10 * math.log2(classes))
    for _ in range(200):
        code = rng.choice([-1.0, 1.0], (classes, width))
        code = code[:, np.abs(code.sum(axis=0)) < classes]
        apart = ((code.shape[1] - code @ code.T) / 2 + np.eye(classes) * width).min()
        if best is None or apart > best[0]:
            best = (apart, code)
    return best[1]


@dataclass
class Model:
    languages: list[str]
    code: np.ndarray
    weights: np.ndarray
    trust: np.ndarray

    @classmethod
    def of(cls, counts: dict[str, np.ndarray]) -> Model:
        names = sorted(counts)
        code = code_matrix(len(names))
        if not names or not code.shape[1]:
            return cls(names, code, np.zeros((BUCKETS, 0)), np.zeros(0))
        shares = np.array([(c + 0.5) / (c.sum() + 0.5 * BUCKETS) for c in (counts[n] for n in names)])
        side = lambda s: np.array([shares[code[:, j] == s].mean(axis=0) for j in range(code.shape[1])])
        weights = np.log(side(1.0) / side(-1.0)).T
        expected = (shares @ weights) * code
        trust = np.clip(expected.min(axis=0), 0.05, None)
        return cls(names, code, weights, trust / trust.mean())

    def predict(self, text: str | None) -> tuple[str, float, bool]:
        if not text or not self.languages or not any(map(str.isalpha, text)):
            return UNKNOWN, 0.0, True
        if not self.code.shape[1]:
            return self.languages[0], 1.0, False
        counts = ngram_counts(text)
        total = counts.sum()
        margins = (counts @ self.weights) * (min(total, EVIDENCE) / max(total, 1))
        losses = np.logaddexp(0, -self.code * margins) @ self.trust
        chances = np.exp(losses.min() - losses)
        best = int(losses.argmin())
        score = float(chances[best] / chances.sum())
        return self.languages[best], score, score < SURE


def fit(labelled: DataFrame, text: str = "text", lang: str = "lang") -> Model:
    """Model of all rows with text and language; without any, it predicts ``und``."""

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, np.ndarray] = {}

        def flush() -> Iterator[pa.RecordBatch]:
            for name, counts in held.items():
                at = np.flatnonzero(counts)
                yield pa.RecordBatch.from_pydict({"lang": pa.array([name] * len(at), pa.string()), "bucket": pa.array(at, pa.int32()), "n": pa.array(counts[at], pa.int64())})
            held.clear()

        for batch in batches:
            for t, name in zip(*(c.to_pylist() for c in batch.columns)):
                held[name] = held.get(name, 0) + ngram_counts(t)
                if len(held) > 256:
                    yield from flush()
        yield from flush()

    rows = labelled.select(F.col(text).alias("text"), F.col(lang).alias("lang")).dropna()
    sums = rows.mapInArrow(add_up, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    found = sums.toArrow().to_pandas()
    counts = {}
    for name, part in found.groupby("lang"):
        counts[name] = np.bincount(part["bucket"], part["n"], BUCKETS)
    return Model.of(counts)


def identify(text: Column, model: Model) -> Column:
    """Struct of ``lang_pred``, ``score`` and ``ambiguous``. ``und``, 0 and true for a null text or one without a letter."""

    @F.pandas_udf("lang_pred string, score double, ambiguous boolean")
    def of(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([model.predict(t) for t in texts], columns=["lang_pred", "score", "ambiguous"])

    return of(text)
