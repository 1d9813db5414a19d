"""Importance resampling towards a target distribution.

Features (runs of words) are hashed into buckets, and both corpora are counted per bucket over all their texts. A
bucket's gain is the log ratio of its two smoothed shares; a document's weight is the sum of the gains of its features,
looked up in one array. A seeded Gumbel term beside the weight turns the highest scores into a draw without replacement.

Scores are written once. The score of the last document drawn is then found by bisection: each round counts the
rows at or above some thresholds over all written scores, exactly, and keeps the part where the wanted count lies. Rows tied
at that score are cut in the same way by id, and rows of one id by their number. Rows drawn are range-partitioned in their
order and numbered within each part after the rows of the parts before. Only counts come to the driver.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import shuffle_partitions
from .common import written

BUCKETS, LONGEST, SEED = 10_000, 1, 2024
#: Share of the documents with ``LEAST_WORDS`` words that is drawn, in percent.
PERCENT, LEAST_WORDS = 10, 20
#: Thresholds of one counting round, and rows that one task numbers.
THRESHOLDS, PIECE_ROWS = 16, 1_000_000

_LETTERS = bytes(range(ord("A"), ord("Z") + 1))
_WORD_BYTES = set(range(0x30, 0x3A)) | set(range(0x61, 0x7B)) | set(range(0x80, 0x100))
#: Capital letters to small ones, every byte outside words to a blank.
_PLAIN = bytes(b + 32 if b in _LETTERS else b if b in _WORD_BYTES else 32 for b in range(256))


def words_of(text: bytes | None) -> list[bytes]:
    return text.translate(_PLAIN).split() if text else []


def features(words: Sequence[bytes], longest: int) -> Iterator[bytes]:
    """All runs of one to ``longest`` words, joined by one blank."""
    for k in range(1, longest + 1):
        yield from words if k == 1 else (b" ".join(words[i : i + k]) for i in range(len(words) - k + 1))


def _buckets(words: Sequence[bytes], longest: int, buckets: int) -> np.ndarray:
    return (np.fromiter(map(zlib.crc32, features(words, longest)), np.uint32) % np.uint32(buckets)).astype(np.int64)


def bucket_counts(docs: DataFrame, text: str = "text", longest: int = LONGEST, buckets: int = BUCKETS) -> np.ndarray:
    """Features of all texts by bucket. Each task adds up before anything is shuffled; at most ``buckets`` rows come back."""

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(buckets, np.int64)
        for batch in batches:
            for value in batch.column(0):
                counts += np.bincount(_buckets(words_of(value.as_py()), longest, buckets), minlength=buckets)
        held = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(counts[held])], ["bucket", "n"])

    texts = docs.select(F.col(text).cast("binary").alias("text")).filter(F.octet_length("text") > 0)
    out = np.zeros(buckets, np.int64)
    for row in texts.mapInArrow(add_up, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[row["bucket"]] = row["n"]
    return out


def gains(source: np.ndarray, target: np.ndarray) -> list[int]:
    """Thousandths of the log ratio of target share to source share, each bucket counted once more."""
    many, s_all, t_all = len(source), float(source.sum()), float(target.sum())
    ratio = lambda s, t: (t + 1.0) * (s_all + many) / ((s + 1.0) * (t_all + many))
    return [math.floor(1000 * math.log(ratio(float(s), float(t)))) for s, t in zip(source, target)]


def weighed(text: Column, gain: Sequence[int], longest: int = LONGEST) -> Column:
    """Struct of ``n_words``, ``n_features`` and ``weight``; all 0 for a text that is null or has no word."""
    array = np.array(gain, np.int64)

    @F.arrow_udf("struct<n_words:bigint,n_features:bigint,weight:bigint>")
    def of(texts: pa.Array) -> pa.Array:
        out = np.zeros((3, len(texts)), np.int64)
        for i, value in enumerate(texts):
            words = words_of(value.as_py())
            if words:
                found = _buckets(words, longest, len(array))
                out[:, i] = len(words), len(found), array[found].sum()
        return pa.StructArray.from_arrays([pa.array(x) for x in out], ["n_words", "n_features", "weight"])

    return of(text.cast("binary"))


def chance(key: Column, seed: int = SEED) -> Column:
    """Thousandths of the Gumbel term of a key, from its SHA-256; a null key is hashed as an empty one."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))).cast("binary"), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0))).cast("long")


def _cut(rows: DataFrame, value: Column, wanted: int) -> tuple[int, int, int]:
    """The highest threshold that at least ``wanted`` rows reach, the rows above it, and those at it."""
    told = rows.agg(F.min(value).alias("low"), F.max(value).alias("high"), F.count(F.lit(1)).alias("n")).first()
    low, high, reach, above = told["low"], told["high"], told["n"], 0  # rows from low on, and from high + 1 on
    while low < high:
        points = sorted({low + (high - low + 1) * k // THRESHOLDS for k in range(1, THRESHOLDS)} - {low} | {high})
        counts = rows.agg(*(F.count_if(value >= p).alias(f"p{k}") for k, p in enumerate(points))).first()
        for point, count in zip(points, counts):
            if count < wanted:
                high, above = point - 1, count
                break
            low, reach = point, count
    return low, above, reach - above


def highest(rows: DataFrame, values: Sequence[Column], wanted: int) -> Column:
    """Whether a row is one of the ``wanted`` highest by ``values``, longs compared one after the other; the last ones differ."""
    if wanted <= 0:
        return F.lit(False)
    chosen, tied = F.lit(False), F.lit(True)
    for value in values:
        least, above, at = _cut(rows, value, wanted)
        wanted -= above
        if at == wanted:
            return chosen | tied & (value >= F.lit(least))
        chosen, tied = chosen | tied & (value > F.lit(least)), tied & (value == F.lit(least))
        rows = rows.filter(value == F.lit(least))
    raise ValueError("rows are tied in every value")


def ranked(rows: DataFrame, order: Sequence[Column], many: int, name: str = "rank") -> DataFrame:
    """``rows`` with their place in ``order``, from 1; ``many`` is about their number. Parts are ranges of the order."""
    parts = max(1, min(-(-many // PIECE_ROWS) * 4, max(shuffle_partitions(rows.sparkSession), -(-many // PIECE_ROWS))))
    pieces = written(rows.repartitionByRange(parts, *order).withColumn("piece", F.spark_partition_id()))
    before = Window.orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    counts = pieces.groupBy("piece").agg(F.count(F.lit(1)).alias("n"))  # one row for each part
    offsets = counts.select("piece", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    own = F.row_number().over(Window.partitionBy("piece").orderBy(*order))
    numbered = pieces.withColumn("own", own).join(F.broadcast(offsets), "piece")
    return numbered.select(*rows.columns, (F.col("before") + F.col("own")).cast("long").alias(name))


def resample(docs: DataFrame, target: DataFrame, key: str = "doc_id", text: str = "text", percent: int = PERCENT, least_words: int = LEAST_WORDS,
             longest: int = LONGEST, buckets: int = BUCKETS, seed: int = SEED) -> DataFrame:
    """``key``, ``n_features``, ``weight``, ``score``, ``rank`` (longs; null where not drawn) for each row of ``docs``.

    The draw takes ``percent`` of the rows with ``least_words`` words, rounded down: those of highest score, then smallest
    key (null keys last), then, for repeated rows, by their place in the written scores. A null or empty text has no feature
    and weight 0; empty tables have no features, so all gains are equal. Keys are integers. Other columns are not carried.
    """
    gain = gains(bucket_counts(docs, text, longest, buckets), bucket_counts(target, "text", longest, buckets))
    told = docs.select(F.col(key).cast("long").alias("key"), weighed(F.col(text), gain, longest).alias("x"))
    scored = written(told.select(F.monotonically_increasing_id().alias("row"), "key", "x.n_words", "x.n_features", "x.weight",
                                 (F.col("x.weight") + chance(F.col("key"), seed)).alias("score")))
    fit = scored.filter(F.col("n_words") >= least_words)
    wanted = fit.count() * percent // 100
    # every value counts upwards: a smaller key or row number is a higher complement
    values = [F.col("score"), F.col("key").isNotNull().cast("long"), F.coalesce(F.bitwise_not("key"), F.lit(0)), F.bitwise_not("row")]
    drawn = (F.col("n_words") >= least_words) & highest(fit, values, wanted)
    order = [F.desc("score"), F.asc_nulls_last("key"), F.asc("row")]
    first = ranked(scored.filter(drawn), order, wanted)
    rest = scored.filter(~drawn).withColumn("rank", F.lit(None).cast("long"))
    return first.unionByName(rest).select(F.col("key").alias(key), "n_features", "weight", "score", "rank")
