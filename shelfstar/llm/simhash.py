"""SimHash near-duplicates by multi-index hashing.

A fingerprint is cut into two 32-bit segments. Of two fingerprints with at most three differing bits,
one segment differs in at most one bit, so each distinct fingerprint is stored under both segments
and looked up under every value in the Hamming ball of radius one around each segment. Matches are
verified on all 64 bits. Texts with the same fingerprint are one entry of the index from the start,
so a group of copies costs one row, and no pair of copies is ever made.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from .common import checkpointed
from .components import components

SHINGLE_WORDS = 3
MAX_BITS = 3
SEED = 42
_CHUNK = 1 << 16


def fingerprint(text: str | None, words: int = SHINGLE_WORDS, seed: int = SEED) -> int:
    """Unsigned SimHash of the word shingles, repeats included; 0 if there is no word."""
    found = text.encode().lower().split() if text else []  # bytes: only A-Z change, only \x20 and \x09-\x0D part words
    if not found:
        return 0
    digest, count, ones = xxhash.xxh64_intdigest, max(1, len(found) - words + 1), np.zeros(64, np.int64)
    for at in range(0, count, _CHUNK):
        last = min(count, at + _CHUNK)
        if len(found) < words:
            hashes = [digest(b" ".join(found), seed)]
        else:
            hashes = [digest(b" ".join(s), seed) for s in zip(*(found[at + k : last + k] for k in range(words)))]
        octets = np.array(hashes, ">u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(octets, axis=1).sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > count).view(">u8")[0])


def fingerprints(text: Column, words: int = SHINGLE_WORDS) -> Column:
    """The fingerprint as a long with the same 64 bits; a null text has that of an empty one."""

    @F.pandas_udf("long")
    def of(texts: pd.Series) -> pd.Series:
        return pd.Series(np.array([fingerprint(t, words) for t in texts], np.uint64).view(np.int64))

    return of(text)


def near_links(distinct: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """``a``, ``b``: each pair of the distinct longs in ``fp`` that differ in at most ``max_bits`` <= 3 bits."""
    if not 0 <= max_bits <= 3:
        raise ValueError("two segments with balls of radius one find at most three differing bits")
    segments = F.array(F.shiftrightunsigned("fp", 32), F.col("fp").bitwiseAND((1 << 32) - 1))
    cut = distinct.select("fp", F.posexplode(segments).alias("segment", "value"))
    place = (F.shiftleft(F.col("segment").cast("long"), 32)).bitwiseOR(F.col("value"))
    stored = cut.select(F.col("fp").alias("b"), place.alias("place"))
    ball = F.array(F.lit(0).cast("long"), *(F.lit(1 << k).cast("long") for k in range(32)))
    asked = cut.select(F.col("fp").alias("a"), F.explode(ball).alias("flip"), place.alias("at"))
    asked = asked.select("a", F.col("at").bitwiseXOR(F.col("flip")).alias("place"))
    differ = F.bit_count(F.col("a").bitwiseXOR(F.col("b")))
    return asked.join(stored, "place").filter((F.col("a") < F.col("b")) & (differ <= max_bits)).select("a", "b")


def simhash_groups(docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = SHINGLE_WORDS,
                   max_bits: int = MAX_BITS) -> DataFrame:
    """One row per row of ``docs``: the key, ``fp`` (long), ``text_hash`` and ``component_id``.

    ``component_id`` is the smallest key reachable over links, null if none of the group has one. Null and
    empty texts have fingerprint 0 and are linked like any other. Repeated rows give repeated rows.
    Other columns of ``docs`` are not carried, whatever their names.
    """
    # the row's fields are named here, so that no column of docs can clash
    marked = docs.select(F.col(key).alias("key"), F.xxhash64(F.coalesce(text, F.lit(""))).alias("text_hash"),
                         fingerprints(F.col(text), words).alias("fp"))
    marked = checkpointed(marked)
    classes = checkpointed(marked.groupBy("fp").agg(F.min("key").alias("least")))
    roots = components(near_links(classes.select("fp"), max_bits))
    rooted = classes.join(roots.withColumnRenamed("vertex", "fp"), "fp", "left")
    rooted = checkpointed(rooted.select("fp", "least", F.coalesce("root", "fp").alias("root")))
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    named = rooted.join(least, "root").select("fp", "component_id")
    return marked.join(named, "fp").select(F.col("key").alias(key), "fp", "text_hash", "component_id")


def one_of_each_group(docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = SHINGLE_WORDS,
                      max_bits: int = MAX_BITS) -> DataFrame:
    """The rows of ``docs``, all columns, that stand for their group: the one of smallest key (null keys last).

    Rows that share key and text are one document. Only the keys and text hashes of the kept rows meet
    the texts again.
    """
    found = checkpointed(simhash_groups(docs, key, text, words, max_bits).select(F.col(key).alias("key"), "text_hash", "fp", "component_id"))
    # a group without keys is known by its least fingerprint of all rows in it; such rows are no documents one can name
    group = F.coalesce(F.concat(F.lit("k"), F.col("component_id").cast("string")), F.concat(F.lit("f"), F.col("fp").cast("string")))
    first = found.groupBy(group.alias("g")).agg(F.min(F.struct(F.col("key").isNull().alias("none"), "key", "text_hash")).alias("first"))
    kept = first.select(F.col("first.key").alias("key"), F.col("first.text_hash").alias("text_hash"))
    mark = "row"
    row = F.struct(*(docs[c].alias(f"c{i}") for i, c in enumerate(docs.columns)))
    known = docs.select(F.col(key).alias("key"), F.xxhash64(F.coalesce(text, F.lit(""))).alias("text_hash"), row.alias(mark))
    # min() of whole rows combines repeats before the shuffle, so many copies of one row never meet in one task
    same = (known["key"].eqNullSafe(kept["key"])) & (known["text_hash"] == kept["text_hash"])
    left = known.join(kept, same, "left_semi").groupBy("key", "text_hash").agg(F.min(mark).alias(mark))
    return left.select(*(F.col(f"{mark}.c{i}").alias(c) for i, c in enumerate(docs.columns)))


def hex_digits(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))
