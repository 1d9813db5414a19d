"""Importance resampling against a plain version, with ties, repeats and empty tables."""

import hashlib
import math
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from shelfstar.llm import queries, resampling

from .test_operators import SF, folder, given, odd_rows  # noqa: F401

COLUMNS = ["doc_id", "n_features", "weight", "score", "rank"]


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def plain(rows, targets, percent=10, least=20, longest=1, buckets=10_000, seed=2024):
    features = lambda t: [" ".join(w[i : i + k]) for w in [words(t)] for k in range(1, longest + 1) for i in range(len(w) - k + 1)]
    bucket = lambda f: zlib.crc32(f.encode()) % buckets
    s, t = (Counter(bucket(f) for x in texts for f in features(x)) for texts in ([x for _, x in rows], targets))
    total_s, total_t = sum(s.values()), sum(t.values())
    out = []
    for key, text in rows:
        found = features(text)
        weight = sum(math.floor(1000 * math.log((t[b] + 1) * (total_s + buckets) / ((s[b] + 1) * (total_t + buckets)))) for b in map(bucket, found))
        h = int(hashlib.sha256(f"{seed}:{'' if key is None else key}".encode()).hexdigest()[:8], 16)
        out.append([key, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, len(words(text))])
    fit = sorted((r for r in out if r[5] >= least), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    for place, r in enumerate(fit[: len(fit) * percent // 100], 1):
        r[4] = place
    return Counter(tuple(r[:5]) for r in out)


def test_query_equals_plain_version_on_given_rows(spark):
    got = queries.op13_importance_resampling(spark, SF)
    assert sorted(got.columns) == sorted(COLUMNS)
    want = plain(given(spark, "documents", "doc_id", "text"), [t for _, t in given(spark, "benchmark", "item_id", "text")])
    assert Counter(map(tuple, got.select(*COLUMNS).collect())) == want and any(r[4] for r in want)


@pytest.fixture(scope="module")
def benchmark(spark):
    return spark.createDataFrame([(1, "the ing eit Ouè the", "x"), (2, None, "x"), (3, "", "x")], "item_id long, text string, score string")


@pytest.mark.parametrize("longest", [1, 3])
def test_odd_rows(spark, odd_rows, folder, benchmark, longest):  # noqa: F811
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    got = Counter(map(tuple, resampling.resample(docs, benchmark, longest=longest, percent=40).select(*COLUMNS).collect()))
    assert got == plain([r[:2] for r in odd_rows], ["the ing eit Ouè the"], longest=longest, percent=40)


def test_ties_go_to_smaller_keys_and_repeats_are_drawn_in_part(spark, benchmark):
    text = " ".join(f"w{k}" for k in range(20))
    rows = [(7, text)] * 60 + [(None, text)] * 30 + [(9, text)] * 10
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = resampling.resample(docs, benchmark, percent=35).collect()
    assert sorted(r["rank"] for r in got if r["rank"]) == list(range(1, 36)) and len(got) == 100
    by_score = sorted({(-r["score"], r["doc_id"] is None, r["doc_id"] or 0) for r in got})
    drawn = [(-r["score"], r["doc_id"] is None, r["doc_id"] or 0) for r in sorted((r for r in got if r["rank"]), key=lambda r: r["rank"])]
    assert drawn == sorted(drawn) and drawn[0] == by_score[0]


def test_equal_scores_of_different_keys(spark):
    rows = [(i, 5, i % 3) for i in range(900)] + [(-(2**63), 5, 2), (2**63 - 1, 5, 2)]
    df = spark.createDataFrame(rows, "key long, same long, score long").repartition(7)
    values = [F.col("score"), F.bitwise_not("key")]
    for wanted in (0, 1, 2, 301, 302, 303, 600, 902):
        got = {r["key"] for r in df.filter(resampling.highest(df, values, wanted)).collect()}
        assert got == {k for k, _, _ in sorted(rows, key=lambda r: (-r[2], r[0]))[:wanted]}, wanted
    with pytest.raises(ValueError):
        resampling.highest(df, [F.col("same")], 3)


def test_ranks_run_through_all_pieces(spark, monkeypatch):
    monkeypatch.setattr(resampling, "PIECE_ROWS", 100)
    df = spark.range(5000).select(F.xxhash64("id").alias("a"), (F.col("id") % 3).alias("b"))
    got = resampling.ranked(df, [F.desc("b"), F.asc("a")], 5000).collect()
    ordered = sorted(got, key=lambda r: r["rank"])
    assert [r["rank"] for r in ordered] == list(range(1, 5001)) and ordered == sorted(got, key=lambda r: (-r["b"], r["a"]))


def test_empty_tables(spark, benchmark):
    docs = spark.createDataFrame([(1, "a " * 30), (2, None)], "doc_id long, text string")
    assert resampling.resample(docs.limit(0), benchmark).count() == 0
    assert {(r["doc_id"], r["n_features"], r["rank"]) for r in resampling.resample(docs, benchmark.limit(0), percent=100).collect()} == {(1, 30, 1), (2, 0, None)}
