"""Registered queries: each operator over its whole table, with production parameters."""

from __future__ import annotations

import zlib
from collections.abc import Callable

import public_tokenizers
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from . import bit_mixing, bpe, language_id, line_quality, mixing, periodic, resampling, secrets, simhash, token_counts, toxicity, url_reputation, vector_dedup
from .common import bounded_batches, checkpointed, fold
from .oracles import ORACLES as ORACLES

#: Folds kept for testing, and the rules of the url query.
LANGUAGE_FOLDS, LANGUAGE_TEST = 4, 2
TOXIC_FOLDS, TOXIC_TEST = 5, 0
SCORE_FOLDS, SCORE_TEST = 7, 2
RULES = [url_reputation.Rule("block", "net/"), url_reputation.Rule("allow", "example.net/en/"),
         url_reputation.Rule("block", "example.com/de/"), url_reputation.Rule("allow", "org/fr/")]
LIMIT = 4096
#: Some 32 MB as a hash table of longs.
BROADCAST_LABELS = 1_000_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    bounded_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def held_out(folds: int, test: int):
    """Whether a row is in the test fold; a row without an id is in none."""
    return F.coalesce(fold("doc_id", folds) == test, F.lit(False))


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = table(spark, sf_dir, "documents").select("doc_id", secrets.find_secrets(F.col("text")).alias("found"))
    many = lambda kind: F.size(F.filter("found", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    base = F.filter("found", lambda s: s["kind"] != "novel")
    return found.select("doc_id", *map(many, secrets.KINDS), F.sha2(secrets.joined(base), 256).alias("base_sha256"), secrets.joined(F.col("found")).alias("spans"))


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = public_tokenizers.path("piece_bpe_32k.model")
    counted = token_counts.count_tokens(table(spark, sf_dir, "documents"), model)
    return counted.withColumn("over_limit", F.col("n_tokens") > LIMIT)


def page_outcomes(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """Labelled pages and good ones per host: the number in a page's path is that of the document on it."""
    host, path = url_reputation.url_parts(F.col("url"))
    number = F.regexp_extract(path, r"^/[^/]*/([0-9]{1,18})(?:[./]|$)", 1)
    seen = pages.select(host.alias("host"), F.when(number != "", number.cast("long")).alias("doc_id"))
    many = seen.dropna().groupBy("host", "doc_id").agg(F.count(F.lit(1)).alias("pages"))
    good = labels.filter("quality in (0, 1)").groupBy("doc_id").agg(F.min("quality").alias("good"))
    told = many.join(good, "doc_id")
    return told.groupBy("host").agg(F.sum("pages").alias("n"), F.sum(F.col("pages") * F.col("good")).alias("s"))


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return url_reputation.judge_urls(pages, page_outcomes(pages, table(spark, sf_dir, "labels")), RULES)


def with_labels(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Labelled texts. Up to ``BROADCAST_LABELS`` labels go to the texts; with more, the texts are shuffled once and kept."""
    if labels.count() <= BROADCAST_LABELS:
        return docs.join(F.broadcast(labels), "doc_id")
    return checkpointed(docs.join(labels, "doc_id"))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").select("doc_id", F.col("toxic").alias("label")).dropna()
    model = toxicity.fit(with_labels(docs.filter(fold("doc_id", TOXIC_FOLDS) != TOXIC_TEST), labels))
    scored = docs.select("doc_id", held_out(TOXIC_FOLDS, TOXIC_TEST).alias("held_out"), toxicity.toxicity(F.col("text"), model).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def op5_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


def op6_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    ids = table(spark, sf_dir, "documents").select("doc_id", bpe.encode(F.col("text"), ranks, public_tokenizers.PATTERN).alias("ids"))
    both = ids.select("doc_id", "ids", bpe.decode(F.col("ids"), ranks).alias("decoded"))
    return both.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op7_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_dedup.near_vectors(table(spark, sf_dir, "embeddings"))


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_quality.judge_quality(table(spark, sf_dir, "documents"))


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = language_id.fit(docs.filter(fold("doc_id", LANGUAGE_FOLDS) != LANGUAGE_TEST))
    told = docs.select("doc_id", held_out(LANGUAGE_FOLDS, LANGUAGE_TEST).alias("held_out"), language_id.identify(F.col("text"), model).alias("x"))
    return told.select("doc_id", "held_out", "x.lang_pred", "x.score", "x.ambiguous")


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.simhash_groups(table(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash.hex_digits(F.col("fp")).alias("fingerprint"), "component_id")


def looped(text: Column, key: Column) -> Column:
    """The text of every tenth key, by crc32, with its tail turned into a period of its own words; other texts, and those
    of a null key, stay as they are."""

    @F.arrow_udf("string")
    def of(texts: pa.Array, keys: pa.Array) -> pa.Array:
        out = []
        for value, key in zip(texts, keys):
            body, h = value.as_py() or b"", 1 if (key := key.as_py()) is None else zlib.crc32(str(key).encode())
            if h % 10 == 0 and (words := body.split()):
                n, g = len(words), h // 10
                a = g % n
                p = 1 + (n - a) // (3 + g % 8)
                body = b" ".join(words[:a] + [words[a + (i - a) % p] for i in range(a, n)])
            out.append(body)
        return pa.array(out, pa.binary()).cast(pa.string())

    return of(text.cast("binary"), key)


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", looped(F.col("text"), F.col("doc_id")).alias("text"))
    found = docs.select("doc_id", periodic.periodic(F.col("text")).alias("x")).select("doc_id", "x.runs", "x.collapsed")
    top = found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), periodic.longest(F.col("runs")).alias("top"),
                       F.sha2(periodic.listed(F.col("runs")), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
    return top.select("doc_id", "n_runs", "top.start", "top.length", "top.period", F.expr("1000 * top.length div top.period").alias("exponent_milli"), "runs_sha256", "collapsed_sha256")


def op12_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", held_out(SCORE_FOLDS, SCORE_TEST).alias("held_out"))
    model = bit_mixing.fit(docs.filter(fold("doc_id", SCORE_FOLDS) != SCORE_TEST))
    return bit_mixing.score(docs, model, keep=["held_out"])


def op13_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resampling.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (op1_secret_scan, op2_token_counts, op3_url_filter, op4_toxicity, op5_source_mix, op6_byte_bpe,
              op7_embedding_dedup, op8_quality_rules, op9_language_id, op10_simhash, op11_periodic_runs, op12_lm_scores, op13_importance_resampling)
}
