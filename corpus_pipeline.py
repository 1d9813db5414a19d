"""Corpus pipeline: language ID, SimHash near-dedup, secret scan, source mix, byte-level BPE.

Every stage takes the rows that the one before kept and returns a DataFrame; between stages rows are
written as Parquet and read again. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from shelfstar.llm import bpe, language_id, mixing, secrets, simhash
from shelfstar.llm.common import bounded_batches, fold, fresh
from shelfstar.llm.queries import LANGUAGE_FOLDS, LANGUAGE_TEST
from shelfstar.session import ensure_checkpoint_dir

#: A document goes if the decoding of its language is less sure than this.
LEAST_SURE = 0.4


def identified(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops texts without a letter, null ones among them, and those of no language that stands out."""
    bounded_batches(spark)
    model = language_id.fit(docs.filter(fold("doc_id", LANGUAGE_FOLDS) != LANGUAGE_TEST))
    told = fresh(docs, "told")
    marked = docs.withColumn(told, language_id.identify(F.col("text"), model))
    return marked.filter((F.col(f"{told}.lang_pred") != language_id.UNKNOWN) & (F.col(f"{told}.score") >= LEAST_SURE)).select(*docs.columns)


def deduplicated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps of each SimHash group the document of smallest id."""
    bounded_batches(spark)
    return simhash.one_of_each_group(docs)


def scanned(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces every secret in the texts; ``n_chars`` follows. Documents without one stay as they are."""
    bounded_batches(spark)
    masked = docs.withColumn("text", secrets.redact(F.col("text")))
    return masked.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(*docs.columns) if "n_chars" in docs.columns else masked


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeats each document as often as the mix takes it: not at all up to three times."""
    return mixing.repeat(docs)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id``, ``source``, ``ids``: token ids of the whole text, ``n_tokens``, and whether they decode to it."""
    bounded_batches(spark)
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    ids = docs.select("doc_id", "source", F.coalesce("text", F.lit("")).alias("text"), bpe.encode(F.col("text"), ranks, public_tokenizers.PATTERN).alias("ids"))
    both = ids.select("doc_id", "source", "ids", F.size("ids").cast("long").alias("n_tokens"), (bpe.decode(F.col("ids"), ranks) == F.col("text")).alias("round_trip"))
    return both


STAGES = [("language ID", identified), ("SimHash near-dedup", deduplicated), ("secret scan", scanned), ("source mix", mixed), ("byte-level BPE", encoded)]

#: The language decoder, SimHash and the tokenizer have no SQL form; tests hold the pipeline against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies the stages to ``documents``; rows between stages are in the shared folder of the session."""
    ensure_checkpoint_dir(spark)
    folder = f"{spark.sparkContext.getCheckpointDir()}/pipeline-{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for place, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{place}")
        docs = spark.read.parquet(f"{folder}/{place}")
    return docs
