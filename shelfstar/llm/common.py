"""Small helpers shared by the operators of this package."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..session import ensure_checkpoint_dir


def fresh(df: DataFrame, stem: str) -> str:
    """A column name that no column of ``df`` has, whatever its case."""
    taken = {c.lower() for c in df.columns}
    while stem.lower() in taken:
        stem += "_"
    return stem


#: Rows and bytes that go to a Python worker at once: texts may be long, and a worker holds a batch several times.
BATCH_ROWS, BATCH_BYTES = 1000, 32 << 20


def bounded_batches(spark: SparkSession) -> None:
    """Keep Arrow batches small in this session, if it has larger ones."""
    for name, most in (("maxRecordsPerBatch", BATCH_ROWS), ("maxBytesPerBatch", BATCH_BYTES)):
        setting = f"spark.sql.execution.arrow.{name}"
        now = spark.conf.get(setting, None)
        if now is None or not now.isdigit() or not 0 < int(now) <= most:
            spark.conf.set(setting, str(most))


def checkpointed(df: DataFrame) -> DataFrame:
    """``df`` written once to the shared checkpoint folder; later steps read it from there."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def written(df: DataFrame) -> DataFrame:
    """``df`` written once as Parquet to the shared checkpoint folder and read from there, by the columns that are asked for."""
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    folder = f"{spark.sparkContext.getCheckpointDir()}/rows-{uuid.uuid4().hex}"
    df.write.parquet(folder)
    return spark.read.schema(df.schema).parquet(folder)


def fold(key: str, folds: int) -> Column:
    """Fold of a row: crc32 of the key's decimal text; null for a null key, which is in no fold."""
    return F.crc32(F.col(key).cast("string").cast("binary")) % folds


def whole(text: str) -> Column:
    return F.coalesce(F.col(text), F.lit(""))


def lower_ascii(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
