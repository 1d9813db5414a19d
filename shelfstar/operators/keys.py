"""Dense surrogate keys 1, 2, 3, ... in the order of a natural key.

Numbering over one ordered window puts the table into one task, so every table is numbered in ordered pieces, whatever its
size: count per piece, running offset over the small table of pieces, row number within each piece.

* Integer keys: a piece is the run of 65,536 keys that share their upper 16 bits. There are at
  most 65,536 pieces and, the key being unique, at most 65,536 rows in each.
* Other keys: pieces are Spark's range partitions. Their bounds come from a sample, so the
  partitioned table is checkpointed and both steps read the same pieces. Rows of equal or missing keys are told apart by a
  hash of the row, so that they fall into several pieces and keep one order.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from ..session import ensure_checkpoint_dir, shuffle_partitions

_PIECE, _TIE = "_pieza", "_empate"
_NULL_PIECE = -(1 << 16)


def surrogate_key(df: DataFrame, name: str, natural: str) -> DataFrame:
    """``df`` with its number as ``name``. An integer key is unique, or its equal rows are numbered in any order."""
    if isinstance(df.schema[natural].dataType, T.IntegerType):
        upper = F.coalesce(F.shiftright(natural, 16), F.lit(_NULL_PIECE))
        return _number_pieces(df.withColumn(_PIECE, upper), name, [natural])
    return _number_pieces(_range_pieces(df, natural), name, [natural, _TIE])


def _range_pieces(df: DataFrame, natural: str) -> DataFrame:
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    tied = df.withColumn(_TIE, F.xxhash64(*df.columns))
    ranged = tied.repartitionByRange(shuffle_partitions(spark), natural, _TIE)
    return ranged.withColumn(_PIECE, F.spark_partition_id()).checkpoint()


def _number_pieces(pieces: DataFrame, name: str, order: Sequence[str]) -> DataFrame:
    before = Window.orderBy(_PIECE).rowsBetween(Window.unboundedPreceding, -1)
    counts = pieces.groupBy(_PIECE).agg(F.count(F.lit(1)).alias("_n"))
    offsets = counts.select(_PIECE, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_antes"))
    within: Column = F.row_number().over(Window.partitionBy(_PIECE).orderBy(*order))
    numbered = pieces.withColumn("_orden", within).join(F.broadcast(offsets), _PIECE)
    key = (F.col("_antes") + F.col("_orden")).cast("int")
    kept = [c for c in pieces.columns if c not in (_PIECE, _TIE, name)]
    return numbered.select(*kept, key.alias(name))
