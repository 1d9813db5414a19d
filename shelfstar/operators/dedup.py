"""Exact duplicates, splits and key distinctness.

All of these group first, so Spark combines copies on the map side: a row repeated in a
third of the table leaves each map task as one row.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.text import is_blank


def dedup_exact(df: DataFrame) -> DataFrame:
    return df.dropDuplicates()


def duplicate_report(df: DataFrame) -> DataFrame:
    """Rows that occur more than once, with how often."""
    return count_copies(df, "veces_repetida").filter("veces_repetida > 1")


def split(df: DataFrame, predicate: Column) -> tuple[DataFrame, DataFrame]:
    """``(valid, rejected)``: rejected rows satisfy the predicate; NULL counts as not satisfied."""
    hit = F.coalesce(predicate, F.lit(False))
    return df.filter(~hit), df.filter(hit)


def key_counts(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row: ``filas``, ``claves`` and ``duplicados``; NULL counts as a key value."""
    groups = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    total = F.coalesce(F.sum("n"), F.lit(0))
    return groups.agg(
        total.alias("filas"),
        F.count(F.lit(1)).alias("claves"),
        (total - F.count(F.lit(1))).alias("duplicados"),
    )


def count_copies(df: DataFrame, name: str = "_copias") -> DataFrame:
    """Every distinct row once, with how often it occurred."""
    return df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias(name))


def pieces_by(df: DataFrame, keys: Sequence[str], pieces: int) -> Iterator[DataFrame]:
    """The rows in pieces, equal keys in one piece. What groups by the keys can take one piece after the other and then shuffles a
    piece's share of the rows at a time; every piece reads the table. Numbers that are equal but differ in their bits (0.0 and -0.0) are not equal here."""
    slot = F.pmod(F.xxhash64(*keys), F.lit(pieces))
    for piece in range(pieces):
        yield df if pieces == 1 else df.filter(slot == piece)


def copies_in_pieces(df: DataFrame, pieces: int, name: str = "_copias") -> Iterator[DataFrame]:
    """``count_copies`` of a table of text, in pieces."""
    for piece in pieces_by(df, df.columns, pieces):
        yield count_copies(piece, name)


def reconcile_copies(counted: DataFrame, reject_if: Column | None = None, name: str = "_copias") -> DataFrame:
    """Input rows = duplicates + valid + rejected, from rows with their copy counts."""
    reject = F.coalesce(is_blank("sku") if reject_if is None else reject_if, F.lit(False))
    counts = counted.select(F.col(name).alias("n"), reject.alias("rechazo")).agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("filas_origen"),
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicados"),
        F.count_if(~F.col("rechazo")).alias("validas"),
        F.count_if(F.col("rechazo")).alias("rechazadas"),
    )
    parts = F.col("duplicados") + F.col("validas") + F.col("rechazadas")
    return counts.withColumn("cierra", F.col("filas_origen") == parts)


def reconcile_rows(df: DataFrame, reject_if: Column | None = None) -> DataFrame:
    return reconcile_copies(count_copies(df), reject_if)
