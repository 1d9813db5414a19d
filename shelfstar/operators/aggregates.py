"""Summaries and counts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F


def summary(df: DataFrame, aggregates: Mapping[str, Column]) -> DataFrame:
    """One row of named aggregates."""
    return df.agg(*(value.alias(name) for name, value in aggregates.items()))


def counts(df: DataFrame, *keys: str) -> DataFrame:
    return df.groupBy(*keys).count()


def count_if(condition: Column) -> Column:
    return F.count_if(condition)


def rows_per(df: DataFrame, key: str, cols: Sequence[str]) -> DataFrame:
    """Rows of the keys that occur more than once, one by one, beside how often the key occurs.

    Nothing is gathered per key, so the result is the same however the rows are dealt out and however
    many a key has. A NULL key is not a key.
    """
    repeated = df.groupBy(key).agg(F.count(F.lit(1)).alias("cantidad")).filter("cantidad > 1")
    return df.select(key, *cols).join(repeated, key).select(key, "cantidad", *cols)
