"""Semi-additive values: sums over the last period only."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F


def last_period_sum(df: DataFrame, keys: Sequence[str], period: str, value: str, name: str = "stock_cierre") -> DataFrame:
    """Per group, the sum of ``value`` over the group's own last period. One scan, two hash aggregates."""
    per_period = df.groupBy(*keys, period).agg(F.sum(value).alias("_suma"))
    return per_period.groupBy(*keys).agg(F.max_by("_suma", period).alias(name))


def last_period(df: DataFrame, period: str, keys: Sequence[str], value: str, name: str = "stock_cierre") -> DataFrame:
    """Per group, the sum of ``value`` over the last period of the whole table.

    A group without rows in that period gets no row.
    """
    per_period = df.groupBy(*keys, period).agg(F.sum(value).alias(name))
    newest = per_period.agg(F.max(period).alias(period))
    return per_period.join(newest, period, "left_semi").select(*keys, name)
