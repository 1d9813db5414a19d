"""Row predicates used by checks and reports."""

from __future__ import annotations

from collections.abc import Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.text import as_column


def invalid_format(col: Column | str, pattern: str) -> Column:
    """Trimmed text that breaks the pattern. NULL stays NULL: missing values have their own check."""
    return ~F.trim(as_column(col)).rlike(pattern)


def in_list(col: Column | str, values: Sequence[Any] | None) -> Column:
    """Membership; no list means no restriction, as with an untouched report slicer."""
    return F.lit(True) if values is None else as_column(col).isin(list(values))


def between(col: Column | str, low: Any, high: Any) -> Column:
    return as_column(col).between(low, high)


def inconsistent(left: Column | str, right: Column) -> Column:
    """Stored value differs from its rule; NULL on either side is not counted."""
    return as_column(left) != right


def sort(df: DataFrame, keys: Sequence[str], descending: Sequence[str] = ()) -> DataFrame:
    return df.orderBy(*(F.col(k).desc() if k in descending else F.col(k).asc() for k in keys))


def top_n(df: DataFrame, keys: Sequence[Column], n: int) -> DataFrame:
    """First ``n`` rows of an order; give a last key that breaks ties."""
    return df.orderBy(*keys).limit(n)


def preview(df: DataFrame, order: Sequence[str], n: int = 10) -> DataFrame:
    """A look at ``n`` rows: the first by ``order``, so that it shows the same rows each time. Each task keeps ``n`` of its own."""
    return top_n(df, [F.asc(c) for c in order], n)
