"""Text to typed values.

Under ANSI a plain cast of bad text stops the job. These give NULL instead, so that a
check can count the failures and name the column before anything is written.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .text import as_column, blank_to_null


def to_int(col: Column | str) -> Column:
    return as_column(col).try_cast("int")


def to_decimal(col: Column | str, precision: int = 10, scale: int = 2) -> Column:
    return as_column(col).try_cast(f"decimal({precision},{scale})")


def comma_decimal(col: Column | str, precision: int = 10, scale: int = 2) -> Column:
    """Number text with a decimal comma or point."""
    return to_decimal(F.translate(F.trim(as_column(col)), ",", "."), precision, scale)


def to_day(col: Column | str) -> Column:
    """``YYYY/MM/DD`` text to a date."""
    return F.try_to_date(F.trim(as_column(col)), "yyyy/MM/dd")


def to_month(col: Column | str) -> Column:
    """``YYYY/MM`` text to the first day of that month."""
    return F.try_to_date(F.concat(F.trim(as_column(col)), F.lit("/01")), "yyyy/MM/dd")


def to_moment(day: Column | str, clock: Column | str) -> Column:
    joined = F.concat_ws(" ", F.trim(as_column(day)), F.trim(as_column(clock)))
    return F.try_to_timestamp(joined, F.lit("yyyy/MM/dd HH:mm:ss"))


def iso_moment(col: Column | str) -> Column:
    """ISO-8601 text with an offset to a timestamp."""
    return as_column(col).try_cast("timestamp")


def int_or(col: Column | str, default: int) -> Column:
    """Integer text; blank means ``default``, and text that is no integer becomes NULL."""
    present = blank_to_null(col)
    return F.when(present.isNull(), F.lit(default)).otherwise(to_int(present))
