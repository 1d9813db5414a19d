"""Text cleaning and text patterns."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Shapes that source text must have.
DIGITS = r"^[0-9]+$"
NUMBER = r"^[0-9]+(\.[0-9]+)?$"
DATE = r"^[0-9]{4}/[0-9]{2}/[0-9]{2}$"
MONTH = r"^[0-9]{4}/(0[1-9]|1[0-2])$"
CLOCK = r"^([01][0-9]|2[0-3]):[0-5][0-9]:[0-5][0-9]$"


def as_column(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def blank_to_null(col: Column | str) -> Column:
    """Trimmed text; NULL when nothing but spaces is left. Tabs are not spaces."""
    return F.nullif(F.trim(as_column(col)), F.lit(""))


def is_blank(col: Column | str) -> Column:
    """Never NULL, so a split on it loses no row."""
    return blank_to_null(col).isNull()


def title_case(col: Column | str) -> Column:
    return F.initcap(F.trim(as_column(col)))


def blank_to(col: Column | str, default: str) -> Column:
    return F.coalesce(blank_to_null(col), F.lit(default))


def contains(col: Column | str, text: str) -> Column:
    return as_column(col).contains(text)


def display_name(name: Column | str, ident: Column | str) -> Column:
    """``name (id)``; NULL when either part is NULL."""
    return F.concat(as_column(name), F.lit(" ("), as_column(ident).cast("string"), F.lit(")"))


def mask_partial(col: Column | str, prefix: int = 2, padding: str = "XXXX", suffix: int = 2) -> Column:
    """Keep ``prefix`` leading and ``suffix`` trailing characters; text too short for both is all padding."""
    text = as_column(col)
    shown = F.concat(F.substring(text, 1, prefix), F.lit(padding), F.right(text, F.lit(suffix)))
    return F.when(F.length(text) > prefix + suffix, shown).when(text.isNotNull(), F.lit(padding))
