"""Data checks.

Every check gives a small table ``(control, valor, cumple)``; ``require`` stops a job when a
control fails. A table's plain counts are one aggregate, whatever the number of columns or
rules, and its key count is a second one that shuffles the key columns only.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.text import is_blank
from . import joins
from .aggregates import rows_per
from .dedup import key_counts
from .filters import invalid_format


class QualityError(Exception):
    """A fatal control failed; nothing was published."""


def require(report: DataFrame) -> None:
    """Raise on failed controls. The report has one row per control, so it is small."""
    failed = report.filter(~F.coalesce(F.col("cumple"), F.lit(False))).collect()
    if failed:
        raise QualityError("; ".join(f"{row['control']} = {row['valor']}" for row in failed))


def combine(*reports: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, reports)


def _rows(one_row: DataFrame, controls: Mapping[str, Column | None]) -> DataFrame:
    """Turn a one-row table of counts into report rows.

    ``controls`` maps a column to its pass condition over ``valor``; None is informative.
    """
    entries = [
        F.struct(
            F.lit(name).alias("control"),
            F.col(f"`{name}`").cast("bigint").alias("valor"),
            (F.lit(True) if passes is None else passes).alias("cumple"),
        )
        for name, passes in controls.items()
    ]
    return one_row.select(F.inline(F.array(*entries)))


Rules = Mapping[str, Column]


def _counted(df: DataFrame, conditions: Rules) -> DataFrame:
    """One row: how many rows meet each condition."""
    return df.agg(*(F.count_if(condition).alias(name) for name, condition in conditions.items()))


def rules(df: DataFrame, forbidden: Rules) -> DataFrame:
    """Rows that meet each forbidden condition; every count must be zero. One aggregate for all."""
    return _rows(_counted(df, forbidden), {name: F.col(f"`{name}`") == 0 for name in forbidden})


def null_rules(required: Sequence[str]) -> dict[str, Column]:
    return {f"nulos_{c}": F.col(c).isNull() for c in required}


def format_rules(patterns: Mapping[str, str]) -> dict[str, Column]:
    """Values that break their column's pattern; missing values do not count."""
    return {c: invalid_format(c, pattern) for c, pattern in patterns.items()}


def _outside(col: str, allowed: Sequence[Any]) -> Column:
    return F.col(col).isNull() | ~F.col(col).isin(list(allowed))


def domain_rules(allowed: Mapping[str, Sequence[Any]]) -> dict[str, Column]:
    return {f"fuera_de_dominio_{c}": _outside(c, values) for c, values in allowed.items()}


def conversion_rules(pairs: Sequence[tuple[str, str]]) -> dict[str, Column]:
    """Text present but typed value NULL, per ``(text, typed)`` pair and for any pair."""
    failed = {text: F.col(text).isNotNull() & F.col(typed).isNull() for text, typed in pairs}
    return {**failed, "filas_fallidas": reduce(lambda a, b: a | b, failed.values())}


def validar(df: DataFrame, keys: Sequence[str], required: Sequence[str], forbidden: Rules | None = None) -> DataFrame:
    """Row count, duplicate keys, missing values of required columns, and further forbidden conditions."""
    keyed = _rows(key_counts(df, keys), {"filas": None, "duplicados": F.col("duplicados") == 0})
    conditions = null_rules(required) | dict(forbidden or {})
    return combine(keyed, rules(df, conditions)) if conditions else keyed


def validar_dimension(df: DataFrame, surrogate: str, natural: str) -> DataFrame:
    """Surrogate key unique and present, natural key unique. Missing natural keys are not checked."""
    by_surrogate = key_counts(df, [surrogate]).withColumnRenamed("duplicados", f"duplicados_{surrogate}")
    by_natural = key_counts(df, [natural]).withColumnRenamed("duplicados", f"duplicados_{natural}")
    return combine(
        _rows(by_surrogate, {"filas": None, f"duplicados_{surrogate}": F.col(f"duplicados_{surrogate}") == 0}),
        _rows(by_natural, {f"duplicados_{natural}": F.col(f"duplicados_{natural}") == 0}),
        rules(df, null_rules([surrogate])),
    )


def formats(df: DataFrame, patterns: Mapping[str, str]) -> DataFrame:
    return rules(df, format_rules(patterns))


def failed_conversions(df: DataFrame, pairs: Sequence[tuple[str, str]]) -> DataFrame:
    return rules(df, conversion_rules(pairs))


def domain(df: DataFrame, col: str, allowed: Sequence[Any]) -> DataFrame:
    """Values outside the allowed set, with their row counts; empty when the check passes."""
    return df.filter(_outside(col, allowed)).groupBy(col).agg(F.count(F.lit(1)).alias("filas"))


def references(df: DataFrame, checks: Sequence[tuple[str, DataFrame, str]], fatal: bool = False) -> DataFrame:
    """Fact rows whose value is missing from a dimension, per ``(column, dimension, key)``.

    The fact is read once: all columns are counted per value in one grouping, and only those counts are joined.
    Values are compared as text, so a column and its key need the same type.
    """
    cells = F.array(*(F.struct(F.lit(col).alias("columna"), F.col(col).cast("string").alias("valor")) for col, _, _ in checks))
    values = df.select(F.inline(cells)).filter("valor is not null").groupBy("columna", "valor").agg(F.count(F.lit(1)).alias("filas"))
    known = [dim.select(F.lit(col).alias("columna"), F.col(key).cast("string").alias("valor")) for col, dim, key in checks]
    missing = values.join(reduce(DataFrame.union, known), ["columna", "valor"], "left_anti")
    names = {col: f"huerfanas_{col}" for col, _, _ in checks}
    counted = missing.agg(*(F.coalesce(F.sum(F.when(F.col("columna") == col, F.col("filas"))), F.lit(0)).alias(name) for col, name in names.items()))
    return _rows(counted, {name: F.col(name) == 0 if fatal else None for name in names.values()})


def orphan_key_check(df: DataFrame, col: str, dim: DataFrame, key: str) -> DataFrame:
    """Distinct values, NULL included, that a dimension lacks."""
    name = f"claves_sin_dimension_{col}"
    missing = joins.orphan_keys(df, col, dim, key).agg(F.count(F.lit(1)).alias(name))
    return _rows(missing, {name: F.col(name) == 0})


def complete(df: DataFrame, keys: Sequence[str], col: str, n: int = 12) -> DataFrame:
    """Groups that do not have exactly ``n`` distinct values of ``col``."""
    return df.groupBy(*keys).agg(F.countDistinct(col).alias("valores")).filter(F.col("valores") != n)


def complete_check(df: DataFrame, keys: Sequence[str], col: str, n: int = 12) -> DataFrame:
    groups = df.groupBy(*keys).agg(F.countDistinct(col).alias("valores"))
    counted = groups.agg(F.count(F.lit(1)).alias("grupos"), F.count_if(F.col("valores") != n).alias("incompletos"))
    return _rows(counted, {"grupos": None, "incompletos": F.col("incompletos") == 0})


def calendar_complete(calendar: DataFrame, uses: Mapping[str, tuple[DataFrame, str]]) -> DataFrame:
    """No day missing in the calendar's range, and every used date is in it."""
    span = F.date_diff(F.max("fecha"), F.min("fecha")) + 1
    days = calendar.agg((span - F.count(F.lit(1))).alias("dias_faltantes"))
    reports = [_rows(days, {"dias_faltantes": F.col("dias_faltantes") == 0})]
    for name, (df, col) in uses.items():
        label = f"fechas_fuera_{name}"
        missing = joins.orphan_keys(df, col, calendar, "fecha").agg(F.count(F.lit(1)).alias(label))
        reports.append(_rows(missing, {label: F.col(label) == 0}))
    return combine(*reports)


def reconcile_amount(left: DataFrame, right: DataFrame, col: str) -> DataFrame:
    """Exact equality of an amount's sum in two layers."""
    sides = left.select(F.lit(1).alias("lado"), F.col(col).alias("x")).unionByName(
        right.select(F.lit(2).alias("lado"), F.col(col).alias("x"))
    )
    sums = sides.agg(
        F.coalesce(F.sum(F.when(F.col("lado") == 1, F.col("x"))), F.lit(0)).alias("izquierda"),
        F.coalesce(F.sum(F.when(F.col("lado") == 2, F.col("x"))), F.lit(0)).alias("derecha"),
    )
    return sums.withColumn("cumple", F.col("izquierda") == F.col("derecha"))


def same_rows(left: DataFrame, right: DataFrame) -> DataFrame:
    """A join that must keep its rows: both counts and whether they agree."""
    sides = left.select(F.lit(1).alias("lado")).unionByName(right.select(F.lit(2).alias("lado")))
    sums = sides.agg(F.count_if(F.col("lado") == 1).alias("izquierda"), F.count_if(F.col("lado") == 2).alias("derecha"))
    return sums.withColumn("cumple", F.col("izquierda") == F.col("derecha"))


def verify_written(tables: Mapping[str, tuple[DataFrame, int]]) -> DataFrame:
    """Row counts read back from written tables against the expected ones."""
    reports = []
    for name, (df, expected) in tables.items():
        counted = df.agg(F.count(F.lit(1)).alias(name))
        reports.append(_rows(counted, {name: F.col(f"`{name}`") == expected}))
    return combine(*reports)


def has_member(dim: DataFrame, key: str, value: Any) -> DataFrame:
    """The sentinel member is there exactly once."""
    name = f"miembro_{key}"
    return _rows(_counted(dim, {name: F.col(key) == F.lit(value)}), {name: F.col(name) == 1})


def unique(dim: DataFrame, col: str) -> DataFrame:
    name = f"repetidos_{col}"
    counted = key_counts(dim, [col]).withColumnRenamed("duplicados", name)
    return _rows(counted, {name: F.col(name) == 0})


def _values_per_column(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """``(columna, valor, n)``: each column's values with their counts, all columns in one grouping."""
    text = df.select(*(F.col(c).cast("string").alias(c) for c in cols))
    long = text.unpivot([], list(cols), "columna", "valor")
    return long.groupBy("columna", "valor").agg(F.count(F.lit(1)).alias("n"))


def profile(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Per column: blank values, values with outer spaces, distinct values. Audit columns are left out."""
    cols = cols or [c for c in df.columns if not c.startswith("_")]
    value = F.col("valor")
    return _values_per_column(df, cols).groupBy("columna").agg(
        F.sum(F.when(is_blank(value), F.col("n")).otherwise(0)).alias("nulos_o_vacios"),
        F.sum(F.when(value != F.trim(value), F.col("n")).otherwise(0)).alias("con_espacios"),
        F.count(value).alias("valores_distintos"),
    )


def value_counts(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Distribution of every listed column: ``(columna, valor, n)``."""
    return _values_per_column(df, cols)


def repeated_names(df: DataFrame, name: str, cols: Sequence[str]) -> DataFrame:
    """Rows whose name several rows share; see ``rows_per``."""
    return rows_per(df, name, cols)


def coverage(dim: DataFrame, fact: DataFrame, key: str, shown: Sequence[str]) -> DataFrame:
    """Dimension members that the fact never uses."""
    return joins.uncovered(dim, fact, key).select(*shown)


def repeated_ids(df: DataFrame, ident: str) -> DataFrame:
    """Ids carried by more than one row."""
    return df.groupBy(ident).count().filter("count > 1")
