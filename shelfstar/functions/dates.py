"""Calendar expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .text import as_column

# Spanish calendar names, January and Monday first.
MONTH_NAMES = [
    "Enero", "Febrero", "Marzo", "Abril", "Mayo", "Junio",
    "Julio", "Agosto", "Septiembre", "Octubre", "Noviembre", "Diciembre",
]
DAY_NAMES = ["Lunes", "Martes", "Miércoles", "Jueves", "Viernes", "Sábado", "Domingo"]


def fecha_a_key(col: Column | str) -> Column:
    """Date to the integer ``yyyyMMdd``."""
    day = as_column(col)
    return F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)


def month_label(col: Column | str) -> Column:
    return F.date_format(as_column(col), "yyyy/MM")


def weekday_number(col: Column | str) -> Column:
    """Monday is 1, Sunday is 7."""
    return F.weekday(as_column(col)) + 1


def pick_name(names: list[str], index: Column) -> Column:
    """Name at a 1-based position."""
    return F.element_at(F.array(*map(F.lit, names)), index)


def calendar_columns(fecha: Column | str) -> list[Column]:
    day = as_column(fecha)
    weekday = weekday_number(day)
    return [
        fecha_a_key(day).alias("fecha_key"),
        day.alias("fecha"),
        F.year(day).alias("anio"),
        F.month(day).alias("mes"),
        F.quarter(day).alias("trimestre"),
        pick_name(MONTH_NAMES, F.month(day)).alias("nombre_mes"),
        month_label(day).alias("anio_mes"),
        pick_name(DAY_NAMES, weekday).alias("dia_semana"),
        weekday.alias("dia_semana_num"),
        (weekday >= 6).alias("es_fin_de_semana"),
    ]
