"""Business measures as additive parts plus a final expression.

The parts are row expressions to sum; the final expression works on the sums. So a ratio is
always a ratio of sums, and a fact can be summed on its own keys before it meets a dimension.
Blank is NULL: a measure over no rows, or divided by nothing, is NULL.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.money import divide
from . import joins
from .clean import ANOMALY_PCT
from .joins import SENTINEL, Grouping
from .periods import last_period_sum

Parts = dict[str, Column]


@dataclass(frozen=True)
class Measure:
    name: str
    parts: Callable[[], Parts]
    value: Callable[[], Column]


def _sales() -> Parts:
    return {"p_venta": F.col("venta_total")}


def _cost() -> Parts:
    return {"p_costo": F.col("costo_total")}


def _rows() -> Parts:
    return {"p_filas": F.lit(1)}


def _targets() -> Parts:
    return {"p_real": F.col("venta_total_real"), "p_meta": F.col("meta_venta")}


def _margin() -> Column:
    sales, cost = F.col("p_venta"), F.col("p_costo")
    both_blank = sales.isNull() & cost.isNull()
    return F.when(~both_blank, F.coalesce(sales, F.lit(0)) - F.coalesce(cost, F.lit(0)))


VENTA_TOTAL = Measure("venta_total", _sales, lambda: F.col("p_venta"))
COSTO_TOTAL = Measure("costo_total", _cost, lambda: F.col("p_costo"))
MARGEN_BRUTO = Measure("margen_bruto", lambda: _sales() | _cost(), _margin)
MARGEN_PCT = Measure("margen_pct", lambda: _sales() | _cost(), lambda: divide(_margin(), F.col("p_venta")))
UNIDADES = Measure("unidades_vendidas", lambda: {"p_unidades": F.col("cantidad")}, lambda: F.col("p_unidades"))
TRANSACCIONES = Measure("transacciones", _rows, lambda: F.col("p_filas"))
TICKET_PROMEDIO = Measure(
    "ticket_promedio", lambda: _sales() | _rows(), lambda: divide(F.col("p_venta"), F.col("p_filas"))
)
DESCUENTO_ATIPICO = Measure(
    "ventas_descuento_atipico",
    lambda: {"p_atipico": F.when(F.col("descuento_pct") >= ANOMALY_PCT, 1)},
    lambda: F.col("p_atipico"),
)
SIN_CLIENTE_PCT = Measure(
    "pct_ventas_sin_cliente",
    lambda: {"p_sin_cliente": F.when(F.col("cliente_key") == SENTINEL, 1)} | _rows(),
    lambda: divide(F.col("p_sin_cliente"), F.col("p_filas")),
)
VENTA_REAL = Measure("venta_real_mensual", _targets, lambda: F.col("p_real"))
META_VENTA = Measure("meta_venta", _targets, lambda: F.col("p_meta"))
CUMPLIMIENTO_PCT = Measure("cumplimiento_pct", _targets, lambda: divide(F.col("p_real"), F.col("p_meta")))
VARIACION_PCT = Measure(
    "variacion_pct", _targets, lambda: divide(F.coalesce(F.col("p_real"), F.lit(0)) - F.col("p_meta"), F.col("p_meta"))
)
#: A missing target counts as zero, so a month without one is met.
MESES_CUMPLIDOS = Measure(
    "meses_meta_cumplida",
    lambda: {"p_cumplidos": F.when(F.col("venta_total_real") >= F.coalesce("meta_venta", F.lit(0)), 1)},
    lambda: F.col("p_cumplidos"),
)
QUIEBRES_STOCK = Measure(
    "quiebres_de_stock", lambda: {"p_quiebres": F.when(F.col("sin_stock"), 1)}, lambda: F.col("p_quiebres")
)

SALES_MEASURES = (
    VENTA_TOTAL, COSTO_TOTAL, MARGEN_BRUTO, MARGEN_PCT, UNIDADES,
    TRANSACCIONES, TICKET_PROMEDIO, DESCUENTO_ATIPICO, SIN_CLIENTE_PCT,
)
TARGET_MEASURES = (VENTA_REAL, META_VENTA, CUMPLIMIENTO_PCT, VARIACION_PCT, MESES_CUMPLIDOS)


def _names(keys: Sequence[str], dims: Sequence[Grouping]) -> list[str]:
    return [*keys, *(a for _, _, attributes in dims for a in attributes)]


def evaluate(
    fact: DataFrame, measures: Sequence[Measure], keys: Sequence[str] = (), dims: Sequence[Grouping] = ()
) -> DataFrame:
    """Measures per fact column in ``keys`` and per dimension attribute in ``dims``.

    The fact is summed on its own keys first, where Spark combines rows before the shuffle; the
    joins see one row per key combination, however unevenly the fact is spread over the keys.
    """
    parts: Parts = {}
    for measure in measures:
        parts |= measure.parts()
    own = list(dict.fromkeys([*keys, *(on for _, on, _ in dims)]))
    summed = fact.groupBy(*own).agg(*(F.sum(part).alias(name) for name, part in parts.items()))
    groups = _names(keys, dims)
    if dims:
        summed = joins.star(summed, dims).groupBy(*groups).agg(*(F.sum(name).alias(name) for name in parts))
    return summed.select(*groups, *(m.value().alias(m.name) for m in measures))


def closing_stock(
    inventory: DataFrame, keys: Sequence[str] = (), dims: Sequence[Grouping] = (), name: str = "stock_cierre"
) -> DataFrame:
    """Stock at the last period of each group; periods are never added up."""
    own = list(dict.fromkeys([*keys, *(on for _, on, _ in dims), "fecha_key"]))
    summed = inventory.groupBy(*own).agg(F.sum("cantidad_disponible").alias("_stock"))
    return last_period_sum(joins.star(summed, dims), _names(keys, dims), "fecha_key", "_stock", name)
