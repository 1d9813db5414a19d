"""Report queries over the star schema.

A star is a mapping from table name to DataFrame. Slicers are lists of allowed values, None
meaning no restriction; they restrict a dimension, and facts follow by key. Sales by date go
through the calendar; the target table has no calendar, so date slicers do not reach it.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import DataFrame, functions as F

from ..operators import measures as m, security
from ..operators.filters import in_list
from ..operators.joins import semi
from ..operators.measures import closing_stock, evaluate

Star = Mapping[str, DataFrame]
Values = Sequence[Any] | None
_GOOD, _BAD = "favorable", "desfavorable"
_BAND = 1000


def _restrict(star: Star, fact: DataFrame, table: str, key: str, **allowed: Values) -> DataFrame:
    if all(values is None for values in allowed.values()):
        return fact
    dim = star[table]
    for col, values in allowed.items():
        dim = dim.filter(in_list(col, values))
    return semi(fact, dim, key)


def slice_sales(star: Star, region: Values = None, formato: Values = None, mes: Values = None) -> DataFrame:
    """Sales of the chosen regions, store formats and months."""
    fact = _restrict(star, star["FactVentas"], "DimTienda", "tienda_key", region=region, formato_tienda=formato)
    return _restrict(star, fact, "DimFecha", "fecha_key", nombre_mes=mes)


def kpis(star: Star, **slicers: Values) -> DataFrame:
    chosen = (m.VENTA_TOTAL, m.TRANSACCIONES, m.TICKET_PROMEDIO, m.MARGEN_PCT)
    return evaluate(slice_sales(star, **slicers), chosen)


def all_sales_measures(star: Star, **slicers: Values) -> DataFrame:
    return evaluate(slice_sales(star, **slicers), m.SALES_MEASURES)


def sales_by_region(star: Star, **slicers: Values) -> DataFrame:
    by = [(star["DimTienda"], "tienda_key", ["region"])]
    return evaluate(slice_sales(star, **slicers), [m.VENTA_TOTAL], dims=by).orderBy(F.desc("venta_total"), "region")


def sales_by_category(star: Star, **slicers: Values) -> DataFrame:
    by = [(star["DimProducto"], "producto_key", ["categoria"])]
    return evaluate(slice_sales(star, **slicers), [m.VENTA_TOTAL], dims=by).orderBy(F.desc("venta_total"), "categoria")


def sales_cost_by_month(star: Star, **slicers: Values) -> DataFrame:
    by = [(star["DimFecha"], "fecha_key", ["mes", "nombre_mes"])]
    return evaluate(slice_sales(star, **slicers), [m.VENTA_TOTAL, m.COSTO_TOTAL], dims=by).orderBy("mes")


def sales_by_weekday(star: Star) -> DataFrame:
    """Daily totals by weekday, Monday first."""
    by = [(star["DimFecha"], "fecha_key", ["dia_semana_num", "dia_semana"])]
    return evaluate(star["ventas_diarias_por_tienda"], [m.VENTA_TOTAL], dims=by).orderBy("dia_semana_num")


def _targets(star: Star, region: Values = None) -> DataFrame:
    return _restrict(star, star["real_vs_presupuesto"], "DimTienda", "tienda_id", region=region)


def _store_name(star: Star, key: str) -> tuple[DataFrame, str, list[str]]:
    return star["DimTienda"], key, ["nombre_tienda_display"]


def target_by_month(star: Star, region: Values = None) -> DataFrame:
    return evaluate(_targets(star, region), [m.VENTA_REAL, m.META_VENTA], keys=["anio_mes"]).orderBy("anio_mes")


def target_table(star: Star, region: Values = None) -> DataFrame:
    """Store months with actual, target, variation and the band of its sign."""
    chosen = [m.VENTA_REAL, m.META_VENTA, m.VARIACION_PCT]
    table = evaluate(_targets(star, region), chosen, keys=["anio_mes"], dims=[_store_name(star, "tienda_id")])
    ratio = F.col("variacion_pct")
    band = F.when((ratio >= 0) & (ratio <= _BAND), _GOOD).when((ratio >= -_BAND) & (ratio < 0), _BAD)
    return table.withColumn("banda", band).orderBy("anio_mes", "nombre_tienda_display")


def fulfilment_by_store(star: Star, region: Values = None) -> DataFrame:
    by = [_store_name(star, "tienda_id")]
    table = evaluate(_targets(star, region), [m.CUMPLIMIENTO_PCT], dims=by)
    return table.orderBy(F.desc("cumplimiento_pct"), "nombre_tienda_display")


def target_kpis(star: Star, region: Values = None) -> DataFrame:
    return evaluate(_targets(star, region), [m.VENTA_REAL, m.META_VENTA, m.MESES_CUMPLIDOS])


def all_target_measures(star: Star, region: Values = None) -> DataFrame:
    return evaluate(_targets(star, region), m.TARGET_MEASURES)


def slice_stock(star: Star, region: Values = None, categoria: Values = None) -> DataFrame:
    stock = _restrict(star, star["FactInventario"], "DimTienda", "tienda_key", region=region)
    return stock.filter(in_list("categoria", categoria))


def closing_stock_by_month(star: Star, **slicers: Values) -> DataFrame:
    by = [(star["DimFecha"], "fecha_key", ["mes", "nombre_mes"])]
    return closing_stock(slice_stock(star, **slicers), dims=by).orderBy("mes")


def stock_outs(star: Star, **slicers: Values) -> DataFrame:
    """Store, category and month rows without stock."""
    empty = slice_stock(star, **slicers).filter(in_list("sin_stock", [True]))
    by = [_store_name(star, "tienda_key"), (star["DimFecha"], "fecha_key", ["mes", "nombre_mes"])]
    table = evaluate(empty, [m.QUIEBRES_STOCK], keys=["categoria"], dims=by)
    return table.orderBy("nombre_tienda_display", "categoria", "mes")


def stock_pivot(star: Star, categories: Sequence[str], **slicers: Values) -> DataFrame:
    """Closing stock with stores as rows and the given categories as columns."""
    cells = closing_stock(slice_stock(star, **slicers), keys=["categoria"], dims=[_store_name(star, "tienda_key")])
    return cells.groupBy("nombre_tienda_display").pivot("categoria", list(categories)).agg(F.first("stock_cierre"))


def stock_kpis(star: Star, **slicers: Values) -> DataFrame:
    stock = slice_stock(star, **slicers)
    # Both one-row results as columns of one row: tag, stack, and take the non-null value of each.
    closing = closing_stock(stock).select("stock_cierre", F.lit(None).cast("bigint").alias("quiebres_de_stock"))
    outs = evaluate(stock, [m.QUIEBRES_STOCK]).select(F.lit(None).cast("bigint").alias("stock_cierre"), "quiebres_de_stock")
    return closing.unionByName(outs).agg(
        F.max("stock_cierre").alias("stock_cierre"), F.max("quiebres_de_stock").alias("quiebres_de_stock")
    )


def secure_sales_by_region(star: Star, role: str, user: str | None = None) -> DataFrame:
    return sales_by_region(security.tables_for(star, role, user))


def secure_employees(star: Star, role: str, user: str | None = None) -> DataFrame:
    """Name, position and, where the role may read it, salary."""
    employees = security.tables_for(star, role, user)["DimEmpleado"]
    shown = [c for c in ("nombre_completo", "puesto", "salario") if c in employees.columns]
    return employees.select(*shown)
