"""Fact and aggregate tables."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

from pyspark.sql import DataFrame, functions as F

from ..functions.dates import fecha_a_key, month_label
from ..functions.money import cost_total, variation_pct
from . import joins
from .joins import SENTINEL, Grouping, Hot, Step, keyed_pieces, lookup, lookup_keys, lookup_with_sentinel, review_flag, spread_in_slices


def _sales_keys(dims: Mapping[str, DataFrame], sentinel: int, **limits: int) -> tuple[list[Grouping], Step]:
    """The lookups of a sale line, and what makes fact rows of lines by them."""
    wanted = [
        (dims["tienda"], "tienda_id", ["tienda_key"]),
        (dims["producto"], "sku", ["producto_key", "costo_unitario"]),
        (dims["empleado"], "empleado_id", ["empleado_key"]),
        (dims["cliente"], "cliente_id", ["cliente_key"]),
    ]

    def keyed(lines: DataFrame, known: Sequence[Grouping], hot: Hot) -> DataFrame:
        *plain, member = known
        found = lookup_with_sentinel(lookup_keys(lines, plain, hot, **limits), *member, sentinel, hot, **limits)
        return found.select(
            "transaccion_id",
            fecha_a_key("fecha_venta").alias("fecha_key"),
            "tienda_key", "producto_key", "empleado_key",
            F.coalesce("cliente_key", F.lit(sentinel)).alias("cliente_key"),
            "cantidad", "precio_unitario", "descuento_pct", "venta_total",
            cost_total("cantidad", "costo_unitario").alias("costo_total"),
            review_flag("tienda_key", "producto_key", "empleado_key", "cliente_key").alias("requiere_revision"),
        )

    return wanted, keyed


def fact_sales(
    sales: DataFrame, dims: Mapping[str, DataFrame], sentinel: int = SENTINEL, folder: str | None = None, **limits: int
) -> DataFrame:
    """Sale lines with surrogate keys for natural ids; no line is lost.

    A line without a customer gets the sentinel member. A line whose store, product, employee or
    customer id is unknown is marked for review, and an unknown customer id then becomes the sentinel.
    With a dimension too large to broadcast the lines are keyed here, slice by slice, and read from ``folder`` (see ``spread_in_slices``).
    """
    return spread_in_slices(sales, *_sales_keys(dims, sentinel, **limits), folder, {"cliente_id": sentinel}, **limits)


def fact_sales_pieces(sales: DataFrame, dims: Mapping[str, DataFrame], folder: str, sentinel: int = SENTINEL, **limits: int) -> Iterator[DataFrame]:
    """``fact_sales`` of the rows of a table, in pieces that are to be written one after the other (see ``keyed_pieces``)."""
    return keyed_pieces(sales, *_sales_keys(dims, sentinel, **limits), folder, {"cliente_id": sentinel}, **limits)


def fact_inventory(inventory: DataFrame, stores: DataFrame, **limits: int) -> DataFrame:
    keyed = lookup(inventory, stores, "tienda_id", ["tienda_key"], **limits)
    return keyed.select(
        "tienda_key", fecha_a_key("anio_mes").alias("fecha_key"), "categoria", "cantidad_disponible", "sin_stock"
    )


def daily(fact: DataFrame) -> DataFrame:
    """Store and day totals, in the types that sums have; lines without a store keep their own group."""
    sums = {"venta_total": F.sum("venta_total"), "unidades": F.sum("cantidad"), "cantidad_transacciones": F.count(F.lit(1))}
    return fact.groupBy("tienda_key", "fecha_key").agg(*(total.alias(name) for name, total in sums.items()))


def monthly(fact: DataFrame, calendar: DataFrame, stores: DataFrame) -> DataFrame:
    """Store and month totals. Lines are summed per store and day before they meet the dimensions;
    lines without a store or a calendar day drop out."""
    per_day = fact.groupBy("tienda_key", "fecha_key").agg(F.sum("venta_total").alias("venta_dia"))
    named = joins.inner_on(per_day, calendar.select("fecha_key", "anio_mes"), "fecha_key")
    named = joins.inner_on(named, stores.select("tienda_key", "tienda_id"), "tienda_key")
    return named.groupBy("tienda_id", "anio_mes").agg(F.sum("venta_dia").alias("venta_total_real"))


def actual_vs_target(monthly_sales: DataFrame, budget: DataFrame) -> DataFrame:
    """Store months with their target, where there is one, and the variation in percent."""
    targets = budget.select("tienda_id", month_label("anio_mes").alias("anio_mes"), "meta_venta")
    return joins.left_on(monthly_sales, targets, ["tienda_id", "anio_mes"]).select(
        "tienda_id", "anio_mes", "venta_total_real", "meta_venta",
        variation_pct("venta_total_real", "meta_venta").alias("variacion_pct"),
    )
