"""Star-schema dimensions."""

from __future__ import annotations

from collections.abc import Mapping
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ..functions.dates import calendar_columns
from ..functions.text import display_name
from .clean import NO_TIER
from .contracts import contract
from .joins import SENTINEL
from .keys import surrogate_key

# The member that stands for sales without a customer.
UNKNOWN_CUSTOMER = "Cliente No Identificado"
UNKNOWN_CITY = "N/A"


def calendar_between(bounds: DataFrame, first: str, last: str) -> DataFrame:
    """Calendar of the whole years from column ``first`` to column ``last`` of a one-row table."""
    start = F.make_date(F.year(first), F.lit(1), F.lit(1))
    end = F.make_date(F.year(last), F.lit(12), F.lit(31))
    days = bounds.select(F.explode(F.sequence(start, end, F.expr("interval 1 day"))).alias("fecha"))
    return days.select(*calendar_columns("fecha"))


def dim_fecha(sales: DataFrame, date_col: str = "fecha_venta") -> DataFrame:
    """One row per day over the years the sales span; the bounds never visit the driver."""
    bounds = sales.agg(F.min(date_col).alias("primera"), F.max(date_col).alias("ultima"))
    return calendar_between(bounds, "primera", "ultima")


def unknown_member(spark: SparkSession, schema: T.StructType, values: Mapping[str, Any]) -> DataFrame:
    """One literal row; columns without a value are NULL.

    It is made of a one-row range, so that the optimizer knows how small it is, and integers are
    added to the range's zero: a key that is a plain literal would be folded out of join conditions
    and turn an equi-join into a nested loop.
    """

    def column(value: Any) -> Column:
        return F.col("id") + value if isinstance(value, int) else F.lit(value)

    return spark.range(1).select(*(column(values.get(f.name)).cast(f.dataType).alias(f.name) for f in schema.fields))


def with_unknown_member(dim: DataFrame, row: DataFrame) -> DataFrame:
    return row.unionByName(dim.select(*row.columns))


def _keyed(df: DataFrame, table: str, key: str, natural: str) -> DataFrame:
    """Surrogate key in front of the columns of the table's contract."""
    return surrogate_key(df, key, natural).select(*contract(table).fieldNames())


def dim_tienda(stores: DataFrame) -> DataFrame:
    """The display name adds the id, since several stores may share a name."""
    named = stores.withColumn("nombre_tienda_display", display_name("nombre_tienda", "tienda_id"))
    return _keyed(named, "DimTienda", "tienda_key", "tienda_id")


def dim_producto(products: DataFrame) -> DataFrame:
    return _keyed(products, "DimProducto", "producto_key", "sku")


def dim_empleado(employees: DataFrame) -> DataFrame:
    return _keyed(employees, "DimEmpleado", "empleado_key", "empleado_id")


def dim_cliente(customers: DataFrame, sentinel: int = SENTINEL) -> DataFrame:
    member = {
        "cliente_key": sentinel, "cliente_id": sentinel, "nombre_completo": UNKNOWN_CUSTOMER,
        "tier_lealtad": NO_TIER, "ciudad": UNKNOWN_CITY,
    }
    row = unknown_member(customers.sparkSession, contract("DimCliente"), member)
    return with_unknown_member(_keyed(customers, "DimCliente", "cliente_key", "cliente_id"), row)
