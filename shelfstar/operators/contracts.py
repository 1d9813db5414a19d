"""Column contracts of the Gold tables: names, order, types, required columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from .quality import null_rules, rules

# The published tables, as DDL.
_DDL = {
    "DimFecha": (
        "fecha_key INT, fecha DATE NOT NULL, anio INT NOT NULL, mes INT NOT NULL, trimestre INT NOT NULL, "
        "nombre_mes STRING, anio_mes STRING NOT NULL, dia_semana STRING, dia_semana_num INT, es_fin_de_semana BOOLEAN"
    ),
    "DimTienda": (
        "tienda_key INT NOT NULL, tienda_id INT, nombre_tienda STRING, nombre_tienda_display STRING, ciudad STRING, "
        "pais STRING, region STRING, formato_tienda STRING, fecha_apertura DATE"
    ),
    "DimProducto": (
        "producto_key INT NOT NULL, sku STRING, nombre_producto STRING, categoria STRING, subcategoria STRING, "
        "marca STRING, costo_unitario DECIMAL(10,2)"
    ),
    "DimEmpleado": (
        "empleado_key INT NOT NULL, empleado_id INT, nombre_completo STRING, tienda_id INT, puesto STRING, "
        "fecha_ingreso DATE, salario DECIMAL(10,2), documento_identidad STRING"
    ),
    "DimCliente": (
        "cliente_key INT, cliente_id INT, nombre_completo STRING, fecha_registro DATE, tier_lealtad STRING, ciudad STRING"
    ),
    "FactVentas": (
        "transaccion_id STRING, fecha_key INT, tienda_key INT, producto_key INT, empleado_key INT, "
        "cliente_key INT NOT NULL, cantidad INT, precio_unitario DECIMAL(10,2), descuento_pct INT, "
        "venta_total DECIMAL(12,2), costo_total DECIMAL(12,2), requiere_revision BOOLEAN NOT NULL"
    ),
    "FactInventario": (
        "tienda_key INT, fecha_key INT, categoria STRING, cantidad_disponible INT, sin_stock BOOLEAN"
    ),
    "real_vs_presupuesto": (
        "tienda_id INT, anio_mes STRING, venta_total_real DECIMAL(14,2), meta_venta DECIMAL(12,2), "
        "variacion_pct DECIMAL(10,2)"
    ),
    "ventas_diarias_por_tienda": (
        "tienda_key INT, fecha_key INT, venta_total DECIMAL(14,2), unidades INT, cantidad_transacciones INT NOT NULL"
    ),
    "SeguridadRegion": "usuario_email STRING NOT NULL, region STRING NOT NULL",
}
TABLES = tuple(_DDL)


def contract(table: str) -> T.StructType:
    return T.StructType.fromDDL(_DDL[table])


def conform(df: DataFrame, table: str) -> DataFrame:
    """The contract's columns in order and in its types; a value that does not fit becomes NULL."""
    return df.select(*(F.col(f.name).try_cast(f.dataType).alias(f.name) for f in contract(table).fields))


def required_columns(table: str) -> list[str]:
    return [f.name for f in contract(table).fields if not f.nullable]


def losses(table: str) -> dict[str, Column]:
    """Per column, values that ``conform`` turns into NULL; for rows before it."""
    return {f"no_convierte_{f.name}": F.col(f.name).isNotNull() & F.col(f.name).try_cast(f.dataType).isNull() for f in contract(table).fields}


def contract_check(df: DataFrame, table: str) -> DataFrame:
    """Missing values in required columns, and values lost by ``conform``."""
    return rules(df, null_rules(required_columns(table)) | losses(table))
