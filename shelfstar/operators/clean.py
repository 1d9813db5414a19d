"""Raw text tables to typed tables."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import convert, money, text

# Fixed values of the domain.
NO_TIER = "Sin Tier"
PAYMENTS = ("Tarjeta", "Efectivo", "Billetera Digital")
REJECT_REASON = "SKU vacío: producto no identificable"
ANOMALY_PCT = 50

EVENT_COLUMNS = (
    "evento_id", "timestamp_evento", "tienda_id", "empleado_id",
    "sku", "cantidad", "precio_unitario", "descuento_pct",
)
ARRIVAL_COLUMN = "EventEnqueuedUtcTime"
#: Columns of a feed that carries records that are no events along: their text, and why.
LETTER_COLUMNS = ("_registro", "_motivo")


def clean_store(df: DataFrame) -> DataFrame:
    return df.select(
        convert.to_int("tienda_id").alias("tienda_id"),
        "nombre_tienda", "ciudad", "pais", "region", "formato_tienda",
        convert.to_day("fecha_apertura").alias("fecha_apertura"),
    )


def clean_product(df: DataFrame) -> DataFrame:
    return df.select(
        "sku",
        F.trim("nombre_producto").alias("nombre_producto"),
        text.title_case("categoria").alias("categoria"),
        "subcategoria", "marca",
        convert.to_decimal("costo_unitario").alias("costo_unitario"),
    )


def clean_employee(df: DataFrame) -> DataFrame:
    """The identity document stays text: leading zeros matter."""
    return df.select(
        convert.to_int("empleado_id").alias("empleado_id"),
        "nombre_completo",
        convert.to_int("tienda_id").alias("tienda_id"),
        "puesto",
        convert.to_day("fecha_ingreso").alias("fecha_ingreso"),
        convert.to_decimal("salario").alias("salario"),
        F.trim("documento_identidad").alias("documento_identidad"),
    )


def clean_customer(df: DataFrame, no_tier: str = NO_TIER) -> DataFrame:
    return df.select(
        convert.to_int("cliente_id").alias("cliente_id"),
        "nombre_completo",
        convert.to_day("fecha_registro").alias("fecha_registro"),
        text.blank_to("tier_lealtad", no_tier).alias("tier_lealtad"),
        "ciudad",
    )


def clean_sales(df: DataFrame, originals: Iterable[str] = ()) -> DataFrame:
    """Typed sale lines; the raw text of ``originals`` stays beside them as ``*_original``."""
    typed = df.select(
        F.trim("transaccion_id").alias("transaccion_id"),
        convert.to_day("fecha").alias("fecha_venta"),
        F.trim("hora").alias("hora_venta"),
        convert.to_moment("fecha", "hora").alias("fecha_hora_venta"),
        convert.to_int("tienda_id").alias("tienda_id"),
        convert.to_int("empleado_id").alias("empleado_id"),
        convert.to_int(text.blank_to_null("cliente_id")).alias("cliente_id"),
        F.trim("sku").alias("sku"),
        convert.to_int("cantidad").alias("cantidad"),
        convert.comma_decimal("precio_unitario").alias("precio_unitario"),
        convert.int_or("descuento_pct", 0).alias("descuento_pct"),
        text.title_case("medio_pago").alias("medio_pago"),
        *(F.col(c).alias(f"{c}_original") for c in originals),
    )
    return typed.withColumn("venta_total", money.line_total("cantidad", "precio_unitario", "descuento_pct"))


def clean_budget(df: DataFrame) -> DataFrame:
    return df.select(
        convert.to_int("tienda_id").alias("tienda_id"),
        convert.to_month("anio_mes").alias("anio_mes"),
        convert.to_decimal("meta_venta", 12, 2).alias("meta_venta"),
        convert.to_decimal("meta_margen", 12, 2).alias("meta_margen"),
    )


def clean_inventory(df: DataFrame) -> DataFrame:
    typed = df.select(
        convert.to_int("tienda_id").alias("tienda_id"),
        text.title_case("categoria").alias("categoria"),
        convert.to_month("anio_mes").alias("anio_mes"),
        convert.to_int("cantidad_disponible").alias("cantidad_disponible"),
    )
    return typed.withColumn("sin_stock", F.col("cantidad_disponible") == 0)


def select_present(df: DataFrame, required: Iterable[str], optional: Iterable[str] = ()) -> DataFrame:
    """The required columns and those optional ones the table has."""
    return df.select(*required, *(c for c in optional if c in df.columns))


def flag_anomaly(df: DataFrame, threshold: int = ANOMALY_PCT) -> DataFrame:
    return df.withColumn("es_anomalia", F.col("descuento_pct") >= threshold)


def clean_events(df: DataFrame, match_double: bool = False, threshold: int = ANOMALY_PCT) -> DataFrame:
    """Typed sale events, for a batch or a streaming table.

    ``match_double`` computes the line total in floating point, as the event feed's own rule does.
    """
    amount = money.line_total_double if match_double else money.line_total
    typed = select_present(df, EVENT_COLUMNS, [ARRIVAL_COLUMN, *LETTER_COLUMNS]).withColumns({
        "evento_id": F.trim("evento_id"),
        "timestamp_evento": convert.iso_moment("timestamp_evento"),
        "tienda_id": convert.to_int("tienda_id"),
        "empleado_id": convert.to_int("empleado_id"),
        "sku": F.trim("sku"),
        "cantidad": convert.to_int("cantidad"),
        "precio_unitario": convert.to_decimal("precio_unitario"),
        "descuento_pct": convert.to_int("descuento_pct"),
    })
    typed = typed.withColumn("venta_total", amount("cantidad", "precio_unitario", "descuento_pct"))
    return flag_anomaly(typed, threshold).withColumnRenamed(ARRIVAL_COLUMN, "_fecha_ingesta")


def before_after(df: DataFrame, conversions: Mapping[str, Column]) -> DataFrame:
    """Each source text beside its converted value."""
    pairs = []
    for name, converted in conversions.items():
        pairs += [F.col(name).alias(f"{name}_texto"), converted.alias(f"{name}_valor")]
    return df.select(*pairs)


def before_after_sales(raw: DataFrame, columns: Iterable[str], kept: Iterable[str] = ()) -> DataFrame:
    """Each sale line's raw text beside its typed values; one pass over the raw rows, without a join on the id."""
    columns = list(columns)
    return clean_sales(raw, columns).select("transaccion_id", *(f"{c}_original" for c in columns), *columns, *kept)


def with_reason(df: DataFrame, reason: str = REJECT_REASON) -> DataFrame:
    return df.withColumn("motivo_rechazo", F.lit(reason))
