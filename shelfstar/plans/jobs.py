"""Layer jobs: raw files to star schema. Run in this order; surrogate keys are renumbered by
every dimension load, so dimensions and facts are one load, which is published as a whole."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions import convert, text
from ..operators import clean, dedup, dimensions, facts, quality
from ..operators.quality import require
from ..sources.delimited import MANIFEST, Entry, ingest
from ..session import estimated_bytes
from ..sources.tables import GOLD, Load, escribir_gold, escribir_silver, leer_bronze, leer_gold, leer_silver, measured, new_load, scratch, staged
from ..streaming.refine import event_checks, refine_events

# Columns that may not be empty, text shapes, and the catalogs sales refer to.
REQUIRED_SALES = (
    "transaccion_id", "fecha_venta", "hora_venta", "fecha_hora_venta", "tienda_id", "empleado_id", "sku",
    "cantidad", "precio_unitario", "descuento_pct", "medio_pago", "venta_total",
)
BUDGET_FORMATS = {
    "tienda_id": text.DIGITS, "anio_mes": text.MONTH, "meta_venta": text.NUMBER, "meta_margen": text.NUMBER,
}
INVENTORY_FORMATS = {"tienda_id": text.DIGITS, "anio_mes": text.MONTH, "cantidad_disponible": text.DIGITS}
STORE_FORMATS = {"tienda_id": text.DIGITS, "fecha_apertura": text.DATE}
REFERENCES = (
    ("tienda_id", "dim_tienda"), ("empleado_id", "dim_empleado"), ("sku", "dim_producto"), ("cliente_id", "dim_cliente"),
)

#: Pieces in which sales are grouped, and the bytes of their table below which they aren't cut further. Every piece reads the table.
PIECES, PIECE_BYTES = 4, 16 * 1024 * 1024

Tables = Mapping[str, DataFrame]


def row_count() -> dict[str, Column]:
    """Observed while a table is written."""
    return {"filas": F.count(F.lit(1))}


def amount(col: str) -> dict[str, Column]:
    return {"venta_total": F.sum(col)}


def _pieces(table: DataFrame) -> int:
    return max(1, min(PIECES, estimated_bytes(table) // PIECE_BYTES))


def bronze(spark: SparkSession, folder: str, manifest: Sequence[Entry] = MANIFEST) -> Tables:
    return ingest(spark, folder, manifest)


def silver_dims(spark: SparkSession) -> Tables:
    """Raw catalogs to typed ones; keys must be unique and required columns present."""
    plan = {
        "dim_tienda": ("tiendas", clean.clean_store, "tienda_id", (
            "nombre_tienda", "ciudad", "pais", "region", "formato_tienda", "fecha_apertura")),
        "dim_producto": ("productos", clean.clean_product, "sku", (
            "nombre_producto", "categoria", "subcategoria", "costo_unitario")),
        "dim_empleado": ("empleados", clean.clean_employee, "empleado_id", (
            "nombre_completo", "tienda_id", "puesto", "fecha_ingreso", "salario", "documento_identidad")),
        "dim_cliente": ("clientes", clean.clean_customer, "cliente_id", (
            "nombre_completo", "fecha_registro", "tier_lealtad")),
    }
    out = {}
    for table, (raw, cleaner, key, required) in plan.items():
        check = partial(quality.validar, keys=[key], required=[key, *required])
        out[table] = escribir_silver(cleaner(leer_bronze(spark, raw)), table, check)
    return out


def budget_rules() -> quality.Rules:
    sale, margin = F.col("meta_venta"), F.col("meta_margen")
    return {"metas_fuera_de_regla": (sale <= 0) | (margin <= 0) | (margin >= sale)}


def budget_checks(budget: DataFrame) -> DataFrame:
    columns = ["tienda_id", "anio_mes", "meta_venta", "meta_margen"]
    return quality.validar(budget, ["tienda_id", "anio_mes"], columns, budget_rules())


def inventory_checks(stock: DataFrame) -> DataFrame:
    key = ["tienda_id", "categoria", "anio_mes"]
    negative = {"stock_negativo": F.col("cantidad_disponible") < 0}
    return quality.validar(stock, key, [*key, "cantidad_disponible"], negative)


def sales_rules() -> quality.Rules:
    return quality.null_rules(REQUIRED_SALES) | quality.domain_rules({"medio_pago": clean.PAYMENTS}) | quality.format_rules({"hora_venta": text.CLOCK})


def sales_checks(sales: DataFrame) -> DataFrame:
    return quality.combine(quality.validar(sales, ["transaccion_id"], []), quality.rules(sales, sales_rules()))


def sales_conversions(raw: DataFrame) -> DataFrame:
    """Customer and discount text that is present but does not convert; both may be blank, so no null check sees them."""
    typed = {"cliente_id": convert.to_int(text.blank_to_null("cliente_id")), "descuento_pct": convert.int_or("descuento_pct", 0)}
    return quality.rules(raw, {f"no_convierte_{c}": ~text.is_blank(c) & value.isNull() for c, value in typed.items()})


def _silver_sales(spark: SparkSession) -> Tables:
    """The raw rows are grouped once, a large table in pieces; counts, valid and rejected rows all come from the grouped ones."""
    raw = leer_bronze(spark, "ventas_transacciones")
    pieces = _pieces(raw)
    with staged(dedup.copies_in_pieces(raw, pieces), "ventas_unicas", spark) as grouped:
        counts = dedup.reconcile_copies(grouped)
        read, kept = raw.agg(F.count(F.lit(1)).alias("izquierda")), counts.select(F.col("filas_origen").alias("derecha"))
        sides = read.unionByName(kept, allowMissingColumns=True).agg(F.max("izquierda").alias("izquierda"), F.max("derecha").alias("derecha"))
        require(quality.combine(
            _as_control(sides.withColumn("cumple", F.col("izquierda") == F.col("derecha")), "filas_leidas"),
            counts.select(F.lit("filas_origen").alias("control"), F.col("filas_origen").alias("valor"), F.col("cierra").alias("cumple")),
        ))
        require(sales_conversions(grouped))
        # an id names one row among all distinct ones, the rejected ones too
        for piece in dedup.pieces_by(grouped, ["transaccion_id"], pieces):
            require(quality.validar(piece, ["transaccion_id"], []))
        valid, rejected = dedup.split(grouped.drop("_copias"), text.is_blank("sku"))
        return {
            "ventas_enriquecidas": escribir_silver(
                clean.clean_sales(valid), "ventas_enriquecidas", forbidden=sales_rules(), measures=row_count() | amount("venta_total"),
                order=["tienda_id", "fecha_venta"]),
            "rechazos_ventas": escribir_silver(clean.with_reason(rejected), "rechazos_ventas", measures=row_count()),
        }


def _silver_budget(spark: SparkSession, months: int) -> DataFrame:
    raw = leer_bronze(spark, "presupuesto_metas")
    require(quality.formats(raw, BUDGET_FORMATS))
    stores = leer_silver(spark, "dim_tienda")

    def check(budget: DataFrame) -> DataFrame:
        return quality.combine(
            budget_checks(budget),
            quality.complete_check(budget, ["tienda_id"], "anio_mes", months),
            quality.orphan_key_check(budget, "tienda_id", stores, "tienda_id"),
        )

    return escribir_silver(clean.clean_budget(raw), "presupuesto", check)


def _silver_inventory(spark: SparkSession, months: int) -> DataFrame:
    raw = leer_bronze(spark, "inventario_snapshot")
    require(quality.formats(raw, INVENTORY_FORMATS))
    stores, products = leer_silver(spark, "dim_tienda"), leer_silver(spark, "dim_producto")

    def check(stock: DataFrame) -> DataFrame:
        return quality.combine(
            inventory_checks(stock),
            quality.complete_check(stock, ["tienda_id", "categoria"], "anio_mes", months),
            quality.orphan_key_check(stock, "categoria", products.select("categoria").distinct(), "categoria"),
            quality.orphan_key_check(stock, "tienda_id", stores, "tienda_id"),
        )

    return escribir_silver(clean.clean_inventory(raw), "inventario", check, measures=row_count())


def silver_facts(spark: SparkSession, months: int = 12) -> Tables:
    """Raw facts to typed ones, with rejected sales kept apart."""
    return {
        **_silver_sales(spark),
        "presupuesto": _silver_budget(spark, months),
        "inventario": _silver_inventory(spark, months),
    }


def sales_references(spark: SparkSession) -> DataFrame:
    """Sales whose store, employee, product or customer the catalogs lack; informative."""
    sales = leer_silver(spark, "ventas_enriquecidas")
    return quality.references(sales, [(c, leer_silver(spark, dim), c) for c, dim in REFERENCES])


def stock_coverage(spark: SparkSession) -> DataFrame:
    """Stores without any inventory; informative."""
    shown = ["tienda_id", "nombre_tienda", "formato_tienda"]
    return quality.coverage(leer_silver(spark, "dim_tienda"), leer_silver(spark, "inventario"), "tienda_id", shown)


def gold_dims(spark: SparkSession, load: Load) -> Tables:
    sales = leer_silver(spark, "ventas_enriquecidas")
    uses = {
        "ventas_enriquecidas": (sales, "fecha_venta"),
        "presupuesto": (leer_silver(spark, "presupuesto"), "anio_mes"),
        "inventario": (leer_silver(spark, "inventario"), "anio_mes"),
    }
    plan = {
        "DimFecha": (dimensions.dim_fecha(sales), "fecha_key", "fecha", [
            partial(quality.calendar_complete, uses=uses)]),
        "DimTienda": (dimensions.dim_tienda(leer_silver(spark, "dim_tienda")), "tienda_key", "tienda_id", [
            partial(quality.unique, col="nombre_tienda_display")]),
        "DimProducto": (dimensions.dim_producto(leer_silver(spark, "dim_producto")), "producto_key", "sku", []),
        "DimEmpleado": (dimensions.dim_empleado(leer_silver(spark, "dim_empleado")), "empleado_key", "empleado_id", []),
        "DimCliente": (dimensions.dim_cliente(leer_silver(spark, "dim_cliente")), "cliente_key", "cliente_id", [
            partial(quality.has_member, key="cliente_key", value=-1)]),
    }
    return {
        table: escribir_gold(
            df, table, load,
            partial(quality.validar_dimension, surrogate=surrogate, natural=natural),
            *checks,
        )
        for table, (df, surrogate, natural, checks) in plan.items()
    }


def _as_control(comparison: DataFrame, name: str) -> DataFrame:
    left, right = F.col("izquierda"), F.col("derecha")
    return comparison.select(F.lit(name).alias("control"), (right - left).cast("bigint").alias("valor"), "cumple")


def _one_row_per_id(fact: DataFrame, piece: int, pieces: int) -> DataFrame:
    """The key control of one piece of the fact."""
    return quality.validar(list(dedup.pieces_by(fact, ["transaccion_id"], pieces))[piece], keys=["transaccion_id"], required=[])


def gold_facts(spark: SparkSession, load: Load, partition_sales: bool = False) -> Tables:
    """Facts and aggregates. ``partition_sales`` stores the sale lines by day, for tables large
    enough that a report on some months should read only those days.

    Rows and amounts are observed while a table is written and held against those of its source, observed in the same
    way; only the key count of the sales fact reads what was written.
    """
    sales, inventory = leer_silver(spark, "ventas_enriquecidas"), leer_silver(spark, "inventario")
    names = {"tienda": "DimTienda", "producto": "DimProducto", "empleado": "DimEmpleado", "cliente": "DimCliente"}
    dims = {role: leer_gold(spark, table, load) for role, table in names.items()}
    sold, stocked = measured(spark, "silver.ventas_enriquecidas"), measured(spark, "silver.inventario")
    pieces = _pieces(sales)
    with scratch(spark, "claves_ventas") as folder:
        fact = escribir_gold(
            facts.fact_sales_pieces(sales, dims, folder), "FactVentas", load, *(partial(_one_row_per_id, piece=k, pieces=pieces) for k in range(pieces)),
            order=["tienda_key", "fecha_key"], forbidden=quality.null_rules(["fecha_key"]), measures=row_count() | amount("venta_total"), expected={k: sold[k] for k in ("filas", "venta_total")},
            partition_by="fecha_key" if partition_sales else None)
    calendar, budget = leer_gold(spark, "DimFecha", load), leer_silver(spark, "presupuesto")
    # totals are by store, so stores are summed in pieces
    targets = (facts.actual_vs_target(facts.monthly(lines, calendar, dims["tienda"]), budget) for lines in dedup.pieces_by(fact, ["tienda_key"], pieces))
    by_day = (facts.daily(lines) for lines in dedup.pieces_by(fact, ["tienda_key"], pieces))
    return {
        "FactVentas": fact,
        "real_vs_presupuesto": escribir_gold(
            targets, "real_vs_presupuesto", load, measures=amount("venta_total_real"), expected={"venta_total": sold["venta_total"]}),
        "ventas_diarias_por_tienda": escribir_gold(
            by_day, "ventas_diarias_por_tienda", load, order=["tienda_key", "fecha_key"], measures=amount("venta_total"), expected={"venta_total": sold["venta_total"]}),
        "FactInventario": escribir_gold(
            facts.fact_inventory(inventory, dims["tienda"]), "FactInventario", load, forbidden=quality.null_rules(["tienda_key"]),
            measures=row_count(), expected={"filas": stocked["filas"]}),
    }


def gold(spark: SparkSession, partition_sales: bool = False) -> Tables:
    """The star, written as one load and published by one switch."""
    with new_load(spark, GOLD) as load:
        tables = [*gold_dims(spark, load), *gold_facts(spark, load, partition_sales)]
    return {table: leer_gold(spark, table) for table in tables}


def target_summary(targets: DataFrame) -> DataFrame:
    """Met and missed store months and the extremes; a month without a target is in neither count."""
    pct = F.col("variacion_pct")
    return targets.agg(
        F.count_if(pct >= 0).alias("meses_que_cumplen"),
        F.count_if(pct < 0).alias("meses_que_no_cumplen"),
        F.count_if(F.col("meta_venta").isNull()).alias("meses_sin_meta"),
        F.min(pct).alias("peor_variacion"),
        F.max(pct).alias("mejor_variacion"),
    )


def rebuild_events(spark: SparkSession, table: str = "ventas_tiempo_real", match_double: bool = False) -> DataFrame:
    """Full rebuild of the refined events from the raw ones; running it twice gives the same table."""
    refined = refine_events(leer_bronze(spark, table), match_double)

    def not_empty(events: DataFrame) -> DataFrame:
        rows = F.count(F.lit(1))
        return events.agg(rows.alias("valor")).select(
            F.lit("filas").alias("control"), "valor", (F.col("valor") > 0).alias("cumple"))

    return escribir_silver(refined, table, event_checks, not_empty)


def profile_table(spark: SparkSession, table: str) -> DataFrame:
    """Read-only column profile of a raw table."""
    return quality.profile(leer_bronze(spark, table))


def run_layers(spark: SparkSession, months: int = 12, partition_sales: bool = False) -> Tables:
    """Raw tables to the star."""
    silver_dims(spark)
    silver_facts(spark, months)
    return gold(spark, partition_sales)


def run_batch(spark: SparkSession, folder: str, months: int = 12, partition_sales: bool = False) -> Tables:
    bronze(spark, folder)
    return run_layers(spark, months, partition_sales)
