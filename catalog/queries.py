"""The registered queries: each operator on the given tables.

Every entry takes ``(spark, sf_dir)`` and returns a DataFrame. ``present`` puts the result in the
types the SQL side also gives: decimals as doubles, dates and timestamps as text, arrays joined.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from shelfstar.functions import convert, text
from shelfstar.operators import aggregates, clean, dedup, dimensions, facts, filters, joins, keys, quality, security
from shelfstar.operators.contracts import conform, contract_check
from shelfstar.operators.periods import last_period
from shelfstar.plans import jobs, reports
from shelfstar.session import ensure_checkpoint_dir
from shelfstar.sources.delimited import TABLE_NAMES, read_delimited
from shelfstar.sources.events import LETTER, REASON, parse_events, read_event_lines, read_events
from shelfstar.sources.tables import LOAD_AUDIT
from shelfstar.streaming import refine

from . import load, roles

Query = Callable[[SparkSession, str], DataFrame]
_REGISTRY: dict[str, Query] = {}

MOMENT = "yyyy-MM-dd HH:mm:ss.SSSSSS"


def _shown(field: T.StructField) -> F.Column:
    col = F.col(f"`{field.name}`")
    if isinstance(field.dataType, T.DecimalType):
        col = F.round(col, 6).cast("double")
    elif isinstance(field.dataType, T.DateType):
        col = col.cast("string")
    elif isinstance(field.dataType, (T.TimestampType, T.TimestampNTZType)):
        col = F.date_format(col, MOMENT)
    elif isinstance(field.dataType, T.ArrayType):
        col = F.array_join(col.cast("array<string>"), ",")
    return col.alias(field.name)


def present(df: DataFrame) -> DataFrame:
    return df.select(*map(_shown, df.schema.fields))


def query(build: Query) -> Query:
    _REGISTRY[build.__name__] = lambda spark, sf: present(build(spark, sf))
    return build


def queries() -> dict[str, Query]:
    return dict(_REGISTRY)


def _folder(spark: SparkSession, name: str) -> str:
    """New folder inside the session's shared checkpoint folder."""
    ensure_checkpoint_dir(spark)
    return f"{spark.sparkContext.getCheckpointDir()}/{name}-{uuid.uuid4().hex}"


# ---- cleaning ---------------------------------------------------------------------------------

@query
def clean_store(spark, sf):
    return roles.stores(spark, sf)


@query
def clean_product(spark, sf):
    return roles.products(spark, sf)


@query
def clean_employee(spark, sf):
    return roles.employees(spark, sf)


@query
def clean_customer(spark, sf):
    return roles.customers(spark, sf)


def _valid_sales(spark, sf):
    return dedup.split(dedup.dedup_exact(roles.raw_sales(spark, sf)), text.is_blank("sku"))[0]


def _silver_sales(spark, sf):
    return clean.clean_sales(_valid_sales(spark, sf))


@query
def clean_sales(spark, sf):
    return _silver_sales(spark, sf)


@query
def clean_budget(spark, sf):
    return roles.budget(spark, sf)


@query
def clean_inventory(spark, sf):
    return roles.inventory(spark, sf)


@query
def clean_events(spark, sf):
    return refine.refine_events(roles.raw_events(spark, sf))


@query
def clean_events_double(spark, sf):
    return refine.refine_events(roles.raw_events(spark, sf), match_double=True)


@query
def before_after_store(spark, sf):
    conversions = {"tienda_id": convert.to_int("tienda_id"), "fecha_apertura": convert.to_day("fecha_apertura")}
    return clean.before_after(roles.raw_stores(spark, sf), conversions)


@query
def before_after_sales(spark, sf):
    pairs = clean.before_after_sales(_valid_sales(spark, sf), ["precio_unitario", "descuento_pct", "medio_pago"], ["venta_total"])
    return pairs.filter(text.contains("precio_unitario_original", ",") | text.is_blank("descuento_pct_original"))


# ---- duplicates, rejects, checks --------------------------------------------------------------

@query
def dedup_exact(spark, sf):
    return dedup.dedup_exact(roles.raw_sales(spark, sf))


@query
def duplicate_report(spark, sf):
    return dedup.duplicate_report(roles.raw_sales(spark, sf))


@query
def split_rejected(spark, sf):
    rejected = dedup.split(dedup.dedup_exact(roles.raw_sales(spark, sf)), text.is_blank("sku"))[1]
    return clean.with_reason(rejected)


@query
def reconcile_rows(spark, sf):
    return dedup.reconcile_rows(roles.raw_sales(spark, sf))


@query
def sales_checks(spark, sf):
    return jobs.sales_checks(_silver_sales(spark, sf))


@query
def validate_store(spark, sf):
    return quality.validar(roles.stores(spark, sf), ["tienda_id"], ["tienda_id", "nombre_tienda", "fecha_apertura"])


@query
def validate_budget(spark, sf):
    return jobs.budget_checks(roles.budget(spark, sf))


@query
def validate_dimension(spark, sf):
    customers = dimensions.dim_cliente(roles.customers(spark, sf))
    return quality.combine(
        quality.validar_dimension(customers, "cliente_key", "cliente_id"),
        quality.has_member(customers, "cliente_key", joins.SENTINEL),
    )


@query
def unique_display_name(spark, sf):
    stores = dimensions.dim_tienda(roles.stores(spark, sf))
    return quality.combine(quality.unique(stores, "nombre_tienda_display"), quality.unique(stores, "nombre_tienda"))


@query
def format_check(spark, sf):
    sales_patterns = {"hora": text.CLOCK, "precio_unitario": text.NUMBER, "sku": "^SKU-[0-9]+$"}
    return quality.combine(
        quality.formats(roles.raw_stores(spark, sf), jobs.STORE_FORMATS),
        quality.formats(roles.raw_customers(spark, sf), {"tier_lealtad": "^[A-Z]+$"}),
        quality.formats(roles.raw_sales(spark, sf), sales_patterns),
    )


@query
def failed_conversions(spark, sf):
    compared = before_after_store(spark, sf)
    pairs = [("tienda_id_texto", "tienda_id_valor"), ("fecha_apertura_texto", "fecha_apertura_valor")]
    return quality.failed_conversions(compared, pairs)


@query
def domain_check(spark, sf):
    return quality.domain(roles.raw_sales(spark, sf), "medio_pago", clean.PAYMENTS)


@query
def sales_references(spark, sf):
    dims = [
        ("tienda_id", roles.stores(spark, sf)), ("empleado_id", roles.employees(spark, sf)),
        ("sku", roles.products(spark, sf)), ("cliente_id", roles.customers(spark, sf)),
    ]
    sales = roles.typed_sales(spark, sf, with_customer=True)
    return quality.references(sales, [(col, dim, col) for col, dim in dims])


@query
def orphan_keys(spark, sf):
    return joins.orphan_keys(roles.typed_sales(spark, sf), "sku", roles.products(spark, sf), "sku")


@query
def completeness(spark, sf):
    stock = roles.inventory(spark, sf)
    return quality.complete(stock, ["tienda_id", "categoria"], "anio_mes", roles.months(stock))


@query
def completeness_check(spark, sf):
    targets = roles.budget(spark, sf)
    return quality.complete_check(targets, ["tienda_id"], "anio_mes", roles.months(targets))


@query
def inventory_checks(spark, sf):
    stock, categories = roles.inventory(spark, sf), roles.products(spark, sf).select("categoria").distinct()
    return quality.combine(
        jobs.inventory_checks(stock), quality.orphan_key_check(stock, "categoria", categories, "categoria")
    )


@query
def event_checks(spark, sf):
    return refine.event_checks(refine.refine_events(roles.raw_events(spark, sf)))


@query
def calendar_check(spark, sf):
    uses = {
        "ventas": (roles.typed_sales(spark, sf), "fecha_venta"),
        "presupuesto": (roles.budget(spark, sf), "anio_mes"),
        "inventario": (roles.inventory(spark, sf), "anio_mes"),
    }
    return quality.calendar_complete(roles.calendar(spark, sf), uses)


@query
def contract_check_fact(spark, sf):
    return contract_check(roles.full_fact(spark, sf), "FactVentas")


@query
def reconcile_amount(spark, sf):
    sales = roles.typed_sales(spark, sf)
    return quality.reconcile_amount(sales, roles.full_fact(spark, sf), "venta_total")


@query
def same_rows(spark, sf):
    return quality.same_rows(roles.typed_sales(spark, sf), roles.full_fact(spark, sf))


@query
def contract_breaks(spark, sf):
    """The contract's control on a fact with costs beyond their type and lines without a customer member."""
    broken = roles.full_fact(spark, sf).withColumns({
        "costo_total": F.when(F.col("cantidad") == 17, F.col("costo_total") * 1_000_000_000).otherwise(F.col("costo_total")),
        "cliente_key": F.when(F.col("cantidad") != 23, F.col("cliente_key")),
    })
    return contract_check(broken, "FactVentas")


def _without_some(spark, sf):
    return roles.full_fact(spark, sf).filter("cantidad <> 17")


@query
def reconcile_amount_breaks(spark, sf):
    """A fact that lost its lines of 17 units, against the sales."""
    return quality.reconcile_amount(roles.typed_sales(spark, sf), _without_some(spark, sf), "venta_total")


@query
def same_rows_breaks(spark, sf):
    return quality.same_rows(roles.typed_sales(spark, sf), _without_some(spark, sf))


@query
def sales_references_fatal(spark, sf):
    """References as a control that stops a job."""
    dims = [("sku", roles.products(spark, sf)), ("cliente_id", roles.customers(spark, sf)), ("tienda_id", roles.stores(spark, sf))]
    return quality.references(roles.typed_sales(spark, sf, with_customer=True), [(col, dim, col) for col, dim in dims], fatal=True)


@query
def verify_rows(spark, sf):
    """Rows of the published tables against those that their sources should give."""
    raw = roles.raw_sales(spark, sf)
    expected = {
        "bronze.ventas_transacciones": raw.count(), "silver.ventas_enriquecidas": _valid_sales(spark, sf).count(),
        "gold.DimTienda": roles.raw_stores(spark, sf).count(), "gold.DimCliente": roles.raw_customers(spark, sf).count() + 1,
    }
    return quality.verify_written({name.split(".")[1]: (load.loaded(spark, sf, name), rows) for name, rows in expected.items()})


@query
def sales_conversions(spark, sf):
    """The fatal control of the sales job on text that does not convert."""
    raw = roles.raw_sales(spark, sf)
    dirty = raw.withColumns({
        "descuento_pct": F.when(F.col("cantidad") == "17", "9O").otherwise(F.col("descuento_pct")),
        "cliente_id": F.when(F.col("cantidad") == "23", F.concat(F.lit("C"), "tienda_id")).otherwise(F.col("cliente_id")),
    })
    return jobs.sales_conversions(dirty)


@query
def profile_columns(spark, sf):
    return quality.profile(roles.raw_sales(spark, sf))


@query
def value_distribution(spark, sf):
    return quality.value_counts(roles.raw_sales(spark, sf), ["medio_pago", "tienda_id", "descuento_pct"])


@query
def repeated_names(spark, sf):
    return quality.repeated_names(roles.raw_stores(spark, sf), "nombre_tienda", ["tienda_id", "fecha_apertura"])


@query
def coverage(spark, sf):
    shown = ["tienda_id", "nombre_tienda", "formato_tienda"]
    return quality.coverage(roles.stores(spark, sf), roles.inventory(spark, sf), "tienda_id", shown)


@query
def repeated_event_ids(spark, sf):
    return quality.repeated_ids(refine.refine_events(roles.raw_events(spark, sf)), "evento_id")


@query
def top_repeated_event_ids(spark, sf):
    return filters.top_n(repeated_event_ids(spark, sf), [F.desc("count"), F.asc("evento_id")], 10)


# ---- star schema ------------------------------------------------------------------------------

@query
def dim_calendar(spark, sf):
    return roles.calendar(spark, sf)


@query
def dim_store(spark, sf):
    return roles.dims(spark, sf)["tienda"]


@query
def dim_product(spark, sf):
    return roles.dims(spark, sf)["producto"]


@query
def dim_employee(spark, sf):
    return roles.dims(spark, sf)["empleado"]


@query
def dim_customer(spark, sf):
    return roles.dims(spark, sf)["cliente"]


@query
def surrogate_key_pieces(spark, sf):
    """Numbering in integer pieces, the way a table too large for one task is numbered."""
    orders = roles.table(spark, sf, "orders").selectExpr("cast(o_orderkey as int) as pedido_id")
    return keys.surrogate_key(orders, "pedido_key", "pedido_id")


@query
def surrogate_key_ranges(spark, sf):
    """Numbering in range partitions, the way a large table with a text key is numbered."""
    return keys.surrogate_key(roles.products(spark, sf).select("sku"), "producto_key", "sku")


@query
def fact_sales(spark, sf):
    return roles.full_fact(spark, sf)


@query
def preview_fact(spark, sf):
    return filters.preview(roles.full_fact(spark, sf), ["fecha_key", "transaccion_id"])


@query
def fact_sales_spread(spark, sf):
    """The same fact when no dimension may be broadcast."""
    sales = roles.typed_sales(spark, sf, with_customer=True)
    return facts.fact_sales(sales, roles.dims(spark, sf), broadcast_bytes=0, hot_keys=20)


@query
def fact_sales_from_raw(spark, sf):
    """The same fact from the raw text rows, through deduplication, split and cleaning."""
    return facts.fact_sales(_silver_sales(spark, sf), roles.dims(spark, sf))


@query
def fact_inventory(spark, sf):
    return roles.stock_star(spark, sf)["FactInventario"]


def _daily(fact):
    return conform(facts.daily(fact), "ventas_diarias_por_tienda")


@query
def daily_store(spark, sf):
    return _daily(roles.sales_star(spark, sf)["FactVentas"])


@query
def monthly_store(spark, sf):
    star = roles.sales_star(spark, sf, ("tienda", "fecha"))
    return facts.monthly(star["FactVentas"], star["DimFecha"], star["DimTienda"])


@query
def actual_vs_target(spark, sf):
    return roles.target_star(spark, sf)["real_vs_presupuesto"]


@query
def target_summary(spark, sf):
    return jobs.target_summary(actual_vs_target(spark, sf))


@query
def closing_stock_by_category(spark, sf):
    return last_period(roles.inventory(spark, sf), "anio_mes", ["categoria"], "cantidad_disponible")


@query
def sales_summary(spark, sf):
    return aggregates.summary(roles.typed_sales(spark, sf, with_customer=True), {
        "venta_total": F.sum("venta_total"),
        "unidades": F.sum("cantidad"),
        "primera_venta": F.min("fecha_venta"),
        "ultima_venta": F.max("fecha_venta"),
        "ventas_sin_cliente": aggregates.count_if(F.col("cliente_id").isNull()),
    })


@query
def budget_summary(spark, sf):
    return aggregates.summary(roles.budget(spark, sf), {
        "filas": F.count(F.lit(1)),
        "tiendas": F.countDistinct("tienda_id"),
        "primer_mes": F.min("anio_mes"),
        "ultimo_mes": F.max("anio_mes"),
        "meta_venta_total": F.sum("meta_venta"),
        "meta_margen_total": F.sum("meta_margen"),
    })


@query
def inventory_summary(spark, sf):
    return aggregates.summary(roles.inventory(spark, sf), {
        "filas": F.count(F.lit(1)),
        "tiendas": F.countDistinct("tienda_id"),
        "categorias": F.countDistinct("categoria"),
        "meses": F.countDistinct("anio_mes"),
        "registros_sin_stock": aggregates.count_if(F.col("sin_stock")),
    })


@query
def payment_counts(spark, sf):
    return filters.sort(aggregates.counts(_silver_sales(spark, sf), "medio_pago"), ["count"], descending=["count"])


@query
def tier_counts(spark, sf):
    return filters.sort(aggregates.counts(roles.customers(spark, sf), "tier_lealtad"), ["tier_lealtad"])


# ---- measures and reports ---------------------------------------------------------------------

@query
def sales_measures(spark, sf):
    return reports.all_sales_measures(roles.sales_star(spark, sf, ("producto", "cliente")))


@query
def target_measures(spark, sf):
    return reports.all_target_measures(roles.target_star(spark, sf))


@query
def kpis(spark, sf):
    return reports.kpis(roles.sales_star(spark, sf, ("producto",)))


@query
def kpis_sliced(spark, sf):
    star = roles.sales_star(spark, sf, ("tienda", "producto", "fecha"))
    return reports.kpis(star, region=["México", "Perú"], formato=["Express"], mes=["Enero", "Febrero"])


@query
def sales_by_region(spark, sf):
    return reports.sales_by_region(roles.sales_star(spark, sf))


@query
def sales_by_category(spark, sf):
    return reports.sales_by_category(roles.sales_star(spark, sf, ("producto",)))


@query
def sales_cost_by_month(spark, sf):
    return reports.sales_cost_by_month(roles.sales_star(spark, sf, ("producto", "fecha")))


@query
def sales_by_weekday(spark, sf):
    star = roles.sales_star(spark, sf, ("tienda", "fecha"))
    return reports.sales_by_weekday(star | {"ventas_diarias_por_tienda": facts.daily(star["FactVentas"])})


@query
def target_by_month(spark, sf):
    return reports.target_by_month(roles.target_star(spark, sf))


@query
def target_table(spark, sf):
    return reports.target_table(roles.target_star(spark, sf))


@query
def fulfilment_by_store(spark, sf):
    return reports.fulfilment_by_store(roles.target_star(spark, sf))


@query
def target_kpis(spark, sf):
    return reports.target_kpis(roles.target_star(spark, sf), region=["Argentina"])


@query
def closing_stock_by_month(spark, sf):
    return reports.closing_stock_by_month(roles.stock_star(spark, sf))


@query
def stock_outs(spark, sf):
    return reports.stock_outs(roles.stock_star(spark, sf))


@query
def stock_pivot(spark, sf):
    return reports.stock_pivot(roles.stock_star(spark, sf), roles.CATEGORIES)


@query
def stock_kpis(spark, sf):
    return reports.stock_kpis(roles.stock_star(spark, sf), region=["Chile", "Colombia"], categoria=["Promo", "Small"])


# ---- security ---------------------------------------------------------------------------------

@query
def secure_sales_by_region(spark, sf):
    return reports.secure_sales_by_region(roles.sales_star(spark, sf), "Gerente_Mexico")


@query
def secure_sales_by_region_user(spark, sf):
    star = roles.sales_star(spark, sf) | {security.SECURITY_MAP: roles.security_map(spark, sf)}
    return reports.secure_sales_by_region(star, security.DYNAMIC_ROLE, "gerente1@example.com")


def _employee_tables(spark, sf):
    return {"DimEmpleado": roles.dims(spark, sf)["empleado"], security.SECURITY_MAP: roles.security_map(spark, sf)}


@query
def secure_employees(spark, sf):
    return reports.secure_employees(_employee_tables(spark, sf), "Default")


@query
def secure_employees_hr(spark, sf):
    return reports.secure_employees(_employee_tables(spark, sf), security.UNRESTRICTED_ROLE)


@query
def masked_employees(spark, sf):
    return security.tables_for(_employee_tables(spark, sf), "Default")["DimEmpleado"]


@query
def rls_static(spark, sf):
    star = roles.sales_star(spark, sf)
    # the lines are restricted before they are summed
    return _daily(security.row_filter(star, "Perú")["FactVentas"])


@query
def rls_dynamic(spark, sf):
    star = roles.target_star(spark, sf)
    tables = {k: star[k] for k in ("DimTienda", "real_vs_presupuesto")}
    tables[security.SECURITY_MAP] = roles.security_map(spark, sf)
    return security.row_filter_user(tables, "gerente2@example.com")["real_vs_presupuesto"]


@query
def security_map_own_rows(spark, sf):
    tables = {"DimTienda": roles.dims(spark, sf)["tienda"], security.SECURITY_MAP: roles.security_map(spark, sf)}
    return security.row_filter_user(tables, "gerente1@example.com")[security.SECURITY_MAP]


@query
def security_map_rows(spark, sf):
    """Rows of the security map that each role may read."""
    tables = _employee_tables(spark, sf) | {"DimTienda": roles.dims(spark, sf)["tienda"]}
    seen = None
    for role in ("Default", "RRHH", "Gerente_Peru", "Gerente_Region"):
        rows = security.tables_for(tables, role, "gerente1@example.com")[security.SECURITY_MAP].agg(F.lit(role).alias("role"), F.count(F.lit(1)).alias("filas"))
        seen = rows if seen is None else seen.unionByName(rows)
    return seen


# ---- events -----------------------------------------------------------------------------------

@query
def dedup_events(spark, sf):
    return refine.dedup_events(roles.raw_events(spark, sf)).withColumn("evento_id", F.trim("evento_id"))


@query
def events_stream(spark, sf):
    """Events as lines through the stream: two sinks for one read, deduplicated and typed, and what is no event in a third."""
    folder = _folder(spark, "events")
    roles.event_lines(spark, sf).write.text(f"{folder}/in")
    refined = refine.refine_events(parse_events(read_event_lines(spark, f"{folder}/in")))
    sinks = [refine.append_parquet(f"{folder}/{name}") for name in ("vivo", "tabla")]
    refine.fan_out(refined, sinks, f"{folder}/checkpoint", refine.append_parquet(f"{folder}/cartas")).awaitTermination()
    read = lambda name: spark.read.parquet(f"{folder}/{name}").drop("batch_id").withColumn("destino", F.lit(name))
    letters = read("cartas").withColumnsRenamed({LETTER: "registro", REASON: "motivo"})
    return read("vivo").unionByName(read("tabla")).unionByName(letters, allowMissingColumns=True)


@query
def events_incremental(spark, sf):
    """Refined events as the stream publishes them, batch by batch and each checked."""
    return load.streamed_events(spark, sf)["eventos"]


@query
def events_set_aside(spark, sf):
    """Batches that fail a control: their events with the controls."""
    return load.streamed_events(spark, sf)["apartados"]


@query
def anomalies_by_store_live(spark, sf):
    """The anomaly report by store as the stream keeps it up."""
    return load.streamed_events(spark, sf)["anomalias"]


@query
def letters_rebuilt(spark, sf):
    """Records of the raw event table that are no events, by reason."""
    lines = parse_events(roles.event_lines(spark, sf))
    return refine.split_letters(lines)[1].groupBy(F.col(REASON).alias("motivo")).agg(F.count(F.lit(1)).alias("registros"))


@query
def events_appended(spark, sf):
    """Raw events through the plain append of the stream, as many rows as were sent."""
    folder = _folder(spark, "append")
    roles.raw_events(spark, sf).write.json(f"{folder}/in")
    refine.stream_to_table(read_events(spark, f"{folder}/in"), f"{folder}/tabla", f"{folder}/checkpoint").awaitTermination()
    return spark.read.parquet(f"{folder}/tabla")


@query
def events_rebuilt(spark, sf):
    """Refined events as the batch rebuild publishes them."""
    return load.rebuilt_events(spark, sf).drop(LOAD_AUDIT)


def _refined(spark, sf):
    return refine.refine_events(roles.raw_events(spark, sf))


@query
def anomaly_summary(spark, sf):
    return refine.anomaly_summary(_refined(spark, sf))


@query
def latest_anomalies(spark, sf):
    return refine.latest_anomalies(_refined(spark, sf))


@query
def anomalies_by_store(spark, sf):
    return refine.anomalies_by_store(_refined(spark, sf))


@query
def arrival_latency(spark, sf):
    refined = refine.refine_events(roles.raw_events(spark, sf, with_arrival=True))
    timed = refine.arrival_latency(refined)
    return timed.select("evento_id", "timestamp_evento", "sku", "_fecha_ingesta", "latencia_seg")


# ---- the load ---------------------------------------------------------------------------------

@query
def load_raw(spark, sf):
    """Rows of each raw table, and how many carry the file and the time they came from."""
    counts = None
    for name in TABLE_NAMES:
        raw = load.loaded(spark, sf, f"bronze.{name}")
        one = raw.agg(
            F.lit(name).alias("tabla"), F.count(F.lit(1)).alias("filas"),
            F.count_if(text.contains("_archivo_origen", f"/{name}.csv/")).alias("con_archivo"), F.count("_fecha_ingesta").alias("con_fecha"),
        )
        counts = one if counts is None else counts.unionByName(one)
    return counts


def _published(table: str) -> Query:
    return lambda spark, sf: load.loaded(spark, sf, table).drop(LOAD_AUDIT)


LOADED = {
    "load_sales": "silver.ventas_enriquecidas", "load_rejects": "silver.rechazos_ventas", "load_budget": "silver.presupuesto",
    "load_store": "gold.DimTienda", "load_customer": "gold.DimCliente", "load_calendar": "gold.DimFecha", "load_fact": "gold.FactVentas",
    "load_daily": "gold.ventas_diarias_por_tienda", "load_targets": "gold.real_vs_presupuesto", "load_stock": "gold.FactInventario",
}
for _name, _table in LOADED.items():
    _REGISTRY[_name] = lambda spark, sf, build=_published(_table): present(build(spark, sf))


# ---- files ------------------------------------------------------------------------------------

@query
def malformed_lines(spark, sf):
    """Lines with more or fewer cells than their header, with file and reason, as the ingest keeps them."""
    return load.ingested_lines(spark, sf)


@query
def line_control(spark, sf):
    """Lines of the raw sales that don't fit, and lines in all, as observed while they were written."""
    return load.line_counts(spark, sf)


@query
def delimited_round_trip(spark, sf):
    """Raw sales written as delimited files and read back as text. Outer spaces survive; empty text comes back as NULL."""
    folder = _folder(spark, "delimited")
    writer = roles.raw_sales(spark, sf).write.option("sep", "|").option("header", True).option("quoteAll", True)
    writer.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(folder)
    return read_delimited(spark, folder)


_REGISTRY["contract_check"] = _REGISTRY.pop("contract_check_fact")
