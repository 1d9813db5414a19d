"""Files to star schema on a small dirty fixture."""

from decimal import Decimal

import pytest

from shelfstar.operators.quality import QualityError
from shelfstar.plans import jobs, reports
from shelfstar.sources.tables import leer_bronze, leer_gold, leer_silver

STORES = [
    "101|TR Lima|Lima|Perú|Perú|Express|2020/01/05", "102|TR Lima|Lima|Perú|Perú|Express|2021/06/01",
    "125|TR Online|N/A|México|México|Online|2022/03/01",
]
PRODUCTS = ["SKU-1|  Mesa |HOGAR|Sala|M1|10.50", "SKU-2|Radio| electronica|Audio||20.00"]
EMPLOYEES = ["5001|Ana|101|Cajero|2020/01/01|1500.50| 00123456 ", "5002|Luis|125|Gerente|2019/05/05|2500.00|A1"]
CUSTOMERS = ["1|Eva|2020/02/02|Oro|Lima", "2|Leo|2021/03/03||Lima", "3|Sol|2021/03/03|  |Lima"]
BUDGET = [f"{t}|2025/{m:02d}|{100 + m}.50|{20 + m}" for t in (101, 102, 125) for m in range(1, 13)]
STOCK = [f"{t}|{c}|2025/{m:02d}|{0 if (t, m) == (101, 12) else m}" for t in (101, 102) for c in ("HOGAR", "electronica ") for m in range(1, 13)]
SALES = [
    "T1|2025/01/01|10:00:00|101|5001|1|SKU-1|3|10,05|10|TARJETA",
    "T1|2025/01/01|10:00:00|101|5001|1|SKU-1|3|10,05|10|TARJETA",
    "T2|2025/01/02|11:00:00|101|5001||SKU-2|1|100.00||efectivo",
    "T3|2025/03/01|12:00:00|102|5001|999|SKU-1|2|50.00|0|Billetera digital",
    "T4|2025/12/31|23:59:59|125|5002|2|SKU-9|1|5.00|90|tarjeta ",
    "T5|2025/05/05|12:00:00|101|5001|1||1|5.00|0|tarjeta",
    "T5|2025/05/05|12:00:00|101|5001|1||1|5.00|0|tarjeta",
]
HEADERS = {
    "tiendas": "tienda_id|nombre_tienda|ciudad|pais|region|formato_tienda|fecha_apertura",
    "productos": "sku|nombre_producto|categoria|subcategoria|marca|costo_unitario",
    "empleados": "empleado_id|nombre_completo|tienda_id|puesto|fecha_ingreso|salario|documento_identidad",
    "clientes": "cliente_id|nombre_completo|fecha_registro|tier_lealtad|ciudad",
    "presupuesto_metas": "tienda_id|anio_mes|meta_venta|meta_margen",
    "inventario_snapshot": "tienda_id|categoria|anio_mes|cantidad_disponible",
    "ventas_transacciones": "transaccion_id|fecha|hora|tienda_id|empleado_id|cliente_id|sku|cantidad|precio_unitario|descuento_pct|medio_pago",
}
LINES = {
    "tiendas": STORES, "productos": PRODUCTS, "empleados": EMPLOYEES, "clientes": CUSTOMERS,
    "presupuesto_metas": BUDGET, "inventario_snapshot": STOCK, "ventas_transacciones": SALES,
}


def write_files(folder, **changes):
    folder.mkdir(exist_ok=True)
    for name, lines in (LINES | changes).items():
        (folder / f"{name}.csv").write_text("\n".join([HEADERS[name], *lines]) + "\n", encoding="utf-8")
    return str(folder)


@pytest.fixture(scope="module")
def gold(spark, tmp_path_factory):
    return jobs.run_batch(spark, write_files(tmp_path_factory.mktemp("raw")))


def test_bronze_is_text_with_audit(spark, gold):
    raw = spark.table("bronze.ventas_transacciones")
    assert set(dict(raw.drop("_fecha_ingesta").dtypes).values()) == {"string"}
    assert raw.first()["_archivo_origen"].endswith("ventas_transacciones.csv")
    assert leer_bronze(spark, "tiendas").columns == HEADERS["tiendas"].split("|")


def test_silver_sales_and_rejects(spark, rows, gold):
    assert rows(leer_silver(spark, "ventas_enriquecidas"), "transaccion_id", "venta_total", "medio_pago") == [
        ("T1", Decimal("27.14"), "Tarjeta"), ("T2", Decimal("100.00"), "Efectivo"),
        ("T3", Decimal("100.00"), "Billetera Digital"), ("T4", Decimal("0.50"), "Tarjeta"),
    ]
    assert rows(leer_silver(spark, "rechazos_ventas"), "transaccion_id", "motivo_rechazo") == [
        ("T5", "SKU vacío: producto no identificable")]
    assert rows(leer_silver(spark, "dim_cliente"), "cliente_id", "tier_lealtad") == [(1, "Oro"), (2, "Sin Tier"), (3, "Sin Tier")]
    assert rows(leer_silver(spark, "dim_producto"), "nombre_producto", "categoria") == [("Mesa", "Hogar"), ("Radio", "Electronica")]


def test_fact_keys_flags_and_cost(rows, gold):
    got = rows(gold["FactVentas"], "transaccion_id", "fecha_key", "tienda_key", "producto_key", "cliente_key", "costo_total", "requiere_revision")
    assert got == [
        ("T1", 20250101, 1, 1, 1, Decimal("31.50"), False),
        ("T2", 20250102, 1, 2, -1, Decimal("20.00"), False),
        ("T3", 20250301, 2, 1, -1, Decimal("21.00"), True),
        ("T4", 20251231, 3, None, 2, None, True),
    ]


def test_gold_sizes(spark, gold):
    sizes = {name: df.count() for name, df in gold.items()}
    assert sizes == {
        "DimFecha": 365, "DimTienda": 3, "DimProducto": 2, "DimEmpleado": 2, "DimCliente": 4,
        "FactVentas": 4, "real_vs_presupuesto": 3, "ventas_diarias_por_tienda": 4, "FactInventario": 48,
    }
    assert leer_gold(spark, "DimTienda").filter("tienda_id = 102").first()["nombre_tienda_display"] == "TR Lima (102)"


def test_targets(rows, gold):
    assert rows(gold["real_vs_presupuesto"])[0] == (101, "2025/01", Decimal("127.14"), Decimal("101.50"), Decimal("25.26"))


def test_informative_checks(spark, rows, gold):
    got = {r["control"]: r["valor"] for r in jobs.sales_references(spark).collect()}
    assert got == {"huerfanas_tienda_id": 0, "huerfanas_empleado_id": 0, "huerfanas_sku": 1, "huerfanas_cliente_id": 1}
    assert rows(jobs.stock_coverage(spark)) == [(125, "TR Online", "Online")]
    profiled = {r["columna"]: r["nulos_o_vacios"] for r in jobs.profile_table(spark, "clientes").collect()}
    assert profiled["tier_lealtad"] == 2


def test_reports_on_published_tables(rows, gold):
    assert rows(reports.sales_by_region(gold)) == [("México", Decimal("0.50")), ("Perú", Decimal("227.14"))]
    assert reports.stock_kpis(gold).first()["quiebres_de_stock"] == 2
    assert rows(reports.sales_by_region(dict(gold), region=["Perú"])) == [("Perú", Decimal("227.14"))]


@pytest.mark.parametrize("table, lines, message", [
    ("tiendas", [*STORES, STORES[0]], "duplicados"),
    ("tiendas", [STORES[0].replace("2020/01/05", "2021/02/30")], "nulos_fecha_apertura"),
])
def test_a_failed_check_publishes_nothing(spark, gold, tmp_path, table, lines, message):
    before = leer_silver(spark, "dim_tienda").count()
    jobs.bronze(spark, write_files(tmp_path / "bad", **{table: lines}))
    with pytest.raises(QualityError, match=message):
        jobs.silver_dims(spark)
    assert leer_silver(spark, "dim_tienda").count() == before


@pytest.mark.parametrize("table, lines, message", [
    ("ventas_transacciones", [*SALES, SALES[2].replace("efectivo", "bitcoin").replace("T2", "T9")], "fuera_de_dominio_medio_pago"),
    ("ventas_transacciones", [*SALES, SALES[2].replace("11:00:00", "25:00:00").replace("T2", "T9")], "nulos_fecha_hora_venta.*hora_venta"),
    ("ventas_transacciones", [*SALES, SALES[2].replace("100.00", "101.00")], "duplicados"),
    ("presupuesto_metas", BUDGET[1:], "incompletos"),
    ("presupuesto_metas", [*BUDGET[:-1], "125|2025/13|1|1"], "anio_mes"),
    ("inventario_snapshot", [*STOCK, *(s.replace("101|", "999|") for s in STOCK if s.startswith("101"))], "claves_sin_dimension_tienda_id"),
])
def test_bad_facts_stop_the_job(spark, gold, tmp_path, table, lines, message):
    jobs.bronze(spark, write_files(tmp_path / "bad", **{table: lines}))
    with pytest.raises(QualityError, match=message):
        jobs.silver_facts(spark)


def test_reload_gives_the_same_star(spark, rows, gold, tmp_path):
    before = rows(leer_gold(spark, "FactVentas"))
    again = jobs.run_batch(spark, write_files(tmp_path / "again"))
    assert rows(again["FactVentas"]) == before


def test_sales_by_day_give_the_same_reports_and_prune(spark, rows, gold, tmp_path):
    before, region = rows(leer_gold(spark, "FactVentas")), rows(reports.sales_by_region(gold))
    split = jobs.run_batch(spark, write_files(tmp_path / "days"), partition_sales=True)
    assert rows(split["FactVentas"]) == before
    assert rows(reports.sales_by_region(split)) == region
    only_january = reports.kpis(split, mes=["Enero"])
    assert only_january.first()["transacciones"] == 2
    assert "dynamicpruning" in only_january._jdf.queryExecution().executedPlan().toString()
    flat = jobs.run_batch(spark, write_files(tmp_path / "flat"))
    assert rows(flat["FactVentas"]) == before


def test_rebuild_events(spark, tmp_path):
    from shelfstar.sources.events import read_events_batch
    from shelfstar.sources.tables import write_bronze

    from .test_streaming import event, write

    write(tmp_path / "in", "a", [event(n) for n in range(5)] * 2)
    write_bronze(read_events_batch(spark, str(tmp_path / "in")), "bronze.ventas_tiempo_real")
    assert jobs.rebuild_events(spark).count() == 5
    assert jobs.rebuild_events(spark).count() == 5
    write_bronze(read_events_batch(spark, str(tmp_path / "in")).limit(0), "bronze.ventas_tiempo_real")
    with pytest.raises(QualityError, match="filas"):
        jobs.rebuild_events(spark)
