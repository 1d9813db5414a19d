from decimal import Decimal

import pytest

from shelfstar.operators import measures as m
from shelfstar.operators.periods import last_period, last_period_sum
from shelfstar.plans import jobs, reports

FACT = "fecha_key int, tienda_key int, producto_key int, cliente_key int, cantidad int, descuento_pct int, venta_total decimal(12,2), costo_total decimal(12,2)"


@pytest.fixture
def star(spark):
    fact = spark.createDataFrame([
        (20250101, 1, 1, -1, 2, 90, Decimal("10.00"), Decimal("4.00")),
        (20250102, 1, 2, 5, 1, 0, Decimal("30.00"), Decimal("6.00")),
        (20250201, None, None, 5, 1, 50, Decimal("60.00"), None),
    ], FACT)
    return {
        "FactVentas": fact,
        "DimTienda": spark.createDataFrame(
            [(1, 101, "Lima (101)", "Perú", "Express"), (2, 102, "Quito (102)", "Chile", "Centro")],
            "tienda_key int, tienda_id int, nombre_tienda_display string, region string, formato_tienda string"),
        "DimFecha": spark.createDataFrame(
            [(20250101, 1, "Enero", "2025/01"), (20250102, 1, "Enero", "2025/01"), (20250201, 2, "Febrero", "2025/02")],
            "fecha_key int, mes int, nombre_mes string, anio_mes string"),
    }


def test_sales_measures(star):
    got = reports.all_sales_measures(star).first()
    assert got["venta_total"] == 100 and got["costo_total"] == 10 and got["margen_bruto"] == 90
    assert got["margen_pct"] == Decimal("0.9") and got["unidades_vendidas"] == 4 and got["transacciones"] == 3
    assert float(got["ticket_promedio"]) == pytest.approx(33.333333, abs=1e-6)
    assert got["ventas_descuento_atipico"] == 2
    assert float(got["pct_ventas_sin_cliente"]) == pytest.approx(1 / 3)


def test_measures_over_nothing_are_blank(star):
    empty = star | {"FactVentas": star["FactVentas"].limit(0)}
    assert set(reports.all_sales_measures(empty).first()) == {None}


def test_margin_with_one_side_blank(star):
    only_sales = m.evaluate(star["FactVentas"].filter("costo_total is null"), [m.MARGEN_BRUTO]).first()
    assert only_sales["margen_bruto"] == 60


def test_unmatched_rows_form_a_blank_group(star, rows):
    assert rows(reports.sales_by_region(star)) == [("Perú", Decimal("40.00")), (None, Decimal("60.00"))]
    assert rows(reports.sales_by_region(star, region=["Perú"])) == [("Perú", Decimal("40.00"))]


def test_month_order_and_slicer(star):
    got = [(r["mes"], r["nombre_mes"], r["venta_total"]) for r in reports.sales_cost_by_month(star).collect()]
    assert got == [(1, "Enero", 40), (2, "Febrero", 60)]
    assert reports.kpis(star, mes=["Enero"]).first()["transacciones"] == 2


@pytest.fixture
def targets(spark):
    return spark.createDataFrame([
        (101, "2025/01", Decimal("120.00"), Decimal("100.00"), Decimal("20.00")),
        (101, "2025/02", Decimal("50.00"), Decimal("100.00"), Decimal("-50.00")),
        (102, "2025/01", Decimal("10.00"), None, None),
    ], "tienda_id int, anio_mes string, venta_total_real decimal(14,2), meta_venta decimal(12,2), variacion_pct decimal(10,2)")


def test_target_measures_and_missing_target(star, targets):
    star = star | {"real_vs_presupuesto": targets}
    got = reports.all_target_measures(star).first()
    assert got["venta_real_mensual"] == 180 and got["meta_venta"] == 200
    assert got["cumplimiento_pct"] == Decimal("0.9") and got["variacion_pct"] == Decimal("-0.1")
    assert got["meses_meta_cumplida"] == 2  # the month without a target counts here
    assert jobs.target_summary(targets).first()["meses_que_cumplen"] == 1  # and not here
    assert reports.target_kpis(star, region=["Perú"]).first()["meses_meta_cumplida"] == 1


def test_target_table_band(star, targets):
    got = {(r["nombre_tienda_display"], r["anio_mes"]): r["banda"] for r in reports.target_table(star | {"real_vs_presupuesto": targets}).collect()}
    assert got == {("Lima (101)", "2025/01"): "favorable", ("Lima (101)", "2025/02"): "desfavorable", ("Quito (102)", "2025/01"): None}


@pytest.fixture
def stock(spark):
    return spark.createDataFrame([
        (1, 20250101, "A", 5, False), (1, 20250201, "A", 7, False), (1, 20250201, "B", 0, True), (2, 20250101, "A", 3, False),
    ], "tienda_key int, fecha_key int, categoria string, cantidad_disponible int, sin_stock boolean")


def test_closing_stock_uses_each_groups_own_last_period(stock, rows):
    assert rows(m.closing_stock(stock, keys=["tienda_key"])) == [(1, 7), (2, 3)]
    assert rows(m.closing_stock(stock)) == [(7,)]
    assert rows(last_period_sum(stock, ["categoria"], "fecha_key", "cantidad_disponible")) == [("A", 7), ("B", 0)]


def test_last_period_of_the_whole_table(stock, rows):
    assert rows(last_period(stock, "fecha_key", ["tienda_key"], "cantidad_disponible")) == [(1, 7)]


def test_stock_reports(star, stock, rows):
    star = star | {"FactInventario": stock}
    assert rows(reports.closing_stock_by_month(star)) == [(1, "Enero", 8), (2, "Febrero", 7)]
    assert rows(reports.stock_outs(star)) == [("B", "Lima (101)", 2, "Febrero", 1)]
    assert rows(reports.stock_pivot(star, ["A", "B"])) == [("Lima (101)", 7, 0), ("Quito (102)", 3, None)]
    assert tuple(reports.stock_kpis(star).first()) == (7, 1)
    assert tuple(reports.stock_kpis(star, region=["Chile"]).first()) == (3, None)
