from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from shelfstar.functions import text
from shelfstar.operators import aggregates, quality
from shelfstar.operators.contracts import TABLES, conform, contract, contract_check


def report(df):
    return {r["control"]: (r["valor"], r["cumple"]) for r in df.collect()}


@pytest.fixture
def stores(spark):
    return spark.createDataFrame(
        [("101", " Lima", "2020/01/01"), ("102", "Lima", "2021/02/30"), ("102", "Lima", None), ("x", None, "2020-1-1")],
        "id string, nombre string, fecha string")


def test_validar(stores):
    got = report(quality.validar(stores, ["id"], ["nombre", "fecha"], {"raro": F.col("id") == "x"}))
    assert got == {"filas": (4, True), "duplicados": (1, False), "nulos_nombre": (1, False), "nulos_fecha": (1, False), "raro": (1, False)}


def test_validar_of_an_empty_table(stores):
    got = report(quality.validar(stores.limit(0), ["id"], ["nombre"]))
    assert got == {"filas": (0, True), "duplicados": (0, True), "nulos_nombre": (0, True)}


def test_format_ignores_null_and_conversion_finds_impossible_dates(stores):
    assert report(quality.formats(stores, {"id": text.DIGITS, "fecha": text.DATE})) == {"id": (1, False), "fecha": (1, False)}
    typed = stores.select("id", "fecha", F.try_to_date("fecha", "yyyy/MM/dd").alias("dia"), F.col("id").try_cast("int").alias("n"))
    got = report(quality.failed_conversions(typed, [("fecha", "dia"), ("id", "n")]))
    assert got == {"fecha": (2, False), "id": (1, False), "filas_fallidas": (2, False)}


def test_require_names_the_failed_controls(stores):
    with pytest.raises(quality.QualityError, match="duplicados = 1"):
        quality.require(quality.validar(stores, ["id"], []))
    quality.require(quality.validar(stores, ["id", "fecha"], ["id"]))


def test_domain_counts_null_as_outside(spark, rows):
    df = spark.createDataFrame([("a",), ("b",), ("b",), (None,)], "x string")
    assert rows(quality.domain(df, "x", ["a"])) == [("b", 2), (None, 1)]
    assert report(quality.rules(df, quality.domain_rules({"x": ["a"]}))) == {"fuera_de_dominio_x": (3, False)}


def test_complete(spark, rows):
    df = spark.createDataFrame([(1, m) for m in range(12)] + [(2, 1), (2, 1), (2, None)], "t int, m int")
    assert rows(quality.complete(df, ["t"], "m")) == [(2, 1)]
    assert report(quality.complete_check(df, ["t"], "m")) == {"grupos": (2, True), "incompletos": (1, False)}


def test_references_inform_or_fail(spark):
    fact = spark.createDataFrame([(1,), (9,), (9,), (None,)], "k int")
    dim = spark.createDataFrame([(1,)], "k int")
    assert report(quality.references(fact, [("k", dim, "k")])) == {"huerfanas_k": (2, True)}
    assert report(quality.references(fact, [("k", dim, "k")], fatal=True)) == {"huerfanas_k": (2, False)}


def test_calendar_gap_and_unused_date(spark):
    calendar = spark.createDataFrame([(date(2025, 1, 1),), (date(2025, 1, 3),)], "fecha date")
    uses = spark.createDataFrame([(date(2025, 1, 2),), (date(2025, 1, 3),)], "d date")
    assert report(quality.calendar_complete(calendar, {"u": (uses, "d")})) == {"dias_faltantes": (1, False), "fechas_fuera_u": (1, False)}


def test_reconcile_amount_is_exact(spark):
    a = spark.createDataFrame([(Decimal("0.10"),)] * 3, "x decimal(12,2)")
    b = spark.createDataFrame([(Decimal("0.30"),)], "x decimal(12,2)")
    assert quality.reconcile_amount(a, b, "x").first()["cumple"]
    assert not quality.reconcile_amount(a, b.union(b), "x").first()["cumple"]
    assert tuple(quality.same_rows(a, b).first()) == (3, 1, False)


def test_profile(spark, stores):
    got = {r["columna"]: tuple(r)[1:] for r in quality.profile(stores.withColumn("_audit", F.lit(1))).collect()}
    assert got == {"id": (0, 0, 3), "nombre": (1, 1, 2), "fecha": (1, 0, 3)}


def test_value_counts(stores, rows):
    assert rows(quality.value_counts(stores, ["nombre"])) == [("nombre", " Lima", 1), ("nombre", "Lima", 2), ("nombre", None, 1)]


def test_repeated_names(spark, rows):
    df = spark.createDataFrame([("L", 2, "b"), ("L", 1, "a"), ("M", 3, "c")], "n string, i int, f string")
    assert rows(quality.repeated_names(df, "n", ["i", "f"])) == [("L", 2, 1, "a"), ("L", 2, 2, "b")]


def test_rows_of_a_large_group_do_not_depend_on_partitions(spark, rows):
    df = spark.range(0, 6000).selectExpr("if(id < 5000, 'hot', cast(id as string)) as k", "id as v")
    got = [rows(aggregates.rows_per(df.repartition(n), "k", ["v"])) for n in (2, 7)]
    assert got[0] == got[1] == sorted((("hot", 5000, i) for i in range(5000)), key=repr)


def test_contracts(spark):
    assert len(TABLES) == 10
    df = spark.createDataFrame([("a@b", "Perú", 1), (None, "Perú", 2)], "usuario_email string, region string, extra int")
    assert conform(df, "SeguridadRegion").columns == ["usuario_email", "region"]
    assert report(contract_check(df, "SeguridadRegion"))["nulos_usuario_email"] == (1, False)
    assert contract("FactVentas")["venta_total"].dataType.simpleString() == "decimal(12,2)"
    wide = spark.createDataFrame([(1, 2, Decimal("123456789012.00"), 3, 4)], "tienda_key int, fecha_key int, venta_total decimal(20,2), unidades bigint, cantidad_transacciones bigint")
    assert report(contract_check(wide, "ventas_diarias_por_tienda"))["no_convierte_venta_total"] == (0, True)


def test_repeated_ids(spark, rows):
    assert rows(quality.repeated_ids(spark.createDataFrame([("a",), ("a",), ("b",)], "e string"), "e")) == [("a", 2)]
