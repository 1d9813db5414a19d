import random

import pytest
from pyspark.sql import Window, functions as F

from shelfstar.operators.dimensions import dim_cliente, dim_empleado, dim_producto, dim_tienda
from shelfstar.operators.keys import surrogate_key


def expected(df, natural):
    return df.withColumn("k", F.row_number().over(Window.orderBy(natural)))


@pytest.mark.parametrize("kind", ["int", "string", "bigint"])
def test_dense_numbering_equals_one_ordered_window(spark, rows, kind):
    rng = random.Random(3)
    values = rng.sample(range(-(1 << 31), 1 << 31), 3000) + list(range(70000, 70400)) + [-1, 0, 1]
    values = sorted(set(values), key=lambda v: rng.random())
    df = spark.createDataFrame([(v,) for v in values], "v bigint").select(F.col("v").cast(kind).alias("v"))
    assert rows(surrogate_key(df, "k", "v")) == rows(expected(df, "v"))


@pytest.mark.parametrize("kind", ["int", "string"])
def test_missing_natural_key_comes_first(spark, rows, kind):
    df = spark.createDataFrame([(5,), (None,), (-70000,)], "v int").select(F.col("v").cast(kind).alias("v"))
    got = dict(rows(surrogate_key(df, "k", "v"), "v", "k"))
    assert got[None] == 1 and sorted(got.values()) == [1, 2, 3]


def test_empty_table(spark):
    for kind in ("int", "string"):
        assert surrogate_key(spark.createDataFrame([], f"v {kind}"), "k", "v").count() == 0


def test_known_keys(spark):
    stores = spark.range(101, 130).selectExpr(
        "cast(id as int) as tienda_id", "'x' as nombre_tienda", "'c' as ciudad", "'p' as pais", "'r' as region",
        "'f' as formato_tienda", "date'2020-01-01' as fecha_apertura")
    products = spark.range(1001, 1186).selectExpr(
        "concat('SKU-', id) as sku", "'n' as nombre_producto", "'c' as categoria", "'s' as subcategoria", "'m' as marca",
        "cast(1 as decimal(10,2)) as costo_unitario")
    employees = spark.range(5001, 5146).selectExpr(
        "cast(id as int) as empleado_id", "'n' as nombre_completo", "101 as tienda_id", "'p' as puesto",
        "date'2020-01-01' as fecha_ingreso", "cast(1 as decimal(10,2)) as salario", "'d' as documento_identidad")
    assert dim_tienda(stores).filter("tienda_id = 109").first()["tienda_key"] == 9
    assert dim_producto(products).filter("sku = 'SKU-1108'").first()["producto_key"] == 108
    assert dim_empleado(employees).filter("empleado_id = 5040").first()["empleado_key"] == 40


def test_unknown_customer_member(spark):
    customers = spark.createDataFrame(
        [(7, "Ana", None, "Oro", "Lima")],
        "cliente_id int, nombre_completo string, fecha_registro date, tier_lealtad string, ciudad string")
    got = {r["cliente_key"]: tuple(r) for r in dim_cliente(customers).collect()}
    assert got[-1] == (-1, -1, "Cliente No Identificado", None, "Sin Tier", "N/A")
    assert got[1][1] == 7


def test_equal_and_missing_text_keys_fall_into_several_pieces(spark, rows):
    df = spark.createDataFrame([("a" if i % 2 else None, i) for i in range(4000)], "v string, x int")
    got = surrogate_key(df, "k", "v").collect()
    assert sorted(r["k"] for r in got) == list(range(1, 4001))
    assert all((r["v"] is None) == (r["k"] <= 2000) for r in got)
    from shelfstar.operators import keys
    sizes = [r["count"] for r in keys._range_pieces(df, "v").groupBy("_pieza").count().collect()]
    assert len(sizes) > 4 and max(sizes) < 2000


def test_no_numbering_in_one_task(spark):
    small = spark.range(10).select(F.col("id").cast("int").alias("v"), F.col("id").cast("string").alias("s"))
    for natural in ("v", "s"):
        plan = surrogate_key(small, "k", natural)._jdf.queryExecution().executedPlan().toString()
        assert all("row_number" not in line or "_pieza" in line for line in plan.splitlines() if "Window [" in line)
