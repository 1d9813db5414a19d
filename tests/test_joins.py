import pytest
from pyspark.sql import functions as F

from shelfstar.operators import joins


@pytest.fixture(scope="module")
def skewed(spark):
    """Two thirds of the rows on two keys, one of them NULL; some keys unknown."""
    return spark.range(0, 30000, 1, 12).selectExpr(
        "id",
        "cast(case id % 3 when 0 then 7 when 1 then null else id % 500 end as int) as k",
    )


@pytest.fixture(scope="module")
def dim(spark):
    return spark.range(450).selectExpr("cast(id as int) as k", "concat('v', id) as v", "if(id = 9, null, id) as w")


LIMITS = [{}, {"broadcast_bytes": 0, "hot_keys": 1}, {"broadcast_bytes": 0, "hot_keys": 3}, {"broadcast_bytes": 0, "hot_keys": 10000}]


@pytest.mark.parametrize("limits", LIMITS)
def test_lookup_is_a_left_join(rows, skewed, dim, limits):
    got = joins.lookup(skewed, dim, "k", ["v", "w"], **limits)
    assert rows(got, "id", "k", "v", "w") == rows(skewed.join(dim, "k", "left"), "id", "k", "v", "w")


def test_spread_lookup_leaves_no_hot_partition(spark, skewed, dim):
    got = joins.lookup(skewed, dim, "k", ["v"], broadcast_bytes=0, hot_keys=2)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        sizes = [r["n"] for r in got.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert sum(sizes) == 30000
    assert max(sizes) < 30000 / 3


@pytest.mark.parametrize("limits", LIMITS)
def test_semi(rows, skewed, dim, limits):
    allowed = dim.filter("k in (7, 9, 11)").union(dim.filter("k = 7"))
    got = joins.semi(skewed, allowed, "k", **limits)
    assert rows(got, "id", "k") == rows(skewed.join(allowed, "k", "left_semi"), "id", "k")


def test_lookups_in_a_chain_read_the_fact_once_for_their_frequent_keys(rows, skewed, dim, monkeypatch):
    second, calls, counted = dim.select("k", F.col("w").alias("z")), [], joins.frequent_keys
    monkeypatch.setattr(joins, "frequent_keys", lambda *args: calls.append(args) or counted(*args))
    got = joins.lookup_keys(skewed, [(dim, "k", ["v"]), (second, "k", ["z"])], broadcast_bytes=0, hot_keys=2)
    want = skewed.join(dim.select("k", "v"), "k", "left").join(second, "k", "left")
    assert rows(got, "id", "v", "z") == rows(want, "id", "v", "z") and len(calls) == 1


def test_frequent_keys_of_several_columns(spark):
    fact = spark.range(0, 40000, 1, 8).selectExpr(
        "cast(if(id % 4 = 0, 7, id) as int) as a", "if(id % 3 = 0, null, concat('x', id % 3)) as b", "id % 2 as c", "cast(null as int) as d")
    got = joins.frequent_keys(fact, ["a", "b", "c", "d"], 2)
    assert got["a"][0] == 7 and sorted(got["b"]) == ["x1", "x2"] and sorted(got["c"]) == [0, 1] and got["d"] == []
    assert joins.frequent_keys(fact.limit(0), ["a", "b"], 3) == {"a": [], "b": []}


def test_every_key_above_its_share_is_among_the_frequent(spark):
    fact = spark.range(0, 200000, 1, 16).selectExpr("cast(if(id % 10 < 3, id % 40, 1000 + id) as int) as k")
    got = joins.frequent_keys(fact, ["k"], 100)["k"]
    assert {r["k"] for r in fact.groupBy("k").count().filter("count > 2000").collect()} <= set(got)


@pytest.mark.parametrize("limits", LIMITS[:2])
def test_sentinel(spark, rows, limits):
    fact = spark.createDataFrame([(1, None), (2, 5), (3, 99)], "id int, c int")
    members = spark.createDataFrame([(-1, -1), (5, 1)], "c int, ck int")
    got = joins.lookup_with_sentinel(fact, members, "c", ["ck"], **limits)
    assert rows(got, "id", "c", "ck") == [(1, None, -1), (2, 5, 1), (3, 99, None)]


def test_orphans_ignore_null_and_orphan_keys_do_not(rows, skewed, dim):
    want = skewed.filter("k is not null and k >= 450").count()
    counted = joins.orphans(skewed, "k", dim, "k").first()
    assert counted["filas"] == want and counted["valores"] == skewed.filter("k >= 450").select("k").distinct().count()
    assert (None,) in rows(joins.orphan_keys(skewed, "k", dim, "k"))


def test_orphans_of_a_clean_fact(skewed, dim):
    assert tuple(joins.orphans(skewed.filter("k < 450"), "k", dim, "k").first()) == (0, 0)


def test_uncovered(spark, rows, dim):
    used = spark.createDataFrame([(i,) for i in range(445)] + [(None,)], "k int")
    assert rows(joins.uncovered(dim, used, "k"), "k") == [(445,), (446,), (447,), (448,), (449,)]


@pytest.mark.parametrize("n", [0, 1, 5000])
def test_a_fact_with_large_dimensions_is_keyed_in_slices(spark, rows, tmp_path, monkeypatch, n):
    from shelfstar.operators import facts

    sales = spark.range(0, n, 1, 5).selectExpr(
        "concat('T', id) as transaccion_id", "date'2025-01-01' as fecha_venta", "cast(id % 40 as int) as tienda_id", "cast(id % 7 as int) as empleado_id",
        "if(id % 11 = 0, null, concat('S', id % 90)) as sku", "cast(if(id % 3 = 0, null, id % 300) as int) as cliente_id", "cast(1 + id % 4 as int) as cantidad",
        "cast(id as decimal(10,2)) as precio_unitario", "0 as descuento_pct", "cast(id as decimal(12,2)) as venta_total")
    dims = {
        "tienda": spark.range(38).selectExpr("cast(id as int) as tienda_id", "cast(id + 1 as int) as tienda_key"),
        # a repeated product and a missing one
        "producto": spark.range(90).selectExpr("if(id = 89, null, concat('S', if(id = 88, 7, id))) as sku", "cast(id + 1 as int) as producto_key", "cast(id as decimal(10,2)) as costo_unitario"),
        "empleado": spark.range(7).selectExpr("cast(id as int) as empleado_id", "cast(id + 1 as int) as empleado_key"),
        "cliente": spark.range(-1, 280).selectExpr("cast(id as int) as cliente_id", "cast(id as int) as cliente_key"),
    }
    plain = facts.fact_sales(sales, dims)
    monkeypatch.setattr(joins, "SLICE_BYTES", 1)
    release = spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled")
    folder = tmp_path / "slices"
    sliced = facts.fact_sales(sales, dims, folder=str(folder), broadcast_bytes=0, hot_keys=3)
    assert sliced.dtypes == plain.dtypes and rows(sliced) == rows(plain)
    left = sorted(p.name for p in folder.iterdir() if not p.name.startswith("."))
    assert all(name.startswith("done") for name in left) and (len(left) > 3 or n < 2)
    assert "Join" not in sliced._jdf.queryExecution().executedPlan().toString()
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == release
