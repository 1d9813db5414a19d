"""The given tables in the roles of a retail chain.

``raw_*`` functions give the text tables a raw layer would hold, with the usual dirt: padded and
mixed-case text, blank values, decimal commas, repeated rows, unknown ids. ``typed_sales`` gives
the same sale lines already clean, straight from the columns a report needs.
"""

from __future__ import annotations

from collections.abc import Collection

from pyspark.sql import DataFrame, SparkSession, functions as F

from shelfstar.functions.dates import fecha_a_key
from shelfstar.functions.money import cost_total, line_total
from shelfstar.functions.text import is_blank
from shelfstar.operators import clean, dedup, dimensions, facts
from shelfstar.operators.joins import SENTINEL, lookup, lookup_with_sentinel


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def raw_stores(spark: SparkSession, sf: str) -> DataFrame:
    """Suppliers as stores; the nation gives the region."""
    return table(spark, sf, "supplier").selectExpr(
        "cast(s_suppkey as string) as tienda_id",
        "concat('Tienda ', s_nationkey % 5, ' ', s_suppkey div 2) as nombre_tienda",
        "if(s_nationkey >= 20, 'N/A', concat('NATION_', s_nationkey)) as ciudad",
        "concat('NATION_', s_nationkey) as pais",
        """case s_nationkey % 5 when 0 then 'Argentina' when 1 then 'México' when 2 then 'Perú'
           when 3 then 'Chile' else 'Colombia' end as region""",
        "case when s_nationkey >= 20 then 'Online' when s_suppkey % 2 = 0 then 'Express' else 'Centro' end as formato_tienda",
        """case when s_suppkey % 50 = 7 then '2021/02/30' else concat('20', lpad(s_suppkey % 20, 2, '0'), '/',
           lpad(1 + s_suppkey % 12, 2, '0'), '/', lpad(1 + s_suppkey % 28, 2, '0')) end as fecha_apertura""",
    )


def raw_products(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "part").selectExpr(
        "concat('SKU-', p_partkey) as sku",
        "case p_partkey % 3 when 0 then concat('  ', p_name) when 1 then concat(p_name, ' ') else p_name end as nombre_producto",
        "case p_partkey % 3 when 0 then p_type when 1 then lower(p_type) else concat(' ', p_type) end as categoria",
        "concat('Talla ', p_size) as subcategoria",
        "p_brand as marca",
        "cast(cast(p_retailprice as decimal(10,2)) as string) as costo_unitario",
    )


def raw_employees(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "supplier").selectExpr(
        "cast(s_suppkey as string) as empleado_id",
        "s_name as nombre_completo",
        "cast(s_suppkey as string) as tienda_id",
        "case s_suppkey % 3 when 0 then 'Vendedor' when 1 then 'Cajero' else 'Gerente' end as puesto",
        "concat('20', lpad(s_suppkey % 24, 2, '0'), '/', lpad(1 + s_suppkey % 12, 2, '0'), '/15') as fecha_ingreso",
        "cast(cast(s_acctbal as decimal(10,2)) as string) as salario",
        """case when s_suppkey % 10 = 0 then ' A1 '
           else concat(' ', lpad(s_suppkey * 7919 % 100000000, 8, '0'), ' ') end as documento_identidad""",
    )


def raw_customers(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "customer").selectExpr(
        "cast(c_custkey as string) as cliente_id",
        "c_name as nombre_completo",
        "concat('20', lpad(c_custkey % 24, 2, '0'), '/', lpad(1 + c_custkey % 12, 2, '0'), '/01') as fecha_registro",
        """case c_mktsegment when 'FURNITURE' then '' when 'HOUSEHOLD' then '   '
           when 'MACHINERY' then cast(null as string) else concat(' ', c_mktsegment) end as tier_lealtad""",
        "concat('NATION_', c_nationkey) as ciudad",
    )


def raw_budget(spark: SparkSession, sf: str) -> DataFrame:
    """Monthly targets in proportion to what a store shipped a year before; months of its first year have none."""
    lines = table(spark, sf, "lineitem").selectExpr(
        "l_suppkey", "cast(l_extendedprice as decimal(12,2)) as valor", "date_format(add_months(l_shipdate, 12), 'yyyy/MM') as anio_mes"
    )
    sums = lines.groupBy("l_suppkey", "anio_mes").agg((F.sum("valor") * 36).alias("meta"))
    return sums.selectExpr(
        "cast(l_suppkey as string) as tienda_id",
        "concat(anio_mes, ' ') as anio_mes",
        "cast(cast(meta as decimal(14,2)) as string) as meta_venta",
        "cast(cast(meta * 0.23 as decimal(14,2)) as string) as meta_margen",
    )


_SKU = """case when l_quantity = 13 then case l_linenumber % 3 when 0 then '' when 1 then '   ' end
          when l_quantity = 37 and l_tax = 0 then concat('SKU-X', l_partkey) else concat('SKU-', l_partkey) end"""
_CUSTOMER = """case o_custkey % 5 when 0 then '' when 1 then '  '
               else cast(o_custkey + if(o_custkey % 97 = 2, 100000000, 0) as string) end"""
_DISCOUNT = "case when l_tax = 0.08 and l_linenumber = 1 then 90 else cast(l_discount * 100 + 0.5 as int) end"
_BLANK_DISCOUNT = "l_linenumber = 3 and l_returnflag = 'N'"
_PRICE = "cast(l_extendedprice as decimal(10,2))"
_TICKET = "concat_ws('-', 'T', l_orderkey, l_linenumber, l_partkey, l_suppkey, cast(l_quantity as int))"


def raw_sales(spark: SparkSession, sf: str) -> DataFrame:
    lines, orders = table(spark, sf, "lineitem"), table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    sales = lines.join(orders, lines.l_orderkey == orders.o_orderkey).selectExpr(
        f"{_TICKET} as transaccion_id",
        "replace(cast(cast(l_shipdate as date) as string), '-', '/') as fecha",
        "concat_ws(':', lpad(l_orderkey % 24, 2, '0'), lpad(l_partkey % 60, 2, '0'), lpad(l_suppkey % 60, 2, '0')) as hora",
        "cast(l_suppkey as string) as tienda_id",
        "cast(l_suppkey as string) as empleado_id",
        f"{_CUSTOMER} as cliente_id",
        f"{_SKU} as sku",
        "cast(cast(l_quantity as int) as string) as cantidad",
        f"replace(cast({_PRICE} as string), '.', if(l_orderkey % 2 = 0, ',', '.')) as precio_unitario",
        f"if({_BLANK_DISCOUNT}, ' ', cast({_DISCOUNT} as string)) as descuento_pct",
        """case l_returnflag
             when 'A' then case l_linenumber % 3 when 0 then 'TARJETA' when 1 then 'tarjeta' else ' Tarjeta' end
             when 'N' then case l_linenumber % 3 when 0 then 'EFECTIVO' when 1 then 'efectivo' else 'Efectivo ' end
             else if(l_linenumber % 2 = 0, 'billetera digital', 'BILLETERA DIGITAL') end as medio_pago""",
        "if(l_discount = 0 and l_tax = 0, 2, 1) as copias",
    )
    return sales.withColumn("copia", F.explode(F.sequence(F.lit(1), F.col("copias")))).drop("copias", "copia")


def raw_inventory(spark: SparkSession, sf: str) -> DataFrame:
    """Monthly stock by product category; online stores have no shelves."""
    shops = table(spark, sf, "supplier").filter("s_nationkey < 20").selectExpr("s_suppkey as tienda")
    lines = table(spark, sf, "lineitem").selectExpr(
        "l_suppkey as tienda", "l_partkey", "cast(l_quantity as bigint) as q", "date_format(l_shipdate, 'yyyy/MM') as anio_mes"
    )
    parts = table(spark, sf, "part").select("p_partkey", "p_type")
    stock = (
        lines.join(shops, "tienda", "left_semi")
        .join(parts, lines.l_partkey == parts.p_partkey)
        .groupBy("tienda", "p_type", "anio_mes").agg(F.sum("q").alias("q"))
    )
    return stock.selectExpr(
        "cast(tienda as string) as tienda_id",
        "if(tienda % 2 = 0, lower(p_type), concat(p_type, ' ')) as categoria",
        "anio_mes",
        "cast(q % 41 as string) as cantidad_disponible",
    )


def raw_events(spark: SparkSession, sf: str, with_arrival: bool = False) -> DataFrame:
    """Event records; error events are sent twice, the second time a second later."""
    events = table(spark, sf, "events").withColumn("k", F.get_json_object("props", "$.k").cast("int"))
    sends = events.withColumn("envio", F.expr("explode(sequence(1, if(event_type = 'error', 2, 1)))"))
    columns = [
        "concat(' EVT-', 100000 + (user_id * 1000 + k) % 900000) as evento_id",
        "concat(date_format(ts, \"yyyy-MM-dd'T'HH:mm:ss.SSSSSS\"), '+00:00') as timestamp_evento",
        "user_id as tienda_id",
        "user_id as empleado_id",
        "concat('SKU-', event_id % 185) as sku",
        "cast(1 + k % 5 as bigint) as cantidad",
        "value as precio_unitario",
        "cast(if(k >= 95, 90, (k % 5) * 5) as bigint) as descuento_pct",
    ]
    if with_arrival:
        columns.append("cast(ts as timestamp) + make_dt_interval(0, 0, 0, k + envio) as EventEnqueuedUtcTime")
    return sends.selectExpr(*columns)


def event_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Events as JSON lines, and among them lines that are none: cut off, of another type, without most columns."""
    good = raw_events(spark, sf).select(F.to_json(F.struct("*")).alias("value"))
    ids = table(spark, sf, "events").select("event_id")
    broken = ids.filter("event_id % 50 in (3, 7, 11)").selectExpr(
        """case event_id % 50 when 3 then concat('{"evento_id": "EVT-', event_id, '", "cantidad": ')
           when 7 then concat('{"evento_id": "EVT-', event_id, '"}')
           else concat('{"evento_id": "EVT-', event_id, '", "cantidad": "muchas"}') end as value""")
    return good.unionByName(broken)


def sale_files(spark: SparkSession, sf: str, folder: str) -> None:
    """Raw sales as delimited files; lines of 17 units have a cell too many, lines of 23 units one too few."""
    sales = raw_sales(spark, sf)
    parts = {
        "bien": sales.filter("cantidad not in ('17', '23')"), "sobra": sales.filter("cantidad = '17'").withColumn("nota", F.lit("a|b")),
        "falta": sales.filter("cantidad = '23'").drop("medio_pago"),
    }
    for name, rows in parts.items():
        writer = rows.write.option("sep", "|").option("header", True).option("quoteAll", True)
        writer.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(f"{folder}/{name}")


def security_map(spark: SparkSession, sf: str) -> DataFrame:
    """Each user manages two stores and may see their regions."""
    return raw_stores(spark, sf).selectExpr(
        "concat('gerente', cast(tienda_id as int) div 2, '@example.com') as usuario_email", "region"
    ).distinct()


def stores(spark: SparkSession, sf: str) -> DataFrame:
    return clean.clean_store(raw_stores(spark, sf))


def products(spark: SparkSession, sf: str) -> DataFrame:
    return clean.clean_product(raw_products(spark, sf))


def employees(spark: SparkSession, sf: str) -> DataFrame:
    return clean.clean_employee(raw_employees(spark, sf))


def customers(spark: SparkSession, sf: str) -> DataFrame:
    return clean.clean_customer(raw_customers(spark, sf))


def budget(spark: SparkSession, sf: str) -> DataFrame:
    return clean.clean_budget(raw_budget(spark, sf))


def inventory(spark: SparkSession, sf: str) -> DataFrame:
    return clean.clean_inventory(raw_inventory(spark, sf))


def typed_sales(spark: SparkSession, sf: str, with_customer: bool = False) -> DataFrame:
    """Clean sale lines, without the rejected ones. The customer id needs the orders, so they are joined on request only."""
    lines = table(spark, sf, "lineitem")
    columns = [
        f"{_TICKET} as transaccion_id",
        "cast(l_shipdate as date) as fecha_venta",
        "cast(l_suppkey as int) as tienda_id",
        "cast(l_suppkey as int) as empleado_id",
        f"{_SKU} as sku",
        "cast(l_quantity as int) as cantidad",
        f"{_PRICE} as precio_unitario",
        f"if({_BLANK_DISCOUNT}, 0, {_DISCOUNT}) as descuento_pct",
    ]
    if with_customer:
        orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey")
        lines = lines.join(orders, lines.l_orderkey == orders.o_orderkey)
        columns.append(f"cast(nullif(trim({_CUSTOMER}), '') as int) as cliente_id")
    typed, _ = dedup.split(lines.selectExpr(*columns), is_blank("sku"))
    return typed.withColumn("venta_total", line_total("cantidad", "precio_unitario", "descuento_pct"))


def months(df: DataFrame) -> int:
    """Months that a monthly table covers."""
    return df.agg(F.countDistinct("anio_mes")).first()[0]


def dims(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    return {
        "tienda": dimensions.dim_tienda(stores(spark, sf)),
        "producto": dimensions.dim_producto(products(spark, sf)),
        "empleado": dimensions.dim_empleado(employees(spark, sf)),
        "cliente": dimensions.dim_cliente(customers(spark, sf)),
    }


def calendar(spark: SparkSession, sf: str) -> DataFrame:
    return dimensions.dim_fecha(typed_sales(spark, sf))


def full_fact(spark: SparkSession, sf: str) -> DataFrame:
    return facts.fact_sales(typed_sales(spark, sf, with_customer=True), dims(spark, sf))


def sales_star(spark: SparkSession, sf: str, roles: Collection[str] = ("tienda",)) -> dict[str, DataFrame]:
    """Sales fact with the keys of the asked dimensions only, and those dimensions."""
    star = {}
    fact = typed_sales(spark, sf, with_customer="cliente" in roles).withColumn("fecha_key", fecha_a_key("fecha_venta"))
    if "tienda" in roles:
        star["DimTienda"] = dimensions.dim_tienda(stores(spark, sf))
        fact = lookup(fact, star["DimTienda"], "tienda_id", ["tienda_key"])
    if "producto" in roles:
        star["DimProducto"] = dimensions.dim_producto(products(spark, sf))
        fact = lookup(fact, star["DimProducto"], "sku", ["producto_key", "costo_unitario"])
        fact = fact.withColumn("costo_total", cost_total("cantidad", "costo_unitario"))
    if "cliente" in roles:
        star["DimCliente"] = dimensions.dim_cliente(customers(spark, sf))
        fact = lookup_with_sentinel(fact, star["DimCliente"], "cliente_id", ["cliente_key"])
        fact = fact.withColumn("cliente_key", F.coalesce("cliente_key", F.lit(SENTINEL)))
    if "fecha" in roles:
        star["DimFecha"] = calendar(spark, sf)
    if "empleado" in roles:
        star["DimEmpleado"] = dimensions.dim_empleado(employees(spark, sf))
    return star | {"FactVentas": fact}


def target_star(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    star = sales_star(spark, sf, ("tienda", "fecha"))
    by_month = facts.monthly(star["FactVentas"], star["DimFecha"], star["DimTienda"])
    return star | {"real_vs_presupuesto": facts.actual_vs_target(by_month, budget(spark, sf))}


def stock_star(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    store_dim = dimensions.dim_tienda(stores(spark, sf))
    return {
        "DimTienda": store_dim,
        "DimFecha": calendar(spark, sf),
        "FactInventario": facts.fact_inventory(inventory(spark, sf), store_dim),
    }


CATEGORIES = ("Economy", "Large", "Medium", "Promo", "Small", "Standard")
