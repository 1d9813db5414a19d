"""The registered queries in plain SQL, written against the given tables.

Each statement names the shared subqueries it needs; ``oracle_sql`` puts them, with what they
need in turn, in front of it.
"""

from __future__ import annotations

import re

INITCAP = "array_to_string(list_transform(string_split(lower(trim({0}, ' ')), ' '), lambda w: upper(w[1]) || w[2:]), ' ')"
DAY = "try_strptime(trim({0}, ' '), '%Y/%m/%d')::date"
MONTH = "try_strptime(trim({0}, ' ') || '/01', '%Y/%m/%d')::date"
BLANK = "nullif(trim({0}, ' '), '')"


def _cents(quantity: str = "cantidad", price: str = "precio_unitario", pct: str = "descuento_pct") -> str:
    """Discounted amount as integer arithmetic: cents times percent, rounded half up."""
    hundredths = f"({quantity}::hugeint * ({price} * 100)::hugeint * (100 - {pct})::hugeint)"
    return f"((({hundredths} + 50) // 100)::decimal(18,0) / 100)::decimal(18,2)"


def _text(day: str) -> str:
    return f"strftime({day}, '%Y-%m-%d')"


def _key(day: str) -> str:
    return f"strftime({day}, '%Y%m%d')::int"


_CUSTOMER = """CASE o_custkey % 5 WHEN 0 THEN '' WHEN 1 THEN '  '
  ELSE (o_custkey + CASE WHEN o_custkey % 97 = 2 THEN 100000000 ELSE 0 END)::varchar END"""
_SKU = """CASE WHEN l_quantity = 13 THEN CASE l_linenumber % 3 WHEN 0 THEN '' WHEN 1 THEN '   ' END
  WHEN l_quantity = 37 AND l_tax = 0 THEN 'SKU-X' || l_partkey ELSE 'SKU-' || l_partkey END"""
_DISCOUNT = "CASE WHEN l_tax = 0.08 AND l_linenumber = 1 THEN 90 ELSE round(l_discount * 100)::int END"

MONTHS = "['Enero','Febrero','Marzo','Abril','Mayo','Junio','Julio','Agosto','Septiembre','Octubre','Noviembre','Diciembre']"
DAYS = "['Lunes','Martes','Miércoles','Jueves','Viernes','Sábado','Domingo']"

CTES = {
    # raw text tables
    "tiendas_raw": """SELECT s_suppkey::varchar AS tienda_id, 'Tienda ' || (s_nationkey % 5) || ' ' || (s_suppkey // 2) AS nombre_tienda,
        CASE WHEN s_nationkey >= 20 THEN 'N/A' ELSE 'NATION_' || s_nationkey END AS ciudad, 'NATION_' || s_nationkey AS pais,
        ['Argentina', 'México', 'Perú', 'Chile', 'Colombia'][s_nationkey % 5 + 1] AS region,
        CASE WHEN s_nationkey >= 20 THEN 'Online' WHEN s_suppkey % 2 = 0 THEN 'Express' ELSE 'Centro' END AS formato_tienda,
        CASE WHEN s_suppkey % 50 = 7 THEN '2021/02/30' ELSE '20' || lpad((s_suppkey % 20)::varchar, 2, '0') || '/' ||
          lpad((1 + s_suppkey % 12)::varchar, 2, '0') || '/' || lpad((1 + s_suppkey % 28)::varchar, 2, '0') END AS fecha_apertura FROM supplier""",
    "productos_raw": """SELECT 'SKU-' || p_partkey AS sku,
        CASE p_partkey % 3 WHEN 0 THEN '  ' || p_name WHEN 1 THEN p_name || ' ' ELSE p_name END AS nombre_producto,
        CASE p_partkey % 3 WHEN 0 THEN p_type WHEN 1 THEN lower(p_type) ELSE ' ' || p_type END AS categoria,
        'Talla ' || p_size AS subcategoria, p_brand AS marca, p_retailprice::decimal(10,2)::varchar AS costo_unitario FROM part""",
    "empleados_raw": """SELECT s_suppkey::varchar AS empleado_id, s_name AS nombre_completo, s_suppkey::varchar AS tienda_id,
        CASE s_suppkey % 3 WHEN 0 THEN 'Vendedor' WHEN 1 THEN 'Cajero' ELSE 'Gerente' END AS puesto,
        '20' || lpad((s_suppkey % 24)::varchar, 2, '0') || '/' || lpad((1 + s_suppkey % 12)::varchar, 2, '0') || '/15' AS fecha_ingreso,
        s_acctbal::decimal(10,2)::varchar AS salario,
        CASE WHEN s_suppkey % 10 = 0 THEN ' A1 ' ELSE ' ' || lpad((s_suppkey * 7919 % 100000000)::varchar, 8, '0') || ' ' END
          AS documento_identidad FROM supplier""",
    "clientes_raw": """SELECT c_custkey::varchar AS cliente_id, c_name AS nombre_completo,
        '20' || lpad((c_custkey % 24)::varchar, 2, '0') || '/' || lpad((1 + c_custkey % 12)::varchar, 2, '0') || '/01' AS fecha_registro,
        CASE c_mktsegment WHEN 'FURNITURE' THEN '' WHEN 'HOUSEHOLD' THEN '   ' WHEN 'MACHINERY' THEN NULL
          ELSE ' ' || c_mktsegment END AS tier_lealtad, 'NATION_' || c_nationkey AS ciudad FROM customer""",
    "presupuesto_raw": """SELECT l_suppkey::varchar AS tienda_id, strftime(l_shipdate + INTERVAL 1 YEAR, '%Y/%m') || ' ' AS anio_mes,
        (sum(l_extendedprice::decimal(12,2)) * 36)::decimal(14,2)::varchar AS meta_venta,
        (sum(l_extendedprice::decimal(12,2)) * 36 * 0.23)::decimal(14,2)::varchar AS meta_margen
        FROM lineitem GROUP BY l_suppkey, strftime(l_shipdate + INTERVAL 1 YEAR, '%Y/%m')""",
    "ventas_una_vez": f"""SELECT 'T-' || l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey || '-' || l_quantity::int AS transaccion_id,
        strftime(l_shipdate, '%Y/%m/%d') AS fecha,
        lpad((l_orderkey % 24)::varchar, 2, '0') || ':' || lpad((l_partkey % 60)::varchar, 2, '0') || ':' || lpad((l_suppkey % 60)::varchar, 2, '0') AS hora,
        l_suppkey::varchar AS tienda_id, l_suppkey::varchar AS empleado_id, {_CUSTOMER} AS cliente_id, {_SKU} AS sku,
        l_quantity::int::varchar AS cantidad,
        CASE WHEN l_orderkey % 2 = 0 THEN replace(l_extendedprice::decimal(10,2)::varchar, '.', ',') ELSE l_extendedprice::decimal(10,2)::varchar END AS precio_unitario,
        CASE WHEN l_linenumber = 3 AND l_returnflag = 'N' THEN ' ' ELSE ({_DISCOUNT})::varchar END AS descuento_pct,
        CASE l_returnflag WHEN 'A' THEN CASE l_linenumber % 3 WHEN 0 THEN 'TARJETA' WHEN 1 THEN 'tarjeta' ELSE ' Tarjeta' END
          WHEN 'N' THEN CASE l_linenumber % 3 WHEN 0 THEN 'EFECTIVO' WHEN 1 THEN 'efectivo' ELSE 'Efectivo ' END
          ELSE CASE WHEN l_linenumber % 2 = 0 THEN 'billetera digital' ELSE 'BILLETERA DIGITAL' END END AS medio_pago,
        l_discount = 0 AND l_tax = 0 AS repetida
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "ventas_raw": """SELECT * EXCLUDE (repetida) FROM ventas_una_vez UNION ALL
        SELECT * EXCLUDE (repetida) FROM ventas_una_vez WHERE repetida""",
    "inventario_raw": """SELECT l_suppkey::varchar AS tienda_id, CASE WHEN l_suppkey % 2 = 0 THEN lower(p_type) ELSE p_type || ' ' END AS categoria,
        strftime(l_shipdate, '%Y/%m') AS anio_mes, (sum(l_quantity::bigint) % 41)::varchar AS cantidad_disponible
        FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey WHERE s_nationkey < 20
        GROUP BY l_suppkey, p_type, strftime(l_shipdate, '%Y/%m')""",
    "envios": "SELECT 1 AS envio UNION ALL SELECT 2",
    "eventos_raw": """SELECT ' EVT-' || (100000 + (user_id * 1000 + (props->>'$.k')::int) % 900000) AS evento_id, ts AS momento,
        user_id AS tienda_id, user_id AS empleado_id, 'SKU-' || (event_id % 185) AS sku, 1 + (props->>'$.k')::int % 5 AS cantidad,
        value AS precio_unitario, CASE WHEN (props->>'$.k')::int >= 95 THEN 90 ELSE ((props->>'$.k')::int % 5) * 5 END AS descuento_pct,
        ts + to_seconds((props->>'$.k')::int + envio) AS llegada
        FROM events JOIN envios ON envio = 1 OR event_type = 'error'""",
    "cartas": """SELECT CASE event_id % 50 WHEN 3 THEN '{"evento_id": "EVT-' || event_id || '", "cantidad": ' WHEN 7 THEN '{"evento_id": "EVT-' || event_id || '"}'
        ELSE '{"evento_id": "EVT-' || event_id || '", "cantidad": "muchas"}' END AS registro,
        CASE event_id % 50 WHEN 7 THEN 'falta timestamp_evento' ELSE 'no se puede leer' END AS motivo FROM events WHERE event_id % 50 IN (3, 7, 11)""",
    "mapa": "SELECT DISTINCT 'gerente' || (tienda_id::int // 2) || '@example.com' AS usuario_email, region FROM tiendas_raw",
    # typed tables
    "tiendas": f"""SELECT tienda_id::int AS tienda_id, nombre_tienda, ciudad, pais, region, formato_tienda,
        {DAY.format('fecha_apertura')} AS fecha_apertura FROM tiendas_raw""",
    "productos": f"""SELECT sku, trim(nombre_producto, ' ') AS nombre_producto, {INITCAP.format('categoria')} AS categoria, subcategoria, marca,
        costo_unitario::decimal(10,2) AS costo_unitario FROM productos_raw""",
    "empleados": f"""SELECT empleado_id::int AS empleado_id, nombre_completo, tienda_id::int AS tienda_id, puesto,
        {DAY.format('fecha_ingreso')} AS fecha_ingreso, salario::decimal(10,2) AS salario,
        trim(documento_identidad, ' ') AS documento_identidad FROM empleados_raw""",
    "clientes": f"""SELECT cliente_id::int AS cliente_id, nombre_completo, {DAY.format('fecha_registro')} AS fecha_registro,
        coalesce({BLANK.format('tier_lealtad')}, 'Sin Tier') AS tier_lealtad, ciudad FROM clientes_raw""",
    "presupuesto": f"""SELECT tienda_id::int AS tienda_id, {MONTH.format('anio_mes')} AS anio_mes,
        try_cast(meta_venta AS decimal(12,2)) AS meta_venta, try_cast(meta_margen AS decimal(12,2)) AS meta_margen FROM presupuesto_raw""",
    "ventas_limpias": f"""SELECT trim(transaccion_id, ' ') AS transaccion_id, {DAY.format('fecha')} AS fecha_venta, trim(hora, ' ') AS hora_venta,
        try_strptime(fecha || ' ' || hora, '%Y/%m/%d %H:%M:%S') AS fecha_hora_venta, tienda_id::int AS tienda_id, empleado_id::int AS empleado_id,
        {BLANK.format('cliente_id')}::int AS cliente_id, trim(sku, ' ') AS sku, cantidad::int AS cantidad,
        replace(trim(precio_unitario, ' '), ',', '.')::decimal(10,2) AS precio_unitario,
        coalesce({BLANK.format('descuento_pct')}::int, 0) AS descuento_pct, {INITCAP.format('medio_pago')} AS medio_pago
        FROM (SELECT DISTINCT * FROM ventas_raw) WHERE {BLANK.format('sku')} IS NOT NULL""",
    "ventas": f"SELECT *, {_cents()} AS venta_total FROM ventas_limpias",
    "inventario": f"""SELECT tienda_id::int AS tienda_id, {INITCAP.format('categoria')} AS categoria, {MONTH.format('anio_mes')} AS anio_mes,
        cantidad_disponible::int AS cantidad_disponible, cantidad_disponible::int = 0 AS sin_stock FROM inventario_raw""",
    "eventos_unicos": """SELECT DISTINCT trim(evento_id, ' ') AS evento_id, momento AS timestamp_evento, tienda_id::int AS tienda_id,
        empleado_id::int AS empleado_id, sku, cantidad::int AS cantidad, precio_unitario::decimal(10,2) AS precio_unitario,
        descuento_pct::int AS descuento_pct FROM eventos_raw""",
    "eventos": f"SELECT *, {_cents()} AS venta_total, descuento_pct >= 50 AS es_anomalia FROM eventos_unicos",
    # what the load is given: targets and stock of every month with sales, opening days that exist
    "meses": "SELECT DISTINCT strftime(l_shipdate, '%Y/%m') AS anio_mes FROM lineitem",
    "un_anio_antes": """SELECT l_suppkey AS tienda, strftime(l_shipdate + INTERVAL 1 YEAR, '%Y/%m') AS anio_mes, sum(l_extendedprice::decimal(12,2)) * 36 AS meta
        FROM lineitem GROUP BY ALL""",
    "metas_carga": """SELECT s_suppkey::int AS tienda_id, (replace(anio_mes, '/', '-') || '-01')::date AS anio_mes, coalesce(meta, 1000.5)::decimal(14,2)::decimal(12,2) AS meta_venta,
        coalesce((meta * 0.23)::decimal(14,2), 230.12)::decimal(12,2) AS meta_margen
        FROM supplier CROSS JOIN meses LEFT JOIN (SELECT tienda AS s_suppkey, anio_mes, meta FROM un_anio_antes) USING (s_suppkey, anio_mes)""",
    "vendido": """SELECT l_suppkey, p_type, strftime(l_shipdate, '%Y/%m') AS anio_mes, sum(l_quantity::bigint) AS q
        FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey WHERE s_nationkey < 20 GROUP BY ALL""",
    "stock_carga": f"""SELECT l_suppkey::int AS tienda_id, {INITCAP.format('p_type')} AS categoria, (replace(anio_mes, '/', '') || '01')::int AS fecha_key,
        (coalesce(q, 0) % 41)::int AS cantidad_disponible, coalesce(q, 0) % 41 = 0 AS sin_stock
        FROM (SELECT DISTINCT l_suppkey, p_type FROM vendido) CROSS JOIN meses LEFT JOIN vendido USING (l_suppkey, p_type, anio_mes)""",
    # star schema
    "dim_fecha": f"""SELECT {_key('fecha')} AS fecha_key, fecha, year(fecha)::int AS anio, month(fecha)::int AS mes, quarter(fecha)::int AS trimestre,
        ({MONTHS})[month(fecha)] AS nombre_mes, strftime(fecha, '%Y/%m') AS anio_mes, ({DAYS})[isodow(fecha)] AS dia_semana,
        isodow(fecha)::int AS dia_semana_num, isodow(fecha) >= 6 AS es_fin_de_semana
        FROM (SELECT unnest(generate_series(make_date(min(year(fecha_venta)), 1, 1)::timestamp, make_date(max(year(fecha_venta)), 12, 31)::timestamp,
          INTERVAL 1 DAY))::date AS fecha FROM ventas)""",
    "dim_tienda": """SELECT row_number() OVER (ORDER BY tienda_id)::int AS tienda_key, tienda_id, nombre_tienda,
        nombre_tienda || ' (' || tienda_id || ')' AS nombre_tienda_display, ciudad, pais, region, formato_tienda, fecha_apertura FROM tiendas""",
    "dim_producto": "SELECT row_number() OVER (ORDER BY sku)::int AS producto_key, * FROM productos",
    "dim_empleado": "SELECT row_number() OVER (ORDER BY empleado_id)::int AS empleado_key, * FROM empleados",
    "dim_cliente": """SELECT row_number() OVER (ORDER BY cliente_id)::int AS cliente_key, * FROM clientes UNION ALL
        SELECT -1, -1, 'Cliente No Identificado', NULL, 'Sin Tier', 'N/A'""",
    "fact_ventas": f"""SELECT v.transaccion_id, {_key('v.fecha_venta')} AS fecha_key, t.tienda_key, p.producto_key, e.empleado_key,
        coalesce(c.cliente_key, -1) AS cliente_key, v.cantidad, v.precio_unitario, v.descuento_pct, v.venta_total,
        (v.cantidad * p.costo_unitario)::decimal(12,2) AS costo_total,
        t.tienda_key IS NULL OR p.producto_key IS NULL OR e.empleado_key IS NULL OR c.cliente_key IS NULL AS requiere_revision
        FROM ventas v LEFT JOIN dim_tienda t ON v.tienda_id = t.tienda_id LEFT JOIN dim_producto p ON v.sku = p.sku
        LEFT JOIN dim_empleado e ON v.empleado_id = e.empleado_id LEFT JOIN dim_cliente c ON coalesce(v.cliente_id, -1) = c.cliente_id""",
    "fact_inventario": f"""SELECT t.tienda_key, {_key('i.anio_mes')} AS fecha_key, i.categoria, i.cantidad_disponible, i.sin_stock
        FROM inventario i LEFT JOIN dim_tienda t ON i.tienda_id = t.tienda_id""",
    "ventas_mes": """SELECT t.tienda_id, f.anio_mes, sum(v.venta_total)::decimal(14,2) AS venta_total_real FROM fact_ventas v
        JOIN dim_fecha f ON v.fecha_key = f.fecha_key JOIN dim_tienda t ON v.tienda_key = t.tienda_key GROUP BY ALL""",
    "metas": """SELECT m.tienda_id, m.anio_mes, m.venta_total_real, p.meta_venta,
        round((m.venta_total_real - p.meta_venta)::double / p.meta_venta::double * 100, 2) AS variacion_pct FROM ventas_mes m
        LEFT JOIN presupuesto p ON m.tienda_id = p.tienda_id AND m.anio_mes = strftime(p.anio_mes, '%Y/%m')""",
    "diarias": """SELECT tienda_key, fecha_key, sum(venta_total) AS venta_total, sum(cantidad)::int AS unidades, count(*)::int AS cantidad_transacciones
        FROM fact_ventas GROUP BY ALL""",
    "metas_tienda": "SELECT m.*, t.nombre_tienda_display, t.region FROM metas m LEFT JOIN dim_tienda t ON m.tienda_id = t.tienda_id",
    "stock": """SELECT i.*, t.nombre_tienda_display, t.region, f.mes, f.nombre_mes FROM fact_inventario i
        LEFT JOIN dim_tienda t ON i.tienda_key = t.tienda_key LEFT JOIN dim_fecha f ON i.fecha_key = f.fecha_key""",
    "venta_estrella": """SELECT v.*, t.region, t.formato_tienda, p.categoria, f.mes, f.nombre_mes FROM fact_ventas v
        LEFT JOIN dim_tienda t ON v.tienda_key = t.tienda_key LEFT JOIN dim_producto p ON v.producto_key = p.producto_key
        LEFT JOIN dim_fecha f ON v.fecha_key = f.fecha_key""",
    "enmascarados": """SELECT * EXCLUDE (salario) REPLACE (CASE WHEN length(documento_identidad) > 4
        THEN left(documento_identidad, 2) || 'XXXX' || right(documento_identidad, 2) WHEN documento_identidad IS NOT NULL THEN 'XXXX' END
        AS documento_identidad) FROM dim_empleado""",
}

VALUE = "round(({0})::double, 6)"


def _v(expr: str, name: str | None = None) -> str:
    """Decimals are compared as doubles."""
    return f"{VALUE.format(expr)} AS {name or expr}"


def _control(name: str, value: str, passes: str, source: str) -> str:
    return f"SELECT '{name}' AS control, ({value})::bigint AS valor, ({passes.format(value)}) AS cumple FROM {source}"


def _zero(name: str, value: str, source: str) -> str:
    return _control(name, value, "({0}) = 0", source)


def _nulls(source: str, *cols: str) -> list[str]:
    return [_zero(f"nulos_{c}", f"count(*) FILTER ({c} IS NULL)", source) for c in cols]


def _union(*parts: str) -> str:
    return "\nUNION ALL ".join(parts)


def _keyed(source: str, *keys: str) -> list[str]:
    groups = f"(SELECT count(*) AS n FROM {source} GROUP BY {', '.join(keys)})"
    return [
        _control("filas", "count(*)", "true", source),
        _zero("duplicados", "coalesce(sum(n - 1), 0)", groups),
    ]


def _broken(source: str, patterns: dict[str, str]) -> str:
    return _union(*(
        _zero(c, f"count(*) FILTER (NOT regexp_matches(trim({c}, ' '), '{p}'))", source) for c, p in patterns.items()
    ))


def _orphan(source: str, col: str, dim: str) -> str:
    found = f"(SELECT 1 FROM {source} x WHERE x.{col} IS NOT NULL AND NOT EXISTS (SELECT 1 FROM {dim} d WHERE d.{col} = x.{col}))"
    return _control(f"huerfanas_{col}", "count(*)", "true", found)


_SALES_COLUMNS = f"""transaccion_id, {_text('fecha_venta')} AS fecha_venta, hora_venta,
    strftime(fecha_hora_venta, '%Y-%m-%d %H:%M:%S.%f') AS fecha_hora_venta, tienda_id, empleado_id, cliente_id, sku, cantidad,
    {_v('precio_unitario')}, descuento_pct, medio_pago, {_v('venta_total')}"""
_FACT_COLUMNS = f"""transaccion_id, fecha_key, tienda_key, producto_key, empleado_key, cliente_key, cantidad, {_v('precio_unitario')},
    descuento_pct, {_v('venta_total')}, {_v('costo_total')}, requiere_revision"""
_EVENT_COLUMNS = f"""evento_id, strftime(timestamp_evento, '%Y-%m-%d %H:%M:%S.%f') AS timestamp_evento, tienda_id, empleado_id, sku, cantidad,
    {_v('precio_unitario')}, descuento_pct, {_v('venta_total')}"""
_STORE_COLUMNS = f"tienda_key, tienda_id, nombre_tienda, nombre_tienda_display, ciudad, pais, region, formato_tienda, {_text('fecha_apertura')} AS fecha_apertura"
# Rounds the shortest decimal text of the double, which is what the JVM rounds.
_EVENT_DOUBLE = """round(((cantidad * precio_unitario)::double * (1 - descuento_pct / 100.0::double))::varchar::decimal(38,18), 2) AS venta_total"""
_SALES_REQUIRED = (
    "transaccion_id", "fecha_venta", "hora_venta", "fecha_hora_venta", "tienda_id", "empleado_id", "sku",
    "cantidad", "precio_unitario", "descuento_pct", "medio_pago", "venta_total",
)
_RAW_CELLS = ("transaccion_id", "fecha", "hora", "tienda_id", "empleado_id", "cliente_id", "sku", "cantidad", "precio_unitario", "descuento_pct")
_CLOCK = "^([01][0-9]|2[0-3]):[0-5][0-9]:[0-5][0-9]$"
_LAST_STOCK = "max_by(s, fecha_key)::bigint"


def _closing(groups: str, where: str = "true") -> str:
    by = f"{groups}, " if groups else ""
    tail = f" GROUP BY {groups}" if groups else ""
    per = f"SELECT {by}fecha_key, sum(cantidad_disponible) AS s FROM stock WHERE {where} GROUP BY {by}fecha_key"
    return f"SELECT {by}{_LAST_STOCK} AS stock_cierre FROM ({per}){tail}"


STATEMENTS = {
    "clean_store": f"SELECT * REPLACE ({_text('fecha_apertura')} AS fecha_apertura) FROM tiendas",
    "clean_product": f"SELECT * REPLACE ({VALUE.format('costo_unitario')} AS costo_unitario) FROM productos",
    "clean_employee": f"SELECT * REPLACE ({_text('fecha_ingreso')} AS fecha_ingreso, {VALUE.format('salario')} AS salario) FROM empleados",
    "clean_customer": f"SELECT * REPLACE ({_text('fecha_registro')} AS fecha_registro) FROM clientes",
    "clean_sales": f"SELECT {_SALES_COLUMNS} FROM ventas",
    "clean_budget": f"SELECT tienda_id, {_text('anio_mes')} AS anio_mes, {_v('meta_venta')}, {_v('meta_margen')} FROM presupuesto",
    "clean_inventory": f"SELECT * REPLACE ({_text('anio_mes')} AS anio_mes) FROM inventario",
    "clean_events": f"SELECT {_EVENT_COLUMNS}, es_anomalia FROM eventos",
    "clean_events_double": f"SELECT {_EVENT_COLUMNS}, es_anomalia FROM (SELECT * REPLACE ({_EVENT_DOUBLE}) FROM eventos)",
    "before_after_store": f"""SELECT tienda_id AS tienda_id_texto, tienda_id::int AS tienda_id_valor, fecha_apertura AS fecha_apertura_texto,
        {_text(DAY.format('fecha_apertura'))} AS fecha_apertura_valor FROM tiendas_raw""",
    "before_after_sales": f"""SELECT v.transaccion_id, r.precio_unitario AS precio_unitario_original, r.descuento_pct AS descuento_pct_original,
        r.medio_pago AS medio_pago_original, {_v('v.precio_unitario', 'precio_unitario')}, v.descuento_pct, v.medio_pago, {_v('v.venta_total', 'venta_total')}
        FROM (SELECT DISTINCT * FROM ventas_raw) r JOIN ventas v ON r.transaccion_id = v.transaccion_id
        WHERE {BLANK.format('r.sku')} IS NOT NULL AND (contains(r.precio_unitario, ',') OR {BLANK.format('r.descuento_pct')} IS NULL)""",
    "dedup_exact": "SELECT DISTINCT * FROM ventas_raw",
    "duplicate_report": "SELECT *, count(*) AS veces_repetida FROM ventas_raw GROUP BY ALL HAVING count(*) > 1",
    "split_rejected": f"""SELECT DISTINCT *, 'SKU vacío: producto no identificable' AS motivo_rechazo FROM ventas_raw
        WHERE {BLANK.format('sku')} IS NULL""",
    "reconcile_rows": f"""SELECT *, filas_origen = duplicados + validas + rechazadas AS cierra FROM (
        SELECT (SELECT count(*) FROM ventas_raw) AS filas_origen, (SELECT count(*) FROM ventas_raw) - count(*) AS duplicados,
        count(*) FILTER ({BLANK.format('sku')} IS NOT NULL) AS validas, count(*) FILTER ({BLANK.format('sku')} IS NULL) AS rechazadas
        FROM (SELECT DISTINCT * FROM ventas_raw))""",
    "sales_checks": _union(
        *_keyed("ventas", "transaccion_id"), *_nulls("ventas", *_SALES_REQUIRED),
        _zero("fuera_de_dominio_medio_pago",
              "count(*) FILTER (medio_pago IS NULL OR medio_pago NOT IN ('Tarjeta', 'Efectivo', 'Billetera Digital'))", "ventas"),
        _zero("hora_venta", f"count(*) FILTER (NOT regexp_matches(hora_venta, '{_CLOCK}'))", "ventas")),
    "validate_store": _union(*_keyed("tiendas", "tienda_id"), *_nulls("tiendas", "tienda_id", "nombre_tienda", "fecha_apertura")),
    "validate_budget": _union(
        *_keyed("presupuesto", "tienda_id", "anio_mes"), *_nulls("presupuesto", "tienda_id", "anio_mes", "meta_venta", "meta_margen"),
        _zero("metas_fuera_de_regla", "count(*) FILTER (meta_venta <= 0 OR meta_margen <= 0 OR meta_margen >= meta_venta)", "presupuesto")),
    "validate_dimension": _union(
        _control("filas", "count(*)", "true", "dim_cliente"),
        _zero("duplicados_cliente_key", "count(*) - count(DISTINCT cliente_key)", "dim_cliente"),
        _zero("duplicados_cliente_id", "count(*) - count(DISTINCT cliente_id)", "dim_cliente"),
        _zero("nulos_cliente_key", "count(*) FILTER (cliente_key IS NULL)", "dim_cliente"),
        _control("miembro_cliente_key", "count(*) FILTER (cliente_key = -1)", "({0}) = 1", "dim_cliente")),
    "unique_display_name": _union(
        _zero("repetidos_nombre_tienda_display", "count(*) - count(DISTINCT nombre_tienda_display)", "dim_tienda"),
        _zero("repetidos_nombre_tienda", "count(*) - count(DISTINCT nombre_tienda)", "dim_tienda")),
    "format_check": _union(
        _broken("tiendas_raw", {"tienda_id": "^[0-9]+$", "fecha_apertura": "^[0-9]{4}/[0-9]{2}/[0-9]{2}$"}),
        _broken("clientes_raw", {"tier_lealtad": "^[A-Z]+$"}),
        _broken("ventas_raw", {"hora": _CLOCK, "precio_unitario": r"^[0-9]+(\.[0-9]+)?$", "sku": "^SKU-[0-9]+$"})),
    "failed_conversions": _union(
        _zero("tienda_id_texto", "count(*) FILTER (tienda_id IS NOT NULL AND try_cast(tienda_id AS int) IS NULL)", "tiendas_raw"),
        _zero("fecha_apertura_texto", f"count(*) FILTER (fecha_apertura IS NOT NULL AND {DAY.format('fecha_apertura')} IS NULL)", "tiendas_raw"),
        _zero("filas_fallidas", f"""count(*) FILTER ((tienda_id IS NOT NULL AND try_cast(tienda_id AS int) IS NULL)
            OR (fecha_apertura IS NOT NULL AND {DAY.format('fecha_apertura')} IS NULL))""", "tiendas_raw")),
    "domain_check": f"""SELECT medio_pago, count(*) AS filas FROM ventas_raw
        WHERE medio_pago NOT IN ('Tarjeta', 'Efectivo', 'Billetera Digital') GROUP BY ALL""",
    "sales_references": _union(
        _orphan("ventas", "tienda_id", "tiendas"), _orphan("ventas", "empleado_id", "empleados"),
        _orphan("ventas", "sku", "productos"), _orphan("ventas", "cliente_id", "clientes")),
    "orphan_keys": "SELECT DISTINCT sku FROM ventas v WHERE NOT EXISTS (SELECT 1 FROM productos p WHERE p.sku = v.sku)",
    "completeness": """SELECT tienda_id, categoria, count(DISTINCT anio_mes) AS valores FROM inventario GROUP BY ALL 
        HAVING count(DISTINCT anio_mes) <> (SELECT count(DISTINCT anio_mes) FROM inventario)""",
    "completeness_check": _union(
        _control("grupos", "count(*)", "true", "(SELECT count(DISTINCT anio_mes) AS n FROM presupuesto GROUP BY tienda_id)"),
        _zero("incompletos", "count(*) FILTER (n <> (SELECT count(DISTINCT anio_mes) FROM presupuesto))", "(SELECT count(DISTINCT anio_mes) AS n FROM presupuesto GROUP BY tienda_id)")),
    "inventory_checks": _union(
        *_keyed("inventario", "tienda_id", "categoria", "anio_mes"),
        *_nulls("inventario", "tienda_id", "categoria", "anio_mes", "cantidad_disponible"),
        _zero("stock_negativo", "count(*) FILTER (cantidad_disponible < 0)", "inventario"),
        _zero("claves_sin_dimension_categoria", "count(DISTINCT categoria) FILTER (categoria NOT IN (SELECT categoria FROM productos))", "inventario")),
    "event_checks": _union(
        *_nulls("eventos", "evento_id", "timestamp_evento", "tienda_id", "empleado_id", "sku", "cantidad", "precio_unitario", "descuento_pct", "venta_total"),
        _zero("anomalia_incoherente", "count(*) FILTER (es_anomalia <> (descuento_pct >= 50))", "eventos"),
        _zero("total_negativo", "count(*) FILTER (venta_total < 0)", "eventos"),
        _zero("descuento_fuera_de_rango", "count(*) FILTER (descuento_pct NOT BETWEEN 0 AND 100)", "eventos")),
    "calendar_check": _union(
        _zero("dias_faltantes", "date_diff('day', min(fecha), max(fecha)) + 1 - count(*)", "dim_fecha"),
        _zero("fechas_fuera_ventas", "count(DISTINCT fecha_venta) FILTER (fecha_venta NOT IN (SELECT fecha FROM dim_fecha))", "ventas"),
        _zero("fechas_fuera_presupuesto", "count(DISTINCT anio_mes) FILTER (anio_mes NOT IN (SELECT fecha FROM dim_fecha))", "presupuesto"),
        _zero("fechas_fuera_inventario", "count(DISTINCT anio_mes) FILTER (anio_mes NOT IN (SELECT fecha FROM dim_fecha))", "inventario")),
    "contract_check": _union(
        *_nulls("fact_ventas", "cliente_key", "requiere_revision"),
        *(_zero(f"no_convierte_{c}", f"count(*) FILTER ({c} IS NOT NULL AND try_cast({c} AS {t}) IS NULL)", "fact_ventas") for c, t in {
            "transaccion_id": "varchar", "fecha_key": "int", "tienda_key": "int", "producto_key": "int", "empleado_key": "int",
            "cliente_key": "int", "cantidad": "int", "precio_unitario": "decimal(10,2)", "descuento_pct": "int",
            "venta_total": "decimal(12,2)", "costo_total": "decimal(12,2)", "requiere_revision": "boolean"}.items())),
    "reconcile_amount": f"""SELECT {_v('a', 'izquierda')}, {_v('b', 'derecha')}, a = b AS cumple
        FROM (SELECT (SELECT sum(venta_total) FROM ventas) AS a, (SELECT sum(venta_total) FROM fact_ventas) AS b)""",
    "same_rows": """SELECT *, izquierda = derecha AS cumple
        FROM (SELECT (SELECT count(*) FROM ventas) AS izquierda, (SELECT count(*) FROM fact_ventas) AS derecha)""",
    "contract_breaks": _union(
        _zero("nulos_cliente_key", "count(*) FILTER (cliente_key IS NULL OR cantidad = 23)", "fact_ventas"), *_nulls("fact_ventas", "requiere_revision"),
        *(_zero(f"no_convierte_{c}", "0", "(SELECT 1)") for c in (
            "transaccion_id", "fecha_key", "tienda_key", "producto_key", "empleado_key", "cliente_key", "cantidad", "precio_unitario", "descuento_pct", "venta_total")),
        _zero("no_convierte_costo_total", "count(*) FILTER (cantidad = 17 AND costo_total * 1000000000 >= 9999999999.995)", "fact_ventas"),
        _zero("no_convierte_requiere_revision", "0", "(SELECT 1)")),
    "reconcile_amount_breaks": f"""SELECT {_v('a', 'izquierda')}, {_v('b', 'derecha')}, a = b AS cumple
        FROM (SELECT (SELECT sum(venta_total) FROM ventas) AS a, (SELECT sum(venta_total) FROM fact_ventas WHERE cantidad <> 17) AS b)""",
    "same_rows_breaks": """SELECT *, izquierda = derecha AS cumple
        FROM (SELECT (SELECT count(*) FROM ventas) AS izquierda, (SELECT count(*) FROM fact_ventas WHERE cantidad <> 17) AS derecha)""",
    "sales_references_fatal": "SELECT control, valor, valor = 0 AS cumple FROM (" + _union(
        _orphan("ventas", "sku", "productos"), _orphan("ventas", "cliente_id", "clientes"), _orphan("ventas", "tienda_id", "tiendas")) + ")",
    "verify_rows": _union(
        _control("ventas_transacciones", "count(*)", "true", "ventas_raw"), _control("ventas_enriquecidas", "count(*)", "true", "ventas"),
        _control("DimTienda", "count(*)", "true", "tiendas_raw"), _control("DimCliente", "count(*) + 1", "true", "clientes_raw")),
    "profile_columns": _union(*(
        f"""SELECT '{c}' AS columna, (count(*) FILTER ({BLANK.format(c)} IS NULL))::bigint AS nulos_o_vacios,
        (count(*) FILTER ({c} <> trim({c}, ' ')))::bigint AS con_espacios, count(DISTINCT {c}) AS valores_distintos FROM ventas_raw"""
        for c in ("transaccion_id", "fecha", "hora", "tienda_id", "empleado_id", "cliente_id", "sku", "cantidad",
                  "precio_unitario", "descuento_pct", "medio_pago"))),
    "value_distribution": _union(*(
        f"SELECT '{c}' AS columna, {c} AS valor, count(*) AS n FROM ventas_raw GROUP BY {c}" for c in ("medio_pago", "tienda_id", "descuento_pct"))),
    "repeated_names": """SELECT nombre_tienda, count(*) OVER por_nombre AS cantidad, tienda_id, fecha_apertura FROM tiendas_raw
        WHERE nombre_tienda IS NOT NULL WINDOW por_nombre AS (PARTITION BY nombre_tienda) QUALIFY count(*) OVER por_nombre > 1""",
    "coverage": """SELECT tienda_id, nombre_tienda, formato_tienda FROM tiendas t
        WHERE NOT EXISTS (SELECT 1 FROM inventario i WHERE i.tienda_id = t.tienda_id)""",
    "repeated_event_ids": "SELECT evento_id, count(*) AS count FROM eventos GROUP BY evento_id HAVING count(*) > 1",
    "top_repeated_event_ids": """SELECT evento_id, count(*) AS count FROM eventos GROUP BY evento_id HAVING count(*) > 1
        ORDER BY count(*) DESC, evento_id LIMIT 10""",
    # star schema
    "dim_calendar": f"SELECT * REPLACE ({_text('fecha')} AS fecha) FROM dim_fecha",
    "dim_store": f"SELECT {_STORE_COLUMNS} FROM dim_tienda",
    "dim_product": f"SELECT * REPLACE ({VALUE.format('costo_unitario')} AS costo_unitario) FROM dim_producto",
    "dim_employee": f"SELECT * REPLACE ({_text('fecha_ingreso')} AS fecha_ingreso, {VALUE.format('salario')} AS salario) FROM dim_empleado",
    "dim_customer": f"SELECT * REPLACE ({_text('fecha_registro')} AS fecha_registro) FROM dim_cliente",
    "surrogate_key_pieces": "SELECT o_orderkey::int AS pedido_id, row_number() OVER (ORDER BY o_orderkey)::int AS pedido_key FROM orders",
    "surrogate_key_ranges": "SELECT sku, row_number() OVER (ORDER BY sku)::int AS producto_key FROM productos",
    "fact_sales": f"SELECT {_FACT_COLUMNS} FROM fact_ventas",
    "preview_fact": f"SELECT {_FACT_COLUMNS} FROM (SELECT * FROM fact_ventas ORDER BY fecha_key, transaccion_id LIMIT 10)",
    "fact_sales_spread": f"SELECT {_FACT_COLUMNS} FROM fact_ventas",
    "fact_sales_from_raw": f"SELECT {_FACT_COLUMNS} FROM fact_ventas",
    "fact_inventory": "SELECT * FROM fact_inventario",
    "daily_store": f"SELECT * REPLACE ({VALUE.format('venta_total')} AS venta_total) FROM diarias",
    "monthly_store": f"SELECT tienda_id, anio_mes, {_v('venta_total_real')} FROM ventas_mes",
    "actual_vs_target": f"SELECT tienda_id, anio_mes, {_v('venta_total_real')}, {_v('meta_venta')}, {_v('variacion_pct')} FROM metas",
    "target_summary": f"""SELECT count(*) FILTER (variacion_pct >= 0) AS meses_que_cumplen, count(*) FILTER (variacion_pct < 0) AS meses_que_no_cumplen,
        count(*) FILTER (meta_venta IS NULL) AS meses_sin_meta, {_v('min(variacion_pct)', 'peor_variacion')}, {_v('max(variacion_pct)', 'mejor_variacion')} FROM metas""",
    "closing_stock_by_category": """SELECT categoria, sum(cantidad_disponible)::bigint AS stock_cierre FROM inventario
        WHERE anio_mes = (SELECT max(anio_mes) FROM inventario) GROUP BY categoria""",
    "sales_summary": f"""SELECT {_v('sum(venta_total)', 'venta_total')}, sum(cantidad)::bigint AS unidades, {_text('min(fecha_venta)')} AS primera_venta,
        {_text('max(fecha_venta)')} AS ultima_venta, count(*) FILTER (cliente_id IS NULL) AS ventas_sin_cliente FROM ventas""",
    "budget_summary": f"""SELECT count(*) AS filas, count(DISTINCT tienda_id) AS tiendas, {_text('min(anio_mes)')} AS primer_mes,
        {_text('max(anio_mes)')} AS ultimo_mes, {_v('sum(meta_venta)', 'meta_venta_total')}, {_v('sum(meta_margen)', 'meta_margen_total')} FROM presupuesto""",
    "inventory_summary": """SELECT count(*) AS filas, count(DISTINCT tienda_id) AS tiendas, count(DISTINCT categoria) AS categorias,
        count(DISTINCT anio_mes) AS meses, count(*) FILTER (sin_stock) AS registros_sin_stock FROM inventario""",
    "payment_counts": "SELECT medio_pago, count(*) AS count FROM ventas GROUP BY medio_pago",
    "tier_counts": "SELECT tier_lealtad, count(*) AS count FROM clientes GROUP BY tier_lealtad",
    # measures and reports; a count of nothing is blank
    "sales_measures": f"""SELECT {_v('sum(venta_total)', 'venta_total')}, {_v('sum(costo_total)', 'costo_total')},
        {_v('sum(venta_total) - sum(costo_total)', 'margen_bruto')},
        {_v('(sum(venta_total) - sum(costo_total))::double / sum(venta_total)::double', 'margen_pct')}, sum(cantidad)::bigint AS unidades_vendidas,
        nullif(count(*), 0) AS transacciones, {_v('sum(venta_total)::double / count(*)', 'ticket_promedio')},
        nullif(count(*) FILTER (descuento_pct >= 50), 0) AS ventas_descuento_atipico,
        {_v('nullif(count(*) FILTER (cliente_key = -1), 0)::double / count(*)', 'pct_ventas_sin_cliente')} FROM fact_ventas""",
    "target_measures": f"""SELECT {_v('sum(venta_total_real)', 'venta_real_mensual')}, {_v('sum(meta_venta)', 'meta_venta')},
        {_v('sum(venta_total_real)::double / sum(meta_venta)::double', 'cumplimiento_pct')},
        {_v('(sum(venta_total_real) - sum(meta_venta))::double / sum(meta_venta)::double', 'variacion_pct')},
        nullif(count(*) FILTER (venta_total_real >= coalesce(meta_venta, 0)), 0) AS meses_meta_cumplida FROM metas""",
    "kpis": f"""SELECT {_v('sum(venta_total)', 'venta_total')}, nullif(count(*), 0) AS transacciones, {_v('sum(venta_total)::double / count(*)', 'ticket_promedio')},
        {_v('(sum(venta_total) - sum(costo_total))::double / sum(venta_total)::double', 'margen_pct')} FROM fact_ventas""",
    "kpis_sliced": f"""SELECT {_v('sum(venta_total)', 'venta_total')}, nullif(count(*), 0) AS transacciones, {_v('sum(venta_total)::double / count(*)', 'ticket_promedio')},
        {_v('(sum(venta_total) - sum(costo_total))::double / sum(venta_total)::double', 'margen_pct')} FROM venta_estrella
        WHERE region IN ('México', 'Perú') AND formato_tienda IN ('Express') AND nombre_mes IN ('Enero', 'Febrero')""",
    "sales_by_region": f"SELECT region, {_v('sum(venta_total)', 'venta_total')} FROM venta_estrella GROUP BY region",
    "sales_by_category": f"SELECT categoria, {_v('sum(venta_total)', 'venta_total')} FROM venta_estrella GROUP BY categoria",
    "sales_cost_by_month": f"""SELECT mes, nombre_mes, {_v('sum(venta_total)', 'venta_total')}, {_v('sum(costo_total)', 'costo_total')}
        FROM venta_estrella GROUP BY mes, nombre_mes""",
    "sales_by_weekday": f"""SELECT dia_semana_num, dia_semana, {_v('sum(venta_total)', 'venta_total')} FROM diarias d
        LEFT JOIN dim_fecha f ON d.fecha_key = f.fecha_key GROUP BY dia_semana_num, dia_semana""",
    "target_by_month": f"""SELECT anio_mes, {_v('sum(venta_total_real)', 'venta_real_mensual')}, {_v('sum(meta_venta)', 'meta_venta')} FROM metas GROUP BY anio_mes""",
    "target_table": f"""SELECT *, CASE WHEN variacion_pct >= 0 AND variacion_pct <= 1000 THEN 'favorable'
        WHEN variacion_pct >= -1000 AND variacion_pct < 0 THEN 'desfavorable' END AS banda FROM (
        SELECT nombre_tienda_display, anio_mes, {_v('sum(venta_total_real)', 'venta_real_mensual')}, {_v('sum(meta_venta)', 'meta_venta')},
        {_v('(sum(venta_total_real) - sum(meta_venta))::double / sum(meta_venta)::double', 'variacion_pct')}
        FROM metas_tienda GROUP BY nombre_tienda_display, anio_mes)""",
    "fulfilment_by_store": f"""SELECT nombre_tienda_display, {_v('sum(venta_total_real)::double / sum(meta_venta)::double', 'cumplimiento_pct')}
        FROM metas_tienda GROUP BY nombre_tienda_display""",
    "target_kpis": f"""SELECT {_v('sum(venta_total_real)', 'venta_real_mensual')}, {_v('sum(meta_venta)', 'meta_venta')},
        nullif(count(*) FILTER (venta_total_real >= coalesce(meta_venta, 0)), 0) AS meses_meta_cumplida FROM metas_tienda WHERE region IN ('Argentina')""",
    "closing_stock_by_month": _closing("mes, nombre_mes"),
    "stock_outs": """SELECT nombre_tienda_display, categoria, mes, nombre_mes, count(*) AS quiebres_de_stock FROM stock WHERE sin_stock GROUP BY ALL""",
    "stock_pivot": "SELECT nombre_tienda_display, " + ", ".join(
        f'max(stock_cierre) FILTER (categoria = \'{c}\') AS "{c}"' for c in ("Economy", "Large", "Medium", "Promo", "Small", "Standard")
    ) + f" FROM ({_closing('nombre_tienda_display, categoria')}) GROUP BY nombre_tienda_display",
    "stock_kpis": f"""SELECT ({_closing('', "region IN ('Chile', 'Colombia') AND categoria IN ('Promo', 'Small')")}) AS stock_cierre,
        (SELECT sum(CASE WHEN sin_stock THEN 1 END) FROM stock WHERE region IN ('Chile', 'Colombia') AND categoria IN ('Promo', 'Small'))::bigint AS quiebres_de_stock""",
    # security
    "secure_sales_by_region": f"SELECT region, {_v('sum(venta_total)', 'venta_total')} FROM venta_estrella WHERE region = 'México' GROUP BY region",
    "secure_sales_by_region_user": f"""SELECT region, {_v('sum(venta_total)', 'venta_total')} FROM venta_estrella
        WHERE region IN (SELECT region FROM mapa WHERE usuario_email = 'gerente1@example.com') GROUP BY region""",
    "secure_employees": "SELECT nombre_completo, puesto FROM dim_empleado",
    "secure_employees_hr": f"SELECT nombre_completo, puesto, {_v('salario')} FROM dim_empleado",
    "masked_employees": f"SELECT * REPLACE ({_text('fecha_ingreso')} AS fecha_ingreso) FROM enmascarados",
    "rls_static": f"""SELECT tienda_key, fecha_key, {_v('venta_total')}, unidades, cantidad_transacciones FROM diarias
        WHERE tienda_key IN (SELECT tienda_key FROM dim_tienda WHERE region = 'Perú')""",
    "rls_dynamic": f"""SELECT tienda_id, anio_mes, {_v('venta_total_real')}, {_v('meta_venta')}, {_v('variacion_pct')} FROM metas
        WHERE tienda_id IN (SELECT tienda_id FROM dim_tienda WHERE region IN (SELECT region FROM mapa WHERE usuario_email = 'gerente2@example.com'))""",
    "security_map_own_rows": "SELECT usuario_email, region FROM mapa WHERE usuario_email = 'gerente1@example.com'",
    "security_map_rows": """SELECT role, CASE role WHEN 'RRHH' THEN (SELECT count(*) FROM mapa)
        WHEN 'Gerente_Region' THEN (SELECT count(*) FROM mapa WHERE usuario_email = 'gerente1@example.com') ELSE 0 END AS filas
        FROM (SELECT unnest(['Default', 'RRHH', 'Gerente_Peru', 'Gerente_Region']) AS role)""",
    "sales_conversions": _union(
        _control("no_convierte_cliente_id", "count(*) FILTER (cantidad = '23')", "({0}) = 0", "ventas_raw"),
        _control("no_convierte_descuento_pct", "count(*) FILTER (cantidad = '17')", "({0}) = 0", "ventas_raw")),
    # events
    "dedup_events": """SELECT DISTINCT trim(evento_id, ' ') AS evento_id, strftime(momento, '%Y-%m-%dT%H:%M:%S.%f') || '+00:00' AS timestamp_evento, tienda_id,
        empleado_id, sku, cantidad::bigint AS cantidad, precio_unitario, descuento_pct::bigint AS descuento_pct FROM eventos_raw""",
    "events_stream": f"""SELECT {_EVENT_COLUMNS}, es_anomalia, unnest(['vivo', 'tabla']) AS destino, NULL AS registro, NULL AS motivo FROM eventos
        UNION ALL BY NAME SELECT 'cartas' AS destino, registro, motivo FROM cartas""",
    "events_incremental": f"SELECT {_EVENT_COLUMNS}, es_anomalia FROM eventos",
    "events_set_aside": f"""SELECT {_EVENT_COLUMNS}, es_anomalia, 'total_negativo, descuento_fuera_de_rango' AS controles FROM (SELECT * REPLACE (-{_cents(pct='(200 - descuento_pct)')} AS venta_total)
        FROM (SELECT * REPLACE (descuento_pct + 60 AS descuento_pct) FROM eventos WHERE descuento_pct = 90))""",
    "anomalies_by_store_live": "SELECT tienda_id, count(*) AS anomalias FROM eventos WHERE es_anomalia GROUP BY tienda_id",
    "letters_rebuilt": "SELECT motivo, count(*) AS registros FROM cartas GROUP BY motivo",
    "events_appended": """SELECT evento_id, strftime(momento, '%Y-%m-%dT%H:%M:%S.%f') || '+00:00' AS timestamp_evento, tienda_id, empleado_id, sku,
        cantidad, precio_unitario, descuento_pct FROM eventos_raw""",
    "events_rebuilt": f"SELECT {_EVENT_COLUMNS}, es_anomalia FROM eventos",
    "load_raw": _union(*(
        f"SELECT '{name}' AS tabla, count(*) AS filas, count(*) AS con_archivo, count(*) AS con_fecha FROM {source}"
        for name, source in (("tiendas", "tiendas_raw"), ("productos", "productos_raw"), ("empleados", "empleados_raw"), ("clientes", "clientes_raw"),
                             ("presupuesto_metas", "metas_carga"), ("ventas_transacciones", "ventas_raw"), ("inventario_snapshot", "stock_carga")))),
    "load_sales": f"SELECT {_SALES_COLUMNS} FROM ventas",
    "load_rejects": f"""SELECT DISTINCT * REPLACE (nullif(cliente_id, '') AS cliente_id, nullif(sku, '') AS sku),
        'SKU vacío: producto no identificable' AS motivo_rechazo FROM ventas_raw WHERE {BLANK.format('sku')} IS NULL""",
    "load_budget": f"SELECT tienda_id, {_text('anio_mes')} AS anio_mes, {_v('meta_venta')}, {_v('meta_margen')} FROM metas_carga",
    "load_store": f"SELECT * REPLACE (coalesce({_text('fecha_apertura')}, '2021-02-28') AS fecha_apertura) FROM dim_tienda",
    "load_customer": f"SELECT * REPLACE ({_text('fecha_registro')} AS fecha_registro) FROM dim_cliente",
    "load_calendar": f"SELECT * REPLACE ({_text('fecha')} AS fecha) FROM dim_fecha",
    "load_fact": f"SELECT {_FACT_COLUMNS} FROM fact_ventas",
    "load_daily": f"SELECT * REPLACE ({VALUE.format('venta_total')} AS venta_total) FROM diarias",
    "load_targets": f"""SELECT m.tienda_id, m.anio_mes, {_v('m.venta_total_real', 'venta_total_real')}, {_v('p.meta_venta', 'meta_venta')},
        round((m.venta_total_real - p.meta_venta)::double / p.meta_venta::double * 100, 2) AS variacion_pct FROM ventas_mes m
        LEFT JOIN metas_carga p ON m.tienda_id = p.tienda_id AND m.anio_mes = strftime(p.anio_mes, '%Y/%m')""",
    "load_stock": """SELECT t.tienda_key, s.fecha_key, s.categoria, s.cantidad_disponible, s.sin_stock FROM stock_carga s
        LEFT JOIN dim_tienda t ON s.tienda_id = t.tienda_id""",
    "anomaly_summary": f"""SELECT count(*) AS eventos, count(*) FILTER (es_anomalia) AS anomalias,
        round(100.0::double * (count(*) FILTER (es_anomalia))::double / count(*), 2) AS pct_anomalias, {_v('sum(venta_total)', 'venta_total')},
        strftime(min(timestamp_evento), '%Y-%m-%d %H:%M:%S.%f') AS primer_evento, strftime(max(timestamp_evento), '%Y-%m-%d %H:%M:%S.%f') AS ultimo_evento FROM eventos""",
    "latest_anomalies": f"""SELECT {_EVENT_COLUMNS} FROM (SELECT * FROM eventos WHERE es_anomalia ORDER BY eventos.timestamp_evento DESC,
        evento_id, tienda_id, empleado_id, sku, cantidad, precio_unitario, descuento_pct, venta_total LIMIT 20)""",
    "anomalies_by_store": "SELECT tienda_id, count(*) AS count FROM eventos WHERE es_anomalia GROUP BY tienda_id",
    "arrival_latency": """SELECT DISTINCT trim(evento_id, ' ') AS evento_id, strftime(momento, '%Y-%m-%d %H:%M:%S.%f') AS timestamp_evento, sku,
        strftime(llegada, '%Y-%m-%d %H:%M:%S.%f') AS _fecha_ingesta, date_diff('microsecond', momento, llegada) / 1e6 AS latencia_seg FROM eventos_raw""",
    # files
    "malformed_lines": _union(*(
        f"""SELECT 'ventas' AS tabla, 'ventas.csv/{where}' AS archivo, concat_ws('|', {', '.join(f"chr(34) || {c} || chr(34)" for c in cells)}) AS linea,
        '{why}' AS motivo FROM (SELECT *, 'a|b' AS nota FROM ventas_raw) WHERE cantidad = '{units}'"""
        for where, why, units, cells in (("sobra", "sobran columnas", 17, (*_RAW_CELLS, "medio_pago", "nota")), ("falta", "faltan columnas", 23, _RAW_CELLS)))),
    "line_control": """SELECT count(*) AS lineas, count(*) FILTER (cantidad IN ('17', '23')) AS invalidas,
        count(*) FILTER (cantidad NOT IN ('17', '23')) AS visibles FROM ventas_raw""",
    "delimited_round_trip": "SELECT * REPLACE (nullif(cliente_id, '') AS cliente_id, nullif(sku, '') AS sku) FROM ventas_raw",
}

_NAMES = re.compile(r"\b(" + "|".join(CTES) + r")\b")


def _needed(text: str) -> set[str]:
    found = set(_NAMES.findall(text))
    return found.union(*(_needed(CTES[name]) for name in found)) if found else found


def oracle_sql() -> dict[str, str]:
    out = {}
    for name, statement in STATEMENTS.items():
        needed = _needed(statement)
        ctes = ",\n".join(f"{cte} AS ({body})" for cte, body in CTES.items() if cte in needed)
        out[name] = f"WITH {ctes}\n{statement}" if ctes else statement
    return out
