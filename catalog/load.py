"""The whole load on the given tables: delimited files, raw, typed and star layers.

The seven source files are written from the given tables to a new folder in shared storage, with
the usual dirt but without what the fatal checks of the load refuse, and the jobs take them
through all layers. Files are ingested one after the other, and go when their raw table is there. Schemas and folders are named per load, so loads that run side by side don't meet.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from shelfstar.plans import jobs
from shelfstar.session import ensure_checkpoint_dir, shuffles_released
from shelfstar.sources.delimited import MANIFEST, Entry, ingest, invalid_lines
from shelfstar.sources.events import parse_events, read_event_lines, read_events_batch
from shelfstar.sources.tables import PREFIX, ROOT, measured, remove_folder, write_bronze
from shelfstar.streaming import incremental, refine

from . import roles

_INHERITED = ("spark.sql.session.timeZone", "spark.sql.shuffle.partitions", "spark.sql.ansi.enabled")
_LOADS: dict[tuple[str, str], str] = {}


def stores(spark: SparkSession, sf: str) -> DataFrame:
    day = F.col("fecha_apertura")
    return roles.raw_stores(spark, sf).withColumn("fecha_apertura", F.when(day == "2021/02/30", "2021/02/28").otherwise(day))


def months(spark: SparkSession, sf: str) -> DataFrame:
    """Months with sales."""
    return roles.table(spark, sf, "lineitem").select(F.date_format("l_shipdate", "yyyy/MM").alias("anio_mes")).distinct()


def _every_month(keys: DataFrame, spark: SparkSession, sf: str) -> DataFrame:
    """Each key with every month; the months are one array, as there are some twelve a year."""
    listed = [r["anio_mes"] for r in months(spark, sf).collect()]
    return keys.withColumn("anio_mes", F.explode(F.array(*map(F.lit, sorted(listed)))))


def budget(spark: SparkSession, sf: str) -> DataFrame:
    """The targets of every store and month with sales, from what the store shipped a year before; a small one where it shipped nothing."""
    stores_ = roles.table(spark, sf, "supplier").selectExpr("cast(s_suppkey as string) as tienda_id")
    known = roles.raw_budget(spark, sf).select("tienda_id", F.trim("anio_mes").alias("anio_mes"), "meta_venta", "meta_margen")
    return _every_month(stores_, spark, sf).join(known, ["tienda_id", "anio_mes"], "left").selectExpr(
        "tienda_id", "concat(anio_mes, ' ') as anio_mes", "coalesce(meta_venta, '1000.50') as meta_venta", "coalesce(meta_margen, '230.12') as meta_margen")


def inventory(spark: SparkSession, sf: str) -> DataFrame:
    """Stock of every category that a store with shelves has ever sold, in every month with sales; nothing where it sold nothing."""
    known = roles.raw_inventory(spark, sf)
    kinds = known.select("tienda_id", "categoria").distinct()
    return _every_month(kinds, spark, sf).join(known, ["tienda_id", "categoria", "anio_mes"], "left").selectExpr(
        "tienda_id", "categoria", "anio_mes", "coalesce(cantidad_disponible, '0') as cantidad_disponible")


SOURCES = {
    "tiendas": stores, "productos": roles.raw_products, "empleados": roles.raw_employees, "clientes": roles.raw_customers,
    "presupuesto_metas": budget, "ventas_transacciones": roles.raw_sales, "inventario_snapshot": inventory,
}


def _session(spark: SparkSession) -> tuple[SparkSession, str, str]:
    """A session whose tables have names and a shared folder of their own; the name prefix; the folder."""
    ensure_checkpoint_dir(spark)
    prefix = f"load_{uuid.uuid4().hex}_"
    folder = f"{spark.sparkContext.getCheckpointDir()}/{prefix}"
    own = spark.newSession()
    for setting in _INHERITED:
        own.conf.set(setting, spark.conf.get(setting))
    own.conf.set(PREFIX, prefix)
    own.conf.set(ROOT, f"{folder}/tables")
    return own, prefix, folder


def load(spark: SparkSession, sf: str) -> str:
    """Runs the load once per application and folder of given tables; returns the prefix of its schemas."""
    key = spark.sparkContext.applicationId, sf
    if key not in _LOADS:
        own, prefix, folder = _session(spark)
        with shuffles_released(own):
            for name, build in SOURCES.items():
                writer = build(own, sf).write.option("sep", "|").option("header", True).option("quoteAll", True).option("compression", "snappy")
                writer.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(f"{folder}/raw/{name}.csv")
                jobs.bronze(own, f"{folder}/raw", [entry for entry in MANIFEST if entry.tabla == name])
                remove_folder(own, f"{folder}/raw/{name}.csv")
            jobs.run_layers(own, months(own, sf).count())
        _LOADS[key] = prefix
    return _LOADS[key]


def loaded(spark: SparkSession, sf: str, table: str) -> DataFrame:
    """A table of the load, as published."""
    return spark.table(f"{load(spark, sf)}{table}")


def rebuilt_events(spark: SparkSession, sf: str) -> DataFrame:
    """Raw events to a raw table, and the refined table rebuilt from it twice."""
    own, prefix, folder = _session(spark)
    roles.raw_events(spark, sf).write.json(f"{folder}/raw")
    write_bronze(read_events_batch(own, f"{folder}/raw"), "bronze.ventas_tiempo_real")
    jobs.rebuild_events(own)
    jobs.rebuild_events(own)
    return spark.table(f"{prefix}silver.ventas_tiempo_real")


_STREAMS: dict[tuple[str, str], dict[str, DataFrame]] = {}


def streamed_events(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    """Events in four groups that arrive one after the other, published batch by batch, once per application and folder. The last
    group has discounts that no control lets pass, so its batches are set aside."""
    key = spark.sparkContext.applicationId, sf
    if key not in _STREAMS:
        own, prefix, folder = _session(spark)
        events = roles.raw_events(spark, sf)
        wrong = events.filter("descuento_pct = 90").withColumn("descuento_pct", F.col("descuento_pct") + 60)
        for group in (*(events.filter(F.col("tienda_id") % 3 == k) for k in range(3)), wrong):
            group.write.mode("append").option("compression", "gzip").json(f"{folder}/in")
            refined = refine.refine_events(parse_events(read_event_lines(own, f"{folder}/in")))
            letters = refine.append_parquet(f"{folder}/cartas")
            incremental.publish_stream(refined, f"{folder}/checkpoint", letters=letters).awaitTermination()
        _STREAMS[key] = {
            "eventos": spark.table(f"{prefix}silver.{incremental.LIVE}").drop(incremental.BATCH),
            "apartados": spark.table(f"{prefix}silver.{incremental.ASIDE}").drop(incremental.BATCH),
            "anomalias": spark.table(f"{prefix}silver.{incremental.BY_STORE}"),
        }
    return _STREAMS[key]


_LINES: dict[tuple[str, str], tuple[SparkSession, list[Entry]]] = {}


def _ingested(spark: SparkSession, sf: str) -> tuple[SparkSession, list[Entry]]:
    """Sales files with lines that don't fit, ingested once per application and folder."""
    key = spark.sparkContext.applicationId, sf
    if key not in _LINES:
        own, _, folder = _session(spark)
        roles.sale_files(spark, sf, f"{folder}/ventas.csv")
        entries = [Entry("ventas.csv", "ventas", columnas=tuple(roles.raw_sales(spark, sf).columns))]
        ingest(own, folder, entries)
        _LINES[key] = own, entries
    return _LINES[key]


def ingested_lines(spark: SparkSession, sf: str) -> DataFrame:
    own, entries = _ingested(spark, sf)
    return invalid_lines(own, entries).withColumn("archivo", F.regexp_extract("archivo", "([^/]+/[^/]+)/[^/]+$", 1))


def line_counts(spark: SparkSession, sf: str) -> DataFrame:
    """What was observed against what readers of the table see."""
    own, _ = _ingested(spark, sf)
    told = measured(own, "bronze.ventas")
    seen = own.table(f"{own.conf.get(PREFIX)}bronze.ventas").agg(F.count(F.lit(1)).alias("visibles"))
    return seen.select(F.lit(int(told["lineas"])).cast("bigint").alias("lineas"), F.lit(int(told["lineas_invalidas"])).cast("bigint").alias("invalidas"), "visibles")
