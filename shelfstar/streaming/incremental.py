"""Refined events published batch by batch, each checked before it is seen.

A micro-batch is written to a folder of its own, held against the same controls as the rebuild, and then becomes a partition of
the published table by one statement of the catalog; a batch that fails a control becomes a partition of the table of
batches set aside, with what failed. A batch that is repeated after a stop is written again, to another folder, unless one
of the two tables has it already, so each batch is seen once. Folders that no table has are left overs of a stop and are
removed by the next batch.

The anomaly report by store is kept up in the same way: a batch's few counts are added to a small table, which
remembers the last batch it has.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming.query import StreamingQuery

from ..sources import tables
from .refine import Sink, event_checks, fan_out

LIVE, ASIDE, BY_STORE, BATCH = "ventas_en_vivo", "ventas_apartadas", "anomalias_en_vivo", "lote"


def _batches(spark: SparkSession, table: str) -> set[int]:
    if not spark.catalog.tableExists(table):
        return set()
    return {int(r["partition"].split("=")[1]) for r in spark.sql(f"SHOW PARTITIONS {table}").collect()}


def _folder(spark: SparkSession, table: str) -> str:
    return f"{tables.table_root(spark)}/{table.replace('.', '/')}"


def _remove_left_overs(spark: SparkSession, folder: str, batch: int) -> None:
    """Folders of earlier tries of this batch, which no table has."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/{batch}-*")
    for found in path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(path) or []:
        tables.remove_folder(spark, found.getPath().toString())


def _add_partition(rows: DataFrame, table: str, batch: int) -> None:
    """Write ``rows`` and let readers of ``table`` see them as its partition ``batch``."""
    spark = rows.sparkSession
    folder = _folder(spark, table)
    _remove_left_overs(spark, folder, batch)
    path = f"{folder}/{batch}-{uuid.uuid4().hex}"
    rows.write.parquet(path)
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({columns}, `{BATCH}` BIGINT) USING parquet PARTITIONED BY (`{BATCH}`) LOCATION '{folder}'")
    spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS PARTITION ({BATCH} = {batch}) LOCATION '{path}'")


def checked_sink(spark: SparkSession, live: str = LIVE, aside: str = ASIDE, by_store: str | None = BY_STORE) -> Sink:
    """Sink for ``fan_out``: publishes a batch of refined events in Silver, or sets it aside with the controls it failed."""
    schema = tables.named(spark, tables.SILVER)
    tables.ensure_schema(spark, schema)
    good, bad = f"{schema}.{live}", f"{schema}.{aside}"

    def publish(batch: DataFrame, batch_id: int) -> None:
        if batch_id not in _batches(spark, good) | _batches(spark, bad):
            failed = [r["control"] for r in event_checks(batch).collect() if not r["cumple"]]
            if failed:
                _add_partition(batch.withColumn("controles", F.lit(", ".join(failed))), bad, batch_id)
            else:
                _add_partition(batch, good, batch_id)
        if by_store is not None:
            add_anomalies(spark, good, batch_id, by_store)

    return publish


def add_anomalies(spark: SparkSession, live: str, batch_id: int, by_store: str = BY_STORE) -> None:
    """Adds a published batch's anomalies to the counts by store, once. The counts are a row a store, so they are merged whole."""
    name = f"{tables.SILVER}.{by_store}"
    known = tables.current_version(spark, name) is not None
    if known and int(tables.measured(spark, name)["ultimo_lote"]) >= batch_id:
        return
    counts = spark.createDataFrame([], "tienda_id int, anomalias bigint")
    if batch_id in _batches(spark, live):
        fresh = spark.table(live).filter((F.col(BATCH) == batch_id) & F.col("es_anomalia"))
        counts = fresh.groupBy("tienda_id").agg(F.count(F.lit(1)).alias("anomalias"))
    if known:
        counts = counts.unionByName(spark.table(tables.named(spark, name)))
    merged = counts.groupBy("tienda_id").agg(F.sum("anomalias").alias("anomalias"))
    tables.publish(merged, name, properties={"ultimo_lote": batch_id})


def live_events(spark: SparkSession, live: str = LIVE) -> DataFrame:
    return spark.table(f"{tables.named(spark, tables.SILVER)}.{live}").drop(BATCH)


def batches_aside(spark: SparkSession, aside: str = ASIDE) -> DataFrame:
    return spark.table(f"{tables.named(spark, tables.SILVER)}.{aside}")


def anomalies_kept(spark: SparkSession, by_store: str = BY_STORE) -> DataFrame:
    return spark.table(tables.named(spark, f"{tables.SILVER}.{by_store}"))


def publish_stream(refined: DataFrame, checkpoint: str, *others: Sink, letters: Sink | None = None) -> StreamingQuery:
    """Publishes a stream of refined events batch by batch, with whatever ``others`` want of it. Takes what is there, then stops."""
    return fan_out(refined, [checked_sink(refined.sparkSession), *others], checkpoint, letters)
