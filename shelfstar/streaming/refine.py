"""Event refinement: one rule for batch and stream.

The batch rebuild is the full result. The stream gives the same rows as long as exact copies
arrive within the watermark delay of each other; a later copy passes, because state must stay
bounded. The watermark follows the time of arrival, not the time of sale, so an event that
arrives days late is kept.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming.query import StreamingQuery

from ..operators.clean import ANOMALY_PCT, ARRIVAL_COLUMN, EVENT_COLUMNS, LETTER_COLUMNS, clean_events, select_present
from ..operators.filters import inconsistent
from ..operators.quality import null_rules, rules
from ..session import ensure_disk_state

DELAY = "1 hour"
# Columns that may not be empty, and the columns of the anomaly report.
REQUIRED = (*EVENT_COLUMNS, "venta_total")
ANOMALY_COLUMNS = (
    "timestamp_evento", "evento_id", "tienda_id", "empleado_id",
    "sku", "cantidad", "precio_unitario", "descuento_pct", "venta_total",
)

Sink = Callable[[DataFrame, int], None]


def dedup_events(events: DataFrame, delay: str = DELAY, spread: int = 8) -> DataFrame:
    """Drop exact copies of the whole record. Never by ``evento_id``: ids collide.

    An arrival time, where present, is part of the record, so a resend with a new one stays. Letters (see ``parse_events``) are
    records too.

    In a stream all copies of a record meet in one state partition. They do so in two steps: first
    per record and slot, where the slot comes from the input partition, then per record. So a record
    resent very often reaches the second step at most ``spread`` times within the delay.
    """
    records = select_present(events, EVENT_COLUMNS, [ARRIVAL_COLUMN, *LETTER_COLUMNS])
    if not records.isStreaming:
        return records.dropDuplicates()
    timed = records.withColumn("_llegada", F.current_timestamp()).withWatermark("_llegada", delay)
    if spread > 1:
        slotted = timed.withColumn("_reparto", F.spark_partition_id() % spread)
        timed = slotted.dropDuplicatesWithinWatermark([*records.columns, "_reparto"]).drop("_reparto")
    return timed.dropDuplicatesWithinWatermark(records.columns).drop("_llegada")


def refine_events(
    events: DataFrame,
    match_double: bool = False,
    threshold: int = ANOMALY_PCT,
    delay: str = DELAY,
    spread: int = 8,
) -> DataFrame:
    """Raw events, batch or stream, to typed events with amount and anomaly flag."""
    return clean_events(dedup_events(events, delay, spread), match_double, threshold)


def event_checks(refined: DataFrame, threshold: int = ANOMALY_PCT) -> DataFrame:
    """Controls before refined events are published."""
    forbidden = {
        "anomalia_incoherente": inconsistent("es_anomalia", F.col("descuento_pct") >= threshold),
        "total_negativo": F.col("venta_total") < 0,
        "descuento_fuera_de_rango": ~F.col("descuento_pct").between(0, 100),
    }
    return rules(refined, null_rules(REQUIRED) | forbidden)


def append_parquet(path: str) -> Sink:
    """Sink for ``fan_out``: one folder per micro-batch, so a repeated batch overwrites itself."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    return write


def split_letters(events: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Events without the letter columns, and the letters alone."""
    text, reason = LETTER_COLUMNS
    return events.filter(F.col(reason).isNull()).drop(*LETTER_COLUMNS), events.filter(F.col(reason).isNotNull()).select(text, reason)


def fan_out(stream: DataFrame, sinks: Sequence[Sink], checkpoint: str, letters: Sink | None = None) -> StreamingQuery:
    """Write every micro-batch to all sinks, reading it once. Takes what is there, then stops.

    With ``letters`` the stream has letter columns: sinks get the events, and it gets the records that are none.
    """

    def write_all(batch: DataFrame, batch_id: int) -> None:
        kept = batch.persist()
        try:
            # every task of the batch runs, and so leaves its state, even if the sinks have the batch already
            kept.count()
            events, broken = (kept, None) if letters is None else split_letters(kept)
            for sink in sinks:
                sink(events, batch_id)
            if letters is not None:
                letters(broken, batch_id)
        finally:
            kept.unpersist()

    ensure_disk_state(stream.sparkSession)
    return (
        stream.writeStream.foreachBatch(write_all)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def stream_to_table(events: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append a stream to a Parquet folder, exactly once. Takes what is there, then stops."""
    ensure_disk_state(events.sparkSession)
    return (
        events.writeStream.format("parquet")
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def anomaly_summary(refined: DataFrame) -> DataFrame:
    flag = F.col("es_anomalia").cast("int")
    return refined.agg(
        F.count(F.lit(1)).alias("eventos"),
        F.sum(flag).alias("anomalias"),
        F.round(F.avg(flag) * 100, 2).alias("pct_anomalias"),
        F.sum("venta_total").alias("venta_total"),
        F.min("timestamp_evento").alias("primer_evento"),
        F.max("timestamp_evento").alias("ultimo_evento"),
    )


def latest_anomalies(refined: DataFrame, n: int = 20) -> DataFrame:
    """Newest anomalies first; the remaining columns break ties, so the report is repeatable."""
    rest = [F.asc(c) for c in ANOMALY_COLUMNS if c != "timestamp_evento"]
    return refined.filter("es_anomalia").select(*ANOMALY_COLUMNS).orderBy(F.desc("timestamp_evento"), *rest).limit(n)


def anomalies_by_store(refined: DataFrame) -> DataFrame:
    return refined.filter("es_anomalia").groupBy("tienda_id").count().orderBy(F.desc("count"), "tienda_id")


def anomaly_report(refined: DataFrame, n: int = 20) -> dict[str, DataFrame]:
    return {
        "resumen": anomaly_summary(refined),
        "ultimas": latest_anomalies(refined, n),
        "por_tienda": anomalies_by_store(refined),
    }


def arrival_latency(refined: DataFrame) -> DataFrame:
    """Seconds from sale to arrival; NULL when the feed brings no arrival time."""
    if "_fecha_ingesta" not in refined.columns:
        return refined.withColumn("latencia_seg", F.lit(None).cast("double"))
    arrived, sold = F.col("_fecha_ingesta").cast("timestamp"), F.col("timestamp_evento")
    return refined.withColumn("latencia_seg", (F.unix_micros(arrived) - F.unix_micros(sold)) / F.lit(1e6))
