"""Sale events as JSON records.

``read_events`` trusts the feed: a record that does not parse is an event of NULLs. ``read_event_lines`` and ``parse_events``
don't: such a record comes out as its text with a reason, to be sent to a destination of its own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

# Fixed value: the event contract on the wire.
EVENT_SCHEMA = (
    "evento_id STRING, timestamp_evento STRING, tienda_id BIGINT, empleado_id BIGINT, "
    "sku STRING, cantidad BIGINT, precio_unitario DOUBLE, descuento_pct BIGINT"
)
ARRIVAL = "EventEnqueuedUtcTime TIMESTAMP"


#: Files of one micro-batch. It bounds a batch and not the data: a backlog is taken in several batches.
FILES_PER_BATCH = 1000


def event_schema(with_arrival: bool = False) -> str:
    return f"{EVENT_SCHEMA}, {ARRIVAL}" if with_arrival else EVENT_SCHEMA


def read_events(
    spark: SparkSession, path: str, schema: str = EVENT_SCHEMA, files_per_batch: int = FILES_PER_BATCH
) -> DataFrame:
    """Streaming table over a folder of UTF-8 JSON lines."""
    reader = spark.readStream.schema(schema).option("encoding", "UTF-8").option("maxFilesPerTrigger", files_per_batch)
    return reader.json(path)


def read_events_batch(spark: SparkSession, path: str, schema: str = EVENT_SCHEMA) -> DataFrame:
    return spark.read.schema(schema).option("encoding", "UTF-8").json(path)


#: Text of a record that is no event, and why; both NULL in an event.
LETTER, REASON = "_registro", "_motivo"
UNREADABLE, MISSING = "no se puede leer", "falta "


def read_event_lines(spark: SparkSession, path: str, files_per_batch: int | None = FILES_PER_BATCH) -> DataFrame:
    """Lines of a folder of UTF-8 JSON lines as a stream; as a plain table without ``files_per_batch``."""
    if files_per_batch is None:
        return spark.read.text(path)
    return spark.readStream.option("maxFilesPerTrigger", files_per_batch).text(path)


def parse_events(lines: DataFrame, schema: str = EVENT_SCHEMA, line: str = "value") -> DataFrame:
    """Event columns, ``LETTER`` and ``REASON``. A line that is no JSON of these types, or lacks one of the contract's columns, is
    a letter; blank lines are nothing. What else the lines' table has is not carried."""
    names, required = T.StructType.fromDDL(schema).fieldNames(), T.StructType.fromDDL(EVENT_SCHEMA).fieldNames()
    text = F.col(line)
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": LETTER}
    told = lines.filter(F.trim(text) != "").select(text.alias(LETTER), F.from_json(text, f"{schema}, {LETTER} STRING", options).alias("e"))
    unreadable = F.col("e").isNull() | F.col(f"e.{LETTER}").isNotNull()
    absent = F.coalesce(*(F.when(F.col(f"e.{c}").isNull(), F.lit(MISSING + c)) for c in required))
    reason = F.when(unreadable, F.lit(UNREADABLE)).otherwise(absent)
    whole = reason.isNull()
    return told.select(
        *(F.when(whole, F.col(f"e.{c}")).alias(c) for c in names), F.when(~whole, F.col(LETTER)).alias(LETTER), reason.alias(REASON))
