"""Layer tables: versions on disk, views as their names.

What a reader sees as ``silver.X`` is a view of one version, a Parquet table of its own in ``silver_datos``. A version
is written once, checked, and only then the view is replaced, by one statement of the catalog; neither other
columns nor other partitions need a moment without the table. What is wrong while a version is written or checked leaves the
view as it was, and the version is removed.

Tables that only fit together, as the star with its surrogate keys, are versions of one *load* (``Load``). Their views choose
their version by one pointer, the view ``carga_actual``: while a load is being published each of them has the branches
of the old load and the new one, the pointer is replaced, and with that one statement all of them change. The pointer is a constant,
so that the optimizer reads the chosen branch alone.

Counts and sums that checks ask for are observed while the rows are written, in the writing stage, so nothing is read for
them; they stay with the version as its *measures*. Of earlier versions ``KEEP`` are left after a publication, and those that
are pinned. A query that runs longer than that many publications should pin what it reads.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable, Iterable, Mapping, Sequence
from contextlib import contextmanager
from datetime import datetime, timezone
from decimal import Decimal
from typing import Any

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from ..operators.contracts import conform, contract, losses, required_columns
from ..operators.quality import null_rules, require
from ..session import settings, shuffles_released

RAW_AUDIT = ("_archivo_origen", "_fecha_ingesta")
LOAD_AUDIT = "_fecha_procesamiento"
BRONZE, SILVER, GOLD = "bronze", "silver", "gold"
#: Session settings: what the names of this session's schemas begin with, the folder of its tables
#: (else the warehouse), and how many earlier versions stay.
PREFIX, ROOT, KEEP = "shelfstar.schema.prefix", "shelfstar.tables.dir", "shelfstar.tables.keep"
KEPT = 1
POINTER, _MEASURE, _PIN = "carga_actual", "shelfstar.medida.", "shelfstar.fijada"

#: How every table's files are written: numbers and text that share beginnings are stored as differences.
FILES = {"compression": "zstd", "parquet.writer.version": "PARQUET_2_0"}
#: Moments take 8 bytes instead of 12.
MOMENTS = {"spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS"}

Check = Callable[[DataFrame], DataFrame]
Measures = Mapping[str, Column]


def named(spark: SparkSession, table: str) -> str:
    """Full name of a table of this session."""
    return spark.conf.get(PREFIX, "") + table


def table_root(spark: SparkSession) -> str:
    """Folder of the tables. Spark's default warehouse is below the driver's working folder, which executors of
    a cluster don't see."""
    root = spark.conf.get(ROOT, None) or spark.conf.get("spark.sql.warehouse.dir")
    root = root.rstrip("/")
    if not spark.sparkContext.master.startswith("local") and root in (f"file:{os.getcwd()}/spark-warehouse", "spark-warehouse"):
        raise RuntimeError(f"set spark.sql.warehouse.dir or {ROOT} to a folder every executor can reach")
    return root


def ensure_schema(spark: SparkSession, name: str) -> None:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name} LOCATION '{table_root(spark)}/{name}.db'")


def _run(spark: SparkSession, statement: str) -> None:
    """One statement that changes the catalog."""
    spark.sql(statement)


def remove_folder(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


# ---- versions ---------------------------------------------------------------------------------

def _data_schema(schema: str) -> str:
    return f"{schema}_datos"


def new_version() -> str:
    """An id that sorts by time."""
    return f"{datetime.now(timezone.utc):%Y%m%d%H%M%S%f}_{uuid.uuid4().hex[:6]}"


def _physical(table: str, version: str) -> str:
    schema, name = table.split(".")
    return f"{_data_schema(schema)}.{name}__{version}"


def _columns(names: Sequence[str]) -> str:
    return ", ".join(f"`{n}`" for n in names)


def _properties(spark: SparkSession, physical: str) -> dict[str, str]:
    return {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {physical}").collect()}


def _text(value: Any) -> str:
    return str(value if value is not None else 0)


def _pieces(df: DataFrame | Iterable[DataFrame]) -> Iterable[DataFrame]:
    return [df] if isinstance(df, DataFrame) else df


def _added(sums: dict[str, Any], found: Mapping[str, Any]) -> None:
    for name, value in found.items():
        if value is not None:
            sums[name] = value if sums.get(name) is None else sums[name] + value


def write_version(
    df: DataFrame | Iterable[DataFrame], table: str, version: str, *checks: Check, partition_by: str | None = None, forbidden: Measures | None = None,
    measures: Measures | None = None, expected: Mapping[str, Decimal] | None = None, into: str | None = None,
    properties: Mapping[str, Any] | None = None, order: Sequence[str] = (), spark: SparkSession | None = None,
) -> DataFrame:
    """Write a version of a table, hold it against its controls, and give it a name that readers don't see.

    ``forbidden`` are conditions that no row may meet and ``measures`` are counts or sums over all rows, both of the rows before
    they take the types of the contract ``into``; ``expected`` are values that measures must have. ``properties`` are kept as
    measures are. ``checks`` read the version. Rows may come in pieces of one schema, which are written one after the other; then with ``spark``.
    Every task writes its rows in the ``order``, which takes fewer bytes; rows with a partition column come in that column's.
    """
    spark = spark or df.sparkSession
    ensure_schema(spark, _data_schema(table.split(".")[0]))
    physical = _physical(table, version)
    folder = f"{table_root(spark)}/{table.replace('.', '/')}/{version}"
    kept = forbidden or {}
    told = {f"prohibido_{k}": F.count_if(v) for k, v in kept.items()} | {f"medida_{k}": v for k, v in (measures or {}).items()}
    found: dict[str, Any] = {}
    try:
        for number, piece in enumerate(_pieces(df)):
            seen = Observation()
            # rows with a partition column are rebalanced by it first: small partitions are merged at run time, and one that
            # holds a large share of the rows is split over several tasks and files
            ready = (piece.sortWithinPartitions(*order) if order else piece) if partition_by is None else piece.hint("rebalance", partition_by)
            ready = ready.observe(seen, *(c.alias(k) for k, c in told.items())) if told else ready
            ready = ready if into is None else conform(ready, into)
            writer = ready.write if partition_by is None else ready.write.partitionBy(partition_by)
            with shuffles_released(spark), settings(spark, MOMENTS):
                writer.options(**FILES).mode("append" if number else "errorifexists").parquet(folder)
            _added(found, seen.get if told else {})
        rows = [(k, int(found.get(f"prohibido_{k}") or 0), not found.get(f"prohibido_{k}")) for k in kept]
        known = {k: found.get(f"medida_{k}") for k in measures or {}}
        for k, value in (expected or {}).items():
            rows.append((k, int((known[k] or 0) - value), (known[k] or 0) == value))
        if rows:
            require(spark.createDataFrame(rows, "control string, valor bigint, cumple boolean"))
        staged = spark.read.schema(ready.schema).parquet(folder).select(*ready.columns)
        with shuffles_released(spark):
            for check in checks:
                require(check(staged))
        last = [partition_by] if partition_by else []
        fields = [f for f in ready.schema.fields if f.name not in last] + [f for f in ready.schema.fields if f.name in last]
        ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)
        noted = ", ".join(f"'{_MEASURE}{k}'='{_text(v)}'" for k, v in (known | dict(properties or {})).items())
        _run(spark, f"CREATE TABLE {physical} ({ddl}) USING parquet" + (f" PARTITIONED BY (`{partition_by}`)" if partition_by else "")
             + f" LOCATION '{folder}'" + (f" TBLPROPERTIES ({noted})" if noted else ""))
        if partition_by:
            spark.catalog.recoverPartitions(physical)
    except BaseException:
        _run(spark, f"DROP TABLE IF EXISTS {physical}")
        remove_folder(spark, folder)
        raise
    return spark.table(physical).select(*ready.columns)


def versions(spark: SparkSession, table: str) -> list[str]:
    """Versions of a table, oldest first; ``table`` with its schema, without the session's prefix."""
    schema, name = named(spark, table).split(".")
    if not spark.catalog.databaseExists(_data_schema(schema)):
        return []
    found = [r["tableName"] for r in spark.sql(f"SHOW TABLES IN {_data_schema(schema)} LIKE '{name.lower()}__*'").collect()]
    return sorted(f.split("__", 1)[1] for f in found if f.lower().startswith(f"{name.lower()}__"))


def at_version(spark: SparkSession, table: str, version: str) -> DataFrame:
    return spark.table(_physical(named(spark, table), version))


def pin(spark: SparkSession, table: str, version: str, pinned: bool = True) -> None:
    """Keep a version, or let it go with the next publication."""
    physical = _physical(named(spark, table), version)
    _run(spark, f"ALTER TABLE {physical} SET TBLPROPERTIES ('{_PIN}'='1')" if pinned else f"ALTER TABLE {physical} UNSET TBLPROPERTIES IF EXISTS ('{_PIN}')")


def measured(spark: SparkSession, table: str) -> dict[str, Decimal]:
    """Measures of the published version of a table, as they were observed when it was written."""
    schema, name = named(spark, table).split(".")
    current = _current(spark, f"{schema}.{name}")
    found = _properties(spark, _physical(f"{schema}.{name}", current))
    return {k.removeprefix(_MEASURE): Decimal(v) for k, v in found.items() if k.startswith(_MEASURE)}


def _view_text(spark: SparkSession, view: str) -> str | None:
    """The query of a view; None if there is none."""
    if not spark.catalog.tableExists(view):
        return None
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {view}").collect()
    found = {r["col_name"]: r["data_type"] for r in rows}
    return found.get("View Text") if found.get("Type") == "VIEW" else ""


def _current(spark: SparkSession, table: str) -> str | None:
    """Published version of a table given by its full name."""
    schema, name = table.split(".")
    text = _view_text(spark, table)
    if not text:
        return None
    if f"{schema}.{POINTER}" in text:
        return spark.table(f"{schema}.{POINTER}").first()["carga"]
    return text.rsplit(f"{name}__", 1)[1].split()[0].strip("`;)")


def current_version(spark: SparkSession, table: str) -> str | None:
    """Version that readers of a table see; None before the first publication."""
    return _current(spark, named(spark, table))


def _set_view(spark: SparkSession, view: str, query: str) -> None:
    if _view_text(spark, view) == "":  # a table of that name, from before there were versions; once
        _run(spark, f"DROP TABLE {view}")
    _run(spark, f"CREATE OR REPLACE VIEW {view} AS {query}")


def _drop_earlier(spark: SparkSession, table: str, current: str) -> None:
    """Remove versions before the last ``KEEP`` ones and the current one, unless they are pinned."""
    schema, name = table.split(".")
    keep = int(spark.conf.get(KEEP, str(KEPT)))
    found = [r["tableName"] for r in spark.sql(f"SHOW TABLES IN {_data_schema(schema)} LIKE '{name.lower()}__*'").collect()]
    earlier = sorted(v for v in (f.split("__", 1)[1] for f in found) if v < current)
    for version in earlier[: max(0, len(earlier) - keep)]:
        physical = _physical(table, version)
        if _PIN not in _properties(spark, physical):
            _run(spark, f"DROP TABLE {physical}")
            remove_folder(spark, f"{table_root(spark)}/{table.replace('.', '/')}/{version}")


@contextmanager
def scratch(spark: SparkSession, name: str):
    """A folder outside the catalog; it is removed at the end."""
    folder = f"{table_root(spark)}/{named(spark, 'staging')}/{name}/{uuid.uuid4().hex}"
    try:
        yield folder
    finally:
        remove_folder(spark, folder)


@contextmanager
def staged(df: DataFrame | Iterable[DataFrame], table: str, spark: SparkSession | None = None):
    """Rows written once for several uses; they are removed at the end. They may come in pieces, as in ``write_version``."""
    spark = spark or df.sparkSession
    with scratch(spark, table) as folder:
        for piece in _pieces(df):
            with shuffles_released(spark):
                piece.write.options(**FILES).mode("append").parquet(folder)
        yield spark.read.schema(piece.schema).parquet(folder)


def publish(df: DataFrame, table: str, *checks: Check, only: str | None = None, hidden: Sequence[str] = (), **options: Any) -> DataFrame:
    """Write, check, replace the view; returns the published table. Readers see the rows that meet the SQL condition ``only``,
    without the ``hidden`` columns. Other ``options`` are those of ``write_version``."""
    spark = df.sparkSession
    table, version = named(spark, table), new_version()
    ensure_schema(spark, table.split(".")[0])
    written = write_version(df, table, version, *checks, **options)
    shown = [c for c in written.columns if c not in hidden]
    _set_view(spark, table, f"SELECT {_columns(shown)} FROM {_physical(table, version)}" + (f" WHERE {only}" if only else ""))
    _drop_earlier(spark, table, version)
    return spark.table(table)


class Load:
    """Tables of one schema that change together. Nothing of it is seen before ``publish``."""

    def __init__(self, spark: SparkSession, schema: str = GOLD):
        self.spark, self.schema, self.version = spark, named(spark, schema), new_version()
        self.tables: dict[str, list[str]] = {}
        ensure_schema(spark, self.schema)

    def write(self, df: DataFrame | Iterable[DataFrame], name: str, *checks: Check, **options: Any) -> DataFrame:
        written = write_version(df, f"{self.schema}.{name}", self.version, *checks, spark=self.spark, **options)
        self.tables[name] = written.columns
        return written

    def read(self, name: str) -> DataFrame:
        """A table of this load; one that it has not written, as it is published."""
        table = f"{self.schema}.{name}"
        return self.spark.table(_physical(table, self.version) if name in self.tables else table)

    def _branch(self, name: str, columns: Sequence[str], version: str) -> str:
        return f"SELECT {_columns(columns)} FROM {_physical(f'{self.schema}.{name}', version)} WHERE (SELECT carga FROM {self.schema}.{POINTER}) = '{version}'"

    def publish(self) -> None:
        """Both branches into every view, the pointer, the new branch alone. A reader at any moment sees one load whole."""
        spark, pointer = self.spark, f"{self.schema}.{POINTER}"
        old = _pointed(spark, self.schema)
        if old is None:
            # until there is a first load, no version is chosen
            _set_view(spark, pointer, "SELECT '' AS carga")
        for name, columns in self.tables.items():
            both = [self._branch(name, columns, self.version)]
            before = _physical(f"{self.schema}.{name}", old) if old else None
            if before and spark.catalog.tableExists(before):
                has = {f.name.lower() for f in spark.table(before).schema.fields}
                types = {f.name: f.dataType.simpleString() for f in self.read(name).schema.fields}
                had = ", ".join(f"`{c}`" if c.lower() in has else f"CAST(NULL AS {types[c]}) AS `{c}`" for c in columns)
                both.insert(0, f"SELECT {had} FROM {before} WHERE (SELECT carga FROM {pointer}) = '{old}'")
            _set_view(spark, f"{self.schema}.{name}", " UNION ALL ".join(both))
        _set_view(spark, pointer, f"SELECT '{self.version}' AS carga")
        for name, columns in self.tables.items():
            _set_view(spark, f"{self.schema}.{name}", self._branch(name, columns, self.version))
            _drop_earlier(spark, f"{self.schema}.{name}", self.version)

    def discard(self) -> None:
        for name in self.tables:
            table = f"{self.schema}.{name}"
            _run(self.spark, f"DROP TABLE IF EXISTS {_physical(table, self.version)}")
            remove_folder(self.spark, f"{table_root(self.spark)}/{table.replace('.', '/')}/{self.version}")


@contextmanager
def new_load(spark: SparkSession, schema: str = GOLD):
    """A load that is published at the end of the block, or not at all."""
    load = Load(spark, schema)
    try:
        yield load
        load.publish()
    except BaseException:
        if load.version != _pointed(spark, load.schema):
            load.discard()
        raise


def _pointed(spark: SparkSession, schema: str) -> str | None:
    pointer = f"{schema}.{POINTER}"
    return spark.table(pointer).first()["carga"] if spark.catalog.tableExists(pointer) else None


# ---- layers -----------------------------------------------------------------------------------

def write_bronze(df: DataFrame, table: str, **options: Any) -> DataFrame:
    return publish(df, table, **options)


def escribir_silver(df: DataFrame, table: str, *checks: Check, **options: Any) -> DataFrame:
    stamped = df.withColumn(LOAD_AUDIT, F.current_timestamp())
    return publish(stamped, f"{SILVER}.{table}", *checks, **options).drop(LOAD_AUDIT)


def escribir_gold(df: DataFrame | Iterable[DataFrame], table: str, load: Load, *checks: Check, forbidden: Measures | None = None, **options: Any) -> DataFrame:
    """Every table is held against its contract: required values that are missing and values that its types can't take are
    counted while the rows are written, before they would be lost."""
    held = null_rules(required_columns(table)) | losses(table) | dict(forbidden or {})
    return load.write(df, table, *checks, forbidden=held, into=table, **options)


def leer_bronze(spark: SparkSession, table: str) -> DataFrame:
    return spark.table(named(spark, f"{BRONZE}.{table}")).drop(*RAW_AUDIT)


def leer_silver(spark: SparkSession, table: str) -> DataFrame:
    return spark.table(named(spark, f"{SILVER}.{table}")).drop(LOAD_AUDIT)


def leer_gold(spark: SparkSession, table: str, load: Load | None = None) -> DataFrame:
    found = spark.table(named(spark, f"{GOLD}.{table}")) if load is None else load.read(table)
    return found.select(*contract(table).fieldNames())
