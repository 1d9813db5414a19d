"""Delimited files to raw tables, driven by a manifest.

A line with more or fewer cells than the header is kept as text beside its table (``LINE``), instead of being cut or
filled up. Readers of the raw table don't see it; ``invalid_lines`` does, with file and reason, and ``ingest`` counts it.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..operators.quality import combine
from .tables import RAW_AUDIT, at_version, current_version, measured, write_bronze

AUDIT_COLUMNS = ("_archivo_origen", "_fecha_ingesta")


@dataclass(frozen=True)
class Entry:
    archivo: str
    tabla: str
    delimitador: str = "|"
    #: The header; without it, that of the first file.
    columnas: tuple[str, ...] = ()


# The source files; each table is named after its file.
TABLE_NAMES = (
    "tiendas", "productos", "empleados", "clientes",
    "presupuesto_metas", "ventas_transacciones", "inventario_snapshot",
)
MANIFEST = tuple(Entry(f"{name}.csv", name) for name in TABLE_NAMES)


#: Text of a line that doesn't fit the header, and why.
LINE, MORE, FEWER, QUOTES = "_linea_invalida", "sobran columnas", "faltan columnas", "comillas sin cerrar"


def _dialect(delimiter: str) -> dict[str, str]:
    return {"sep": delimiter, "quote": '"', "escape": "\\"}


def read_delimited(
    spark: SparkSession, path: str, delimiter: str = "|", columns: Sequence[str] = (), invalid: str | None = None
) -> DataFrame:
    """All columns as text, named by the header; one record per line, so large files split.

    With ``invalid`` a column of that name has the text of lines that don't fit the header, and is NULL in all others.
    """
    reader = spark.read.options(**_dialect(delimiter), header=True, multiLine=False, inferSchema=False, recursiveFileLookup=True)
    if invalid is None and not columns:
        return reader.csv(path)
    names = list(columns or reader.csv(path).columns)
    fields = ", ".join(f"`{c}` STRING" for c in [*names, *([invalid] if invalid else [])])
    return reader.options(mode="PERMISSIVE", **({"columnNameOfCorruptRecord": invalid} if invalid else {})).schema(fields).csv(path)


def line_reason(line: Column, cells: int, delimiter: str = "|") -> Column:
    """Whether a line that doesn't fit ``cells`` has more or fewer; quoted delimiters are part of their cell. A line whose quotes don't
    close may have as many."""
    plain = F.regexp_replace(line, r'"(?:[^"\\]|\\.)*"', "q")
    found = F.size(F.split(plain, rf"\Q{delimiter}\E", -1))
    return F.when(found > cells, F.lit(MORE)).when(found < cells, F.lit(FEWER)).otherwise(F.lit(QUOTES))


def add_ingest_audit(df: DataFrame) -> DataFrame:
    return df.withColumns({"_archivo_origen": F.col("_metadata.file_path"), "_fecha_ingesta": F.current_timestamp()})


def ingest(
    spark: SparkSession, folder: str, manifest: Sequence[Entry] = MANIFEST, schema: str = "bronze", fatal_lines: bool = False
) -> Mapping[str, DataFrame]:
    """Copy every listed file to its raw table and return the tables read back.

    Lines that don't fit are counted while they are written; with ``fatal_lines`` one of them stops the ingest of its table.
    """
    tables = {}
    for entry in manifest:
        source = add_ingest_audit(read_delimited(spark, f"{folder}/{entry.archivo}", entry.delimitador, entry.columnas, LINE))
        wrong = F.col(LINE).isNotNull()
        tables[entry.tabla] = write_bronze(
            source, f"{schema}.{entry.tabla}", only=f"{LINE} IS NULL", hidden=[LINE],
            measures={"lineas": F.count(F.lit(1)), "lineas_invalidas": F.count_if(wrong)}, forbidden={"lineas_invalidas": wrong} if fatal_lines else None)
    return tables


def line_control(spark: SparkSession, manifest: Sequence[Entry] = MANIFEST, schema: str = "bronze") -> DataFrame:
    """Lines of each raw table that don't fit its header, from what was observed while it was written; informative."""
    found = [(f"lineas_invalidas_{e.tabla}", int(measured(spark, f"{schema}.{e.tabla}")["lineas_invalidas"]), True) for e in manifest]
    return spark.createDataFrame(found, "control string, valor bigint, cumple boolean")


def invalid_lines(spark: SparkSession, manifest: Sequence[Entry] = MANIFEST, schema: str = "bronze") -> DataFrame:
    """``tabla``, ``archivo``, ``linea``, ``motivo`` of every line that doesn't fit its table's header."""
    parts = []
    for entry in manifest:
        name = f"{schema}.{entry.tabla}"
        written = at_version(spark, name, current_version(spark, name))
        cells = len([c for c in written.columns if c not in (*RAW_AUDIT, LINE)])
        parts.append(written.filter(F.col(LINE).isNotNull()).select(
            F.lit(entry.tabla).alias("tabla"), F.col("_archivo_origen").alias("archivo"), F.col(LINE).alias("linea"),
            line_reason(F.col(LINE), cells, entry.delimitador).alias("motivo")))
    return combine(*parts)
