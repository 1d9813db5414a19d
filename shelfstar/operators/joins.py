"""Joins of a large fact with tables of unknown size.

``lookup`` leaves a looked-up side below a byte limit to Spark, which broadcasts it if it measures it small.
Above the limit it shuffles, and first takes the fact's most frequent keys out of the
shuffle: the ``HOT_KEYS`` most frequent keys and their values are few rows by definition,
so those are broadcast, and every key left for the shuffle holds less than
about 1/``HOT_KEYS`` of the fact. Nothing is dropped either way.

Which keys are frequent comes from a mergeable summary (``frequent_keys``): one pass over the fact for all its lookup columns,
of fixed size for each. It decides where a row is joined and never what it is joined to.

Every such lookup shuffles whole fact rows, and a query keeps all it has shuffled until it ends. ``spread_in_slices`` therefore writes
the fact once and takes several lookups slice by slice, so that the disks hold the shuffles of one slice at a time.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator, Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ..session import BROADCAST_BYTES, broadcast_threshold, ensure_checkpoint_dir, fits_broadcast, shuffle_partitions, shuffles_released

HOT_KEYS = 1000
#: Items the summary follows for each key it is asked for; the more, the surer a key just above the share is among them.
FOLLOWED = 16
SENTINEL = -1
#: Slices of a fact that meets dimensions too large to broadcast, and the bytes on disk below which a fact isn't cut further. The number
#: bounds what is shuffled at a time to a share of the fact; every slice reads the dimensions again, so it is small.
SLICES, SLICE_BYTES = 8, 16 * 1024 * 1024
#: Dimension, key column it shares with the fact, attributes to take.
Grouping = tuple[DataFrame, str, Sequence[str]]
#: Frequent values of each column, without NULL.
Hot = Mapping[str, Sequence[Any]]


def frequent_keys(fact: DataFrame, columns: Mapping[str, Column] | Sequence[str], most: int = HOT_KEYS) -> dict[str, list[Any]]:
    """The ``most`` most frequent values of every column, NULL apart, in one pass over the fact.

    Tasks keep a summary of ``FOLLOWED`` items a key and merge them, so neither a shuffle nor a sort of the keys is needed.
    At most ``most`` values a column come to the driver.
    """
    wanted = columns if isinstance(columns, Mapping) else {c: F.col(c) for c in columns}
    size = min(1_000_000, max(64, FOLLOWED * most))
    keys = fact.select(*(value.alias(f"k{i}") for i, value in enumerate(wanted.values())))
    # one item more, as NULL may be among them
    told = keys.agg(*(F.expr(f"approx_top_k(k{i}, {most + 1}, {size})").alias(f"k{i}") for i in range(len(wanted)))).first()
    return {name: [r["item"] for r in told[f"k{i}"] or [] if r["item"] is not None][:most] for i, name in enumerate(wanted)}


def lookup(
    fact: DataFrame,
    dim: DataFrame,
    on: str,
    values: Sequence[str],
    broadcast_bytes: int = BROADCAST_BYTES,
    hot_keys: int = HOT_KEYS,
    hot: Hot | None = None,
) -> DataFrame:
    """Left outer join to a table unique on ``on``: every fact row comes out once.

    ``hot`` are frequent values as ``frequent_keys`` gives them; without them the fact is summed up here, if at all needed.
    """
    dim, known = dim.select(on, *values), (hot or {}).get(on)
    # values are given for dimensions that don't fit
    if known is None and fits_broadcast(dim, broadcast_bytes):
        return fact.join(dim, on, "left")
    return _spread_lookup(fact, dim, on, list(values), frequent_keys(fact, [on], hot_keys)[on] if known is None else known)


def _spread_lookup(fact: DataFrame, dim: DataFrame, on: str, values: list[str], hot: Sequence[Any]) -> DataFrame:
    spark = fact.sparkSession
    listed = spark.createDataFrame([(v,) for v in hot], T.StructType([T.StructField(on, fact.schema[on].dataType)]))
    resolved = listed.join(dim.join(F.broadcast(listed), on, "left_semi"), on, "left")
    resolved = resolved.select(F.col(on).alias("_hot_key"), F.lit(True).alias("_hot"), *(F.col(v).alias(f"_hot_{v}") for v in values))
    marked = fact.join(F.broadcast(resolved), F.col(on) == F.col("_hot_key"), "left")
    # Hot rows are done after this join, and rows without a key match nothing. Both still pass the next one: without a
    # key, and with a slot that sends each map task's share to another partition.
    partitions = shuffle_partitions(spark)
    done = F.col("_hot").isNotNull() | F.col(on).isNull()
    marked = marked.withColumns({
        "_key": F.when(~done, F.col(on)),
        "_slot": F.when(done, F.spark_partition_id() % partitions).otherwise(F.lit(0)),
    })
    # The slot of a dimension row is always 0; written so that it is not folded into the condition.
    cold = dim.select(
        F.col(on).alias("_key"), F.pmod(F.hash(on), F.lit(1)).alias("_slot"), *(F.col(v).alias(f"_cold_{v}") for v in values)
    )
    joined = marked.join(cold.hint("merge"), ["_key", "_slot"], "left")
    picked = [F.when(F.col("_hot"), F.col(f"_hot_{v}")).otherwise(F.col(f"_cold_{v}")).alias(v) for v in values]
    return joined.select(on, *(c for c in fact.columns if c != on), *picked)


def with_hot_keys(fact: DataFrame, dims: Sequence[Grouping], broadcast_bytes: int = BROADCAST_BYTES, hot_keys: int = HOT_KEYS,
                  sentinel: Mapping[str, Any] | None = None) -> dict[str, list[Any]]:
    """Frequent values of the columns whose dimension is not left to Spark, in one pass; none at all if all are."""
    missing = sentinel or {}
    wanted = {on: F.coalesce(F.col(on), F.lit(missing[on])) if on in missing else F.col(on)
              for dim, on, values in dims if not fits_broadcast(dim.select(on, *values), broadcast_bytes)}
    return frequent_keys(fact, wanted, hot_keys) if wanted else {}


def lookup_keys(fact: DataFrame, dims: Sequence[Grouping], hot: Hot | None = None, **limits: int) -> DataFrame:
    """Several lookups in a row; each entry is ``(dimension, join column, columns to take)``. The fact is summed up once for all."""
    hot = with_hot_keys(fact, dims, **limits) if hot is None else hot
    for dim, on, values in dims:
        fact = lookup(fact, dim, on, values, hot=hot, **limits)
    return fact


def lookup_with_sentinel(
    fact: DataFrame,
    dim: DataFrame,
    on: str,
    values: Sequence[str],
    sentinel: int = SENTINEL,
    hot: Hot | None = None,
    **limits: int,
) -> DataFrame:
    """A missing id meets the dimension's sentinel member; an id the dimension lacks stays NULL. ``hot`` values of ``on`` count
    a missing id as the sentinel."""
    cross = f"_{on}"
    marked = fact.withColumn(cross, F.coalesce(F.col(on), F.lit(sentinel)))
    known = None if hot is None or on not in hot else {cross: hot[on]}
    return lookup(marked, dim.withColumnRenamed(on, cross), cross, values, hot=known, **limits).drop(cross)


def _stored(df: DataFrame, folder: str) -> DataFrame:
    df.write.option("compression", "zstd").parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def _slices(spark: SparkSession, names: Sequence[str]) -> list[list[str]]:
    """Data files in up to ``SLICES`` groups of about equal bytes."""
    paths = [spark._jvm.org.apache.hadoop.fs.Path(spark._jvm.java.net.URI(name)) for name in sorted(names)]
    files = [(p.toString(), p.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(p).getLen()) for p in paths]
    total, groups, before = sum(size for _, size in files), {}, 0
    count = max(1, min(SLICES, -(-total // SLICE_BYTES)))
    for name, size in files:
        # the middle of a file says which slice has it
        groups.setdefault(min(count - 1, (2 * before + size) * count // (2 * total) if total else 0), []).append(name)
        before += size
    return list(groups.values())


Step = Callable[[DataFrame, Sequence[Grouping], Hot], DataFrame]


def keyed_pieces(
    fact: DataFrame, dims: Sequence[Grouping], step: Step, folder: str, sentinel: Mapping[str, Any] | None = None, **limits: int
) -> Iterator[DataFrame]:
    """``step`` of a fact that is the rows of a table, of the dimensions and of the frequent values of those too large to broadcast;
    ``step`` treats every fact row by itself.

    If Spark broadcasts all dimensions, that is one piece. Else it is one for each slice of the table's files, and the columns taken
    from the dimensions are written once to ``folder``. A piece is to be written before the next one is asked for.
    """
    spark, most = fact.sparkSession, limits.get("broadcast_bytes", BROADCAST_BYTES)
    narrow = [(dim.select(on, *values), on, values) for dim, on, values in dims]
    large = [not fits_broadcast(dim, most) for dim, _, _ in narrow]
    slices = _slices(spark, fact.inputFiles())
    if not any(large) and (len(slices) < 2 or all(fits_broadcast(dim, broadcast_threshold(spark)) for dim, _, _ in narrow)):
        yield step(fact, dims, {})
        return
    with shuffles_released(spark):
        known = [(_stored(dim, f"{folder}/dim{k}"), on, values) for k, (dim, on, values) in enumerate(narrow)]
        spread = [d for d, big in zip(known, large) if big]
        hot = with_hot_keys(fact, spread, sentinel=sentinel, **(limits | {"broadcast_bytes": 0})) if spread else {}
    for files in slices or [[]]:
        yield step(spark.read.schema(fact.schema).parquet(*files) if files else fact, known, hot)
    for k in range(len(known)):
        _remove(spark, f"{folder}/dim{k}")


def spread_in_slices(
    fact: DataFrame, dims: Sequence[Grouping], step: Step, folder: str | None = None, sentinel: Mapping[str, Any] | None = None, **limits: int
) -> DataFrame:
    """``step`` of any fact and its dimensions, as one DataFrame.

    If all dimensions are left to Spark, that is all. Else the fact is written once to ``folder`` and taken in pieces (see
    ``keyed_pieces``); each piece is written, and what it shuffled goes, before the next one. The result is read from ``folder``.
    """
    if all(fits_broadcast(dim.select(on, *values), limits.get("broadcast_bytes", BROADCAST_BYTES)) for dim, on, values in dims):
        return step(fact, dims, {})
    spark = fact.sparkSession
    if folder is None:
        ensure_checkpoint_dir(spark)
        folder = f"{spark.sparkContext.getCheckpointDir()}/slices-{uuid.uuid4().hex}"
    done: list[DataFrame] = []
    with shuffles_released(spark):
        rows = _stored(fact, f"{folder}/rows")
        for piece in keyed_pieces(rows, dims, step, folder, sentinel, **limits):
            done.append(_stored(piece, f"{folder}/done{len(done)}"))
            for name in piece.inputFiles():
                path = spark._jvm.org.apache.hadoop.fs.Path(spark._jvm.java.net.URI(name))
                if path.getParent().getName() == "rows":
                    _remove(spark, path.toString())
    _remove(spark, f"{folder}/rows")
    return spark.read.schema(done[0].schema).parquet(*(f"{folder}/done{k}" for k in range(len(done))))


def _remove(spark: SparkSession, path: str) -> None:
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    found.getFileSystem(spark._jsc.hadoopConfiguration()).delete(found, True)


def semi(fact: DataFrame, allowed: DataFrame, on: str, **limits: int) -> DataFrame:
    """Fact rows whose key is among the allowed ones; the hot-key rules of ``lookup`` apply."""
    allowed = allowed.select(on).distinct().withColumn("_allowed", F.lit(True))
    return lookup(fact, allowed, on, ["_allowed"], **limits).filter("_allowed").select(*fact.columns)


def left_on(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    return left.join(right, list(keys), "left")


def inner_on(left: DataFrame, right: DataFrame, keys: Sequence[str] | str) -> DataFrame:
    return left.join(right, keys, "inner")


def star(fact: DataFrame, dims: Sequence[Grouping]) -> DataFrame:
    """Dimension attributes beside a fact that is already summed on its keys.

    Rows without a match stay, with NULL attributes.
    """
    for dim, on, attributes in dims:
        fact = left_on(fact, dim.select(on, *attributes), [on])
    return fact


def orphan_counts(df: DataFrame, col: str, dim: DataFrame, key: str) -> DataFrame:
    """Values of ``col`` absent from the dimension and their row counts; NULL is not a value.

    The fact is counted per value first, so the anti join sees each value once.
    """
    values = df.filter(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("filas"))
    return values.join(dim.select(F.col(key).alias(col)), col, "left_anti")


def orphans(df: DataFrame, col: str, dim: DataFrame, key: str) -> DataFrame:
    """One row: how many fact rows and how many distinct values have no dimension row."""
    return orphan_counts(df, col, dim, key).agg(
        F.coalesce(F.sum("filas"), F.lit(0)).alias("filas"), F.count(F.lit(1)).alias("valores")
    )


def orphan_keys(df: DataFrame, col: str, dim: DataFrame, key: str) -> DataFrame:
    """Distinct values with no dimension row, NULL included."""
    return df.select(col).distinct().join(dim.select(F.col(key).alias(col)), col, "left_anti")


def uncovered(dim: DataFrame, fact: DataFrame, key: str) -> DataFrame:
    """Dimension rows that no fact row uses."""
    return dim.join(fact.select(key).distinct(), key, "left_anti")


def review_flag(*keys: str) -> Column:
    """True when any of the looked-up keys is missing."""
    flag = F.lit(False)
    for key in keys:
        flag = flag | F.col(key).isNull()
    return flag
