"""Embedding near-duplicates: Euclidean p-stable hashing, then exact cosine.

Normalised vectors are projected on Gaussian directions, and each projection is shifted and cut into cells
of width ``WIDTH``; ``HASHES`` cells together are a bucket of one table, and there are ``TABLES`` tables.
Cosine 0.95 is a distance of 0.32 between unit vectors, which share a bucket of some table with
probability 0.93, those of cosine 0.98 with 0.997; unrelated vectors share one in 1 of 24,000 cases a table.

Equal vectors are one class from the start. A bucket is cut into blocks by a hash of the class, and every pair of its blocks is compared by matrix products of
``STRIPE`` rows at a time, so a bucket with a large share of the rows is many tasks; a vector goes to each block of its
bucket, one for ``BLOCK`` classes. Blocks return link counts and a spanning set of links per block, never all pairs. A
pair that meets in several tables counts in the first.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .common import checkpointed
from .components import components

TABLES, HASHES, WIDTH, SEED = 16, 14, 2.0, 11
BLOCK, STRIPE = 2048, 128


def usable(vector: str) -> Column:
    """Neither null, empty or zero, nor with a null or non-finite component."""
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    return F.coalesce(F.forall(vector, finite) & F.exists(vector, lambda x: x != 0), F.lit(False))


def unit(rows: np.ndarray) -> np.ndarray:
    scaled = rows / np.abs(rows).max(axis=1, keepdims=True)
    return scaled / np.linalg.norm(scaled, axis=1, keepdims=True)


def bucket_codes(rows: np.ndarray) -> np.ndarray:
    """A 64-bit code per row and table; vectors of other lengths get others."""
    size = rows.shape[1]
    rng = np.random.default_rng([SEED, size])
    directions, shifts = rng.standard_normal((size, TABLES * HASHES)), rng.uniform(0, WIDTH, TABLES * HASHES)
    cells = np.floor((unit(rows) @ directions + shifts) / WIDTH).astype(np.int64).reshape(-1, TABLES, HASHES)
    mix = rng.integers(1, 1 << 62, HASHES, dtype=np.int64) | 1
    return (cells * mix).sum(axis=2) ^ np.int64(size)


def _codes(vector: Column) -> Column:
    @F.pandas_udf("array<long>")
    def of(vectors: pd.Series) -> pd.Series:
        out = pd.Series([None] * len(vectors), dtype=object)
        sizes = vectors.map(len)
        for size in sizes.unique():
            at = np.flatnonzero(sizes == size)
            codes = bucket_codes(np.stack(vectors.iloc[at].to_list()).astype(np.float64))
            for i, row in zip(at, codes):
                out.iat[i] = row
        return out

    return of(vector)


def _close_pairs(a: np.ndarray, b: np.ndarray, start: int, same: bool, codes_a: np.ndarray, codes_b: np.ndarray, least: float) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of rows that are close and share no code; within one block, each once. ``a`` begins at row ``start`` of its block."""
    close = a @ b.T >= least
    x, y = np.nonzero(np.triu(close, start + 1) if same else close)
    for mine, other in zip(codes_a.T, codes_b.T):
        if not len(x):
            break
        first = mine[x] != other[y]
        x, y = x[first], y[first]
    return x, y


def _roots(count: int, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Of each of ``count`` rows the first that it is linked to, over any number of links."""
    root = np.arange(count)
    while True:
        before = root.copy()
        low = np.minimum(root[x], root[y])
        np.minimum.at(root, x, low)
        np.minimum.at(root, y, low)
        root = root[root]
        if (root == before).all():
            return root


def _block_links(units: np.ndarray, many: np.ndarray, codes: np.ndarray, left: np.ndarray, right: np.ndarray, same: bool, least: float) -> tuple[np.ndarray, np.ndarray]:
    """Of each row its links, and the first row that it is linked to over any number of them."""
    count = len(units)
    links, root, rows = np.zeros(count), np.arange(count), np.arange(count)
    b, codes_b = units[right], codes[right]
    for start in range(0, len(left), STRIPE):
        at = left[start : start + STRIPE]
        x, y = _close_pairs(units[at], b, start, same, codes[at], codes_b, least)
        if len(x):
            x, y = at[x], right[y]
            links += np.bincount(x, many[y], count) + np.bincount(y, many[x], count)
            root = _roots(count, np.concatenate([x, rows]), np.concatenate([y, root]))
    return links, root


_OUT = pa.schema([("cls", pa.int64()), ("links", pa.int64()), ("root", pa.int64())])


def _compare(least: float):
    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            rows = pa.Table.from_batches([batch])
            rows = pa.concat_tables([held, rows]).combine_chunks() if held is not None else rows
            keys = np.column_stack([rows[c].to_numpy() for c in ("code", "table", "i", "j")])
            cuts = np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1
            last = int(cuts[-1]) if len(cuts) else 0
            yield from blocks(rows.slice(0, last), cuts)
            held = rows.slice(last)
        if held is not None:
            yield from blocks(held, np.array([held.num_rows]))

    def blocks(rows: pa.Table, cuts: np.ndarray) -> Iterator[pa.RecordBatch]:
        if not rows.num_rows:
            return
        flat = lambda c: rows[c].combine_chunks()
        vectors, sizes = flat("vector"), np.diff(flat("vector").offsets.to_numpy())
        values = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
        starts = np.cumsum([0, *sizes])
        codes = flat("codes").flatten().to_numpy().reshape(rows.num_rows, -1)
        cls, many, mine, table, i, j = (rows[c].to_numpy() for c in ("cls", "many", "mine", "table", "i", "j"))
        found = []
        for lo, hi in zip([0, *cuts], [*cuts, rows.num_rows]):
            if hi - lo < 2 or (sizes[lo:hi] != sizes[lo]).any():  # another length here would be a hash collision
                continue
            units = unit(values[starts[lo] : starts[hi]].reshape(hi - lo, -1))
            left, right = np.flatnonzero(mine[lo:hi] == i[lo]), np.flatnonzero(mine[lo:hi] == j[lo])
            links, root = _block_links(units, many[lo:hi], codes[lo:hi, : int(table[lo])], left, right, i[lo] == j[lo], least)
            at = np.flatnonzero(links)
            found.append((cls[lo:hi][at], links[at].astype(np.int64), cls[lo:hi][root[at]]))
        if found:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*found)], schema=_OUT)

    return of


def placed(hashed: DataFrame) -> DataFrame:
    """Each class with every pair of blocks, ``i`` and ``j``, in which it is compared; ``mine`` is its own block."""
    thin = hashed.select("cls", F.posexplode("codes").alias("table", "code"))
    full = thin.groupBy("table", "code").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    cut = F.ceil(F.col("n") / BLOCK).cast("int")
    rows = thin.join(full, ["table", "code"]).select("cls", "table", "code", cut.alias("cut"), F.pmod(F.xxhash64("cls"), cut).cast("int").alias("mine"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("cut") - 1)))
    return rows.select("cls", "table", "code", "mine", F.least("mine", "other").alias("i"), F.greatest("mine", "other").alias("j"))


def near_vectors(rows: DataFrame, key: str = "vec_id", vector: str = "embedding", least: float = 0.95) -> DataFrame:
    """``key``, ``n_links``, ``component_id``, ``kept`` for each row.

    A vector that is null, empty, zero or holds null or non-finite components links with nothing and is kept. Vectors
    of different length never link. Rows count as vectors, also if their key repeats or is null;
    ``component_id`` is null only if no key of the group is known. Other columns are not carried.
    """
    known = rows.select(F.col(key).alias("key"), F.col(vector).alias("vector"))
    classes = known.filter(usable("vector")).groupBy("vector").agg(F.min("key").alias("least"), F.count(F.lit(1)).alias("many"))
    classes = checkpointed(classes.withColumn("cls", F.monotonically_increasing_id()))
    hashed = checkpointed(classes.select("cls", "many", "vector", _codes(F.col("vector")).alias("codes")))
    dealt = placed(hashed).join(hashed, "cls").repartition("table", "code", "i", "j").sortWithinPartitions("table", "code", "i", "j")
    dealt = dealt.select("code", "table", "i", "j", "mine", "cls", "many", "vector", "codes")
    met = checkpointed(dealt.mapInArrow(_compare(least), "cls long, links long, root long").groupBy("cls", "root").agg(F.sum("links").alias("links")))
    links = met.groupBy("cls").agg(F.sum("links").alias("links"))
    roots = components(met.select("cls", "root"), "cls", "root").select(F.col("vertex").alias("cls"), "root")
    joined = classes.join(links, "cls", "left").join(roots, "cls", "left").withColumn("root", F.coalesce("root", "cls"))
    joined = joined.select("vector", "least", "root", (F.coalesce("links", F.lit(0)) + F.col("many") - 1).alias("n_links"))
    joined = joined.join(joined.groupBy("root").agg(F.min("least").alias("component_id")), "root").select("vector", "n_links", "component_id", F.lit(True).alias("in"))
    told = known.join(joined, "vector", "left")
    component = F.when(F.col("in"), F.col("component_id")).otherwise(F.col("key"))
    return told.select(F.col("key").alias(key), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.col("key").eqNullSafe(component).alias("kept"))
