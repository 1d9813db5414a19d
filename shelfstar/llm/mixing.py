"""Mixing sources to target weights by capped water-filling. DataFrame operations only.

Every source asks for its share of all words by weight, but gives at most ``max_epochs`` times its own. What
capped sources can't take is dealt to the others by weight, until none is above its cap. A source is
then taken whole as often as its target holds it, and the rest is filled with its documents in a seeded order.

That order is cut in 4,096 slices of a hash per source. Slices are summed first, and only the slice in which
the fractional repetition ends is put in order, so no task holds a source.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import shuffle_partitions
from .common import checkpointed, whole

WORD = r"[^\x20\x09-\x0D]+"
_EXACT = "decimal(38,0)"
_SLICE_BITS = 12
SEED = 7
#: A plan of so many sources at most is broadcast (some 50 bytes each); a longer one is joined by shuffle.
BROADCAST_SOURCES = 100_000


def word_count(text: str) -> Column:
    return F.regexp_count(whole(text), F.lit(WORD)).cast("long")


def ranked(sources: DataFrame) -> DataFrame:
    """``place``: 0, 1, ... by code point, null last. Numbered in ordered pieces and not in one task."""
    order = F.col("source").asc_nulls_last()
    pieces = checkpointed(sources.repartitionByRange(shuffle_partitions(sources.sparkSession), order).withColumn("piece", F.spark_partition_id()))
    sizes = pieces.groupBy("piece").agg(F.count(F.lit(1)).alias("many"))
    before = F.sum("many").over(Window.orderBy("piece").rowsBetween(Window.unboundedPreceding, -1))
    starts = sizes.select("piece", F.coalesce(before, F.lit(0)).alias("start"))
    within = F.row_number().over(Window.partitionBy("piece").orderBy(order))
    return pieces.withColumn("within", within).join(starts, "piece").withColumn("place", F.col("start") + F.col("within") - 1).drop("piece", "within", "start")


def targets(sources: DataFrame, weights: tuple[int, ...] = (5, 2, 1), max_epochs: int = 3) -> DataFrame:
    """``source``, ``source_size`` with ``target`` (double) added; weights repeat over the sources by code point.

    Rounds of water-filling are exact integer sums over the sources; only those sums come to the driver.
    """
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("place") % len(weights) + 1).cast("int"))
    asked = checkpointed(ranked(sources).select("source", "source_size", weight.cast(_EXACT).alias("w"), (F.col("source_size") * max_epochs).cast(_EXACT).alias("cap")))
    words, parts = asked.agg(F.sum("source_size"), F.sum("w")).first()
    if parts is None:
        return asked.select("source", "source_size", F.lit(0.0).alias("target"))
    words, left, parts, capped = int(words), int(words), int(parts), 0
    while True:
        number = lambda n: F.lit(str(n)).cast(_EXACT)
        above = F.col("cap") * number(parts) < F.col("w") * number(left)
        now, held, free = asked.agg(F.count_if(above), F.sum(F.when(above, F.col("cap"))), F.sum(F.when(~above, F.col("w")))).first()
        if now == capped:
            break
        capped, left, parts = now, words - int(held), int(free)
    share = (F.col("w") * number(left)).cast("double") / F.lit(float(parts))
    return asked.select("source", "source_size", F.when(above, F.col("cap").cast("double")).otherwise(share).alias("target"))


@dataclass(frozen=True)
class Columns:
    key: str = "doc_id"
    text: str = "text"
    source: str = "source"

    def draw(self, seed: int) -> Column:
        """A seeded number of 60 bits for each row, from its key and text; nulls count as empty."""
        parts = F.coalesce(F.col(self.key).cast("string"), F.lit("")), F.md5(whole(self.text))
        return F.conv(F.substring(F.md5(F.concat_ws("|", F.lit(str(seed)), *parts)), 1, 15), 16, 10).cast("long")

    def named(self) -> Column:
        """The source as a join key that is never null."""
        return source_name(F.col(self.source))


def source_name(source: Column) -> Column:
    return F.coalesce(F.concat(F.lit("s"), source), F.lit("n"))


def plan(base: DataFrame, weights: tuple[int, ...] = (5, 2, 1), max_epochs: int = 3) -> DataFrame:
    """A row per source: ``named``, ``source_size``, ``target``, ``epochs`` (whole repetitions) and ``last``: rows
    whose ``draw`` is up to it are in the fractional repetition. ``base`` is what ``drawn`` gives."""
    slices = checkpointed(base.groupBy("named", "slice").agg(F.first("source").alias("source"), F.sum("size").alias("words")))
    sources = slices.groupBy("named").agg(F.first("source").alias("source"), F.sum("words").alias("source_size"))
    filled = targets(sources.select("source", "source_size"), weights, max_epochs)
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0)).cast("int")
    filled = filled.select(source_name(F.col("source")).alias("named"), "source_size", "target", epochs.alias("epochs"))
    filled = checkpointed(filled.withColumn("rest", F.col("target") - F.col("epochs") * F.col("source_size")))
    before = F.sum("words").over(Window.partitionBy("named").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1))
    starts = slices.select("named", "slice", "words", F.coalesce(before, F.lit(0)).alias("start")).join(filled.select("named", "rest"), "named")
    # only the slice in which the fractional repetition ends needs the order of its documents
    ends = starts.filter("start + words > rest").groupBy("named").agg(F.min_by(F.struct("slice", "start", "rest"), "slice").alias("at")).select("named", "at.*")
    # rows of one draw (repeats of a row) are taken alike, so they are one entry of that order
    order = Window.partitionBy("named").orderBy("draw").rowsBetween(Window.unboundedPreceding, -1)
    inside = base.select("named", "slice", "draw", "size").join(ends, ["named", "slice"])
    inside = inside.groupBy("named", "draw", "start", "rest").agg(F.sum("size").alias("words"), F.min("size").alias("size"))
    ahead = F.coalesce(F.sum("words").over(order), F.lit(0))
    # a document is in if its middle is: what is taken misses the target by about half a document
    middle = F.col("start") + F.col("ahead") + F.col("size") / 2
    last = inside.withColumn("ahead", ahead).filter(middle <= F.col("rest")).groupBy("named").agg(F.max("draw").alias("last"))
    floor = F.shiftleft(F.col("slice").cast("long"), 60 - _SLICE_BITS) - 1
    told = ends.select("named", floor.alias("floor")).join(last, "named", "left").select("named", F.coalesce("last", "floor").alias("last"))
    return checkpointed(filled.join(told, "named", "left").select("named", "source_size", "target", "epochs", F.coalesce("last", F.lit(1 << 60)).alias("last")))


def drawn(docs: DataFrame, columns: Columns, seed: int) -> DataFrame:
    base = docs.select(F.col(columns.key).alias("key"), F.col(columns.source).alias("source"), columns.named().alias("named"), word_count(columns.text).alias("size"), columns.draw(seed).alias("draw"))
    return checkpointed(base.withColumn("slice", F.shiftright("draw", 60 - _SLICE_BITS).cast("int")))


def with_plan(rows: DataFrame, planned: DataFrame, name: str = "named") -> DataFrame:
    """``rows`` joined to their source's row of the plan, which is broadcast if it has few rows."""
    small = planned.count() <= BROADCAST_SOURCES
    return rows.join(F.broadcast(planned) if small else planned, name)


def mix(docs: DataFrame, columns: Columns = Columns(), weights: tuple[int, ...] = (5, 2, 1), max_epochs: int = 3, seed: int = SEED) -> DataFrame:
    """Key, ``size``, ``source_size``, ``target``, ``taken`` for each row of ``docs``.

    ``taken`` is in words: whole repetitions of the document, and one more for those that the seeded order
    puts into the fractional one. A null source is one source, a null or empty text has size 0 and is taken
    with 0 words. Rows of equal key and text are taken alike. Other columns of ``docs`` are not carried.
    """
    base = drawn(docs, columns, seed)
    times = F.col("epochs") + F.when(F.col("draw") <= F.col("last"), 1).otherwise(0)
    joined = with_plan(base, plan(base, weights, max_epochs))
    return joined.select(F.col("key").alias(columns.key), "size", "source_size", "target", (F.col("size") * times).cast("long").alias("taken"))


def repeat(docs: DataFrame, columns: Columns = Columns(), weights: tuple[int, ...] = (5, 2, 1), max_epochs: int = 3, seed: int = SEED) -> DataFrame:
    """The mix itself: each row of ``docs``, all columns, as often as it is taken; not at all up to ``max_epochs`` times."""
    planned = plan(drawn(docs, columns, seed), weights, max_epochs)
    row = F.struct(*(docs[c].alias(f"c{i}") for i, c in enumerate(docs.columns)))
    rows = docs.select(row.alias("row"), columns.named().alias("named"), columns.draw(seed).alias("draw"))
    # a text without a word weighs nothing in a fractional repetition, and still comes max_epochs times at most
    times = F.least(F.col("epochs") + F.when(F.col("draw") <= F.col("last"), 1).otherwise(0), F.lit(max_epochs))
    taken = with_plan(rows, planned).select("row", times.alias("times")).filter("times > 0")
    copies = taken.select("row", F.explode(F.sequence(F.lit(1), F.col("times"))).alias("copy"))
    return copies.select(*(F.col(f"row.c{i}").alias(c) for i, c in enumerate(docs.columns)))
