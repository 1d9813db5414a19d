"""Connected components of a link table, as joins and grouped minima.

Each round gives every vertex a random priority, joins it to its neighbour of least priority and
replaces both ends of every link by what they joined; loops and repeats go. A constant share of the
vertices goes with every round, so rounds grow with the logarithm of the largest component. Nothing but the
number of links left comes to the driver. A vertex with very many links is one row of the grouped
minima, and the joins on it are left to the adaptive skew join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .common import checkpointed


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``vertex``, ``root``: one row for each end of a link; vertices are linked through rows of equal root.

    Ends are longs. Null ends and loops link nothing. Without links the result is empty.
    """
    ends = links.select(F.col(a).cast("long").alias("a"), F.col(b).cast("long").alias("b"))
    left = checkpointed(ends.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    roots = left.select(F.explode(F.array("a", "b")).alias("vertex")).distinct().select("vertex", F.col("vertex").alias("root"))
    turn = 0
    while not left.isEmpty():
        turn += 1
        both = left.union(left.select("b", "a"))
        rank = lambda c: F.struct(F.xxhash64(F.lit(turn), F.col(c)).alias("p"), F.col(c).alias("v"))
        best = both.groupBy("a").agg(F.min(rank("b")).alias("near"))
        joins = checkpointed(best.select("a", F.least("near", rank("a"))["v"].alias("to")))
        end = lambda c: joins.select(F.col("a").alias(c), F.col("to").alias(f"{c}_to"))
        left = left.join(end("a"), "a").join(end("b"), "b").filter("a_to <> b_to")
        left = checkpointed(left.select(F.least("a_to", "b_to").alias("a"), F.greatest("a_to", "b_to").alias("b")).distinct())
        roots = checkpointed(roots.join(end("root"), "root", "left").select("vertex", F.coalesce("root_to", "root").alias("root")))
    return roots
