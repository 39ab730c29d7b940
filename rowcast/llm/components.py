"""Connected components of an edge table by alternating large and small stars.

Each round hangs every neighbour on the smallest one it can see; the edge count
never grows, and no vertex's neighbours meet in one place: a round is a grouped
minimum (summed before the shuffle) and a join back, which Spark splits where a
vertex has very many edges.  Every round is a table in the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written

MAX_ROUNDS = 60


def _large(e: DataFrame) -> DataFrame:
    both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")


def _small(e: DataFrame) -> DataFrame:
    least = e.groupBy("u").agg(F.min("v").alias("m"))
    moved = e.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(v, root) for every vertex of ``edges`` (columns u, v): the smallest
    vertex that it reaches.  Loops and repeated edges change nothing."""
    e = written(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v").distinct(), "edges")
    before = None
    for _ in range(MAX_ROUNDS):
        e = written(_small(_large(e)), "edges")
        now = e.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first()
        if tuple(now) == before:
            break
        before = tuple(now)
    else:
        raise RuntimeError("the components don't settle")
    return e.select(F.col("u").alias("v"), F.col("v").alias("root")).unionByName(
        e.select("v", F.col("v").alias("root")).distinct())
