"""Connected components of an edge table by alternating star contraction.

Every round replaces a vertex's edges by edges to its least neighbour (first
towards larger neighbours, then towards smaller ones); the table ends as stars
around each component's least vertex.  Rounds grow with the logarithm of the
component size; each is written to the checkpoint folder.  Nothing is
collected but a count and a checksum.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from convforge.llm.common import written


def _checksum(edges: DataFrame) -> tuple:
    r = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).head()
    return tuple(r)


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """``edges`` (u, v) of bigint vertices -> (v, root) for every vertex that is
    not its component's least; loops and repeated edges are harmless.  Raises if
    ``max_rounds`` are too few."""
    e = written(edges.where("u <> v").select(F.greatest("u", "v").alias("u"),
                                             F.least("u", "v").alias("v")).distinct(), "cc")
    state = _checksum(e)
    for _ in range(max_rounds):
        if not state[0]:
            return e.select(F.col("u").alias("v"), F.col("v").alias("root"))
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        large = (both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .distinct())
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        pairs = large.join(least, "u")
        small = (pairs.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(least.select("u", F.col("m").alias("v"))).distinct())
        e = written(small, "cc")
        now = _checksum(e)
        if now == state:
            return e.select(F.col("u").alias("v"), F.col("v").alias("root"))
        state = now
    raise RuntimeError(f"components are not complete after {max_rounds} rounds")
