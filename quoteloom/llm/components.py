"""Connected components of a graph that is far larger than one machine."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import staged

MAX_ROUNDS = 200


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())


def connected(edges: DataFrame) -> DataFrame:
    """(u, root) for every node of ``edges`` (u, v: long) that isn't its component's smallest.

    Alternating large-star and small-star steps until nothing changes: about the logarithm
    of the longest path squared, in practice a handful.  Minima are aggregated before the
    shuffle and joined back, so a hub is never gathered; every round is written to the
    shared folder.
    """
    own = edges.where("u <> v")
    edges = staged(own.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    mark = _mark(edges)
    for _ in range(MAX_ROUNDS):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
        large = large.distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        own, other = F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v"))
        small = large.join(least, "u").select(F.inline(F.array(own, other)))
        edges = staged(small.where("u <> v").distinct(), "edges")
        before, mark = mark, _mark(edges)
        if before == mark:
            return edges.select("u", F.col("v").alias("root"))
    raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")
