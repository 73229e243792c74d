"""Connected components of an edge table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import discard, materialize

MAX_ROUNDS = 60


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) for every node of an edge; root is the smallest node of its component.

    Each round hangs every node's larger neighbours on its smallest neighbour, then its smaller ones; both are a
    combining minimum and an equi-join, whose large keys adaptive execution splits. Each round is a table of its
    own in the shared folder, so no lineage grows; the round before's is deleted. The rounds end when an order-free checksum stays the same.
    """
    u, v = F.col(a), F.col(b)
    now = materialize(edges.filter(u != v).select(F.greatest(u, v).alias("u"), F.least(u, v).alias("v")).distinct(), "edges")
    seen = None
    for _ in range(MAX_ROUNDS):
        mark = tuple(now.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.shiftright(F.xxhash64("v", "u"), 32))).first())
        if mark == seen or mark[0] == 0:
            return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
        seen = mark
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = materialize(large, "stars")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.when(F.col("v") != F.col("m"), F.col("v")).otherwise(F.col("u")).alias("u"), F.col("m").alias("v"))
        small = small.unionByName(least.select("u", F.col("m").alias("v"))).filter("u != v").distinct()
        last, now = now, materialize(small, "edges")
        discard(last, large)
    raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")
