"""Sharding: rendezvous hashing of stable record keys over weighted shards (operator 6).

Each (key, shard) pair gets a uniform number u from XXH64 and the score weight / -ln(u); the shard with the
largest score takes the record. A new shard only adds one candidate, so it takes rows into itself and moves no
other row; removing a shard moves only that shard's rows. Everything is Column algebra inside codegen.

Slots number a shard's rows without gaps. Rows of a shard are ordered by a hash of their key and cut into hash
ranges; the counts of the ranges give each range its first slot, and a window numbers rows only inside a range,
so that no task ever sorts a whole shard.

Defined cases: a null key is a key like any other; repeated keys go to one shard and get slots of their own, in the
order of their other columns; null, empty and very long texts are columns like any other; an empty table gives an
empty result; input columns named like an output column are replaced, all other names are free.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SEED = 6
ROWS_PER_RANGE = 20_000


def best(key: Column, weights: Sequence[float], first: int = 0, seed: int = SEED) -> Column:
    """(score, shard) of the winner among the shards `first` and up, whose weights are given."""
    if not weights or min(weights) <= 0:
        raise ValueError("weights must be positive")
    text = key.cast("string")

    def score(shard: int, weight: float) -> Column:
        u = (F.shiftrightunsigned(F.xxhash64(text, F.lit(f"{seed}:{shard}")), 11) + F.lit(0.5)) / F.lit(float(1 << 53))
        return F.struct((F.lit(float(weight)) / -F.ln(u)).alias("score"), F.lit(shard).alias("shard"))

    scores = [score(first + i, w) for i, w in enumerate(weights)]
    return F.greatest(*scores) if len(scores) > 1 else scores[0]


def rendezvous(key: Column, weights: Sequence[float], seed: int = SEED) -> Column:
    """Shard number (from 0) for a key under the given shard weights."""
    return best(key, weights, 0, seed)["shard"]


def shard_records(docs: DataFrame, key: str, weights: Sequence[float], shard: str = "shard", slot: str = "slot", grown: str | None = None, seed: int = SEED) -> DataFrame:
    """All rows and columns of docs with their shard and their slot in it (from 0, without gaps).

    grown: name of a column for the shard that one more shard, of the last one's weight, would give; the winner so
    far only meets the new shard's score.
    """
    n = docs.select(key).count()
    bits = max(0, math.ceil(math.log2(max(1, n / len(weights) / ROWS_PER_RANGE))))
    kept = docs.drop(shard, slot, *([grown] if grown else []))
    h = F.xxhash64(F.col(key).cast("string"), F.lit(f"{seed}:slot"))
    range_ = F.shiftright(h, 64 - bits) if bits else F.lit(0).cast("long")
    won = best(F.col(key), weights, 0, seed)
    # the columns of docs are nested meanwhile, so that their names cannot clash
    placed = kept.select(F.struct("*").alias("row"), won.alias("won"), best(F.col(key), [weights[-1]], len(weights), seed).alias("new"), h.alias("h"), range_.alias("range")).select("row", F.col("won.shard").alias("s"), *([F.greatest("won", "new")["shard"].alias("grown")] if grown else []), "h", "range")
    counts = docs.select(won["shard"].alias("s"), range_.alias("range")).groupBy("s", "range").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("s").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    first = counts.select("s", "range", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    if (len(weights) << bits) <= 100_000:
        first = F.broadcast(first)
    tie = [c for c, kind in kept.dtypes if kind in ("string", "bigint", "int", "double", "float", "boolean", "date", "timestamp") and c != key]
    inside = Window.partitionBy("s", "range").orderBy("h", *(F.col("row")[c] for c in (key, *sorted(tie))))
    out = placed.join(first, ["s", "range"])
    return out.withColumn("slot", F.col("first") + F.row_number().over(inside) - 1).select("row.*", F.col("s").alias(shard), F.col("slot").alias(slot), *([F.col("grown").alias(grown)] if grown else []))
