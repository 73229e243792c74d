"""Even ranges of a numeric column, each in a partition of its own.

Range numbers come from a binary search over the cuts, in Arrow, on the narrow column alone; no expression grows
with the number of ranges. Range 0 has the nulls. A range is one partition: the number under which it is dealt out
is chosen so that Spark's hash puts no two ranges together.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import partitions

#: UTF-8 bytes of text in a range, about; and the least that is worth a task where shuffle partitions allow more.
RANGE_BYTES, LEAST_BYTES = 32 << 20, 1 << 20


def how_many(rows: DataFrame, text: str) -> int:
    """Ranges for the texts of rows: by their bytes; small inputs get no more than the session's shuffle partitions."""
    total = rows.agg(F.coalesce(F.sum(F.octet_length(text)), F.lit(0))).first()[0]
    return max(1, math.ceil(total / RANGE_BYTES), min(partitions(rows), math.ceil(total / LEAST_BYTES)))


def percentiles(column: str, n: int) -> Column:
    return F.percentile_approx(column, [i / n for i in range(1, n)], 20 * n)


def even_cuts(rows: DataFrame, column: str, n: int) -> np.ndarray:
    """About n - 1 ascending numbers that part the rows evenly: percentiles of percentiles, so that no sketch is larger than the root of n asks for."""
    coarse = math.isqrt(n)
    first = np.array(sorted(set((rows.agg(percentiles(column, coarse)).first()[0] if coarse > 1 else None) or [])), np.int64)
    fine = math.ceil(n / coarse)
    if fine < 2:
        return first
    inner = rows.filter(F.col(column).isNotNull()).groupBy(number(first)(F.col(column))).agg(percentiles(column, fine).alias("cuts")).collect()
    return np.array(sorted({*first.tolist(), *(c for r in inner for c in r["cuts"] or [])}), np.int64)


def number(cuts: np.ndarray):
    """Column function: the range of a number; 0 for null, else 1 and up."""

    def run(x: pa.Array) -> pa.Array:
        out = 1 + np.searchsorted(cuts, x.fill_null(0).to_numpy(zero_copy_only=False), "right")
        return pa.array(np.where(x.is_null().to_numpy(zero_copy_only=False), 0, out).astype(np.int32))

    return F.arrow_udf(run, "int")


def places(spark: SparkSession, n: int) -> list[int]:
    """For each of n partitions a number that `repartition(n, ...)` deals to it."""
    tried = spark.range(0, 24 * n + 200, 1, 8).select(F.col("id").cast("int").alias("x")).groupBy(F.pmod(F.hash("x"), F.lit(n)).alias("p")).agg(F.min("x").alias("x")).collect()
    out = {r["p"]: r["x"] for r in tried}
    return [out.get(p, p) for p in range(n)]


def place(spark: SparkSession, n: int):
    """Column function: the number under which range r is dealt to partition r modulo n."""
    at = np.array(places(spark, n), np.int32)

    def run(r: pa.Array) -> pa.Array:
        return pa.array(at[r.to_numpy(zero_copy_only=False) % n])

    return F.arrow_udf(run, "int")
