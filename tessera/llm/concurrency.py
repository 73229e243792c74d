"""Peak concurrency of open intervals, by key (operator 13).

Times are whole numbers; an interval is open from its start (included) to its end (excluded), a null end never comes.
Equal intervals are added up first. Buckets are ranges of time, cut at percentiles of the moments at which anything
changes, so that each has about as many moments. A contingency table counts each key's intervals by bucket of start
and bucket of end; its two-dimensional prefix sums P give what is open when a bucket b begins: P[b - 1, all] minus
P[b - 1, b - 1], the intervals that began in an earlier bucket and end in b or later. Each bucket of each key is then
swept on its own, from its snapshot. What goes over a bucket's border after that, the largest count before it and the
next moment behind it, is one row a bucket.

So no task gets more than one bucket of one key, or one key's table of at most `buckets` squared cells; the driver gets
the borders alone. A key that holds a third of all rows is added up before it is shuffled, and is swept in all its
buckets at once.

Defined cases: intervals without a start, or whose end is not after it, take no part; a null amount counts 0; equal rows
count each; a null key is a key of its own; an empty table gives no rows. Moments at which what begins and what ends
leave both count and amount as they were are no rows. Other columns are not read, whatever their names.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import discard, materialize
from tessera.llm.ranges import number, percentiles

#: Buckets of time, at most.
BUCKETS = 128


def minutes(at: Column) -> Column:
    """Seconds since 1970 of a time without a zone, rounded down to whole minutes."""
    return F.unix_date(F.to_date(at)).cast("long") * 86_400 + F.hour(at) * 3_600 + F.minute(at) * 60


def snapshots(key_type: str, last: int):
    """What is open as each bucket 1 .. last begins, of one key's contingency table; ends that never come have bucket last + 1."""

    def run(table: pa.Table) -> pa.Table:
        began, ended = (table[c].to_numpy() for c in ("began", "ended"))
        out = []
        for c in ("n", "amount"):
            cells = np.zeros((last + 2, last + 2), np.int64)
            np.add.at(cells, (began, ended), table[c].to_numpy())
            prefix = cells.cumsum(0).cumsum(1)
            before = np.arange(last)
            out.append(prefix[before, -1] - prefix[before, before])
        some = np.flatnonzero((out[0] != 0) | (out[1] != 0))
        key = pa.array(table["key"].slice(0, 1).to_pylist() * len(some), table.schema.field("key").type)
        return pa.table({"key": key, "bucket": pa.array((some + 1).astype(np.int32)), "n": out[0][some], "amount": out[1][some]})

    return run, f"key {key_type}, bucket int, n long, amount long"


def sweep(spans: DataFrame, key: str = "key", start: str = "start", end: str = "end", amount: str = "amount", buckets: int = BUCKETS) -> DataFrame:
    """(key, from_s, to_s, n_open, open_amount, high_open, is_peak): a row per key and moment at which count or amount changes.

    to_s: the key's next such moment; high_open: its largest count so far; is_peak: the count is the largest it ever has.
    """
    rows = spans.select(F.col(key).alias("key"), F.col(start).cast("long").alias("start"), F.col(end).cast("long").alias("end"), F.coalesce(F.col(amount).cast("long"), F.lit(0)).alias("amount"))
    equal = rows.filter("start is not null and (end is null or end > start)").groupBy("key", "start", "end").agg(F.count(F.lit(1)).alias("n"), F.sum("amount").alias("amount"))
    equal = materialize(equal, "spans")
    begun = equal.select("key", F.col("start").alias("at"), "n", "amount")
    over = equal.filter("end is not null").select("key", F.col("end").alias("at"), (-F.col("n")).alias("n"), (-F.col("amount")).alias("amount"))
    moments = begun.unionByName(over).groupBy("key", "at").agg(F.sum("n").alias("n"), F.sum("amount").alias("amount")).filter("n <> 0 or amount <> 0")
    moments = materialize(moments, "moments")

    cuts = np.unique(np.array((moments.agg(percentiles("at", buckets)).first()[0] if buckets > 1 else None) or [], np.int64))
    last, bucket = len(cuts) + 1, number(cuts)
    table = equal.select("key", bucket(F.col("start")).alias("began"), F.when(F.col("end").isNull(), last + 1).otherwise(bucket(F.col("end"))).alias("ended"), "n", "amount")
    table = table.groupBy("key", "began", "ended").agg(F.sum("n").alias("n"), F.sum("amount").alias("amount"))
    opened = table.groupBy("key").applyInArrow(*snapshots(spans.schema[key].dataType.simpleString(), last))

    # a bucket's snapshot stands before its moments
    local = Window.partitionBy("key", "bucket").orderBy(F.col("at").asc_nulls_first())
    rows = moments.withColumn("bucket", bucket(F.col("at"))).unionByName(opened.withColumn("at", F.lit(None).cast("long")))
    swept = rows.withColumns({"n_open": F.sum("n").over(local), "open_amount": F.sum("amount").over(local), "next": F.lead("at").over(local)})
    swept = swept.withColumn("high", F.max("n_open").over(local)).filter("at is not null").select("key", "bucket", "at", "next", "n_open", "open_amount", "high")
    swept = materialize(swept, "swept")

    of_key = Window.partitionBy("key").orderBy("bucket")
    ends = swept.groupBy("key", "bucket").agg(F.min("at").alias("first"), F.max("high").alias("top"))
    ends = ends.select(
        F.col("key").alias("k"),
        F.col("bucket").alias("b"),
        F.lead("first").over(of_key).alias("behind"),
        F.max("top").over(of_key.rowsBetween(Window.unboundedPreceding, -1)).alias("before"),
        F.max("top").over(Window.partitionBy("key")).alias("peak"),
    )
    joined = swept.join(ends, F.col("key").eqNullSafe(F.col("k")) & (F.col("bucket") == F.col("b")))
    discard(equal, moments)
    return joined.select(
        "key",
        F.col("at").alias("from_s"),
        F.coalesce("next", "behind").alias("to_s"),
        "n_open",
        "open_amount",
        F.greatest("high", "before").alias("high_open"),
        (F.col("n_open") == F.col("peak")).alias("is_peak"),
    )


def open_sales(sales: DataFrame, lines: DataFrame, clients: DataFrame, days: int = 7) -> DataFrame:
    """(key, start, end, amount): a row per sale and nation, and again for nation -2; see `sweep`.

    A sale is open from sold_at until `days` after its latest shipment. A client that is listed more than once counts
    by the smallest nation it has; a sale of a null or unknown client, or of one without a nation, has nation -1.
    Latest shipments and clients are tables of their own, so that adaptive execution can split a client or sale that
    many rows share.
    """
    shipped = materialize(lines.filter("sale_id is not null and shipped_at is not null").groupBy("sale_id").agg(F.max("shipped_at").alias("shipped")), "shipped")
    nations = materialize(clients.filter("client_id is not null").groupBy("client_id").agg(F.min("nation_id").alias("nation")), "nations")
    cents = F.floor(F.lit(100.0) * F.col("total") + F.lit(0.5)).cast("long")
    rows = sales.filter("sold_at is not null").select("sale_id", "client_id", minutes(F.col("sold_at")).alias("start"), F.coalesce(cents, F.lit(0)).alias("amount"))
    rows = rows.join(shipped.select("sale_id", (minutes(F.col("shipped")) + days * 86_400).alias("end")), "sale_id", "left").filter("end is null or end > start")
    rows = rows.join(nations, "client_id", "left").select(F.coalesce("nation", F.lit(-1)).cast("int").alias("key"), "start", "end", "amount")
    return rows.withColumn("key", F.explode(F.array("key", F.lit(-2))))
