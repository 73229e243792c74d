"""Relational operators by name: top rows, anti and semi joins, snapshots, batches."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.operators.graph import written


def top_n_per_group(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int) -> DataFrame:
    """The first n rows of each group; the row number is compared right away, so the sort is limited before the shuffle."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("__rn", F.row_number().over(w)).filter(F.col("__rn") <= n).drop("__rn")


def last_row_wins(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row a key: the largest by `order`, as a hash aggregate without a sort."""
    rest = [c for c in df.columns if c not in keys]
    best = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(*(F.col(c) for c in order), *(F.col(c) for c in rest if c not in order))).alias("__row"))
    return best.select(*keys, *(F.col("__row")[c].alias(c) for c in rest)).select(*df.columns)


def not_in(df: DataFrame, column: str, allowed: DataFrame, code: str) -> DataFrame:
    """Rows whose non-null value is no row of `allowed`; a plain anti join, nulls kept out before it."""
    return df.filter(F.col(column).isNotNull()).join(allowed.select(F.col(code).alias(column)).filter(F.col(column).isNotNull()), column, "left_anti")


def upsert(old: DataFrame, new: DataFrame, keys: Sequence[str], version: str, keep_first: Sequence[str] = (), survive: Sequence[str] = ()) -> DataFrame:
    """The snapshot after new rows are merged into the old: the latest version of a key wins, new before old.

    keep_first: columns that keep their least value; survive: columns of the old row that new rows don't touch.
    """
    both = old.withColumn("__new", F.lit(0)).unionByName(new.withColumn("__new", F.lit(1)))
    rest = [c for c in old.columns if c not in keys]
    best = both.groupBy(*keys).agg(
        F.max_by(F.struct(*rest), F.struct("__new", version, *(c for c in rest if c != version))).alias("__row"),
        *(F.min(c).alias(f"__first_{c}") for c in keep_first),
        *(F.max(F.when(F.col("__new") == 0, F.col(c))).alias(f"__old_{c}") for c in survive),
    )

    def value(c: str) -> Column:
        if c in keep_first:
            return F.col(f"__first_{c}")
        return F.coalesce(f"__old_{c}", F.col("__row")[c]) if c in survive else F.col("__row")[c]

    return best.select(*keys, *(value(c).alias(c) for c in rest)).select(*old.columns)


def insert_if_absent(old: DataFrame, new: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Old rows, and the first new row of each key that the old ones lack."""
    rest = [c for c in new.columns if c not in keys]
    first = new.join(old.select(*keys), list(keys), "left_anti").groupBy(*keys).agg(F.min_by(F.struct(*rest), F.struct(*order, *(c for c in rest if c not in order))).alias("__row"))
    return old.unionByName(first.select(*keys, *(F.col("__row")[c].alias(c) for c in rest)))


def replace_children(children: DataFrame, new: DataFrame, parent: str) -> DataFrame:
    """Delete and insert: all children of the parents in `new` are replaced."""
    return children.join(new.select(parent).distinct(), parent, "left_anti").unionByName(new)


def update_by_key(df: DataFrame, changes: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keyed update: columns of `changes` overwrite, in rows that it has."""
    columns = [c for c in changes.columns if c not in keys]
    renamed = changes.select(*keys, F.lit(True).alias("__hit"), *(F.col(c).alias(f"__{c}") for c in columns))
    joined = df.join(renamed, list(keys), "left")
    return joined.select(*(F.when(F.col("__hit"), F.col(f"__{c}")).otherwise(F.col(c)).alias(c) if c in columns else F.col(c) for c in df.columns))


def drop_orphans(parents: DataFrame, children: DataFrame, key: str) -> DataFrame:
    """Parents that some child names."""
    return parents.join(children.select(key).distinct(), key, "left_semi")


def incremental(df: DataFrame, done: str, changed: str) -> DataFrame:
    """Rows never done, or changed since."""
    return df.filter(F.col(done).isNull() | (F.col(done) < F.col(changed)))


def fresh_split(known: DataFrame, listed: DataFrame, key: str, seen: str, now: Column, days: int = 7) -> tuple[DataFrame, DataFrame]:
    """Listed keys that are known and fresh (to be touched), and the others (to be fetched)."""
    fresh = known.filter(F.col(seen) > now - F.expr(f"INTERVAL {days} DAYS")).select(key)
    return listed.join(fresh, key, "left_semi"), listed.join(fresh, key, "left_anti")


def age_window(df: DataFrame, day: Column, today: Column, days: int = 60) -> DataFrame:
    """Rows of the last `days` days; rows without a day stay."""
    age = F.datediff(today, day)
    return df.filter(age.isNull() | (age <= days))


def until_streak(df: DataFrame, group: Sequence[str], order: Sequence[str], bad: Column, streak: int = 30) -> DataFrame:
    """Rows of each group up to the end of its first run of `streak` bad rows in a row; the stream order is the group's."""
    w = Window.partitionBy(*group).orderBy(*order)
    up_to = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    counted = df.withColumn("__bad", bad.cast("int")).withColumn("__run", F.sum(1 - F.col("__bad")).over(up_to))
    in_run = Window.partitionBy(*group, "__run").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    counted = counted.withColumn("__long", (F.sum("__bad").over(in_run) >= streak).cast("int"))
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    return counted.withColumn("__over", F.coalesce(F.max("__long").over(before), F.lit(0))).filter("__over = 0").drop("__bad", "__run", "__long", "__over")


def in_ranges(df: DataFrame, group: Sequence[str], order: Sequence[str]) -> DataFrame:
    """df with its rows dealt into ranges of (group, order), numbered in that order by `__range`.

    A group of any size lies in as many ranges as it fills; what has to be known of the order across ranges is then
    summed up by range. Ranges come from a sample: write the result before it is read twice.
    """
    return df.repartitionByRange(*group, *order).withColumn("__range", F.spark_partition_id())


def until_streak_in_ranges(df: DataFrame, group: Sequence[str], order: Sequence[str], bad: Column, streak: int = 30) -> DataFrame:
    """`until_streak` for groups of any size: no window holds more than one range of a group.

    A range is summed up by the bad rows before its first good one, those behind its last, and its longest run. Put
    together in order, these say how long a run comes into each range and whether an earlier one has ended the group;
    each range is then cut on its own. Order must tell the rows of a group apart.
    """
    rows = in_ranges(df.withColumn("__bad", F.coalesce(bad, F.lit(False)).cast("int")), group, order)
    own = ["__range", *group]
    up_to = Window.partitionBy(*own).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = rows.withColumn("__run", F.sum(1 - F.col("__bad")).over(up_to))
    in_run = Window.partitionBy(*own, "__run").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = written(rows.withColumn("__long", F.sum("__bad").over(in_run)))

    runs = rows.groupBy(*own, "__run").agg(F.sum("__bad").alias("n"))
    sums = runs.groupBy(*own).agg(F.max(F.when(F.col("__run") == 0, F.col("n"))).alias("first"), F.max_by("n", "__run").alias("last"), F.max("n").alias("longest"), F.max("__run").alias("good"))
    ranges = Window.partitionBy(*group).orderBy("__range")
    sums = sums.withColumn("__part", F.sum((F.col("good") > 0).cast("int")).over(ranges))
    within = Window.partitionBy(*group, "__part").orderBy("__range").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    sums = sums.withColumn("__open", F.sum("last").over(within))  # the run that goes on behind this range
    sums = sums.withColumn("__in", F.coalesce(F.lag("__open").over(ranges), F.lit(0)))
    reached = F.greatest(F.coalesce("first", F.lit(0)) + F.col("__in"), "longest") >= streak
    sums = sums.withColumn("__ended", F.coalesce(F.max(reached.cast("int")).over(ranges.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))

    told = sums.select(*(F.col(c).alias(f"{c}_") for c in own), "__in", "__ended")
    joined = rows.join(told, [F.col(c).eqNullSafe(F.col(f"{c}_")) for c in own]).filter("__ended = 0")
    over = (F.col("__long") + F.when(F.col("__run") == 0, F.col("__in")).otherwise(0) >= streak) & (F.col("__bad") == 1)
    before = Window.partitionBy(*own).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return joined.withColumn("__over", F.coalesce(F.max(over.cast("int")).over(before), F.lit(0))).filter("__over = 0").select(*df.columns)


def batches(df: DataFrame, group: Sequence[str], order: Sequence[str], size: int, item: Column) -> DataFrame:
    """Items of each group in ordered batches of `size`: (group, batch, refs, items)."""
    w = Window.partitionBy(*group).orderBy(*order)
    numbered = df.withColumn("__n", F.row_number().over(w) - 1).withColumn("batch", F.floor(F.col("__n") / size))
    return numbered.groupBy(*group, "batch").agg(F.transform(F.array_sort(F.collect_list(F.struct("__n", item.alias("item")))), lambda x: x["item"]).alias("items"))


def first_distinct(df: DataFrame, keys: Sequence[str], order: Sequence[Column], value: str, rows: int, distinct: int) -> DataFrame:
    """(keys, values): of each group's first `rows` rows, the first `distinct` different values in order."""
    w = Window.partitionBy(*keys).orderBy(*order)
    few = df.withColumn("__rn", F.row_number().over(w)).filter(F.col("__rn") <= rows)
    return few.groupBy(*keys).agg(F.slice(F.array_distinct(F.transform(F.array_sort(F.collect_list(F.struct("__rn", value))), lambda x: x[value])), 1, distinct).alias("values"))


def mode_first(df: DataFrame, keys: Sequence[str], value: str, order: str) -> DataFrame:
    """(keys, value): each group's most frequent value; of equally frequent ones the one met first."""
    counts = df.filter(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count(F.lit(1)).alias("__n"), F.min(order).alias("__first"))
    return counts.groupBy(*keys).agg(F.max_by(value, F.struct("__n", -F.col("__first"), value)).alias(value))


def page(df: DataFrame, order: Sequence[Column], number: int, size: int = 20) -> DataFrame:
    """A page of ordered rows, from 1; numbers beyond the last give the last page, below 1 the first."""
    last = max(1, -(-df.count() // size))
    return df.orderBy(*order).offset((min(max(1, number), last) - 1) * size).limit(size)


def until_first(df: DataFrame, group: Sequence[str], order: str, bad: Column) -> DataFrame:
    """Rows of each group before its first bad one, which is left out too: one minimum a group, and no group is sorted."""
    ends = df.filter(bad).groupBy(*group).agg(F.min(order).alias("__end")).select(*(F.col(c).alias(f"__g_{c}") for c in group), "__end")
    same = [F.col(c).eqNullSafe(F.col(f"__g_{c}")) for c in group]
    met = df.join(ends, reduce(lambda x, y: x & y, same), "left")
    return met.filter(F.col("__end").isNull() | (F.col(order) < F.col("__end"))).select(*df.columns)


def sorted_by(df: DataFrame, how: str, tie: str = "id") -> DataFrame:
    """Vacancies by a named order: newest seen, highest salary (none counts as 0), most sources, or least sure (no confidence counts as 1)."""
    orders = {"new": F.desc_nulls_last("last_seen"), "salary": F.coalesce("salary_max", F.lit(0)).desc(), "sources": F.desc_nulls_last("n_sources"), "confidence": F.coalesce("confidence", F.lit(1.0)).asc()}
    return df.orderBy(orders[how], tie)
