"""One call for a source's run, from its listing to the run's log, and one for reading stored pages anew."""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.timefn import day_of, to_iso
from tessera.operators.graph import written
from tessera.operators.relational import fresh_split, until_streak, update_by_key
from tessera.plans.ingest import clean, land, run_status
from tessera.sources import rawstore

#: Readers of pages: (url, body) rows to (url, error, posting fields) rows.
Read = Callable[[DataFrame], DataFrame]


class Landed(NamedTuple):
    postings: DataFrame
    log: DataFrame


class Limits(NamedTuple):
    """Pages a run fetches, days before a posting is fetched again, old postings in a row that end a run, days of the age window, pages fetched before the run looks whether it is over."""

    max_pages: int = 500
    refetch_days: int = 7
    streak: int = 30
    max_age: int = 60
    step: int = 100


def too_old(today: Column, days: int) -> Column:
    return F.coalesce(F.datediff(today, day_of(to_iso(F.col("posted_at")))) > days, F.lit(False))


def run_log(items: DataFrame, counts: DataFrame, source: str) -> DataFrame:
    """One row: the counts, and status and error type by the run's items (error null: saved); a source that blocks is `blocked`."""
    kind = F.substring_index("error", ":", 1)
    known = items.select(F.lit(source).alias("source"), kind.alias("error"), "nth")
    status = run_status(known, ["source"], "error", "nth").select("n_saved", "n_errors", "status", "error_type")
    blocked = items.agg(F.coalesce(F.bool_or(kind == "blocked"), F.lit(False)).alias("blocked"))
    one = counts.crossJoin(blocked).join(status, F.lit(True), "left")  # one row each
    stopped = F.col("blocked")
    return one.select(
        F.lit(source).alias("source"),
        *counts.columns,
        F.coalesce("n_saved", F.lit(0)).alias("n_saved"),
        F.coalesce("n_errors", F.lit(0)).alias("n_errors"),
        F.when(stopped, "blocked").otherwise(F.coalesce("status", F.lit("success"))).alias("status"),
        F.when(stopped, "blocked").otherwise(F.col("error_type")).alias("error_type"),
    )


def run_source(listed: DataFrame, old: DataFrame, fetch: Callable[[DataFrame], DataFrame], read: Read, source: str, today: Column, now: Column, limits: Limits = Limits(), key: bytes | None = None) -> Landed:
    """The postings' next snapshot and the run's log.

    listed: nth, url, source_job_id (null where the url does not tell); fetch: (nth, url) rows to (url, body, error)
    rows, possibly none behind a blocking page. Postings fetched less than refetch_days ago are only marked as seen. Of
    the others the first max_pages are fetched, `step` at a time, until a streak of old postings ends the run or the
    source blocks. Postings behind the first run of `streak` old ones are left out, as are all old ones. A page without
    a posting is an item of its own, with its error.
    """
    named = listed.withColumn("posting_id", F.concat(F.lit(f"{source}:"), "source_job_id"))
    seen, rest = fresh_split(old.withColumn("seen_at", F.to_timestamp("fetched_at")), named, "posting_id", "seen_at", F.to_timestamp(now), limits.refetch_days)
    touched = update_by_key(old, seen.select("posting_id").distinct().withColumn("fetched_at", now), ["posting_id"])
    wanted = rest.groupBy("url").agg(F.min("nth").alias("nth")).orderBy("nth", "url").limit(limits.max_pages)
    got, items = in_steps(wanted, fetch, read, source, today, limits)
    # a run's items are bounded by max_pages, so their order is one window's; errors neither lengthen nor end a streak
    good = items.filter("error IS NULL")
    kept = until_streak(good, ["source"], ["nth", "url"], F.col("old"), limits.streak)
    end = good.join(kept.select("nth"), "nth", "left_anti").agg(F.min("nth").alias("end"))
    faulty = items.filter("error IS NOT NULL").crossJoin(end).filter(F.col("end").isNull() | (F.col("nth") < F.col("end"))).drop("end")
    within = kept.unionByName(faulty).filter(~F.col("old"))
    snapshot = land(touched, clean(within.filter("error IS NULL"), source, now, key), today, limits.max_age)
    counts = listed.agg(F.count(F.lit(1)).alias("n_listed")).crossJoin(seen.agg(F.count(F.lit(1)).alias("n_fresh"))).crossJoin(got.agg(F.count(F.lit(1)).alias("n_fetched"))).crossJoin(items.agg(F.count_if("old").alias("n_old")))
    return Landed(snapshot, run_log(within, counts, source))


def in_steps(wanted: DataFrame, fetch: Callable[[DataFrame], DataFrame], read: Read, source: str, today: Column, limits: Limits) -> tuple[DataFrame, DataFrame]:
    """(pages, items) of a run: `step` of its pages at a time are fetched and read, until it is over or none is left.

    Only whether the items of a step's pages are old comes to the driver, one row an item.
    """
    numbered = written(wanted.withColumn("__at", F.row_number().over(Window.orderBy("nth", "url")) - 1))
    got = items = None
    length = at = 0
    while True:
        some = numbered.filter((F.col("__at") >= at) & (F.col("__at") < at + limits.step)).drop("__at")
        # fetching is no pure function of its input: it is written before anything is derived from it
        pages = written(fetch(some.select("nth", "url")))
        found = read(pages.filter("error IS NULL").select("url", "body")).unionByName(pages.filter("error IS NOT NULL").select("url", "error"), allowMissingColumns=True)
        new = written(found.join(some, "url").withColumns({"source": F.lit(source), "old": too_old(today, limits.max_age) & F.col("error").isNull()}))
        got, items = (pages, new) if got is None else (got.unionByName(pages), items.unionByName(new))
        over = False
        for old, kind in new.select("old", F.substring_index("error", ":", 1).alias("kind"), "nth", "url").orderBy("nth", "url").select("old", "kind").collect():
            length = length + 1 if old else length if kind else 0
            over = over or length >= limits.streak or kind == "blocked"
        at += limits.step
        if over or at >= limits.max_pages or numbered.filter(F.col("__at") >= at).isEmpty():
            return got, items


def reparse(spark, root: str, old: DataFrame, read: Read, source: str, today: Column, day: str | None = None, max_age: int = 60, key: bytes | None = None) -> Landed:
    """Stored pages of a source (of one day) read anew, without a fetch, and landed as of when they were fetched; pages at fault are counted."""
    pages = rawstore.load(spark, root, source, day).select("key", "body", F.get_json_object("meta", "$.url").alias("url"), F.get_json_object("meta", "$.fetched_at").alias("fetched_at"))
    latest = pages.groupBy("url").agg(F.max_by("body", F.struct("fetched_at", "key")).alias("body"), F.max("fetched_at").alias("fetched_at"))
    items = read(latest.select("url", "body")).join(latest.select("url", "fetched_at"), "url").withColumns({"nth": F.xxhash64("url"), "old": too_old(today, max_age) & F.col("error").isNull()})
    items = written(items)
    good = items.filter("error IS NULL AND NOT old")
    snapshot = land(old, clean(good, source, F.col("fetched_at"), key), today, max_age)
    counts = pages.agg(F.count(F.lit(1)).alias("n_pages")).crossJoin(items.agg(F.count_if("old").alias("n_old")))
    return Landed(snapshot, run_log(items.filter("NOT old"), counts, source))
