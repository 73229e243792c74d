"""Published marts: counts, trends, quartiles, top lists, nested records. Each is one plan over the tables it needs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.operators.graph import written
from tessera.operators.quality import share
from tessera.operators.relational import in_ranges


def summary(vacancies: DataFrame, coded: DataFrame, n_postings: DataFrame, today: Column, window_days: int = 60) -> DataFrame:
    """One row: active and new vacancies, ratios, range of dates, and whether all is sample data.

    vacancies: id, source, first_seen, last_seen, is_active; coded: id; n_postings: one row, postings.
    """
    marked = vacancies.join(coded.select("id").distinct().withColumn("__coded", F.lit(True)), "id", "left")
    active = F.col("is_active")
    one = marked.agg(
        F.count_if(active).alias("active_vacancies"),
        F.count_if(active & (F.col("first_seen") >= F.date_sub(today, 7))).alias("new_last_7_days"),
        F.count_if(active & F.coalesce("__coded", F.lit(False))).alias("__c"),
        F.count(F.lit(1)).alias("__v"),
        F.min("first_seen").alias("first_seen_min"),
        F.max("last_seen").alias("last_seen_max"),
        F.when(F.count_if(F.col("source") != "sample") == 0, "demo").otherwise("real").alias("data_label"),
    )
    return one.crossJoin(n_postings).select("data_label", "active_vacancies", "new_last_7_days", "postings", share(F.col("postings") - F.col("__v"), F.col("postings")).alias("duplicate_ratio"), share(F.col("__c"), F.col("active_vacancies")).alias("coded_ratio"), F.lit(window_days).alias("window_days"), "first_seen_min", "last_seen_max")


def counts_by_dimension(facts: DataFrame, dimension: DataFrame, key: str) -> DataFrame:
    """The dimension's rows with their number of facts, zeros too."""
    counts = facts.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    return dimension.join(counts, key, "left").withColumn("n", F.coalesce("n", F.lit(0)))


def remote_and_unmapped(vacancies: DataFrame) -> DataFrame:
    remote = F.coalesce("is_remote", F.lit(False))
    return vacancies.agg(F.count_if(remote).alias("remote"), F.count_if(F.col("province_code").isNull() & ~remote).alias("unmapped"))


def top_by_count(df: DataFrame, keys: list[str], order: str, k: int) -> DataFrame:
    """The k most frequent keys; of equally frequent ones those met first in `order`."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.min(order).alias("__first")).orderBy(F.desc("n"), "__first").limit(k).drop("__first")


def trend(df: DataFrame, day: str, today: Column, days: int = 30) -> DataFrame:
    """(day, n) of the last days, none left out."""
    spark = df.sparkSession
    spine = spark.range(1).select(F.explode(F.sequence(F.date_sub(today, days - 1), today)).alias("day"))
    counts = df.filter(F.col(day) >= F.date_sub(today, days - 1)).groupBy(F.col(day).alias("day")).agg(F.count(F.lit(1)).alias("n"))
    return spine.join(counts, "day", "left").withColumn("n", F.coalesce("n", F.lit(0)))


def top_skills(skills: DataFrame, k: int = 20) -> DataFrame:
    """(skill, n): most frequent skills without case, in the spelling met first. skills: pos, skill."""
    keyed = skills.select("pos", F.trim("skill").alias("raw"), F.lower(F.trim("skill")).alias("key"))
    return keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min_by("raw", "pos").alias("skill"), F.min("pos").alias("__first")).orderBy(F.desc("n"), "__first").limit(k).select("skill", "n")


def quartile(values: Column, n: Column, i: int) -> Column:
    """Exclusive quartile i of a sorted array of n values."""
    j = F.greatest(F.lit(1), F.least(F.floor(i * (n + 1) / 4), n - 1)).cast("int")
    d = i * (n + 1) - 4 * j
    return (F.element_at(values, j) * (4 - d) + F.element_at(values, j + 1) * d) / 4


def salary_quartiles(df: DataFrame, by: str, low: str, high: str, least: int = 5, step: int = -4) -> DataFrame:
    """(by, n, p25, median, p75) of the midpoints of ranges, exclusive quartiles rounded half to even; small groups are left out.

    Exact quartiles by selection: equal values are counted first, and those counts are dealt into ranges of value. A
    value's rank is its place in its range plus what earlier ranges of its group hold, so that a group of any size is
    ranked by many tasks; only the values at the two places of each quartile are kept.
    """
    mid = ((F.col(low) + F.coalesce(F.nullif(F.col(high), F.lit(0)), F.col(low))) / 2).alias("v")
    rows = df.filter(F.col(by).isNotNull() & (F.coalesce(F.col(low), F.lit(0)) != 0)).select(F.col(by).alias("__by"), mid)
    upto = F.sum("k").over(Window.partitionBy("__by", "__range").orderBy("v"))
    steps = written(in_ranges(rows.groupBy("__by", "v").agg(F.count(F.lit(1)).alias("k")), ["__by"], ["v"]).withColumn("upto", upto))
    held = steps.groupBy("__by", "__range").agg(F.sum("k").alias("held"))
    earlier = Window.partitionBy("__by").orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    held = held.select("__by", "__range", F.coalesce(F.sum("held").over(earlier), F.lit(0)).alias("earlier"), F.sum("held").over(Window.partitionBy("__by")).alias("n")).filter(F.col("n") >= least)
    ranked = steps.join(held, ["__by", "__range"]).withColumn("__hi", F.col("earlier") + F.col("upto")).withColumn("__lo", F.col("__hi") - F.col("k") + 1)

    def at(place: Column) -> Column:
        return F.max(F.when((F.col("__lo") <= place) & (place <= F.col("__hi")), F.col("v")))

    places = {}
    for i in (1, 2, 3):
        j = F.greatest(F.lit(1), F.least(F.floor(i * (F.col("n") + 1) / 4), F.col("n") - 1))
        places[f"a{i}"], places[f"b{i}"] = at(j), at(j + 1)
    found = ranked.groupBy("__by", "n").agg(*(c.alias(k) for k, c in places.items()))

    def value(i: int) -> Column:
        j = F.greatest(F.lit(1), F.least(F.floor(i * (F.col("n") + 1) / 4), F.col("n") - 1))
        d = i * (F.col("n") + 1) - 4 * j
        return F.bround((F.col(f"a{i}") * (4 - d) + F.col(f"b{i}") * d) / 4, step)

    return found.select(F.col("__by").alias(by), "n", value(1).alias("p25"), value(2).alias("median"), value(3).alias("p75"))


def histogram(df: DataFrame, value: str, bins: int = 10) -> DataFrame:
    """(bin, n) of values in 0 to 1, the last bin closed, empty bins too."""
    bin_ = F.least(F.floor(F.col(value) * bins), F.lit(bins - 1)).cast("int")
    counts = df.filter(F.col(value).isNotNull()).groupBy(bin_.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    return df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin")).join(counts, "bin", "left").withColumn("n", F.coalesce("n", F.lit(0)))


def quantile_bins(counts: DataFrame, n: str = "n", shares: tuple[float, ...] = (0.2, 0.4, 0.6, 0.8)) -> DataFrame:
    """counts with `bin`: how many of the cuts, taken at floor(share * size) of the sorted non-zero counts, are below n.

    A dimension's counts are few; they are ranked in one window.
    """
    w = Window.orderBy(n)
    positive = counts.filter(F.col(n) > 0)
    ranked = positive.select(F.col(n).alias("__v"), (F.row_number().over(w) - 1).alias("__r"))
    size = positive.agg(F.count(F.lit(1)).alias("__size"))
    wanted = F.array(*(F.floor(F.col("__size") * q) for q in shares))
    cuts = ranked.crossJoin(size).filter(F.array_contains(wanted, F.col("__r"))).withColumn("__times", F.size(F.filter(wanted, lambda x: x == F.col("__r")))).agg(F.flatten(F.collect_list(F.array_repeat("__v", F.col("__times")))).alias("__cuts"))
    return counts.crossJoin(cuts).withColumn("bin", F.when(F.col(n) > 0, F.size(F.filter("__cuts", lambda c: c < F.col(n)))).otherwise(F.lit(0))).drop("__cuts")


def with_shares(counts: DataFrame, n: str = "n") -> DataFrame:
    """counts with each row's share of the largest and of all, over the whole (small) table."""
    every = counts.agg(F.max(n).alias("__max"), F.sum(n).alias("__sum"))
    return counts.crossJoin(every).withColumn("of_max", F.bround(F.col(n) / F.col("__max"), 4)).withColumn("of_all", F.bround(F.col(n) / F.col("__sum"), 4)).drop("__max", "__sum")


def facets(df: DataFrame, keyword: str | None = None, texts: list[str] | None = None, place: str | None = None, place_column: str = "place", within: dict[str, list] | None = None, at_least: dict[str, float] | None = None) -> DataFrame:
    """Rows that meet all filters: a keyword in any text, a place, values in lists, least values."""
    if keyword:
        found = None
        for c in texts or []:
            hit = F.lower(F.coalesce(F.col(c), F.lit(""))).contains(keyword.lower())
            found = hit if found is None else found | hit
        df = df.filter(found)
    if place:
        df = df.filter(F.lower(F.coalesce(F.col(place_column), F.lit(""))).contains(place.lower()))
    for c, values in (within or {}).items():
        df = df.filter(F.col(c).isin(values))
    for c, value in (at_least or {}).items():
        df = df.filter(F.col(c) >= value)
    return df


#: Statuses of a run that gave rows.
RAN = ("success", "partial")


def last_runs(runs: DataFrame, most: int = 14) -> DataFrame:
    """(source, nth, started_at, status, n_saved, n_errors, error_type) of each source's last runs, the newest first."""
    newest = Window.partitionBy("source").orderBy(F.desc("started_at"), F.desc("run_id"))
    return runs.withColumn("nth", F.row_number().over(newest)).filter(F.col("nth") <= most).select("source", "nth", "started_at", "status", "n_saved", "n_errors", "error_type")


def sources_state(runs: DataFrame, enabled: DataFrame, vacancies: DataFrame) -> DataFrame:
    """(sources_ok, sources_total): enabled sources that ever ran, and those whose last run gave rows; without any, all sources of vacancies."""
    last = last_runs(runs, 1).join(enabled.select("source"), "source", "left_semi").agg(F.count_if(F.col("status").isin(*RAN)).alias("ok"), F.count(F.lit(1)).alias("ran"))
    have = vacancies.agg(F.count_distinct("source").alias("have"))
    ok_of_all = vacancies.select("source").distinct().join(last_runs(runs, 1).filter(F.col("status").isin(*RAN)).select("source"), "source", "left_semi").agg(F.count(F.lit(1)).alias("ok_of_all"))
    one = last.crossJoin(have).crossJoin(ok_of_all)  # one row each
    return one.select(F.when(F.col("ran") > 0, F.col("ok")).otherwise(F.col("ok_of_all")).alias("sources_ok"), F.when(F.col("ran") > 0, F.col("ran")).otherwise(F.col("have")).alias("sources_total"))


def review_state(coded: DataFrame, bins: int = 10) -> DataFrame:
    """(classified, needs_review, confidence_histogram) of coded rows; the histogram is an array of counts by tenth."""
    sure = F.coalesce("confidence", "confidence4")
    tenth = F.least(F.floor(sure * bins), F.lit(bins - 1))
    return coded.agg(F.count(F.lit(1)).alias("classified"), F.count_if("needs_review").alias("needs_review"), F.array(*(F.count_if(tenth == i) for i in range(bins))).alias("confidence_histogram"))
