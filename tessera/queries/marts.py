"""The quality gate and the published marts over the driver's tables: orders as vacancies, nations as regions, parts as codes."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions.text import region_label, short_id
from tessera.operators import quality
from tessera.operators import relational as R
from tessera.plans import marts
from tessera.queries import query
from tessera.queries.texts import SQL_CONTACTS, SQL_KINDS, with_contacts

TODAY = "DATE '1998-08-02'"
SQL_LAST = "(SELECT CAST(max(o_orderdate) AS DATE) FROM orders)"


def _vacancies(t):
    """Orders of customers of nations; the last order's day is today."""
    o = t("orders").join(t("customer"), F.col("o_custkey") == F.col("c_custkey")).join(t("nation"), F.col("c_nationkey") == F.col("n_nationkey"), "left")
    day = F.to_date("o_orderdate")
    return o.select(
        F.col("o_orderkey").alias("id"), F.concat(F.lit("s"), F.col("o_orderkey") % 5).alias("source"), day.alias("first_seen"), F.date_add(day, 5).alias("last_seen"), (F.col("o_orderstatus") != "F").alias("is_active"),
        F.when(F.col("o_orderkey") % 9 != 0, F.col("n_name")).alias("province_code"), (F.col("o_orderkey") % 10 == 0).alias("is_remote"), "o_orderpriority", "o_totalprice", "c_name",
    )


SQL_V = """SELECT o_orderkey AS id, 's' || (o_orderkey % 5) AS source, CAST(o_orderdate AS DATE) AS first_seen, CAST(o_orderdate AS DATE) + 5 AS last_seen, o_orderstatus <> 'F' AS is_active,
CASE WHEN o_orderkey % 9 <> 0 THEN n_name END AS province_code, o_orderkey % 10 = 0 AS is_remote, o_orderpriority, o_totalprice, c_name FROM orders JOIN customer ON o_custkey = c_custkey LEFT JOIN nation ON c_nationkey = n_nationkey"""


def _with_today(t, df):
    today = t("orders").agg(F.to_date(F.max("o_orderdate")).alias("today")).first()["today"]
    return df, F.lit(today)


@query(f"""WITH v AS ({SQL_V}), c AS (SELECT DISTINCT l_orderkey AS id FROM lineitem WHERE l_returnflag = 'N'), p AS (SELECT count(*) AS postings FROM lineitem)
SELECT CASE WHEN bool_and(source = 'sample') THEN 'demo' ELSE 'real' END AS data_label, count(*) FILTER (WHERE is_active) AS active_vacancies, count(*) FILTER (WHERE is_active AND first_seen >= {SQL_LAST} - 7) AS new_last_7_days, any_value(postings) AS postings,
round_even((any_value(postings) - count(*)) / any_value(postings), 4) AS duplicate_ratio, round_even(count(*) FILTER (WHERE is_active AND c.id IS NOT NULL) / count(*) FILTER (WHERE is_active), 4) AS coded_ratio, 60 AS window_days, CAST(min(first_seen) AS VARCHAR) AS first_seen_min, CAST(max(last_seen) AS VARCHAR) AS last_seen_max
FROM v LEFT JOIN c ON c.id = v.id, p""")
def mart_summary(t):
    v, today = _with_today(t, _vacancies(t))
    lines = t("lineitem")
    out = marts.summary(v, lines.filter("l_returnflag = 'N'").select(F.col("l_orderkey").alias("id")), lines.agg(F.count(F.lit(1)).alias("postings")), today)
    return out.withColumn("first_seen_min", F.col("first_seen_min").cast("string")).withColumn("last_seen_max", F.col("last_seen_max").cast("string"))


@query(f"""WITH v AS ({SQL_V}) SELECT n_name AS code, count(v.id) AS n FROM nation LEFT JOIN v ON v.province_code = n_name AND v.is_active GROUP BY 1""")
def mart_by_region(t):
    return marts.counts_by_dimension(_vacancies(t).filter("is_active").withColumnRenamed("province_code", "code"), t("nation").select(F.col("n_name").alias("code")), "code").select("code", "n")


@query(f"""WITH v AS ({SQL_V}) SELECT count(*) FILTER (WHERE is_remote) AS remote, count(*) FILTER (WHERE province_code IS NULL AND NOT is_remote) AS unmapped FROM v WHERE is_active""")
def mart_unmapped(t):
    return marts.remote_and_unmapped(_vacancies(t).filter("is_active"))


@query("""SELECT p_type AS code, p_brand AS title, count(*) AS n FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY 1, 2 ORDER BY n DESC, min(l_orderkey * 10 + l_linenumber), 1, 2 LIMIT 15""")
def mart_by_code(t):
    lines = t("lineitem").join(t("part"), F.col("p_partkey") == F.col("l_partkey")).withColumn("pos", F.struct(F.col("l_orderkey") * 10 + F.col("l_linenumber"), "p_type", "p_brand"))
    return marts.top_by_count(lines.select(F.col("p_type").alias("code"), F.col("p_brand").alias("title"), "pos"), ["code", "title"], "pos", 15)


@query(f"""SELECT CAST(d AS DATE)::VARCHAR AS day, count(o_orderkey) AS n FROM (SELECT unnest(generate_series({SQL_LAST} - 29, {SQL_LAST}, INTERVAL 1 DAY)) AS d) LEFT JOIN orders ON CAST(o_orderdate AS DATE) = CAST(d AS DATE) GROUP BY 1""")
def mart_trend(t):
    v, today = _with_today(t, _vacancies(t))
    return marts.trend(v, "first_seen", today).select(F.col("day").cast("string").alias("day"), "n")


@query("""WITH e AS (SELECT l_orderkey * 10 + l_linenumber AS pos, l_partkey, CASE WHEN l_linenumber % 2 = 0 THEN ' ' || p_name ELSE upper(p_name) END AS skill FROM lineitem JOIN part ON p_partkey = l_partkey),
k AS (SELECT lower(trim(skill)) AS k, (pos, l_partkey, trim(skill)) AS p, trim(skill) AS raw FROM e) SELECT arg_min(raw, p) AS skill, count(*) AS n FROM k GROUP BY k ORDER BY n DESC, min(p) LIMIT 20""")
def mart_skills(t):
    lines = t("lineitem").join(t("part"), F.col("p_partkey") == F.col("l_partkey"))
    skill = F.when(F.col("l_linenumber") % 2 == 0, F.concat(F.lit(" "), "p_name")).otherwise(F.upper("p_name"))
    return marts.top_skills(lines.select(F.struct(F.col("l_orderkey") * 10 + F.col("l_linenumber"), F.col("l_partkey"), F.trim(skill)).alias("pos"), skill.alias("skill")))


@query("""WITH r AS (SELECT o_orderpriority AS education, (floor(o_totalprice) * 1000 + coalesce(nullif(CASE WHEN o_orderkey % 3 = 0 THEN 0 ELSE floor(o_totalprice) * 1500 END, 0), floor(o_totalprice) * 1000)) / 2 AS v FROM orders WHERE floor(o_totalprice) <> 0),
s AS (SELECT education, count(*) AS n, list(v ORDER BY v) AS x FROM r GROUP BY 1 HAVING count(*) >= 5),
q AS (SELECT education, n, x, list_transform([1, 2, 3], lambda i: greatest(1, least((i * (n + 1)) // 4, n - 1))) AS j FROM s)
SELECT education, n, round_even((x[j[1]] * (4 - (1 * (n + 1) - 4 * j[1])) + x[j[1] + 1] * (1 * (n + 1) - 4 * j[1])) / 4, -4) AS p25, round_even((x[j[2]] * (4 - (2 * (n + 1) - 4 * j[2])) + x[j[2] + 1] * (2 * (n + 1) - 4 * j[2])) / 4, -4) AS median,
round_even((x[j[3]] * (4 - (3 * (n + 1) - 4 * j[3])) + x[j[3] + 1] * (3 * (n + 1) - 4 * j[3])) / 4, -4) AS p75 FROM q""")
def mart_salary(t):
    base = F.floor("o_totalprice")
    rows = t("orders").select(F.col("o_orderpriority").alias("education"), (base * 1000).cast("double").alias("low"), F.when(F.col("o_orderkey") % 3 == 0, 0.0).otherwise((base * 1500).cast("double")).alias("high"))
    return marts.salary_quartiles(rows, "education", "low", "high")


@query(f"""WITH v AS ({SQL_V}), top AS (SELECT * FROM v WHERE is_active ORDER BY first_seen DESC, id LIMIT 500)
SELECT 'v' || left(sha1(CAST(id AS VARCHAR)), 10) AS id, province_code AS region, is_remote AS remote, o_orderpriority AS education, CAST(first_seen AS VARCHAR) AS first_seen, (SELECT count(*) FROM lineitem WHERE l_orderkey = top.id) AS skills FROM top""")
def mart_vacancies(t):
    top = _vacancies(t).filter("is_active").orderBy(F.desc("first_seen"), "id").limit(500)
    skills = t("lineitem").groupBy(F.col("l_orderkey").alias("id")).agg(F.count(F.lit(1)).alias("n"))
    record = top.join(skills, "id", "left").select(F.struct(short_id(F.col("id").cast("string")).alias("id"), F.struct(F.col("province_code").alias("name")).alias("region"), F.col("is_remote").alias("remote"), F.col("o_orderpriority").alias("education"), F.col("first_seen").cast("string").alias("first_seen"), F.coalesce("n", F.lit(0)).alias("skills")).alias("r"))
    return record.select(F.col("r.id").alias("id"), F.col("r.region.name").alias("region"), F.col("r.remote").alias("remote"), F.col("r.education").alias("education"), F.col("r.first_seen").alias("first_seen"), F.col("r.skills").alias("skills"))


@query("""SELECT CAST(b AS INTEGER) AS bin, count(l_discount) AS n FROM range(10) t(b) LEFT JOIN lineitem ON least(CAST(floor(l_discount * 10 * 10) AS INTEGER), 9) = b GROUP BY 1""")
def mart_ops_histogram(t):
    return marts.histogram(t("lineitem").withColumn("c", F.col("l_discount") * 10), "c")


@query("""WITH r AS (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY ts DESC, event_id DESC) AS rn FROM events)
SELECT event_type AS source, count(*) AS runs, CAST(sum(CASE WHEN value > 10 THEN 1 ELSE 0 END) AS BIGINT) AS ok, CAST(arg_max(event_id, ts) AS BIGINT) AS last FROM r WHERE rn <= 14 GROUP BY 1""")
def mart_ops_runs(t):
    runs = R.top_n_per_group(t("events"), ["event_type"], [F.desc("ts"), F.desc("event_id")], 14)
    return runs.groupBy(F.col("event_type").alias("source")).agg(F.count(F.lit(1)).alias("runs"), F.count_if(F.col("value") > 10).alias("ok"), F.max_by("event_id", "ts").alias("last"))


@query(f"""WITH v AS ({SQL_V}) SELECT 'v' || left(sha1(CAST(id AS VARCHAR)), 10) AS id, CASE WHEN province_code IS NULL THEN NULL ELSE upper(left(province_code, 1)) || lower(substr(province_code, 2)) END AS region_name,
k.skills FROM v LEFT JOIN (SELECT l_orderkey, string_agg(CAST(l_partkey AS VARCHAR), '; ' ORDER BY l_linenumber, l_partkey) AS skills FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey) AS n FROM lineitem) WHERE n <= 8 GROUP BY 1) k ON k.l_orderkey = v.id""")
def flat_export(t):
    v = _vacancies(t)
    # a record keeps up to 8 skills, as in publish.records
    skills = t("lineitem").groupBy(F.col("l_orderkey").alias("id")).agg(F.array_join(F.transform(F.slice(F.array_sort(F.collect_list(F.struct("l_linenumber", "l_partkey"))), 1, 8), lambda x: x["l_partkey"].cast("string")), "; ").alias("skills"))
    return v.join(skills, "id", "left").select(short_id(F.col("id").cast("string")).alias("id"), region_label(F.col("province_code")).alias("region_name"), "skills")


@query("""WITH p AS (SELECT count(*) AS n, count(*) FILTER (WHERE coalesce(text, '') = '' OR coalesce(lang, '') = '') AS empty, count(*) FILTER (WHERE regexp_matches(text, '[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\\.[A-Za-z]{2,}')) AS pii, count(*) FILTER (WHERE lang <> 'en' OR n_chars % 2 = 0) AS mapped, count(*) FILTER (WHERE n_chars % 3 = 0) AS paid FROM documents),
v AS (SELECT count(DISTINCT sha1(text)) AS v FROM documents), i AS (SELECT count(*) AS invalid FROM documents WHERE lang NOT IN ('en', 'fr', 'de')), q AS (SELECT count(*) AS silent FROM (VALUES ('click'), ('none')) s(source) LEFT JOIN (SELECT event_type, arg_max(value, event_id) AS last FROM events GROUP BY 1) r ON r.event_type = s.source WHERE last IS NULL OR last <= 0)
SELECT unnest(['title_and_location_present', 'codes_valid', 'no_contact_details', 'every_source_produced_rows', 'region_mapped', 'salary_parsed', 'duplicate_ratio_in_range']) AS "check",
unnest([round_even((n - empty) / n, 4), CAST(invalid AS DOUBLE), CAST(pii AS DOUBLE), CAST(silent AS DOUBLE), round_even(mapped / n, 4), round_even(paid / n, 4), round_even((n - v) / n, 4)]) AS value,
unnest([CASE WHEN round_even(empty / n, 4) <= 0.01 THEN 'pass' ELSE 'fail' END, CASE WHEN invalid = 0 THEN 'pass' ELSE 'fail' END, CASE WHEN pii = 0 THEN 'pass' ELSE 'fail' END, CASE WHEN silent = 0 THEN 'pass' ELSE 'warn' END, CASE WHEN round_even(mapped / n, 4) >= 0.9 THEN 'pass' ELSE 'warn' END, CASE WHEN round_even(paid / n, 4) >= 0.35 THEN 'pass' ELSE 'warn' END, CASE WHEN round_even((n - v) / n, 4) BETWEEN 0.05 AND 0.6 THEN 'pass' ELSE 'warn' END]) AS status FROM p, v, i, q""")
def quality_report(t):
    docs = t("documents")
    # phone numbers are left to the unit tests: the oracle's regular expressions can't look behind
    clean = F.when(F.col("text").rlike(quality_email()), "a@b.id")
    postings = docs.select(F.col("text").alias("title"), F.col("lang").alias("location_raw"), F.when((F.col("lang") != "en") | (F.col("n_chars") % 2 == 0), "x").alias("region_code"), F.lit(False).alias("is_remote"), F.when(F.col("n_chars") % 3 == 0, 1).alias("salary_min"), clean.alias("mail"))
    spark = docs.sparkSession
    runs = t("events").select(F.col("event_type").alias("source"), F.col("event_id").alias("started_at"), F.greatest(F.col("value"), F.lit(0.0)).alias("n_saved"), F.lit(0).alias("n_skipped"))
    codes = spark.createDataFrame([("en",), ("fr",), ("de",)], "code string")
    unique = docs.select(F.sha1(F.encode("text", "UTF-8")).alias("h")).distinct()
    return quality.report(postings, unique, docs.select(F.col("lang").alias("code")), codes, runs, spark.createDataFrame([("click",), ("none",)], "source string"), ["mail"]).select("check", "value", "status")


def quality_email() -> str:
    from tessera.functions.privacy import EMAIL

    return EMAIL


@query("""WITH c AS (SELECT c_nationkey AS k, count(*) FILTER (WHERE c_acctbal > 9000) AS n FROM customer GROUP BY 1), s AS (SELECT list(n ORDER BY n) AS x FROM c WHERE n > 0),
q AS (SELECT list_transform([0.2, 0.4, 0.6, 0.8], lambda f: x[CAST(floor(len(x) * f) AS INTEGER) + 1]) AS cuts FROM s)
SELECT k, n, CAST(CASE WHEN n > 0 THEN len(list_filter(cuts, lambda v: v < n)) ELSE 0 END AS INTEGER) AS bin FROM c, q""")
def quantile_bins(t):
    counts = t("customer").groupBy(F.col("c_nationkey").alias("k")).agg(F.count_if(F.col("c_acctbal") > 9000).alias("n"))
    return marts.quantile_bins(counts)


@query("""WITH c AS (SELECT n_name, count(*) AS n FROM customer JOIN nation ON n_nationkey = c_nationkey GROUP BY 1) SELECT n_name, n, round_even(n / max(n) OVER (), 4) AS of_max, round_even(n / sum(n) OVER (), 4) AS of_all FROM c ORDER BY n DESC, n_name LIMIT 10""")
def top_share(t):
    counts = t("customer").join(t("nation"), F.col("n_nationkey") == F.col("c_nationkey")).groupBy("n_name").agg(F.count(F.lit(1)).alias("n"))
    return marts.with_shares(counts).orderBy(F.desc("n"), "n_name").limit(10)


@query(f"""WITH k AS (SELECT *, {SQL_KINDS} AS kinds FROM ({SQL_CONTACTS})), c AS (SELECT count(*) AS n, count(*) FILTER (WHERE kinds <> '') AS pii, count(*) FILTER (WHERE coalesce(lang, '') = '' OR coalesce(source, '') = '') AS empty FROM k)
SELECT 'no_contact_details' AS "check", 'fail' AS level, CASE WHEN pii = 0 THEN 'pass' ELSE 'fail' END AS status, CAST(pii AS DOUBLE) AS value FROM c
UNION ALL SELECT 'title_and_location_present', 'fail', CASE WHEN round_even(empty / n, 4) <= 0.01 THEN 'pass' ELSE 'fail' END, round_even((n - empty) / n, 4) FROM c""")
def quality_contacts(t):
    docs = with_contacts(t("documents"))
    postings = docs.select(F.col("lang").alias("title"), F.col("source").alias("location_raw"), F.lit(None).cast("string").alias("region_code"), F.lit(False).alias("is_remote"), F.lit(None).cast("long").alias("salary_min"), "t")
    runs = t("events").select(F.col("event_type").alias("source"), F.col("event_id").alias("started_at"), F.col("value").alias("n_saved"), F.lit(0).alias("n_skipped"))
    codes = docs.select(F.col("lang").alias("code"))
    found = quality.report(postings, docs.select("doc_id"), codes, codes.distinct(), runs, runs.select("source").distinct(), ["t"])
    return found.filter(F.col("check").isin("no_contact_details", "title_and_location_present"))
