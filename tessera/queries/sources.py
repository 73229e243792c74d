"""Page readers and a source's run over pages that are made of the driver's orders, so that SQL can say what they hold."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.operators import gazetteer
from tessera.operators.graph import written
from tessera.plans import runs
from tessera.plans.ingest import clean
from tessera.queries import query
from tessera.sources import files, pages

def _columns():
    """The order's number, and its price in whole units."""
    return F.col("o_orderkey"), F.floor("o_totalprice").cast("long")


def _script(data):
    return F.concat(F.lit('<html><script type="application/ld+json">'), data, F.lit("</script></html>"))


def _postings(t):
    """(k, url, body): pages with a posting by itself, in a list, in a graph, in lists and graphs of each other, or with a comma too many; broken ones; ones without a title."""
    k, price = _columns()
    salary = F.struct(price.alias("minValue"), F.when(k % 3 == 0, price).otherwise(price * 2).alias("maxValue"), F.lit("MONTH").alias("unitText"))
    address = F.struct(F.concat(F.lit("Kota "), "o_custkey").alias("addressLocality"), F.concat(F.lit("Region "), "o_orderstatus").alias("addressRegion"), F.concat(F.lit("Jl.  "), k).alias("streetAddress"))
    posting = F.to_json(
        F.struct(
            F.lit("JobPosting").alias("@type"),
            F.concat(F.lit("Staf &amp; Admin  "), k).alias("title"),
            F.struct(F.concat(F.lit("PT "), "o_custkey").alias("name")).alias("hiringOrganization"),
            F.date_format("o_orderdate", "yyyy-MM-dd").alias("datePosted"),
            F.array(F.lit("FULL_TIME"), F.lit("CONTRACT")).alias("employmentType"),
            F.struct(address.alias("address")).alias("jobLocation"),
            F.struct(F.lit("IDR").alias("currency"), salary.alias("value")).alias("baseSalary"),
            F.struct((k % 60).alias("monthsOfExperience")).alias("experienceRequirements"),
            F.struct(F.col("o_orderpriority").alias("credentialCategory")).alias("educationRequirements"),
            F.concat(F.lit("<p>Satu</p><p>nomor "), k, F.lit("</p>")).alias("description"),
            F.lit("Teliti").alias("qualifications"),
        )
    )
    data = (
        F.when(k % 6 == 1, F.concat(F.lit('[{"@type":"BreadcrumbList"}, '), posting, F.lit("]")))
        .when(k % 6 == 2, F.concat(F.lit('{"@graph": ['), posting, F.lit("]}")))
        .when(k % 6 == 3, F.concat(F.substring(posting, F.lit(1), F.length(posting) - 1), F.lit(",}")))
        .when(k % 6 == 4, "{broken")
        .when(k % 6 == 5, '{"@type":"JobPosting"}')
        .when(k % 24 == 6, F.concat(F.lit('[{"@type":"WebSite"}, ['), posting, F.lit(', "x"]]')))
        .when(k % 24 == 12, F.concat(F.lit('{"@graph": [{"@type":"WebPage", "@graph": ['), posting, F.lit("]}]}")))
        .when(k % 24 == 18, F.concat(F.lit('{"@graph": [[{"name":"]]"}, ['), posting, F.lit("]]]}")))
        .otherwise(posting)
    )
    # orders are narrow and reading a page is not, so the rows are dealt out by their key, not by the files' splits
    orders = t("orders")
    orders = orders.repartition(int(orders.sparkSession.conf.get("spark.sql.shuffle.partitions")), "o_orderkey")
    return orders.select(k.alias("k"), F.concat(F.lit("https://x/o"), k).alias("url"), _script(data).alias("body"))


@query("""WITH o AS (SELECT o_orderkey AS k, o_orderkey % 6 AS m, CAST(floor(o_totalprice) AS BIGINT) AS p, * FROM orders)
SELECT 'https://x/o' || k AS url, CASE m WHEN 4 THEN 'layout_changed: no posting' WHEN 5 THEN 'layout_changed: no title' END AS error, CASE WHEN m < 4 THEN 'Staf & Admin ' || k END AS title, CASE WHEN m < 4 THEN 'PT ' || o_custkey END AS company_name,
CASE WHEN m < 4 THEN 'Kota ' || o_custkey || ', Region ' || o_orderstatus END AS location_raw, CASE WHEN m < 4 THEN 'IDR ' || p || CASE WHEN k % 3 = 0 THEN '' ELSE '-' || (2 * p) END || '/month' END AS salary_raw,
CASE WHEN m < 4 THEN p END AS salary_min, CASE WHEN m < 4 THEN CASE WHEN k % 3 = 0 THEN p ELSE 2 * p END END AS salary_max, CASE WHEN m < 4 THEN 'month' END AS salary_period, CASE WHEN m < 4 THEN o_orderpriority END AS education_raw,
CASE WHEN m < 4 THEN (k % 60) || ' bulan' END AS experience_raw, CASE WHEN m < 4 THEN 'FULL_TIME, CONTRACT' END AS employment_type, CASE WHEN m < 4 THEN 'Satu' || chr(10) || 'nomor ' || k || chr(10) || chr(10) || 'Kualifikasi:' || chr(10) || 'Teliti' END AS description,
CASE WHEN m < 4 THEN strftime(o_orderdate, '%Y-%m-%d') END AS posted_at, CASE WHEN m < 4 THEN 'Jl. ' || k END AS street, CASE WHEN m < 4 THEN 'o' || k END AS source_job_id FROM o""")
def posting_pages(t):
    """Structured data of every shape to postings."""
    read = pages.structured(_postings(t), job_id=pages.id_from_url(F.col("url"), r"/(o\d+)$"))
    return read.select("url", "error", "title", "company_name", "location_raw", "salary_raw", "salary_min", "salary_max", "salary_period", "education_raw", "experience_raw", "employment_type", "description", "posted_at", F.col("extra")["street_address"].alias("street"), "source_job_id")


@query("""WITH o AS (SELECT o_orderkey AS k, CAST(floor(o_totalprice) AS BIGINT) AS p, * FROM orders)
SELECT 'c' || o_custkey AS url, NULL AS error, CAST(k AS VARCHAR) AS source_job_id, 'Kurir ' || k AS title, 'PT ' || o_custkey AS company_name, CASE WHEN k % 5 = 0 THEN 'Remote' ELSE 'Depok, Region ' || o_orderstatus END AS location_raw,
'IDR ' || p || CASE WHEN k % 2 = 1 THEN '-' || (2 * p) ELSE '' END || '/month' AS salary_raw, p AS salary_min, CASE WHEN k % 2 = 1 THEN 2 * p END AS salary_max, CASE k % 3 WHEN 0 THEN 'SMA/SMK' WHEN 1 THEN 'Sarjana (S1)' ELSE 'Code 999' END AS education_raw,
CASE WHEN k % 5 = 0 THEN 'true' END AS remote FROM o WHERE o_custkey % 7 <> 0
UNION ALL SELECT DISTINCT 'c' || o_custkey, 'layout_changed: unexpected payload', NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL FROM o WHERE o_custkey % 7 = 0""")
def search_answers(t):
    """A search answer a customer, with all its orders as postings."""
    k, price = _columns()
    where = F.struct(F.struct(F.lit("Depok").alias("city"), F.concat(F.lit("Region "), "o_orderstatus").alias("region")).alias("address_components"))
    job = F.struct(
        k.cast("string").alias("id"), F.concat(F.lit("Kurir "), k).alias("name"), F.struct(F.concat(F.lit("PT "), "o_custkey").alias("name")).alias("company"), F.when(k % 5 != 0, where).alias("google_location"),
        price.alias("base_salary"), F.when(k % 2 == 1, price * 2).alias("maximum_salary"), F.lit("monthly").alias("salary_interval"), F.when(k % 3 == 0, 200).when(k % 3 == 1, 550).otherwise(999).alias("education_level"), (k % 5 == 0).alias("is_work_from_home"),
    )
    answers = t("orders").groupBy("o_custkey").agg(F.to_json(F.struct(F.collect_list(job).alias("jobs"))).alias("body"))
    answers = answers.select(F.concat(F.lit("c"), "o_custkey").alias("url"), F.when(F.col("o_custkey") % 7 == 0, "[]").otherwise(F.col("body")).alias("body"))
    return pages.search(answers).select("url", "error", "source_job_id", "title", "company_name", "location_raw", "salary_raw", "salary_min", "salary_max", "education_raw", F.col("extra")["remote"].alias("remote"))


@query("""WITH o AS (SELECT o_orderkey AS k, o_orderkey % 3 <> 0 AS here, CAST(floor(o_totalprice) AS BIGINT) AS p, * FROM orders)
SELECT 'https://x/o' || k AS url, CASE WHEN NOT here THEN 'layout_changed: neither posting nor record' END AS error, CASE WHEN here THEN 'Barista ' || k END AS title, CASE WHEN here THEN 'PT ' || o_custkey END AS company_name, CASE WHEN here THEN 'Depok, Region ' || o_orderstatus END AS location_raw,
CASE WHEN here THEN 'IDR ' || p || '-' || (2 * p) || '/month' END AS salary_raw, CASE WHEN here THEN p END AS salary_min, CASE WHEN here THEN o_orderpriority END AS education_raw, CASE WHEN here THEN 'F&B' END AS industry, CASE WHEN here THEN 'a, "b"' END AS skills FROM o""")
def streamed_pages(t):
    """Records streamed in pieces, behind records of other vacancies; some pages have only the others'."""
    k, price = _columns()
    name = lambda c: F.struct(c.alias("name"))
    own = F.struct(
        F.lit("2").alias("id"), F.concat(F.when(k % 3 == 0, "none").otherwise("o"), k).alias("slug"), F.concat(F.lit("Barista "), k).alias("positionName"), F.col("o_orderpriority").alias("educationLevelStr"), price.alias("salaryLowerBound"), (price * 2).alias("salaryUpperBound"),
        F.struct(F.concat(F.lit("PT "), "o_custkey").alias("name"), name(F.lit("F&B")).alias("companyIndustry")).alias("company"), name(F.lit("Depok")).alias("city"), name(F.concat(F.lit("Region "), "o_orderstatus")).alias("province"), F.array(F.lit("a"), F.lit('"b"')).alias("skillTags"), F.lit("seduh").alias("description"),
    )
    other = F.struct(F.struct(F.lit("1").alias("id"), F.lit("other").alias("slug")).alias("vacancy"))
    record = F.to_json(F.struct(F.array(other).alias("similarVacancies"), own.alias("vacancy")))
    # a piece is a string literal: what is between the quotes of a JSON array of one text
    literal = lambda c: F.regexp_extract(F.to_json(F.array(c)), r'(?s)^\["(.*)"\]$', 1)
    piece = lambda c: F.concat(F.lit('<script>self.__next_f.push([1,"'), literal(c), F.lit('"])</script>'))
    cut = (k % 40 + 1).cast("int")
    rows = t("orders").select(F.concat(F.lit("https://x/o"), k).alias("url"), record.alias("r"), cut.alias("cut"))
    body = F.concat(piece(F.substring("r", F.lit(1), F.col("cut"))), piece(F.substring(F.col("r"), F.col("cut") + 1, F.length("r"))))
    read = pages.composite(rows.select("url", body.alias("body")), job_id=pages.id_from_url(F.col("url"), r"/(o\d+)$"))
    return read.select("url", "error", "title", "company_name", "location_raw", "salary_raw", "salary_min", "education_raw", F.col("extra")["industry"].alias("industry"), F.col("extra")["skills"].alias("skills"))


KEY = b"an example key"
LIMITS = runs.Limits(max_pages=500, streak=6, max_age=1500)


@query(f"""WITH l AS (SELECT o_orderkey AS k, o_orderkey % 6 AS m, o_orderkey % 17 = 0 AND o_orderkey % 6 < 4 AS fresh, o_orderdate FROM orders),
a AS (SELECT k, row_number() OVER (ORDER BY k) AS nr, CASE WHEN k % 11 = 0 THEN 'fetch_failed' WHEN m > 3 THEN 'layout_changed' END AS error, k % 11 <> 0 AND m < 4 AND date_diff('day', CAST(o_orderdate AS DATE), DATE '1998-08-02') > {LIMITS.max_age} AS old FROM (SELECT * FROM l WHERE NOT fresh ORDER BY k LIMIT {LIMITS.max_pages})),
g AS (SELECT *, sum(CASE WHEN old THEN 0 ELSE 1 END) OVER (ORDER BY k) AS run FROM a WHERE error IS NULL),
c AS (SELECT *, sum(CAST(old AS INTEGER)) OVER (PARTITION BY run ORDER BY k) AS n FROM g),
e AS (SELECT coalesce(min(k), 9223372036854775807) AS k FROM c WHERE n >= {LIMITS.streak}),
i AS (SELECT * FROM a WHERE nr <= coalesce((SELECT (a.nr + {LIMITS.step} - 1) // {LIMITS.step} * {LIMITS.step} FROM a, e WHERE a.k = e.k), nr)),
w AS (SELECT i.k, error FROM i, e WHERE i.k <= coalesce((SELECT min(c.k) - 1 FROM c WHERE c.k > e.k AND c.k IN (SELECT k FROM i)), 9223372036854775807) AND NOT old),
s AS (SELECT count(*) FILTER (WHERE error IS NULL) AS saved, count(*) FILTER (WHERE error IS NOT NULL) AS wrong, (SELECT error FROM w WHERE error IS NOT NULL GROUP BY error ORDER BY count(*) DESC, min(k) LIMIT 1) AS kind FROM w)
SELECT 'x' AS source, (SELECT count(*) FROM l) AS n_listed, (SELECT count(*) FROM l WHERE fresh) AS n_fresh, (SELECT count(*) FROM i) AS n_fetched, (SELECT count(*) FROM i WHERE old) AS n_old, saved AS n_saved, wrong AS n_errors,
CASE WHEN wrong = 0 THEN 'success' WHEN saved > 0 THEN 'partial' ELSE 'failed' END AS status, kind AS error_type, saved + (SELECT count(*) FROM l WHERE fresh) AS n_postings FROM s""")
def source_run(t):
    """A whole run: listing, skip of fresh postings, page cap, fetch, parse, end at a streak of old ones, landing, log; pages are fetched a hundred at a time until the streak."""
    read = lambda df: pages.structured(df, job_id=pages.id_from_url(F.col("url"), r"/o(\d+)$"))
    stored = _postings(t)
    today, now, before = F.lit("1998-08-02").cast("date"), F.lit("1998-08-02T07:00:00+07:00"), F.lit("1998-08-01T07:00:00+07:00")
    old = written(clean(read(stored.filter("k % 17 = 0")).filter("error IS NULL"), "x", before, KEY).withColumns({"first_fetched_at": before, "vacancy_id": F.lit(None).cast("string")}))
    listed = stored.select(F.col("k").alias("nth"), "url", F.col("k").cast("string").alias("source_job_id"))
    fetch = lambda df: df.join(stored, "url").select("url", F.when(F.col("k") % 11 != 0, F.col("body")).alias("body"), F.when(F.col("k") % 11 == 0, "fetch_failed: 503").alias("error"))
    landed = runs.run_source(listed, old, fetch, read, "x", today, now, LIMITS, KEY)
    return landed.log.crossJoin(landed.postings.agg(F.count(F.lit(1)).alias("n_postings")))


@query("""SELECT lpad(CAST(r_regionkey + 10 AS VARCHAR), 2, '0') AS region_code, r_name AS name, 'province' AS level, NULL AS kind, lpad(CAST(r_regionkey + 10 AS VARCHAR), 2, '0') AS province_code FROM region
UNION ALL SELECT CAST(1000 + n_nationkey AS VARCHAR), CASE WHEN n_nationkey % 3 = 0 THEN 'Kab. ' WHEN n_nationkey % 3 = 1 THEN 'KOTA ' ELSE '' END || n_name, 'regency', CASE WHEN n_nationkey % 3 = 0 THEN 'kab' WHEN n_nationkey % 3 = 1 THEN 'kota' END, CAST(n_regionkey + 10 AS VARCHAR) FROM nation""")
def region_list(t):
    provinces = t("region").select((F.col("r_regionkey") + 10).cast("string").alias("code"), F.col("r_name").alias("name"))
    prefix = F.when(F.col("n_nationkey") % 3 == 0, "Kab. ").when(F.col("n_nationkey") % 3 == 1, "KOTA ").otherwise("")
    regencies = t("nation").select((F.col("n_nationkey") + 1000).cast("string").alias("code"), F.concat(prefix, "n_name").alias("name"), (F.col("n_regionkey") + 10).cast("string").alias("parent"))
    return gazetteer.regions(provinces, regencies)


@query(r"""WITH o AS (SELECT o_orderkey AS n, o_orderkey // 4 AS m, o_orderkey % 4 AS i, o_custkey AS c, o_orderstatus AS s, o_orderpriority AS p FROM orders),
l AS (SELECT n, CASE WHEN i = 0 OR c % 5 = 0 THEN 72 ELSE 144 END AS x0, CASE
  WHEN i = 0 THEN CAST(1000 + m % 9000 AS VARCHAR) || CASE WHEN m % 3 = 0 THEN '.01' ELSE '' END || '  Teknisi nomor ' || m || CASE p WHEN '1-URGENT' THEN ' dan' WHEN '2-HIGH' THEN ' (alat' WHEN '3-MEDIUM' THEN ',' ELSE '' END
  WHEN c % 4 = 1 THEN '- ' || c || ' -' WHEN c % 4 = 2 THEN CAST(c % 10 AS VARCHAR) || ' dikutip' WHEN s = 'F' THEN 'teknisi nomor ' || m || ' memasang' ELSE 'Mesin ' || c END AS text FROM o),
w AS (SELECT *, lead(text, 1) OVER v AS t1, lead(text, 2) OVER v AS t2, lead(text, 3) OVER v AS t3, lead(x0, 1) OVER v AS x1, lead(x0, 2) OVER v AS x2, lead(x0, 3) OVER v AS x3 FROM l WHERE NOT regexp_matches(text, '^-\s*\d+\s*-$') WINDOW v AS (ORDER BY n)),
h AS (SELECT *, regexp_extract(text, '^(\d{4}\.\d{2}|\d{1,4})\s+(\S.*)$', 1) AS code, trim(regexp_extract(text, '^(\d{4}\.\d{2}|\d{1,4})\s+(\S.*)$', 2)) AS title,
  coalesce(regexp_matches(t1, '^(\d{4}\.\d{2}|\d{1,4})\s+\S') AND x1 <= 100, true) AS s1, coalesce(regexp_matches(t2, '^(\d{4}\.\d{2}|\d{1,4})\s+\S') AND x2 <= 100, true) AS s2, coalesce(regexp_matches(t3, '^(\d{4}\.\d{2}|\d{1,4})\s+\S') AND x3 <= 100, true) AS s3
  FROM w WHERE x0 <= 100 AND regexp_matches(text, '^(\d{4}\.\d{2}|\d{1,4})\s+\S')),
b AS (SELECT *, lower(array_to_string(list_slice(regexp_split_to_array(title, '\s+'), 1, 3), ' ')) AS start FROM h),
e AS (SELECT *, CASE WHEN NOT s1 AND starts_with(lower(t1), start) THEN 1 WHEN NOT s1 AND NOT s2 AND starts_with(lower(t2), start) THEN 2 WHEN NOT s1 AND NOT s2 AND NOT s3 AND starts_with(lower(t3), start) THEN 3 END AS ends,
  ends_with(lower(title), ' dan') OR ends_with(title, ',') OR contains(title, '(') AS wraps FROM b),
f AS (SELECT code, n, CASE WHEN ends = 2 OR (ends IS NULL AND wraps AND t1 IS NOT NULL) THEN title || ' ' || t1 WHEN ends = 3 THEN title || ' ' || t1 || ' ' || t2 ELSE title END AS title FROM e)
SELECT code, CAST(CASE WHEN contains(code, '.') THEN 5 ELSE length(code) END AS INTEGER) AS level, arg_min(title, n) AS title, CASE WHEN contains(code, '.') THEN left(code, 4) ELSE nullif(left(code, length(code) - 1), '') END AS parent_code FROM f GROUP BY code""")
def taxonomy_headings(t):
    n, c = F.col("o_orderkey"), F.col("o_custkey")
    m = F.floor(n / 4).cast("long")
    end = F.when(F.col("o_orderpriority") == "1-URGENT", " dan").when(F.col("o_orderpriority") == "2-HIGH", " (alat").when(F.col("o_orderpriority") == "3-MEDIUM", ",").otherwise("")
    head = F.concat((m % 9000 + 1000).cast("string"), F.when(m % 3 == 0, ".01").otherwise(""), F.lit("  Teknisi nomor "), m, end)
    other = F.when(c % 4 == 1, F.concat(F.lit("- "), c, F.lit(" -"))).when(c % 4 == 2, F.concat((c % 10).cast("string"), F.lit(" dikutip"))).when(F.col("o_orderstatus") == "F", F.concat(F.lit("teknisi nomor "), m, F.lit(" memasang"))).otherwise(F.concat(F.lit("Mesin "), c))
    return files.taxonomy(t("orders").select(n.alias("n"), F.when((n % 4 == 0) | (c % 5 == 0), 72).otherwise(144).alias("x0"), F.when(n % 4 == 0, head).otherwise(other).alias("text")))
