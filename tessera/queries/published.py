"""Published records with all their fields, public and local, through `publish.records` and `publish.flat`: every order is a vacancy, its customer the company."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.plans import publish
from tessera.queries import query

SQL_V = """SELECT o_orderkey AS k, o_orderstatus AS s, o_orderpriority AS education, CAST(floor(o_totalprice) AS BIGINT) AS price, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS first_seen, CAST(CAST(o_orderdate AS DATE) + 5 AS VARCHAR) AS last_seen, CASE WHEN o_orderkey % 7 <> 0 THEN c_name END AS company_name,
c_nationkey, CASE WHEN o_orderkey % 9 <> 0 THEN 'DI ' || n_name END AS region, r_name, 'Staf ' || c_name || ' nomor ' || o_orderkey AS title, repeat('Nomor ' || o_orderkey || ' di ' || replace(lower(c_name), '#', ' ') || ',  ', CAST(o_orderkey % 8 + 1 AS INTEGER)) || c_name AS description
FROM orders JOIN customer ON o_custkey = c_custkey LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey WHERE o_orderstatus <> 'F'"""
SQL_SKILLS = "SELECT l_orderkey, string_agg(CAST(l_partkey AS VARCHAR), '; ' ORDER BY l_linenumber, l_partkey) AS skills FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey) AS n FROM lineitem) WHERE n <= 8 GROUP BY 1"


def _sql(public: bool) -> str:
    name = r"replace(company_name, '#', '[ #]')"
    hidden = lambda c: f"CASE WHEN company_name IS NULL THEN {c} ELSE regexp_replace({c}, '(?i)' || {name}, '[perusahaan]', 'g') END" if public else c
    return f"""WITH v AS ({SQL_V}), h AS (SELECT *, {hidden("title")} AS shown, trim(regexp_replace({hidden("description")}, '\\s+', ' ', 'g')) AS w FROM v)
SELECT {"'v' || left(sha1(CAST(k AS VARCHAR)), 10)" if public else "CAST(k AS VARCHAR)"} AS id, shown AS title, '#' || left(sha256(company_name), 6) AS company, CASE WHEN k % 4 <> 0 THEN (1000 + k % 9000) || '.01' END AS code, CASE WHEN k % 4 <> 0 THEN 'Kode ' || k % 9000 END AS code_title,
CASE WHEN k % 4 <> 0 THEN CAST(1000 + k % 9000 AS VARCHAR) END AS unit, CASE WHEN k % 4 <> 0 THEN CASE WHEN k % 3 = 0 THEN k % 10 / 10 ELSE 0.5 END END AS confidence, CASE WHEN k % 4 <> 0 THEN k % 5 = 0 END AS needs_review, CASE WHEN k % 6 <> 0 THEN s END AS section,
CASE WHEN region IS NOT NULL THEN CAST(c_nationkey AS VARCHAR) END AS region_code, 'DI ' || upper(left(region[4:], 1)) || lower(region[5:]) AS region, CASE WHEN region IS NOT NULL THEN 'Pulau ' || array_to_string(list_transform(string_split(r_name, ' '), lambda x: upper(x[1]) || lower(x[2:])), ' ') END AS province, k % 11 <> 0 AND k % 10 = 0 AS remote,
CASE WHEN k % 3 <> 1 THEN price END AS salary_min, CASE WHEN k % 3 = 0 THEN 2 * price END AS salary_max, education, k % 7 AS experience_years, CASE WHEN k % 2 = 0 THEN 'FULL_TIME' END AS employment_type, k % 3 + 1 AS n_sources, first_seen, last_seen, coalesce(skills, '') AS skills,
CASE WHEN length(w) <= 200 THEN w ELSE regexp_replace(regexp_replace(left(w, 200), ' [^ ]*$', ''), '[,.;:-]+$', '') || '…' END AS description{"" if public else ", company_name, 'https://x/' || k AS url, 's' || k % 5 AS source"}
FROM h LEFT JOIN ({SQL_SKILLS}) ON l_orderkey = k"""


def _vacancies(t):
    """All columns that records are made of; nulls where a vacancy lacks its company, code, section, region, pay or skills."""
    k = F.col("o_orderkey")
    skills = t("lineitem").groupBy(F.col("l_orderkey").alias("__k")).agg(F.transform(F.array_sort(F.collect_list(F.struct("l_linenumber", "l_partkey"))), lambda x: x["l_partkey"].cast("string")).alias("skills"))
    o = t("orders").join(t("customer"), F.col("o_custkey") == F.col("c_custkey")).join(t("nation"), F.col("c_nationkey") == F.col("n_nationkey"), "left").join(t("region"), F.col("n_regionkey") == F.col("r_regionkey"), "left").join(skills, k == F.col("__k"), "left")
    name, day, price, coded, placed = F.when(k % 7 != 0, F.col("c_name")), F.to_date("o_orderdate"), F.floor("o_totalprice").cast("long"), k % 4 != 0, k % 9 != 0
    unit = F.when(coded, (k % 9000 + 1000).cast("string"))
    columns = {
        "vacancy_id": k.cast("string"), "title": F.concat(F.lit("Staf "), "c_name", F.lit(" nomor "), k), "company_name": name, "company_hmac": F.left(F.sha2(F.encode(name, "UTF-8"), 256), F.lit(12)), "url": F.concat(F.lit("https://x/"), k), "source": F.concat(F.lit("s"), k % 5),
        "code": F.concat(unit, F.lit(".01")), "code_title": F.concat(F.lit("Kode "), k % 9000), "unit": unit, "unit_title": F.concat(F.lit("Unit "), unit), "confidence": F.when(k % 3 != 0, 0.5), "confidence4": (k % 10) / 10.0, "reason": F.lit("r"), "needs_review": k % 5 == 0,
        "section": F.when(k % 6 != 0, F.col("o_orderstatus")), "section_title": F.lit("t"), "region_code": F.col("c_nationkey").cast("string"), "region": F.when(placed, F.concat(F.lit("DI "), "n_name")), "province": F.concat(F.lit("pulau  "), "r_name"), "is_remote": F.when(k % 11 != 0, k % 10 == 0),
        "salary_min": F.when(k % 3 != 1, price), "salary_max": F.when(k % 3 == 0, price * 2), "education": F.col("o_orderpriority"), "experience_years": k % 7, "employment_type": F.when(k % 2 == 0, "FULL_TIME"), "n_sources": k % 3 + 1, "first_seen": day.cast("string"), "last_seen": F.date_add(day, 5).cast("string"),
        "skills": F.col("skills"), "is_active": F.col("o_orderstatus") != "F", "description": F.concat(F.repeat(F.concat(F.lit("Nomor "), k, F.lit(" di "), F.replace(F.lower("c_name"), F.lit("#"), F.lit(" ")), F.lit(",  ")), (k % 8 + 1).cast("int")), "c_name"),
    }
    return o.select(*(v.alias(n) for n, v in columns.items()))


@query(_sql(True))
def public_records(t):
    """All active vacancies as public records, flat: hashed ids, pseudonyms, texts without the company's name."""
    return publish.flat(publish.records(_vacancies(t), True, None))


@query(_sql(False))
def local_records(t):
    """The same as local records, with name, url and source."""
    return publish.flat(publish.records(_vacancies(t), False, None))
