"""Run views, the evaluation report, labelling and named orders over the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.operators import evaluate
from tessera.operators import relational as R
from tessera.plans import marts, publish
from tessera.queries import query

SQL_RUNS = "SELECT event_type AS source, event_id AS run_id, ts AS started_at, CASE WHEN value < 20 THEN 'failed' WHEN value < 90 THEN 'success' ELSE 'partial' END AS status, user_id AS n_saved, event_id % 7 AS n_errors FROM events"


def _runs(t):
    status = F.when(F.col("value") < 20, "failed").when(F.col("value") < 90, "success").otherwise("partial")
    return t("events").select(F.col("event_type").alias("source"), F.col("event_id").alias("run_id"), F.col("ts").alias("started_at"), status.alias("status"), F.col("user_id").alias("n_saved"), (F.col("event_id") % 7).alias("n_errors"), F.lit(None).cast("string").alias("error_type"))


@query(f"""SELECT source, CAST(nth AS INTEGER) AS nth, status, n_saved, n_errors FROM (SELECT *, row_number() OVER (PARTITION BY source ORDER BY started_at DESC, run_id DESC) AS nth FROM ({SQL_RUNS})) WHERE nth <= 14""")
def run_history(t):
    return marts.last_runs(_runs(t)).select("source", "nth", "status", "n_saved", "n_errors")


@query(f"""WITH last AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY source ORDER BY started_at DESC, run_id DESC) AS nth FROM ({SQL_RUNS})) WHERE nth = 1 AND source IN ('click', 'view', 'error'))
SELECT count(*) FILTER (WHERE status IN ('success', 'partial')) AS sources_ok, count(*) AS sources_total FROM last""")
def sources_state(t):
    enabled = t("events").sparkSession.createDataFrame([("click",), ("view",), ("error",), ("never",)], "source string")
    return marts.sources_state(_runs(t), enabled, t("events").select(F.col("event_type").alias("source")))


@query("""WITH c AS (SELECT CASE WHEN l_linenumber % 3 <> 0 THEN l_discount * 10 END AS confidence, l_tax AS confidence4, l_returnflag = 'R' AS needs_review FROM lineitem), s AS (SELECT *, least(floor(coalesce(confidence, confidence4) * 10), 9) AS b FROM c)
SELECT b AS bin, count(s.b) AS n, (SELECT count(*) FROM c) AS classified, (SELECT count(*) FILTER (WHERE needs_review) FROM c) AS needs_review FROM (SELECT CAST(unnest(range(10)) AS INTEGER) AS b) bins LEFT JOIN s USING (b) GROUP BY b""")
def review_state(t):
    coded = t("lineitem").select(F.when(F.col("l_linenumber") % 3 != 0, F.col("l_discount") * 10).alias("confidence"), F.col("l_tax").alias("confidence4"), (F.col("l_returnflag") == "R").alias("needs_review"))
    return marts.review_state(coded).select(F.posexplode("confidence_histogram").alias("bin", "n"), "classified", "needs_review")


def _share(part: str, whole: str = "a") -> str:
    return f"coalesce(printf('%.1f%%', round_even(100.0 * {part} / nullif({whole}, 0), 1)), '–')"


@query(f"""WITH p AS (SELECT 's' || (o_orderkey % 5) AS source, o_orderkey % 2 = 0 AS paid, o_orderkey % 3 = 0 AS taught, o_orderkey % 4 = 0 AS seasoned, o_orderkey % 7 < 3 AS placed, o_custkey FROM orders),
t AS (SELECT count(*) AS a, count(DISTINCT o_custkey) AS v, count(*) FILTER (WHERE paid) AS paid, count(*) FILTER (WHERE taught) AS taught, count(*) FILTER (WHERE seasoned) AS seasoned, count(*) FILTER (WHERE placed) AS placed FROM p),
m AS (SELECT 0 AS nth, 'Postings collected' AS metric, format('{{:,}}', a) AS value FROM t UNION ALL SELECT 1, 'from ' || source, format('{{:,}}', count(*)) FROM p GROUP BY source UNION ALL SELECT 2, 'Unique vacancies', format('{{:,}}', v) FROM t
UNION ALL SELECT 3, 'Duplicates merged', format('{{:,}}', a - v) || ' (' || {_share('(a - v)')} || ')' FROM t UNION ALL SELECT 4, 'Salary parsed', {_share('paid')} FROM t UNION ALL SELECT 5, 'Education level parsed', {_share('taught')} FROM t
UNION ALL SELECT 6, 'Experience parsed', {_share('seasoned')} FROM t UNION ALL SELECT 7, 'Location mapped to a regency', {_share('placed')} FROM t)
SELECT 0 AS at, nth, '| ' || metric || ' | ' || value || ' |' AS line FROM m UNION ALL SELECT 0, -1, '## Collection' || chr(10) || chr(10) || '| Metric | Value |' || chr(10) || '|---|---|'""")
def collection_report(t):
    k = F.col("o_orderkey")
    filled = lambda when: F.when(when, 1)
    postings = t("orders").select(F.concat(F.lit("s"), k % 5).alias("source"), filled(k % 2 == 0).alias("salary_min"), filled(k % 3 == 0).alias("education_level"), filled(k % 4 == 0).alias("experience_years"), F.when(k % 7 < 3, "1234").when(k % 7 < 5, "12").alias("region_code"))
    return publish.markdown({"Collection": evaluate.collection_lines(postings, t("orders").agg(F.count_distinct("o_custkey").alias("n")))})


@query("""SELECT p_partkey AS code, p_name AS title FROM part WHERE contains(lower(p_name), 'wid') ORDER BY p_partkey, p_name LIMIT 15""")
def code_search(t):
    return evaluate.find_codes(t("part").select(F.col("p_partkey").alias("code"), F.col("p_name").alias("title")), " Wid")


@query("""WITH s AS (SELECT c_custkey AS id, '1234.0' || (c_custkey % 5) AS predicted, CASE WHEN c_custkey % 4 = 0 THEN '9999' END AS gold FROM customer)
SELECT id, predicted, CASE id % 6 WHEN 0 THEN predicted WHEN 1 THEN '1234.02' WHEN 2 THEN '1234.02' WHEN 3 THEN '1234' ELSE gold END AS gold FROM s""")
def label_sheet(t):
    """Answers of each kind: taken as predicted, six digits with and without a dot, four digits, one that no code has, none at all."""
    k = F.col("c_custkey")
    sheet = t("customer").select(k.alias("id"), F.concat(F.lit("1234.0"), k % 5).alias("predicted"), F.when(k % 4 == 0, "9999").alias("gold"))
    answer = F.when(k % 6 == 0, " ").when(k % 6 == 1, "123402").when(k % 6 == 2, "1234.02 ").when(k % 6 == 3, "1234").otherwise("777777")
    codes = sheet.sparkSession.createDataFrame([("1234",), ("1234.02",)], "code string")
    return evaluate.label(sheet, t("customer").filter(k % 6 != 5).select(k.alias("id"), answer.alias("answer")), "id", "gold", "predicted", codes)


@query("""WITH v AS (SELECT o_orderkey AS id, CAST(o_orderdate AS DATE) AS last_seen, CASE WHEN o_orderkey % 3 <> 0 THEN o_totalprice END AS salary_max, o_custkey % 9 AS n_sources, CASE WHEN o_orderkey % 4 <> 0 THEN (o_orderkey % 100) / 100.0 END AS confidence FROM orders)
SELECT 'new' AS how, id FROM (SELECT id FROM v ORDER BY last_seen DESC NULLS LAST, id LIMIT 20) UNION ALL SELECT 'salary', id FROM (SELECT id FROM v ORDER BY coalesce(salary_max, 0) DESC, id LIMIT 20)
UNION ALL SELECT 'sources', id FROM (SELECT id FROM v ORDER BY n_sources DESC NULLS LAST, id LIMIT 20) UNION ALL SELECT 'confidence', id FROM (SELECT id FROM v ORDER BY coalesce(confidence, 1.0), id LIMIT 20)""")
def named_orders(t):
    """The first page of each named order."""
    k = F.col("o_orderkey")
    v = t("orders").select(k.alias("id"), F.to_date("o_orderdate").alias("last_seen"), F.when(k % 3 != 0, F.col("o_totalprice")).alias("salary_max"), (F.col("o_custkey") % 9).alias("n_sources"), F.when(k % 4 != 0, (k % 100) / 100).alias("confidence"))
    parts = [R.sorted_by(v, how).limit(20).select(F.lit(how).alias("how"), "id") for how in ("new", "salary", "sources", "confidence")]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])


@query("""SELECT event_id FROM events e WHERE event_id < coalesce((SELECT min(event_id) FROM events x WHERE x.event_type = e.event_type AND x.value > 250), 9223372036854775807)""")
def date_stop(t):
    """Rows of each source before its first too-old one, which is left out."""
    return R.until_first(t("events"), ["event_type"], "event_id", F.col("value") > 250).select("event_id")


@query("""SELECT event_type, event_id FROM (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY event_id) AS nth FROM events) WHERE nth <= 40""")
def page_cap(t):
    """Each source's first pages, as many as a run may fetch."""
    return R.top_n_per_group(t("events"), ["event_type"], [F.col("event_id")], 40).select("event_type", "event_id")
