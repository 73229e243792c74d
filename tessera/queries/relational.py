"""Relational operators over the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.operators import relational as R
from tessera.operators.graph import shared_path
from tessera.operators.snapshots import KeyedTable
from tessera.queries import query


@query("""SELECT event_type AS source_id, event_id AS run_id, ts AS started_at FROM
(SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY ts DESC, event_id DESC) rn FROM events) WHERE rn <= 14""")
def latest_runs(t):
    runs = t("events").select(F.col("event_type").alias("source_id"), F.col("event_id").alias("run_id"), F.col("ts").alias("started_at"))
    return R.top_n_per_group(runs, ["source_id"], [F.desc("started_at"), F.desc("run_id")], 14)


@query("""SELECT o_orderkey, CAST(o_orderdate AS DATE)::VARCHAR AS day FROM orders o
WHERE NOT EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = o.o_orderkey AND l_returnflag = 'R')
ORDER BY o_orderdate DESC, o_orderkey LIMIT 500""")
def pending_anti_join(t):
    returned = t("lineitem").filter("l_returnflag = 'R'").select(F.col("l_orderkey").alias("o_orderkey"))
    return t("orders").join(returned, "o_orderkey", "left_anti").orderBy(F.desc("o_orderdate"), "o_orderkey").limit(500).select("o_orderkey", F.to_date("o_orderdate").cast("string").alias("day"))


@query("SELECT c_custkey, c_name FROM customer c WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey = c.c_custkey)")
def coded_semi_join(t):
    return t("customer").join(t("orders").select(F.col("o_custkey").alias("c_custkey")), "c_custkey", "left_semi").select("c_custkey", "c_name")


@query("""SELECT o_orderkey, c_name, n_name FROM orders JOIN customer ON o_custkey = c_custkey LEFT JOIN nation ON c_nationkey = n_nationkey""")
def canonical_join(t):
    return t("orders").join(t("customer"), F.col("o_custkey") == F.col("c_custkey")).join(t("nation"), F.col("c_nationkey") == F.col("n_nationkey"), "left").select("o_orderkey", "c_name", "n_name")


@query("""WITH ref AS (SELECT p_brand AS code, 'brand ' || p_brand AS title FROM part UNION SELECT p_type, 'type ' || p_type FROM part WHERE p_type LIKE '%A%' UNION SELECT substr(p_type, 1, 1), 'major ' || substr(p_type, 1, 1) FROM part)
SELECT p_partkey, k6.title AS title6, k4.title AS title4, k1.title AS title1 FROM part
LEFT JOIN ref k6 ON k6.code = p_brand LEFT JOIN ref k4 ON k4.code = p_type LEFT JOIN ref k1 ON k1.code = substr(p_type, 1, 1)""")
def taxonomy_levels_join(t):
    part = t("part")
    level = lambda c, word: part.select(c.alias("code"), F.concat(F.lit(f"{word} "), c).alias("title"))
    first = F.left("p_type", F.lit(1))
    ref = level(F.col("p_brand"), "brand").unionByName(level(F.col("p_type"), "type").filter("code like '%A%'")).unionByName(level(first, "major")).distinct()
    named = lambda n: ref.select(F.col("code").alias(f"c{n}"), F.col("title").alias(f"title{n}"))
    out = part.join(named(6), F.col("c6") == F.col("p_brand"), "left").join(named(4), F.col("c4") == F.col("p_type"), "left").join(named(1), F.col("c1") == first, "left")
    return out.select("p_partkey", "title6", "title4", "title1")


@query("""SELECT count(*) FILTER (WHERE l_partkey IS NOT NULL AND l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_size < 40)) AS invalid_parts,
count(*) FILTER (WHERE l_suppkey IS NOT NULL AND l_suppkey NOT IN (SELECT s_suppkey FROM supplier WHERE s_acctbal > 0)) AS invalid_suppliers FROM lineitem""")
def invalid_codes(t):
    lines = t("lineitem")
    parts = R.not_in(lines, "l_partkey", t("part").filter("p_size < 40"), "p_partkey").agg(F.count(F.lit(1)).alias("invalid_parts"))
    suppliers = R.not_in(lines, "l_suppkey", t("supplier").filter("s_acctbal > 0"), "s_suppkey").agg(F.count(F.lit(1)).alias("invalid_suppliers"))
    return parts.crossJoin(suppliers)


@query("""SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderkey IN (SELECT DISTINCT l_orderkey FROM lineitem WHERE l_quantity > 45)""")
def orphans(t):
    kept = R.drop_orphans(t("orders").withColumnRenamed("o_orderkey", "k"), t("lineitem").filter("l_quantity > 45").withColumnRenamed("l_orderkey", "k"), "k")
    return kept.select(F.col("k").alias("o_orderkey"), "o_orderstatus")


@query("""SELECT event_type AS step, count(*) AS calls, CAST(round(sum(value), 4) AS DOUBLE) AS total, count(DISTINCT user_id) AS users FROM events GROUP BY 1""")
def usage_by_step(t):
    return t("events").groupBy(F.col("event_type").alias("step")).agg(F.count(F.lit(1)).alias("calls"), F.round(F.sum("value"), 4).alias("total"), F.count_distinct("user_id").alias("users"))


@query("SELECT source, count(*) AS n FROM documents GROUP BY 1")
def rows_per_source(t):
    return t("documents").groupBy("source").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT DISTINCT event_type AS model FROM events WHERE event_type IN (SELECT event_type FROM events WHERE value > 1)")
def distinct_models(t):
    events = t("events")
    # each side is one row a model before they meet: what a task holds does not grow with the events
    return events.select("event_type").distinct().join(events.filter("value > 1").select("event_type").distinct(), "event_type", "left_semi").select(F.col("event_type").alias("model"))


@query("""WITH few AS (SELECT o_custkey, o_orderpriority, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey) rn FROM orders),
firsts AS (SELECT o_custkey, o_orderpriority, min(rn) f FROM few WHERE rn <= 5 GROUP BY 1, 2),
ranked AS (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY f) k FROM firsts)
SELECT o_custkey, string_agg(o_orderpriority, '|' ORDER BY f) AS hints FROM ranked WHERE k <= 3 GROUP BY 1""")
def company_hints(t):
    out = R.first_distinct(t("orders"), ["o_custkey"], [F.desc("o_orderdate"), F.col("o_orderkey")], "o_orderpriority", 5, 3)
    return out.select("o_custkey", F.array_join("values", "|").alias("hints"))


@query("""SELECT l_orderkey, l_linenumber, l_returnflag FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY (l_returnflag = 'R') DESC, l_shipdate DESC, l_linenumber DESC, l_partkey DESC) rn FROM lineitem) WHERE rn = 1""")
def best_classification(t):
    rows = t("lineitem").withColumn("ok", F.col("l_returnflag") == "R").select("l_orderkey", "ok", "l_shipdate", "l_linenumber", "l_partkey", "l_returnflag")
    return R.last_row_wins(rows, ["l_orderkey"], ["ok", "l_shipdate", "l_linenumber", "l_partkey"]).select("l_orderkey", "l_linenumber", "l_returnflag")


@query("""WITH old AS (SELECT o_orderkey AS id, o_totalprice AS price, 1 AS version, 100 + o_orderkey % 7 AS first_at, 'v' || o_orderkey AS vacancy FROM orders WHERE o_orderkey % 2 = 0),
new AS (SELECT o_orderkey AS id, o_totalprice + 1 AS price, 2 AS version, 200 AS first_at, CAST(NULL AS VARCHAR) AS vacancy FROM orders WHERE o_orderkey % 3 = 0)
SELECT coalesce(n.id, o.id) AS id, coalesce(n.price, o.price) AS price, coalesce(n.version, o.version) AS version, least(coalesce(o.first_at, n.first_at), coalesce(n.first_at, o.first_at)) AS first_at, o.vacancy FROM old o FULL JOIN new n ON n.id = o.id""")
def snapshot_upsert(t):
    o = t("orders")
    old = o.filter("o_orderkey % 2 = 0").select(F.col("o_orderkey").alias("id"), F.col("o_totalprice").alias("price"), F.lit(1).alias("version"), (100 + F.col("o_orderkey") % 7).alias("first_at"), F.concat(F.lit("v"), "o_orderkey").alias("vacancy"))
    new = o.filter("o_orderkey % 3 = 0").select(F.col("o_orderkey").alias("id"), (F.col("o_totalprice") + 1).alias("price"), F.lit(2).alias("version"), F.lit(200).cast("long").alias("first_at"), F.lit(None).cast("string").alias("vacancy"))
    return R.upsert(old, new, ["id"], "version", ["first_at"], ["vacancy"])


@query("""SELECT o_orderkey AS id, CASE WHEN o_orderkey % 90 = 0 THEN -1 ELSE o_totalprice END + CASE WHEN o_orderkey % 60 = 1 THEN 1 ELSE 0 END AS price, CASE WHEN o_orderkey % 90 = 0 THEN 3 WHEN o_orderkey % 60 = 1 THEN 2 ELSE 1 END AS version FROM orders
WHERE (o_orderkey % 2 = 0 OR o_orderkey % 60 = 1) AND o_orderkey % 77 <> 0""")
def bucketed_changes(t):
    """A keyed table of half the orders, then an upsert, an update by key and a deletion; each rewrites the buckets of its own keys."""
    o = t("orders").select(F.col("o_orderkey").alias("id"), F.col("o_totalprice").alias("price"), F.lit(1).alias("version"))
    table = KeyedTable.create(o.filter("id % 2 = 0"), shared_path(o.sparkSession, "orders"), ["id"], 16)
    table.change(o.filter("id % 60 = 1").withColumns({"price": F.col("price") + 1, "version": F.lit(2)}), lambda old, new: R.upsert(old, new, ["id"], "version"))
    table.change(o.filter("id % 90 = 0").select("id", F.lit(-1.0).alias("price"), F.lit(3).alias("version")), lambda old, new: R.update_by_key(old, new, ["id"]))
    table.change(o.filter("id % 77 = 0").select("id"), lambda old, new: old.join(new, "id", "left_anti"))
    return table.read()


@query("""SELECT c_custkey AS id, c_name AS name FROM customer WHERE c_custkey % 2 = 0 UNION ALL
SELECT o_custkey, min('order ' || lpad(CAST(o_orderkey AS VARCHAR), 9, '0')) FROM orders WHERE o_custkey % 2 = 1 GROUP BY 1""")
def insert_if_absent(t):
    old = t("customer").filter("c_custkey % 2 = 0").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"))
    new = t("orders").select(F.col("o_custkey").alias("id"), F.concat(F.lit("order "), F.lpad(F.col("o_orderkey").cast("string"), 9, "0")).alias("name"))
    return R.insert_if_absent(old, new.join(t("customer").select(F.col("c_custkey").alias("id")), "id", "left_semi"), ["id"], ["name"])


@query("""SELECT o_orderkey FROM orders WHERE (CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE o_orderkey % 100 END) IS NULL OR o_orderkey % 100 < o_custkey % 100""")
def incremental_filter(t):
    rows = t("orders").withColumns({"done": F.when(F.col("o_orderkey") % 3 != 0, F.col("o_orderkey") % 100), "changed": F.col("o_custkey") % 100})
    return R.incremental(rows, "done", "changed").select("o_orderkey")


@query("""SELECT l_orderkey, l_linenumber, 'kept' AS what FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F')
UNION ALL SELECT o_orderkey, 0, 'new' FROM orders WHERE o_orderstatus = 'F'""")
def replace_children(t):
    kids = t("lineitem").select("l_orderkey", "l_linenumber", F.lit("kept").alias("what"))
    new = t("orders").filter("o_orderstatus = 'F'").select(F.col("o_orderkey").alias("l_orderkey"), F.lit(0).alias("l_linenumber"), F.lit("new").alias("what"))
    return R.replace_children(kids, new, "l_orderkey")


@query("""SELECT c_custkey, CASE WHEN n.k IS NOT NULL THEN n.segment ELSE c_mktsegment END AS segment FROM customer LEFT JOIN (SELECT o_custkey AS k, max(o_orderpriority) AS segment FROM orders WHERE o_orderstatus = 'O' GROUP BY 1) n ON n.k = c_custkey""")
def keyed_update(t):
    changes = t("orders").filter("o_orderstatus = 'O'").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.max("o_orderpriority").alias("segment"))
    return R.update_by_key(t("customer").select("c_custkey", F.col("c_mktsegment").alias("segment")), changes, ["c_custkey"])


@query("""WITH r AS (SELECT *, l_quantity > 10 AS old FROM lineitem),
runs AS (SELECT *, row_number() OVER w - sum(CASE WHEN old THEN 1 ELSE 0 END) OVER w AS island FROM r WINDOW w AS (PARTITION BY l_suppkey ORDER BY l_shipdate, l_orderkey, l_linenumber, l_partkey)),
counted AS (SELECT *, sum(CASE WHEN old THEN 1 ELSE 0 END) OVER (PARTITION BY l_suppkey, island ORDER BY l_shipdate, l_orderkey, l_linenumber, l_partkey ROWS UNBOUNDED PRECEDING) AS streak FROM runs),
over AS (SELECT *, coalesce(max(streak) OVER (PARTITION BY l_suppkey ORDER BY l_shipdate, l_orderkey, l_linenumber, l_partkey ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS worst FROM counted)
SELECT l_suppkey, count(*) AS n FROM over WHERE worst < 12 GROUP BY 1""")
def old_streak_stop(t):
    order = ["l_shipdate", "l_orderkey", "l_linenumber", "l_partkey"]
    return R.until_streak_in_ranges(t("lineitem").select("l_suppkey", "l_quantity", *order), ["l_suppkey"], order, F.col("l_quantity") > 10, 12).groupBy("l_suppkey").agg(F.count(F.lit(1)).alias("n"))


@query("""WITH n AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) - 1 AS k FROM conversations)
SELECT conv_id, CAST(k // 3 AS BIGINT) AS batch, count(*) AS size, sha1(string_agg(text, '|' ORDER BY k)) AS digest FROM n GROUP BY 1, 2""")
def batches(t):
    out = R.batches(t("conversations"), ["conv_id"], ["turn", "role", "text"], 3, F.col("text"))
    return out.select("conv_id", "batch", F.size("items").cast("long").alias("size"), F.sha1(F.encode(F.array_join("items", "|"), "UTF-8")).alias("digest"))


@query("""SELECT o_custkey, o_orderpriority FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY n DESC, f) rn FROM (SELECT o_custkey, o_orderpriority, count(*) n, min(o_orderkey) f FROM orders GROUP BY 1, 2)) WHERE rn = 1""")
def company_mode(t):
    return R.mode_first(t("orders"), ["o_custkey"], "o_orderpriority", "o_orderkey")


@query("""SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 20 OFFSET 20""")
def page_2(t):
    return R.page(t("orders").select("o_orderkey", "o_totalprice"), [F.desc("o_totalprice"), F.col("o_orderkey")], 2)
