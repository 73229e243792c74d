"""Queries over whole tables, against plain Python on small fixtures."""

import hashlib
import random

from pyspark.sql import functions as F

from tessera.functions.similarity import token_set, token_sort
from tessera.operators import classify, graph
from tessera.queries import QUERIES


def test_components_join_all_orders(spark, tmp_path):
    # orders 1 to 39 chain parts that only they join; 40 and 80 hang on the ends
    links = [(40, 100), *((i, 100 + i - 1) for i in range(1, 40)), *((i, 100 + i) for i in range(1, 40)), (80, 139), (41, 500), (42, 501), (42, 502)]
    spark.createDataFrame(links, "l_orderkey long, l_partkey long").write.parquet(f"{tmp_path}/lineitem.parquet")
    group = {}
    for o, p in links:
        x, y = group.setdefault(f"o{o}", {f"o{o}"}), group.setdefault(f"p{p}", {f"p{p}"})
        if x is not y:
            x |= y
            for k in y:
                group[k] = x
    got = {r["id"]: r["root"] for r in QUERIES["order_part_components"](spark, str(tmp_path)).collect()}
    assert got == {k: min(g) for k, g in group.items()}


def test_flat_export_has_all_vacancies(spark, tmp_path):
    frame = lambda name, rows, schema: spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/{name}.parquet")
    orders = [(i, 1 + i % 2, "1998-01-01", "O", "1-URGENT", 5.0) for i in range(1, 31)]
    lines = [(i, 1000 * i + n, n) for i in range(1, 30) for n in range(1, 1 + i % 12)] + [(5, 7, 2)]
    frame("orders", orders, "o_orderkey long, o_custkey long, o_orderdate string, o_orderstatus string, o_orderpriority string, o_totalprice double")
    frame("customer", [(1, 1, "c1"), (2, 2, "c2")], "c_custkey long, c_nationkey long, c_name string")
    frame("nation", [(1, "KENYA"), (2, "PERU")], "n_nationkey long, n_name string")
    frame("lineitem", lines, "l_orderkey long, l_partkey long, l_linenumber int")
    want = set()
    for i, customer, *_ in orders:
        skills = [p for _, p in sorted((n, p) for o, p, n in lines if o == i)][:8]
        want.add(("v" + hashlib.sha1(str(i).encode()).hexdigest()[:10], None if i % 9 == 0 else {1: "Kenya", 2: "Peru"}[customer], "; ".join(map(str, skills)) or None))
    got = [tuple(r) for r in QUERIES["flat_export"](spark, str(tmp_path)).select("id", "region_name", "skills").collect()]
    assert len(got) == 30 and set(got) == want


def test_fuzzy_clusters_equal_brute_force(spark, tmp_path):
    rnd = random.Random(7)
    words = [f"word{i}" for i in range(300)]
    rows = []
    for _ in range(8):
        head, more = rnd.sample(words, 45), rnd.sample(words, 40)
        for k in range(4):  # the first 300 characters agree, the next 200 do not always
            text = " ".join(head + (more if k < 2 else rnd.sample(words, 40)))
            rows.append((len(rows) + 1, text, "en", 1001 + 5 * len(rows)))
    rows += [(50 + k, "same four words title " + " ".join("abc"[k] * (5 + i % 7) for i in range(60)), "en", n) for k, n in ((0, 1003), (1, 2003), (2, 2008))]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    day = lambda d: None if d % 11 == 0 else d % 90

    def match(x, y):
        near = day(x[0]) is None or day(y[0]) is None or abs(day(x[0]) - day(y[0])) <= 30
        if x[1] == y[1]:
            return True
        if x[2] != y[2] or x[3] % 5 != y[3] % 5 or not near:
            return False
        a, b = (" ".join(r[1].split(" ")[:4]) for r in (x, y))
        if a == b and x[3] % 5 and x[3] % 1000 == y[3] % 1000:
            return True
        inside = set(a.split()) <= set(b.split()) or set(b.split()) <= set(a.split())
        return (inside or token_sort(a, b) >= 93) and token_set(x[1][:500].strip(), y[1][:500].strip()) >= 85

    group = {r[0]: r[0] for r in rows}
    for x in rows:
        for y in rows:
            if x[0] < y[0] and match(x, y):
                a, b = sorted((group[x[0]], group[y[0]]))
                group = {k: a if v == b else v for k, v in group.items()}
    got = {int(r["posting_id"]): int(r["root"]) for r in QUERIES["fuzzy_clusters"](spark, str(tmp_path)).collect()}
    assert got == group
    assert got[51] == 50 and got[52] == 52  # equal titles in one region, and in another


def test_classify_limits_are_the_references(spark):
    s = classify.Settings()
    text = "a" * 745 + " tail"
    item = spark.createDataFrame([(text,)], "t string").select(classify.item({}, F.col("t"), s.description_chars).alias("i")).first()["i"]
    assert "tail" in item
    rows = spark.createDataFrame([("x", None, "{}")], "id string, group string, item string")
    step = classify.unit_step(spark.createDataFrame([("2431",)], "unit string"), lambda g: "", s.max_skills)
    reply = '[{"ref": "j1", "unit": "2431", "confidence": 0.9, "skills": [' + ", ".join(f'"s{i}"' for i in range(12)) + "]}]"
    got = classify.run_step(rows, step, lambda *_: reply, s.batch_size)[0].first()["skills"]
    assert got == [f"s{i}" for i in range(10)]


def test_models_meet_as_one_row_each(spark, tmp_path):
    rows = [(i, "ab"[i % 2] if i % 5 else None, 2.0 if i % 2 else 0.5) for i in range(100)]
    spark.createDataFrame(rows, "event_id long, event_type string, value double").write.parquet(f"{tmp_path}/events.parquet")
    got = QUERIES["distinct_models"](spark, str(tmp_path))
    assert [r["model"] for r in got.collect()] == ["b"]
    assert "Aggregate" in got._jdf.queryExecution().optimizedPlan().toString().split("Join LeftSemi")[1]


def test_lines_without_order_or_part_and_rounds_without_orders(spark, tmp_path, monkeypatch):
    seen = []
    whole = graph.components
    monkeypatch.setattr(graph, "components", lambda nodes, *more: seen.append(nodes.count()) or whole(nodes, *more))
    links = [(i, i % 3) for i in range(300)] + [(None, 1), (7, None), (900, None), (None, 901), (12, 1), (None, None)]
    spark.createDataFrame(links, "l_orderkey long, l_partkey long").write.parquet(f"{tmp_path}/lineitem.parquet")
    got = {r["id"]: r["root"] for r in QUERIES["order_part_components"](spark, str(tmp_path)).collect()}
    third = lambda k: "o0" if k in (0, 1) else "o101"
    want = {f"o{i}": third(i % 3) for i in range(300)} | {"p0": "o0", "p1": "o0", "p2": "o101", "o900": "o900", "p901": "p901", None: None}
    assert got == want
    assert seen == [3]  # only parts are a graph


def test_records_make_a_companys_key_once_a_row(spark):
    fields = spark.conf.get("spark.sql.debug.maxToStringFields")
    spark.conf.set("spark.sql.debug.maxToStringFields", 1000)
    plan = QUERIES["public_records"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    spark.conf.set("spark.sql.debug.maxToStringFields", fields)
    assert 1 <= plan.count("perseroan terbatas") <= 2
