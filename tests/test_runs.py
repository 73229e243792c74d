"""Runs and re-reading against what a page-by-page loop would do, and reports, sheets and labels as files."""

import json

from pyspark.sql import functions as F

from tessera.operators import evaluate
from tessera.plans import publish, runs
from tessera.plans.ingest import clean
from tessera.sources import files, pages, rawstore
from tests.test_sources import POSTING, page

NOW, BEFORE, TODAY = "2026-10-10T07:00:00+07:00", "2026-10-08T07:00:00+07:00", "2026-10-10"


def read(df):
    return pages.structured(df, job_id=pages.id_from_url(F.col("url"), r"/(\d+)$"))


def body(day):
    return page(json.dumps(POSTING | {"datePosted": day}))


def snapshot(spark, ids, fetched=BEFORE):
    df = spark.createDataFrame([(f"https://x/{i}", body("2026-10-01")) for i in ids], "url string, body string")
    return clean(read(df), "x", F.lit(fetched), b"k").withColumns({"first_fetched_at": F.lit(fetched), "vacancy_id": F.lit("v1")})


def run(spark, days, old, limits=runs.Limits(max_pages=6, streak=2), errors={}):
    listed = spark.createDataFrame([(i, f"https://x/{i}", str(i)) for i in range(len(days))], "nth long, url string, source_job_id string")
    stored = spark.createDataFrame([(f"https://x/{i}", None if i in errors else body(d), errors.get(i)) for i, d in enumerate(days)], "url string, body string, error string")
    return runs.run_source(listed, old, lambda df: df.join(stored, "url").select(*stored.columns), read, "x", F.lit(TODAY).cast("date"), F.lit(NOW), limits, b"k")


def test_run_skips_fresh_caps_pages_and_ends_at_a_streak(spark):
    new, far = "2026-10-09", "2026-01-01"
    got = run(spark, [new, new, far, far, new, new, new, new], snapshot(spark, [0]))
    log = got.log.first().asDict()
    # 0 is fresh; 1 is saved; 2 and 3 are old and end the run; 4 to 6 were fetched with the rest of the six pages
    assert log == {"source": "x", "n_listed": 8, "n_fresh": 1, "n_fetched": 6, "n_old": 2, "n_saved": 1, "n_errors": 0, "status": "success", "error_type": None}
    rows = {r["posting_id"]: r for r in got.postings.collect()}
    assert set(rows) == {"x:0", "x:1"} and rows["x:0"]["fetched_at"] == NOW and rows["x:0"]["first_fetched_at"] == BEFORE and rows["x:0"]["vacancy_id"] == "v1"
    assert rows["x:1"]["fetched_at"] == rows["x:1"]["first_fetched_at"] == NOW and rows["x:1"]["vacancy_id"] is None


def test_run_states(spark):
    new, old = "2026-10-09", snapshot(spark, [99])
    assert run(spark, [new] * 3, old, errors={1: "fetch_failed: 503"}).log.first()[6:] == (1, "partial", "fetch_failed")
    assert run(spark, [new] * 2, old, errors={0: "fetch_failed: 1", 1: "fetch_failed: 2"}).log.first()[5:] == (0, 2, "failed", "fetch_failed")
    assert run(spark, [new] * 3, old, errors={2: "blocked: 403"}).log.first()[6:] == (1, "blocked", "blocked")
    nothing = run(spark, [new], old.withColumn("posting_id", F.lit("x:0"))).log.first()
    assert (nothing["n_fresh"], nothing["n_fetched"], nothing["n_saved"], nothing["status"]) == (1, 0, 0, "success")


def test_reparse(spark, tmp_path):
    saved = [("x", "1", "https://x/1", "2026-10-08", BEFORE, body("2026-10-01")), ("x", "1", "https://x/1", "2026-10-09", "2026-10-09T07:00:00+07:00", body("2026-10-02")), ("x", "2", "https://x/2", "2026-10-09", BEFORE, page("{broken")), ("x", "3", "https://x/3", "2026-10-09", BEFORE, body("2025-01-01")), ("y", "4", "https://x/4", "2026-10-09", BEFORE, body("2026-10-01"))]
    rawstore.save(spark.createDataFrame(saved, "source string, raw_id string, url string, day string, fetched_at string, body string"), f"{tmp_path}")
    got = runs.reparse(spark, f"{tmp_path}", snapshot(spark, [7]), read, "x", F.lit(TODAY).cast("date"), key=b"k")
    assert got.log.first().asDict() == {"source": "x", "n_pages": 4, "n_old": 1, "n_saved": 1, "n_errors": 1, "status": "partial", "error_type": "layout_changed"}
    rows = {r["posting_id"]: r for r in got.postings.collect()}
    assert set(rows) == {"x:7", "x:1"} and rows["x:1"]["posted_at"].startswith("2026-10-02") and rows["x:1"]["fetched_at"] == "2026-10-09T07:00:00+07:00"
    one = runs.reparse(spark, f"{tmp_path}", snapshot(spark, [7]), read, "x", F.lit(TODAY).cast("date"), "2026-10-08", key=b"k")
    assert one.log.first()["n_pages"] == 1 and one.log.first()["status"] == "success"


def test_report_as_a_file(spark, tmp_path):
    sheet = spark.createDataFrame([("1234.01", "1234.01", "1234", None, "0.9"), ("1234.02", "1235.01", "1235", "1234", "x"), ("12", "1111", None, None, None), (" ", "1", None, None, None)], "gold string, predicted string, unit string, second string, confidence string")
    accuracy = evaluate.accuracy_lines(evaluate.prefix_accuracy(sheet, 0.7))
    cost = evaluate.cost_per_thousand(spark.createDataFrame([(2_000_000, 1_000)], "input_tokens long, output_tokens long"), spark.createDataFrame([(1,), (2,)], "id int"), 0.5, 1.0)
    review = spark.createDataFrame([(1234, 12)], "classified long, needs_review long")
    publish.write_markdown(publish.markdown({"Coding": accuracy, "Cost": evaluate.cost_lines(cost, review)}), f"{tmp_path}/r", "Results")
    text = "\n".join(r[0] for r in spark.read.text(f"{tmp_path}/r", wholetext=True).collect())
    lines = text.strip().split("\n")
    assert lines[:6] == ["# Results", "", "## Coding", "", "| Metric | Value |", "|---|---|"]
    assert "| Labelled | 3 |" in lines and "| Unit group (4 digits) | 33.3% |" in lines and "| Unit group, either choice | 66.7% |" in lines and "| 6 digits, n=2 | 50.0% |" in lines
    assert "| Flagged for review | 12 of 1,234 (1.0%) |" in lines and "| Tokens | 2,000,000 in / 1,000 out for 2 vacancies coded |" in lines and "| Cost per 1,000 vacancies | US$500.5 |" in lines
    empty = evaluate.accuracy_lines(evaluate.prefix_accuracy(sheet.limit(0), 0.7)).collect()
    assert [(r["metric"], r["value"]) for r in empty] == [("Not evaluated yet", "–")]
    free = evaluate.cost_lines(evaluate.cost_per_thousand(spark.createDataFrame([], "input_tokens long, output_tokens long"), spark.createDataFrame([], "id int"), 1.0, 1.0), review)
    assert [r["value"] for r in free.collect()][2] == "–"


def test_review_sheet_and_search(spark, tmp_path):
    pairs = spark.createDataFrame([(2, 'b "x", y'), (1, "a")], "pair int, title string")
    publish.write_review(pairs, f"{tmp_path}/s", ["pair"])
    back = files.read_csv(spark, f"{tmp_path}/s")
    assert [tuple(r) for r in back.collect()] == [("1", "a", None), ("2", 'b "x", y', None)]
    assert evaluate.to_label(back, "label").count() == 2
    codes = spark.createDataFrame([(f"{i:04}", f"Kind {i} of Work") for i in range(30)], "code string, title string")
    assert [r["code"] for r in evaluate.find_codes(codes, " WORK ").collect()] == [f"{i:04}" for i in range(15)] and evaluate.find_codes(codes, "  ").count() == 0
