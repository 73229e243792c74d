"""The whole path on generated listings: file rows to clean, resolved, coded, gated and published records."""

import json

from pyspark.sql import functions as F

from tessera.operators import quality, resolve
from tessera.plans import ingest, publish
from tessera.sources import files, sample
from tests.test_gazetteer import places


def today():
    return F.lit("2026-10-10").cast("date")


def test_generator():
    assert sample.rows(50, 3) == sample.rows(50, 3) != sample.rows(50, 4)
    assert len({r[0] for r in sample.rows(200)}) == 200 and len({r[1:8] for r in sample.rows(200)}) < 190


def test_demo(spark, tmp_path):
    good, bad = files.listings(sample.listings(spark, 120), today())
    assert bad.count() == 0
    clean = ingest.clean(good, "sample", F.lit("2026-10-10T07:00:00+07:00"), b"k", exact=False)
    ingest.normalise(clean, places(spark)).write.parquet(f"{tmp_path}/postings")
    rows = spark.read.parquet(f"{tmp_path}/postings")
    assert rows.count() == 120 and rows.filter(F.col("description_masked").rlike("@|0812")).count() == 0
    keyed = resolve.make_keys(rows.withColumnsRenamed({"description_masked": "description", "fetched_at": "first_fetched_at"}), exact=False)
    roots = resolve.clusters(keyed).withColumnRenamed("posting_id", "__p")
    joined = rows.join(roots, F.col("posting_id") == F.col("__p"))
    members = joined.select("root", "posting_id", "source_id", F.left("posted_at", F.lit(10)).cast("date").alias("day"), F.left("fetched_at", F.lit(10)).cast("date").alias("fetched_day"), F.left("valid_through", F.lit(10)).cast("date").alias("valid_day"))
    resolve.assemble(members, today()).write.parquet(f"{tmp_path}/vacancies")
    found = spark.read.parquet(f"{tmp_path}/vacancies")
    stats = resolve.merge_stats(found).first()
    assert stats["postings"] == 120 and stats["merged"] > 3
    null = lambda kind="string": F.lit(None).cast(kind)
    wide = found.withColumnRenamed("root", "vacancy_id").join(rows, F.col("canonical_posting_id") == F.col("posting_id")).withColumns(
        {"source": F.col("source_id"), "code": F.lit("1111.01"), "code_title": F.lit("t"), "unit": F.lit("1111"), "unit_title": F.lit("u"), "confidence": null("double"), "confidence4": F.lit(0.9), "reason": null(), "needs_review": F.lit(False), "section": null(), "section_title": null(), "region": F.when(F.col("region_code").isNotNull(), "KOTA DI DALAM"), "province": F.lit("DKI JAKARTA"), "education": F.col("education_level"), "skills": F.array(F.lit("Excel"), F.lit("SQL")), "description": F.col("description_masked")}
    )
    public = publish.records(wide, True, 500, 60, exact=False)
    first = public.first()["record"]
    assert first["id"].startswith("v") and len(first["company"]) == 7 and first["occupation"]["confidence"] == 0.9 and first["sector"] is None and len(first["description"]) <= 60
    table = publish.flat(public)
    assert "company_name" not in table.columns and table.first()["skills"] == "Excel; SQL" and len(table.columns) == 23
    assert {"company_name", "url", "source"} <= set(publish.flat(publish.records(wide, False, None, exact=False)).columns)
    mart = publish.as_mart("vacancies", table, True, F.lit("2026-10-10T12:00:00+07:00"))
    assert json.loads(mart.first()["json"])["public"] is True
    assert quality.publish_problems(mart, ["vacancies"], {"status": "pass", "checked_at": "2026-10-10T11:00:00+07:00"}).count() == 0


def test_sinks_and_formats(spark, tmp_path):
    df = spark.createDataFrame([(5_500_000, 7_000_000), (12_000_000, 12_000_000), (None, None)], "lo long, hi long").coalesce(1)
    assert [r[0] for r in df.select(publish.salary_text(F.col("lo"), F.col("hi"))).collect()] == ["Rp5,5–7 jt/bulan", "Rp12 jt/bulan", "Gaji tidak dicantumkan"]
    texts = spark.createDataFrame([("<a & 'b'>", "243104"), (None, "2431.04"), ("x", "2431")], "t string, c string").coalesce(1)
    assert [r[0] for r in texts.select(publish.escape_html(F.col("t"))).collect()] == ["&lt;a &amp; &#39;b&#39;&gt;", "", "x"]
    assert [r[0] for r in texts.select(publish.stored_code(F.col("c"))).collect()] == ["2431.04", "2431.04", "2431"]
    codes = spark.createDataFrame([("12", "b", "1"), ("11", "a", "1"), ("21", "c", "2")], "code string, title string, parent string")
    assert publish.listing_table(codes).first()["listing"] == "11 a\n12 b\n21 c"
    assert {r["parent"]: r["listing"] for r in publish.listing_table(codes, "parent").collect()} == {"1": "11 a\n12 b", "2": "21 c"}
    publish.write_marts(publish.as_mart("m", codes, True, F.lit("t")), f"{tmp_path}/m")
    assert len(json.loads(spark.read.text(f"{tmp_path}/m/name=m").first()[0])["rows"]) == 3
    publish.write_csv(codes, f"{tmp_path}/c")
    assert files.read_csv(spark, f"{tmp_path}/c").count() == 3
