import json
import random
import re

import pytest
from pyspark.sql import functions as F

from tessera.operators.relational import until_streak
from tessera.plans import ingest
from tessera.sources import files, pages, rawstore
from tessera.sources.fetch import Blocked, Disallowed, Fetcher, FetchError
from tests.test_gazetteer import places

POSTING = {
    "@type": "JobPosting", "title": "Staf &amp; Admin", "hiringOrganization": {"name": "PT Contoh"}, "datePosted": "2026-10-01T00:00:00Z", "employmentType": ["FULL_TIME", "CONTRACT"],
    "jobLocation": {"address": {"addressLocality": "Kota Bandung", "addressRegion": "Jawa Barat", "streetAddress": "Jl.  Satu"}},
    "baseSalary": {"currency": "IDR", "value": {"minValue": 5000000, "maxValue": 7000000, "unitText": "MONTH"}},
    "experienceRequirements": {"monthsOfExperience": 24}, "educationRequirements": {"credentialCategory": "bachelor degree"}, "description": "<p>Hubungi Budi</p><p>di 0812-3456-7890</p>", "qualifications": "Teliti",
}


def page(data, more=""):
    return f'<html><script type="application/ld+json">{data}</script>{more}</html>'


def test_structured_pages(spark):
    text = json.dumps(POSTING)
    bodies = [
        page(text), page(f'[{{"@type":"BreadcrumbList"}}, {text}]'), page(text[:-1] + ",}"), page('{"@graph": [' + text + "]}"), page("{broken"), page('{"@type":"JobPosting"}'), None,
        page(json.dumps(POSTING | {"jobLocationType": "TELECOMMUTE", "jobLocation": [], "baseSalary": {"value": {"maxValue": "9,000,000"}}}), '<div><div class="font-bold">Pendidikan</div><div>SMA</div><div>D3</div></div>'),
    ]
    df = spark.createDataFrame([(f"https://x/{i}", b) for i, b in enumerate(bodies)], "url string, body string")
    got = {r["url"][-1]: r for r in pages.structured(df, job_id=pages.id_from_url(F.col("url"), r"/(\d+)$"), labels={"Pendidikan": "education_listed"}, several=("education_listed",)).collect()}
    a = got["0"]
    assert (a["title"], a["company_name"], a["location_raw"], a["salary_raw"], a["salary_min"], a["salary_max"]) == ("Staf & Admin", "PT Contoh", "Kota Bandung, Jawa Barat", "IDR 5000000-7000000/month", 5000000, 7000000)
    assert a["experience_raw"] == "24 bulan" and a["employment_type"] == "FULL_TIME, CONTRACT" and a["education_raw"] == "bachelor degree" and a["source_job_id"] == "0"
    assert a["description"] == "Hubungi Budi\ndi 0812-3456-7890\n\nKualifikasi:\nTeliti" and a["extra"] == {"street_address": "Jl. Satu"}
    assert all(got[k]["title"] == "Staf & Admin" for k in "123") and all(got[k]["error"] for k in "456")
    assert got["7"]["location_raw"] == "Remote" and got["7"]["salary_raw"] == "9000000" and got["7"]["extra"] == {"remote": "true", "education_listed": "SMA / D3"}


def test_search_and_streamed_pages(spark):
    jobs = {"jobs": [{"id": 7, "name": "Kurir", "company": {"code": "c", "name": "Cepat"}, "google_location": {"address_components": {"city": "Depok", "region": "Jawa Barat"}}, "base_salary": 100, "maximum_salary": None, "salary_interval": "daily", "education_level": 999, "work_experience": 200, "is_work_from_home": False, "description": "<p>a</p>", "activation_date": "2026-10-01"}, {"id": 8, "name": "X", "is_work_from_home": True, "education_level": 550}]}
    df = spark.createDataFrame([("u1", json.dumps(jobs)), ("u2", "[]"), ("u3", '{"jobs": null}')], "url string, body string")
    got = pages.search(df).collect()
    assert [(r["url"], r["source_job_id"], r["location_raw"], r["salary_raw"], r["education_raw"]) for r in got] == [("u1", "7", "Depok, Jawa Barat", "IDR 100/day", "Code 999"), ("u1", "8", "Remote", None, "Sarjana (S1)"), ("u2", None, None, None, None)]
    record = {"similarVacancies": [{"vacancy": {"id": "1", "slug": "other"}}], "vacancy": {"id": "2", "slug": "me", "positionName": "Barista", "educationLevelStr": "Minimal SMA", "salaryLowerBound": 3000000, "salaryUpperBound": 4000000, "company": {"name": "Kopi", "companyIndustry": {"name": "F&B"}}, "city": {"name": "Depok"}, "province": {"name": "Jawa Barat"}, "skillTags": ["a", "b"], "description": "seduh"}}
    stream = json.dumps(json.dumps(record, separators=(",", ":")))[1:-1]
    cut = stream.index("similar") + 3
    body = f'<script>self.__next_f.push([1,"{stream[:cut]}"])</script><script>self.__next_f.push([1,"{stream[cut:]}"])</script>'
    df = spark.createDataFrame([("https://x/me", body), ("https://x/none", body)], "url string, body string")
    got = {r["url"]: r for r in pages.composite(df, job_id=pages.id_from_url(F.col("url"), "/([a-z]+)$")).collect()}
    a = got["https://x/me"]
    assert (a["title"], a["location_raw"], a["salary_raw"], a["education_raw"], a["extra"]["industry"], a["extra"]["skills"]) == ("Barista", "Depok, Jawa Barat", "IDR 3000000-4000000/month", "Minimal SMA", "F&B", "a, b")
    assert got["https://x/none"]["error"]
    nested = spark.createDataFrame([("u", '<script id="__NEXT_DATA__" type="application/json">{"a": 1}</script>'), ("v", None)], "url string, body string")
    assert {r["url"]: r["json"] for r in pages.embedded(nested).collect()} == {"u": '{"a": 1}', "v": None}


def test_discovery(spark):
    df = spark.createDataFrame([(2, "<loc>https://x/b</loc><loc>https://x/a</loc>"), (1, "<loc> https://x/a </loc><loc>https://y/c</loc>")], "n int, body string")
    assert [r[0] for r in pages.links(df, "body", r"<loc>\s*(https://x/[^<\s]+)\s*</loc>", "n").collect()] == ["https://x/a", "https://x/b"]
    urls = spark.createDataFrame([("m_10.xml",), ("m_9.xml",), ("other",)], "url string")
    assert [r[0] for r in pages.sitemap_order(urls, r"m_(\d+)\.xml$").collect()] == ["m_9.xml", "m_10.xml"]
    assert [r[0] for r in pages.offsets(spark, 3, 15).collect()] == [0, 15, 30]


def test_listing_files_and_taxonomy(spark, tmp_path):
    (tmp_path / "l.csv").write_text('﻿id,title,salary_min,posted_days_ago,extra_job_level,description\n1,"Admin, staf",5000000.0,3,Junior,"two\nlines"\n2,,,,,\n', encoding="utf-8")
    good, bad = files.listings(files.read_csv(spark, str(tmp_path / "l.csv")), F.lit("2026-10-10").cast("date"), {"source_job_id": "id"})
    r = good.first()
    assert (r["source_job_id"], r["title"], r["salary_min"], r["posted_at"], r["extra"], r["description"]) == ("1", "Admin, staf", 5000000, "2026-10-07", {"job_level": "Junior"}, "two\nlines")
    assert bad.count() == 1
    lines = [(72, "1 Manajer"), (144, "Manajer mengatur."), (72, "- 3 -"), (72, "1234 Teknisi Mesin"), (72, "Besar dan Kecil"), (144, "teknisi mesin besar memasang"), (72, "1234.01 Operator (alat"), (72, "berat)"), (144, "x"), (144, "1 dikutip"), (72, "1 Ulang")]
    df = spark.createDataFrame([(i, float(x), t) for i, (x, t) in enumerate(lines)], "n int, x0 double, text string")
    got = {r["code"]: (r["level"], r["title"], r["parent_code"]) for r in files.taxonomy(df).collect()}
    assert got == {"1": (1, "Manajer", None), "1234": (4, "Teknisi Mesin Besar dan Kecil", "123"), "1234.01": (5, "Operator (alat berat)", "1234")}
    assert {(r["problem"], r["n"]) for r in files.taxonomy_problems(files.taxonomy(df), {1: 1, 4: 2}).collect()} == {("level 4", 1), ("orphans", 1)}


def brute_taxonomy(lines):
    """(code: title) by one walk over (x0, text) lines."""
    kept = [(x, t.strip()) for x, t in lines if not re.match(r"^-\s*\d+\s*-$", t.strip())]
    codes = {}
    head = lambda i: kept[i][0] <= 100 and re.match(files.HEADING, kept[i][1])
    for i in range(len(kept)):
        if not head(i):
            continue
        code, title = head(i)[1], head(i)[2].strip()
        following = []
        for k in range(i + 1, min(i + 4, len(kept))):
            if head(k):
                break
            following.append(kept[k][1])
        start = " ".join(title.split()[:3]).lower()
        at = next((k for k, t in enumerate(following) if t.lower().startswith(start)), None)
        if at is not None:
            title = " ".join([title, *following[:at]])
        elif i + 1 < len(kept) and (title.split()[-1].lower() in files.CONNECTORS or title.endswith(",") or title.count("(") > title.count(")")):
            title += " " + kept[i + 1][1]
        codes.setdefault(code, title)
    return codes


def test_taxonomy_over_ranges(spark):
    rnd = random.Random(6)
    words = ["1 Manajer", "12 Teknisi dan", "1234 Ahli (alat", "1234.01 Juru,", "juru, x", "manajer mengatur", "ahli (alat berat", "teknisi dan y", "- 7 -", "lain", "besar"]
    shapes = [[(rnd.choice((72, 144)), rnd.choice(words).replace("1", str(rnd.randint(1, 99)), 1) if rnd.random() < 0.7 else rnd.choice(words)) for _ in range(size)] for size in (0, 1, 5, 30, 3000)]
    before = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.coalescePartitions.enabled", "spark.sql.shuffle.partitions")}
    try:
        for parts, lines in zip((3, 3, 9, 25, 7), shapes, strict=True):  # ranges of one line or none, too
            spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
            spark.conf.set("spark.sql.shuffle.partitions", str(parts))
            df = spark.createDataFrame([(i, float(x), t) for i, (x, t) in enumerate(lines)], "n int, x0 double, text string").repartition(4)
            assert {r["code"]: r["title"] for r in files.taxonomy(df).collect()} == brute_taxonomy(lines)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_raw_store_and_ingest(spark, tmp_path):
    rows = [("s", "id/1", "https://x/1", "2026-10-09", "2026-10-09T07:00:00+07:00", page(json.dumps(POSTING)))]
    rawstore.save(spark.createDataFrame(rows, "source string, raw_id string, url string, day string, fetched_at string, body string"), str(tmp_path))
    back = rawstore.load(spark, str(tmp_path), "s", "2026-10-09")
    r = back.first()
    assert r["key"] == "raw/s/2026-10-09/id_1.html.gz" and json.loads(r["meta"])["bytes"] == len(rows[0][5].encode())
    assert rawstore.load(spark, str(tmp_path), "t").count() == 0
    parsed = pages.structured(back.withColumn("url", F.get_json_object("meta", "$.url")), job_id=F.lit("1")).filter("error is null")
    cleaned = ingest.clean(parsed, "s", F.lit("2026-10-09T07:00:00+07:00"), b"key")
    out = ingest.normalise(cleaned, places(spark))
    r = out.first()
    assert r["description_masked"] == "Hubungi [disamarkan] [disamarkan] Kualifikasi: Teliti" and r["posted_at"] == "2026-10-01T07:00:00+07:00"
    assert (r["region_code"], r["province_code"], r["education_level"], r["experience_years"], r["employment_type"], r["salary_min"], r["is_remote"]) == ("3273", "32", "D4/S1", 2, "full_time", 5000000, False)
    assert ingest.coverage(out).first()["regency_level"] == 1.0
    first = out.withColumns({"first_fetched_at": F.lit("2026-01-01"), "vacancy_id": F.lit("v")})
    landed = ingest.land(first, out.withColumn("fetched_at", F.lit("2026-10-10T07:00:00+07:00")), F.lit("2026-10-10").cast("date")).first()
    assert (landed["first_fetched_at"], landed["vacancy_id"], landed["fetched_at"][:10]) == ("2026-01-01", "v", "2026-10-10")


def test_run_status_and_streak(spark):
    items = [("a", 1, None), ("b", 1, "x"), ("b", 2, "y"), ("c", 1, None), ("c", 2, "y"), ("c", 3, "x"), ("c", 4, "x")]
    df = spark.createDataFrame(items, "run string, n int, error string")
    assert {r["run"]: (r["status"], r["error_type"]) for r in ingest.run_status(df, ["run"], "error", "n").collect()} == {"a": ("success", None), "b": ("failed", "x"), "c": ("partial", "x")}
    old = [0, 1, 1, 0, 1, 1, 1, 0, 1]
    rows = spark.createDataFrame([("s", i, bool(x)) for i, x in enumerate(old)], "s string, n int, old boolean")
    assert sorted(r["n"] for r in until_streak(rows, ["s"], ["n"], F.col("old"), 3).collect()) == list(range(7))


def test_fetcher():
    answers = {"https://a/robots.txt": (200, {}, "User-agent: *\nDisallow: /no"), "https://b/robots.txt": (500, {}, ""), "https://a/ok": (200, {}, "body"), "https://a/403": (403, {}, ""), "https://a/404": (404, {}, "")}
    waits, tries = [], []

    def transport(url):
        tries.append(url)
        if url == "https://a/busy":
            return (429, {"Retry-After": "7"}, "") if tries.count(url) < 3 else (200, {}, "late")
        return answers[url]

    f = Fetcher(transport, sleep=waits.append, clock=lambda: 0.0)
    assert f.get("https://a/ok") == "body" and f.get("https://a/busy") == "late" and waits.count(7.0) == 2 and max(waits) <= 7
    for url, error in (("https://a/no", Disallowed), ("https://b/x", Disallowed), ("https://a/403", Blocked), ("https://a/404", FetchError)):
        with pytest.raises(error):
            f.get(url)


def test_postings_of_any_depth_in_order(spark):
    job = lambda n: {"@type": "JobPosting", "title": n}
    deep = job("deep")
    for _ in range(40):
        deep = [{"@graph": [deep, {"@type": "WebPage"}]}]
    cases = [
        ([[job("a")]], ["a"]),
        ({"@graph": [{"@graph": [job("b")]}]}, ["b"]),
        ({"@graph": [[job("c")], "x", None, 3]}, ["c"]),
        ([job("d"), [job("e"), {"@type": ["Thing", "JobPosting"], "title": "f", "@graph": [job("g"), [job("h")]]}], job("i [ {")], ["i [ {", "f", "h", "g", "e", "d"]),
        (deep, ["deep"]),
        ([], []),
        ({"a": [job("not reached")]}, []),
        ("text", []),
    ]
    rows = [(i, f'<script type="application/ld+json">{json.dumps(v)}</script>') for i, (v, _) in enumerate(cases)] + [(99, None), (98, '<script type="application/ld+json">{"a": ]]]</script>')]
    found = spark.createDataFrame(rows, "i int, body string").select("i", F.transform(pages.postings_in(F.col("body")), lambda v: F.try_variant_get(v, "$.title", "string")).alias("titles"))
    assert {r["i"]: r["titles"] for r in found.collect()} == {i: want for i, (_, want) in enumerate(cases)} | {99: [], 98: []}


def test_pages_of_one_file_are_dealt_out(spark):
    """Reading pages is many tasks' work, however few files and splits the orders have."""
    from tessera.queries import sources as queries

    one = spark.range(400).selectExpr("id o_orderkey", "id % 7 o_custkey", "'O' o_orderstatus", "id + 0.5D o_totalprice", "date'1998-01-01' o_orderdate", "'1-URGENT' o_orderpriority").coalesce(1)
    made = queries._postings(lambda name: one).groupBy(F.spark_partition_id().alias("task")).count().collect()
    assert len(made) == int(spark.conf.get("spark.sql.shuffle.partitions")) and max(r["count"] for r in made) < 200
