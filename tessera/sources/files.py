"""Listing files and reference files: CSV with a column map, spreadsheets, reference tables, heading lines."""

from __future__ import annotations

import zipfile
from collections.abc import Mapping
from xml.etree import ElementTree

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.operators.graph import written
from tessera.operators.relational import in_ranges

INTEGERS = ("salary_min", "salary_max")
TEXTS = ("source_job_id", "url", "title", "company_name", "location_raw", "salary_raw", "salary_min", "salary_max", "salary_period", "education_raw", "experience_raw", "employment_type", "description", "posted_at", "valid_through")


def read_csv(spark: SparkSession, path: str) -> DataFrame:
    """All columns as text, empty ones null, a byte-order mark left out."""
    df = spark.read.csv(path, header=True, multiLine=True, escape='"', nullValue="", ignoreLeadingWhiteSpace=True, ignoreTrailingWhiteSpace=True)
    return df.toDF(*(c.lstrip("﻿") for c in df.columns))


def read_xlsx(spark: SparkSession, path: str) -> DataFrame:
    """The first sheet of a workbook as text; a workbook is one bounded file, read where the driver is."""
    raw = spark.read.format("binaryFile").load(path).select("content").first()[0]
    import io

    space = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
    with zipfile.ZipFile(io.BytesIO(raw)) as z:
        shared = ["".join(t.text or "" for t in si.iter(f"{space}t")) for si in ElementTree.fromstring(z.read("xl/sharedStrings.xml")).iter(f"{space}si")] if "xl/sharedStrings.xml" in z.namelist() else []
        sheet = ElementTree.fromstring(z.read(sorted(n for n in z.namelist() if n.startswith("xl/worksheets/sheet"))[0]))
    rows = []
    for row in sheet.iter(f"{space}row"):
        cells: dict[int, str | None] = {}
        for c in row.iter(f"{space}c"):
            letters = "".join(x for x in c.get("r", "") if x.isalpha())
            at = sum((ord(x) - 64) * 26**i for i, x in enumerate(reversed(letters))) - 1 if letters else len(cells)
            value = c.find(f"{space}v")
            text = "".join(t.text or "" for t in c.iter(f"{space}t")) if c.get("t") == "inlineStr" else value.text if value is not None else None
            cells[at] = shared[int(text)] if c.get("t") == "s" and text is not None else text
        rows.append(cells)
    names = [rows[0].get(i) for i in range(max(rows[0], default=-1) + 1)] if rows else []
    return spark.createDataFrame([tuple(r.get(i) or None for i in range(len(names))) for r in rows[1:]], ", ".join(f"`{n}` string" for n in names))


def listings(df: DataFrame, today: Column, columns: Mapping[str, str] | None = None) -> tuple[DataFrame, DataFrame]:
    """(postings, errors) of a listing file: renamed columns, whole numbers, dates relative to today, extra_* gathered."""
    columns = columns or {}
    have = set(df.columns)
    text = lambda c: F.nullif(F.trim(F.col(c)), F.lit("")) if c in have else F.lit(None).cast("string")
    out = {c: text(columns.get(c, c)) for c in TEXTS}
    for c in INTEGERS:
        out[c] = out[c].try_cast("double").cast("long")
    out["posted_at"] = F.coalesce(F.date_sub(today, text("posted_days_ago").try_cast("int")).cast("string"), out["posted_at"])
    out["valid_through"] = F.coalesce(F.date_add(today, text("valid_days_ahead").try_cast("int")).cast("string"), out["valid_through"])
    extra = [c for c in df.columns if c.startswith("extra_")]
    pairs = F.array(*(F.struct(F.lit(c[6:]).alias("key"), text(c).alias("value")) for c in extra)) if extra else F.array().cast("array<struct<key:string,value:string>>")
    out["extra"] = F.map_from_entries(F.filter(pairs, lambda x: x["value"].isNotNull()))
    rows = df.select(*(v.alias(k) for k, v in out.items()))
    good = F.col("source_job_id").isNotNull() & F.col("title").isNotNull()
    return rows.filter(good), rows.filter(~good).withColumn("error", F.lit("layout_changed: source_job_id and title are required"))


# Shapes of a taxonomy's heading lines, and words that can't end a title.
HEADING = r"^(\d{4}\.\d{2}|\d{1,4})\s+(\S.*)$"
PAGE_NUMBER = r"^-\s*\d+\s*-$"
CONNECTORS = ("dan", "atau", "serta", "di", "yang", "untuk", "dengan", "pada", "dari")


def with_next_lines(rows: DataFrame, ahead: int = 3) -> DataFrame:
    """(n, x0, text) rows of numbered ranges with the text and margin of each of the next lines (t1, x1, ...).

    A range borrows the first lines behind it, be they of one range or of several short ones; only they meet in one
    window, `ahead` lines a range.
    """
    own = Window.partitionBy("__range").orderBy("n")
    first = rows.withColumn("__i", F.row_number().over(own)).filter(F.col("__i") <= ahead)
    behind = Window.orderBy("__range", "n").rowsBetween(1, ahead)
    lent = first.withColumn("__next", F.collect_list(F.struct("n", "x0", "text")).over(behind)).groupBy("__range").agg(F.max_by("__next", "__i").alias("__next"))
    lent = lent.select("__range", F.inline("__next")).select("n", "x0", "text", "__range", F.lit(True).alias("__lent"))
    both = rows.withColumn("__lent", F.lit(False)).unionByName(lent)
    for k in range(1, ahead + 1):
        both = both.withColumn(f"t{k}", F.lead("text", k).over(own)).withColumn(f"x{k}", F.lead("x0", k).over(own))
    return both.filter(~F.col("__lent")).drop("__lent", "__range")


def taxonomy(lines: DataFrame, margin: float = 100, heading: str = HEADING) -> DataFrame:
    """(code, level, title, parent_code) of numbered headings among (n, x0, text) lines in reading order.

    A heading stands at the left margin. A wrapped title goes on until a line (of the next three) that restates its
    first words; without one, only after an open bracket, a comma or a connecting word, for one line. The first
    heading of a code counts. Lines lie in ranges of n, so a list of any length is many tasks' work.
    """
    kept = lines.filter(~F.trim("text").rlike(PAGE_NUMBER)).select("n", "x0", F.trim("text").alias("text"))
    rows = with_next_lines(written(in_ranges(kept, [], ["n"])))
    title = F.trim(F.regexp_extract("text", heading, 2))
    heads = rows.filter(F.col("text").rlike(heading) & (F.col("x0") <= margin)).withColumn("code", F.regexp_extract("text", heading, 1)).withColumn("title", title)
    start = F.lower(F.array_join(F.slice(F.split("title", r"\s+"), 1, 3), " "))
    stop = lambda k: F.coalesce(F.col(f"t{k}").rlike(heading) & (F.col(f"x{k}") <= margin), F.lit(True))
    restates = lambda k: F.coalesce(F.lower(F.col(f"t{k}")).startswith(start), F.lit(False))
    at = (
        F.when(~stop(1) & restates(1), 1)
        .when(~stop(1) & ~stop(2) & restates(2), 2)
        .when(~stop(1) & ~stop(2) & ~stop(3) & restates(3), 3)
    )
    last = F.lower(F.element_at(F.split("title", r"\s+"), -1))
    count = lambda c: F.length("title") - F.length(F.replace(F.col("title"), F.lit(c), F.lit("")))
    wraps = last.isin(*CONNECTORS) | F.col("title").endswith(",") | (count("(") > count(")"))
    full = F.when(at == 2, F.concat_ws(" ", "title", "t1")).when(at == 3, F.concat_ws(" ", "title", "t1", "t2")).when(at.isNull() & wraps & F.col("t1").isNotNull(), F.concat_ws(" ", "title", "t1")).otherwise(F.col("title"))
    named = heads.withColumn("title", full).groupBy("code").agg(F.min_by("title", "n").alias("title"))
    dotted = F.col("code").contains(".")
    parent = F.when(dotted, F.substring_index("code", ".", 1)).otherwise(F.nullif(F.substring(F.col("code"), F.lit(1), F.length("code") - 1), F.lit("")))
    return named.select("code", F.when(dotted, 5).otherwise(F.length("code")).alias("level"), "title", parent.alias("parent_code"))


def taxonomy_problems(codes: DataFrame, expected: Mapping[int, int]) -> DataFrame:
    """(problem, n): levels whose counts are not as expected, and codes without their parent."""
    spark = codes.sparkSession
    want = spark.createDataFrame(list(expected.items()), "level int, expected long")
    counts = codes.groupBy("level").agg(F.count(F.lit(1)).alias("n"))
    wrong = want.join(counts, "level", "left").withColumn("n", F.coalesce("n", F.lit(0))).filter("n <> expected").select(F.concat(F.lit("level "), "level").alias("problem"), "n")
    orphans = codes.filter("parent_code is not null").join(codes.select(F.col("code").alias("parent_code")), "parent_code", "left_anti").agg(F.count(F.lit(1)).alias("n")).filter("n > 0").select(F.lit("orphans").alias("problem"), "n")
    return wrong.unionByName(orphans)
