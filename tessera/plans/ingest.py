"""From parsed postings to clean tables: masking, normalisation, snapshots, run logs. One DataFrame job, no per-row state."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.parsers import parse_education, parse_employment, parse_experience, parse_salary
from tessera.functions.privacy import mask_text, pseudonym
from tessera.functions.text import collapse_ws, content_hash, html_to_text, none_if_empty
from tessera.functions.timefn import day_of, to_iso
from tessera.operators import gazetteer
from tessera.operators.relational import age_window, upsert


def clean(postings: DataFrame, source: str, fetched_at: Column, key: bytes | None = None, exact: bool = True) -> DataFrame:
    """Storable rows of parsed postings: contact details masked, keys and hash made, empty text null."""
    text = {c: none_if_empty(collapse_ws(F.col(c))) for c in ("location_raw", "salary_raw", "education_raw", "experience_raw")}
    title, company = collapse_ws(F.col("title")), none_if_empty(collapse_ws(F.col("company_name")))
    described = postings.withColumn("__d", mask_text(html_to_text("description")))
    return described.select(
        F.concat(F.lit(f"{source}:"), "source_job_id").alias("posting_id"),
        F.lit(source).alias("source_id"),
        "source_job_id",
        "url",
        mask_text(title).alias("title"),
        company.alias("company_name"),
        pseudonym(company, key, exact).alias("company_hmac"),
        *(c.alias(n) for n, c in text.items()),
        none_if_empty(collapse_ws(F.col("employment_type"))).alias("employment_type_raw"),
        none_if_empty(F.col("__d")).alias("description_masked"),
        F.when(F.size("extra") > 0, F.to_json(F.map_from_entries(F.array_sort(F.map_entries("extra"))))).alias("extra_json"),
        content_hash(title, company, F.col("location_raw"), F.col("__d"), exact=exact).alias("content_hash"),
        to_iso(F.col("posted_at")).alias("posted_at"),
        to_iso(F.col("valid_through")).alias("valid_through"),
        fetched_at.alias("fetched_at"),
    )


def normalise(rows: DataFrame, places: DataFrame) -> DataFrame:
    """Rows with pay, education, experience, employment and place derived anew from their raw text."""
    rows = rows.withColumn("__pay", parse_salary(F.col("salary_raw")))  # its own projection: three columns read it, it is computed once
    pay = F.col("__pay")
    extra = lambda k: F.get_json_object("extra_json", f"$.{k}")
    derived = rows.withColumns(
        {
            "salary_min": pay["min"],
            "salary_max": pay["max"],
            "salary_period": pay["period"],
            "education_level": F.coalesce(parse_education(F.col("education_raw")), parse_education(extra("education_listed"))),
            "experience_years": parse_experience(F.col("experience_raw")),
            "employment_type": parse_employment(F.col("employment_type_raw")),
            "__street": extra("street_address"),
            "__remote": F.coalesce(extra("remote") == "true", F.lit(False)),
        }
    )
    where = gazetteer.resolve(derived, places, "location_raw").withColumnRenamed("raw", "__raw")
    joined = derived.join(where, F.col("location_raw").eqNullSafe(F.col("__raw")), "left").drop("__raw")
    fine = gazetteer.refine(joined, "__street", places)
    return fine.withColumn("is_remote", F.col("is_remote") | F.col("__remote")).drop("__street", "__remote", "__pay")


def coverage(rows: DataFrame) -> DataFrame:
    """Share of rows in which each derived column is filled."""
    share = lambda c: F.bround(F.coalesce(F.avg(c.cast("int").cast("double")), F.lit(0.0)), 3)
    columns = ("salary_min", "education_level", "experience_years", "employment_type", "region_code")
    return rows.agg(*(share(F.col(c).isNotNull()).alias(c) for c in columns), share(F.coalesce(F.length("region_code") == 4, F.lit(False))).alias("regency_level"))


def land(old: DataFrame, new: DataFrame, today: Column, max_age: int = 60) -> DataFrame:
    """The postings' next snapshot: new rows in the age window win over old ones; first_fetched_at and vacancy_id survive."""
    fresh = age_window(new, day_of(F.col("posted_at")), today, max_age)
    fresh = fresh.withColumns({"first_fetched_at": F.col("fetched_at"), "vacancy_id": F.lit(None).cast("string")}).select(*old.columns)
    return upsert(old, fresh, ["posting_id"], "fetched_at", keep_first=["first_fetched_at"], survive=["vacancy_id"])


def run_status(items: DataFrame, group: list[str], error: str, order: str) -> DataFrame:
    """(group, n_saved, n_errors, status, error_type) of runs from their items (error null: saved).

    The error type is the most frequent one, the first met of equally frequent ones. No error: success; errors and
    saved rows: partial; else failed.
    """
    kinds = items.filter(F.col(error).isNotNull()).groupBy(*group, error).agg(F.count(F.lit(1)).alias("n"), F.min(order).alias("first"))
    worst = kinds.groupBy(*group).agg(F.max_by(error, F.struct("n", -F.col("first"))).alias("error_type"))
    counts = items.groupBy(*group).agg(F.count_if(F.col(error).isNull()).alias("n_saved"), F.count_if(F.col(error).isNotNull()).alias("n_errors"))
    status = F.when(F.col("n_errors") == 0, "success").when(F.col("n_saved") > 0, "partial").otherwise("failed")
    return counts.join(worst, group, "left").select(*group, "n_saved", "n_errors", status.alias("status"), "error_type")
