"""Published records and their sinks: nested public or local records, the flat export, JSON marts, prompts' tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.privacy import hide_patterns, name_patterns
from tessera.functions.text import region_label, short_id, truncate


def records(vacancies: DataFrame, public: bool = True, limit: int | None = 500, description_chars: int = 200, exact: bool = True) -> DataFrame:
    """(record) of active vacancies, newest first: nested structs, null where nothing is known.

    vacancies: vacancy_id, title, company_name, company_hmac, url, source, code, code_title, unit, unit_title,
    confidence, confidence4, reason, needs_review, section, section_title, region_code, region, province, is_remote,
    salary_min, salary_max, education, experience_years, employment_type, n_sources, first_seen, last_seen, skills,
    description, is_active. Public records have pseudonyms, hashed ids and texts without the company's name; local
    ones add name, url and source and must not be shared.
    """
    top = vacancies.filter("is_active").orderBy(F.desc("first_seen"), "vacancy_id")
    top = top.limit(limit) if limit is not None else top
    # a company's patterns are made once a row; as they are used several times, Spark does not copy them into each use
    top = top.withColumn("__name", name_patterns(F.col("company_name"), exact)) if public else top
    text = (lambda c: hide_patterns(F.col(c), F.col("__name"))) if public else F.col
    only = lambda known, **fields: F.when(F.col(known).isNotNull(), F.struct(*(v.alias(k) for k, v in fields.items())))
    col = F.col
    fields = {
        "id": short_id(col("vacancy_id")) if public else col("vacancy_id"),
        "title": text("title"),
        "company": F.concat(F.lit("#"), F.left("company_hmac", F.lit(6))),
        "sector": only("section", section=col("section"), title=col("section_title")),
        "occupation": only("unit", code=col("code"), title=col("code_title"), unit=col("unit"), unit_title=col("unit_title"), confidence=F.coalesce("confidence", "confidence4"), reason=col("reason"), needs_review=col("needs_review")),
        "region": only("region", code=col("region_code"), name=region_label(col("region")), province=region_label(col("province"))),
        "remote": F.coalesce("is_remote", F.lit(False)),
        "salary": only("salary_min", min=col("salary_min"), max=col("salary_max")),
        **{c: col(c) for c in ("education", "experience_years", "employment_type", "n_sources", "first_seen", "last_seen")},
        "skills": F.slice(F.coalesce("skills", F.array().cast("array<string>")), 1, 8),
        "description": truncate(text("description"), description_chars),
    }
    if not public:
        fields |= {c: col(c) for c in ("company_name", "url", "source")}
    return top.select(F.struct(*(v.alias(k) for k, v in fields.items())).alias("record"))


def flat(records_: DataFrame) -> DataFrame:
    """One row of plain columns a record, for tables outside."""
    have = {f.name for f in records_.schema["record"].dataType}
    r = lambda path: F.col(f"record.{path}")
    columns = {
        "id": r("id"), "title": r("title"), "company": r("company"), "code": r("occupation.code"), "code_title": r("occupation.title"), "unit": r("occupation.unit"), "confidence": r("occupation.confidence"),
        "needs_review": r("occupation.needs_review"), "section": r("sector.section"), "region_code": r("region.code"), "region": r("region.name"), "province": r("region.province"), "remote": r("remote"),
        "salary_min": r("salary.min"), "salary_max": r("salary.max"), **{c: r(c) for c in ("education", "experience_years", "employment_type", "n_sources", "first_seen", "last_seen")},
        "skills": F.array_join(r("skills"), "; "), "description": r("description"),
    }
    columns |= {c: r(c) for c in ("company_name", "url", "source") if c in have}
    return records_.select(*(v.alias(k) for k, v in columns.items()))


def as_mart(name: str, rows: DataFrame, public: bool, generated_at: Column) -> DataFrame:
    """(name, json) of a mart: its rows (a mart is bounded by its top-k or its dimension) as one public-marked document."""
    body = F.struct(F.lit(public).alias("public"), generated_at.alias("generated_at"), F.collect_list(F.struct(*rows.columns)).alias("rows"))
    return rows.agg(F.to_json(body).alias("json")).select(F.lit(name).alias("name"), "json")


def write_marts(marts: DataFrame, path: str) -> None:
    """One folder a mart with its JSON text."""
    marts.select("name", F.col("json").alias("value")).write.mode("overwrite").partitionBy("name").text(path)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").csv(path, header=True, escape='"')


def markdown(sections: dict[str, DataFrame]) -> DataFrame:
    """(at, nth, line) of a Markdown report: a heading and a table of (nth, metric, value) rows a section."""
    out = None
    for at, (title, rows) in enumerate(sections.items()):
        head = rows.sparkSession.range(1).select(F.lit(at).alias("at"), F.lit(-1).alias("nth"), F.lit(f"## {title}\n\n| Metric | Value |\n|---|---|").alias("line"))
        part = head.unionByName(rows.select(F.lit(at).alias("at"), "nth", F.concat(F.lit("| "), "metric", F.lit(" | "), "value", F.lit(" |")).alias("line")))
        out = part if out is None else out.unionByName(part)
    return out


def write_markdown(lines: DataFrame, path: str, title: str) -> None:
    """One text of the lines in order (a report is bounded by its sections and sources)."""
    body = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", "nth", "line"))), lambda x: F.concat(F.when((x["nth"] < 0) & (x["at"] > 0), "\n").otherwise(F.lit("")), x["line"])), "\n")
    lines.agg(F.concat(F.lit(f"# {title}\n\n"), body).alias("value")).coalesce(1).write.mode("overwrite").text(path)


def write_review(pairs: DataFrame, path: str, order: list[str]) -> None:
    """A sheet for people: one CSV file in order, with an empty label column at the end."""
    pairs.withColumn("label", F.lit("")).orderBy(*order).coalesce(1).write.mode("overwrite").csv(path, header=True, escape='"')


def rupiah(value: Column) -> Column:
    """Millions with one decimal below ten, in Indonesian notation."""
    v = value / 1e6
    return F.replace(F.when(v >= 10, F.round(v).cast("long").cast("string")).otherwise(F.regexp_replace(F.round(v, 1).cast("string"), r"\.0$", "")), F.lit("."), F.lit(","))


def salary_text(low: Column, high: Column) -> Column:
    span = F.concat(F.lit("Rp"), rupiah(low), F.when(high.isNotNull() & (high != low), F.concat(F.lit("–"), rupiah(high))).otherwise(F.lit("")), F.lit(" jt/bulan"))
    return F.coalesce(span, F.lit("Gaji tidak dicantumkan"))


def escape_html(value: Column) -> Column:
    out = F.coalesce(value, F.lit(""))
    for char, name in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#39;")):
        out = F.replace(out, F.lit(char), F.lit(name))
    return out


def listing_table(codes: DataFrame, key: str | None = None, code: str = "code", title: str = "title") -> DataFrame:
    """(key, listing): 'code title' lines in code order for a prompt, one text a key, or one for all (a taxonomy is bounded)."""
    lines = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(code, title))), lambda x: F.concat_ws(" ", x[code], x[title])), "\n")
    grouped = codes.groupBy(key) if key else codes.groupBy()
    return grouped.agg(lines.alias("listing"))


def stored_code(answer: Column) -> Column:
    """A typed code as it is stored: six digits get their dot; whether it exists is a join with the taxonomy."""
    digits = F.trim(F.replace(answer, F.lit("."), F.lit("")))
    return F.when(F.length(digits) == 6, F.concat(F.left(digits, F.lit(4)), F.lit("."), F.substring(digits, 5, 2))).otherwise(digits)
