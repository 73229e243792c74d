"""Parsers of free-text pay, education, experience and employment, as Columns. Nothing is guessed: what can't be decided is null."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tessera.functions.text import collapse_ws

# Pay.
HIDDEN = r"(?iU)dirahasiakan|nego|kompetitif|competitive|confidential|tidak ditampilkan|undisclosed"
FOREIGN = r"(?iU)\b(usd|us\$|sgd|eur|myr|\$)"
PERIODS = (
    ("hour", r"(?iU)/\s*(jam|hour)|per\s*(jam|hour)|hourly", 173.0),
    ("day", r"(?iU)/\s*(hari|day)|per\s*(hari|day)|harian|daily", 22.0),
    ("week", r"(?iU)/\s*(minggu|week)|per\s*(minggu|week)|mingguan|weekly", 52 / 12),
    ("year", r"(?iU)/\s*(tahun|year)|per\s*(tahun|year)|tahunan|annual|yearly", 1 / 12),
    ("month", r"(?iU)/\s*(bulan|month)|per\s*(bulan|month)|bulanan|monthly", 1.0),
)
AMOUNT = r"(?iU)(\d+(?:[.,]\d+)*)\s*(jt|juta|jutaan|million|mio|m\b|rb|ribu|k\b|ribuan|thousand)?"
MILLIONS = ("jt", "juta", "jutaan", "million", "mio", "m")
LEAST_AMOUNT, LEAST_MONTHLY, MOST_MONTHLY = 1000, 500_000, 200_000_000

# Education levels, from the lowest, and what names them.
EDUCATION = (
    ("SD", r"(?iU)\bsd\b|sekolah dasar|elementary|primary school"),
    ("SMP", r"(?iU)\bsmp\b|\bsltp\b|\bmts\b|junior high"),
    ("SMA/SMK", r"(?iU)\bsma\b|\bsmk\b|\bstm\b|\bslta\b|\bma\b|sederajat|high school|secondary school|vocational school"),
    ("D1-D3", r"(?iU)\bd-?[123]\b|\bd-?i{1,3}\b|diploma|associate degree|akademi|politeknik"),
    ("D4/S1", r"(?iU)\bs-?1\b|\bd-?iv\b|\bd-?4\b|sarjana|bachelor|strata\s*1|undergraduate"),
    ("S2", r"(?iU)\bs-?2\b|magister|master|pasca\s*sarjana|postgraduate|post graduate"),
    ("S3", r"(?iU)\bs-?3\b|doktor|doctor|phd|doctoral"),
)
#: Without the roman numeral that is also the preposition "di".
STRICT_DIPLOMA = r"(?iU)\bd-?[123]\b|\bd-i{1,3}\b|\bdii?i\b|diploma|associate degree|akademi|politeknik"

# Experience.
FRESH = r"(?iU)fresh\s*grad|tanpa pengalaman|no experience|tidak (perlu|wajib) berpengalaman|lulusan baru|entry level"
YEARS = r"(?iU)(\d+(?:[.,]\d+)?)\s*(?:-\s*\d+\s*)?(tahun|thn|th\b|years?|yrs?)"
MONTHS = r"(?iU)(\d+)\s*(?:-\s*\d+\s*)?(bulan|bln|months?)"

# Employment types and what names them.
EMPLOYMENT = (
    ("internship", r"(?iU)intern|magang|ojt|on the job|trainee|praktik kerja|pkl"),
    ("freelance", r"(?iU)freelance|lepas|per diem|gig"),
    ("part_time", r"(?iU)part[\s_-]*time|paruh waktu|paruh-waktu"),
    ("contract", r"(?iU)contract|kontrak|temporary|temporer|pkwt|outsourc"),
    ("full_time", r"(?iU)full[\s_-]*time|penuh waktu|permanent|tetap|pkwtt|regular"),
)


def number_of(token: Column, unit: Column) -> Column:
    """A number token, scaled by its unit word ('' for none): with a unit at most one separator, a decimal one."""
    plain = F.replace(F.regexp_replace(token, r"[.,](?=\d{3}\b)", ""), F.lit(","), F.lit(".")).try_cast("double")
    one_separator = F.length(F.regexp_replace(token, r"\d", "")) <= 1
    scaled = F.replace(token, F.lit(","), F.lit(".")).try_cast("double") * F.when(F.lower(unit).isin(*MILLIONS), 1e6).otherwise(1e3)
    return F.when(unit == "", plain).when(one_separator, scaled)


def parse_salary(raw: Column) -> Column:
    """struct(min, max, period): monthly bounds rounded to thousands, and the period as published."""
    text = collapse_ws(raw)
    amounts = F.arrays_zip(F.regexp_extract_all(text, F.lit(AMOUNT), 1).alias("token"), F.regexp_extract_all(text, F.lit(AMOUNT), 2).alias("unit"))
    # a small bare number, as in "5-7 jt", borrows the last unit of the text
    lent = F.coalesce(F.try_element_at(F.filter(amounts["unit"], lambda u: u != ""), F.lit(-1)), F.lit(""))
    values = F.transform(amounts, lambda a: number_of(a["token"], F.when((a["unit"] == "") & (number_of(a["token"], F.lit("")) < 1000), lent).otherwise(a["unit"])))
    two = F.slice(F.filter(values, lambda v: v >= LEAST_AMOUNT), 1, 2)
    period, factor = F.lit("month"), F.lit(1.0)
    for name, pattern, times in reversed(PERIODS):
        period, factor = F.when(text.rlike(pattern), name).otherwise(period), F.when(text.rlike(pattern), times).otherwise(factor)
    low, high = (F.bround(f(two) * factor, -3).cast("long") for f in (F.array_min, F.array_max))
    ok = ~text.rlike(HIDDEN) & ~text.rlike(FOREIGN) & (low >= LEAST_MONTHLY) & (high <= MOST_MONTHLY)
    return F.struct(F.when(ok, low).alias("min"), F.when(ok, high).alias("max"), F.when(ok, period).alias("period"))


def parse_education(raw: Column, strict: bool = False) -> Column:
    """The lowest level that is named."""
    levels = [(n, STRICT_DIPLOMA if strict and n == "D1-D3" else p) for n, p in EDUCATION]
    return F.coalesce(*(F.when(raw.rlike(p), F.lit(n)) for n, p in levels))


def parse_experience(raw: Column) -> Column:
    """Least years asked for; months are rounded to years, fewer than six to none."""
    text = F.regexp_replace(raw, r"(?U)^\s+|\s+$", "")
    years, months = F.regexp_extract(text, YEARS, 1), F.regexp_extract(text, MONTHS, 1).try_cast("int")
    return (
        F.when(text.rlike(FRESH), 0)
        .when(text.rlike(YEARS), F.replace(years, F.lit(","), F.lit(".")).try_cast("double").cast("int"))
        .when(text.rlike(MONTHS), F.when(months >= 6, F.floor(months / 12 + 0.5)).otherwise(0).cast("int"))
        .when(text.rlike(r"^\d{1,2}$"), text.try_cast("int"))
    )


def parse_employment(raw: Column) -> Column:
    """The type that is named first; of types named at one place the first in alphabetical order."""
    named = F.array(*(F.struct(F.regexp_instr(raw, F.lit(p)).alias("at"), F.lit(n).alias("name")) for n, p in EMPLOYMENT))
    return F.array_min(F.filter(named, lambda x: x["at"] > 0))["name"]
