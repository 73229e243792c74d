"""Evaluation: stratified samples, prefix accuracy, cost."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.plans.publish import stored_code


def stratified(df: DataFrame, strata: list[str], key: str, n: int, order: Column) -> DataFrame:
    """n rows, one of each stratum in turn in the order of the strata, each stratum in the order given."""
    w = Window.partitionBy(*strata).orderBy(order, key)
    ranked = df.withColumn("__turn", F.row_number().over(w)).filter(F.col("__turn") <= n)
    return ranked.orderBy("__turn", *strata).limit(n).drop("__turn")


def prefix_accuracy(sheet: DataFrame, threshold: float) -> DataFrame:
    """Hits by digits of predicted codes against gold ones, of the second choice too, and by confidence.

    sheet: gold, predicted, unit, second, confidence; rows without gold are left out.
    """
    plain = lambda c: F.replace(F.coalesce(F.trim(c), F.lit("")), F.lit("."), F.lit(""))
    rows = sheet.filter(F.coalesce(F.trim("gold"), F.lit("")) != "")
    unit = F.coalesce(F.nullif("unit", F.lit("")), F.left(F.coalesce("predicted", F.lit("")), F.lit(4)))
    rows = rows.select(plain(F.col("gold")).alias("g"), F.coalesce(F.nullif(plain(F.col("predicted")), F.lit("")), unit).alias("p"), unit.alias("u"), F.coalesce("second", F.lit("")).alias("s"), F.coalesce(F.col("confidence").try_cast("double"), F.lit(0.0)).alias("c"))
    same = lambda d: F.left("p", F.lit(d)) == F.left("g", F.lit(d))
    of = lambda hit, base: F.when(F.count_if(base) > 0, F.bround(F.count_if(hit & base) / F.count_if(base), 3))
    every, six, sure = F.lit(True), F.length("g") == 6, F.col("c") >= threshold
    return rows.agg(
        F.count(F.lit(1)).alias("labelled"),
        *(of(same(d), every).alias(f"accuracy_{d}") for d in (1, 2, 4)),
        of(F.col("p") == F.col("g"), six).alias("accuracy_6"),
        F.count_if(six).alias("labelled_6"),
        of((F.left("g", F.lit(4)) == F.col("u")) | (F.left("g", F.lit(4)) == F.col("s")), every).alias("top2_4"),
        of(same(4), sure).alias("accuracy_4_confident"),
        F.count_if(sure).alias("n_confident"),
        of(same(4), ~sure).alias("accuracy_4_low"),
        F.count_if(~sure).alias("n_low"),
    )


def cost_per_thousand(usage: DataFrame, coded: DataFrame, price_in: float, price_out: float) -> DataFrame:
    """Tokens (usage: input_tokens, output_tokens), coded items (coded: id) and their cost at prices a million tokens."""
    tokens = usage.agg(F.coalesce(F.sum("input_tokens"), F.lit(0)).alias("input_tokens"), F.coalesce(F.sum("output_tokens"), F.lit(0)).alias("output_tokens"))
    n = coded.agg(F.count_distinct("id").alias("coded"))
    usd = F.col("input_tokens") / 1e6 * price_in + F.col("output_tokens") / 1e6 * price_out
    return tokens.crossJoin(n).select("coded", "input_tokens", "output_tokens", F.bround(usd, 4).alias("usd_total"), F.when(F.col("coded") > 0, F.bround(usd / F.col("coded") * 1000, 3)).alias("usd_per_1000"))


def percent(share: Column) -> Column:
    """A share as a percentage with one decimal, a dash where there is none."""
    return F.coalesce(F.format_string("%.1f%%", F.bround(share * 100, 1)), F.lit("–"))


def grouped(n: Column) -> Column:
    return F.format_number(n, 0)


def collection_lines(postings: DataFrame, n_vacancies: DataFrame) -> DataFrame:
    """(nth, metric, value) of the report's first table: postings, by source, merged ones, and filled columns.

    postings: source, salary_min, education_level, experience_years, region_code; n_vacancies: one row, n.
    """
    n = F.count(F.lit(1))
    filled = {"Salary parsed": "salary_min", "Education level parsed": "education_level", "Experience parsed": "experience_years"}
    every = postings.agg(n.alias("all"), *(F.count_if(F.col(c).isNotNull()).alias(c) for c in filled.values()), F.count_if(F.length("region_code") == 4).alias("regency")).crossJoin(n_vacancies.select(F.col("n").alias("unique")))
    of = lambda c: percent(F.when(F.col("all") > 0, c / F.col("all")))
    merged = F.col("all") - F.col("unique")
    rows = [("Postings collected", grouped(F.col("all"))), ("Unique vacancies", grouped(F.col("unique"))), ("Duplicates merged", F.concat(grouped(merged), F.lit(" ("), of(merged), F.lit(")")))]
    rows += [(name, of(F.col(c))) for name, c in filled.items()] + [("Location mapped to a regency", of(F.col("regency")))]
    places = [0, *range(2, len(rows) + 1)]
    total = every.select(F.inline(F.array(*(F.struct(F.lit(k).alias("nth"), F.lit(name).alias("metric"), value.alias("value")) for k, (name, value) in zip(places, rows, strict=True)))))
    return total.unionByName(postings.groupBy("source").agg(n.alias("k")).select(F.lit(1).alias("nth"), F.concat(F.lit("from "), "source").alias("metric"), grouped(F.col("k")).alias("value")))


def accuracy_lines(accuracy: DataFrame) -> DataFrame:
    """(nth, metric, value) of the report's second table, from the row of `prefix_accuracy`; without labels a line that says so."""
    c = F.col
    rows = [("Major group (1 digit)", "accuracy_1"), ("Sub-major group (2 digits)", "accuracy_2"), ("Unit group (4 digits)", "accuracy_4"), ("Unit group, either choice", "top2_4")]
    lines = [(F.lit(name), percent(c(x))) for name, x in rows]
    lines += [(F.concat(F.lit("6 digits, n="), c("labelled_6")), percent(c("accuracy_6"))), (F.concat(F.lit("4 digits, confident, n="), c("n_confident")), percent(c("accuracy_4_confident"))), (F.concat(F.lit("4 digits, not confident, n="), c("n_low")), percent(c("accuracy_4_low")))]
    table = F.array(F.struct(F.lit(0).alias("nth"), F.lit("Labelled").alias("metric"), c("labelled").cast("string").alias("value")), *(F.struct(F.lit(k).alias("nth"), name.alias("metric"), value.alias("value")) for k, (name, value) in enumerate(lines, 1)))
    none = F.array(F.struct(F.lit(0).alias("nth"), F.lit("Not evaluated yet").alias("metric"), F.lit("–").alias("value")))
    return accuracy.select(F.inline(F.when(c("labelled") > 0, table).otherwise(none)))


def cost_lines(cost: DataFrame, review: DataFrame) -> DataFrame:
    """(nth, metric, value) of the report's last lines: rows for review, tokens, cost; cost: `cost_per_thousand`'s row, review: classified, needs_review."""
    one = cost.crossJoin(review.select("classified", "needs_review"))
    c = F.col
    lines = [
        ("Flagged for review", F.concat(grouped(c("needs_review")), F.lit(" of "), grouped(c("classified")), F.lit(" ("), percent(F.when(c("classified") > 0, c("needs_review") / c("classified"))), F.lit(")"))),
        ("Tokens", F.concat(grouped(c("input_tokens")), F.lit(" in / "), grouped(c("output_tokens")), F.lit(" out for "), grouped(c("coded")), F.lit(" vacancies coded"))),
        ("Cost per 1,000 vacancies", F.coalesce(F.concat(F.lit("US$"), F.nullif("usd_per_1000", F.lit(0.0)).cast("string")), F.lit("–"))),
    ]
    return one.select(F.inline(F.array(*(F.struct(F.lit(k).alias("nth"), F.lit(name).alias("metric"), value.alias("value")) for k, (name, value) in enumerate(lines)))))


def to_label(sheet: DataFrame, label: str) -> DataFrame:
    """Rows of a sheet that nobody has labelled yet."""
    return sheet.filter(F.trim(F.coalesce(label, F.lit(""))) == "")


def find_codes(codes: DataFrame, word: str, most: int = 15, code: str = "code", title: str = "title") -> DataFrame:
    """(code, title) of the first codes whose title has the word, without case; none for no word."""
    word = word.strip().lower()
    return codes.filter(F.lit(bool(word)) & F.lower(title).contains(word)).orderBy(code, title).limit(most).select(code, title)


def label(sheet: DataFrame, answers: DataFrame, key: str, column: str, predicted: str, codes: DataFrame) -> DataFrame:
    """The sheet with answers (key, answer) put in: an empty answer takes the prediction, a code in any notation is stored as it stands in the taxonomy, unknown codes change nothing."""
    known = codes.select(F.col("code").alias("__code")).distinct()
    told = answers.select(F.col(key).alias("__key"), F.trim(F.coalesce("answer", F.lit(""))).alias("__answer"))
    told = told.withColumn("__stored", stored_code(F.col("__answer"))).join(known, F.col("__stored") == F.col("__code"), "left")
    rows = sheet.join(told, F.col(key) == F.col("__key"), "left")
    new = F.when(F.col("__key").isNotNull() & (F.col("__answer") == ""), F.col(predicted)).otherwise(F.coalesce("__code", column))
    return rows.withColumn(column, new).select(*sheet.columns)
