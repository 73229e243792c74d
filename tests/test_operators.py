import json
import random
import statistics
from decimal import ROUND_HALF_EVEN, Decimal

import pytest
from pyspark.sql import functions as F

from tessera.operators import classify, quality, relational
from tessera.plans import marts
from tessera.sources.model_client import ModelClient, ModelError
from tessera.streaming import ingest

UNITS = ("1111", "2222")


def answer(items, **more):
    return json.dumps([{"ref": x["ref"], "unit": "1111", "second": "9", "confidence": 0.5, "skills": [" a ", "", "b"], "code": "1111.01"} | more for x in items])


def steps(spark, max_skills=8):
    units = spark.createDataFrame([(u,) for u in UNITS], "unit string")
    codes = spark.createDataFrame([("1111.01",)], "code string")
    return classify.unit_step(units, lambda g: "units", max_skills), classify.code_step(codes, lambda g: g)


def items(spark, n, group=None):
    return spark.createDataFrame([(f"i{k}", group, json.dumps({"description": str(k)})) for k in range(n)], "id string, group string, item string")


def asked(spark, rows, step, model, size=4):
    answers, calls = classify.run_step(rows, step, model, size)
    return {r["id"]: r for r in answers.collect()}, sorted((r["status"], r["n_items"]) for r in calls.collect())


def test_a_bad_reply_is_asked_for_once_more(spark, tmp_path):
    mark = str(tmp_path / "asked")

    def flaky(step, system, batch):
        import os

        if not os.path.exists(mark):
            open(mark, "w").close()
            return "no json"
        return f"```json\n{json.dumps({'results': json.loads(answer(batch))})}\n```"

    out, calls = asked(spark, items(spark, 4), steps(spark, 1)[0], flaky)
    assert set(out) == {"i0", "i1", "i2", "i3"} and out["i0"]["skills"] == ["a"] and out["i0"]["second"] is None and out["i0"]["pii"] is False
    assert calls == [("failed", 4), ("ok", 4)]
    out, calls = asked(spark, items(spark, 4), steps(spark)[0], lambda *_: "no json")
    assert out == {} and calls == [("failed", 4), ("failed", 4)]


def test_a_filtered_batch_loses_only_what_is_at_fault(spark):
    def filters(step, system, batch):
        if any(x["description"] == "2" for x in batch):
            raise classify.Filtered
        return classify.Reply(answer(batch), 10, 5)

    answers, calls = classify.run_step(items(spark, 4), steps(spark)[0], filters, 4)
    assert {r["id"] for r in answers.collect()} == {"i0", "i1", "i3"}
    assert sorted((r["status"], r["n_items"]) for r in calls.collect()) == [("filtered", 1), ("filtered", 2), ("filtered", 4), ("ok", 1), ("ok", 2)]
    total = classify.usage(calls, price_in=1.0, price_out=2.0).first()
    assert total["calls"] == 5 and total["ok"] == 2 and total["output_tokens"] == 10 and total["items"] == 10

    def broken(step, system, batch):
        raise OSError

    assert asked(spark, items(spark, 4), steps(spark)[0], broken) == ({}, [("failed", 4)])


def test_replies_are_judged_whole(spark):
    """Batches by group, each with one fault: none of its answers counts."""
    faults = {"ref": {"ref": "x"}, "unit": {"unit": "3333"}, "high": {"confidence": 2}, "word": {"confidence": "much"}, "none": {"confidence": None}, "skills": {"skills": "a"}, "good": {}, "second": {"second": "2222", "skills": None, "pii_found": True}}
    rows = spark.createDataFrame([(f"{g}{k}", g, "{}") for g in faults for k in range(2)], "id string, group string, item string")
    step = steps(spark)[0]
    step = classify.Step(step.name, lambda g: g, step.judge)

    def model(name, system, batch):
        made = json.loads(answer(batch))
        made[0] |= faults[system]
        return json.dumps(made)

    out, _ = asked(spark, rows, step, model)
    assert set(out) == {"good0", "good1", "second0", "second1"}
    assert out["second0"]["second"] == "2222" and out["second0"]["pii"] and out["second0"]["skills"] == [] and out["second1"]["skills"] == ["a", "b"]


def test_codes_and_sections(spark):
    code = steps(spark)[1]
    out, _ = asked(spark, items(spark, 2, "1111"), code, lambda s, t, b: answer(b, reason="r" * 400))
    assert {r["code"] for r in out.values()} == {"1111.01"} and len(out["i0"]["reason"]) == 300
    assert asked(spark, items(spark, 2, "2222"), code, lambda s, t, b: answer(b))[0] == {}
    listed = classify.listing(spark.createDataFrame([("B", "Mining"), ("A", "Farms")], "section string, title string"), "section", "title")
    step = classify.section_step(spark.createDataFrame([("A",), ("B",)], "section string"), classify.systems(listed, classify.SECTION_TEXT))

    def model(name, system, batch):
        assert system.endswith("A Farms\nB Mining") and len(batch) == 15
        return answer(batch, section=" b ", confidence=0)

    found, calls = classify.company_sections(items(spark, 15).drop("group"), model, step)
    assert {tuple(r)[1:] for r in found.collect()} == {("B", 0.0)} and calls.count() == 1


def test_two_steps_and_outcome(spark):
    def model(step, system, batch):
        if step == "unit":
            return json.dumps([{"ref": x["ref"], "unit": UNITS[int(x["description"]) % 2], "confidence": 0.9, "skills": ["Excel", "excel ", "SQL"]} for x in batch])
        return answer(batch, confidence=0.8)

    first, second = steps(spark)
    found, skills, calls = classify.two_steps(items(spark, 6), model, first, second)
    assert {r["id"]: (r["status"], r["code"], r["needs_review"]) for r in found.collect()} == {f"i{k}": ("ok", "1111.01", False) if k % 2 == 0 else ("partial", None, True) for k in range(6)}
    assert skills.filter("id = 'i0'").count() == 2 and {r["step"] for r in calls.collect()} == {"unit", "code"}
    ids = spark.createDataFrame([("a",), ("b",), ("c",), ("d",)], "id string")
    first = spark.createDataFrame([("a", "1", None, 0.9, False), ("b", "1", None, 0.9, False), ("d", "1", None, 0.9, True)], "id string, unit string, second string, confidence4 double, pii boolean")
    second = spark.createDataFrame([("a", "1.1", 0.8, None), ("d", "1.1", 0.8, None)], "id string, code string, confidence double, reason string")
    got = {r["id"]: (r["status"], r["needs_review"]) for r in classify.outcome(ids, first, second, 0.7).collect()}
    assert got == {"a": ("ok", False), "b": ("partial", True), "c": ("failed", True), "d": ("ok", True)}
    assert tuple(classify.token_estimate(spark.createDataFrame([("x" * 7,)] * 11, "t string"), "t").first()) == (11, 2, 22)


def test_client_waits_longer_each_time():
    def client(replies):
        slept = []
        left = iter(replies)

        def send(request):
            got = next(left)
            if isinstance(got, Exception):
                raise got
            return got

        return ModelClient(send, "m", sleep=slept.append), slept

    good = (200, {"choices": [{"message": {"content": "[]"}}], "usage": {"prompt_tokens": 3, "completion_tokens": 1}})
    empty = (200, {"choices": [{"message": {"content": " "}}]})
    ask, slept = client([(429, {}), (503, {}), empty, good])
    assert ask("unit", "s", []) == classify.Reply("[]", 3, 1) and slept == [5, 10, 20]
    ask, slept = client([OSError("line"), good])
    assert ask("unit", "s", []).text == "[]" and slept == [5]
    ask, slept = client([(500, {})] * 4)
    with pytest.raises(ModelError):
        ask("unit", "s", [])
    assert slept == [5, 10, 20]
    for reply, error in (((400, {}), ModelError), ((400, {"error": {"code": "content_filter"}}), classify.Filtered), ((200, {"choices": [{"finish_reason": "content_filter"}]}), classify.Filtered)):
        ask, slept = client([reply])
        with pytest.raises(error):
            ask("unit", "s", [])
        assert slept == []


def test_gate_and_publishing(spark):
    checks = spark.createDataFrame([("a", "fail", "pass", 1.0), ("b", "warn", "warn", 0.0)], "check string, level string, status string, value double")
    assert tuple(quality.verdict(checks).first()) == ("pass", [], ["b"])
    good = json.dumps({"public": True, "generated_at": "2026-10-10T10:00:00+07:00", "rows": [{"n": 1}]})
    bad = json.dumps({"public": False, "generated_at": "2026-10-10T10:00:00+07:00", "rows": [{"url": "x", "note": "mail a@b.id"}]})
    marts_ = spark.createDataFrame([("summary", good), ("trend", bad), ("ops", good)], "name string, json string")
    found = {tuple(r) for r in quality.publish_problems(marts_, ["summary", "skills"], {"status": "pass", "checked_at": "2026-10-10T11:00:00+07:00"}).collect()}
    assert found == {("trend", "not public"), ("trend", "forbidden field url at $.rows[0]"), ("trend", "contact details at $.rows[0].note"), ("skills", "missing"), ("gate", "ran after the data was made")}
    assert ("gate", "no quality report") in {tuple(r) for r in quality.publish_problems(marts_, [], None).collect()}


def test_marts_of_nothing(spark):
    none = spark.createDataFrame([], "id long, source string, first_seen date, last_seen date, is_active boolean")
    row = marts.summary(none, none.select("id"), none.agg(F.count(F.lit(1)).alias("postings")), F.lit("2026-01-01").cast("date")).first()
    assert (row["data_label"], row["active_vacancies"], row["duplicate_ratio"], row["coded_ratio"]) == ("demo", 0, 0.0, 0.0)
    assert [r["n"] for r in marts.histogram(spark.createDataFrame([(1.0,), (0.05,), (None,)], "c double"), "c").orderBy("bin").collect()] == [1, 0, 0, 0, 0, 0, 0, 0, 0, 1]


def test_stream_lands_once(spark, tmp_path):
    rows = [("a", 1), ("b", 1)]
    spark.createDataFrame(rows, "k string, v int").coalesce(1).write.parquet(f"{tmp_path}/in")
    merge = lambda old, new: new if old is None else old.join(new.select("k"), "k", "left_anti").unionByName(new)
    run = lambda: ingest.land_stream(ingest.page_stream(spark, f"{tmp_path}/in", "k string, v int"), merge, f"{tmp_path}/out", f"{tmp_path}/cp")
    run()
    spark.createDataFrame([("b", 2), ("c", 2)], "k string, v int").coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    run()
    run()
    assert sorted(tuple(r) for r in spark.read.parquet(f"{tmp_path}/out/1").collect()) == [("a", 1), ("b", 2), ("c", 2)]


def test_pages_sorts_and_date_stop(spark):
    from tessera.functions.parsers import parse_experience
    from tessera.operators import relational as R

    df = spark.range(45).withColumnRenamed("id", "n")
    at = lambda k: [r["n"] for r in R.page(df, [F.col("n")], k).collect()]
    assert at(0) == at(1) == list(range(20)) and at(3) == at(9) == list(range(40, 45)) and R.page(df.limit(0), [F.col("n")], 2).count() == 0
    rows = spark.createDataFrame([("a", 1, False), ("a", 2, True), ("a", 3, False), ("b", 1, False), ("b", 2, None), (None, 5, True), (None, 4, False)], "s string, n int, old boolean")
    assert sorted((str(r["s"]), r["n"]) for r in R.until_first(rows, ["s"], "n", F.col("old")).collect()) == [("None", 4), ("a", 1), ("b", 1), ("b", 2)]
    v = spark.createDataFrame([(1, "2026-01-02", 5, 1, 0.9), (2, "2026-01-03", None, 3, None), (3, "2026-01-01", 9, 2, 0.1)], "id int, last_seen string, salary_max int, n_sources int, confidence double")
    assert {how: [r["id"] for r in R.sorted_by(v, how).collect()] for how in ("new", "salary", "sources", "confidence")} == {"new": [2, 1, 3], "salary": [3, 1, 2], "sources": [2, 3, 1], "confidence": [3, 1, 2]}
    said = spark.createDataFrame([("\t1",), ("1\n",), (" 2 ",)], "t string").coalesce(1)
    assert [r[0] for r in said.select(parse_experience(F.col("t"))).collect()] == [1, 1, 2]


@pytest.fixture
def many_ranges(spark):
    keep = {"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.shuffle.partitions": "13"}
    before = {k: spark.conf.get(k) for k in keep}
    for k, v in keep.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def cut_one_by_one(rows, streak):
    out, state = set(), {}
    for g, n, bad in sorted(rows, key=lambda r: (str(r[0]), r[1])):
        run, over = state.get(g, (0, False))
        if not over:
            out.add((g, n, bad))
        run = run + 1 if bad else 0
        state[g] = run, over or run >= streak
    return out


def test_streaks_over_ranges(spark, many_ranges):
    """A source in many ranges is cut where it would be if read row by row; so is one of bad rows only, and one without a name."""
    rnd = random.Random(2)
    for share, streak in ((0.5, 5), (0.85, 12), (0.97, 60), (1.0, 40)):
        rows = [(rnd.choice(["a", "a", "a", "b", None]), n, rnd.random() < share) for n in range(700)] + [("c", n, n != 3) for n in range(20)]
        df = spark.createDataFrame(rows, "s string, n int, old boolean")
        got = relational.until_streak_in_ranges(df, ["s"], ["n"], F.col("old"), streak)
        assert got.columns == df.columns and {tuple(r) for r in got.collect()} == cut_one_by_one(rows, streak)
        assert {tuple(r) for r in relational.until_streak(df, ["s"], ["n"], F.col("old"), streak).collect()} == cut_one_by_one(rows, streak)
    assert relational.in_ranges(df.filter("s = 'a'"), ["s"], ["n"]).select("__range").distinct().count() > 5
    assert relational.until_streak_in_ranges(df.limit(0), ["s"], ["n"], F.col("old"), 3).count() == 0


def test_quartiles_by_selection(spark, many_ranges):
    rnd = random.Random(4)
    rows = [(rnd.choice(["x", "x", "x", "y", "z", None]), rnd.choice([None, 0, *range(1, 400)]) , rnd.choice([None, 0, 500, 777])) for _ in range(900)] + [("few", 5, 5)] * 4 + [("same", 8, None)] * 9
    want = {}
    for k in ("x", "y", "z", "same"):
        values = [(low + (high or low)) / 2 for g, low, high in rows if g == k and low]
        want[k] = (len(values), *(Decimal(q).quantize(Decimal("0.1"), ROUND_HALF_EVEN) for q in statistics.quantiles(values, n=4)))
    out = marts.salary_quartiles(spark.createDataFrame(rows, "by string, low long, high long"), "by", "low", "high", step=1)
    assert {r["by"]: (r["n"], *(Decimal(r[c]).quantize(Decimal("0.1")) for c in ("p25", "median", "p75"))) for r in out.collect()} == want
