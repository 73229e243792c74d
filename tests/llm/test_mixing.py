import itertools
import random

from pyspark.sql import functions as F

from tessera.llm.mixing import cycle_quotas, min_cost_flow, mix, mix_documents, targets, word_count
from tessera.llm.queries import op2_mixing


def test_targets():
    for sizes, weights in (([100, 100, 100], [5, 2, 1]), ([10, 1000, 50, 0], [5, 2, 1, 5]), ([7], [1])):
        total = 1.5 * sum(sizes)
        out = targets(sizes, weights, total, 2)
        assert all(t <= 2 * s + 1e-9 for t, s in zip(out, sizes)) and abs(sum(out) - min(total, 2 * sum(sizes))) < 1e-6
        free = [t / w for t, s, w in zip(out, sizes, weights) if t < 2 * s - 1e-9]
        assert not free or max(free) - min(free) < 1e-9
    assert targets([], [], 0, 2) == []


def brute_flow(patterns, quotas, repetitions):
    """Least total repetition cost among the largest flows, by trying all integer splits."""
    best = None
    names = list(quotas)
    options = []
    for members, words in patterns:
        splits = [s for s in itertools.product(*(range(repetitions * words + 1 if n in members else 1) for n in names)) if sum(s) <= repetitions * words]
        options.append(splits)
    for choice in itertools.product(*options):
        if any(sum(c[i] for c in choice) > quotas[n] for i, n in enumerate(names)):
            continue
        given = [sum(c) for c in choice]
        cost = sum(sum(r * max(0, min(w, g - r * w)) for r in range(repetitions)) for g, (_, w) in zip(given, patterns))
        key = (-sum(given), cost)
        if best is None or key < best:
            best = key
    return best


def test_flow_is_largest_and_cheapest():
    rnd = random.Random(2)
    for _ in range(25):
        patterns = [(frozenset(rnd.sample("ab", rnd.randint(1, 2))), rnd.randint(0, 3)) for _ in range(rnd.randint(1, 3))]
        quotas = {"a": rnd.randint(0, 6), "b": rnd.randint(0, 6)}
        got = min_cost_flow(patterns, quotas, 2)
        assert all(g <= 2 * w for g, (_, w) in zip(got, patterns))
        cost = sum(sum(r * max(0, min(w, g - r * w)) for r in range(2)) for g, (_, w) in zip(got, patterns))
        assert (-sum(got), cost) == brute_flow(patterns, quotas, 2)


def corpus(spark, n=400):
    rnd = random.Random(1)
    rows = [(i, " ".join(["w"] * rnd.randint(0, 80)), rnd.choice(["hot"] * 6 + ["b", "c", None]), i) for i in range(n)]
    rows += [(n, None, "b", 0), (n + 1, "", "d", 0), (n + 2, "w\x0bw w " * 3000, "c", 0), (5, rows[5][1], rows[5][2], 5), (None, "a b c", "c", 0)]
    return rows, spark.createDataFrame(rows, "doc_id long, text string, source string, taken long")


def test_query_meets_its_targets(spark, tmp_path):
    rows, docs = corpus(spark)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    got = op2_mixing(spark, str(tmp_path)).collect()
    again = op2_mixing(spark, str(tmp_path)).collect()
    assert sorted(map(str, got)) == sorted(map(str, again)) and len(got) == len(rows)
    size = {d: sum(1 for x in (t or "").replace("\x0b", " ").split(" ") if x) for d, t, _, _ in rows}
    source = {d: s for d, _, s, _ in rows}
    assert all(r["size"] == size[r["doc_id"]] for r in got)
    names = sorted({s for s in source.values() if s is not None}) + [None]
    totals = [sum(size[d] for d, _, s, _ in rows if s == n) for n in names]
    want = dict(zip(names, targets(totals, [(5, 2, 1)[i % 3] for i in range(len(names))], 1.5 * sum(totals), 2)))
    for n, total in zip(names, totals):
        mine = [r for r in got if source[r["doc_id"]] == n]
        assert {r["source_size"] for r in mine} == {total} and all(abs(r["target"] - want[n]) < 1e-6 for r in mine)
        taken = sum(r["taken"] for r in mine)
        assert want[n] - max([81, 0.02 * want[n]]) <= taken <= want[n] + 1 or total < 9100
    assert all(r["taken"] in (0, r["size"], 2 * r["size"]) for r in got)
    assert op2_mixing(spark, str(tmp_path)).columns[:5] == ["doc_id", "size", "source_size", "target", "taken"]


def test_overlapping_sources(spark):
    rows = [(i, 10, ["a"] if i < 20 else ["a", "b"] if i < 40 else ["b"]) for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, words long, of array<string>")
    out = mix(df, F.col("doc_id"), F.col("words"), F.col("of"), lambda ranked: {"a": 150.0, "b": 350.0}).collect()
    taken = {k: sum(r["taken"] for r in out if r["row"]["doc_id"] // 20 == k) for k in range(3)}
    assert sum(taken.values()) == 500 and max(r["copies"] for r in out) == 1


def test_documents_and_empty_table(spark):
    _, docs = corpus(spark, 60)
    out = mix_documents(docs)
    assert out.columns == docs.columns and out.count() > 60
    assert mix_documents(docs.limit(0)).count() == 0
    assert mix(docs.limit(0), F.col("doc_id"), word_count(F.col("text")), F.array("source"), cycle_quotas((1,), 1, 2)).count() == 0


def test_equal_rows_and_clashing_names(spark):
    """A source of equal rows meets its target, and every row is accounted for."""
    rows = [(i, "w " * 40, "a") for i in range(2000)] + [(10_000 + i, "w " * 40, "b") for i in range(2000)] + [(-1, "w w w w", "c")] * 20_000
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    clash = docs.selectExpr("doc_id", "text", "source", "1 row", "2 size", "3 h", "4 p", "5 `range`", "6 n", "7 copies", "8 __id", "9 `a.b`")
    out = mix_documents(clash)
    assert out.columns == clash.columns
    words = {r["source"]: r["n"] for r in out.groupBy("source").agg(F.sum(word_count(F.col("text"))).alias("n")).collect()}
    assert 159_960 <= words["a"] <= 160_000 and 133_293 <= words["b"] <= 133_333 and 66_663 <= words["c"] <= 66_667
    copies = out.filter("source <> 'c'").groupBy("doc_id").count().agg(F.max("count")).first()[0]
    assert copies == 2 and out.filter("size <> 2 or n <> 6").count() == 0


def brute_choice(rows, whole, part, repetitions=2):
    """Greedy seeded prefix, by sorting a pattern whole; the rows are (position, size)."""
    more, room = [], part
    for _, size in sorted(rows):
        more.append(size <= room and room > 0)
        room -= size if more[-1] else 0
    return sum(size * (min(repetitions, whole + m)) for (_, size), m in zip(sorted(rows), more))


def test_choice_against_sorting_all(spark):
    """With one range the choice is the greedy prefix; with many it stays as close to the quota."""
    from tessera.llm import mixing

    rnd = random.Random(4)
    rows = [(i, rnd.randint(1, 50)) for i in range(3000)]
    df = spark.createDataFrame(rows, "doc_id long, words long")
    total = sum(w for _, w in rows)
    for share in (0.3, 1.0, 1.7):
        quota = round(share * total)
        whole, part = divmod(quota, total)
        h = {r["doc_id"]: r["h"] for r in df.select("doc_id", F.xxhash64("doc_id", F.lit(mixing.SEED)).alias("h")).collect()}
        want = brute_choice([(h[i], w) for i, w in rows], whole, part)
        got = mix(df, F.col("doc_id"), F.col("words"), F.array(F.lit("s")), lambda _: {"s": float(quota)}).agg(F.sum("taken")).first()[0]
        assert got == want and quota - 50 <= got <= quota
        old, mixing.ROWS_PER_RANGE = mixing.ROWS_PER_RANGE, 100
        try:
            near = mix(df, F.col("doc_id"), F.col("words"), F.array(F.lit("s")), lambda _: {"s": float(quota)}).agg(F.sum("taken")).first()[0]
        finally:
            mixing.ROWS_PER_RANGE = old
        assert quota - 50 <= near <= quota
