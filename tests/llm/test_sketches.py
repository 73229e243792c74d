import hashlib
import random
import re

import numpy as np

from tessera.llm.sketches import containment, decoded, distinct_shingles, edited_likeness, encoded, fingerprint_column, merge, resemblance, shingle_hashes, sketches


def shingles(t, size=5):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t))
    return [tuple(w[i : i + size]) for i in range(max(1, len(w) - size + 1))] if w else []


def texts(rnd, n):
    return [" ".join(rnd.choice(["Ab", "cd", "é", "fgh", "i", "j", "x\ty"]) for _ in range(rnd.choice([0, 1, 3, 5, 9, 60]))) for _ in range(n)]


def test_hashes_follow_the_shingles():
    rnd = random.Random(7)
    some = texts(rnd, 300) + ["a b c d e f", "A B  c\nd e f "]
    known: dict = {}
    for t, h in zip(some, shingle_hashes([t.encode() for t in some]), strict=True):
        want = shingles(t)
        assert len(want) == len(h)
        for s, x in zip(want, h.tolist(), strict=True):
            assert known.setdefault(s, x) == x
    assert len(set(known.values())) == len(known)


def test_estimates():
    rnd = np.random.default_rng(1)
    a = [f"w{i}" for i in rnd.integers(0, 10**6, 4000)]
    b = a[:2000] + [f"v{i}" for i in range(2000)]
    x, y, z = sketches([" ".join(t).encode() for t in (a, b, a + b)])
    truth = len(set(shingles(" ".join(a))) & set(shingles(" ".join(b)))) / len(set(shingles(" ".join(a))) | set(shingles(" ".join(b))))
    assert abs(resemblance(x, y) - truth) < 0.15
    assert abs(containment(x, y) - 0.5) < 0.2
    assert abs(distinct_shingles(x) / 3996 - 1) < 0.3
    assert resemblance(merge(x, y), z) > 0.9
    assert (decoded(encoded(x)) == x).all()
    e = np.zeros(0, np.uint64)
    assert resemblance(e, e) == 1 and resemblance(e, x) == 0 and distinct_shingles(e) == 0


def test_edited_likeness_equals_brute_force(spark):
    rnd = random.Random(3)
    rows = [(int(i), t) for i, t in zip(rnd.sample(range(-50, 500), 120), texts(rnd, 120), strict=True)]
    rows += [(None, "null id " * 9), (600, None), (601, "é" * 30_001), (602, "dup a b c d"), (602, "dup a b c d"), (602, "aaa b c d e f g")]
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, fingerprint string").repartition(5)
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, (r[1] or "").encode()))
    want = []
    for (i, t), (_, u) in zip(rows, rows[1:] + rows[:1], strict=True):
        t, u = t or "", u or ""
        edited = t[: len(t) - len(t) // 2] + u[: len(t) // 2]
        a, b, c = (set(shingles(x)) for x in (t, edited, u))
        like = lambda p, q: float(p == q) if not p or not q else len(p & q) / len(p | q)
        want.append((i, len(t), hashlib.sha256(edited.encode()).hexdigest(), round(like(a, b), 9), round(like(a, c), 9)))
    got = [(r["doc_id"], r["n_chars"], r["edited_sha256"], round(r["near_edited"], 9), round(r["near_next"], 9)) for r in edited_likeness(docs).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)
    same = {r["doc_id"]: r["fingerprint"] for r in fingerprint_column(docs).collect() if r["doc_id"] != 602}
    assert all(same[r["doc_id"]] == r["fingerprint"] for r in edited_likeness(docs).collect() if r["doc_id"] != 602)


def test_one_row_and_none(spark):
    docs = spark.createDataFrame([(4, "one two three four")], "doc_id long, text string")
    assert [(r["n_chars"], r["near_next"]) for r in edited_likeness(docs).collect()] == [(18, 1.0)]
    assert edited_likeness(docs.limit(0)).count() == 0
    assert edited_likeness(spark.createDataFrame([(None, "a")], "doc_id long, text string")).count() == 1


def test_any_number_of_shuffle_partitions(spark):
    docs = spark.createDataFrame([(i, f"w{i} " * (i % 7 * 300)) for i in range(5000)], "doc_id long, text string")
    want = sorted(map(str, edited_likeness(docs).collect()))
    old = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for n in (1, 1000, 4000):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            assert sorted(map(str, edited_likeness(docs).collect())) == want
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)


def test_ranges_are_even_and_apart(spark, monkeypatch):
    from tessera.llm import ranges

    monkeypatch.setattr(ranges, "RANGE_BYTES", 10_000)
    docs = spark.createDataFrame([(i * i, "x" * 100) for i in range(60_000)], "doc_id long, text string")
    n = ranges.how_many(docs, "text")
    cuts = ranges.even_cuts(docs, "doc_id", n)
    assert 0.9 * 600 <= len(cuts) + 1 <= 1.1 * 600
    dealt = docs.withColumn("range", ranges.number(cuts)(docs["doc_id"])).withColumn("place", ranges.place(spark, len(cuts) + 2)(docs["doc_id"] * 0 + 1))
    sizes = [r["count"] for r in dealt.groupBy("range").count().collect()]
    assert max(sizes) < 3 * 100
    assert len({(r["p"]) for r in spark.createDataFrame([(x,) for x in ranges.places(spark, 700)], "x int").selectExpr("pmod(hash(x), 700) p").collect()}) == 700
