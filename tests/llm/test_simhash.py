import random
import re

import numpy as np
import xxhash

from tessera.llm.components import components
from tessera.llm.simhash import fingerprint, forest, independent, keep_one, near_duplicates, plan


def brute_fingerprint(text, size=3):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(words[i : i + size]) for i in range(max(1, len(words) - size + 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(rows, distance):
    fps = [brute_fingerprint(t) for _, t in rows]
    group = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= distance:
                a, b = group[i], group[j]
                group = [a if g == b else g for g in group]
    least = {g: min(rows[i][0] for i in range(len(rows)) if group[i] == g) for g in group}
    return sorted((rows[i][0], f"{fps[i]:016x}", least[group[i]]) for i in range(len(rows)))


def corpus(rnd, n):
    words = [f"w{i}" for i in range(40)]
    rows = []
    for i in range(n):
        if rows and rnd.random() < 0.6:
            t = (rnd.choice(rows)[1] or "").split(" ")
            t[rnd.randrange(len(t))] = rnd.choice(words)
            rows.append((i, " ".join(t)))
        else:
            rows.append((i, " ".join(rnd.choice(words) for _ in range(rnd.choice([1, 2, 4, 150])))))
    return rows + [(n, None), (n + 1, ""), (n + 2, " \t\n "), (n + 3, "Ünï CODE x " * 4000), (n + 4, "Ünï CODE x " * 4000)]


def test_fingerprint():
    rnd = random.Random(3)
    for _, t in corpus(rnd, 60):
        assert fingerprint((t or "").encode(), 3).hex() == f"{brute_fingerprint(t):016x}"
    assert len(fingerprint(b"a b c", 5, 8)) == 64


def test_near_duplicates_equal_brute_force(spark):
    rnd = random.Random(5)
    rows = corpus(rnd, 160)
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, fp string")
    for distance in (3, 9):
        got = sorted((r["doc_id"], r["fp"].hex(), r["component"]) for r in near_duplicates(docs, distance=distance).collect())
        assert got == brute_components(rows, distance)
    assert near_duplicates(docs.limit(0)).count() == 0


def test_plan_covers_the_distance():
    rnd = np.random.default_rng(1)
    for n in (10, 10**6, 10**9, 10**12):
        x = (rnd.random((500, 64)) < 0.5).astype(float)
        both = x.T @ x / 500 * n
        index = plan(n, both, 3, lambda parts: np.array([independent(n, both, p, 3) for p in parts]))
        assert sum(t + 1 for _, t in index) == 4
        assert sorted(b for p, _ in index for b in p) == sorted(set(b for p, _ in index for b in p))


def test_forest_connects_what_is_close():
    rnd = np.random.default_rng(2)
    base = rnd.integers(0, 2**63, 5, dtype=np.uint64)
    fp = np.array([base[i % 5] ^ np.uint64(1 << int(rnd.integers(0, 64))) for i in range(400)], np.uint64).reshape(-1, 1)
    links = forest(fp, 3)
    assert len(links) == 395


def test_components(spark):
    rnd = random.Random(8)
    edges = [(rnd.randrange(300), rnd.randrange(300)) for _ in range(200)] + [(1000 + i, 1001 + i) for i in range(60)]
    group = {}
    for a, b in edges:
        x, y = group.setdefault(a, {a}), group.setdefault(b, {b})
        if x is not y:
            x |= y
            for k in y:
                group[k] = x
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {k: min(g) for k, g in group.items() if len(g) > 1}


def test_keep_one(spark):
    rows = [(3, "a b c d e f", 1), (2, "a b c d e f", 1), (2, "a b c d e f", 1), (None, "a b c d e f", 1), (5, None, 0), (6, "", 0), (7, "other words", 2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_chars long")
    assert sorted(r["doc_id"] for r in keep_one(docs).collect()) == [2, 5, 7]
    assert keep_one(docs).columns == docs.columns
    named = docs.withColumnsRenamed({"n_chars": "id"}).withColumn("row", docs["doc_id"])
    assert keep_one(named).columns == named.columns


def test_chances_count_real_pairs(spark):
    """Bits that go together meet far more often than independent ones would."""
    from tessera.llm.simhash import bit_counts, meeting_chances

    rnd = np.random.default_rng(5)
    rows = []
    for i in range(512):
        together = rnd.random() < 0.5
        bits = np.concatenate((np.full(16, together), rnd.random(48) < 0.5))
        rows.append((np.packbits(bits).tobytes(),))
    distinct = spark.createDataFrame(rows, "fp binary").coalesce(1)
    n, both = bit_counts(distinct, 1)
    found = meeting_chances(distinct, n, both, [list(range(16)), list(range(16, 32))], 1, 1)
    assert n == 512 and abs(found[0, 0] - 0.5) < 0.05 and found[1, 1] < 0.01
    assert independent(n, both, list(range(16)), 0)[0] < 1e-4
