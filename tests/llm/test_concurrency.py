import datetime as dt
import random

import pytest

from tessera.llm.concurrency import open_sales, sweep

SCHEMA = "nation int, a long, b long, cents long, key string, at string"


def brute_force(rows):
    """Every key's moments, one by one, with all intervals looked at for each."""
    out = set()
    rows = [(k, a, b, c or 0) for k, a, b, c in rows if a is not None and (b is None or b > a)]
    for key in {r[0] for r in rows}:
        own = [r for r in rows if r[0] == key]
        at, was = [], (0, 0)
        for t in sorted({r[1] for r in own} | {r[2] for r in own if r[2] is not None}):
            now = [r for r in own if r[1] <= t and (r[2] is None or r[2] > t)]
            if (sums := (len(now), sum(r[3] for r in now))) != was:
                at.append((t, *sums))
                was = sums
        top = max((n for _, n, _ in at), default=0)
        for i, (t, n, c) in enumerate(at):
            out.add((key, t, at[i + 1][0] if i + 1 < len(at) else None, n, c, max(x[1] for x in at[: i + 1]), n == top))
    return out


@pytest.mark.parametrize("buckets", [1, 2, 7, 128])
def test_sweep_against_brute_force(spark, buckets):
    rng = random.Random(buckets)
    rows = []
    for _ in range(400):
        a = rng.choice([None, *range(-50, 60)]) if rng.random() < 0.9 else rng.randint(-(10**9), 10**9)
        b = None if a is None or rng.random() < 0.1 else a + rng.choice([-3, 0, 1, 2, 7, 30, 10**7])
        rows.append((rng.choice([None, 1, 1, 1, 2, 3]), a, b, rng.choice([None, 0, 5, 5, 7])))
    rows += rows[:40]
    spans = spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA)
    found = sweep(spans, "nation", "a", "b", "cents", buckets).collect()
    assert len(found) == len(brute_force(rows))
    assert {tuple(r) for r in found} == brute_force(rows)


def test_one_key_at_one_moment_and_no_rows(spark):
    spans = spark.createDataFrame([(1, 5, 9, 3, "", "")] * 50, SCHEMA)
    assert sorted(tuple(r) for r in sweep(spans, "nation", "a", "b", "cents").collect()) == [(1, 5, 9, 50, 150, 50, True), (1, 9, None, 0, 0, 50, False)]
    assert sweep(spans.limit(0), "nation", "a", "b", "cents").count() == 0


def test_what_replaces_what_is_no_moment(spark):
    spans = spark.createDataFrame([(1, 0, 10, 3, "", ""), (1, 10, 20, 3, "", ""), (1, 20, 30, 4, "", "")], SCHEMA)
    assert sorted(r["from_s"] for r in sweep(spans, "nation", "a", "b", "cents").collect()) == [0, 20, 30]


def test_open_sales(spark):
    at = lambda s: dt.datetime(2024, 1, 1) + dt.timedelta(seconds=s)
    base = 1_704_067_200
    sales = spark.createDataFrame(
        [(1, 1, at(59), 1.005), (2, 2, at(60), None), (3, None, None, 2.0), (4, 9, at(0), 0.125), (5, 3, at(30 * 86_400), 1.0), (None, 1, at(121), 3.0)],
        "sale_id long, client_id long, sold_at timestamp_ntz, total double",
    )
    lines = spark.createDataFrame([(1, at(10)), (1, at(86_459)), (1, None), (4, None), (5, at(86_400)), (None, at(1))], "sale_id long, shipped_at timestamp_ntz")
    clients = spark.createDataFrame([(1, 7), (2, None), (3, 4), (3, 5), (None, 8)], "client_id long, nation_id int")
    got = sorted(map(tuple, open_sales(sales, lines, clients).collect()), key=repr)
    want = [(7, base, base + 86_400 + 604_800, 100), (-1, base + 60, None, 0), (-1, base, None, 13), (7, base + 120, None, 300)]
    assert got == sorted(want + [(-2, *r[1:]) for r in want], key=repr)
