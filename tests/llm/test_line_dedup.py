import random

from tessera.llm.line_dedup import chunks, dedup_lines, dedup_runs




def test_chunks_resist_shifts():
    rnd = random.Random(1)
    lines = [str(rnd.random()) for _ in range(400)]
    a = chunks("\n".join(lines).encode())
    b = chunks("\n".join([*lines[:7], "new", *lines[7:]]).encode())
    assert b"\n".join(a).decode() == "\n".join(lines)
    assert len(set(a) & set(b)) > 0.9 * len(a)
    assert chunks(b"") == [b""] and max(c.count(b"\n") for c in chunks(b"\n" * 1000)) < 64


def test_first_occurrence_stays(spark):
    rnd = random.Random(2)
    line = lambda: f"line {rnd.randrange(10**6)}"
    shared = [[line() for _ in range(12)] for _ in range(4)]
    rows = []
    for i in range(80):
        ls = [line() for _ in range(rnd.randint(0, 9))] + rnd.choice(shared) + [line() for _ in range(rnd.randint(0, 9))]
        rows.append((i, "\n".join(ls)))
    rows += [(100, None), (101, ""), (102, "one line"), (103, "one line"), (3, rows[3][1]), (None, rows[4][1]), (104, "x y\n" * 30_000)]
    docs = spark.createDataFrame([(*r, 7) for r in rows], "doc_id long, text string, rk int").repartition(5)
    got = dedup_lines(docs).collect()
    assert len(got) == len(rows)
    # which occurrence is first: by id (null last), then place; rows that are equal are one
    first: dict = {}
    for none, d, t in sorted({(d is None, d or 0, t) for d, t in rows if t is not None}):
        for n, c in enumerate(chunks(t.encode())):
            if b"\n" in c:
                first.setdefault(c, (none, d, n))
    want = {}
    for d, t in rows:
        if t is None:
            want[d, t] = (0, 0, 0, None)
            continue
        parts = chunks(t.encode())
        lost = {n for n, c in enumerate(parts) if b"\n" in c and first[c] != (d is None, d or 0, n)}
        want[d, t] = (len(t.split("\n")), len(lost), sum(parts[n].count(b"\n") + 1 for n in lost), b"\n".join(c for n, c in enumerate(parts) if n not in lost).decode())
    assert sorted(((r["doc_id"], r["n_lines"], r["removed_chunks"], r["removed_lines"], r["text"]) for r in got), key=str) == sorted(((d, *want[d, t]) for d, t in rows), key=str)
    assert sum(r["removed_chunks"] for r in got) > 60
    assert dedup_lines(docs.limit(0)).count() == 0


def test_every_repeated_run_goes(spark):
    rnd = random.Random(3)
    line = lambda: f"line {rnd.randrange(10**9)}"
    shared = [[line() for _ in range(k)] for k in (2, 3, 4, 5, 6, 8, 12)]
    rows = []
    for i in range(60):
        ls = [line() for _ in range(rnd.randint(0, 4))] + rnd.choice(shared) + [line() for _ in range(rnd.randint(0, 4))] + rnd.choice(shared)[rnd.randint(0, 1) :]
        rows.append((i, "\n".join(ls)))
    rows += [(70, None), (71, ""), (72, "one line"), (73, "one line"), (74, "x\nx\nx\nx\ny"), (75, "y\nx\nx"), (3, rows[3][1]), (None, rows[4][1])]
    got = dedup_runs(spark.createDataFrame(rows, "doc_id long, text string").repartition(5)).collect()
    # brute force: all runs of two lines or more that stand at an earlier place
    seen, want = {}, {(d, None): (0, 0, None) for d, t in rows if t is None}
    for none, d, t in sorted({(d is None, d or 0, t) for d, t in rows if t is not None}):
        ls, lost = t.split("\n"), set()
        for a in range(len(ls)):
            for b in range(a + 2, len(ls) + 1):
                at = seen.setdefault(tuple(ls[a:b]), (none, d, a))
                if at != (none, d, a):
                    first = range(at[2], at[2] + b - a) if at[:2] == (none, d) else ()
                    lost |= {i for i in range(a, b) if i not in first}
        want[None if none else d, t] = (len(ls), len(lost), "\n".join(x for i, x in enumerate(ls) if i not in lost))
    assert sorted(((r["doc_id"], r["n_lines"], r["removed_lines"], r["text"]) for r in got), key=str) == sorted(((d, *want[d, t]) for d, t in rows), key=str)
    short = next(r for r in got if r["doc_id"] == 75)
    assert short["text"] == "y" and short["n_chunks"] == 2 and short["removed_chunks"] == 1
    assert dedup_runs(spark.createDataFrame([], "doc_id long, text string")).count() == 0
