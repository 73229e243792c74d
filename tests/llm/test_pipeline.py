import random

import numpy as np

import corpus_pipeline
from tessera.llm import near_copies as near
from tessera.llm.near_copies import near_copies
from tessera.llm.simhash import grouped_bits, independent, keep_one


def shingles(text, size):
    words = text.lower().split()
    return {tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1))}


def test_near_copies_go_and_others_stay(spark):
    rnd = random.Random(4)
    words = [f"w{i}" for i in range(3000)]
    rows, copies = [], set()
    for i in range(120):
        t = [rnd.choice(words) for _ in range(rnd.randint(150, 400))]
        rows.append((i, " ".join(t), "en", "s", 0))
        if i % 4 == 0:
            t[rnd.randrange(len(t))] = "edited"
            rows.append((1000 + i, " ".join(t), "en", "s", 0))
            copies.add(1000 + i)
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    kept = {r["doc_id"] for r in keep_one(docs, **corpus_pipeline.NEAR).collect()}
    assert kept == set(range(120))


def test_stages_and_run(spark, tmp_path):
    rnd = random.Random(9)
    words = [f"word{i}" for i in range(500)]
    item = " ".join(rnd.choice(words) for _ in range(30))
    docs, labels = [], []
    for i in range(260):
        t = [rnd.choice(words) for _ in range(rnd.randint(20, 80))]
        bad = i % 6 == 0
        if bad:
            for _ in range(5):
                t.insert(rnd.randrange(len(t)), rnd.choice(["vile", "nasty"]))
        docs.append((i, " ".join(t), "en", f"s{i % 5}", len(" ".join(t)), "extra"))
        labels.append((i, 1, int(bad)))
    docs += [(400, docs[1][1], "en", "s1", 5, None), (401, item + " " + docs[2][1], "en", "s2", 5, None), (402, None, None, None, None, None), (403, "", "en", "s1", 0, "x"), (None, "no id here " * 30, "en", "s1", 9, "x"), (404, "vile nasty vile nasty vile", "en", "s1", 9, "x")]
    schema = "doc_id long, text string, lang string, source string, n_chars long, `shard` string"
    spark.createDataFrame(docs, schema).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    now = spark.read.parquet(f"{tmp_path}/documents.parquet")
    after = {}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        now = stage(spark, now, str(tmp_path))
        if k < 4:
            assert now.columns == spark.read.parquet(f"{tmp_path}/documents.parquet").columns
        now.write.parquet(f"{tmp_path}/{k}")
        now = spark.read.parquet(f"{tmp_path}/{k}")
        after[name] = now.collect()
    ids = {name: {r["doc_id"] for r in rows} for name, rows in after.items()}
    toxic = {i for i in range(260) if i % 6 == 0} | {404}
    assert not ids["toxicity"] & toxic and len(ids["toxicity"]) >= 260 + 6 - len(toxic)
    assert 400 not in ids["simhash_near_dedup"] and ids["toxicity"] - ids["simhash_near_dedup"] <= {400, 402, 403}
    cut = {r["doc_id"]: r["text"] for r in after["decontamination"]}
    assert all(item not in (t or "") for t in cut.values()) and ids["simhash_near_dedup"] - ids["decontamination"] <= {401}
    shards: dict = {}
    for r in after["sharding"]:
        shards.setdefault(r["shard"], []).append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in shards.values())
    assert len(after["sharding"]) == len(after["mixing"])
    assert sorted(map(str, corpus_pipeline.run(spark, str(tmp_path)).collect())) == sorted(map(str, after["sharding"]))


def test_links_are_resemblance(spark):
    rnd = random.Random(11)
    words = [f"w{i}" for i in range(3000)]
    docs = []
    for i in range(40):
        t = [rnd.choice(words) for _ in range(204)]
        docs.append((2 * i, " ".join(t)))
        for at in range(10, 10 + 5 * (3 + i % 4), 5):  # 15 to 30 of 200 shingles differ
            t[at] = f"new{at}"
        docs.append((2 * i + 1, " ".join(t)))
    core = [rnd.choice(words) for _ in range(300)]
    for i in range(60):  # a large bucket: copies that differ in one word or in a tail
        docs.append((100 + i, " ".join(core[: 300 - i] + [f"x{i}_{j}" for j in range(i)])))
    sets = [shingles(t, 5) for _, t in docs]
    group = list(range(len(docs)))
    for i in range(len(docs)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if 5 * both >= 4 * (len(sets[i]) + len(sets[j]) - both):
                a, b = group[i], group[j]
                group = [a if g == b else g for g in group]
    want = {docs[i][0]: min(docs[j][0] for j in range(len(docs)) if group[j] == group[i]) for i in range(len(docs))}
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    got = {r["doc_id"]: r["component"] for r in near_copies(frame, "doc_id", "text", **corpus_pipeline.NEAR).collect()}
    assert got == want
    assert 0 < sum(k != v for k, v in want.items() if k < 100) < 40  # some of the edited ones are below


def test_proposals():
    f = np.zeros((6, 8), np.uint64)
    f[5] = np.uint64(2**64 - 1)
    x, y, d, more = near.proposals(f, None, 3, 2)
    assert more and not d.any() and sorted(zip(x.tolist(), y.tolist())) == [(0, 1), (0, 2), (0, 3), (0, 4), (1, 2), (1, 3), (1, 4)]
    x, y, _, more = near.proposals(f, np.array([7, 7, 7, 3, 3, 5]), 3, None)
    assert not more and sorted(zip(x.tolist(), y.tolist())) == [(a, b) for a in range(3) for b in (3, 4)]


def test_index_keeps_recall_and_pairs_as_it_grows():
    """The chosen thresholds reach the recall, are unequal where costs are, and random pairs a text grow slower than texts by far."""
    rnd = np.random.default_rng(1)
    share = np.where(np.arange(512) < 100, 0.9, 0.5)  # some bits tell little
    x = (rnd.random((3000, 512)) < share).astype(float)
    differ, per_text = near.differing(0.8), {}
    for n in (2_000, 20_000, 200_000, 2_000_000):
        both = x.T @ x / len(x) * n
        parts = near.offered(n, both, differ, 0.99)
        chances = np.array([independent(n, both, p, 1) for p in parts])
        index = near.allocate(n, parts, chances, differ, 0.99)
        assert sum(near.gains(len(p), differ)[t] for p, t in index) >= -np.log(0.01) * 0.999
        used = {tuple(p) for p, _ in index}
        cost = {tuple(p): c for p, c in zip(parts, chances[:, 0])}
        assert len(used) < len(parts) and np.mean([cost[p] for p in used]) < np.mean([c for p, c in cost.items() if p not in used])
        per_text[n] = n * sum(cost[tuple(p)] for p, _ in index) / len(index)
    assert per_text[2_000_000] < 3 * per_text[20_000]
    assert len(grouped_bits(10, np.eye(512), 36)) == 36


def test_many_copies_send_few_pairs(spark):
    """A large group of near copies: fewer pairs are tested than a small multiple of its texts, and all are linked."""
    rnd = random.Random(2)
    core = [f"w{rnd.randrange(5000)}" for _ in range(300)]
    docs = []
    for i in range(700):
        t = list(core)
        for _ in range(rnd.randint(0, 3)):
            t[rnd.randrange(300)] = f"x{i}"
        docs.append((i, " ".join([*t, f"end{i}"])))
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    tested = []
    old = near.materialize

    def watched(df, name):
        out = old(df, name)
        if name == "near-tested":
            tested.append(out.count())
        return out

    near.materialize = watched
    try:
        got = {r["component"] for r in near_copies(frame, "doc_id", "text", **corpus_pipeline.NEAR).collect()}
    finally:
        near.materialize = old
    assert got == {0} and sum(tested) < 700 * 8 < 700 * 699 / 2


def test_a_passage_that_repeats_inside_a_text(spark):
    """Resemblance is of sets, and so are the fingerprints: how often a line stands in a text changes nothing."""
    rnd = random.Random(21)
    docs = []
    for i in range(40):
        body, line = (" ".join(f"w{rnd.randrange(4000)}" for _ in range(n)) for n in (200, 12))
        docs += [(2 * i, f"{body} {line}"), (2 * i + 1, f"{body}{f' {line}' * (1 + i)}")]
    docs += [(200, None), (201, ""), (201, "")]
    sets = {d: shingles(t or "", 5) for d, t in docs}
    assert all(len(sets[d] & sets[d + 1]) / len(sets[d] | sets[d + 1]) >= 0.8 for d in range(0, 80, 2))
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    got = {r["doc_id"]: r["component"] for r in near_copies(frame, "doc_id", "text", **corpus_pipeline.NEAR).collect()}
    assert all(got[d] == got[d + 1] == d for d in range(0, 80, 2)) and got[201] == got[200] == 200
    assert near_copies(frame.limit(0), "doc_id", "text", **corpus_pipeline.NEAR).count() == 0


def test_sharp_limits_keep_recall():
    """Of pairs at exactly 0.8, whatever their sizes, nearly all are within the limit; of pairs at 0.7 few."""
    rnd = np.random.default_rng(3)
    kept, far, pairs = 0, 0, 0
    for n, m, both, wide in ((4, 5, 4, 3), (9, 9, 8, 7), (30, 33, 28, 26), (64, 80, 64, 59), (90, 90, 80, 74), (300, 300, 267, 247), (900, 1000, 845, 783)):
        for _ in range(60):
            h = rnd.integers(0, 2**64, n + m, dtype=np.uint64)
            for share, count in ((both, True), (wide, False)):
                x, y = (np.frombuffer(near.majority(v, near.SHARP), np.uint64) for v in (h[:n], h[n - share : n - share + m]))
                ok = np.bitwise_count(x ^ y).sum() <= near.sharp_limit(np.array([min(n, m)]), 0.8)[0]
                kept, far = kept + (ok and count), far + (ok and not count and n >= 300)
            pairs += 1
    assert kept >= 0.995 * pairs and far <= 4


def test_a_group_below_the_resemblance_sends_few_pairs(spark):
    """Texts of one group, each two of which resemble each other by some 0.72, stay apart and are hardly tested."""
    rnd = random.Random(5)
    core = [f"w{rnd.randrange(5000)}" for _ in range(400)]
    docs = []
    for i in range(260):
        t = list(core)
        for at in rnd.sample(range(80), 12):
            t[5 * at] = f"x{i}_{at}"
        docs.append((i, " ".join(t)))
    sets = [shingles(t, 5) for _, t in docs]
    close = sum(len(a & b) >= 0.8 * len(a | b) for k, a in enumerate(sets) for b in sets[:k])
    tested = []
    old = near.materialize

    def watched(df, name):
        out = old(df, name)
        if name == "near-tested":
            tested.append(out.count())
        return out

    near.materialize = watched
    try:
        got = {r["doc_id"]: r["component"] for r in near_copies(spark.createDataFrame(docs, "doc_id long, text string"), "doc_id", "text", **corpus_pipeline.NEAR).collect()}
    finally:
        near.materialize = old
    assert sum(tested) < 260 * 12 < 260 * 259 / 6 and (close or all(k == v for k, v in got.items()))


def planned(df):
    return df.sparkSession._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "simple")


def test_texts_and_sets_are_dealt_out_once(spark, monkeypatch):
    """Sets of shingles lie by text and are not dealt out again in each turn; the rows themselves go through one exchange."""
    rnd = random.Random(31)
    docs = []
    for i in range(60):
        t = [f"w{rnd.randrange(4000)}" for _ in range(200)]
        docs += [(2 * i, " ".join(t)), (2 * i + 1, " ".join([*t, "end"]))]
    monkeypatch.setattr(near, "AT_A_TIME", 4)
    plans, written = [], []
    old = near.materialize

    def watched(df, name):
        if name == "near-tested":
            plans.append(planned(df))
        written.append(name)
        return old(df, name)

    monkeypatch.setattr(near, "materialize", watched)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        kept = keep_one(spark.createDataFrame(docs, "doc_id long, text string"), **corpus_pipeline.NEAR)
        assert planned(kept).count("SortAggregate") == 2 and "Exchange" not in planned(kept).split("LeftSemi")[0]
        assert {r["doc_id"] for r in kept.collect()} == set(range(0, 120, 2))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert plans and all(p.count("Exchange") == 2 and p.count("Bucketed: true") == 2 for p in plans)
    assert written.count("near-proposed") > 2
    assert not [t.name for t in spark.catalog.listTables() if t.name.startswith("near_shingles")]


def test_a_key_of_two_texts(spark):
    """A key that stands before several texts is linked by the sets of each."""
    rnd = random.Random(33)
    a, b = (" ".join(f"{x}{rnd.randrange(4000)}" for _ in range(200)) for x in "pq")
    frame = spark.createDataFrame([(1, a), (1, b), (2, f"{a} end"), (3, f"{b} end"), (4, "alone")], "doc_id long, text string")
    got = {r["doc_id"]: r["component"] for r in near_copies(frame, "doc_id", "text", **corpus_pipeline.NEAR).collect()}
    assert got == {1: 1, 2: 1, 3: 1, 4: 4}


def test_passes():
    index = [(list(range(8)), 0)] * 5 + [(list(range(8)), 1)] + [(list(range(8)), 0)] * 3
    parts = list(near.passes(index, 4))
    assert [(k, len(some)) for k, some in parts] == [(0, 4), (4, 1), (5, 1), (6, 3)] and [x for _, some in parts for x in some] == index
    assert list(near.passes([], 4)) == [(0, [])]


def test_wide_rows_go_to_python_few_at_a_time(spark):
    """Rows that hold texts are written in small Arrow batches; the session's own setting stays, and no text goes to Python twice."""
    import pyarrow as pa

    from tessera.llm.common import BATCH, WIDE_ROWS, materialize
    from tessera.llm.decontamination import decontaminate
    from tessera.llm.toxicity import keep_clean

    before = spark.conf.get(BATCH)
    seen = spark.range(0, 4 * WIDE_ROWS, 1, 1).mapInArrow(lambda batches: (pa.record_batch([pa.array([b.num_rows])], ["n"]) for b in batches), "n long")
    sizes = [r["n"] for r in materialize(seen, "batches", wide=True).collect()]
    assert sum(sizes) == 4 * WIDE_ROWS and max(sizes) <= WIDE_ROWS and spark.conf.get(BATCH) == before
    docs = spark.createDataFrame([(1, "one two three", "en", "web", 13)], "doc_id long, text string, lang string, source string, n_chars int")
    items = spark.createDataFrame([("a", "four five")], "item_id string, text string")
    labels = spark.createDataFrame([(1, 0)], "doc_id long, toxic int")
    for out in (decontaminate(docs, items), keep_clean(docs, labels)):
        sent = out._jdf.queryExecution().analyzed().children().head().schema().simpleString()
        assert sent.count("text:string") == 1 and out.collect() == docs.collect()
