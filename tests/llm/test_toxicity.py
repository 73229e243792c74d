import random
import zlib
from itertools import product

import numpy as np

from tessera.llm.toxicity import Tagger, chain, fit, fold, keep_clean, score


def random_tagger(rnd, classes=3):
    t = Tagger({b"w%d" % i: i for i in range(1, classes + 1)}, rnd.normal(size=classes + 1) * 2, rnd.normal(size=(2, 2)))
    t.prepare()
    return t


def brute_marginals(emit, move, ids):
    total, out = 0.0, np.zeros(len(ids))
    for tags in product((0, 1), repeat=len(ids)):
        s = sum(emit[c] * y for c, y in zip(ids, tags)) + sum(move[a, b] for a, b in zip(tags, tags[1:]))
        total += np.exp(s)
        out += np.exp(s) * np.array(tags)
    return out / total


def test_marginals_equal_enumeration():
    rnd = np.random.default_rng(5)
    for _ in range(40):
        tagger = random_tagger(rnd)
        n = int(rnd.integers(1, 10))
        ids = np.where(rnd.random(n) < 0.5, 0, rnd.integers(1, 4, n))
        want = brute_marginals(tagger.emit, tagger.move, ids)
        dense, _, _ = chain(tagger.emit, tagger.move, np.pad(ids, (0, 3))[None], np.pad(np.ones(n, bool), (0, 3))[None])
        assert np.allclose(dense[0, :n], want)
        at = np.flatnonzero(ids)
        assert np.allclose(tagger.marginals(n, at, ids[at]), want[at])


def test_long_gaps_are_exact():
    """Against the chain over every word, with gaps on both sides of what is ready."""
    rnd = np.random.default_rng(7)
    for n, at in ((3000, [700, 1212, 2990]), (2100, [0, 513, 1026, 2099]), (1600, [1599]), (1537, [0])):
        tagger = random_tagger(rnd)
        tagger.move += np.array([[1.5, -1.5], [-1.5, 1.5]])  # a chain that forgets slowly
        tagger.emit[0] = rnd.normal() * 0.01
        tagger.prepare()
        ids = np.zeros(n, np.int64)
        ids[at] = rnd.integers(1, 4, len(at))
        dense, _, _ = chain(tagger.emit, tagger.move, ids[None], np.ones((1, n), bool))
        assert np.allclose(tagger.marginals(n, np.array(at), ids[at]), dense[0, at], atol=1e-9)


def test_scores_against_brute_force(spark):
    """The query's scores from plain Python: words, the chain over all of them, the document's regression."""
    import re

    _, _, docs, marks = corpus(spark, 300)
    tagger = fit(docs, marks)
    assert tagger.lexicon
    for r in score(docs, tagger, spans=None).collect():
        words = [w.encode() for w in re.findall(r"[0-9a-z\x80-\U0010ffff]+", (r["text"] or "").lower())]
        p = np.zeros(0)
        if words:
            ids = np.array([[tagger.lexicon.get(w, 0) for w in words]])
            post, _, _ = chain(tagger.emit, tagger.move, ids, np.ones(ids.shape, bool))
            p = post[0][ids[0] > 0]
        total, most, n = p.sum(), p.max(initial=0), len(words)
        x = np.array([1, np.log(1 + total), most, total > 1.5, np.log(1 + n) / 10, np.log(1 + 100 * total / (n + 20))]) @ tagger.document
        assert abs(r["score"] - 1 / (1 + np.exp(-np.clip(x, -30, 30)))) < 1e-6


def corpus(spark, n=900):
    rnd = random.Random(6)
    rows, labels = [], []
    for i in range(n):
        words = [f"{rnd.choice('abcdefgh')}{rnd.randrange(300)}" for _ in range(rnd.randint(5, 120))]
        bad = rnd.random() < 0.2
        if bad:
            for _ in range(4):
                words.insert(rnd.randrange(len(words)), rnd.choice(["Vile", "RÜDE,", "nasty!"]))
        rows.append((i, " ".join(words), "x"))
        if i % 3:
            labels.append((i, 1, int(bad)))
    rows += [(n, None, "x"), (n + 1, "", "x"), (None, "vile rüde", "x"), (n + 2, "plain " * 40_000 + "vile nasty rüde vile", "x"), (0, rows[0][1], "y")]
    labels += [(5, 0, None), (None, 1, 1), (7, 1, labels[4][2])]
    return rows, labels, spark.createDataFrame(rows, "doc_id long, text string, score string"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_held_out_accuracy_spans_and_cases(spark):
    rows, labels, docs, marks = corpus(spark)
    out = score(docs, fit(docs, marks)).collect()
    assert len(out) == len(rows)
    by = {r["doc_id"]: r for r in out}
    truth = {i: any(w in (t or "") for w in ("Vile", "RÜDE", "nasty")) for i, t, _ in rows}
    held = [i for i in range(900) if zlib.crc32(str(i).encode()) % 5 == 0]
    assert sum((by[i]["score"] >= 0.5) == truth[i] for i in held) / len(held) > 0.97
    assert by[900]["score"] == by[901]["score"] < 0.5 and by[None]["score"] > 0.5
    assert by[902]["score"] >= 0 and len(by[902]["spans"]) == 8
    for i, t, _ in rows[:60]:
        s = by[i]["spans"]
        for a, b in zip(s[::2], s[1::2]):
            assert t.encode()[a:b].decode() in ("Vile", "RÜDE", "nasty")
    kept = {r["doc_id"] for r in keep_clean(docs, marks).collect()}
    assert kept == {i for i, r in by.items() if r["score"] < 0.5}
    clashing = docs.withColumns({"__score": docs["doc_id"], "score": docs["doc_id"]})
    assert keep_clean(clashing, marks).columns == clashing.columns and {r["__score"] for r in keep_clean(clashing, marks).collect()} == kept


def test_fold_and_no_labels(spark):
    _, _, docs, marks = corpus(spark, 30)
    for r in docs.select("doc_id", fold(docs["doc_id"]).alias("f")).collect():
        assert r["f"] == zlib.crc32(str("" if r["doc_id"] is None else r["doc_id"]).encode()) % 5
    assert {r["score"] for r in score(docs, fit(docs, marks.limit(0))).collect()} == {0.0}
    assert score(docs.limit(0), fit(docs.limit(0), marks)).count() == 0
