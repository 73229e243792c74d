import hashlib
import random
import re

from tessera.llm.decontamination import Automaton, decontaminate, digest, matches, words_of

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def brute(doc, items, window):
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), doc or ""))
    hit, found = set(), set()
    for item, text in items:
        v = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        wins = [v[i : i + window] for i in range(len(v) - window + 1)] if len(v) >= window else [v] if v else []
        for x in wins:
            for i in range(len(w) - len(x) + 1):
                if w[i : i + len(x)] == x:
                    hit |= set(range(i, i + len(x)))
                    found.add(item)
    return len(w), len(hit), sorted(found)


def test_automaton_equals_brute_force():
    rnd = random.Random(4)
    for _ in range(400):
        k = rnd.choice([2, 3, 6])
        text = lambda n, k=k: " ".join(rnd.choice("abcdef"[:k]) for _ in range(rnd.randint(0, n)))
        window = rnd.choice([1, 2, 3, 5])
        items = [(str(rnd.randint(0, 9)), text(9)) for _ in range(rnd.randint(0, 6))]
        automaton = Automaton([(i, t.encode()) for i, t in items], window)
        doc = text(40) + rnd.choice(["", " zz ", " Zz. "]) + text(20)
        spans, found = automaton.match(words_of(doc.encode()))
        assert (sum(b - a for a, b in spans), sorted(found)) == brute(doc, items, window)[1:]


def fixture(spark):
    item = "One two three four five six seven eight nine ten eleven twelve"
    docs = [
        (1, "intro é words " + item.upper() + "! outro" + " more" * 20, "en", "a", 0),
        (2, "clean text of its own", "en", "a", 21),
        (3, None, "en", "a", None),
        (4, "", "en", None, 0),
        (5, item, "en", "a", 0),
        (6, "x " * 50_000 + "short item here", "en", "a", 0),
        (6, "x " * 50_000 + "short item here", "en", "a", 0),
        (None, "one two three four five six seven eight nine", None, None, 44),
    ]
    items = [(10, item), (9, "short  ITEM here"), (9, "..."), (None, None), (2, item)]
    return spark.createDataFrame(docs, SCHEMA), docs, spark.createDataFrame(items, "item_id long, text string"), items


def test_digest_and_blocks(spark):
    docs, rows, bench, items = fixture(spark)
    want = []
    for d, t, *_ in rows:
        n, hit, found = brute(t, [(str(i), x) for i, x in items], 10)
        want.append((d, n, hit, len(found), hashlib.sha256(",".join(found).encode()).hexdigest(), hit > 0))
    for size in (1 << 20, 20):
        got = [tuple(r) for r in digest(matches(docs, bench, block_bytes=size)).collect()]
        assert sorted(got, key=str) == sorted(want, key=str)


def test_empty_tables(spark):
    docs, _, bench, _ = fixture(spark)
    assert digest(matches(docs.limit(0), bench)).count() == 0
    assert digest(matches(docs, bench.limit(0))).filter("contaminated").count() == 0


def test_decontaminate_cuts_spans_and_drops_covered_documents(spark):
    docs, rows, bench, _ = fixture(spark)
    out = {r["doc_id"]: r for r in decontaminate(docs, bench, least_words=3).collect()}
    assert 5 not in out and set(out) == {1, 2, 3, 4, 6, None}
    assert out[1]["text"] == "intro é words ! outro" + " more" * 20 and out[1]["n_chars"] == len(out[1]["text"])
    assert out[2]["text"] == rows[1][1] and out[3]["text"] is None
    assert out[6]["text"] == "x " * 50_000
    assert decontaminate(docs, bench).columns == docs.columns


def test_blocks_equal_brute_force(spark, monkeypatch):
    from tessera.llm import decontamination

    monkeypatch.setattr(decontamination, "TEXTS_PER_TASK", 7)
    rnd = random.Random(6)
    text = lambda n: " ".join(rnd.choice(["ab", "Cd", "é", "x9", "zz-y"]) for _ in range(rnd.randint(0, n)))
    items = [(str(rnd.randint(0, 30)), text(9)) for _ in range(60)] + [("all", "ab")]
    rows = [(i, text(40)) for i in range(120)] + [(120, None), (3, rnd.choice(items)[1])]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("doc_id", "text", "1 words", "2 key", "3 block", "4 `row`", "5 spans", "6 __items")
    want = sorted((str(d), *brute(t, items, 4)) for d, t in rows)
    for size in (1 << 20, 100):
        found = matches(docs, spark.createDataFrame(items, "item_id string, text string"), window=4, block_bytes=size)
        got = sorted((str(r["row"]["doc_id"]), r["words"], sum(b - a for a, b in zip(r["spans"][::2], r["spans"][1::2])), r["items"]) for r in found.collect())
        assert got == want
    assert decontaminate(docs, spark.createDataFrame(items, "item_id string, text string"), window=4).columns == docs.columns


def test_equal_items_are_one_string():
    words = " ".join(f"w{i}" for i in range(300))
    automaton = Automaton([(str(i), words.encode()) for i in range(4000)], 10)
    assert len(automaton.next) < 700 and sum(map(len, automaton.holds.values())) < 700
    assert len(automaton.match(words_of(words.encode()))[1]) == 4000


def test_a_document_made_of_a_short_item_goes(spark):
    docs = spark.createDataFrame([(1, "short item", None, None, 1), (2, "short item " + "and more words " * 5, None, None, 1)], SCHEMA)
    bench = spark.createDataFrame([(1, "short item")], "item_id long, text string")
    assert [(r["doc_id"], r["text"][:10]) for r in decontaminate(docs, bench, least_words=5).collect()] == [(2, "short item")]
