import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from tessera.llm import spelling
from tessera.llm.spelling import variants, word_counts


def counted(rows, least=6, every=0):
    out: Counter = Counter()
    for d, t in rows:
        for w in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            w = "".join(c.lower() if c.isascii() else c for c in w)
            if every:
                h = zlib.crc32(f"{'' if d is None else d}:{w}".encode())
                if h % every == 0:
                    w = w[: h % len(w)] + w[h % len(w) + 1 :]
            if len(w) >= least:
                out[w] += 1
    return out


def one_edit(u, v):
    if abs(len(u) - len(v)) > 1 or u == v:
        return False
    if len(u) == len(v):
        return sum(a != b for a, b in zip(u, v)) == 1
    u, v = sorted((u, v), key=len)
    return any(v[:i] + v[i + 1 :] == u for i in range(len(v)))


def brute_force(counts, least, times):
    words = {w: n for w, n in counts.items() if n >= least}
    form, near = {}, {}
    for w, n in words.items():
        close = [v for v in words if one_edit(w, v)]
        near[w] = len(close)
        best = min(close, key=lambda v: (-words[v], v), default=None)
        form[w] = best if best is not None and words[best] >= times * n else None
    out = set()
    for w, n in words.items():
        root = w
        while form[root]:
            root = form[root]
        out.add((w, form[w], root, n, near[w], words.get(form[w])))
    return out


def test_word_counts_against_brute_force(spark):
    rng = random.Random(4)
    rows = [(d, " ".join("".join(rng.choice("aAbÀÿé×") for _ in range(rng.randint(1, 9))) + rng.choice(["", "-", "ā", "7"]) for _ in range(80))) for d in range(60)]
    rows += [(None, "Abcdefg Abcdefg"), (3, None), (4, ""), rows[0], (61, "abcdefgh " * 30_000)]
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, word string")
    for every in (0, 3):
        got = {r["word"]: r["n"] for r in word_counts(docs, slip_every=every).collect()}
        assert got == counted(rows, every=every)


def test_counts_are_sent_in_parts(spark, monkeypatch):
    monkeypatch.setattr(spelling, "HELD", 3)
    rows = [(d, "abcdefg bcdefgh cdefghi defghij efghijk") for d in range(9)]
    got = {r["word"]: r["n"] for r in word_counts(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == counted(rows)


@pytest.mark.parametrize("word", ["", "a", "aab", "abéé", "bbbb"])
def test_neighbours_are_each_string_once(monkeypatch, word):
    letters = "abé"
    hashed = lambda w: sum(ord(c) * spelling.BASE**i for i, c in enumerate(w)) % 2**64
    want = {word[:i] + word[i + 1 :] for i in range(len(word))} | {word[:i] + c + word[i + 1 :] for i in range(len(word)) for c in letters} | {word[:i] + c + word[i:] for i in range(len(word) + 1) for c in letters}
    for at_once in (1, 5, 1 << 19):
        monkeypatch.setattr(spelling, "AT_ONCE", at_once)
        got = []
        for taken, length, w, i, a, h in spelling.neighbours(np.array([[ord(c) for c in word]] * 2, np.uint64).reshape(2, len(word)), np.array([ord(c) for c in letters], np.uint64)):
            for which, p, c, x in zip(w.tolist(), i.tolist(), a.tolist(), h.tolist()):
                built = word[:p] + (chr(c) if c else "") + word[p + taken :]
                assert len(built) == length and x == hashed(built)
                got.append((which, built))
        assert sorted(got) == sorted((k, v) for k in (0, 1) for v in want - {word})


@pytest.mark.parametrize("full", [False, True])
def test_variants_against_brute_force(spark, monkeypatch, full):
    """Also with a filter that lets everything pass."""
    if full:
        monkeypatch.setattr(spelling, "filter_of", lambda vocabulary, n: (15, np.full(4096, 255, np.uint8)))
    rng = random.Random(1)
    counts: Counter = Counter()
    while len(counts) < 500:
        w = "".join(rng.choice("abé") for _ in range(rng.choice([1, 2, 4, 5, 6, 7])))
        counts[w] = rng.choice([1, 4, 5, 5, 6, 25, 30, 125, 700, 4000])
    long = "ab" * (40 if full else 400)
    counts |= {long: 9, long[:-1]: 45, long[:30] + "é" + long[31:]: 225, "日本語日本語": 5, "日本語日語": 50}
    found = variants(spark.createDataFrame(list(counts.items()), "word string, n long"))
    assert {tuple(r) for r in found.collect()} == brute_force(counts, 5, 5)


def test_no_words(spark):
    docs = spark.createDataFrame([(1, None), (2, "a b c")], "doc_id long, text string")
    assert variants(word_counts(docs)).count() == 0
