import hashlib
import random
from collections import Counter

import numpy as np

from tessera.llm.suffix_dedup import anchor_windows, anchors, by_distance, digest, equal_windows, packed, remove_repeats, stretch_order, suffix_order, surroundings, unpacked


def test_suffix_order():
    rnd = random.Random(8)
    for _ in range(400):
        k = rnd.choice([1, 2, 3, 8])
        t = bytes(rnd.choice(b"abcdefgh"[:k]) for _ in range(rnd.randint(0, 80)))
        if rnd.random() < 0.3:
            t = t[:20] * 4
        assert suffix_order(t, 200).tolist() == sorted(range(len(t)), key=lambda i: t[i:])
    t = bytes(rnd.randrange(256) for _ in range(3000)) * 2
    got = suffix_order(t, 100).tolist()
    assert sorted(got) == list(range(len(t))) and [t[i : i + 100] for i in got] == sorted(t[i : i + 100] for i in range(len(t)))


def test_equal_windows():
    rnd = random.Random(2)
    t = bytes(rnd.choice(b"ab") for _ in range(400)) * 2
    starts = np.arange(len(t) - 20 + 1)
    found = equal_windows(t, starts, 20).tolist()
    want: dict = {}
    assert all(want.setdefault(t[s : s + 20], c) == c for s, c in zip(starts.tolist(), found)) and len(set(found)) == len(want)


def test_equal_windows_share_an_anchor():
    rnd = random.Random(1)
    shared = bytes(rnd.randrange(97, 123) for _ in range(200))
    a, b = (bytes(rnd.randrange(97, 123) for _ in range(n)) for n in (333, 100))
    of, at, h = anchors([a + shared + b, b"short", b + shared])
    sets = [{(p - begin, x) for o, p, x in zip(of.tolist(), at.tolist(), h.tolist()) if o == k and begin <= p <= begin + 176} for k, begin in ((0, 333), (2, 100))]
    assert sets[0] & sets[1]


def brute(rows, length):
    texts = [(t or "").encode() for _, t in rows]
    times = Counter(t[i : i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for (d, _), t in zip(rows, texts):
        gone = bytearray(len(t))
        for i in range(len(t) - length + 1):
            if times[t[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        kept = bytes(x for x, g in zip(t, gone) if not g)
        out.append((d, len(t), sum(gone), sum(1 for i, g in enumerate(gone) if g and not (i and gone[i - 1])), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def corpus(rnd, n):
    word = lambda: "".join(rnd.choice("abcdeé") for _ in range(rnd.randint(2, 7)))
    words = [word() for _ in range(200)]
    text = lambda k: " ".join(rnd.choice(words) for _ in range(k))
    passages = [text(k) for k in (20, 45, 60, 90)]
    rows = []
    for i in range(n):
        kind = rnd.random()
        if kind < 0.2 and rows:
            rows.append((i, rnd.choice(rows)[1]))
        elif kind < 0.4 and rows and rows[-1][1]:
            t = rows[-1][1].split(" ")
            t[rnd.randrange(len(t))] = "edit"
            rows.append((i, " ".join(t)))
        else:
            rows.append((i, " ".join([text(rnd.randint(0, 60)), rnd.choice(passages), text(rnd.randint(0, 60)), rnd.choice(["", rnd.choice(passages)])])))
    rows += [(n, None), (n + 1, ""), (n + 2, "a" * 199), (n + 3, "a" * 450), (n + 4, "xy" * 300), (n + 5, "z" * 200), (3, rows[3][1]), (None, text(90)), (n + 6, text(9000))]
    return rows


def test_digest_equals_brute_force(spark):
    rnd = random.Random(11)
    rows = corpus(rnd, 120)
    docs = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, rk int").repartition(6)
    assert sorted(map(tuple, digest(docs).collect()), key=str) == brute(rows, 200)
    assert digest(docs.limit(0)).count() == 0


def test_removed_text(spark):
    same = "shared passage " * 20
    docs = spark.createDataFrame([(1, "one é " + same), (2, "two " + same)], "doc_id long, text string")
    assert {r["doc_id"]: r["text"] for r in remove_repeats(docs).collect()} == {1: "one é", 2: "two"}


def test_surroundings_by_distance():
    rnd = random.Random(6)
    word = lambda n: bytes(rnd.choice(b"ab") for _ in range(n))
    members = []
    for i in range(60):
        left, right = word(rnd.randint(0, 9)), word(rnd.randint(0, 9))
        members.append((left + b"anchor" + right, [i, 100 + i, len(left), 1000, i % 7 == 0]))
    times = Counter((near[s : s + 12], row[2] - s) for near, row in members for s in range(max(0, len(near) - 11)) if s <= row[2])
    want = set()
    for near, row in members:
        hit = set()
        for s in range(max(0, len(near) - 11)):
            if s <= row[2] and times[near[s : s + 12], row[2] - s] > 1:
                hit |= set(range(s, s + 12))
        if not row[4]:
            want |= {(row[0], row[1], 1000 + x) for x in hit}
    got = {(d, r, x) for d, r, a, b in by_distance(members, 12) for x in range(a, b)}
    assert got == want and want


def test_order_of_directly_sorted_suffixes():
    """Stretches that repeat are ordered by what follows them; the last ranking is the order, without another sort."""
    rnd = random.Random(8)
    for text in (bytes(rnd.choice(b"abc") for _ in range(600)), b"abcab" * 90 + b"b" + b"abcab" * 30, b"bab"):
        t = np.frombuffer(text, np.uint8)
        small = np.array([text[i:] < text[i + 1 :] for i in range(len(text))])
        direct = np.flatnonzero(small[1:] & ~small[:-1]) + 1
        got = direct[stretch_order(t, small, direct, 2000)].tolist()
        assert got == sorted(direct.tolist(), key=lambda i: text[i:])


def test_a_window_has_one_anchor(spark):
    """Each window lies in the surroundings of one anchor, at a distance that its bytes decide, so surroundings stay short."""
    rnd = random.Random(4)
    shared = bytes(rnd.randrange(97, 123) for _ in range(260))
    texts = [bytes(rnd.randrange(97, 123) for _ in range(700)) + shared, b"", b"short", b"ab" * 150, shared + bytes(rnd.randrange(97, 123) for _ in range(900)), b"q" * 200]
    of, at, h, first, last = anchor_windows(texts)
    seen = {}
    for k, p, x, a, b in zip(of.tolist(), at.tolist(), h.tolist(), first.tolist(), last.tolist()):
        assert a <= p <= a + 136 and b <= p <= b + 136
        for s in range(a, b + 1):
            assert (k, s) not in seen
            seen[k, s] = (p - s, x)
    assert set(seen) == {(k, s) for k, t in enumerate(texts) for s in range(len(t) - 199)}
    by_window: dict = {}
    assert all(by_window.setdefault(texts[k][s : s + 200], found) == found for (k, s), found in seen.items())
    places = packed(at, first, last).tolist()
    assert [unpacked(x) for x in places] == list(zip(at.tolist(), first.tolist(), last.tolist()))
    rows = spark.createDataFrame([(0, texts[0].decode(), 0, [x for x, k in zip(places, of.tolist()) if k == 0])], "doc_id long, text string, rk long, at array<long>")
    near = [r["near"] for r in surroundings(rows, 200).collect()]
    assert sum(len(x) - 199 for x in near) == len(texts[0]) - 199
