import random

import pytest

from tessera.llm import token_counts
from tessera.llm.token_counts import ChunkCounts, Transducer, chunks, count_tokens, counter, default_model, load_pieces

sentencepiece = pytest.importorskip("sentencepiece")


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=default_model())


def test_counts_equal_the_library(library):
    known = counter(default_model())
    rnd = random.Random(9)
    pieces = [p for p in known.transducer.scores if len(p) > 1]
    texts = ["", " ", "   x", "a  b", "  hello   world ", "a\nb", "▁a ▁", "<s> </s>", "\x00a", " " * 70 + "x", "a" * 300, "日本語", "ﬁ Ⅷ", "x" * 40_000]
    texts += ["".join(rnd.choice("abcdeisthr \n.,!éß1 -_=/<▁日ⅧA\t") for _ in range(rnd.randint(0, 30))) for _ in range(1500)]
    texts += ["".join(rnd.choice(pieces) for _ in range(rnd.randint(0, 8))).replace("▁", " ") for _ in range(1500)]
    for t in texts:
        assert (sum(map(known.__getitem__, chunks(t))) if t else 0) == len(library.encode(t)), t


def test_small_vocabulary_equals_the_merge_rule():
    rnd = random.Random(1)
    for _ in range(60):
        scores = {c: -99.0 for c in "ab▁"}
        for k in range(rnd.randint(1, 8)):
            scores.setdefault(rnd.choice(["", "▁"]) + "".join(rnd.choice("ab") for _ in range(rnd.randint(2, 4))), -float(rnd.randint(0, 5)))
        transducer = Transducer(scores)
        for _ in range(50):
            text = "▁" + "".join(rnd.choice("ab") for _ in range(rnd.randint(0, 12)))
            assert ChunkCounts(transducer)[text[1:]] == len(transducer.merge(text))


def test_rows(spark, library):
    rows = [(1, "Hello  world"), (1, "Hello  world"), (2, None), (3, ""), (None, "é" * 30_000)]
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, n_tokens string")
    got = sorted(map(tuple, count_tokens(docs, default_model()).collect()), key=str)
    assert got == sorted(((k, len((t or "").encode()), len(library.encode(t or ""))) for k, t in rows), key=str)
    assert count_tokens(docs.limit(0), default_model()).count() == 0


def test_long_chunks_in_segments_and_bounded_memory(library, monkeypatch):
    rnd = random.Random(3)
    letters = "".join(rnd.choice("etaoinshrdlu") for _ in range(6000))
    texts = [letters, "ab" * 3000, "e" * 5000, letters[:700] + "日本語" * 40 + letters[700:1500], "x" + letters[:2500] + " " + letters[:90]]
    scores = load_pieces(default_model())
    for segment, steps, maps in ((1024, 1_500_000, 2000), (64, 300, 5), (7, 20, 1)):
        monkeypatch.setattr(token_counts, "SEGMENT", segment)
        monkeypatch.setattr(token_counts, "MAX_STEPS", steps)
        monkeypatch.setattr(token_counts, "MAX_MAPS", maps)
        known = ChunkCounts(Transducer(scores))
        for t in texts:
            assert sum(map(known.__getitem__, chunks(t))) == len(library.encode(t))
            assert known.transducer.n_steps <= steps + 1 and len(known.transducer.maps) <= maps


def test_segments_without_a_cut_equal_the_merge_rule(monkeypatch):
    """Vocabularies that hold every pair of letters, so that only state maps part a chunk."""
    rnd = random.Random(2)
    monkeypatch.setattr(token_counts, "SEGMENT", 5)
    for _ in range(40):
        scores = {c: -99.0 for c in "ab▁"} | {x: -float(rnd.randint(0, 5)) for x in ("aa", "ab", "ba", "bb", "▁a", "▁b")}
        for _ in range(rnd.randint(0, 6)):
            scores.setdefault("".join(rnd.choice("ab") for _ in range(rnd.randint(3, 5))), -float(rnd.randint(0, 5)))
        transducer = Transducer(scores)
        for n in (60, 61, 150):
            text = "▁" + "".join(rnd.choice("ab") for _ in range(n))
            assert list(transducer.cut(text)) == [text]
            assert ChunkCounts(transducer)[text[1:]] == len(transducer.merge(text))


def test_any_keys_and_clashing_names(spark, library):
    docs = spark.createDataFrame([("b", "one two", 1, 2, "z"), (None, None, 3, 4, "z")], "doc_id string, text string, n_bytes int, n_tokens int, `a.b` string")
    got = {tuple(r) for r in count_tokens(docs, default_model()).collect()}
    assert got == {("b", 7, len(library.encode("one two"))), (None, 0, 0)}
