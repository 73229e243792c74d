import random
import zlib

import numpy as np
import pytest

from tessera.llm import ranges
from tessera.llm.packing import TIERS, pack, sequences, steps, token_ids, windows
from tessera.llm.token_store import default_ranks

tokenizers = pytest.importorskip("tokenizers")
pytest.importorskip("tiktoken")


def library():
    import public_tokenizers

    return tokenizers.Tokenizer.from_file(str(public_tokenizers.path("byte_bpe_50k.json")))


def covered(pieces):
    """Each document's tokens, once each."""
    out: dict = {}
    for doc, start, n in pieces:
        out.setdefault(doc, []).append((start, start + n))
    for spans in out.values():
        spans.sort()
        assert spans[0][0] == 0 and all(a[1] == b[0] for a, b in zip(spans, spans[1:]))
    return {doc: spans[-1][1] for doc, spans in out.items()}


@pytest.mark.parametrize("kind", ["short", "long", "mixed", "one", "equal", "none"])
def test_windows_are_full_and_whole(kind):
    rng = random.Random(3)
    lengths = {"short": [rng.randint(1, 40) for _ in range(500)], "long": [rng.randint(1100, 2047) for _ in range(90)], "mixed": [int(10 ** rng.uniform(0, 4.2)) for _ in range(400)], "one": [1500], "equal": [1024] * 33, "none": []}[kind]
    made, left = windows(lengths, [])
    assert covered([p for w in made for p in w] + left) == dict(enumerate(lengths))
    assert all(sum(p[2] for p in w) in TIERS for w in made) and sum(p[2] for p in left) < TIERS[0]
    groups = steps(made)
    assert sorted(w for g in groups for w in g) == sorted(made)
    assert all(sum(p[2] for w in g for p in w) == 16_384 for g in groups[:-1])
    if kind == "mixed":  # most documents that fit into a window stay whole
        assert sum(len([w for w in made for p in w if p[0] == d]) > 1 for d, n in enumerate(lengths) if n <= 2048) < 0.1 * len(lengths)


def test_gaps_are_filled_from_shorter_tiers():
    made, left = windows([1500, 548, 300, 100, 112], [])
    assert sorted(sorted(w) for w in made) == [[(0, 0, 1500), (1, 0, 548)], [(2, 0, 300), (3, 0, 100), (4, 0, 112)]] and not left


def corpus(spark):
    rng = random.Random(5)
    rows = [(i, " ".join(rng.choice(["alpha", "beta", "  ", "gamma9", "Ünï", "日本"]) for _ in range(int(10 ** rng.uniform(0, 3.3))))) for i in range(120)]
    rows += [(500, None), (501, ""), (None, "no id"), (502, "a <|endoftext|> b<|endoftext|>"), (503, "long é " * 9_000), (504, "twice"), (504, "twice")]
    return rows, spark.createDataFrame([(*r, "s") for r in rows], "doc_id long, text string, tier string")


@pytest.mark.parametrize("block", [1 << 22, 3_000])
def test_pieces_against_the_library(spark, monkeypatch, block):
    rows, docs = corpus(spark)
    monkeypatch.setattr(ranges, "LEAST_BYTES", 30_000)
    found = pack(docs, default_ranks(), block=block)
    out = found.collect()
    ids = {}
    for d, t in rows:
        ids.setdefault(d, []).append([*library().encode(t or "", add_special_tokens=False).ids, 1])
    by_doc, by_sequence = {}, {}
    for r in out:
        by_doc.setdefault(r["doc_id"], []).append(r)
        by_sequence.setdefault(r["sequence_id"], []).append(r)
    assert set(by_doc) == set(ids)
    for d, own in by_doc.items():
        want = ids[d]
        assert sum(r["length"] for r in own) == sum(map(len, want))
        for r in own:
            assert r["doc_tokens"] == len(want[0]) and np.frombuffer(r["ids"], "<u4").tolist() == want[0][r["start"] : r["start"] + r["length"]]
            assert zlib.crc32(r["ids"]) == zlib.crc32(np.array(want[0][r["start"] : r["start"] + r["length"]], "<u4").tobytes())
        if len(want) == 1:
            assert covered([(0, r["start"], r["length"]) for r in own]) == {0: len(want[0])}
    padding = 0
    for own in by_sequence.values():
        own.sort(key=lambda r: r["offset"])
        n = sum(r["length"] for r in own)
        assert own[0]["offset"] == 0 and all(a["offset"] + a["length"] == b["offset"] for a, b in zip(own, own[1:])) and n <= 2048
        assert {r["tier"] for r in own} == {n if n & (n - 1) == 0 else 2048} and len({r["step"] for r in own}) == 1
        padding += own[0]["tier"] - n
    assert padding < 2048 * found.rdd.getNumPartitions()
    whole = {r["sequence_id"]: r for r in sequences(found, pad=9).collect()}
    for s, own in by_sequence.items():
        assert bytes(whole[s]["ids"]) == b"".join(r["ids"] for r in own) + b"\x09\0\0\0" * (own[0]["tier"] - whole[s]["n_tokens"])
    again = pack(docs.repartition(7), default_ranks(), block=block).collect()
    assert sorted(map(tuple, again), key=repr) == sorted(map(tuple, out), key=repr)


def test_special_strings_and_no_rows(spark):
    for t in ("", "<|endoftext|>", "x<|endoftext|><|endoftext|> y", "plain  \n text ½ é"):
        assert token_ids(t, default_ranks()).tolist() == [*library().encode(t, add_special_tokens=False).ids, 1]
    assert pack(corpus(spark)[1].limit(0), default_ranks()).count() == 0
