import numpy as np
import pytest

from tessera.llm import ranges
from tessera.llm.token_store import default_ranks, encoding, feistel, ids_of, read_from, record_at, records, write_shards

pytest.importorskip("tiktoken")


def test_feistel_is_a_permutation():
    for n in (1, 2, 3, 5, 64, 1000, 4097):
        for key in (1, 2):
            assert sorted(feistel(np.arange(n), n, key).tolist()) == list(range(n))
    assert feistel(np.arange(1000), 1000, 1).tolist() != feistel(np.arange(1000), 1000, 2).tolist()


def corpus(spark):
    rows = [(i, f"text number {i} " * (i % 90)) for i in range(150)] + [(200, None), (None, "null id"), (3, "text number 3 " * 3), (201, "long é " * 20_000)]
    return rows, spark.createDataFrame([(*r, "s") for r in rows], "doc_id long, text string, slot string")


def test_shard_files_are_read_by_arithmetic(spark, tmp_path):
    rows, docs = corpus(spark)
    found = records(docs.repartition(4), default_ranks(), length=64, per_shard=100)
    out = sorted(found.collect(), key=lambda r: r["slot"])
    n, size = len(out), 4 + 2 * 64 + 1
    assert [r["slot"] for r in out] == list(range(n)) and all(r["shard"] == r["slot"] // 100 and len(r["record"]) == size and r["at"] == r["slot"] % 100 * size for r in out)
    write_shards(found, f"{tmp_path}/shards")
    for s in range(-(-n // 100)):  # one file a shard, of records and nothing else
        (file,) = (tmp_path / "shards" / f"shard={s}").glob("part-*")
        assert file.read_bytes() == b"".join(bytes(r["record"]) for r in out[100 * s : 100 * (s + 1)])
        with file.open("rb") as f:
            k = min(37, file.stat().st_size // size - 1)
            f.seek(k * size)
            assert f.read(size) == bytes(out[100 * s + k]["record"])
    assert record_at(spark, f"{tmp_path}/shards", 130, 64, 100) == bytes(out[130]["record"])
    assert [(r["slot"], r["record"]) for r in read_from(spark, f"{tmp_path}/shards", 130, 64, 100).collect()] == [(r["slot"], r["record"]) for r in out[130:]]
    encoder, end = encoding(default_ranks())
    got: dict = {}
    for r in sorted(out, key=lambda r: r["piece"]):
        got.setdefault(r["doc_id"], []).append(ids_of(r["record"]))
    for d, t in rows:
        if d != 3:
            assert sum(got[d], []) == [*(encoder.encode_ordinary(t) if t else []), end]
    assert records(docs.limit(0), default_ranks()).count() == 0


def test_slots_against_brute_force_under_any_splits(spark, monkeypatch):
    """Each sequence's slot is the permuted rank of (id, text, piece), however the input and the ranges are split."""
    rows, docs = corpus(spark)
    encoder, end = encoding(default_ranks())
    ranked = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, (r[1] or "").encode()))
    cut = []
    for d, t in ranked:
        ids = [*(encoder.encode_ordinary(t) if t else []), end]
        cut += [(d, k, ids[64 * k : 64 * (k + 1)]) for k in range(-(-len(ids) // 64))]
    slots = feistel(np.arange(len(cut)), len(cut), 7).tolist()
    want = sorted((s, d, k, ids) for s, (d, k, ids) in zip(slots, cut))
    for splits, size in ((3, 32 << 20), (5, 1000), (1, 100)):
        monkeypatch.setattr(ranges, "RANGE_BYTES", size)
        found = records(docs.repartition(splits), default_ranks(), length=64, per_shard=100, permutation_key=7)
        assert sorted((r["slot"], r["doc_id"], r["piece"], ids_of(r["record"])) for r in found.collect()) == want
