import zlib

from pyspark.sql import functions as F

from tessera.llm import sharding
from tessera.llm.queries import op6_sharding
from tessera.llm.sharding import rendezvous, shard_records


def rows():
    out = [(i, f"text é {i}", "x", i) for i in range(3000)]
    return out + [(None, "a", "x", 0), (None, None, "y", 1), (7, "text é 7", "x", 7), (7, "other", "x", 8), (4000, "", "x", 0), (4001, "long " * 50_000, "x", 0)]


def test_query(spark, tmp_path):
    data = rows()
    spark.createDataFrame(data, "doc_id long, text string, shard string, slot long").repartition(7).write.parquet(f"{tmp_path}/documents.parquet")
    out = op6_sharding(spark, str(tmp_path)).collect()
    assert len(out) == len(data)
    want = sorted((d, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for d, t, *_ in data if d is not None)
    assert sorted((r["doc_id"], r["size"], r["text_crc32"]) for r in out if r["doc_id"] is not None) == want
    shards: dict = {}
    for r in out:
        assert r["law"] == "key" and 0 <= r["shard"] < 40 and r["grown_shard"] in (r["shard"], 40)
        shards.setdefault(r["shard"], []).append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in shards.values())
    assert len({r["shard"] for r in out if r["doc_id"] == 7}) == 1 and len({r["shard"] for r in out if r["doc_id"] is None}) == 1
    moved = sum(r["grown_shard"] == 40 for r in out)
    assert 30 < moved < 130 and max(map(len, shards.values())) < 130


def test_ranges_give_the_same_slots_without_gaps(spark, monkeypatch):
    df = spark.createDataFrame(rows(), "doc_id long, text string, shard string, slot long")
    one = {(r["doc_id"], r["text"], r["slot"]) for r in shard_records(df, "doc_id", [1.0, 1.0]).collect()}
    monkeypatch.setattr(sharding, "ROWS_PER_RANGE", 50)
    many = {(r["doc_id"], r["text"], r["slot"]) for r in shard_records(df, "doc_id", [1.0, 1.0]).collect()}
    assert one == many


def test_weights_and_removal(spark):
    df = spark.range(20_000).withColumnRenamed("id", "k")
    share = {r["s"]: r["count"] / 20_000 for r in df.select(rendezvous(F.col("k"), [1.0, 2.0, 5.0]).alias("s")).groupBy("s").count().collect()}
    assert abs(share[0] - 0.125) < 0.015 and abs(share[1] - 0.25) < 0.015 and abs(share[2] - 0.625) < 0.015
    both = df.select(rendezvous(F.col("k"), [1.0, 2.0, 5.0]).alias("a"), rendezvous(F.col("k"), [1.0, 2.0]).alias("b"))
    assert both.filter("a < 2 and a <> b").count() == 0
    assert df.select(rendezvous(F.col("k"), [3.0]).alias("s")).distinct().collect()[0]["s"] == 0


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    out = shard_records(df, "doc_id", [1.0] * 3)
    assert out.count() == 0 and out.columns == ["doc_id", "text", "shard", "slot"]


def test_free_names(spark):
    df = spark.createDataFrame([(i, f"t{i}") for i in range(200)], "doc_id long, text string").selectExpr("doc_id", "text", "1 __s", "2 __r", "3 __first", "4 __h", "5 __range", "6 s", "7 `row`", "8 `range`", "9 first", "0 h", "1 `a.b`")
    out = shard_records(df, "doc_id", [1.0] * 4, grown="more")
    assert out.columns == [*df.columns, "shard", "slot", "more"] and out.filter("__s <> 1 or h <> 0 or first <> 9").count() == 0


def test_against_plain_python(spark):
    """Shards recomputed from the hash's definition, with and without one more shard."""
    import math

    import xxhash

    def score(text, shard, weight, seed=6):
        """XXH64 chained as Spark does it: the first argument's hash seeds the second's."""
        h = 42
        for part in (text, f"{seed}:{shard}"):
            if part is not None:
                h = xxhash.xxh64_intdigest(part.encode(), h)
        return weight / -math.log(((h >> 11) + 0.5) / 2**53)

    weights = [1.0, 2.0, 0.5, 3.0]
    keys = [*range(300), -5, None]
    df = spark.createDataFrame([(k,) for k in keys], "doc_id long")
    got = {r["doc_id"]: (r["shard"], r["more"]) for r in shard_records(df, "doc_id", weights, grown="more").collect()}
    for k in keys:
        text = None if k is None else str(k)
        scores = [score(text, i, w) for i, w in enumerate([*weights, weights[-1]])]
        assert got[k] == (max(range(4), key=scores.__getitem__), max(range(5), key=scores.__getitem__))
