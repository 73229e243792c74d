"""Training-order materialisation of token ids (operator 10).

Documents become token ids with an end mark and are cut into sequences of at most `length` ids. A sequence's index
is its rank in the order of (doc_id, null first; text; piece): documents are dealt into ranges of doc_id, the ranges'
totals give each its first index, and a range is read in order. A keyed Feistel network permutes indices: it permutes
the next larger power of four, and walks a cycle on until it is below the number of sequences, which makes it a
permutation of exactly those. The permuted index is the sequence's slot in the training order: the same rows and key
give the same slots whatever the input's splits; another key gives another order.

Shard s holds the slots from s * per_shard on, in order, as records of one size: a 4-byte count, `length` two-byte
ids, zero-padded, and a newline. Ranges of whole shards are dealt to tasks; `write_shards` has each shard written by
one task as one raw file of these records, through Spark's commit protocol, so that a lost task leaves no part of a
file. Slot k's record begins at byte (k mod per_shard) * stride of its shard's file, so a reader resumes anywhere by
arithmetic alone (`record_at` seeks, `read_from` reads whole shards from a slot on).

Defined cases: null and empty texts are one sequence of the end mark alone; repeated rows are separate sequences;
very long texts are as many sequences as they need; an empty table gives no shards. doc_id is a number; a null one
stays null. Other columns of docs are ignored, whatever their names.
"""

from __future__ import annotations

import base64
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import materialize, partitions
from tessera.llm.hashing import mixed
from tessera.llm.ranges import even_cuts, how_many, number, place

LENGTH, PER_SHARD, KEY, ROUNDS = 512, 8192, 10, 6
#: Bytes of records that a task gets at least, if a shard is smaller.
TASK_BYTES = 16 << 20
_ready: dict = {}


def encoding(path: str):
    """The byte-level BPE whose ranks lie at path; the first id behind them marks a text's end."""
    if path not in _ready:
        import public_tokenizers
        import tiktoken

        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
        _ready[path] = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}), len(ranks)
    return _ready[path]


def default_ranks() -> str:
    import public_tokenizers

    return str(public_tokenizers.path("byte_bpe_50k.tiktoken"))


def feistel(index: np.ndarray, n: int, key: int) -> np.ndarray:
    """The keyed permutation of 0 .. n - 1 at each index."""
    half = np.uint64(max(1, (max(2, n) - 1).bit_length() + 1 >> 1))
    low = (np.uint64(1) << half) - np.uint64(1)

    def once(x: np.ndarray) -> np.ndarray:
        a, b = x >> half, x & low
        for r in range(ROUNDS):
            a, b = b, a ^ (mixed(b, key * ROUNDS + r + 1) & low)
        return a << half | b

    out = once(index.astype(np.uint64))
    while (walking := np.flatnonzero(out >= n)).size:
        out[walking] = once(out[walking])
    return out.astype(np.int64)


def stride(length: int) -> int:
    return 4 + 2 * length + 1


def token_table(docs: DataFrame, ranks: str, key: str = "doc_id", text: str = "text", length: int = LENGTH) -> DataFrame:
    """(part, before, doc_id, ids): each row's ids as two-byte numbers, and the sequences before it in its range of doc_id."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, end = encoding(ranks)
        part, before = None, 0
        for b in batches:
            ids, firsts = [], []
            for now_in, t in zip(b[0].to_pylist(), b[2].to_pylist(), strict=True):
                if now_in != part:
                    part, before = now_in, 0
                now = encoder.encode_ordinary(t) if t else []
                now.append(end)
                ids.append(np.array(now, "<u2").tobytes())
                firsts.append(before)
                before += -(-len(now) // length)
            yield pa.RecordBatch.from_arrays([b[0], pa.array(firsts, pa.int64()), b[1], pa.array(ids, pa.binary())], names=["part", "before", "doc_id", "ids"])

    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.coalesce(text, F.lit("")).alias("text"))
    cuts = even_cuts(rows, "doc_id", how_many(rows, "text"))
    dealt = rows.withColumn("part", number(cuts)(F.col("doc_id")))
    dealt = dealt.withColumn("place", place(docs.sparkSession, len(cuts) + 2)(F.col("part"))).repartition(len(cuts) + 2, "place")
    return dealt.select("part", "doc_id", "text").sortWithinPartitions("part", F.col("doc_id").asc_nulls_first(), "text").mapInArrow(run, "part int, before long, doc_id long, ids binary")


RECORDS = "slot long, task int, doc_id long, piece int, n_tokens int, ids binary"


def records(docs: DataFrame, ranks: str, key: str = "doc_id", text: str = "text", length: int = LENGTH, per_shard: int = PER_SHARD, permutation_key: int = KEY) -> DataFrame:
    """(shard, slot, at, doc_id, piece, n_tokens, record): every sequence, in order within its shard; at: byte offset in the shard's file."""
    spark = docs.sparkSession
    tokens = materialize(token_table(docs, ranks, key, text, length), "tokens")
    totals = tokens.groupBy("part").agg(F.sum(F.ceil(F.octet_length("ids") / (2 * length))).alias("n")).orderBy("part").collect()
    firsts, n = {}, 0
    for r in totals:  # one row a range of doc_id
        firsts[r["part"]] = n
        n += int(r["n"])
    size = stride(length)
    n_shards = max(1, -(-n // per_shard))
    each = max(1, min(TASK_BYTES // (per_shard * size), -(-n_shards // partitions(docs))))  # whole shards of a task
    n_tasks = -(-n_shards // each)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            ids = b[3].to_pylist()
            pieces = np.array([-(-len(x) // (2 * length)) for x in ids])
            of = np.repeat(np.arange(len(ids)), pieces)
            piece = np.arange(len(of)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
            base = np.array([firsts[p] for p in b[0].to_pylist()]) + b[1].to_numpy()
            slot = feistel(base[of] + piece, n, permutation_key)
            cuts = [ids[k][2 * length * p : 2 * length * (p + 1)] for k, p in zip(of.tolist(), piece.tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(slot), pa.array((slot // (per_shard * each)).astype(np.int32)), b[2].take(pa.array(of)), pa.array(piece.astype(np.int32)), pa.array([len(c) // 2 for c in cuts], pa.int32()), pa.array(cuts, pa.binary())], names=["slot", "task", "doc_id", "piece", "n_tokens", "ids"])

    dealt = tokens.mapInArrow(cut, RECORDS).withColumn("place", place(spark, n_tasks)(F.col("task"))).repartition(n_tasks, "place").drop("place", "task").sortWithinPartitions("slot")

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, 4096):
                some = b.slice(at, 4096)
                packed = [struct.pack("<I", len(x) // 2) + x.ljust(2 * length, b"\0") + b"\n" for x in some["ids"].to_pylist()]
                slot = some["slot"].to_numpy()
                yield pa.RecordBatch.from_arrays([pa.array(slot // per_shard), some["slot"], pa.array(slot % per_shard * size), some["doc_id"], some["piece"], some["n_tokens"], pa.array(packed, pa.binary())], names=["shard", "slot", "at", "doc_id", "piece", "n_tokens", "record"])

    return dealt.mapInArrow(pack, "shard long, slot long, at long, doc_id long, piece int, n_tokens int, record binary")


def write_shards(found: DataFrame, path: str) -> None:
    """One raw file a shard, in the folder shard=s: its records one behind another in slot order, and nothing else.

    The text writer puts a newline behind each value, which is the record's last byte; it passes all other bytes as
    they are.
    """
    raw = F.substring("record", 1, F.octet_length("record") - 1).cast("string").alias("value")
    found.sortWithinPartitions("shard", "slot").select(raw, "shard").write.option("compression", "none").option("lineSep", "\n").partitionBy("shard").text(path)


def record_at(spark: SparkSession, path: str, slot: int, length: int = LENGTH, per_shard: int = PER_SHARD) -> bytes:
    """The record of a slot, by one seek in its shard's file, wherever Spark's file systems reach."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    found = jvm.org.apache.hadoop.fs.Path(f"{path}/shard={slot // per_shard}/part-*")
    files = found.getFileSystem(conf)
    stream = files.open(files.globStatus(found)[0].getPath())
    try:
        stream.seek(slot % per_shard * stride(length))
        return bytes(jvm.org.apache.commons.io.IOUtils.toByteArray(stream, stride(length)))
    finally:
        stream.close()


def read_from(spark: SparkSession, path: str, slot: int, length: int = LENGTH, per_shard: int = PER_SHARD) -> DataFrame:
    """(slot, record) from a slot on, in training order: earlier shards are not read, earlier records of its own shard are stepped over."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = stride(length)
        for b in batches:
            for shard, content in zip(b[0].to_pylist(), b[1].to_pylist(), strict=True):
                begin = max(0, slot - shard * per_shard)
                for at in range(begin, len(content) // size, 4096):
                    end = min(at + 4096, len(content) // size)
                    some = [content[k * size : (k + 1) * size] for k in range(at, end)]
                    yield pa.RecordBatch.from_arrays([pa.array(np.arange(at, end) + shard * per_shard), pa.array(some, pa.binary())], names=["slot", "record"])

    files = spark.read.format("binaryFile").load(path).filter(F.col("shard") >= slot // per_shard)
    return files.select(F.col("shard").cast("long").alias("shard"), "content").mapInArrow(run, "slot long, record binary").orderBy("slot")


def ids_of(record: bytes) -> list[int]:
    n = struct.unpack_from("<I", record)[0]
    return np.frombuffer(record, "<u2", n, 4).tolist()
