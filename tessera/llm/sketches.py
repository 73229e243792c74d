"""Document fingerprints: bottom-k sketches of word shingle hashes (operator 7).

A sketch is the k smallest distinct 64-bit hashes of a text's shingles (five words after A-Z became a-z; words
are [^\\x20\\x09-\\x0D]+; a text of fewer words is one shingle). Sketches of parts merge to the sketch of the
whole; two sketches estimate resemblance (Jaccard) and containment, one the number of distinct shingles. A text
with at most k distinct shingles is kept exactly, and then the estimates are exact.

Hashes are computed for many texts at once: a polynomial prefix hash over the bytes gives each word's hash, and
a weighted sum of five mixed word hashes a shingle's.

Defined cases: null reads as empty; a text without words has the empty sketch, alike (1) to another empty one
and unlike (0) any other; very long texts are hashed whole; repeated rows have equal fingerprints; an empty table
gives an empty result.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.ranges import even_cuts, how_many, number, place
from tessera.llm.hashing import AT_ONCE, shingle_hashes

K, SIZE = 128, 5
def bottom(hashes: np.ndarray, k: int = K) -> np.ndarray:
    if len(hashes) > 8 * k:
        # enough of the smallest that k distinct ones are among them, unless repeats are many
        few = np.unique(np.partition(hashes, 4 * k)[: 4 * k + 1])
        if len(few) > k:
            return few[:k]
    return np.unique(hashes)[:k]


def sketches(texts: list[bytes], k: int = K, size: int = SIZE) -> list[np.ndarray]:
    out, begin, total = [], 0, 0
    for i, t in enumerate(texts):
        total += len(t) + 1
        if total >= AT_ONCE or i == len(texts) - 1:
            out += [bottom(h, k) for h in shingle_hashes(texts[begin : i + 1], size)]
            begin, total = i + 1, 0
    return out


def merge(a: np.ndarray, b: np.ndarray, k: int = K) -> np.ndarray:
    """The sketch of both texts' shingles together."""
    return np.unique(np.concatenate((a, b)))[:k]


def resemblance(a: np.ndarray, b: np.ndarray, k: int = K) -> float:
    """Estimated share of common shingles among all of both."""
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    both = np.sort(np.concatenate((a, b)))
    again = both[1:] == both[:-1]
    order = np.arange(len(both)) - np.concatenate(([0], np.cumsum(again)))  # place among the distinct
    union = min(k, int(order[-1]) + 1)
    return int((again & (order[1:] < union)).sum()) / union


def distinct_shingles(a: np.ndarray, k: int = K) -> float:
    """Estimated number of distinct shingles."""
    return float(len(a)) if len(a) < k else (k - 1) / ((float(a[-1]) + 1) / 2.0**64)


def containment(a: np.ndarray, b: np.ndarray, k: int = K) -> float:
    """Estimated share of a's shingles that b has."""
    if not len(a):
        return 1.0
    j, n = resemblance(a, b, k), distinct_shingles(a, k)
    return min(1.0, j / (1 + j) * (n + distinct_shingles(b, k)) / n)


def encoded(a: np.ndarray) -> str:
    return base64.b64encode(a.astype(">u8").tobytes()).decode()


def decoded(text: str) -> np.ndarray:
    return np.frombuffer(base64.b64decode(text), ">u8").astype(np.uint64)


def fingerprint_column(docs: DataFrame, key: str = "doc_id", text: str = "text", k: int = K, size: int = SIZE) -> DataFrame:
    """(key, fingerprint string) of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = sketches([t or b"" for t in b[1].cast(pa.binary()).to_pylist()], k, size)
            yield pa.RecordBatch.from_arrays([b[0], pa.array(map(encoded, found), pa.string())], names=[key, "fingerprint"])

    rows = docs.select(key, text)
    return rows.mapInArrow(run, f"`{key}` {rows.schema[key].dataType.simpleString()}, fingerprint string")


OUT = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def edited_likeness(docs: DataFrame, k: int = K, size: int = SIZE) -> DataFrame:
    """Fingerprints of (doc_id, text) rows and of their edited texts, whose last half comes from the next row.

    Rows are in the order of doc_id, null first, equal ids in the order of their texts; the last is followed by
    the first. One exchange brings them into ranges of doc_id, as many as their bytes ask for; the first row of each
    range also goes, as a guard, to the end of the range before. So every row meets the next one in its own task.
    Rows of one id stand in one range. doc_id must be a number; other columns of docs are ignored.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    wanted = how_many(rows, "text")
    cuts = even_cuts(rows, "doc_id", wanted)
    in_range = number(cuts)
    n_ranges = len(cuts) + 2
    # two numbers a range
    heads = sorted((r["range"], r["head"]) for r in rows.groupBy(in_range(F.col("doc_id")).alias("range")).agg(F.min("doc_id").alias("head")).collect())
    firsts = np.array([head for _, head in heads if head is not None], np.int64)
    before = np.array([heads[i - 1][0] for i, (_, head) in enumerate(heads) if head is not None], np.int32)
    before_null = heads[-1][0] if heads and heads[0][1] is None else None

    def guarded(x: pa.Array) -> pa.Array:
        """The range to whose end the first row of a range goes too; null for other rows."""
        none = x.is_null().to_numpy(zero_copy_only=False)
        ids = x.fill_null(0).to_numpy(zero_copy_only=False)
        if not len(firsts):
            return pa.array([before_null] * len(ids), pa.int32())
        at = np.minimum(np.searchsorted(firsts, ids), len(firsts) - 1)
        out = np.where(none, -1 if before_null is None else before_null, before[at])
        return pa.array(out.astype(np.int32), mask=np.where(none, before_null is None, firsts[at] != ids))

    dealt = rows.withColumns({"range": in_range(F.col("doc_id")), "guard": F.arrow_udf(guarded, "int")(F.col("doc_id"))})
    here = F.struct(F.col("range"), F.lit(False).alias("is_guard"))
    there = F.struct(F.col("guard").alias("range"), F.lit(True).alias("is_guard"))
    dealt = dealt.select("doc_id", "text", F.explode(F.when(F.col("guard").isNull(), F.array(here)).otherwise(F.array(here, there))).alias("at")).select("at.range", "at.is_guard", "doc_id", "text")
    ordered = dealt.withColumn("place", place(spark, n_ranges)(F.col("range"))).repartition(n_ranges, "place").select("range", "is_guard", "doc_id", "text").sortWithinPartitions("range", "is_guard", F.col("doc_id").asc_nulls_first(), "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[tuple] = []
        for b in batches:
            if not b.num_rows:
                continue
            texts = b[3].to_pylist()
            rows = waiting + list(zip(b[1].to_pylist(), b[2].to_pylist(), texts, sketches([t.encode() for t in texts], k, size), strict=True))
            pairs = [(x, y) for x, y in zip(rows, rows[1:], strict=False) if not x[0]]
            waiting = [] if rows[-1][0] else rows[-1:]
            for at in range(0, len(pairs), 512):
                some = pairs[at : at + 512]
                edited = []
                for x, y in some:
                    half = len(x[2]) // 2
                    edited.append((x[2][: len(x[2]) - half] + y[2][:half]).encode())
                found = sketches(edited, k, size)
                yield pa.RecordBatch.from_pydict(
                    {
                        "doc_id": pa.array([x[1] for x, _ in some], pa.int64()),
                        "n_chars": pa.array([len(x[2]) for x, _ in some], pa.int64()),
                        "edited_sha256": pa.array([hashlib.sha256(t).hexdigest() for t in edited], pa.string()),
                        "fingerprint": pa.array([encoded(x[3]) for x, _ in some], pa.string()),
                        "edited_fingerprint": pa.array(map(encoded, found), pa.string()),
                        "near_edited": pa.array([resemblance(x[3], e, k) for (x, _), e in zip(some, found, strict=True)], pa.float64()),
                        "near_next": pa.array([resemblance(x[3], y[3], k) for x, y in some], pa.float64()),
                    }
                )

    return ordered.mapInArrow(run, OUT)
