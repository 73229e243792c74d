"""SimHash near-dedup with a generalised pigeonhole index (operator 3).

Fingerprint: words are [^\\x20\\x09-\\x0D]+ after A-Z became a-z; each shingle of `size` words (repeats count; a
text of fewer words is one shingle) is hashed with XXH64 (seed 42); a bit is 1 if it is in over half the hashes.
Fingerprints of more than 64 bits mix each hash again for every further 64 bits.

Search: the bits are grouped into m partitions, correlated bits together, from the co-occurrence of the bits in
all fingerprints. Thresholds t_i of the partitions with sum(t_i + 1) = distance + 1 find every pair within
`distance` bits: some partition must differ in at most t_i bits. Dynamic programming chooses the t_i, which may
be unequal or -1 (unused), for the least estimated probe and candidate cost; the cost also chooses m. Candidates
are estimated from pairs of the fingerprints themselves, as correlated bits meet more often than independent ones. Each
distinct fingerprint goes to its own value and to the values up to t_i bits away in each partition; fingerprints
that meet are verified. Within a bucket only a spanning forest of the links is kept, never all pairs.
Components run over distinct fingerprints, so that a group of equal fingerprints is one node however large.

Defined cases: null reads as empty; texts without words have fingerprint zero and link like any other; repeated
rows share a fingerprint; an empty table gives an empty result; a null doc_id is never a component's id unless
the component has no other.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import materialize, partitions
from tessera.llm.components import components
from tessera.llm.hashing import FOLD, mixed

#: Relative costs of a row that is dealt out and of a pair that is compared.
ROW_COST, PAIR_COST = 1.0, 0.005


def fingerprint(text: bytes, size: int, words64: int = 1) -> bytes:
    """Big-endian fingerprint of 8 * words64 bytes."""
    from xxhash import xxh64_intdigest

    words = text.translate(FOLD).split(b" ")
    if b"" in words:
        words = [w for w in words if w]
    if not words:
        return bytes(8 * words64)
    n = max(1, len(words) - size + 1)
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = np.concatenate(([0], ends[:-1]))[:n].tolist()
    ends = (ends[min(size, len(words)) - 1 :] - 1).tolist()
    return majority(np.fromiter((xxh64_intdigest(joined[a:b], 42) for a, b in zip(starts, ends, strict=True)), np.uint64, n), words64)


def majority(h: np.ndarray, words64: int) -> bytes:
    """The bits that are in over half the hashes; each further 64 bits from the hashes mixed again."""
    out = []
    for k in range(words64):
        g = mixed(h, k) if k else h
        ones = np.zeros(64, np.int64)
        for at in range(0, len(g), 8160):
            bits = np.unpackbits(g[at : at + 8160].astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
            full = len(bits) // 255 * 255  # counts of 255 rows fit in a byte
            ones += bits[:full].reshape(-1, 255, 64).sum(1, dtype=np.uint8).sum(0, dtype=np.int64) + bits[full:].sum(0, dtype=np.uint8)
        out.append(np.packbits(2 * ones > len(g)).tobytes())
    return b"".join(out)


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text", size: int = 3, words64: int = 1) -> DataFrame:
    """(key, fp binary) of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = [fingerprint(t or b"", size, words64) for t in b[1].cast(pa.binary()).to_pylist()]
            yield pa.RecordBatch.from_arrays([b[0], pa.array(fps, pa.binary())], names=[key, "fp"])

    rows = docs.select(key, text)
    return rows.mapInArrow(run, f"`{key}` {rows.schema[key].dataType.simpleString()}, fp binary")


def matrix(column: pa.Array, words64: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), ">u8").astype(np.uint64).reshape(-1, words64)


def bit_counts(distinct: DataFrame, words64: int) -> tuple[int, np.ndarray]:
    """How many fingerprints there are, and how many have each two bits; summed where the fingerprints lie, a row of the table a bit."""
    bits = 64 * words64

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, both = 0, np.zeros((bits, bits))
        for b in batches:
            for at in range(0, b.num_rows, 4096):
                x = np.unpackbits(np.frombuffer(b"".join(b[0].slice(at, 4096).to_pylist()), np.uint8).reshape(-1, bits // 8), axis=1).astype(np.float32)
                both += x.T @ x
                n += len(x)
        if n:
            rows = [r.tobytes() for r in np.concatenate((both, np.full((1, bits), float(n))))]
            yield pa.RecordBatch.from_arrays([pa.array(range(bits + 1), pa.int32()), pa.array(rows, pa.binary())], names=["bit", "counts"])

    def add(pdf):
        total = sum(np.frombuffer(x) for x in pdf["counts"])
        return pdf.iloc[:1].assign(counts=[total.tobytes()])

    rows = distinct.select("fp").mapInArrow(count, "bit int, counts binary").groupBy("bit").applyInPandas(add, "bit int, counts binary").collect()
    table = np.zeros((bits + 1, bits))
    for r in rows:
        table[r["bit"]] = np.frombuffer(r["counts"])
    return int(table[bits, 0]), table[:bits]


def grouped_bits(n: int, both: np.ndarray, m: int) -> list[list[int]]:
    """m partitions of nearly equal size; each grows by the bit that is most correlated with those it has."""
    bits = len(both)
    p = np.diag(both) / max(n, 1)
    sd = np.sqrt(np.maximum(p * (1 - p), 1e-9))
    near = np.abs((both / max(n, 1) - np.outer(p, p)) / np.outer(sd, sd))
    np.fill_diagonal(near, 0)
    left, out = set(range(bits)), []
    for k in range(m):
        want = bits // m + (k < bits % m)
        rest = sorted(left)
        part = [max(rest, key=lambda b: (near[b, rest].sum(), -b))]
        left.remove(part[0])
        while len(part) < want:
            rest = sorted(left)
            nxt = rest[int(np.argmax(near[np.ix_(part, rest)].sum(0)))]
            part.append(nxt)
            left.remove(nxt)
        out.append(sorted(part))
    return out


def independent(n: int, both: np.ndarray, part: list[int], upto: int) -> np.ndarray:
    """Chance that two fingerprints differ in at most 0, 1 ... upto bits of a partition, were its bits independent."""
    p = np.diag(both) / max(n, 1)
    differ = 2 * p * (1 - p)
    chance = np.zeros(upto + 2)
    chance[0] = 1
    for b in part:
        chance[1:] = chance[1:] * (1 - differ[b]) + chance[:-1] * differ[b]
        chance[0] *= 1 - differ[b]
    return np.cumsum(chance)[: upto + 1]


#: Fingerprints that are compared with each other to estimate candidates: all within each block of so many.
BLOCK = 256


def meeting_chances(distinct: DataFrame, n: int, both: np.ndarray, parts: list[list[int]], upto: int, words64: int) -> np.ndarray:
    """(partition, x): share of pairs of fingerprints that differ in at most x bits of it.

    Counted over pairs of all fingerprints, block by block where they lie; where too few pairs met to tell, the share
    for independent bits, which is less than what correlated bits would give.
    """
    bits = 64 * words64

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        met, pairs = np.zeros((len(parts), upto + 1), np.int64), 0
        weight = np.uint64(1) << np.arange(64, dtype=np.uint64)
        for b in batches:
            for at in range(0, b.num_rows, BLOCK):
                column = b[0].slice(at, BLOCK)
                raw = np.unpackbits(np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, bits // 8), axis=1).astype(np.uint64)
                i, j = np.triu_indices(len(raw), 1)
                pairs += len(i)
                for k, part in enumerate(parts):
                    v = raw[:, part] @ weight[: len(part)]
                    d = np.bitwise_count(v[i] ^ v[j])
                    met[k] += [(d <= x).sum() for x in range(upto + 1)]
        rows = [(k, x, int(met[k, x])) for k in range(len(parts)) for x in range(upto + 1)] + [(-1, 0, pairs)]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.int32(), pa.int32(), pa.int64()), strict=True)], names=["part", "x", "met"])

    found = {(r["part"], r["x"]): r["met"] for r in distinct.select("fp").mapInArrow(count, "part int, x int, met long").groupBy("part", "x").agg(F.sum("met").alias("met")).collect()}
    pairs = max(1, found.get((-1, 0), 0))
    low = np.array([independent(n, both, p, upto) for p in parts])
    return np.maximum(low, np.array([[found.get((k, x), 0) / pairs for x in range(upto + 1)] for k in range(len(parts))]))


def thresholds(n: int, chances: np.ndarray, parts: list[list[int]], distance: int) -> tuple[float, list[int]]:
    """The allocation of least estimated cost with sum(t + 1) = distance + 1, by dynamic programming over partitions."""
    best: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
    for part, chance in zip(parts, chances, strict=True):
        new: dict[int, tuple[float, list[int]]] = {}
        for used, (cost, t) in best.items():
            for x in range(-1, min(distance, len(part)) + 1):
                if used + x + 1 > distance + 1:
                    break
                ball = sum(math.comb(len(part), i) for i in range(x + 1))
                own = n * ball * ROW_COST + n * n / 2 * chance[x] * PAIR_COST if x >= 0 else 0.0
                if used + x + 1 not in new or cost + own < new[used + x + 1][0]:
                    new[used + x + 1] = (cost + own, [*t, x])
        best = new
    return best.get(distance + 1, (math.inf, []))


def plan(n: int, both: np.ndarray, distance: int, chances_of: Callable[[list[list[int]]], np.ndarray]) -> list[tuple[list[int], int]]:
    """Partitions with their thresholds, of the number of partitions that costs least."""
    groups = [grouped_bits(n, both, m) for m in range(1, min(distance + 1, len(both)) + 1)]
    chances = chances_of([p for g in groups for p in g])
    options, at = [], 0
    for g in groups:
        cost, t = thresholds(n, chances[at : at + len(g)], g, distance)
        at += len(g)
        options.append((cost, [(p, x) for p, x in zip(g, t, strict=False) if x >= 0]))
    return min(options, key=lambda x: x[0])[1]


def probes(fps: DataFrame, index: list[tuple[list[int], int]], words64: int) -> DataFrame:
    """(k, fp): each fingerprint under every bucket it meets others in."""
    bits = 64 * words64

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = mixed(np.arange(1, bits + 1, dtype=np.uint64), 7)
        for b in batches:
            for at in range(0, b.num_rows, 2048):
                column = b[0].slice(at, 2048)
                raw = np.unpackbits(np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(len(column), -1)[:, : bits // 8], axis=1)
                for k, (part, t) in enumerate(index):
                    # a bucket's number: the sum of the weights of the set bits, so that a flipped bit adds or takes its weight
                    own = raw[:, part].astype(np.uint64) @ weights[part] + np.uint64(mixed(np.array([k], np.uint64), 11)[0])
                    step = np.where(raw[:, part] == 1, np.uint64(0) - weights[part], weights[part])
                    for flips in range(t + 1):
                        for chosen in combinations(range(len(part)), flips):
                            key = own + step[:, list(chosen)].sum(1, dtype=np.uint64) if flips else own
                            yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), column], names=["k", "fp"])

    return fps.select("fp").mapInArrow(run, "k long, fp binary")


def close(x: np.ndarray, y: np.ndarray, distance: int) -> np.ndarray:
    return np.bitwise_count(x ^ y).sum(-1, dtype=np.int64) <= distance


def forest(fp: np.ndarray, distance: int) -> list[tuple[int, int]]:
    """Links of a spanning forest: what is not reached yet is compared with what was reached last."""
    links, left = [], np.arange(len(fp))
    while len(left) > 1:
        root, left = int(left[0]), left[1:]
        front = np.array([root])
        while len(front) and len(left):
            now, front = front[:64], front[64:]
            hit = close(fp[now][:, None, :], fp[left][None, :, :], distance).any(0)
            if hit.any():
                links += [(root, int(i)) for i in left[hit]]
                front = np.concatenate((front, left[hit]))
                left = left[~hit]
    return links


#: Buckets up to this size are compared many at a time.
SMALL = 24


def links(met: DataFrame, distance: int, words64: int) -> DataFrame:
    """(a, b): verified links that connect all that is linked within a bucket."""

    def bucket(k: np.ndarray, fp: np.ndarray, raw: list[bytes]) -> Iterator[pa.RecordBatch]:
        begins = np.concatenate(([0], np.flatnonzero(k[1:] != k[:-1]) + 1, [len(k)]))
        sizes = np.diff(begins)
        a, b = [], []
        member = np.repeat(sizes, sizes)
        rest = np.flatnonzero((member > 1) & (member <= SMALL))
        for s in range(1, SMALL):
            rest = rest[rest + s < len(k)]
            rest = rest[k[rest] == k[rest + s]]
            if not len(rest):
                break
            hit = rest[close(fp[rest], fp[rest + s], distance)]
            a += hit.tolist()
            b += (hit + s).tolist()
        for g in np.flatnonzero(sizes > SMALL):
            for x, y in forest(fp[begins[g] : begins[g + 1]], distance):
                a.append(begins[g] + x)
                b.append(begins[g] + y)
        pairs = {(raw[x], raw[y]) for x, y in zip(a, b, strict=True) if raw[x] != raw[y]}
        if pairs:
            yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in pairs], pa.binary()), pa.array([y for _, y in pairs], pa.binary())], names=["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k, raw = np.zeros(0, np.int64), []
        for batch in batches:
            k = np.concatenate((k, batch[0].to_numpy()))
            raw += batch[1].to_pylist()
            last = int(np.searchsorted(k, k[-1])) if len(k) else 0
            if last:
                yield from bucket(k[:last], np.frombuffer(b"".join(raw[:last]), np.uint64).reshape(-1, words64), raw[:last])
                k, raw = k[last:], raw[last:]
        if len(k):
            yield from bucket(k, np.frombuffer(b"".join(raw), np.uint64).reshape(-1, words64), raw)

    return met.repartition(partitions(met), "k").sortWithinPartitions("k").mapInArrow(run, "a binary, b binary")


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", size: int = 3, words64: int = 1, distance: int = 3) -> DataFrame:
    """(key, fp, component): every row's fingerprint and the smallest key that is linked to it, itself included."""
    fps = materialize(fingerprints(docs, key, text, size, words64), "simhash")
    distinct = materialize(fps.groupBy("fp").agg(F.min(key).alias("least")), "simhash-distinct")
    n, both = bit_counts(distinct, words64)
    index = plan(n, both, distance, lambda parts: meeting_chances(distinct, n, both, parts, distance, words64))
    found = links(probes(distinct, index, words64), distance, words64)
    roots = components(found)
    # only fingerprints with links have a root other than themselves
    least = roots.join(distinct, roots["node"] == distinct["fp"]).groupBy("root").agg(F.min("least").alias("component"))
    moved = roots.join(least, "root").select(F.col("node").alias("fp"), "component")
    classes = distinct.join(moved, "fp", "left").select("fp", F.coalesce("component", "least").alias("component"))
    return fps.join(classes, "fp").select(key, "fp", "component")


def keep_one(docs: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """docs with one row (of the smallest key) of each component; columns as before. With `resemblance`, components of `near_copies`."""
    from tessera.llm.near_copies import near_copies

    # the row itself is nested meanwhile, so that no column's name can clash; equal rows are one
    tagged = docs.select(F.struct("*").alias("row"), F.struct(F.col(key).isNull().alias("none"), F.col(key).alias("key"), F.xxhash64(text).alias("hash")).alias("id"), F.col(text).alias("text"))
    found = (near_copies if "resemblance" in options else near_duplicates)(tagged, "id", "text", **options)
    kept = found.filter(F.col("component") == F.col("id")).select("id").distinct()
    # of one type with kept's, nullable as a written table's: the rows are dealt out once, for the join and for equal rows
    own = tagged.select("row", F.col("id").cast(kept.schema["id"].dataType).alias("id"))
    return own.join(kept, "id", "left_semi").dropDuplicates(["id"]).select("row.*")
