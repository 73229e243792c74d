"""Near copies: SimHash candidates from an index of chosen recall, linked by exact resemblance (operator 3 at work).

Texts whose five-word shingle sets have a resemblance (Jaccard) of 0.8 or more are linked. 512-bit fingerprints of
such texts differ in some 78 bits, far beyond what a pigeonhole index can warrant, so the index warrants a recall
instead: partitions of the bits (one grouping of correlated bits, others drawn at random) get thresholds -1 (unused),
0 or 1 by dynamic programming, for the least estimated cost at which a pair of exactly that resemblance meets with
the recall asked for; pairs that are closer meet more often. A partition's bits grow with the logarithm of the number
of texts, so that the random pairs that a text meets in a bucket stay as many. Costs come from counts over all
fingerprints (`simhash.meeting_chances`).

Within a bucket each text proposes its nearest earlier ones within the bit limit, a few at first. Of what is proposed
for a text the nearest are verified first, by their shingle sets (as sets of 64-bit hashes), and linked; what the links
have connected by then needs no test any more; then more of the rest, then all of it. Buckets where some text had more
close ones than it proposed propose again, only between texts that are not connected yet, more in the second round, and
all in the last. There the texts bring fingerprints of 4,096 bits, whose limit follows from the sizes of the two shingle
sets (`sharp_limit`): texts of one group that are near, but below the resemblance asked for, are told apart within the
bucket, so their pairs are not sent. So no pair within the limits and between different components stays untested,
and yet a group of copies never sends or tests all its pairs.

Fingerprints are of shingle sets, as the resemblance is: a passage that stands in a text many times counts once. Sets
of a few shingles (texts of under 20 words) differ in more bits than the angle says, so that of such pairs at exactly
the least resemblance fewer than the recall asked for meet.

Texts travel as numbers of distinct texts; equal texts are one. Defined cases: null reads as empty; texts without
words are alike; repeated rows share a text; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import discard, materialize, materialize_by, partitions, sliced
from tessera.llm.components import components
from tessera.llm.hashing import mixed, shingle_hashes
from tessera.llm.simhash import PAIR_COST, ROW_COST, bit_counts, grouped_bits, majority, meeting_chances

#: Texts are hashed together up to about so many bytes: a worker holds some 60 bytes for each.
AT_ONCE = 1 << 18
#: Random texts that share a bucket with a text, about; thresholds that a partition may get.
IN_BUCKET, MOST = 32, 1
#: Close earlier texts that each text of a bucket proposes in the rounds, and of these for a text, how many are verified in turn.
ROUNDS, TURNS = (4, 64, None), (2, 12, None)
#: Fingerprint bits may differ by so many standard deviations more than expected at the least resemblance.
DEVIATIONS = 3.3
#: 64-bit words of the fingerprints of texts in crowded buckets.
SHARP = 64
#: Rows of a text that are dealt out to buckets at once, about: the index grows with the logarithm of the texts, what lies on disk of it does not.
AT_A_TIME = 16


def in_parts(texts: list[bytes]) -> Iterator[list[bytes]]:
    begin, total = 0, 0
    for i, t in enumerate(texts):
        total += len(t) + 1
        if total >= AT_ONCE or i == len(texts) - 1:
            yield texts[begin : i + 1]
            begin, total = i + 1, 0


def differing(resemblance: float) -> float:
    """Chance that a bit differs: the angle between two sets of equal size, as a share of a half turn."""
    return math.acos(2 * resemblance / (1 + resemblance)) / math.pi


def binomial(n: int) -> np.ndarray:
    k = np.arange(n + 1)
    logs = np.array([math.lgamma(x + 1) for x in range(n + 1)])
    return np.exp(logs[n] - logs[k] - logs[n - k] - n * math.log(2))


def apart(n: int, m: int, resemblance: float) -> float:
    """Chance that the majority bits of two sets of n and m differ that share as few as the resemblance allows."""
    both = min(n, m, math.ceil(resemblance / (1 + resemblance) * (n + m) - 1e-9))
    a = np.arange(both + 1)

    def ones(size: int) -> np.ndarray:  # by how many of the shared hashes have the bit
        own = np.concatenate((np.cumsum(binomial(size - both)[::-1])[::-1], [0.0]))
        return own[np.clip(size // 2 + 1 - a, 0, size - both + 1)]

    x, y = ones(n), ones(m)
    return float((binomial(both) * (x * (1 - y) + y * (1 - x))).sum())


_sizes = np.array([*range(1, 33), 40, 48, 64, 96, 128, 192, 256, 384, 512])
_limits: dict[float, np.ndarray] = {}


def sharp_limit(sizes: np.ndarray, resemblance: float) -> np.ndarray:
    """Bits of sharp fingerprints in which sets of that resemblance, the smaller one of these sizes, may differ: the most likely number at the worst larger size, and deviations as above."""
    if resemblance not in _limits:
        worst = [max(apart(n, m, resemblance) for n in range(s, s + (4 if s > 32 else 1)) for m in range(n, int(n / resemblance + 1e-9) + 1)) for s in _sizes.tolist()]
        p, bits = np.maximum.accumulate(np.array(worst)[::-1])[::-1], 64 * SHARP
        _limits[resemblance] = np.ceil(bits * p + DEVIATIONS * np.sqrt(bits * p * (1 - p))).astype(np.int64)
    return _limits[resemblance][np.searchsorted(_sizes, np.maximum(sizes, 1), "right") - 1]


def width(n: int) -> int:
    """Bits of a partition for n texts."""
    return max(8, math.ceil(math.log2(max(2, n) / IN_BUCKET)))


def gains(bits: int, differ: float) -> np.ndarray:
    """-ln of the chance to miss a pair in a partition, by threshold."""
    same = [math.comb(bits, x) * differ**x * (1 - differ) ** (bits - x) for x in range(MOST + 1)]
    return -np.log1p(-np.cumsum(same))


def offered(n: int, both: np.ndarray, differ: float, recall: float) -> list[list[int]]:
    """Partitions to choose from: half as many again as are needed at threshold 0."""
    bits, size = len(both), width(n)
    wanted = math.ceil(1.5 * -math.log(1 - recall) / gains(size, differ)[0])
    each = bits // size
    out = [p[:size] for p in grouped_bits(n, both, each)]
    seed = 1
    while len(out) < wanted:
        order = np.random.default_rng(seed).permutation(bits)
        out += [sorted(order[k * size : (k + 1) * size].tolist()) for k in range(each)]
        seed += 1
    return out[: max(wanted, 1)]


def allocate(n: int, parts: list[list[int]], chances: np.ndarray, differ: float, recall: float, units: int = 500) -> list[tuple[list[int], int]]:
    """Thresholds of least estimated cost that together miss at most 1 - recall of the pairs; dynamic programming over partitions and units of gain."""
    need = -math.log(1 - recall)
    best = np.full(units + 1, np.inf)
    best[0] = 0
    chosen = np.zeros((len(parts), units + 1), np.int8)
    came = np.zeros((len(parts), units + 1), np.int64)
    for k, part in enumerate(parts):
        gain = np.floor(gains(len(part), differ) / need * units).astype(int)
        new, take, source = best.copy(), np.full(units + 1, -1, np.int8), np.arange(units + 1)
        for x in range(MOST + 1):
            own = n * sum(math.comb(len(part), i) for i in range(x + 1)) * ROW_COST + n * n / 2 * chances[k, x] * PAIR_COST
            for used in np.flatnonzero(np.isfinite(best)).tolist():
                to = min(units, used + gain[x])
                if best[used] + own < new[to]:
                    new[to], take[to], source[to] = best[used] + own, x, used
        best, chosen[k], came[k] = new, take, source
    at, out = units if np.isfinite(best[units]) else int(np.flatnonzero(np.isfinite(best))[-1]), []
    for k in range(len(parts) - 1, -1, -1):
        if chosen[k, at] >= 0:
            out.append((parts[k], int(chosen[k, at])))
        at = int(came[k, at])
    return out


def passes(index: list[tuple[list[int], int]], most: int) -> Iterator[tuple[int, list[tuple[list[int], int]]]]:
    """(number of the first, entries): the index in parts of up to `most` rows a text, or of one entry."""
    begin, total = 0, 0
    for k, (part, t) in enumerate(index):
        rows = sum(math.comb(len(part), i) for i in range(t + 1))
        if k > begin and total + rows > most:
            yield begin, index[begin:k]
            begin, total = k, 0
        total += rows
    yield begin, index[begin:]


def buckets(distinct: DataFrame, index: list[tuple[list[int], int]], words64: int, first: int = 0) -> DataFrame:
    """(k, id, f0, f1 ...): each text under every bucket it meets others in. first: the number of the first entry of index."""
    from itertools import combinations

    bits = 64 * words64
    names = ["k", "id", *(f"f{i}" for i in range(words64))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = mixed(np.arange(1, bits + 1, dtype=np.uint64), 7)
        for b in batches:
            for at in range(0, b.num_rows, 2048):
                ids, column = b[0].slice(at, 2048), b[1].slice(at, 2048)
                words = np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(len(column), -1)
                raw = np.unpackbits(words, axis=1)
                told = [ids, *(pa.array(np.ascontiguousarray(words.view(np.int64)[:, i])) for i in range(words64))]
                for k, (part, t) in enumerate(index, first):
                    # a bucket's number: the sum of the weights of the set bits, so that a flipped bit adds or takes its weight
                    own = raw[:, part].astype(np.uint64) @ weights[part] + mixed(np.array([k], np.uint64), 11)[0]
                    step = np.where(raw[:, part] == 1, np.uint64(0) - weights[part], weights[part])
                    for flips in range(t + 1):
                        for chosen in combinations(range(len(part)), flips):
                            key = own + step[:, list(chosen)].sum(1, dtype=np.uint64) if flips else own
                            yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), *told], names=names)

    return distinct.select("id", "fp").mapInArrow(run, ", ".join(f"{n} long" for n in names))


def distances(f: np.ndarray, rows: slice) -> np.ndarray:
    out = np.zeros((len(f[rows]), len(f)), np.uint16)
    for w in range(f.shape[1]):
        out += np.bitwise_count(f[rows, w, None] ^ f[None, :, w])
    return out


def proposals(f: np.ndarray, roots: np.ndarray | None, limit: int, most: int | None, sharp: np.ndarray | None = None, resemblance: float = 0.8) -> tuple[np.ndarray, np.ndarray, np.ndarray, bool]:
    """(earlier, later, differing bits) of pairs within limit, of different roots if given: of each text the `most` nearest earlier ones; and whether any were left out.

    sharp: each text's set size and sharp fingerprint, within whose limits pairs must be too.
    """
    m = len(f)
    step = max(1, (1 << 18) // m)
    first, second, apart, more = [], [], [], False
    for at in range(0, m, step):
        d = distances(f, slice(at, at + step))
        i = np.arange(at, min(at + step, m))
        close = (d <= limit) & (np.arange(m)[None, :] < i[:, None])
        if roots is not None:
            close &= roots[i][:, None] != roots[None, :]
        if sharp is not None:
            x, y = np.nonzero(close)
            for some in range(0, len(x), 8192):
                a, b = sharp[x[some : some + 8192] + at], sharp[y[some : some + 8192]]
                smaller, larger = np.minimum(a[:, 0], b[:, 0]).astype(np.int64), np.maximum(a[:, 0], b[:, 0]).astype(np.int64)
                near = np.bitwise_count(a[:, 1:] ^ b[:, 1:]).sum(1, dtype=np.int64) <= sharp_limit(smaller, resemblance)
                near &= smaller >= resemblance * larger - 1e-9
                close[x[some : some + 8192][~near], y[some : some + 8192][~near]] = False
        many = close.sum(1)
        for r in np.flatnonzero(many > most).tolist() if most else []:
            more = True
            hit = np.flatnonzero(close[r])
            close[r] = False
            close[r, hit[np.argsort(d[r, hit], kind="stable")[:most]]] = True
        x, y = np.nonzero(close)
        first.append(y)
        second.append(x + at)
        apart.append(d[x, y].astype(np.int64))
    return np.concatenate(first), np.concatenate(second), np.concatenate(apart), more


def proposed(met: DataFrame, limit: int, words64: int, most: int | None, resemblance: float = 0.8) -> DataFrame:
    """(a, b, d, k, f0 ...): pairs and the bits in which they differ (k null), and the texts (b null) of buckets where some text had more close ones than it proposes.

    met has the columns root and sharp behind the others, or neither.
    """
    rooted = "root" in met.columns
    names = ["a", "b", "d", "k", *(f"f{i}" for i in range(words64))]

    def told(k: np.ndarray, ids: np.ndarray, f: np.ndarray, roots: np.ndarray | None, sharp: np.ndarray | None) -> Iterator[pa.RecordBatch]:
        begins = np.concatenate(([0], np.flatnonzero(k[1:] != k[:-1]) + 1, [len(k)]))
        a, b, apart, again = [], [], [], []
        for g in np.flatnonzero(np.diff(begins) > 1).tolist():
            s, e = int(begins[g]), int(begins[g + 1])
            x, y, d, more = proposals(f[s:e], None if roots is None else roots[s:e], limit, most, None if sharp is None else sharp[s:e], resemblance)
            if len(x):
                a.append(ids[s:e][x])
                b.append(ids[s:e][y])
                apart.append(d)
            if more:
                again.append(np.arange(s, e))
        if a:
            a, b = np.concatenate(a), np.concatenate(b)
            low, high = np.minimum(a, b), np.maximum(a, b)
            pairs = np.unique(np.stack((low, high, np.concatenate(apart)), 1)[low != high], axis=0)
            none = pa.nulls(len(pairs), pa.int64())
            yield pa.RecordBatch.from_arrays([*(pa.array(np.ascontiguousarray(pairs[:, i])) for i in range(3)), *[none] * (1 + words64)], names=names)
        if again:
            at = np.concatenate(again)
            none = pa.nulls(len(at), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(ids[at]), none, none, pa.array(k[at]), *(pa.array(np.ascontiguousarray(f[at, w]).view(np.int64)) for w in range(words64))], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = None
        for batch in batches:
            now = [c.to_numpy() if c.type != pa.binary() else np.frombuffer(b"".join(c.to_pylist()), np.uint64).reshape(len(c), -1) for c in batch.columns]
            if rest is not None:
                now = [np.concatenate(x) for x in zip(rest, now, strict=True)]
            if not len(now[0]):
                continue
            last = int(np.searchsorted(now[0], now[0][-1]))
            if last:
                yield from told(*parted([c[:last] for c in now]))
            rest = [c[last:] for c in now]
        if rest is not None:
            yield from told(*parted(rest))

    def parted(columns: list[np.ndarray]) -> tuple:
        f = np.stack(columns[2 : 2 + words64], 1).view(np.uint64)
        return columns[0], columns[1], f, *(columns[-2:] if rooted else (None, None))

    dealt = met.repartition(partitions(met), "k").sortWithinPartitions("k", "id")
    return dealt.mapInArrow(run, ", ".join(f"{n} long" for n in names))


def near_copies(docs: DataFrame, key: str, text: str, size: int = 5, words64: int = 8, resemblance: float = 0.8, recall: float = 0.99) -> DataFrame:
    """(key, component) of every row: the smallest key of the texts linked to its own, itself included."""

    def told(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in sliced(batches):
            texts = [t or b"" for t in b[1].cast(pa.binary()).to_pylist()]
            fps = [majority(np.unique(h), words64) for part in in_parts(texts) for h in shingle_hashes(part, size)]
            yield pa.RecordBatch.from_arrays([b[0], pa.array([hashlib.md5(t).digest() for t in texts], pa.binary()), pa.array(fps, pa.binary())], names=[key, "node", "fp"])

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in sliced(batches):
            texts = [t or b"" for t in b[1].cast(pa.binary()).to_pylist()]
            found = [np.unique(h) for part in in_parts(texts) for h in shingle_hashes(part, size)]
            sharp = [np.uint64(len(h)).tobytes() + majority(h, SHARP) if crowded else None for h, crowded in zip(found, b[2].to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([b[0], pa.array([h.tobytes() for h in found], pa.binary()), pa.array(sharp, pa.binary())], names=["id", "shingles", "sharp"])

    def verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ok = []
            for x, y in zip(b[2], b[3], strict=True):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                both = len(np.intersect1d(x, y, assume_unique=True))
                ok.append(both >= resemblance * (len(x) + len(y) - both) - 1e-9)
            yield pa.RecordBatch.from_arrays([b[0], b[1], pa.array(ok, pa.bool_())], names=["a", "b", "ok"])

    source = docs.select(key, text)
    rows = materialize(source.mapInArrow(told, f"`{key}` {source.schema[key].dataType.simpleString()}, node binary, fp binary"), "near-rows", wide=True)
    distinct = materialize(rows.groupBy("node").agg(F.min(key).alias("least"), F.first("fp").alias("fp")).withColumn("id", F.monotonically_increasing_id()), "near-texts")
    n, both = bit_counts(distinct, words64)
    differ = differing(resemblance)
    parts = offered(n, both, differ, recall)
    index = allocate(n, parts, meeting_chances(distinct, n, both, parts, MOST, words64), differ, recall)
    bits = 64 * words64
    limit = math.ceil(bits * differ + DEVIATIONS * math.sqrt(bits * differ * (1 - differ)))
    each = [materialize(proposed(buckets(distinct, some, words64, k), limit, words64, ROUNDS[0]), "near-proposed") for k, some in passes(index, AT_A_TIME)]
    first = reduce(DataFrame.union, each)
    hot = first.filter("b is null").select("k", F.col("a").alias("id"), *(f"f{i}" for i in range(words64)))
    # the shingle sets of the texts that are or may be compared
    needed = first.select(F.col("a").alias("id"), F.col("b").isNull().alias("crowded")).union(first.filter("b is not null").select("b", F.lit(False))).groupBy("id").agg(F.max("crowded").alias("crowded")).join(distinct.select("id", F.col("least").alias("__least"), F.col("node").alias("__node")), "id")
    # a key may stand before several texts, so texts are met by both; rows of equal texts are not gathered, only those of the least key
    told_by = F.unhex(F.md5(F.coalesce(text, F.lit(""))))
    texts = needed.join(source.select(F.col(key).alias("__least"), told_by.alias("__node"), F.col(text).alias("__text")), ["__least", "__node"]).groupBy("id").agg(F.first(F.coalesce("__text", F.lit(""))).alias("__text"), F.first("crowded").alias("crowded"))
    shingled = materialize_by(texts.mapInArrow(sets, "id long, shingles binary, sharp binary"), "id", "near-shingles", wide=True)
    tested = roots = None
    spent = [*each, shingled]

    def rooted(c: str) -> DataFrame:
        return roots.select(F.col("node").alias(c), F.col("root").alias(f"{c}_root"))

    for most in ROUNDS:
        found = first
        if tested is not None:
            if hot.isEmpty():
                break
            met = hot.join(roots.select(F.col("node").alias("id"), "root"), "id", "left").select("k", "id", *(f"f{i}" for i in range(words64)), F.coalesce("root", "id").alias("root"))
            met = met.join(shingled.filter("sharp is not null").select("id", "sharp"), "id").select(*met.columns, "sharp")
            found = materialize(proposed(met, limit, words64, most, resemblance), "near-proposed")
        pool = materialize(found.filter("b is not null").select("a", "b", "d").distinct(), "near-pool")
        spent += [pool] if found is first else [pool, found]
        for turn in TURNS:
            left = pool
            if tested is not None:
                fresh = pool.join(tested.select("a", "b"), ["a", "b"], "left_anti")
                apart = fresh.join(rooted("a"), "a", "left").join(rooted("b"), "b", "left").filter(F.coalesce("a_root", "a") != F.coalesce("b_root", "b"))
                left = apart.select("a", "b", "d")
            if turn:
                left = left.withColumn("nth", F.row_number().over(Window.partitionBy("b").orderBy("d", "a"))).filter(F.col("nth") <= turn)
            # written on its own, so that the sets, which lie by id, are read only for pairs that there are, and no set is dealt out but once a pair
            left = materialize(left.select("a", "b"), "near-left")
            spent.append(left)
            if tested is not None and left.isEmpty():
                break
            joined = left.join(shingled.select(F.col("id").alias("a"), F.col("shingles").alias("x")), "a").join(shingled.select(F.col("id").alias("b"), F.col("shingles").alias("y")), "b").select("a", "b", "x", "y")
            now = materialize(joined.mapInArrow(verified, "a long, b long, ok boolean"), "near-tested", wide=True)
            spent.append(now)
            tested = now if tested is None else tested.unionByName(now)
            if roots is None or not now.filter("ok").isEmpty():
                roots = components(tested.filter("ok").select("a", "b"))
    # roots are numbers of texts; a component is named by the smallest key of its texts
    least = roots.join(distinct.select(F.col("id").alias("node"), "least"), "node").groupBy("root").agg(F.min("least").alias("component"))
    moved = roots.join(least, "root").select(F.col("node").alias("id"), "component")
    classes = materialize(distinct.select("id", "node", "least").join(moved, "id", "left").select("node", F.coalesce("component", "least").alias("component")), "near-classes")
    discard(*spent, distinct)
    return rows.join(classes, "node").select(key, "component")
