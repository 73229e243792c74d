"""Suffix-array dedup: removal of every byte that a repeated string of `length` bytes covers (operator 8).

Bringing repeats together. Every window of `length` bytes holds the hashes of length - GRAM + 1 grams; the leftmost
of the least of them is the window's anchor. Equal windows have equal anchors at the same place, so only anchors that
occur twice can be of repeated windows; they are found by a narrow exchange on the anchor's hash. Each such anchor's
surroundings (the windows whose anchor it is, which follow each other) then meet those of equal anchors.

Finding repeats. The surroundings of a batch of anchors are one string. Its suffixes are sorted in two stages:
those that are smaller than their successor while their predecessor is larger are sorted directly, by names of
the stretches between them and doubling; the others are induced by scans over the buckets of first bytes, first
the suffixes larger than their successors, then the rest. Adjacent common prefixes of `length` bytes, compared
byte by byte, make classes of equal windows; a window is repeated if another place is in its class. Order is exact to more than `length` bytes, which is all that is compared.

Skew: anchors and surroundings that are equal within a task are told before the exchange and go on as one
witness, so a passage of a third of all documents sends a row a task, not a row a document. Surroundings of one
anchor that all differ and are too many to sort at once are looked up window by window, at one distance at a time.

Defined cases: null reads as empty; shorter texts keep everything; equal rows are repeats of each other; windows
may overlap themselves. Removal is judged on bytes; `remove_repeats` drops the rest of a cut character.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.common import partitions
from tessera.llm.hashing import BASE, INVERSE, mixed, powers

LENGTH, GRAM = 200, 64
#: Bytes that are hashed, or sorted, at once.
HASH_BYTES, SORT_BYTES = 1 << 20, 1 << 21
#: Bytes of different surroundings of one anchor beyond which they are compared distance by distance instead of sorted.
GROUP_BYTES = 8 << 20
#: Bytes of surroundings that a task remembers to find equal ones before the exchange.
KNOWN_BYTES = 64 << 20


# --- anchors


def anchor_windows(texts: list[bytes], length: int = LENGTH, gram: int = GRAM) -> tuple[np.ndarray, ...]:
    """(text number, position, hash, first, last) of every anchor of every text; the windows that begin from first to last have it."""
    buf = np.frombuffer(b"".join(texts), np.uint8)
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    ends = np.cumsum(sizes)
    n = len(buf) - length + 1
    none = np.zeros(0, np.int64)
    if n <= 0:
        return none, none, np.zeros(0, np.uint64), none, none
    prefix = np.concatenate((np.zeros(1, np.uint64), np.cumsum((buf.astype(np.uint64) + np.uint64(1)) * powers(BASE, len(buf)))))
    h = mixed((prefix[gram:] - prefix[:-gram]) * powers(INVERSE, len(buf) + 1)[: len(buf) - gram + 1], 9)
    # one number orders grams by hash (its upper half, always so that equal windows agree), then by place
    low = np.uint64(0xFFFFFFFF)
    least = (sliding(np.minimum, (h & ~low) | np.arange(len(h), dtype=np.uint64), length - gram + 1) & low).astype(np.int64)
    windows = np.flatnonzero(np.repeat(ends, sizes)[:n] >= np.arange(n) + length)  # that lie in one text
    if not len(windows):
        return none, none, np.zeros(0, np.uint64), none, none
    least = least[windows]
    begin = np.concatenate(([0], np.flatnonzero(least[1:] != least[:-1]) + 1))
    end = np.concatenate((begin[1:], [len(windows)])) - 1
    at = least[begin]
    of = np.searchsorted(ends, at, "right")
    base = ends[of] - sizes[of]
    return of, at - base, h[at], windows[begin] - base, windows[end] - base


def anchors(texts: list[bytes], length: int = LENGTH, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text number, position, hash) of every anchor of every text."""
    return anchor_windows(texts, length, gram)[:3]


def packed(at: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """An anchor's position, how far before it its windows begin, and how far they reach, in one number."""
    return at << 32 | at - first << 16 | last - first


def unpacked(place: int) -> tuple[int, int, int]:
    """(position, first, last)"""
    first = (place >> 32) - (place >> 16 & 0xFFFF)
    return place >> 32, first, first + (place & 0xFFFF)


def sliding(pick: np.ufunc, x: np.ndarray, width: int) -> np.ndarray:
    """pick over each `width` neighbours."""
    n, size = len(x) - width + 1, 1
    while 2 * size <= width:
        x = pick(x[:-size], x[size:])
        size *= 2
    return pick(x[:n], x[width - size :][:n])


def in_parts(texts: list[bytes]) -> Iterator[tuple[int, list[bytes]]]:
    begin, total = 0, 0
    for i, t in enumerate(texts):
        total += len(t)
        if total >= HASH_BYTES or i == len(texts) - 1:
            yield begin, texts[begin : i + 1]
            begin, total = i + 1, 0


CANDIDATE, WITNESS, KNOWN = 0, 1, 2


def anchor_rows(rows: DataFrame, length: int) -> DataFrame:
    """(h, rk, pos, kind) of the anchors of (doc_id, text, rk) rows; pos is `packed`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keys = b[2].to_numpy()
            of, at, h = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)]
            for begin, part in in_parts(b[1].cast(pa.binary()).to_pylist()):
                o, p, x, first, last = anchor_windows(part, length)
                of.append(o + begin)
                at.append(packed(p, first, last))
                h.append(x)
            of, at, h = map(np.concatenate, (of, at, h))
            if not len(h):
                continue
            h = h.view(np.int64)
            _, met, inverse, times = np.unique(h, return_index=True, return_inverse=True, return_counts=True)
            again = times[inverse] > 1
            seen = met[times > 1]
            rk = keys[of]
            out = (np.concatenate((np.where(again, rk, h), h[seen])), np.concatenate((rk, rk[seen])), np.concatenate((at, at[seen])), np.concatenate((np.where(again, KNOWN, CANDIDATE), np.full(len(seen), WITNESS))))
            yield pa.RecordBatch.from_arrays([pa.array(out[0]), pa.array(out[1]), pa.array(out[2]), pa.array(out[3].astype(np.int8))], names=["h", "rk", "pos", "kind"])

    return rows.mapInArrow(run, "h long, rk long, pos long, kind byte")


def repeated_anchors(found: DataFrame) -> DataFrame:
    """(rk, pos) of the anchors whose hash occurs more than once."""

    def told(h: np.ndarray, rk: np.ndarray, pos: np.ndarray, kind: np.ndarray) -> pa.RecordBatch:
        counted = kind != KNOWN
        _, inverse = np.unique(h, return_inverse=True)
        votes = np.bincount(inverse, np.where(kind == WITNESS, 2, np.where(counted, 1, 0)))
        keep = (kind == KNOWN) | ((kind == CANDIDATE) & (votes[inverse] > 1))
        return pa.RecordBatch.from_arrays([pa.array(rk[keep]), pa.array(pos[keep])], names=["rk", "pos"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = None
        for b in batches:
            now = [c.to_numpy() for c in b.columns]
            if rest is not None:
                now = [np.concatenate(x) for x in zip(rest, now, strict=True)]
            if not len(now[0]):
                continue
            last = int(np.searchsorted(now[0], now[0][-1]))
            if last:
                yield told(*(x[:last] for x in now))
            tail = [x[last:] for x in now]
            if len(tail[0]) > 100_000:  # one very frequent hash: what is certain goes on, two witnesses stay
                if ((tail[3] != KNOWN).sum() > 1) or (tail[3] == WITNESS).any():
                    yield told(*tail)
                    tail = [x[:1] for x in tail]
                    tail[3] = np.array([WITNESS], np.int8)
            rest = tail
        if rest is not None and len(rest[0]):
            yield told(*rest)

    return found.repartition(partitions(found), "h").sortWithinPartitions("h").mapInArrow(run, "rk long, pos long")


# --- suffix sorting


def suffix_order(text: bytes, depth: int = LENGTH) -> np.ndarray:
    """Starts of all suffixes in the order of at least their first `depth` bytes."""
    t = np.frombuffer(text, np.uint8)  # bytes stay bytes: the scans below look up millions of them
    n = len(t)
    if n < 2:
        return np.arange(n)
    # a suffix is small if it is smaller than its successor; equal bytes are as the next different one decides
    change = np.flatnonzero(t[1:] != t[:-1])
    ends = np.concatenate((change, [n - 1]))
    rises = np.concatenate((t[change] < t[change + 1], [False]))
    small = np.repeat(rises, np.diff(np.concatenate(([-1], ends))))
    direct = np.flatnonzero(small[1:] & ~small[:-1]) + 1
    order = direct[stretch_order(t, small, direct, depth)] if len(direct) else direct
    # large suffixes, by an ascending scan: each bucket's own first, in rounds over runs of its byte, then the directly sorted
    waiting: list[list[np.ndarray]] = [[] for _ in range(256)]
    waiting[t[-1]].append(np.array([n - 1]))
    sorted_by = np.searchsorted(t[order], np.arange(257))
    large: list[np.ndarray] = []

    def deal(items: np.ndarray, into: list[list[np.ndarray]]) -> None:
        bytes_ = t[items]
        by = np.argsort(bytes_, kind="stable")
        where = np.searchsorted(bytes_[by], np.arange(257))
        for c in np.unique(bytes_).tolist():
            into[c].append(items[by[where[c] : where[c + 1]]])

    for c in range(256):
        now = np.concatenate(waiting[c]) if waiting[c] else np.zeros(0, np.int64)
        own = [now]
        while len(now):
            back = now[now > 0] - 1
            now = back[(t[back] == c) & ~small[back]]
            own.append(now)
        mine = np.concatenate(own)
        large.append(mine)
        scan = np.concatenate((mine, order[sorted_by[c] : sorted_by[c + 1]]))
        back = scan[scan > 0] - 1
        back = back[(t[back] > c) & ~small[back]]
        if len(back):
            deal(back, waiting)
    # small suffixes, by a descending scan over the large ones and over themselves; lists are kept from the end
    waiting = [[] for _ in range(256)]
    out: list[np.ndarray] = []
    for c in range(255, -1, -1):
        now = np.concatenate(waiting[c]) if waiting[c] else np.zeros(0, np.int64)
        own = [now]
        while len(now):
            back = now[now > 0] - 1
            now = back[(t[back] == c) & small[back]]
            own.append(now)
        mine = np.concatenate(own)
        scan = np.concatenate((mine, large[c][::-1]))
        out.append(scan)
        back = scan[scan > 0] - 1
        back = back[(t[back] < c) & small[back]]
        if len(back):
            deal(back, waiting)
    return np.concatenate(out)[::-1]


def stretch_order(t: np.ndarray, small: np.ndarray, direct: np.ndarray, depth: int) -> np.ndarray:
    """Order of the directly sorted suffixes: stretches between them get names in order, then doubling ranks rows of names."""
    coded = (2 * t.astype(np.uint16) + small).astype(">u2").tobytes()
    ends = np.concatenate((direct[1:] + 1, [len(t)]))
    stretches = [coded[a:b] for a, b in zip((2 * direct).tolist(), (2 * ends).tolist(), strict=True)]
    name = {s: i + 1 for i, s in enumerate(sorted(set(stretches)))}
    rank = np.fromiter(map(name.__getitem__, stretches), np.int64, len(stretches))
    step = 1
    while step < depth and step < len(rank):  # a stretch moves on by two bytes at least, so this is deeper than needed
        after = np.concatenate((rank[step:], np.zeros(min(step, len(rank)), np.int64)))
        key = rank * (len(rank) + 2) + after
        order = np.argsort(key)  # equal keys get one rank, in whatever order they come
        ordered = key[order]
        steps = np.cumsum(np.concatenate(([1], ordered[1:] != ordered[:-1])))
        if steps[-1] == len(rank):
            return order
        rank, step = np.empty_like(rank), 2 * step
        rank[order] = steps
    return np.argsort(rank, kind="stable")


def equal_windows(text: bytes, starts: np.ndarray, length: int) -> np.ndarray:
    """A class number for each start; equal numbers mean equal strings of `length` bytes from there."""
    wanted = np.full(len(text), -1, np.int64)
    wanted[starts] = np.arange(len(starts))
    order = wanted[suffix_order(text, length)]
    order = order[order >= 0]
    at = starts[order]
    t = np.frombuffer(text + bytes(8), np.uint8)
    eight = np.zeros(len(text) + 1, np.uint64)
    for j in range(8):
        eight |= t[j : j + len(eight)].astype(np.uint64) << np.uint64(8 * j)
    begins = eight[at]
    same = np.flatnonzero(begins[1:] == begins[:-1]) + 1
    for j in [*range(8, length - 7, 8), *([length - 8] if length % 8 else [])]:  # adjacent common prefixes, eight bytes a time
        same = same[eight[at[same] + j] == eight[at[same - 1] + j]]
    new = np.ones(len(at), bool)
    new[same] = False
    out = np.empty(len(starts), np.int64)
    out[order] = np.cumsum(new)
    return out


# --- repeated spans


def merge_spans(starts: np.ndarray, length: int) -> list[tuple[int, int]]:
    """Unions of [start, start + length) for ascending starts."""
    cut = np.flatnonzero(np.diff(starts) > length)
    a = starts[np.concatenate(([0], cut + 1))]
    b = starts[np.concatenate((cut, [len(starts) - 1]))] + length
    return list(zip(a.tolist(), b.tolist(), strict=True))


def by_distance(members: list[tuple[bytes, list]], length: int) -> list[tuple]:
    """Repeated spans of very many surroundings of one anchor: windows that have it at one distance are looked up at a time, in memory of one window a member."""
    again: dict[int, list[int]] = {}
    for distance in range(max(x[2] for _, x in members) + 1):
        seen: dict[bytes, int] = {}
        for k, (near, row) in enumerate(members):
            start = row[2] - distance
            if 0 <= start <= len(near) - length:
                first = seen.setdefault(near[start : start + length], k)
                if first != k:
                    again.setdefault(k, []).append(start)
                    again.setdefault(first, []).append(members[first][1][2] - distance)
    out = []
    for k, starts in again.items():
        doc, rk, _, first, twice = members[k][1]
        if not twice:
            out += [(doc, rk, x, y) for x, y in merge_spans(np.unique(np.array(starts)) + first, length)]
    return out


SURROUNDINGS = "h long, doc_id long, rk long, first int, place int, twice boolean, near binary, last int"


def surroundings(rows: DataFrame, length: int) -> DataFrame:
    """The bytes of the windows of the repeated anchors of (doc_id, text, rk, at) rows.

    first: where near begins in the text; place: where the anchor is in near; twice: near was met before in this
    task. Rows without near only tell that the bytes from first to last are repeated.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        met: dict[bytes, list] = {}
        held = 0

        for b in batches:
            told: list[tuple] = []
            for doc, text, rk, places in zip(b[0].to_pylist(), b[1].cast(pa.binary()).to_pylist(), b[2].to_pylist(), b[3].to_pylist(), strict=True):
                for place in places:
                    p, first, last = unpacked(place)
                    near = text[first : last + length]
                    # the anchor's place in the bytes is part of what must be equal
                    known = met.get(key := near + (p - first).to_bytes(2, "little"))
                    if known is None:
                        gram = text[p : p + GRAM]
                        met[key] = [int.from_bytes(hashlib.blake2b(gram, digest_size=8).digest(), "little", signed=True), doc, rk, first, p - first, False]
                        held += len(near) + 300
                    else:
                        if not known[5]:
                            known[5] = True
                            told.append((known[2], known[1], known[2], known[3], 0, True, None, known[3] + len(near)))
                        told.append((rk, doc, rk, first, 0, True, None, first + len(near)))
            if told:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*told, strict=True), KINDS, strict=True)], names=NAMES)
            if held > KNOWN_BYTES:
                yield from forward(met)
                held = 0
        yield from forward(met)

    return rows.mapInArrow(run, SURROUNDINGS)


KINDS = (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.bool_(), pa.binary(), pa.int32())
NAMES = ["h", "doc_id", "rk", "first", "place", "twice", "near", "last"]


def forward(met: dict[bytes, list]) -> Iterator[pa.RecordBatch]:
    rows = [(*x[:6], key[:-2], x[3] + len(key) - 2) for key, x in met.items()]
    met.clear()
    for at in range(0, len(rows), 20_000):
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows[at : at + 20_000], strict=True), KINDS, strict=True)], names=NAMES)


def repeated_spans(around: DataFrame, length: int) -> DataFrame:
    """(doc_id, rk, first, last): bytes that repeated windows cover."""

    class Sorter:
        """Groups of different surroundings of one anchor, gathered until they are worth sorting."""

        def __init__(self) -> None:
            self.groups: list[list[tuple[bytes, list]]] = []
            self.size = 0

        def add(self, group: list[tuple[bytes, list]]) -> None:
            self.groups.append(group)
            self.size += sum(len(near) for near, _ in group)

        def drain(self) -> list[tuple]:
            parts, starts, owner, owners = [], [], [], []
            base, number = 0, 0
            for members in self.groups:
                for near, row in members:
                    n = len(near) - length + 1
                    starts.append(np.arange(base, base + n))
                    owner.append(np.full(n, number))
                    owners.append((near, row, base))
                    number += 1
                    parts.append(near)
                    base += len(near)
            self.groups, self.size = [], 0
            if not parts:
                return []
            starts, owner = np.concatenate(starts), np.concatenate(owner)
            classes = equal_windows(b"".join(parts), starts, length)  # equal windows have one anchor at one distance
            again = np.bincount(classes)[classes] > 1
            out = []
            edges = np.searchsorted(owner, np.arange(number + 1))
            for k in np.unique(owner[again]).tolist():
                near, (doc, rk, _, first, twice), begin = owners[k]
                if not twice:
                    s = starts[edges[k] : edges[k + 1]][again[edges[k] : edges[k + 1]]] - begin + first
                    out += [(doc, rk, x, y) for x, y in merge_spans(s, length)]
            return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sorter, now, group = Sorter(), None, {}

        def batch(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), (pa.int64(), pa.int64(), pa.int32(), pa.int32()), strict=True)], names=["doc_id", "rk", "first", "last"])

        def close() -> list[tuple]:
            members = [(key[0], x) for key, x in group.items()]
            group.clear()
            if sum(len(near) for near, _ in members) > GROUP_BYTES:
                return by_distance(members, length)
            if len(members) > 1:
                sorter.add(members)
            return []

        for b in batches:
            out = []
            for h, doc, rk, first, place, twice, near, last in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if near is None:
                    out.append((doc, rk, first, last))
                    continue
                if h != now:
                    out += close()
                    now = h
                known = group.get((near, place))
                if known is None:
                    group[near, place] = [doc, rk, place, first, twice]
                else:
                    if not known[4]:
                        known[4] = True
                        out.append((known[0], known[1], known[3], known[3] + len(near)))
                    if not twice:
                        out.append((doc, rk, first, last))
            if sorter.size >= SORT_BYTES:
                out += sorter.drain()
            if out:
                yield batch(out)
        if out := close() + sorter.drain():
            yield batch(out)

    dealt = around.repartition(partitions(around), "h").sortWithinPartitions("h")
    return dealt.mapInArrow(run, "doc_id long, rk long, first int, last int")


def with_spans(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """(doc_id, text, rk, spans): every row and the bytes of its text to remove, as merged from, to, from, to ..."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")).withColumn("rk", F.xxhash64("doc_id", "text"))
    by_row = rows.repartition(partitions(docs), "rk")  # both joins below read this one exchange
    at = repeated_anchors(anchor_rows(rows, length)).groupBy("rk").agg(F.sort_array(F.collect_set("pos")).alias("at"))
    around = surroundings(by_row.join(at.hint("shuffle_hash"), "rk").select("doc_id", "text", "rk", "at"), length)
    # grouped and joined by rk alone, so that both sides of both joins share one partitioning; rows of other ids with an equal rk are told apart behind it
    spans = repeated_spans(around, length).filter(F.col("last") - F.col("first") >= length).groupBy("rk").agg(F.sort_array(F.collect_set(F.struct("first", "last", "doc_id"))).alias("all"))
    joined = by_row.join(spans.hint("shuffle_hash"), "rk", "left").withColumn("found", F.filter("all", lambda x: x["doc_id"].eqNullSafe(F.col("doc_id"))))
    # collected pairs are ordered by their beginnings; union them
    merged = F.aggregate(
        "found",
        F.array().cast("array<long>"),
        lambda acc, x: F.when(
            (F.size(acc) > 0) & (F.element_at(acc, -1) >= x["first"]),
            F.concat(F.slice(acc, 1, F.size(acc) - 1), F.array(F.greatest(F.element_at(acc, -1), x["last"].cast("long")))),
        ).otherwise(F.concat(acc, F.array(x["first"].cast("long"), x["last"].cast("long")))),
    )
    return joined.select("doc_id", "text", "rk", F.coalesce(merged, F.array().cast("array<long>")).alias("spans"))


def kept_bytes(text: bytes, spans: list[int]) -> bytes:
    if not spans:
        return text
    return b"".join(text[a:b] for a, b in zip([0, *spans[1::2]], [*spans[::2], len(text)], strict=True))


def digest(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts, spans = b[1].cast(pa.binary()).to_pylist(), b[3].to_pylist()
            kept = [kept_bytes(t, s) for t, s in zip(texts, spans, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [b[0], pa.array(map(len, texts), pa.int64()), pa.array([len(t) - len(k) for t, k in zip(texts, kept, strict=True)], pa.int64()), pa.array([len(s) // 2 for s in spans], pa.int64()), pa.array([hashlib.sha256(k).hexdigest() for k in kept], pa.string())],
                names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
            )

    return with_spans(docs, length).mapInArrow(run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def remove_repeats(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """doc_id, the kept text (whole characters) and the removed spans of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            kept = [kept_bytes(t, s).decode("utf-8", "ignore") for t, s in zip(b[1].cast(pa.binary()).to_pylist(), b[3].to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([b[0], pa.array(kept, pa.string()), b[3]], names=["doc_id", "text", "spans"])

    return with_spans(docs, length).mapInArrow(run, T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("spans", T.ArrayType(T.LongType()))]))
