"""Line dedup over content-defined chunks of lines (operator 1).

A text is its lines (cut at newlines). A hash rolls over the hashes of the last WINDOW lines; where it meets a mask, a
chunk ends, so boundaries follow the content and stay where they are when lines are put in before them. Chunks have
between LEAST and MOST lines. Of each chunk of two lines or more that occurs again anywhere, equal in every byte, the
first occurrence stays (smallest doc_id, then text hash, then place) and all others go (`dedup_lines` stops here).

A boundary may lie inside the ends of a repeated passage, and a passage of a few lines may hold no whole chunk. So
`dedup_runs`, the registered query, goes on exactly: what chunks have not removed is compared by pairs of neighbouring
lines. A run of two lines or more occurs again just if each of its pairs does, so every repeated run is found, whatever
stands around it; its first occurrence stays and the lines of all others go. A line that a run's first occurrence
shares with an overlapping second one (three equal lines or more) stays.

Chunks and pairs meet as hashes first; the bytes travel only of those whose hash occurs again, and are compared. Those
that meet within a task are settled before the exchange, so a chunk that a third of all documents share sends one row a
task.

Defined cases: null stays null and has no lines; the empty text is one empty line, which stays; very long texts and
lines are cut whole; equal rows (same id and text) are one document and keep or lose the same lines; null ids come last
in order; kept lines are joined by newlines; an empty table gives an empty result. doc_id is a number; other columns of
docs are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.common import materialize, partitions

WINDOW, MASK, LEAST, MOST = 2, 1, 2, 64
PRIME, WORD = 0x9E3779B97F4A7C15, 2**64 - 1
#: Bytes of chunks that a task remembers to settle equal ones before the exchange.
KNOWN_BYTES = 64 << 20


def chunk_ends(lines: list[bytes]) -> list[int]:
    """The line behind each chunk's last."""
    from xxhash import xxh64_intdigest

    hashes = [xxh64_intdigest(line) for line in lines]
    out, begin, roll = [], 0, 0
    leaving = pow(PRIME, WINDOW, 2**64)
    for i, h in enumerate(hashes):
        roll = (roll * PRIME + h - (hashes[i - WINDOW] * leaving if i >= WINDOW else 0)) & WORD
        size = i + 1 - begin
        if size >= MOST or (size >= LEAST and ((roll * PRIME & WORD) >> 40) & MASK == 0):
            out.append(i + 1)
            begin = i + 1
    if begin < len(lines):
        out.append(len(lines))
    return out


def chunks(text: bytes) -> list[bytes]:
    lines = text.split(b"\n")
    ends = chunk_ends(lines)
    return [b"\n".join(lines[a:b]) for a, b in zip([0, *ends], ends, strict=False)]


def pairs(text: bytes) -> list[bytes]:
    """Each line with the next."""
    lines = text.split(b"\n")
    return [a + b"\n" + b for a, b in zip(lines, lines[1:], strict=False)]


def inside(text: bytes, gone: list[int] | None) -> set[int]:
    """The pairs within the chunks of these numbers."""
    if not gone:
        return set()
    ends = chunk_ends(text.split(b"\n"))
    return {i for k in gone for i in range(ends[k - 1] if k else 0, ends[k] - 1)}


def covered(lines: list[bytes], again: set[int]) -> set[int]:
    """The lines of the pairs that occurred before; of a pair that overlaps its own first occurrence only the second."""
    out = {i + 1 for i in again}
    for i in again:
        if i == 0 or i - 1 in again or not lines[i - 1] == lines[i] == lines[i + 1]:
            out.add(i)
    return out


Place = tuple  # (no id, id, text hash, number of the chunk or pair)


def settle(known: dict[bytes, Place], chunk: bytes, place: Place) -> Place | None:
    """Keep the first place of the chunk; returns the one that goes, if any."""
    old = known.get(chunk)
    if old is None or place < old:
        known[chunk] = place
        return old
    return place if place != old else None


ROWS = "h long, doc_id long, rk long, n int, chunk binary"
NAMES = ["h", "doc_id", "rk", "n", "chunk"]
KINDS = (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary())


def gone_chunks(rows: DataFrame, cut: Callable[[bytes], list[bytes]] = chunks) -> DataFrame:
    """(doc_id, rk, n): the chunks (or what else `cut` gives) that occurred before, of (doc_id, text, rk) rows; with a column `some`, of its numbers only."""

    def batch(rows: list[tuple], columns: slice = slice(5)) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), KINDS[columns], strict=True)], names=NAMES[columns])

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from xxhash import xxh64_intdigest

        known: dict[bytes, Place] = {}
        held = 0

        def forward() -> Iterator[pa.RecordBatch]:
            rows = [(xxh64_intdigest(c) - 2**63, None if p[0] else p[1], p[2], p[3], c) for c, p in known.items()]
            known.clear()
            for at in range(0, len(rows), 10_000):
                yield batch(rows[at : at + 10_000])

        for b in batches:
            lost = []
            some = [set(x) for x in b[3].to_pylist()] if len(b.columns) > 3 else [None] * len(b)
            for doc, text, rk, only in zip(b[0].to_pylist(), b[1].cast(pa.binary()).to_pylist(), b[2].to_pylist(), some, strict=True):
                for n, chunk in enumerate(cut(text)) if text is not None else ():
                    if b"\n" in chunk and (only is None or n in only):
                        size = len(known)
                        gone = settle(known, chunk, (doc is None, doc or 0, rk, n))
                        held += len(chunk) + 250 if len(known) > size else 0
                        if gone:
                            lost.append((gone[2], None if gone[0] else gone[1], gone[2], gone[3], None))
            if lost:
                yield batch(lost)
            if held > KNOWN_BYTES:
                yield from forward()
                held = 0
        yield from forward()

    def globally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[bytes, Place] = {}
        now = None
        for b in batches:
            lost = []
            for h, doc, rk, n, chunk in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if chunk is None:
                    lost.append((doc, rk, n))
                    continue
                if h != now:
                    known.clear()
                    now = h
                gone = settle(known, chunk, (doc is None, doc or 0, rk, n))
                if gone:
                    lost.append((None if gone[0] else gone[1], gone[2], gone[3]))
            if lost:
                yield batch(lost, slice(1, 4))

    met = rows.mapInArrow(local, ROWS).repartition(partitions(rows), "h").sortWithinPartitions("h")
    return met.mapInArrow(globally, "doc_id long, rk long, n int")


def met_again(rows: DataFrame, cut: Callable[[bytes], list[bytes]]) -> DataFrame:
    """(doc_id, rk, n): the chunks or pairs of (doc_id, text, rk) rows whose hash occurs more than once, first ones included; with a column `gone`, without the pairs in those chunks, which have occurred before."""

    def batch(rows: list[tuple], names: list[str]) -> pa.RecordBatch:
        kinds = {"h": pa.int64(), "doc_id": pa.int64(), "rk": pa.int64(), "n": pa.int32(), "again": pa.bool_()}
        return pa.RecordBatch.from_arrays([pa.array(c, kinds[k]) for c, k in zip(zip(*rows, strict=True), names, strict=True)], names=names)

    place = ["doc_id", "rk", "n"]

    # a hash sends one row a task; again: null for a pair that is known to occur more than once, or else whether its task has it twice
    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from xxhash import xxh64_intdigest

        names = ["h", *place, "again"]
        known: dict[int, tuple] = {}
        twice: set[int] = set()

        def forward() -> Iterator[pa.RecordBatch]:
            rows = [(h - 2**63, *p, h in twice) for h, p in known.items()]
            known.clear()
            twice.clear()
            for at in range(0, len(rows), 10_000):
                yield batch(rows[at : at + 10_000], names)

        for b in batches:
            more = []
            lost = b[3].to_pylist() if len(b.columns) > 3 else [None] * len(b)
            for doc, text, rk, gone in zip(b[0].to_pylist(), b[1].cast(pa.binary()).to_pylist(), b[2].to_pylist(), lost, strict=True):
                settled = inside(text, gone)
                for n, piece in enumerate(cut(text)) if text is not None else ():
                    if n in settled or b"\n" not in piece:
                        continue
                    h = xxh64_intdigest(piece)
                    if known.setdefault(h, (doc, rk, n)) != (doc, rk, n):
                        twice.add(h)
                        more.append((rk, doc, rk, n, None))
            if more:
                yield batch(more, names)
            if len(known) * 300 > KNOWN_BYTES:
                yield from forward()
        yield from forward()

    def globally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, first = None, None  # the last hash, and its first row as long as it is alone
        for b in batches:
            out = []
            for h, doc, rk, n, again in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if again is None:
                    out.append((doc, rk, n))
                elif h != now:
                    now, first = h, None if again else (doc, rk, n)
                    if again:
                        out.append((doc, rk, n))
                else:
                    if first:
                        out.append(first)
                        first = None
                    out.append((doc, rk, n))
            if out:
                yield batch(out, place)

    met = rows.mapInArrow(local, "h long, doc_id long, rk long, n int, again boolean").repartition(partitions(rows), "h").sortWithinPartitions("h")
    return met.mapInArrow(globally, "doc_id long, rk long, n int")


def numbered(rows: DataFrame, found: DataFrame, name: str, how: str) -> DataFrame:
    """rows with their numbers n of found, as `name`."""
    sets = found.groupBy("doc_id", "rk").agg(F.collect_set("n").alias(name)).select(F.col("doc_id").alias("__id"), F.col("rk").alias("__rk"), name)
    return rows.join(sets.hint("shuffle_hash"), (F.col("rk") == F.col("__rk")) & F.col("doc_id").eqNullSafe(F.col("__id")), how).select(*rows.columns, name)


def hashed(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").withColumn("rk", F.xxhash64("doc_id", "text"))


def batch_of(out: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True) if out else [[]] * 6, (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string()), strict=True)], names=[f.name for f in OUT])


def dedup_runs(docs: DataFrame) -> DataFrame:
    """doc_id, n_lines, n_chunks, removed_chunks, removed_lines and the kept text of every row; a chunk is a longest stretch of lines that stay, or that go."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for doc, text, gone, again in zip(b[0].to_pylist(), b[1].cast(pa.binary()).to_pylist(), b[2].to_pylist(), b[3].to_pylist(), strict=True):
                if text is None:
                    out.append((doc, 0, 0, 0, 0, None))
                    continue
                lines = text.split(b"\n")
                lost = covered(lines, inside(text, gone).union(again or ()))
                begins = [i for i in range(len(lines)) if i == 0 or (i in lost) != (i - 1 in lost)]
                kept = b"\n".join(x for i, x in enumerate(lines) if i not in lost) if lost else text
                out.append((doc, len(lines), len(begins), sum(i in lost for i in begins), len(lost), kept.decode()))
            yield batch_of(out)

    rows = hashed(docs)
    gone = materialize(gone_chunks(numbered(rows, met_again(rows, chunks), "some", "inner")), "gone-chunks")
    rest = numbered(rows, gone, "gone", "left")
    again = gone_chunks(numbered(rows, met_again(rest, pairs), "some", "inner"), pairs)
    return numbered(rest, again, "again", "left").drop("rk").mapInArrow(run, OUT)


def dedup_lines(docs: DataFrame) -> DataFrame:
    """doc_id, n_lines, n_chunks, removed_chunks, removed_lines and the kept text of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for doc, text, lost in zip(b[0].to_pylist(), b[1].cast(pa.binary()).to_pylist(), b[2].to_pylist(), strict=True):
                if text is None:
                    out.append((doc, 0, 0, 0, 0, None))
                    continue
                parts = chunks(text)
                lost = set(lost or ())
                lines = [p.count(b"\n") + 1 for p in parts]
                kept = b"\n".join(p for i, p in enumerate(parts) if i not in lost) if lost else text
                out.append((doc, sum(lines), len(parts), len(lost), sum(lines[i] for i in lost), kept.decode()))
            yield batch_of(out)

    rows = hashed(docs)
    gone = gone_chunks(numbered(rows, met_again(rows, chunks), "some", "inner"))
    return numbered(rows, gone, "gone", "left").drop("rk").mapInArrow(run, OUT)


OUT = T.StructType([T.StructField(n, T.LongType()) for n in ("doc_id", "n_lines", "n_chunks", "removed_chunks", "removed_lines")] + [T.StructField("text", T.StringType())])
