"""Hierarchical packing of token ids into windows of several lengths (operator 11).

Documents become token ids with an end mark. Context lengths are tiers, each the double of the one before. What a
document has in whole windows of the longest tier is cut off into windows of its own; the rest is routed to the
shortest tier that holds it. Tiers are packed from the longest down: each rest opens a window of its tier, and the gap
behind it is filled from the shorter tiers, by the longest whole rest that fits, again and again; only where none fits
is one cut, and what is left of it goes back to the tier of its new length. A tier without shorter ones to fill from
fills from itself. The window that nothing can fill any more is cut into whole windows of shorter tiers, and what is
then left, less than the shortest tier, waits for the next documents. So every window is full but one a range of the
documents, which is padded to the longest tier.

Windows are dealt into step groups of equally many tokens: first of one tier each, ordered by attention cost (squares
of the pieces' lengths), so that what runs side by side costs alike; what is over of the tiers is combined from the
longest down, which fills steps exactly as every tier divides the next.

Documents are dealt by a hash of id and text into ranges by their bytes, so order is random but the same for the same
rows and number of ranges, and copies under different ids spread. A task holds `BLOCK` tokens and one document at
most. sequence_id is the range's number times 2 ** 32 plus the place in it; so is step.

Defined cases: null and empty texts are the end mark alone; repeated rows are packed each; very long texts are many
windows; an empty table gives no rows; a null doc_id stays null. Other columns are not read, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.ranges import how_many
from tessera.llm.token_store import encoding

TIERS = (256, 512, 1024, 2048)
#: Tokens of a step group, and tokens that a task holds before it packs them.
STEP, BLOCK = 16_384, 4 << 20
#: Id behind each document, and the vocabulary's special string; it stands for the id behind all ranks.
END, SPECIAL = 1, "<|endoftext|>"

Piece = tuple[int, int, int]  # document, first token, tokens


class Rests:
    """Rests of documents by length, the longest of at most so many tokens at hand."""

    def __init__(self) -> None:
        self.by, self.there = {}, 0  # there: bit n is set if there are rests of n tokens

    def put(self, piece: Piece) -> None:
        self.by.setdefault(piece[2], []).append(piece)
        self.there |= 1 << piece[2]

    def longest(self, most: int) -> int:
        return (self.there & ((2 << most) - 1)).bit_length() - 1

    def shortest(self) -> int:
        return (self.there & -self.there).bit_length() - 1

    def take(self, length: int) -> Piece:
        own = self.by[length]
        piece = own.pop()
        if not own:
            del self.by[length]
            self.there &= ~(1 << length)
        return piece


def cut(pieces: list[Piece], size: int) -> tuple[list[Piece], list[Piece]]:
    """The first `size` tokens of the pieces, and the rest."""
    first, rest = [], []
    for doc, start, n in pieces:
        now = min(n, size)
        if now:
            first.append((doc, start, now))
        if n > now:
            rest.append((doc, start + now, n - now))
        size -= now
    return first, rest


def windows(lengths: list[int], left: list[Piece], tiers: tuple[int, ...] = TIERS) -> tuple[list[list[Piece]], list[Piece]]:
    """(full windows, what is left) of documents of these lengths and what was left before; a window's length is a tier."""
    top, out, rests = tiers[-1], [], Rests()
    for doc, n in enumerate(lengths):
        out += [[(doc, start, top)] for start in range(0, n - top + 1, top)]
        if n % top:
            rests.put((doc, n - n % top, n % top))
    for piece in left:
        rests.put(piece)
    below = 0
    for tier, shorter in zip(tiers[::-1], (*tiers[-2::-1], 0)):
        while (n := rests.longest(tier)) > shorter:
            window, gap = [rests.take(n)], tier - n
            while gap and rests.there:
                if (n := rests.longest(min(gap, shorter or gap))) > 0:
                    window.append(rests.take(n))
                    gap -= n
                    continue
                # nothing whole fits: cut the shortest there is, which is of a shorter tier if any is
                (now,), (then,) = cut([rests.take(rests.shortest())], gap)
                window.append(now)
                rests.put(then)
                gap = 0
            if gap:  # nothing is left to fill it with
                for size in tiers[::-1]:
                    while sum(p[2] for p in window) >= size:
                        now, window = cut(window, size)
                        out.append(now)
                return out, window
            out.append(window)
    return out, []


def steps(made: list[list[Piece]], tiers: tuple[int, ...] = TIERS, step: int = STEP) -> list[list[list[Piece]]]:
    """The windows in step groups of `step` tokens; only the last has fewer."""
    by: dict[int, list] = {t: [] for t in tiers}
    for w in made:
        by[sum(p[2] for p in w)].append(w)
    out, over = [], []
    for tier in tiers[::-1]:
        own = sorted(by[tier], key=lambda w: sum(p[2] * p[2] for p in w))
        each = step // tier
        whole = len(own) - len(own) % each
        out += [own[at : at + each] for at in range(0, whole, each)]
        over += own[whole:]
    group, held = [], 0
    for w in over:
        group.append(w)
        held += sum(p[2] for p in w)
        if held == step:
            out.append(group)
            group, held = [], 0
    return [*out, group] if group else out


def token_ids(text: str | None, ranks: str, end: int = END, special: str = SPECIAL) -> np.ndarray:
    """The text's ids and the end mark; the special string is one id, as in the vocabulary's own library."""
    encoder, behind = encoding(ranks)
    ids: list[int] = []
    for k, part in enumerate((text or "").split(special)):
        if k:
            ids.append(behind)
        ids += encoder.encode_ordinary(part)
    ids.append(end)
    return np.array(ids, "<u4")


def pack(docs: DataFrame, ranks: str, key: str = "doc_id", text: str = "text", tiers: tuple[int, ...] = TIERS, step: int = STEP, block: int = BLOCK) -> DataFrame:
    """(doc_id, start, length, doc_tokens, sequence_id, offset, tier, step, ids): every piece; ids: little-endian 32-bit numbers.

    tier: the length to which the sequence is padded, its own but for one sequence a range.
    """
    names = ["doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "tier", "step", "ids"]
    if any(b != 2 * a for a, b in zip(tiers, tiers[1:])) or step % tiers[-1]:
        raise ValueError("each tier is the double of the one before, and a step is of whole windows")

    def told(groups: list, held: list, first: int, first_step: int, padded: int | None = None) -> Iterator[pa.RecordBatch]:
        flat = [(s, w) for s, g in enumerate(groups) for w in g]
        for at in range(0, len(flat), 1024):
            rows = []
            for k, (s, w) in enumerate(flat[at : at + 1024]):
                offset, size = 0, padded or sum(p[2] for p in w)
                for doc, start, n in w:
                    rows.append((held[doc][0], start, n, len(held[doc][1]), first + at + k, offset, size, first_step + s, held[doc][1][start : start + n].tobytes()))
                    offset += n
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (key_arrow, *[pa.int64()] * 5, pa.int32(), pa.int64(), pa.binary()))], names=names)

    rows = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text"))
    key_type = rows.schema["doc_id"].dataType
    key_arrow = pa.string() if key_type.typeName() == "string" else {"long": pa.int64(), "integer": pa.int32()}[key_type.typeName()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = first_step = TaskContext.get().partitionId() << 32
        held, left, tokens = [], [], 0  # documents; pieces of the first of them that wait

        def packed() -> Iterator[pa.RecordBatch]:
            nonlocal first, first_step, held, left, tokens
            waiting = [d for d, _, _ in left]
            made, rest = windows([0 if d in waiting else len(ids) for d, (_, ids) in enumerate(held)], left, tiers)
            groups = steps(made, tiers, step)
            yield from told(groups, held, first, first_step)
            first, first_step = first + len(made), first_step + len(groups)
            places = {d: k for k, d in enumerate(dict.fromkeys(d for d, _, _ in rest))}
            held, left, tokens = [held[d] for d in places], [(places[d], s, n) for d, s, n in rest], 0

        for b in batches:
            for doc, content in zip(b[0].to_pylist(), b[1].to_pylist(), strict=True):
                held.append((doc, token_ids(content, ranks)))
                tokens += len(held[-1][1])
                if tokens >= block:
                    yield from packed()
        yield from packed()
        if left:
            size = sum(n for _, _, n in left)
            yield from told([[left]], held, first, first_step, size if size & (size - 1) == 0 else tiers[-1])

    order = F.xxhash64("doc_id", "text")
    dealt = rows.repartition(how_many(rows, "text"), order).sortWithinPartitions(order, "doc_id", "text")
    kind = key_type.simpleString()
    return dealt.mapInArrow(run, f"doc_id {kind}, start long, length long, doc_tokens long, sequence_id long, offset long, tier int, step long, ids binary")


def sequences(pieces: DataFrame, pad: int = 0) -> DataFrame:
    """(sequence_id, tier, step, n_tokens, ids): each sequence put together and padded; at most the longest tier's pieces meet."""
    met = pieces.groupBy("sequence_id").agg(F.first("tier").alias("tier"), F.first("step").alias("step"), F.sum("length").alias("n_tokens"), F.array_sort(F.collect_list(F.struct("offset", "ids"))).alias("parts"))
    filler = F.unhex(F.repeat(F.lit(int(pad).to_bytes(4, "little").hex()), (F.col("tier") - F.col("n_tokens")).cast("int")))
    joined = F.aggregate(F.transform("parts", lambda p: p["ids"]), F.lit(b""), lambda a, x: F.concat(a, x))
    return met.select("sequence_id", "tier", "step", "n_tokens", F.concat(joined, filler).alias("ids"))
