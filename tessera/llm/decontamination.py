"""Benchmark decontamination with a generalised suffix automaton (operator 4).

The normalised items become one suffix automaton over words. Each document's words run through it; the state and
the length of the longest match ending at a word say whether a window of an item (window consecutive item words,
or a whole item that is shorter) ends there, and which items hold it. A word that no item has resets the match,
so only runs of item words that are long enough for a window are stepped through.

Items of up to BLOCK_BYTES are one automaton, which is broadcast: its size is checked first. More items are cut into
blocks of about that size; the hashes of windows of items and of documents meet in an exchange of narrow rows, which
tells the blocks that a text can match at all; a text then goes to those blocks alone, where a task builds the
block's automaton from its items and streams the texts through it. Blocks that many texts ask for are dealt to
several tasks. Nothing is collected but at most BLOCK_BYTES of items.

Defined cases: null or wordless texts have no hits; wordless items have no window; repeated items all count, as
their ids do (equal ids once); a null item id reads as the empty string; no items: nothing is hit; very long texts
are matched whole; repeated rows each get their own result; extra columns may have any names.
"""

from __future__ import annotations

import math
import re
from collections.abc import Callable, Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.common import materialize, partitions, sliced
from tessera.llm.hashing import mixed, shingle_hashes

WINDOW = 10
#: UTF-8 bytes of items in one automaton; more items make blocks of about so many.
BLOCK_BYTES = 4_000_000
#: Texts that one task matches with a block; a block with more is dealt to more tasks.
TEXTS_PER_TASK = 20_000
#: A-Z become a-z; what no word holds becomes a space.
FOLD = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
WORD = re.compile(rb"[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def words_of(text: bytes) -> list[bytes]:
    return text.translate(FOLD).split()


class Automaton:
    """Suffix automaton of all items of a block, over word numbers.

    full[v]: the suffix state of v whose strings include one of `window` words (0: none). holds[u], for such a
    state u: the numbers of the different items in which its strings occur; ids: the item ids of each. whole[v]:
    (words, item) of the shorter items that are strings of v; near[v]: v or its nearest suffix state that has any; up[v]: the same, without v.
    """

    def __init__(self, items: list[tuple[str, bytes]], window: int):
        self.window, self.least, self.vocabulary = window, window, {}
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        ids: dict[bytes, list[str]] = {}  # equal items are one string of the automaton
        for item, text in items:
            ids.setdefault(b" ".join(words_of(text)), []).append(item)
        self.ids = [tuple(sorted(set(x))) for x in ids.values()]
        kept = [(k, [self.vocabulary.setdefault(w, len(self.vocabulary)) for w in text.split()]) for k, text in enumerate(ids)]
        holds: dict[int, set[int]] = {}
        for item, words in kept:
            last = 0
            for w in words:
                last = self._extend(last, w)
        self.whole: dict[int, list[tuple[int, int]]] = {}
        for item, words in kept:
            v = 0
            for w in words:
                v = self.next[v][w]
                if self.length[v] >= window:
                    holds.setdefault(v, set()).add(item)
            if words and len(words) < window:
                self.least = min(self.least, len(words))
                self.whole.setdefault(v, []).append((len(words), item))
        n = len(self.length)
        order = sorted(range(1, n), key=self.length.__getitem__)
        for v in reversed(order):  # where a string occurs, its suffixes do
            if self.length[self.link[v]] >= window and v in holds:
                holds.setdefault(self.link[v], set()).update(holds[v])
        self.full, self.near, self.up = [0] * n, [0] * n, [0] * n
        for v in order:
            u = self.link[v]
            self.full[v] = self.full[u] or (v if self.length[v] >= window else 0)
            self.up[v] = self.near[u]
            self.near[v] = v if v in self.whole else self.near[u]
        self.holds = {u: tuple(holds[u]) for u in set(self.full) if u}

    def _state(self, length: int) -> int:
        self.next.append({})
        self.link.append(0)
        self.length.append(length)
        return len(self.length) - 1

    def _of_length(self, p: int, w: int) -> int:
        """The state of p's longest string and w, made by splitting a longer state where needed."""
        q = self.next[p][w]
        if self.length[q] == self.length[p] + 1:
            return q
        v = self._state(self.length[p] + 1)
        self.next[v], self.link[v], self.link[q] = dict(self.next[q]), self.link[q], v
        while p >= 0 and self.next[p].get(w) == q:
            self.next[p][w] = v
            p = self.link[p]
        return v

    def _extend(self, last: int, w: int) -> int:
        if w in self.next[last]:
            return self._of_length(last, w)
        v, p = self._state(self.length[last] + 1), last
        while p >= 0 and w not in self.next[p]:
            self.next[p][w] = v
            p = self.link[p]
        self.link[v] = self._of_length(p, w) if p >= 0 else 0
        return v

    def match(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
        """Merged spans [from, to) of hit words, and the items whose windows occur."""
        if len(words) < self.least:
            return [], set()
        ids = np.fromiter(map(self.vocabulary.get, words, repeat(-1)), np.int64, len(words))
        known = np.flatnonzero(np.diff(np.concatenate(([0], (ids >= 0).view(np.int8), [0]))))
        starts, ends = known[::2], known[1::2]
        long = ends - starts >= self.least
        spans: list[tuple[int, int]] = []
        found: set[int] = set()
        items: set[int] = set()
        next_, link, length, full, near, window = self.next, self.link, self.length, self.full, self.near, self.window
        for a, b in zip(starts[long].tolist(), ends[long].tolist(), strict=True):
            v, size = 0, 0
            for i, w in enumerate(ids[a:b].tolist(), a + 1):
                while v and w not in next_[v]:
                    v = link[v]
                    size = length[v]
                if w in next_[v]:
                    v = next_[v][w]
                    size += 1
                if size >= window:
                    found.add(full[v])
                    spans.append((i - window, i))
                u = near[v]
                while u:
                    for words_, item in self.whole[u]:
                        if words_ <= size:
                            items.add(item)
                            spans.append((i - words_, i))
                    u = self.up[u]
        for u in found:
            items.update(self.holds[u])
        return merged(spans), {i for k in items for i in self.ids[k]}


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def as_bytes(column: pa.Array) -> list[bytes | None]:
    return column.cast(pa.binary()).to_pylist()


FOUND = [T.StructField("words", T.LongType()), T.StructField("spans", T.ArrayType(T.LongType())), T.StructField("items", T.ArrayType(T.StringType()))]


def found_batch(row: pa.Array, counts: list[int], spans: list[list[int]], items: list[list[str]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([row, pa.array(counts, pa.int64()), pa.array(spans, pa.list_(pa.int64())), pa.array(items, pa.list_(pa.string()))], names=["row", "words", "spans", "items"])


def flat(spans: list[tuple[int, int]]) -> list[int]:
    return [x for s in spans for x in s]


def matches(docs: DataFrame, benchmark: DataFrame, text: str = "text", item: str = "item_id", item_text: str = "text", window: int = WINDOW, block_bytes: int = BLOCK_BYTES, then: Callable[[pa.RecordBatch], pa.RecordBatch] | None = None, fields: T.StructType | None = None) -> DataFrame:
    """(row, words, spans, items): the row of docs, nested; its words; hit words as from, to, from, to ...; ids of items whose windows occur.

    `then`, with the fields it gives, is applied to each batch of these where it was made.
    """
    spark = docs.sparkSession
    items = benchmark.select(F.coalesce(F.col(item).cast("string"), F.lit("")).alias("id"), F.col(item_text).alias("text")).filter(F.col("text").isNotNull())
    total = items.agg(F.coalesce(F.sum(F.octet_length("text") + F.octet_length("id")), F.lit(0))).first()[0]
    nested = docs.select(F.struct("*").alias("row"), F.col(text).alias("text"))
    out = T.StructType([nested.schema["row"], *FOUND])
    if total > block_bytes:
        met = elsewhere(nested, items, math.ceil(total / block_bytes), window)
        return met.mapInArrow(lambda batches: map(then, batches), fields) if then else met
    rows = items.collect()  # block_bytes at most
    sent = spark.sparkContext.broadcast(Automaton([(r["id"], r["text"].encode()) for r in rows], window))

    place = docs.columns.index(text)  # the text is read from the row, so that it goes to Python once

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = sent.value
        for b in sliced(batches):
            counts, spans, names = [], [], []
            for t in as_bytes(b[0].field(place)):
                words = words_of(t) if t else []
                hit, ids = automaton.match(words)
                counts.append(len(words))
                spans.append(flat(hit))
                names.append(sorted(ids))
            found = found_batch(b[0], counts, spans, names)
            yield then(found) if then else found

    return nested.select("row").mapInArrow(run, fields if then else out)


def window_hashes(texts: list[bytes], lengths: list[int]) -> list[np.ndarray]:
    """The different hashes of each text's windows of these lengths."""
    plain = [t.translate(FOLD) for t in texts]
    counts = [len(t.split()) for t in plain]
    out: list[list[np.ndarray]] = [[] for _ in texts]
    for m in lengths:
        for k, h in enumerate(shingle_hashes(plain, m)):
            if counts[k] >= m:
                out[k].append(mixed(h, m + 20))
    return [np.unique(np.concatenate(x)) if x else np.zeros(0, np.uint64) for x in out]


def elsewhere(nested: DataFrame, items: DataFrame, n_blocks: int, window: int) -> DataFrame:
    """What `matches` gives, with items in blocks: a text meets only the blocks that hold one of its windows' hashes."""
    blocked = materialize(items.groupBy("text").agg(F.sort_array(F.collect_set("id")).alias("ids")).withColumn("block", F.pmod(F.xxhash64("text"), F.lit(n_blocks)).cast("int")), "items")
    folded = F.regexp_count("text", F.lit("[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+"))
    lengths = sorted(r[0] for r in blocked.select(F.least(folded, F.lit(window)).alias("m")).filter("m > 0").distinct().collect())  # `window` numbers at most

    def hashed(shorter: bool) -> Callable:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                for at in range(0, b.num_rows, 256):
                    keys, texts = b[0].slice(at, 256), as_bytes(b[1].slice(at, 256))
                    if shorter:  # an item has windows of one length only
                        found = [window_hashes([t], [min(window, len(words_of(t)))])[0] if words_of(t) else np.zeros(0, np.uint64) for t in texts]
                    else:
                        found = window_hashes(texts, lengths)
                    sizes = [len(h) for h in found]
                    yield pa.RecordBatch.from_arrays([keys.take(pa.array(np.repeat(np.arange(len(texts)), sizes))), pa.array(np.concatenate(found).view(np.int64))], names=["key", "h"])

        return run

    texts = materialize(nested.filter("text is not null").select(F.md5(F.encode("text", "UTF-8")).alias("key"), "text").dropDuplicates(["key"]), "texts")
    of_items = blocked.select("block", "text").mapInArrow(hashed(True), "key int, h long").distinct().withColumnRenamed("key", "block")
    of_texts = texts.select("key", "text").mapInArrow(hashed(False), "key string, h long")
    asked = materialize(of_texts.join(of_items, "h").select("key", "block").distinct(), "asked")
    tasks = asked.groupBy("block").agg(F.ceil(F.count(F.lit(1)) / TEXTS_PER_TASK).cast("int").alias("tasks"))  # a row a block
    asked = asked.join(tasks, "block").withColumn("task", F.pmod(F.xxhash64("key"), F.col("tasks").cast("long")).cast("int"))
    there = blocked.join(tasks, "block").select("block", F.explode(F.sequence(F.lit(0), F.col("tasks") - 1)).alias("task"), F.lit(0).alias("kind"), F.lit("").alias("key"), "text", "ids")
    here = asked.join(texts, "key").select("block", "task", F.lit(1).alias("kind"), "key", "text", F.array().cast("array<string>").alias("ids"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held, automaton = None, [], None
        for b in batches:
            keys, spans, names = [], [], []
            for block, task, kind, key, t, ids in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if (block, task) != now:
                    now, held, automaton = (block, task), [], None
                if kind == 0:
                    held += [(i, t.encode()) for i in ids]
                    continue
                automaton = automaton or Automaton(held, window)
                hit, found = automaton.match(words_of(t.encode()))
                if hit:
                    keys.append(key)
                    spans.append(flat(hit))
                    names.append(sorted(found))
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.string()), pa.array(spans, pa.list_(pa.int64())), pa.array(names, pa.list_(pa.string()))], names=["key", "spans", "items"])

    dealt = there.unionByName(here).repartition(max(n_blocks, partitions(nested)), "block", "task").sortWithinPartitions("block", "task", "kind")
    hits = dealt.mapInArrow(run, "key string, spans array<long>, items array<string>").groupBy("key").agg(F.collect_list("spans").alias("spans"), F.sort_array(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))

    def told(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            counts = [len(words_of(t)) if t else 0 for t in as_bytes(b[1])]
            spans = [flat(merged([(x, y) for s in each or [] for x, y in zip(s[::2], s[1::2], strict=True)])) for each in b[2].to_pylist()]
            yield found_batch(b[0], counts, spans, [x or [] for x in b[3].to_pylist()])

    keyed = nested.withColumn("key", F.md5(F.encode("text", "UTF-8")))
    return keyed.join(hits, "key", "left").select("row", "text", "spans", "items").mapInArrow(told, T.StructType([nested.schema["row"], *FOUND]))


def digest(found: DataFrame, key: str = "doc_id") -> DataFrame:
    """What the documents hold of the benchmark, in numbers."""
    spans = F.col("spans")
    hit = F.aggregate(F.sequence(F.lit(0), (F.size(spans) / 2).cast("int")), F.lit(0).cast("long"), lambda acc, i: acc + F.coalesce(F.get(spans, 2 * i + 1) - F.get(spans, 2 * i), F.lit(0)))
    return found.select(
        F.col("row")[key].alias(key),
        F.col("words").alias("n_words"),
        hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.size(spans) > 0).alias("contaminated"),
    )


def decontaminate(docs: DataFrame, benchmark: DataFrame, text: str = "text", n_chars: str | None = "n_chars", window: int = WINDOW, least_words: int = WINDOW, max_coverage: float = 0.5) -> DataFrame:
    """docs without their benchmark passages: spans of least_words hit words and more are cut out of the text.

    A document goes whole if hit words, those of shorter spans too (which can only be whole short items), are more
    than max_coverage of its words. Where a span is cut, n_chars (if given, and there) is counted anew.
    """
    columns, fields = docs.columns, docs.schema
    place = columns.index(text)

    def cut(found: pa.RecordBatch) -> pa.RecordBatch:
        row = found["row"]
        parts = [row.field(i) for i in range(len(columns))]
        keep, texts, changed = [], [], []
        for t, n, spans in zip(parts[place].to_pylist(), found["words"].to_pylist(), found["spans"].to_pylist(), strict=True):
            every = list(zip(spans[::2], spans[1::2], strict=True))
            spans = [(x, y) for x, y in every if y - x >= least_words]
            keep.append(sum(y - x for x, y in every) <= max_coverage * n)
            changed.append(bool(spans) and keep[-1])
            if changed[-1]:
                raw = t.encode()
                at = [m.span() for m in WORD.finditer(raw)]
                kept, last = [], 0
                for x, y in spans:
                    kept.append(raw[last : at[x][0]])
                    last = at[y - 1][1]
                t = b"".join([*kept, raw[last:]]).decode()
            texts.append(t)
        if n_chars in columns:
            k = columns.index(n_chars)
            parts[k] = pa.array([len(t) if new else n for t, n, new in zip(texts, parts[k].to_pylist(), changed, strict=True)], parts[k].type)
        parts[place] = pa.array(texts, pa.string())
        return pa.RecordBatch.from_arrays(parts, names=columns).filter(pa.array(keep, pa.bool_()))

    return matches(docs, benchmark, text, window=window, then=cut, fields=fields)
