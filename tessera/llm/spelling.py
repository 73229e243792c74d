"""Spelling variants of words, by full neighbourhood generation (operator 12).

Words are counted first, a table of counts a task before anything is exchanged. For every word of the vocabulary all
distinct strings one edit away are generated: each deletion, each replacement and each insertion of a letter of the
observed alphabet. A string that is generated is one edit away, so that equality with a word is all that remains to
test, by a hash join of the candidates with the vocabulary.

Of the candidates of a word, some thousand, nearly none are words. Their 64-bit hashes come out of the word's prefix
hashes by array arithmetic and are looked up in a Bloom filter of the vocabulary before any string is built; what
passes is built, sent and joined as a string, so the filter has no part in the result. It has 16 to 32 bits a word and
32 MB at most, whatever the input; beyond 16 million words it lets more strings pass to the join, and loses none.
Work for one word goes block by block, so that long words take no more memory; strings of more than `LONG` letters must
pass more probes.

A word's form is its most frequent near word, if that is so much more frequent; roots follow forms by doubling jumps.

Defined cases: null and empty texts have no words; texts are read whole; a null doc_id reads as empty; repeated rows
count each; ties go to the first word in code-point order; an empty table gives no rows. Other columns are not read,
whatever their names.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import discard, materialize, partitions

LEAST_LETTERS, LEAST_COUNT, TIMES = 6, 5, 5
#: Distinct words that a task counts before it sends them on.
HELD = 200_000
#: Bits of the filter at most (32 MB), and probes for short and long strings.
MOST_BITS, LONG, PROBES, MORE_PROBES = 28, 64, 4, 20
#: Candidates that are hashed together.
AT_ONCE = 1 << 19
BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 2**64)
SALTS = [(pow(0xD1342543DE82EF95, k + 1, 2**64) | 1) for k in range(MORE_PROBES)]
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def word_counts(docs: DataFrame, key: str = "doc_id", text: str = "text", least_letters: int = LEAST_LETTERS, slip_every: int = 0) -> DataFrame:
    """(word, n) of all runs of Latin letters of at least so many; A-Z are lower-cased.

    slip_every: if that divides the crc32 of "doc_id:run", the run loses the letter at crc32 modulo its length.
    """
    run = re.compile(rb"(?:[a-z]|\xc3[\x80-\xbf]){%d,}" % least_letters)

    def sent(counts: dict) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(counts), pa.binary()).cast(pa.string()), pa.array(list(counts.values()), pa.int64())], names=["word", "n"])

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for b in batches:
            for doc, content in zip(b[0].to_pylist(), b[1].cast(pa.binary()).to_pylist(), strict=True):
                if not content:
                    continue
                found = Counter(run.findall(content.translate(LOWER)))
                if slip_every:
                    begun = zlib.crc32(f"{'' if doc is None else doc}:".encode())
                    for w in [w for w in found if zlib.crc32(w, begun) % slip_every == 0]:
                        letters, h = w.decode(), zlib.crc32(w, begun)
                        at = h % len(letters)
                        if len(letters) > least_letters:
                            counts[(letters[:at] + letters[at + 1 :]).encode()] += found[w]
                        del found[w]
                counts.update(found)
                if len(counts) > HELD:
                    yield sent(counts)
                    counts = Counter()
        yield sent(counts)

    counted_rows = docs.select(F.col(key).cast("string").alias("key"), F.col(text).alias("text")).mapInArrow(counted, "word string, n long")
    return counted_rows.groupBy("word").agg(F.sum("n").alias("n"))


def by_length(words: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(places in the batch, letters) of the words of each length; letters: a row a word, as code points."""
    texts = words.to_pylist()
    lengths = np.fromiter(map(len, texts), np.int64, len(texts))
    for n in np.unique(lengths).tolist():
        at = np.flatnonzero(lengths == n)
        yield at, np.frombuffer("".join(texts[i] for i in at.tolist()).encode("utf-32-le"), np.uint32).reshape(len(at), n).astype(np.uint64)


def powers(n: int) -> np.ndarray:
    out = np.full(n, BASE, np.uint64)
    out[:1] = 1
    return np.cumprod(out)


def probes(length: int) -> int:
    return PROBES if length <= LONG else MORE_PROBES


def passing(hashes: np.ndarray, length: int, bits: int, filled: np.ndarray) -> np.ndarray:
    """Which hashes of strings of this length the filter lets pass."""
    at = np.arange(hashes.size)
    for salt in SALTS[: probes(length)]:
        p = (hashes[at] * np.uint64(salt)) >> np.uint64(64 - bits)
        at = at[(filled[p >> np.uint64(3)] >> (p & np.uint64(7)).astype(np.uint8)) & 1 == 1]
    return at


def filter_of(vocabulary: DataFrame, n: int) -> tuple[int, np.ndarray]:
    """(log2 of the bits, bytes) of a Bloom filter; its parts are put together by Spark's bitmap aggregate."""
    bits = min(MOST_BITS, max(15, (16 * max(1, n) - 1).bit_length()))

    def positions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for _, letters in by_length(b[0]):
                h = (letters * powers(letters.shape[1])).sum(1, dtype=np.uint64)
                told = np.concatenate([(h * np.uint64(salt)) >> np.uint64(64 - bits) for salt in SALTS[: probes(letters.shape[1])]])
                yield pa.RecordBatch.from_arrays([pa.array(told.astype(np.int64))], names=["p"])

    parts = vocabulary.select("word").mapInArrow(positions, "p long").groupBy(F.expr("shiftright(p, 15)").alias("part"))
    filled = np.zeros((1 << bits) // 8, np.uint8)
    for r in parts.agg(F.bitmap_construct_agg(F.col("p") % 32_768).alias("bytes")).toLocalIterator():
        filled[r["part"] * 4096 : (r["part"] + 1) * 4096] = np.frombuffer(r["bytes"], np.uint8)
    return bits, filled


def neighbours(letters: np.ndarray, alphabet: np.ndarray) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(letters taken, length, word, place, letter, hash) of all distinct strings one edit away, in blocks.

    A string that several edits give comes once: of equal letters in a row the last is deleted, and a letter is
    inserted only where the one before differs.
    """
    m, n = letters.shape
    weight = powers(n + 1)
    terms = letters * weight[:n]
    before = np.concatenate((np.zeros((m, 1), np.uint64), np.cumsum(terms, 1, dtype=np.uint64)), 1)  # of the first i letters
    whole = before[:, -1:]
    last = np.ones((m, n), bool)
    last[:, :-1] = letters[:, :-1] != letters[:, 1:]
    w, i = np.nonzero(last)
    yield 1, n - 1, w, i, np.zeros(len(w), np.uint64), before[w, i] + (whole[w, 0] - before[w, i + 1]) * np.uint64(INVERSE)
    for taken in (1, 0):
        places = n + (taken == 0)
        if taken:
            rest = np.broadcast_to(whole, (m, n)) - terms
            never = letters
        else:
            rest = before + (whole - before) * np.uint64(BASE)
            never = np.concatenate((np.zeros((m, 1), np.uint64), letters), 1)
        some = max(1, AT_ONCE // len(alphabet))
        for at in range(0, m * places, some):
            w, i = np.divmod(np.arange(at, min(at + some, m * places)), places)
            h = rest[w, i][:, None] + alphabet[None, :] * weight[i][:, None]
            w2, a = np.nonzero(alphabet[None, :] != never[w, i][:, None])
            yield taken, n + (taken == 0), w[w2], i[w2], alphabet[a], h[w2, a]


def near_pairs(vocabulary: DataFrame, n: int) -> DataFrame:
    """(word, n, near, near_n): every two words of the vocabulary (word, n) one edit apart, both ways."""
    spark = vocabulary.sparkSession
    alphabet = np.array(sorted(ord(r["c"]) for r in vocabulary.select(F.explode(F.array_distinct(F.split("word", ""))).alias("c")).distinct().filter("c <> ''").collect()), np.uint64)
    bits, filled = filter_of(vocabulary, n)
    shared = spark.sparkContext.broadcast(filled)

    def generated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filled = shared.value
        for b in batches:
            texts = b[0].to_pylist()
            for places, letters in by_length(b[0]):
                each = max(1, AT_ONCE // max(1, letters.shape[1] * 8))
                for begin in range(0, len(places), each):
                    for taken, length, w, i, a, h in neighbours(letters[begin : begin + each], alphabet):
                        ok = passing(h, length, bits, filled)
                        if not len(ok):
                            continue
                        of = places[begin + w[ok]]
                        built = [texts[k][:p] + (chr(c) if c else "") + texts[k][p + taken :] for k, p, c in zip(of.tolist(), i[ok].tolist(), a[ok].tolist(), strict=True)]
                        yield pa.RecordBatch.from_arrays([b[0].take(pa.array(of)), b[1].take(pa.array(of)), pa.array(built, pa.string())], names=["word", "n", "near"])

    candidates = vocabulary.select("word", "n").repartition(partitions(vocabulary), "word").mapInArrow(generated, "word string, n long, near string")
    return candidates.join(vocabulary.select(F.col("word").alias("near"), F.col("n").alias("near_n")).hint("shuffle_hash"), "near")


def followed(forms: DataFrame) -> DataFrame:
    """(word, root): from each word of forms (word, form) follow forms to the last. Jumps double, so the rounds are few: a form is several times as frequent as its word."""
    now = materialize(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        further = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        then = materialize(now.join(further, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        discard(now)
        if then.filter("moved").isEmpty():
            return then.select("word", "root")
        now = then


def variants(counts: DataFrame, least_count: int = LEAST_COUNT, times: int = TIMES) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every word of counts (word, n) with at least least_count."""
    vocabulary = materialize(counts.filter(F.col("n") >= least_count), "words")
    pairs = near_pairs(vocabulary, vocabulary.count())
    best = pairs.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("m"), "near")).alias("best"))
    joined = vocabulary.join(best, "word", "left")
    formed = -F.col("best.m") >= times * F.col("n")
    told = materialize(joined.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(formed, F.col("best.near")).alias("form"), F.when(formed, -F.col("best.m")).alias("form_n")), "forms")
    roots = followed(told.filter("form is not null"))
    discard(vocabulary)
    return told.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
