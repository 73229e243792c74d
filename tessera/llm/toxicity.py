"""Toxicity: a linear-chain conditional random field over words (operator 5).

Labels are of documents; token labels are drawn from them. Words whose presence speaks for toxic documents (a
log-likelihood ratio test over a bounded, seeded sample of labelled documents) make the lexicon; in toxic
documents its words are tagged toxic, all other words and all of clean documents are not. The chain has two
tags; its weights (one for each lexicon word, one for other words, transitions) maximise the conditional
likelihood of the tags by forward-backward and gradient ascent. Pieces of documents without lexicon words are
alike and count as one with a weight.

A document is scored whole. Between lexicon words the chain runs through words that are alike, so forward and
backward vectors pass a gap by a power of one 2 x 2 matrix; the marginals of the lexicon words are exact. They
aggregate to the document score by a logistic regression on their sum, their maximum and the document's length,
fitted on the same sample with the classes weighted as in all labelled rows. Spans are words with a marginal of
0.5 or more, as byte offsets.

Scores depend on the text only. Words: runs of a-z, 0-9 and non-ASCII characters of the lower-cased text.
Defined cases: null and empty texts have the score of a text without words; repeated labels of a document count
once (toxic if any says so), null ones not at all; without toxic labels to learn from every score is 0; a null
doc_id falls into the held-out part.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.common import materialize, sliced

#: Labelled documents of each class in the training sample, at most, and the seed that draws them.
SAMPLE, SEED = 4000, 5
#: Least log-likelihood ratio (G squared) and least documents of a lexicon word.
LEAST_G, LEAST_DOCUMENTS = 14.0, 3
PIECE, STEPS = 64, 80
#: Gaps up to so many words have their matrix power ready.
GAPS = 512
#: Training pieces whose marginals are held at once.
PIECES_AT_ONCE = 2048

SPLIT = bytes(b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
WORD = re.compile(rb"[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def words_of(text: str | None) -> list[bytes]:
    return text.lower().encode().translate(SPLIT).split() if text else []


def fold(key: Column) -> Column:
    """crc32 of the key as text, modulo 5; 0 is the held-out part."""
    return F.crc32(F.encode(F.coalesce(key.cast("string"), F.lit("")), "UTF-8")) % 5


def chain(emit: np.ndarray, move: np.ndarray, ids: np.ndarray, mask: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Marginals of tag 1, expected moves, and log normaliser of rows of words, all rows at once."""
    n, size = ids.shape
    score = np.zeros((n, size, 2))
    score[:, :, 1] = emit[ids]
    local, m = np.exp(score), np.exp(move)
    alpha, scale = np.empty((n, size, 2)), np.ones((n, size))
    for t in range(size):
        now = local[:, t] if not t else (alpha[:, t - 1] @ m) * local[:, t]
        if t:
            now = np.where(mask[:, t, None], now, alpha[:, t - 1])
        scale[:, t] = now.sum(1)
        alpha[:, t] = now / scale[:, t, None]
    beta = np.ones((n, size, 2))
    for t in range(size - 2, -1, -1):
        back = (local[:, t + 1] * beta[:, t + 1]) @ m.T
        beta[:, t] = np.where(mask[:, t + 1, None], back / back.sum(1, keepdims=True), beta[:, t + 1])
    post = alpha * beta
    post /= post.sum(2, keepdims=True)
    pair = alpha[:, :-1, :, None] * m * (local[:, 1:] * beta[:, 1:])[:, :, None, :]
    pair /= pair.sum((2, 3), keepdims=True)
    pair *= mask[:, 1:, None, None]
    return post[:, :, 1] * mask, pair, np.log(scale).sum(1)


def train_chain(ids: np.ndarray, tags: np.ndarray, mask: np.ndarray, weight: np.ndarray, classes: int) -> tuple[np.ndarray, np.ndarray]:
    """Emission weights by class (0: other words) and moves, by Adam on the conditional log-likelihood."""
    theta = np.zeros(classes + 4)
    theta[0] = -4.0
    first, second = np.zeros_like(theta), np.zeros_like(theta)
    w = (weight[:, None] * mask).ravel()
    seen = np.bincount(ids.ravel(), w * tags.ravel(), classes)
    both = np.zeros((2, 2))
    for a in (0, 1):
        for b in (0, 1):
            both[a, b] = (weight[:, None] * mask[:, 1:] * (tags[:, :-1] == a) * (tags[:, 1:] == b)).sum()
    total = max(1.0, w.sum())
    for step in range(1, STEPS + 1):
        want, moved = np.zeros(classes), np.zeros((2, 2))
        for at in range(0, len(ids), PIECES_AT_ONCE):
            part = slice(at, at + PIECES_AT_ONCE)
            post, pair, _ = chain(theta[:classes], theta[classes:].reshape(2, 2), ids[part], mask[part])
            want += np.bincount(ids[part].ravel(), (weight[part, None] * post).ravel(), classes)
            moved += np.einsum("n,ntab->ab", weight[part], pair)
        # each weight's slope is measured against how often it is at stake, so that rare words learn as fast
        at_stake = np.concatenate((np.bincount(ids.ravel(), w, classes) + 1, np.full(4, total)))
        slope = (np.concatenate((seen - want, (both - moved).ravel())) - 0.5 * theta) / at_stake
        first, second = 0.9 * first + 0.1 * slope, 0.99 * second + 0.01 * slope**2
        theta += 0.25 * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-9) / np.sqrt(1 + step / 20)
    return theta[:classes], theta[classes:].reshape(2, 2)


def logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Weights of a ridge logistic regression by Newton's method; x has a column of ones."""
    out = np.zeros(x.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ out, -30, 30)))
        h = (x * (weight * p * (1 - p))[:, None]).T @ x + 0.1 * np.eye(len(out))
        out += np.linalg.solve(h, x.T @ (weight * (y - p)) - 0.1 * out)
    return out


@dataclass
class Tagger:
    lexicon: dict[bytes, int] = field(default_factory=dict)
    emit: np.ndarray = field(default_factory=lambda: np.zeros(1))
    move: np.ndarray = field(default_factory=lambda: np.zeros((2, 2)))
    document: np.ndarray | None = None

    def prepare(self) -> None:
        m = np.exp(self.move + np.array([0.0, self.emit[0]]))
        powers, now = [np.eye(2)], np.eye(2)
        for _ in range(GAPS):
            now = now @ m
            now = now / now.sum()
            powers.append(now)
        self.powers = np.array(powers)
        self.doubled = [self.powers[GAPS]]

    def power(self, gap: int) -> np.ndarray:
        """The chain through a gap, up to a factor; beyond GAPS words by repeated squaring."""
        if gap <= GAPS:
            return self.powers[gap]
        out, times = self.powers[gap % GAPS], gap // GAPS
        for bit in range(times.bit_length()):
            if bit == len(self.doubled):
                now = self.doubled[-1] @ self.doubled[-1]
                self.doubled.append(now / now.sum())
            if times >> bit & 1:
                out = out @ self.doubled[bit]
                out = out / out.sum()
        return out

    def marginals(self, n: int, at: np.ndarray, classes: np.ndarray) -> np.ndarray:
        """Of tag 1, at the places `at` of a text of n words where lexicon words stand."""
        size = len(at)
        if not size:
            return np.zeros(0)
        gaps = (np.diff(np.concatenate(([-1], at, [n]))) - 1).tolist()
        local = np.stack((np.ones(size), np.exp(self.emit[classes])), 1)
        m, power = np.exp(self.move), self.power
        ahead, back = np.empty((size, 2)), np.empty((size, 2))
        # the first word of a text has no move into it: a gap of g words at the beginning is one start and g - 1 powers
        now = None
        for i in range(size):
            if i == 0:
                if gaps[0]:
                    now = np.array([1.0, np.exp(self.emit[0])]) @ power(gaps[0] - 1) @ m
                else:
                    now = np.ones(2)
            else:
                now = ahead[i - 1] @ power(gaps[i]) @ m
            now = now * local[i]
            ahead[i] = now / now.sum()
        now = power(gaps[size]) @ np.ones(2)
        for i in range(size - 1, -1, -1):
            back[i] = now / now.sum()
            if i:
                now = power(gaps[i]) @ (m @ (local[i] * back[i]))
        post = ahead * back
        return post[:, 1] / post.sum(1)

    def hits(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        if not words or self.lexicon.keys().isdisjoint(words):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        found = [(i, c) for i, c in enumerate(map(self.lexicon.get, words)) if c is not None]
        return np.array([i for i, _ in found]), np.array([c for _, c in found])

    @staticmethod
    def features(n: int, marginals: np.ndarray) -> list[float]:
        total, most = (float(marginals.sum()), float(marginals.max())) if len(marginals) else (0.0, 0.0)
        return [1.0, np.log1p(total), most, float(total > 1.5), np.log1p(n) / 10, np.log1p(100 * total / (n + 20))]

    def score(self, n: int, marginals: np.ndarray) -> float:
        if self.document is None:
            return 0.0
        return float(1 / (1 + np.exp(-np.clip(np.dot(self.features(n, marginals), self.document), -30, 30))))


def pieces_of(rows: list[tuple[int, int, np.ndarray, np.ndarray]]) -> tuple[np.ndarray, ...]:
    """Training pieces of PIECE words from (toxic, words, places, classes); those without lexicon words are counted together."""
    ids, tags, mask, weight = [], [], [], []
    plain: Counter[int] = Counter()
    for y, n, at, classes in rows:
        by = {}
        for i, c in zip(at.tolist(), classes.tolist(), strict=True):
            by.setdefault(i // PIECE, []).append((i % PIECE, c))
        for k in range(-(-n // PIECE)):
            length = min(PIECE, n - k * PIECE)
            if k in by:
                row, tag = np.zeros(PIECE, np.int64), np.zeros(PIECE, bool)
                for i, c in by[k]:
                    row[i], tag[i] = c, y
                ids.append(row)
                tags.append(tag)
                mask.append(np.arange(PIECE) < length)
                weight.append(1.0)
            else:
                plain[length] += 1
    for length, times in plain.items():
        ids.append(np.zeros(PIECE, np.int64))
        tags.append(np.zeros(PIECE, bool))
        mask.append(np.arange(PIECE) < length)
        weight.append(float(times))
    return np.array(ids), np.array(tags), np.array(mask), np.array(weight)


def fit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic", sample: int = SAMPLE, seed: int = SEED) -> Tagger:
    """A tagger from the labelled rows outside the held-out part; `sample` rows of each class at most, drawn by seeded hash."""
    spark = docs.sparkSession
    known = labels.select(F.col(key).alias("__k"), F.col(label).cast("int").alias("__y")).filter((fold(F.col("__k")) != 0) & F.col("__y").isNotNull() & F.col("__k").isNotNull()).groupBy("__k").agg(F.max("__y").alias("__y"))
    counts = {r["__y"]: r["count"] for r in known.groupBy("__y").count().collect()}
    if not counts.get(1) or not counts.get(0):
        return Tagger()
    drawn = [known.filter(F.col("__y") == y).orderBy(F.xxhash64("__k", F.lit(seed)), "__k").limit(sample) for y in (0, 1)]
    chosen = F.broadcast(drawn[0].unionByName(drawn[1]))  # 2 * sample rows at most
    rows = materialize(docs.select(F.col(key).alias("__k"), F.col(text).alias("__t")).join(chosen, "__k").select("__y", "__t"), "toxic-sample")
    sizes = {r["__y"]: r["count"] for r in rows.groupBy("__y").count().collect()}
    if not sizes.get(1) or not sizes.get(0):
        return Tagger()

    def presence(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            seen = ({}, {})
            for y, t in zip(b[0].to_pylist(), b[1].to_pylist(), strict=True):
                for w in set(words_of(t)):
                    seen[y][w] = seen[y].get(w, 0) + 1
            words = list(seen[0].keys() | seen[1].keys())
            yield pa.RecordBatch.from_arrays([pa.array(words, pa.binary()), *(pa.array([s.get(w, 0) for w in words], pa.int64()) for s in seen)], names=["word", "clean", "toxic"])

    n0, n1 = float(sizes[0]), float(sizes[1])
    table = rows.mapInArrow(presence, "word binary, clean long, toxic long").groupBy("word").agg(F.sum("clean").alias("q"), F.sum("toxic").alias("p")).filter(F.col("p") >= LEAST_DOCUMENTS)

    def part(x: Column, n: float, rate: Column) -> Column:
        return F.when(x > 0, x * F.ln(x / (n * rate))).otherwise(0.0) + F.when(n - x > 0, (n - x) * F.ln((n - x) / (n * (1 - rate)))).otherwise(0.0)

    rate = (F.col("p") + F.col("q")) / (n0 + n1)
    g = 2 * (part(F.col("p"), n1, rate) + part(F.col("q"), n0, rate))
    # at least three times as frequent in toxic documents; how many words pass is bounded by the sample's evidence
    lexicon = table.filter((g >= LEAST_G) & (F.col("p") / n1 >= 3 * F.col("q") / n0) & (rate < 1)).select("word").collect()
    tagger = Tagger({w: i + 1 for i, w in enumerate(sorted(bytes(r["word"]) for r in lexicon))})
    sent = spark.sparkContext.broadcast(tagger)

    def compact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for y, t in zip(b[0].to_pylist(), b[1].to_pylist(), strict=True):
                words = words_of(t)
                at, classes = sent.value.hits(words)
                out.append((y, len(words), at.tolist(), classes.tolist()))
            yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*out, strict=True), (pa.int32(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64())), strict=True)] if out else [pa.array([], k) for k in (pa.int32(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()))], names=["y", "n", "at", "classes"])

    short = [(r["y"], r["n"], np.array(r["at"], np.int64), np.array(r["classes"], np.int64)) for r in rows.mapInArrow(compact, "y int, n long, at array<long>, classes array<long>").collect()]
    short.sort(key=lambda r: (r[0], r[1], r[2].tolist(), r[3].tolist()))
    tagger.emit, tagger.move = train_chain(*pieces_of(short), len(tagger.lexicon) + 1)
    tagger.prepare()
    x = np.array([tagger.features(n, tagger.marginals(n, at, classes)) for _, n, at, classes in short])
    y = np.array([r[0] for r in short], float)
    weight = np.where(y == 1, counts[1] / n1, counts[0] / n0)
    tagger.document = logistic(x, y, weight / weight.mean())
    return tagger


def scored(tagger: Tagger, texts: list[str | None], spans: bool) -> tuple[list[float], list[list[int]]]:
    """The score of each text and, if asked for, its toxic words' byte offsets."""
    scores, found = [], []
    for t in texts:
        words = words_of(t)
        at, classes = tagger.hits(words)
        marginals = tagger.marginals(len(words), at, classes)
        scores.append(tagger.score(len(words), marginals))
        bad = at[marginals >= 0.5]
        if spans and len(bad):
            places = [m.span() for m in WORD.finditer(t.encode())]
            found.append([x for i in bad.tolist() for x in places[i]])
        else:
            found.append([])
    return scores, found


def score(docs: DataFrame, tagger: Tagger, text: str = "text", column: str = "score", spans: str | None = "spans") -> DataFrame:
    """docs with the score of each text (0 to 1) and, if asked for, the toxic words' byte offsets (from, to, from, to ...)."""
    sent = docs.sparkSession.sparkContext.broadcast(tagger)
    kept = [c for c in docs.columns if c not in (column, spans)]
    place = kept.index(text)
    extra = [T.StructField(column, T.DoubleType()), *([T.StructField(spans, T.ArrayType(T.LongType()))] if spans else [])]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            scores, found = scored(sent.value, b[place].to_pylist(), bool(spans))
            new = [pa.array(scores, pa.float64()), *([pa.array(found, pa.list_(pa.int64()))] if spans else [])]
            yield pa.RecordBatch.from_arrays([*b.columns, *new], names=[*b.schema.names, *(f.name for f in extra)])

    rows = docs.select(*kept)
    return rows.mapInArrow(run, T.StructType([*rows.schema.fields, *extra]))


def keep_clean(docs: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id", limit: float = 0.5) -> DataFrame:
    """docs without the rows whose score is `limit` or more; columns as before, whatever their names."""
    sent = docs.sparkSession.sparkContext.broadcast(fit(docs, labels, key, text))
    place = docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in sliced(batches):  # a text goes to Python once, within its row
            scores, _ = scored(sent.value, b[place].to_pylist(), False)
            yield b.filter(pa.array([x < limit for x in scores], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
