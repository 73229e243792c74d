"""Mixing sources to target weights by min-cost flow (operator 2).

A document may belong to several sources. Documents are aggregated by membership pattern (the set of their
sources), which leaves a network of patterns and sources that is small whatever the corpus: a pattern offers its
words once for each repetition, at a cost that rises with the repetition (convex), and each source asks for its
target. The min-cost flow says how many words each pattern gives; repetitions are used only where single copies
do not fill a target. Documents are then selected in seeded order: every document of a pattern gets the whole
repetitions that the flow gives to all, and a seeded prefix gets one more.

The prefix is found without sorting a pattern in one task: a pattern's documents are cut into seeded hash
ranges, the sums of the ranges give the range in which the cut lies, and only that range is ordered; there,
documents are taken greedily while they fit, so that the gap to the flow is smaller than that range's smallest
document left out.

Defined cases: null text has no words; a null source is a source of its own, last in order; documents without
words are taken once if any of their pattern's words are; repeated rows are separate documents with the same
seeded position, of which each counts; very long texts count whole; ties in position go by size; extra columns may
have any names; an empty table gives an empty result.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.common import materialize

SEED = 2
ROWS_PER_RANGE = 4096
#: Membership patterns that the driver's flow network may have; a proven bound for what is collected.
MAX_PATTERNS = 100_000


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def targets(sizes: Sequence[int], weights: Sequence[float], total: float, cap: float) -> list[float]:
    """Share total by weight; no target above cap times its size, the excess is shared again by weight."""
    out, free, left = [0.0] * len(sizes), set(range(len(sizes))), float(total)
    while free:
        weight = sum(weights[i] for i in free)
        full = {i for i in free if left * weights[i] / weight > cap * sizes[i]}
        if not full:
            for i in free:
                out[i] = left * weights[i] / weight
            break
        for i in full:
            out[i] = cap * sizes[i]
        left -= sum(out[i] for i in full)
        free -= full
    return out


def min_cost_flow(patterns: Sequence[tuple[frozenset, int]], quotas: dict, repetitions: int) -> list[int]:
    """Words that each pattern gives so that the quotas are met as far as they can be, at least total repetition cost.

    patterns: (its sources, its words). Arc costs: repetition r of a pattern costs r (from 0), convex. Successive
    shortest paths with potentials on the graph start -> pattern (one arc a repetition) -> source -> end.
    """
    names = list(quotas)
    node = {s: 2 + len(patterns) + i for i, s in enumerate(names)}
    arcs: list[list[int]] = []  # [to, capacity, cost, index of the reverse arc's place]
    out: list[list[int]] = [[] for _ in range(2 + len(patterns) + len(names))]

    def arc(a: int, b: int, capacity: int, cost: int) -> int:
        out[a].append(len(arcs))
        arcs.append([b, capacity, cost])
        out[b].append(len(arcs))
        arcs.append([a, 0, -cost])
        return len(arcs) - 2

    firsts = []
    for k, (members, words) in enumerate(patterns):
        firsts.append([arc(0, 2 + k, words, r) for r in range(repetitions)])
        for s in members:
            arc(2 + k, node[s], words * repetitions, 0)
    for s in names:
        arc(node[s], 1, int(quotas[s]), 0)
    potential = [0] * len(out)
    while True:
        far = [math.inf] * len(out)
        far[0], heap = 0, [(0, 0)]
        while heap:
            d, v = heapq.heappop(heap)
            if d > far[v]:
                continue
            for e in out[v]:
                to, capacity, cost = arcs[e]
                if capacity and (x := d + cost + potential[v] - potential[to]) < far[to]:
                    far[to] = x
                    heapq.heappush(heap, (x, to))
        if far[1] == math.inf:
            break
        limit = far[1]
        potential = [p + min(d, limit) for p, d in zip(potential, far, strict=True)]
        # all paths of this length at once: a blocking flow over arcs of reduced cost zero
        while True:
            level, queue = {0: 0}, [0]
            for v in queue:
                for e in out[v]:
                    to, capacity, cost = arcs[e]
                    if capacity and to not in level and cost + potential[v] - potential[to] == 0:
                        level[to] = level[v] + 1
                        queue.append(to)
            if 1 not in level:
                break
            at = [0] * len(out)
            while True:
                path, v = [], 0
                while v != 1:
                    while at[v] < len(out[v]):
                        e = out[v][at[v]]
                        to, capacity, cost = arcs[e]
                        if capacity and level.get(to, -1) == level[v] + 1 and cost + potential[v] - potential[to] == 0:
                            break
                        at[v] += 1
                    if at[v] < len(out[v]):
                        path.append(e)
                        v = to
                    elif path:
                        v = arcs[path.pop() ^ 1][0]
                        at[v] += 1
                    else:
                        break
                if v != 1:
                    break
                push = min(arcs[e][1] for e in path)
                for e in path:
                    arcs[e][1] -= push
                    arcs[e ^ 1][1] += push
    return [sum(arcs[e ^ 1][1] for e in each) for each in firsts]


def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Greedy choice inside the ranges where a pattern's cut lies: rows come ordered by pattern and seeded position."""
    pattern, room = None, 0
    for b in batches:
        more = []
        for p, r, size in zip(b["p"].to_pylist(), b["room"].to_pylist(), b["size"].to_pylist(), strict=True):
            if p != pattern:
                pattern, room = p, r
            take = size <= room
            room -= size if take else 0
            more.append(int(take))
        yield pa.RecordBatch.from_arrays([*b.columns, pa.array(more, pa.int64())], names=[*b.schema.names, "more"])


def mix(docs: DataFrame, key: Column, size: Column, sources: Column, quotas: Callable[[list[tuple[str | None, int]]], dict], repetitions: int = 2, seed: int = SEED) -> DataFrame:
    """How often each row is taken: (row, size, sources, copies, taken, and for rows of one source source_size, target).

    row: all columns of docs, nested, so that their names cannot clash. key: what the seeded position depends on.
    sources: array of the row's sources. quotas: from [(source, words)] in code-point order, null last, to
    {source: target words}. No row is taken more than `repetitions` times.
    """
    spark = docs.sparkSession
    of = F.array_sort(F.array_distinct(F.coalesce(sources, F.array(F.lit(None).cast("string")))))
    rows = materialize(docs.select(F.struct("*").alias("row"), size.alias("size"), of.alias("sources"), F.xxhash64(key, F.lit(seed)).alias("h")), "mix-sizes")
    by_pattern = rows.groupBy("sources").agg(F.sum("size").alias("words"), F.count(F.lit(1)).alias("n")).limit(MAX_PATTERNS + 1).collect()
    if len(by_pattern) > MAX_PATTERNS:
        raise ValueError(f"more than {MAX_PATTERNS} membership patterns; map sources to fewer groups first")
    order = lambda s: (s is None, (s or "").encode())
    by_pattern = sorted(by_pattern, key=lambda r: [order(s) for s in r["sources"]])
    words: dict = {}
    for r in by_pattern:
        for s in r["sources"]:
            words[s] = words.get(s, 0) + r["words"]
    ranked = sorted(words.items(), key=lambda x: order(x[0]))
    asked = quotas(ranked)
    flow = min_cost_flow([(frozenset(r["sources"]), r["words"]) for r in by_pattern], {s: round(t) for s, t in asked.items()}, repetitions)
    plan = []
    for k, (r, f) in enumerate(zip(by_pattern, flow, strict=True)):
        whole = min(repetitions, f // r["words"]) if r["words"] else 1
        one = r["sources"][0] if len(r["sources"]) == 1 else None
        single = len(r["sources"]) == 1
        plan.append((k, r["sources"], int(whole), int(f - whole * r["words"]) if r["words"] else 0, int(words[one]) if single else None, float(asked[one]) if single else None))
    n = sum(r["n"] for r in by_pattern)
    bits = max(0, math.ceil(math.log2(max(1, n / ROWS_PER_RANGE))))
    plans = F.broadcast(spark.createDataFrame(plan, "p int, plan array<string>, whole long, part long, source_size long, target double"))
    placed = rows.join(plans, F.col("sources").eqNullSafe(F.col("plan"))).drop("plan").withColumn("range", F.shiftright("h", 64 - bits) if bits else F.lit(0).cast("long"))
    sums = placed.groupBy("p", "range").agg(F.sum("size").alias("sum"), F.first("part").alias("cut"))
    before = F.coalesce(F.sum("sum").over(Window.partitionBy("p").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    # the range in which the cut of a pattern lies; one row a pattern, so as bounded as the plan
    cuts = sums.withColumn("before", before).filter((F.col("before") <= F.col("cut")) & (F.col("before") + F.col("sum") > F.col("cut"))).select(F.col("p").alias("cp"), F.col("range").alias("at"), (F.col("cut") - F.col("before")).alias("room"))
    cuts = spark.createDataFrame(cuts.collect(), "cp int, at long, room long")
    cut = placed.join(F.broadcast(cuts), F.col("p") == F.col("cp"), "left").drop("cp")
    clear = cut.filter(F.col("at").isNull() | (F.col("range") != F.col("at"))).withColumn("more", F.when(F.col("range") < F.col("at"), 1).otherwise(0).cast("long"))
    edge = cut.filter(F.col("range") == F.col("at")).repartition("p").sortWithinPartitions("p", "h", "size")
    fields = T.StructType([*edge.schema.fields, T.StructField("more", T.LongType())])
    chosen = clear.unionByName(edge.mapInArrow(fill, fields))
    copies = F.least(F.lit(repetitions), F.col("whole") + F.col("more"))
    return chosen.select("row", "size", "sources", copies.cast("long").alias("copies"), (copies * F.col("size")).cast("long").alias("taken"), "source_size", "target")


def cycle_quotas(weights: Sequence[float], share: float, cap: float) -> Callable[[list[tuple[str | None, int]]], dict]:
    """Quotas for sources in order whose weights repeat, sharing `share` times all words, no quota over cap times its source."""

    def quotas(ranked: list[tuple[str | None, int]]) -> dict:
        sizes = [n for _, n in ranked]
        return dict(zip([s for s, _ in ranked], targets(sizes, [weights[i % len(weights)] for i in range(len(sizes))], share * sum(sizes), cap), strict=True))

    return quotas


def mix_documents(docs: DataFrame, source: str = "source", text: str = "text", key: str = "doc_id", weights: Sequence[float] = (5, 2, 1), share: float = 1.5, cap: float = 2.0, seed: int = SEED) -> DataFrame:
    """The mixed corpus itself: the rows of docs, each as often as it is taken (columns as before).

    Every row is decided on its own, equal rows too; its position follows from key, text and source.
    """
    position = F.xxhash64(F.col(key).cast("string"), F.col(text), F.col(source))
    out = mix(docs, position, word_count(F.col(text)), F.array(F.col(source)), cycle_quotas(weights, share, cap), math.ceil(cap), seed)
    return out.filter("copies > 0").withColumn("n", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).select("row.*")
