"""Streaks over a stream's batches and restarts, as over the whole table; a run that stops to fetch."""

import random

from pyspark.sql import functions as F

from tessera.operators.relational import until_streak
from tessera.plans import runs
from tessera.streaming import ingest
from tests.test_runs import run, snapshot


def test_streak_goes_on_over_restarts(spark, tmp_path):
    rnd = random.Random(4)
    rows = [("hot" if rnd.random() < 0.5 else f"s{rnd.randrange(6)}", n, rnd.random() < 0.6 if n % 9 else None) for n in range(300)]
    schema = "source string, nth int, old boolean"
    for part in range(3):
        spark.createDataFrame(rows[part * 100 : part * 100 + 100], schema).repartition(3).write.mode("append").parquet(f"{tmp_path}/in")
        stream = ingest.page_stream(spark, f"{tmp_path}/in", schema)
        out = ingest.until_streak_stream(stream, ["source"], ["nth"], "old", 4)
        out.writeStream.format("parquet").option("path", f"{tmp_path}/out").option("checkpointLocation", f"{tmp_path}/cp").trigger(availableNow=True).start().awaitTermination()
    got = sorted(tuple(r) for r in spark.read.parquet(f"{tmp_path}/out").collect())
    whole = until_streak(spark.createDataFrame(rows, schema), ["source"], ["nth"], F.coalesce("old", F.lit(False)), 4)
    assert got == sorted(tuple(r) for r in whole.collect()) and len(got) < 250


def test_a_run_stops_to_fetch_at_a_streak_or_a_block(spark):
    new, far, old = "2026-10-09", "2026-01-01", snapshot(spark, [99])
    limits = runs.Limits(max_pages=9, streak=3, step=2)
    # the streak of 1, 2 and 4 (3 is an error, which neither ends nor lengthens it) ends with the third step
    log = run(spark, [new, far, far, new, far, new, new, new], old, limits, {3: "fetch_failed: 503"}).log.first()
    assert (log["n_fetched"], log["n_old"], log["n_saved"], log["n_errors"]) == (6, 3, 1, 1)
    log = run(spark, [new] * 8, old, limits, {3: "blocked: 403"}).log.first()
    assert (log["n_fetched"], log["status"]) == (4, "blocked")
    log = run(spark, [new] * 8, old, limits).log.first()
    assert (log["n_fetched"], log["n_saved"], log["status"]) == (8, 8, "success")
    assert run(spark, [new] * 12, old, limits).log.first()["n_fetched"] == 10 - 1
