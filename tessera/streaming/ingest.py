"""Extension: the raw store as a stream. New pages flow through the same parsing and cleaning into snapshots, exactly once."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.streaming.stateful_processor import TimerValues

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def page_stream(spark: SparkSession, path: str, schema: str, files_per_trigger: int = 1000) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(path)


def first_sightings(stream: DataFrame, key: str, time: str, late: str = "7 days") -> DataFrame:
    """Each key once while it is younger than the watermark; the state of older ones is dropped."""
    return stream.withWatermark(time, late).dropDuplicatesWithinWatermark([key])


def hourly_counts(stream: DataFrame, time: str, by: str, late: str = "1 hour") -> DataFrame:
    return stream.withWatermark(time, late).groupBy(F.window(time, "1 hour"), by).agg(F.count(F.lit(1)).alias("n"))


class StreakEnd(StatefulProcessor):
    """Passes a group's rows on up to the end of its first run of `streak` bad ones; the state is the run's length, or that it has ended."""

    def __init__(self, order: Sequence[str], bad: str, streak: int):
        self.order, self.bad, self.streak = list(order), bad, streak

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.run = handle.getValueState("run", "length int, ended boolean")

    def handleInputRows(self, key: tuple, rows: Iterator[Row], timerValues: TimerValues) -> Iterator[Row]:
        length, ended = self.run.get() if self.run.exists() else (0, False)
        if not ended:
            for row in sorted(rows, key=lambda r: tuple((r[c] is None, r[c]) for c in self.order)):
                yield row
                length = length + 1 if row[self.bad] else 0
                if length >= self.streak:
                    ended = True
                    break
        self.run.update((length, ended))

    def close(self) -> None:
        """Holds nothing but its state."""


def until_streak_stream(stream: DataFrame, group: Sequence[str], order: Sequence[str], bad: str, streak: int = 30) -> DataFrame:
    """`relational.until_streak` for a stream: the run goes on from batch to batch and over restarts.

    A group is a listing (a source and its run, say) whose batches come in order; a batch's rows of it are sorted by
    `order` in one task, so that they are bounded by what a trigger lets in. Rows whose `bad` is null count as good.
    A group's state is two values and stays: state that expires would need batches without end, which a stream that
    ends at what is there (availableNow) never finishes. The session's state store becomes RocksDB, which this needs.
    """
    stream.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    return stream.groupBy(*group).transformWithState(StreakEnd(order, bad, streak), stream.schema, "Append", "None")


def land_stream(stream: DataFrame, merge: Callable[[DataFrame | None, DataFrame], DataFrame], target: str, checkpoint: str) -> None:
    """Merge every micro-batch into the newest snapshot below `target` and write the next one; a repeated batch rewrites its own."""
    spark = stream.sparkSession

    def step(batch: DataFrame, number: int) -> None:
        old = spark.read.parquet(f"{target}/{number - 1}") if number else None
        merge(old, batch).write.mode("overwrite").parquet(f"{target}/{number}")

    stream.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
