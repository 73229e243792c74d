"""Helpers shared by the training-data operators: tables in the shared folder, and text columns."""

from __future__ import annotations

import contextlib
import tempfile
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share, as the session names it in spark.checkpoint.dir.

    Only where that is unset (tests, one machine) a temporary folder of this machine is set instead.
    """
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not found:
        jdir = spark.sparkContext._jsc.sc().getCheckpointDir()
        found = jdir.get() if jdir.isDefined() else None
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        found = tempfile.mkdtemp(prefix="tessera-")
        spark.sparkContext.setCheckpointDir(found)
    return found.rstrip("/")


def sliced(batches: Iterator[pa.RecordBatch], size: int = 1024) -> Iterator[pa.RecordBatch]:
    """Smaller batches, so that less is held twice."""
    for b in batches:
        for at in range(0, b.num_rows, size):
            yield b.slice(at, size)


CLEANUP, BATCH = "spark.sql.classic.shuffleDependency.fileCleanup.enabled", "spark.sql.execution.arrow.maxRecordsPerBatch"
#: Rows that go to Python at once where each holds a text or a text's shingles: executor and worker each hold such a batch a task.
WIDE_ROWS = 1000


@contextlib.contextmanager
def settings(spark: SparkSession, wide: bool) -> Iterator[None]:
    """The job's shuffle files go when it is over, as nothing reads them again; wide: Arrow batches have WIDE_ROWS rows at most."""
    now, before = {CLEANUP: "true"}, {CLEANUP: spark.conf.get(CLEANUP, "false")}
    if wide:
        before[BATCH] = spark.conf.get(BATCH)
        now[BATCH] = str(min(WIDE_ROWS, int(before[BATCH]))) if int(before[BATCH]) > 0 else str(WIDE_ROWS)
    try:
        for k, v in now.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def materialize(df: DataFrame, name: str, wide: bool = False) -> DataFrame:
    """Write df as Parquet below the shared folder and read it back: the lineage ends there and a lost executor costs nothing that was written."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/tessera/{name}-{uuid.uuid4().hex}"
    with settings(spark, wide):
        df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.written_at = path
    return out


def materialize_by(df: DataFrame, key: str, name: str, wide: bool = False) -> DataFrame:
    """As `materialize`, but in buckets of key, as many as the session's shuffle partitions: joins on key read it where it lies."""
    spark = df.sparkSession
    named = f"{name}-{uuid.uuid4().hex}".replace("-", "_")
    path = f"{shared_dir(spark)}/tessera/{named}"
    with settings(spark, wide):
        df.write.format("parquet").bucketBy(partitions(df), key).option("path", path).saveAsTable(named)
    out = spark.table(named)
    out.written_at, out.table_name = path, named
    return out


def discard(*tables: DataFrame | None) -> None:
    """Delete tables of `materialize` and `materialize_by` that nothing reads any more."""
    for df in tables:
        if named := getattr(df, "__dict__", {}).get("table_name"):
            df.sparkSession.sql(f"DROP TABLE IF EXISTS {named}")
        if path := getattr(df, "__dict__", {}).get("written_at"):
            jvm, conf = df.sparkSession._jvm, df.sparkSession._jsc.hadoopConfiguration()
            folder = jvm.org.apache.hadoop.fs.Path(path)
            folder.getFileSystem(conf).delete(folder, True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def partitions(df: DataFrame) -> int:
    """Shuffle partitions of the session, for exchanges that are asked for by number."""
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def unsigned_crc32(text: Column) -> Column:
    return F.crc32(F.encode(text, "UTF-8"))
