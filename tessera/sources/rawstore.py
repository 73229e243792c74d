"""The raw page store: one gzipped body and one JSON sidecar a page, under source/day, read back as a table.

Keys are <prefix>/<source>/<day>/<id>.html.gz. Reading is Spark's own text source over any file system it knows;
source and day are columns of the path, so a source or a day is read by listing only its folders.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.text import safe_id

PREFIX = "raw"
KEY = r"([^/]+)/(\d{4}-\d{2}-\d{2})/([^/]+)\.html\.gz$"


def page_key(source: Column, raw_id: Column, day: Column) -> Column:
    return F.concat(F.lit(f"{PREFIX}/"), source, F.lit("/"), day.cast("string"), F.lit("/"), safe_id(raw_id), F.lit(".html.gz"))


def meta_key(key: Column) -> Column:
    return F.concat(F.regexp_replace(key, r"\.html\.gz$", ""), F.lit(".meta.json"))


def sidecar(pages: DataFrame, body: str = "body") -> Column:
    """JSON of a page's metadata: where from, when, its digest and size."""
    data = F.encode(body, "UTF-8")
    return F.to_json(F.struct("source", "raw_id", "url", "fetched_at", F.sha2(data, 256).alias("sha256"), F.octet_length(data).alias("bytes")))


def save(pages: DataFrame, root: str) -> None:
    """Write (source, raw_id, url, day, fetched_at, body) pages: bodies gzipped in one table partitioned by source and day, with their sidecars."""
    pages.select("source", "day", page_key(F.col("source"), F.col("raw_id"), F.col("day")).alias("key"), "body", sidecar(pages).alias("meta")).write.mode("append").partitionBy("source", "day").option("compression", "gzip").parquet(f"{root}/{PREFIX}")


def load(spark: SparkSession, root: str, source: str | None = None, day: str | None = None) -> DataFrame:
    """(key, source, day, body, meta) of saved pages; source and day prune folders."""
    df = spark.read.parquet(f"{root}/{PREFIX}")
    for column, value in (("source", source), ("day", day)):
        if value is not None:
            df = df.filter(F.col(column) == value)
    return df.withColumn("day", F.col("day").cast("string"))


def load_files(spark: SparkSession, root: str, source: str = "*", day: str = "*") -> DataFrame:
    """(key, source, day, body) of a store of single gzipped files, each read whole."""
    df = spark.read.text(f"{root}/{PREFIX}/{source}/{day}/*.html.gz", wholetext=True).withColumnRenamed("value", "body")
    path = F.input_file_name()
    return df.select(F.regexp_extract(path, KEY, 0).alias("key"), F.regexp_extract(path, KEY, 1).alias("source"), F.regexp_extract(path, KEY, 2).alias("day"), "body")
