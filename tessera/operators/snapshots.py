"""Keyed tables in buckets: changes rewrite the buckets they touch, and a new version shows at once or not at all.

Rows lie in buckets of a hash of their keys, each bucket a folder of Parquet files that never change. A version is one
small file that names each bucket's folder; readers take the newest. A change reads the buckets of its own keys alone,
writes them anew beside the old ones, and then moves the version's file into place: until that, and if the job is
killed before it, everybody reads the old version. A second writer who began from the same version is refused.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.operators.graph import discard, written


class Conflict(Exception):
    """Another writer has made this version meanwhile."""


class KeyedTable:
    """A table at a path, keyed by columns; `create` makes one, `change` its next version, `read` a DataFrame of one.

    Null keys are keys. A bucket should have some 100 MB; their number is fixed when the table is made and bounds the
    version's file and what a change collects.
    """

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path.rstrip("/")

    @classmethod
    def create(cls, df: DataFrame, path: str, keys: Sequence[str], buckets: int = 256) -> KeyedTable:
        table = cls(df.sparkSession, path)
        state = {"keys": list(keys), "buckets": buckets, "schema": df.schema.json(), "held": {}}
        table._commit(0, state | {"held": table._write(df, state)})
        return table

    def version(self) -> int:
        names = [f.getPath().getName() for f in self._list(f"{self.path}/versions")]
        return max(int(n.removesuffix(".json")) for n in names if n.endswith(".json"))

    def read(self, version: int | None = None) -> DataFrame:
        state = self._state(self.version() if version is None else version)
        return self._rows(state, state["held"])

    def change(self, changes: DataFrame, how: Callable[[DataFrame, DataFrame], DataFrame]) -> list[int]:
        """Makes the next version of how(old rows, changes), where all rows of a key that changes lie in its bucket; returns the buckets that were rewritten.

        how sees the old rows of the touched buckets only, and must leave those of other keys as they are: upserts,
        inserts of what is absent, replaced children (keyed by the parent), updates by key and deletions do.
        """
        at = self.version()
        state = self._state(at)
        changes = written(changes)
        touched = sorted(r[0] for r in changes.select(self._bucket(state)).distinct().collect())
        old = self._rows(state, {k: v for k, v in state["held"].items() if int(k) in touched})
        columns = T.StructType.fromJson(json.loads(state["schema"])).names
        new = self._write(how(old, changes).select(*columns), state)
        held = {k: v for k, v in state["held"].items() if int(k) not in touched}
        self._commit(at + 1, state | {"held": held | new})
        discard(changes)
        return touched

    def vacuum(self, keep: int = 2) -> None:
        """Deletes what none of the newest versions names, killed jobs' folders included; not to be run beside a writer."""
        newest = self.version()
        versions = [v for v in range(max(0, newest - keep + 1), newest + 1)]
        named = {folder for v in versions for folder in self._state(v)["held"].values()}
        for f in self._list(f"{self.path}/data"):
            if f.getPath().getName() not in named:
                self._files().delete(f.getPath(), True)
        for f in self._list(f"{self.path}/versions"):
            name = f.getPath().getName()
            if not name.endswith(".json") or int(name.removesuffix(".json")) not in versions:
                self._files().delete(f.getPath(), False)

    def _bucket(self, state: dict) -> Column:
        return F.pmod(F.xxhash64(*state["keys"]), F.lit(state["buckets"])).cast("int").alias("__bucket")

    def _rows(self, state: dict, held: dict) -> DataFrame:
        schema = T.StructType.fromJson(json.loads(state["schema"]))
        if not held:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*(f"{self.path}/data/{folder}/__bucket={k}" for k, folder in sorted(held.items())))

    def _write(self, rows: DataFrame, state: dict) -> dict[str, str]:
        folder = uuid.uuid4().hex
        place = f"{self.path}/data/{folder}"
        # a bucket's rows come together, and large ones are split into several files
        rows.withColumn("__bucket", self._bucket(state)).hint("rebalance", "__bucket").write.partitionBy("__bucket").parquet(place)
        names = [f.getPath().getName() for f in self._list(place)]
        return {n.removeprefix("__bucket="): folder for n in names if n.startswith("__bucket=")}

    def _commit(self, version: int, state: dict) -> None:
        files, jvm = self._files(), self.spark._jvm
        path = lambda name: jvm.org.apache.hadoop.fs.Path(f"{self.path}/versions/{name}")
        target, own = path(f"{version}.json"), path(f"{uuid.uuid4().hex}.tmp")
        stream = files.create(own, True)
        stream.write(bytearray(json.dumps(state).encode()))
        stream.close()
        if files.exists(target) or not files.rename(own, target):
            files.delete(own, False)
            raise Conflict(f"version {version} of {self.path}")

    def _state(self, version: int) -> dict:
        return json.loads(self.spark.read.text(f"{self.path}/versions/{version}.json", wholetext=True).first()[0])

    def _files(self):
        return self.spark._jvm.org.apache.hadoop.fs.Path(self.path).getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _list(self, folder: str) -> list:
        found = self.spark._jvm.org.apache.hadoop.fs.Path(folder)
        return list(self._files().listStatus(found)) if self._files().exists(found) else []
