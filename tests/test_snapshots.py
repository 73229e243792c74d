import random

import pytest
from pyspark.sql import functions as F

from tessera.operators import relational
from tessera.operators.snapshots import Conflict, KeyedTable

SCHEMA = "id long, v int, name string"


def upsert(old, new):
    return relational.upsert(old, new, ["id"], "v")


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_changes_rewrite_their_buckets_only(spark, tmp_path):
    rnd = random.Random(1)
    base = spark.createDataFrame([(i, 1, f"n{i}") for i in range(600)] + [(None, 1, "null")], SCHEMA)
    table, now = KeyedTable.create(base, str(tmp_path / "t"), ["id"], 64), base
    for version in range(2, 5):
        some = spark.createDataFrame([(rnd.randrange(700), version, f"v{version}") for _ in range(6)] + [(None, version, "null")], SCHEMA).dropDuplicates(["id"]).cache()
        before = table._state(table.version())["held"]
        touched = table.change(some, upsert)
        after = table._state(table.version())["held"]
        assert 0 < len(touched) <= 7 and {int(k) for k in after if after[k] != before.get(k)} == set(touched)
        now = upsert(now, some)
        assert rows(table.read()) == rows(now)
    assert rows(table.read(0)) == rows(base)
    table.change(spark.createDataFrame([(i,) for i in range(600)], "id long"), lambda old, new: old.join(new, "id", "left_anti"))
    assert rows(table.read()) == rows(now.filter("id is null or id >= 600"))
    last = rows(table.read())
    table.vacuum(1)
    assert rows(table.read()) == last and len(table._list(f"{table.path}/versions")) == 1


def test_a_killed_job_leaves_the_old_version(spark, tmp_path, monkeypatch):
    table = KeyedTable.create(spark.createDataFrame([(1, 1, "a"), (2, 1, "b")], SCHEMA), str(tmp_path / "t"), ["id"], 4)
    new = spark.createDataFrame([(1, 2, "c")], SCHEMA)
    with monkeypatch.context() as m:
        m.setattr(KeyedTable, "_commit", lambda *a: (_ for _ in ()).throw(KeyboardInterrupt()))
        with pytest.raises(KeyboardInterrupt):
            table.change(new, upsert)
    assert rows(table.read()) == [(1, 1, "a"), (2, 1, "b")] and table.version() == 0
    table.vacuum()
    state = table._state(0)
    table.change(new, upsert)
    with pytest.raises(Conflict):  # a writer that began from version 0 as well
        table._commit(1, state)
    assert rows(table.read()) == [(1, 2, "c"), (2, 1, "b")]


def test_children_and_empty_tables(spark, tmp_path):
    table = KeyedTable.create(spark.createDataFrame([], SCHEMA), str(tmp_path / "t"), ["id"], 4)
    assert table.read().count() == 0 and table.read().columns == ["id", "v", "name"]
    table.change(spark.createDataFrame([(1, 1, "a"), (1, 2, "b"), (2, 1, "c")], SCHEMA), lambda old, new: relational.replace_children(old, new, "id"))
    table.change(spark.createDataFrame([(1, 9, "z")], SCHEMA), lambda old, new: relational.replace_children(old, new, "id"))
    table.change(spark.createDataFrame([], SCHEMA), upsert)
    assert rows(table.read()) == [(1, 9, "z"), (2, 1, "c")]
    table.change(spark.createDataFrame([(2, 5, "d"), (3, 5, "e")], SCHEMA), lambda old, new: relational.insert_if_absent(old, new, ["id"], ["v"]))
    assert rows(table.read().withColumn("n", F.lit(0)).drop("n")) == [(1, 9, "z"), (2, 1, "c"), (3, 5, "e")]
