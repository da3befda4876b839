import os

import pytest
from pyspark.sql import functions as F

from tablekit.operators import file_merge as M
from tablekit.operators.upsert import upsert


def _rows(df):
    return sorted(map(str, map(tuple, df.collect())))


def _table(spark, tmp, n=4000, files=10):
    df = spark.range(n).selectExpr("id AS k", "concat('v', id) AS v", "CAST(id AS DOUBLE) / 7 AS x")
    M.create(df, f"{tmp}/t", "k", files)
    return df, f"{tmp}/t"


def test_only_touched_files_are_rewritten(spark, tmp):
    df, path = _table(spark, tmp)
    before = {r.file for r in M.index(spark, path).collect()}
    changes = spark.createDataFrame([(5, "a", 1.0), (7, "b", None), (3999, "c", 2.0), (10_000, "new", 3.0)], df.schema)
    done = M.merge(spark, path, changes, "k")
    after = {r.file for r in M.index(spark, path).collect()}
    assert done.files == len(before) == 10 and done.rewritten == 2 and done.opened <= 3
    assert len(before - after) == 2 and len(after - before) == done.written
    assert _rows(M.read(spark, path)) == _rows(upsert(df, changes, "k"))


def test_inserts_alone_touch_nothing(spark, tmp):
    df, path = _table(spark, tmp)
    # Keys inside the files' ranges that no file holds would be found by ranges, not by the filter.
    spread, odd = spark.range(0, 8000, 2).selectExpr("id AS k", "concat('v', id) AS v", "1.5D AS x"), f"{tmp}/odd"
    M.create(spread, odd, "k", 10)
    new = spark.createDataFrame([(k, "n", 0.0) for k in (1, 2001, 7001)], spread.schema)
    done = M.merge(spark, odd, new, "k")
    assert done.rewritten == 0 and done.opened <= 2 and M.read(spark, odd).count() == 4003
    assert M.merge(spark, path, spark.createDataFrame([(None, "null", 0.0)], "k long, v string, x double"), "k").rewritten == 0
    assert M.read(spark, path).count() == 4001


def test_many_merges_equal_upserts(spark, tmp):
    df, path = _table(spark, tmp, 600, 6)
    want = df
    for step in range(4):
        changes = spark.range(step * 50, 900, 37 + step).selectExpr("id AS k", f"'s{step}' AS v", "0.0D AS x")
        M.merge(spark, path, changes, "k")
        want = upsert(want, changes, "k")
    assert _rows(M.read(spark, path)) == _rows(want)
    assert M.versions(spark, path) == [0, 1, 2, 3, 4]


def test_text_keys_and_versions_of_a_change(spark, tmp):
    df = spark.range(500).selectExpr("concat('k', id) AS k", "id AS v")
    M.create(df, f"{tmp}/t", "k", 5)
    changes = spark.createDataFrame([("k7", 1, 1), ("k7", 2, 2), ("zz", 3, 1)], "k string, v long, version int")
    done = M.merge(spark, f"{tmp}/t", changes, "k", order_by=["version"])
    assert done.rewritten == 1
    assert _rows(M.read(spark, f"{tmp}/t")) == _rows(upsert(df, changes, "k", order_by=["version"]))
    with pytest.raises(ValueError, match="duplicate"):
        M.merge(spark, f"{tmp}/t", changes.drop("version"), "k")


def test_a_lost_merge_changes_nothing(spark, tmp, monkeypatch):
    df, path = _table(spark, tmp)

    def lost(*args):
        raise RuntimeError("lost")

    monkeypatch.setattr(M, "_publish", lost)
    with pytest.raises(RuntimeError):
        M.merge(spark, path, df.where("k = 3").withColumn("v", F.lit("x")), "k")
    assert M.versions(spark, path) == [0] and _rows(M.read(spark, path)) == _rows(df)
    monkeypatch.undo()
    with pytest.raises(FileExistsError):
        M._publish(spark, path, 0, spark.range(1))
    assert [n for n in os.listdir(f"{path}/versions") if n.startswith("_v")] == []
