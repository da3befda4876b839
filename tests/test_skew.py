"""A key holding a third of the rows: AQE can split it only in the skew-safe plans."""

import pytest
from pyspark.sql import functions as F

from tablekit.operators.joins import join_on

SKEW_CONF = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
    "spark.sql.shuffle.partitions": "16",
}


@pytest.fixture
def skew_conf(spark):
    old = {k: spark.conf.get(k, None) for k in SKEW_CONF}
    for k, v in SKEW_CONF.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)


def _final_plan(spark, df):
    agg = df.agg(F.count(F.lit(1)).alias("n"), F.max("b").alias("m"))
    n = agg.collect()[0][0]
    return n, agg._jdf.queryExecution().executedPlan().toString()


def test_left_outer_hot_right_key_is_split(spark, skew_conf):
    left = spark.range(0, 20000).selectExpr("id AS k", "id AS a")
    # Incompressible payload so that shuffle bytes reflect the row counts.
    right = spark.range(0, 300000).selectExpr(
        "CASE WHEN id % 3 = 0 THEN 7 ELSE id % 20000 END AS rk", "sha2(CAST(id AS STRING), 256) AS b")
    n_plain, plain = _final_plan(spark, join_on(left, right, "k", "rk", "left", skew_safe=False))
    n_safe, safe = _final_plan(spark, join_on(left, right, "k", "rk", "left"))
    assert n_plain == n_safe == 300000
    assert "SortMergeJoin(skew=true)" not in plain
    assert "SortMergeJoin(skew=true)" in safe


@pytest.mark.parametrize("how", ["left", "right", "full"])
def test_outer_forms_split_the_hot_key_and_share_exchanges(spark, skew_conf, how):
    left = spark.range(0, 200000).selectExpr(
        "CASE WHEN id % 3 = 0 THEN 7 WHEN id % 5 = 0 THEN NULL ELSE id END AS k", "sha2(CAST(id AS STRING), 256) AS a")
    right = spark.range(0, 20000).selectExpr("IF(id % 4 = 0, NULL, id) AS rk", "sha2(CAST(-id AS STRING), 256) AS b")
    plain = join_on(left, right, "k", "rk", how, skew_safe=False).agg(F.count("*"), F.count("k"), F.count("rk")).first()
    agg = join_on(left, right, "k", "rk", how).agg(
        F.count("*"), F.count("k"), F.count("rk"), F.max("a"), F.max("b"))
    assert tuple(agg.collect()[0])[:3] == tuple(plain)
    plan = agg._jdf.queryExecution().executedPlan().toString()
    assert "ReusedExchange" in plan
    if how != "right":
        assert "SortMergeJoin(skew=true)" in plan
