import random

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from tablekit.operators.joins import (
    array_join, join_drop_right_key, join_on, join_using, join_with,
)
from tests.fixtures import BANDS, BANDS_SCHEMA, GUITARS, GUITARS_SCHEMA, PLAYERS, PLAYERS_SCHEMA


@pytest.fixture
def frames(spark):
    p = spark.createDataFrame(PLAYERS, PLAYERS_SCHEMA)
    b = spark.createDataFrame(BANDS, BANDS_SCHEMA)
    g = spark.createDataFrame(GUITARS, GUITARS_SCHEMA)
    return p, b, g


@pytest.mark.parametrize("how,expected", [("inner", 3), ("left", 4), ("right", 4), ("full", 5),
                                          ("left_semi", 3), ("left_anti", 1)])
def test_join_types(frames, how, expected):
    p, b, _ = frames
    assert join_on(p, b, "band", "id", how).count() == expected


def test_anti_is_the_unmatched_player(frames):
    p, b, _ = frames
    assert [r.name for r in join_on(p, b, "band", "id", "left_anti").collect()] == ["Cid Chord"]


def test_using_join_key_once_and_first(frames):
    p, b, _ = frames
    out = join_using(p, b.withColumnRenamed("name", "band_name"), "band", right_key="id")
    assert out.columns[0] == "band" and out.columns.count("band") == 1
    assert out.count() == 3


def test_drop_right_key(frames):
    p, b, _ = frames
    out = join_drop_right_key(p, b, "band", "id")
    assert out.columns.count("id") == 1 and out.count() == 3


def test_ambiguous_column_fails(frames):
    p, b, _ = frames
    with pytest.raises(AnalysisException):
        join_on(p, b, "band", "id").select("id", "band").collect()


def test_array_join_fixture(frames):
    p, _, g = frames
    g2 = g.withColumnRenamed("id", "guitarId")
    assert array_join(p, g2, "guitars", "guitarId").count() == 5
    full = array_join(p, g2, "guitars", "guitarId", "full", left_key="id", right_key="guitarId")
    assert full.count() == 6
    lonely = full.where(F.col("id").isNull()).select("guitarId").collect()
    assert [r.guitarId for r in lonely] == [2]


def test_array_join_plan_has_no_cartesian(frames):
    p, _, g = frames
    g2 = g.withColumnRenamed("id", "guitarId")
    plan = array_join(p, g2, "guitars", "guitarId")._jdf.queryExecution().executedPlan().toString()
    assert "Cartesian" not in plan and "NestedLoop" not in plan


def array_join_naive(left, right, array_col, value_col, how):
    """The direct ``array_contains`` condition (a nested loop), for comparison."""
    return left.join(right, F.array_contains(left[array_col], right[value_col]), how)


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.mark.parametrize("seed", range(6))
@pytest.mark.parametrize("how", ["inner", "left", "right", "full"])
def test_array_join_matches_naive(spark, seed, how):
    rnd = random.Random(seed)
    left = []
    for i in range(12):
        kind = rnd.random()
        if kind < 0.15:
            arr = None
        elif kind < 0.25:
            arr = []
        else:
            arr = [rnd.choice([None, 0, 1, 2, 3, 4, 5, 6, 7]) for _ in range(rnd.randint(1, 4))]
        left.append((i, arr))
    right = [(100 + j, rnd.choice([0, 1, 2, 3, 8, 9])) for j in range(8)]
    l_df = spark.createDataFrame(left, "lid long, arr array<long>")
    r_df = spark.createDataFrame(right, "rid long, v long")
    ours = array_join(l_df, r_df, "arr", "v", how, left_key="lid", right_key="rid")
    naive = array_join_naive(l_df, r_df, "arr", "v", how)
    assert _rows(ours.select("lid", "rid")) == _rows(naive.select("lid", "rid"))


def test_join_with_pairs_null_struct(frames):
    p, b, _ = frames
    out = join_with(p, b, "band", "id", "full").collect()
    assert len(out) == 5
    assert sum(1 for r in out if r["_1"] is None) == 1
    assert sum(1 for r in out if r["_2"] is None) == 1
    inner = join_with(p, b, "band", "id", "inner").collect()
    assert all(r["_1"]["band"] == r["_2"]["id"] for r in inner)


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_skew_safe_plans(spark):
    left = spark.range(0, 100).withColumnRenamed("id", "k")
    right = spark.range(0, 3000).selectExpr("CASE WHEN id % 3 = 0 THEN 7 ELSE id END AS rk", "id AS v")
    for how in ("left", "full", "right"):
        plan = _plan(join_on(left, right, "k", "rk", how))
        assert "LeftOuter" not in plan and "FullOuter" not in plan and "RightOuter" not in plan
    plan = _plan(join_on(left, right, "k", "rk", "left_semi"))
    assert "HashAggregate" in plan  # right keys reduced before the probe


@pytest.mark.parametrize("how", ["inner", "left", "right", "full", "left_semi", "left_anti"])
def test_hot_key_joins_match_plain(spark, how):
    # A third of the right rows share key 7; results equal the plain join.
    left = spark.range(0, 120).selectExpr("id AS k", "id * 2 AS a")
    right = spark.range(0, 3000).selectExpr("CASE WHEN id % 3 = 0 THEN 7 ELSE id + 50 END AS rk", "id AS v")
    ours = join_on(left, right, "k", "rk", how)
    plain = join_on(left, right, "k", "rk", how, skew_safe=False)
    assert _rows(ours) == _rows(plain)


@pytest.mark.parametrize("how", ["left", "right", "full"])
def test_pair_join_outer_matches_plain(frames, how):
    p, b, _ = frames
    ours = join_with(p, b, "band", "id", how)
    plain = join_with(p, b, "band", "id", how, skew_safe=False)
    assert _rows(ours) == _rows(plain)
    assert "Nested" not in _plan(ours) and "LeftOuter" not in _plan(ours)


@pytest.mark.parametrize("how", ["inner", "left", "right", "full"])
def test_using_and_drop_key_keep_the_key(spark, how):
    a = spark.createDataFrame([(1, "x"), (2, "y"), (None, "z")], "k long, a string")
    b = spark.createDataFrame([(2, "p"), (3, "q"), (None, "r")], "k long, b string")
    assert _rows(join_using(a, b, "k", how=how)) == _rows(a.join(b, "k", how))
    dropped = join_drop_right_key(a, b, "k", "k", how)
    assert dropped.columns == ["k", "a", "b"] and _rows(dropped) == _rows(a.join(b, "k", how))
    assert "Outer" not in _plan(join_using(a, b, "k", how=how))
