import math
import random
import statistics

import pytest
from pyspark.sql import functions as F

from tablekit.operators import rollups as R
from tablekit.operators.needles import bounded, find_needles
from tablekit.operators.topk import with_row_number


def test_sketches_are_rolled_up_without_the_rows(spark):
    rows = [(d, i) for d in range(30) for i in range(d * 50, d * 50 + 400)] + [(3, None)]
    df = spark.createDataFrame(rows, "day int, v long").repartition(7)
    merged = R.merge_sketches(R.distinct_sketches(df, ["day"], "v"), [(F.col("day") >= 15).alias("late")])
    got = {r.late: r.estimate for r in merged.collect()}
    assert got[False] == pytest.approx(14 * 50 + 400, rel=0.07) and got[True] == pytest.approx(14 * 50 + 400, rel=0.07)
    again = R.merge_sketches(R.merge_sketches(R.distinct_sketches(df, ["day"], "v"), ["day"]), [])
    assert again.first().estimate == pytest.approx(29 * 50 + 400, rel=0.07)


def test_bitmaps_count_exactly(spark):
    rng = random.Random(1)
    rows = [(rng.randrange(4), rng.randrange(3), rng.choice([rng.randrange(100), rng.randrange(200_000), -rng.randrange(50_000)]))
            for _ in range(5000)] + [(0, 0, None), (9, 9, None)]
    df = spark.createDataFrame(rows, "a int, b int, v long").repartition(5)
    maps = R.distinct_bitmaps(df, ["a", "b"], "v")
    want = lambda *by: {r[:-1]: r[-1] for r in map(tuple, df.where("v IS NOT NULL").groupBy(*by).agg(
        F.count_distinct("v")).collect())}
    got = lambda *by: {tuple(r)[:-1]: r.n for r in R.count_bitmaps(maps, by).collect()}
    assert got("a", "b") == want("a", "b") and got("a") == want("a")
    assert R.count_bitmaps(R.merge_bitmaps(maps, ["b"]), ["b"]).count() == 3


@pytest.mark.parametrize("shift", [0.0, 1e9])
def test_moments_merge_to_the_direct_values(spark, shift):
    rng = random.Random(2)
    rows = [(i % 3, i % 11, shift + rng.gauss(0, 5), rng.random() * 3) for i in range(900)] + [(0, 1, None, 1.0), (5, 1, shift, 2.0)]
    df = spark.createDataFrame(rows, "g int, part int, x double, y double")
    s = F.col("state")
    got = R.merge_moments(R.moments(df, ["g", "part"], "x", "y"), ["g"]).select(
        "g", s["n"].alias("n"), R.deviation(s).alias("d"), R.correlation(s).alias("c")).collect()
    for r in got:
        x, y = zip(*[(a - shift, b) for g, _, a, b in rows if g == r.g and a is not None])
        assert r.n == len(x)
        if len(x) == 1:
            assert r.d is None and r.c is None
            continue
        assert r.d == pytest.approx(statistics.stdev(x), rel=1e-8) and r.c == pytest.approx(statistics.correlation(x, y), abs=1e-8)
    assert len(got) == 4 and not any(math.isnan(r.d or 0) for r in got)


def test_row_numbers_are_contiguous_in_one_order(spark):
    rng = random.Random(3)
    rows = [(i, rng.choice([None, 1, 2, 3, 500]), "x") for i in range(2000)]
    df = spark.createDataFrame(rows, "id long, `a b` int, part string").repartition(6)
    out = with_row_number(df, F.col("`a b`").desc_nulls_last(), F.col("id"), partitions=9)
    assert out.columns == ["id", "a b", "part", "row_number"]
    want = [r[0] for r in sorted(rows, key=lambda r: (r[1] is None, -(r[1] or 0), r[0]))]
    assert [r.id for r in sorted(out.collect(), key=lambda r: r.row_number)] == want
    assert sorted(r.row_number for r in out.collect()) == list(range(1, 2001))
    assert "Window" not in out._jdf.queryExecution().optimizedPlan().toString()
    assert with_row_number(df.limit(0), F.col("id")).collect() == []


def test_needles_equal_the_tests_one_by_one(spark):
    rng = random.Random(4)
    word = lambda n: "".join(rng.choice("abcé ") for _ in range(n))
    texts = [word(rng.randrange(60)) for _ in range(200)] + [None, ""]
    needles = [word(rng.randrange(1, 5)) for _ in range(300)] + ["", None, "abc", "abca"]
    df = spark.createDataFrame([(i, t, ["old"]) for i, t in enumerate(texts)], "id long, text string, needles array<string>")
    rows = find_needles(df, "text", spark.createDataFrame([(n,) for n in needles], "w string")).collect()
    assert len(rows) == len(texts)
    for r in rows:
        want = None if texts[r.id] is None else sorted({n for n in needles if n is not None and n in texts[r.id]})
        assert r.needles == want
    assert {tuple(r.needles or ()) for r in find_needles(df, "text", []).collect()} == {()}


def test_too_many_needles_are_refused(monkeypatch):
    from tablekit.operators import needles
    monkeypatch.setattr(needles, "MAX_NEEDLES", 3)
    with pytest.raises(ValueError):
        bounded(["a", "b", "c", "d"])
