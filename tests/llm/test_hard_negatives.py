import math
import random

import duckdb
import pytest
from pyspark.sql import functions as F

from tablekit.llm import hard_negatives as H
from tests.conftest import SF_SMALL

SCHEMA = "vec_id long, embedding array<double>, label int, anchor_id string"


def brute(rows, is_anchor, rule=H.Rule()):
    """Every anchor row against every other row, straight from the definition."""
    used = []
    for i, v, label, *_ in rows:
        if i is not None and label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            used.append((i, [math.floor(256 * x) for x in v], label))
    out = []
    for a, (i, v, label) in enumerate(used):
        if not is_anchor(i):
            continue
        others = [(max(-H.LIMIT, min(H.LIMIT, sum(x * y for x, y in zip(v, w)))), j, m)
                  for b, (j, w, m) in enumerate(used) if b != a]
        others.sort(key=lambda e: (-e[0], e[1]))
        for p, j, _ in [e for e in others if e[2] == label][:rule.positives]:
            fit = [e for e in others if e[2] != label and rule.low * p <= 100 * e[0] <= rule.high * p][:rule.negatives]
            out += [(i, j, k + 1, n, p, s) for k, (s, n, _) in enumerate(fit)]
    return sorted(out)


def mined(spark, rows, **options):
    frame = spark.createDataFrame([(*r, "x")[:4] for r in rows], SCHEMA).repartition(5)
    return sorted(map(tuple, H.mine(frame, F.col("id") % 10 == 0, **options).collect()))


def some_rows(n, seed, width=6):
    rng, rows = random.Random(seed), []
    for i in range(n):
        v = [rng.choice([0.0, 0.25, 0.5, 1.0, -0.25]) + rng.choice([0, 0.01]) * rng.random() for _ in range(width)]
        if rows and rng.random() < 0.4:
            v = rng.choice(rows)[1]
        rows.append((i, v, rng.randrange(3)))
    return rows


@pytest.mark.parametrize("seed", range(3))
def test_equals_brute_force(spark, seed):
    rows = some_rows(120, seed)
    assert mined(spark, rows) == brute(rows, lambda i: i % 10 == 0)


def test_blocks_of_anchors_and_other_rules(spark):
    rows, rule = some_rows(90, 7), H.Rule(positives=2, negatives=3, low=50, high=90)
    assert mined(spark, rows, rule=rule, block_bytes=200) == brute(rows, lambda i: i % 10 == 0, rule)
    with pytest.raises(ValueError):
        H.Rule(high=101)


def test_small_chunks_keep_everything(spark, monkeypatch):
    rows = some_rows(150, 3)
    want = brute(rows, lambda i: i % 10 == 0)
    anchors = [r for r in rows if r[0] % 10 == 0]
    monkeypatch.setattr(H, "SCORES", 4 * len(anchors))     # four rows at a time
    held = H._anchors(spark.createDataFrame(
        [(i, label, [float(math.floor(256 * x)) for x in v], 1) for i, v, label in anchors],
        "id long, label long, vector array<double>, copies long").toArrow())
    batch = spark.createDataFrame([(i, label, [float(math.floor(256 * x)) for x in v]) for i, v, label in rows],
                                  "id long, label long, vector array<double>").toArrow().combine_chunks().to_batches()

    def entries(opened):
        found = list(H.candidates(iter(batch), held, H.Rule(), opened))
        return sorted((k, n) for b in found for k, n in zip(b.column("key").to_pylist(), b.column("kind").to_pylist()))

    opened = H.np.full((len(anchors), 5), H.LIMIT + 1)
    for a, got, score, k in H.walk(iter(entries(None)), H.Rule()):
        if got is None:
            opened[a, k - 1] = score
    out = [(int(held.ids[a]), *got) for a, got, _, _ in H.walk(iter(entries(opened)), H.Rule()) if got]
    assert sorted(out) == want


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 1.0], 1), (0, [1.0, 1.0], 1), (0, [0.5, 1.0], 1), (10, [1.0], 2), (20, [], 1), (30, None, 1),
            (40, [None, 1.0], 1), (50, [nan, 1.0], 1), (60, [inf, 1.0], 1), (None, [1.0, 1.0], 1), (70, [1.0, 1.0], None),
            (1, [1.0, 1.0, 9.0], 1), (2, [0.9, 1.0], 2), (2, [0.9, 1.0], 2), (3, [1.0, 0.9], 2), (4, [-1.0, -1.0], 2),
            (80, [1e200, 1.0], 1), (90, [-1e303, 1e304], 2), (5, [0.0, 0.0], 2), (100, [0.0, 0.0], 1)]
    assert mined(spark, rows) == brute(rows, lambda i: i % 10 == 0)
    assert mined(spark, []) == []
    assert mined(spark, [(10, [1.0], 1)]) == []


def test_query_equals_sql(spark):
    frame = spark.read.parquet(f"{SF_SMALL}/embeddings.parquet")
    con = duckdb.connect()
    con.sql(f"CREATE VIEW embeddings AS SELECT * FROM '{SF_SMALL}/embeddings.parquet'")
    want = con.sql(H.MINE_SQL)
    got = H.op13_rows(frame)
    assert got.columns == want.columns
    assert sorted(map(tuple, got.collect())) == sorted(want.fetchall()) != []
