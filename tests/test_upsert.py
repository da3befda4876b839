import pytest
from pyspark.sql import functions as F

from tablekit.operators.upsert import change_set, classify, dedup_changes, update_matched, upsert
from tests.fixtures import EMPLOYEES, EMPLOYEES_SCHEMA


@pytest.fixture
def emp(spark):
    return spark.createDataFrame(EMPLOYEES, EMPLOYEES_SCHEMA)


def _changes(spark, emp):
    ch = change_set(emp, "gender == 'F'", {"gender": F.regexp_replace("gender", "F", "M")})
    new = spark.createDataFrame([(9, None, "Ny", "New", "F", None)], EMPLOYEES_SCHEMA)
    return ch.unionByName(new)


def test_change_set_keeps_columns(spark, emp):
    ch = change_set(emp, "gender == 'F'", {"gender": F.regexp_replace("gender", "F", "M")})
    assert ch.columns == emp.columns
    assert sorted((r.emp_no, r.gender) for r in ch.collect()) == [(1, "M"), (3, "M")]


def test_classify(spark, emp):
    got = {r.emp_no: r.op for r in classify(_changes(spark, emp), emp, "emp_no").collect()}
    assert got == {1: "UPDATE", 3: "UPDATE", 9: "INSERT"}


def test_upsert_and_idempotence(spark, emp):
    ch = _changes(spark, emp)
    once = upsert(emp, ch, "emp_no")
    twice = upsert(once, ch, "emp_no")
    assert sorted(once.collect()) == sorted(twice.collect())
    rows = {r.emp_no: r for r in once.collect()}
    assert len(rows) == 5 and rows[1].gender == "M" and rows[2].gender == "M"
    # The change row wins whole, NULLs included.
    assert rows[9].birth_date is None


def test_update_only_ignores_new_keys(spark, emp):
    out = {r.emp_no for r in update_matched(emp, _changes(spark, emp), "emp_no").collect()}
    assert out == {1, 2, 3, 4}


def test_duplicate_keys_need_order(spark, emp):
    ch = _changes(spark, emp)
    dup = ch.unionByName(ch.where("emp_no = 1").withColumn("last_name", F.lit("Second")))
    with pytest.raises(ValueError):
        upsert(emp, dup, "emp_no").collect()
    versioned = ch.withColumn("v", F.lit(1)).unionByName(
        ch.where("emp_no = 1").withColumn("last_name", F.lit("Second")).withColumn("v", F.lit(2)))
    out = {r.emp_no: r for r in upsert(emp, versioned, "emp_no", order_by=["v"]).collect()}
    assert out[1].last_name == "Second" and len(out) == 5


def test_dedup_changes_hot_key(spark):
    rows = [(1, i, f"x{i}") for i in range(999)] + [(2, 0, "y")]
    df = spark.createDataFrame(rows, "k long, v long, s string")
    got = {r.k: r.s for r in dedup_changes(df, "k", ["v"]).collect()}
    assert got == {1: "x998", 2: "y"}


def test_bucketed_target_is_not_shuffled(spark):
    from tablekit.sinks.writers import save_bucketed
    orders = spark.read.parquet("/root/testdata/sf0.001/orders.parquet")
    save_bucketed(orders, "tk_orders_bucketed", "o_orderkey", 8)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        target = spark.table("tk_orders_bucketed")
        changes = orders.where("o_orderstatus = 'O'").withColumn("o_orderstatus", F.lit("F"))
        out = upsert(target, changes, "o_orderkey", validate=False)
        plan = out._jdf.queryExecution().executedPlan().toString()
        scan_lines = [i for i, line in enumerate(plan.splitlines()) if "tk_orders_bucketed" in line]
        lines = plan.splitlines()
        # The line above the bucketed scan is not an Exchange.
        assert scan_lines and all("Exchange" not in lines[i - 1] for i in scan_lines)
        assert out.count() == orders.count()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_odd_column_names(spark):
    from tablekit.operators.aggregate import latest_per_key
    from tablekit.operators.joins import array_join
    from tablekit.operators.topk import top_k
    df = spark.createDataFrame([(1, 10, 1.5), (1, 20, 2.5), (2, 5, 9.0)], "`k`: int, `t.x`: int, `w in lbs`: double")
    got = sorted(tuple(r) for r in latest_per_key(df, "k", ["t.x"]).collect())
    assert got == [(1, 20, 2.5), (2, 5, 9.0)]
    ch = spark.createDataFrame([(2, 6, None), (3, 1, 1.0)], "`k`: int, `t.x`: int, `w in lbs`: double")
    assert upsert(df.where("k = 2"), ch, "k").count() == 2
    assert update_matched(df.where("k = 2"), ch, "k").collect()[0]["w in lbs"] is None
    assert top_k(df, 1, ["t.x desc"], ["k"]).collect()[0]["t.x"] == 20
    arr = spark.createDataFrame([(1, ["a b"])], "`id x`: int, `the words`: array<string>")
    voc = spark.createDataFrame([("a b",), ("z",)], "`w.v`: string")
    full = array_join(arr, voc, "the words", "w.v", "full", left_key="id x", right_key="w.v")
    assert full.count() == 2


def test_every_target_row_of_a_key_is_updated(spark):
    target = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c")], "k long, v string")
    changes = spark.createDataFrame([(1, "new"), (3, "x")], "k long, v string")
    assert sorted(tuple(r) for r in update_matched(target, changes, "k").collect()) == [(1, "new"), (1, "new"), (2, "c")]
    assert sorted(tuple(r) for r in upsert(target, changes, "k").collect()) == [(1, "new"), (1, "new"), (2, "c"), (3, "x")]


@pytest.mark.parametrize("stream", [True, False])
def test_both_forms_of_upsert(spark, stream):
    """Null keys match nothing, a key that the target holds twice is updated twice."""
    t = spark.createDataFrame([(1, "a", 1), (1, "b", 2), (None, "c", 3), (2, "d", 4)], "k long, `odd.name` string, n int")
    c = spark.createDataFrame([(1, "x", None), (None, "y", 6), (5, "z", 7)], t.schema)
    got = upsert(t, c, "k", stream_target=stream)
    assert got.columns == t.columns
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, [
        (1, "x", None), (1, "x", None), (None, "c", 3), (2, "d", 4), (None, "y", 6), (5, "z", 7)]))


def test_upsert_reads_each_side_once(spark, tmp):
    spark.range(1000).selectExpr("id AS k", "id * 2 AS v").write.parquet(f"{tmp}/t")
    spark.range(900, 1100).selectExpr("id AS k", "id AS v", "1 AS version").write.parquet(f"{tmp}/c")
    t, c = spark.read.parquet(f"{tmp}/t"), spark.read.parquet(f"{tmp}/c")
    plan = upsert(t, c, "k", order_by=["version"])._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Aggregate [") == 1 and plan.count("Relation [") == 2 and plan.count("Join FullOuter") == 1
    small = upsert(spark.read.parquet(f"{tmp}/t", f"{tmp}/t", *[f"{tmp}/t"] * 30), c, "k", order_by=["version"])
    assert "FullOuter" not in small._jdf.queryExecution().optimizedPlan().toString()
