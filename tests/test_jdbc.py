"""JDBC source, sink and keyed merge against in-memory Derby (in-process, no server)."""

import uuid

import pytest
from pyspark.sql import functions as F

from tablekit.operators.upsert import change_set
from tablekit.sinks.jdbc import merge_into_jdbc, merge_statement
from tablekit.sinks.writers import write_jdbc
from tablekit.sources.readers import read_jdbc
from tests.fixtures import EMPLOYEES, EMPLOYEES_SCHEMA

DRIVER = "org.apache.derby.iapi.jdbc.AutoloadedDriver"
TYPES = "first_name VARCHAR(64), last_name VARCHAR(64), gender VARCHAR(8)"


@pytest.fixture
def db():
    return f"jdbc:derby:memory:tk{uuid.uuid4().hex[:8]};create=true"


def _props():
    return {"driver": DRIVER}


def test_write_read_partitioned(spark, db):
    emp = spark.createDataFrame(EMPLOYEES, EMPLOYEES_SCHEMA)
    write_jdbc(emp, db, "employees", properties=_props(), column_types=TYPES)
    back = read_jdbc(spark, db, "employees", driver=DRIVER)
    assert back.count() == 4
    part = read_jdbc(spark, db, "employees", driver=DRIVER, partition_column="emp_no",
                     lower_bound=1, upper_bound=5, num_partitions=2)
    assert part.rdd.getNumPartitions() == 2 and part.count() == 4
    # A pushed equality filter works on VARCHAR columns.
    assert back.where(F.col("gender") == "F").count() == 2


def test_merge_upsert(spark, db):
    emp = spark.createDataFrame(EMPLOYEES, EMPLOYEES_SCHEMA)
    write_jdbc(emp, db, "employees", properties=_props(), column_types=TYPES)
    ch = change_set(emp, "gender == 'F'", {"gender": F.regexp_replace("gender", "F", "M")})
    new = spark.createDataFrame([(9, None, "Ny", "New", "F", None)], EMPLOYEES_SCHEMA)
    n = merge_into_jdbc(spark, ch.unionByName(new), db, "employees", "emp_no", properties=_props(),
                        column_types=TYPES, writers=2)
    assert n == 3
    rows = {r.emp_no: r for r in read_jdbc(spark, db, "employees", driver=DRIVER).collect()}
    assert len(rows) == 5 and rows[1].gender == "M" and rows[9].last_name == "New"
    # Update only: a new key is not inserted.
    more = spark.createDataFrame([(2, None, "Bo", "Changed", "M", None), (10, None, "X", "Y", "M", None)],
                                 EMPLOYEES_SCHEMA)
    merge_into_jdbc(spark, more, db, "employees", "emp_no", properties=_props(), column_types=TYPES,
                    update_only=True)
    rows = {r.emp_no: r for r in read_jdbc(spark, db, "employees", driver=DRIVER).collect()}
    assert len(rows) == 5 and rows[2].last_name == "Changed"


def test_merge_statement_text():
    s = merge_statement("t", "s", ["k"], ["k", "a"])
    assert s.startswith('MERGE INTO t t USING s s ON t."k" = s."k"')
    assert 'WHEN NOT MATCHED THEN INSERT ("k", "a") VALUES (s."k", s."a")' in s
    m = merge_statement("t", "s", ["k"], ["k", "a"], dialect="mysql")
    assert "ON DUPLICATE KEY UPDATE `a` = VALUES(`a`)" in m
    with pytest.raises(ValueError):
        merge_statement("t; drop", "s", ["k"], ["k"])


def test_transfer_jdbc_tables_to_views_and_warehouse(spark, db):
    from tablekit.sinks.writers import transfer_tables
    emp = spark.createDataFrame(EMPLOYEES, EMPLOYEES_SCHEMA)
    write_jdbc(emp, db, "emp_src", properties=_props(), column_types=TYPES)
    write_jdbc(emp.select("emp_no").withColumn("dept_no", F.lit("d1")), db, "dept_src", properties=_props())
    transfer_tables(spark, lambda n: read_jdbc(spark, db, n, driver=DRIVER), ["emp_src", "dept_src"],
                    to_warehouse=True)
    got = spark.sql("SELECT count(*) FROM emp_src e JOIN dept_src d ON e.emp_no = d.emp_no").collect()[0][0]
    assert got == 4
    assert spark.catalog.tableExists("default.emp_src")
    assert spark.table("default.dept_src").count() == 4


def test_merge_drops_its_staging_table(spark, db):
    emp = spark.createDataFrame(EMPLOYEES, EMPLOYEES_SCHEMA)
    write_jdbc(emp, db, "emp_t", properties=_props(), column_types=TYPES)
    merge_into_jdbc(spark, emp.where("emp_no = 1"), db, "emp_t", "emp_no", properties=_props(), column_types=TYPES)
    tables = read_jdbc(spark, db, "(SELECT tablename FROM sys.systables WHERE tabletype = 'T') t",
                       driver=DRIVER).collect()
    names = {r[0] for r in tables}
    assert "EMP_T" in names and not any(n.startswith("EMP_T_STG") for n in names)


def test_merge_duplicate_keys(spark, db):
    emp = spark.createDataFrame(EMPLOYEES, EMPLOYEES_SCHEMA)
    write_jdbc(emp, db, "emp_d", properties=_props(), column_types=TYPES)
    dup = emp.where("emp_no = 1").withColumn("v", F.lit(1)).unionByName(
        emp.where("emp_no = 1").withColumn("last_name", F.lit("Later")).withColumn("v", F.lit(2)))
    with pytest.raises(ValueError):
        merge_into_jdbc(spark, dup.drop("v"), db, "emp_d", "emp_no", properties=_props(), column_types=TYPES)
    merge_into_jdbc(spark, dup, db, "emp_d", "emp_no", properties=_props(), column_types=TYPES,
                    order_by=["v"])
    rows = {r.emp_no: r for r in read_jdbc(spark, db, "emp_d", driver=DRIVER).collect()}
    assert rows[1].last_name == "Later" and len(rows) == 4


def test_merge_checks_its_columns(spark, db):
    emp = spark.createDataFrame(EMPLOYEES, EMPLOYEES_SCHEMA)
    write_jdbc(emp, db, "emp_c", properties=_props(), column_types=TYPES)
    one = emp.where("emp_no = 1")
    for bad in (one.drop("gender"), one.withColumn("extra", F.lit(1))):
        with pytest.raises(ValueError, match="columns"):
            merge_into_jdbc(spark, bad, db, "emp_c", "emp_no", properties=_props(), column_types=TYPES)
    # Names are matched in any case and written as the target has them.
    upper = one.withColumn("last_name", F.lit("Upper")).toDF(*[c.upper() for c in one.columns])
    merge_into_jdbc(spark, upper, db, "emp_c", "EMP_NO", properties=_props(), column_types=TYPES)
    rows = {r.emp_no: r for r in read_jdbc(spark, db, "emp_c", driver=DRIVER).collect()}
    assert len(rows) == 4 and rows[1].last_name == "Upper"
    write_jdbc(emp.select("emp_no"), db, "emp_k", properties=_props())
    with pytest.raises(ValueError, match="besides the key"):
        merge_into_jdbc(spark, one.select("emp_no"), db, "emp_k", "emp_no", properties=_props(), update_only=True)
