import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from tablekit.sinks.writers import save_as_table


def test_take_and_is_empty(spark):
    df = spark.range(100)
    assert len(df.take(10)) == 10
    assert not df.isEmpty() and df.where("id < 0").isEmpty()


def test_current_date_is_today_but_as_of_is_fixed(spark):
    row = spark.range(1).select(F.current_date().alias("d"), F.current_timestamp().alias("t")).collect()[0]
    assert abs((row.d - dt.date.today()).days) <= 1
    from tablekit.functions.scalars import age_years
    a = spark.range(1).select(age_years(F.lit(dt.date(2016, 1, 1)), "2026-01-01")).collect()[0][0]
    assert a == pytest.approx(3653 / 365)


def test_week_year_pattern_is_refused(spark):
    df = spark.createDataFrame([("2020-05-17",)], "s string")
    with pytest.raises(Exception):
        df.select(F.to_date("s", "YYYY-MM-dd")).collect()
    assert df.select(F.to_date("s", "yyyy-MM-dd")).collect()[0][0] == dt.date(2020, 5, 17)


def test_managed_table_lands_in_warehouse(spark):
    save_as_table(spark.range(3), "tk_wh_check")
    wh = spark.conf.get("spark.sql.warehouse.dir").replace("file:", "")
    assert os.path.isdir(os.path.join(wh, "tk_wh_check"))


def test_repartition_is_round_robin_and_even(spark):
    df = spark.range(0, 1000, numPartitions=1).repartition(10)
    sizes = df.groupBy(F.spark_partition_id().alias("p")).count().collect()
    assert len(sizes) == 10 and all(90 <= r["count"] <= 110 for r in sizes)
