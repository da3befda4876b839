import datetime as dt

import pytest
from pyspark.sql import functions as F

from tablekit.functions.predicates import any_of, contains_any, regex_any, regex_alternation
from tablekit.functions.scalars import age_years, element_at0, parse_date, row_sum
from tablekit.operators.project import union_by_name, union_positional


def test_split_keeps_empty_parts(spark):
    df = spark.createDataFrame([("Love, Actually x",)], "t string")
    assert df.select(F.split("t", " |,")).collect()[0][0] == ["Love", "", "Actually", "x"]


def test_two_digit_year_pivot(spark):
    df = spark.createDataFrame([("12-Jun-98",), ("Unknown",), ("3-Jan-05",)], "s string")
    got = [r[0] for r in df.select(parse_date("s", "d-MMM-yy", as_of="2026-01-01")).collect()]
    assert got == [dt.date(1998, 6, 12), None, dt.date(2005, 1, 3)]
    raw = [r[0] for r in df.select(parse_date("s", "d-MMM-yy")).collect()]
    assert raw[0] == dt.date(2098, 6, 12)


def test_long_date_format(spark):
    df = spark.createDataFrame([("Feb 1 2009",), ("bad",)], "s string")
    assert [r[0] for r in df.select(parse_date("s", "MMM d yyyy")).collect()] == [dt.date(2009, 2, 1), None]


def test_age_positive_for_past(spark):
    df = spark.createDataFrame([(dt.date(2025, 1, 1),)], "d date")
    assert df.select(age_years("d", "2026-01-01")).collect()[0][0] == pytest.approx(1.0)


def test_initcap_splits_on_blank_only(spark):
    df = spark.createDataFrame([("rebel-sst wAgon",)], "s string")
    assert df.select(F.initcap("s")).collect()[0][0] == "Rebel-sst Wagon"


def test_out_of_range_and_null_array(spark):
    df = spark.createDataFrame([(["a", "b"],), (None,)], "a array<string>")
    got = df.select(element_at0("a", 0).alias("x"), element_at0("a", 9).alias("y"),
                    F.size("a").alias("n")).collect()
    assert (got[0].x, got[0].y, got[0].n) == ("a", None, 2)
    assert got[1].n is None  # ANSI: size(NULL) is NULL


def test_regex_items_are_escaped(spark):
    df = spark.createDataFrame([("a.c",), ("abc",), ("x+y",)], "s string")
    assert regex_alternation(["a.c", "x+y"]) == r"a\.c|x\+y"
    got = sorted(r.s for r in df.where(regex_any("s", ["a.c", "x+y"])).collect())
    assert got == ["a.c", "x+y"]


def test_empty_list_matches_nothing(spark):
    df = spark.createDataFrame([("abc",)], "s string")
    assert df.where(contains_any("s", [])).count() == 0
    assert df.where(regex_any("s", [])).count() == 0
    assert df.where(any_of([])).count() == 0


def test_contains_any_equals_regex_any(spark):
    df = spark.createDataFrame([("Volkswagen Golf",), ("ford focus",), ("Audi",)], "s string")
    names = ["Volkswagen", "Ford"]
    a = sorted(r.s for r in df.where(contains_any("s", names, lower=True)).collect())
    b = sorted(r.s for r in df.where(regex_any(F.lower("s"), names, lower=True)).collect())
    assert a == b == ["Volkswagen Golf", "ford focus"]


def test_row_sum_null_propagates(spark):
    df = spark.createDataFrame([(1, 2, 3), (1, None, 3)], "a int, b int, c int")
    assert [r[0] for r in df.select(row_sum(["a", "b", "c"])).collect()] == [6, None]
    assert [r[0] for r in df.select(row_sum(["a", "b", "c"], skip_nulls=True)).collect()] == [6, 4]


def test_sql_literal_decimal_trap(spark):
    df = spark.createDataFrame([(100,)], "w long")
    assert df.selectExpr("w / 2.2").schema[0].dataType.simpleString().startswith("decimal")
    assert df.selectExpr("w / 2.2D").schema[0].dataType.simpleString() == "double"


def test_union_positional_widens_and_refuses_strings(spark):
    a = spark.createDataFrame([(1, 1.5)], "k long, v double")
    b = spark.createDataFrame([(2, 3)], "k long, v long")
    out = union_positional(a, b)
    assert out.schema["v"].dataType.simpleString() == "double" and out.count() == 2
    c = spark.createDataFrame([("x", 3)], "k string, v long")
    with pytest.raises(TypeError):
        union_positional(a, c)
    d = spark.createDataFrame([(2.5, 4)], "v double, k long")
    assert sorted(r.k for r in union_by_name(a, d).collect()) == [1, 4]


def test_struct_field_access(spark):
    df = spark.createDataFrame([("t", 1, 2)], "title string, us long, ww long")
    s = df.selectExpr("title", "(us, ww) AS profit").selectExpr("profit.us")
    assert s.collect()[0][0] == 1


def test_flag_three_valued(spark):
    from tablekit.operators.project import where_flag, with_flag
    df = spark.createDataFrame([(1, True), (2, False), (3, None)], "id int, g boolean")
    f = with_flag(df, ["id"], F.col("g"), "flag")
    assert [r.id for r in where_flag(f, "flag").collect()] == [1]
    assert [r.id for r in where_flag(f, "flag", value=False).collect()] == [2]


def test_empty_needle_matches_like_contains(spark):
    df = spark.createDataFrame([("abc",), ("",), (None,)], "s string")
    a = df.where(contains_any("s", ["zz", ""])).count()
    b = df.where(regex_any("s", ["zz", ""])).count()
    assert a == b == 2


def test_pivot_leaves_full_years_alone(spark):
    from tablekit.functions.scalars import parse_date
    row = spark.createDataFrame([("Feb 1 2030", "1-Feb-30")], "a string, b string").select(
        parse_date("a", "MMM d yyyy", as_of="2026-01-01").cast("string").alias("a"),
        parse_date("b", "d-MMM-yy", as_of="2026-01-01").cast("string").alias("b")).first()
    assert tuple(row) == ("2030-02-01", "1930-02-01")
