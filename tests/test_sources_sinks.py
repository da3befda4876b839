import datetime as dt
import glob

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import types as T

from tablekit.sinks.writers import (
    num_partitions, save_as_table, transfer_tables, with_files, write_csv, write_json, write_parquet,
)
from tablekit.sources.conform import conform
from tablekit.sources.readers import (
    from_rows, read_csv, read_delimited_text, read_json, read_text, read_with_options, schema_of, split_corrupt,
)


def _write(path, text):
    with open(path, "w") as f:
        f.write(text)
    return path


CARS = ('{"Name":"alpha","Miles_per_Gallon":18.5,"Cylinders":8,"Year":"1970-01-01","Origin":"USA"}\n'
        '{"Name":"beta","Miles_per_Gallon":null,"Cylinders":4,"Year":"1971-01-01","Origin":"Japan"}\n')


def test_json_inferred_alphabetical(spark, tmp):
    p = _write(f"{tmp}/cars.json", CARS)
    df = read_json(spark, p)
    assert df.columns == sorted(df.columns) and df.count() == 2


def test_json_explicit_schema_and_date_format(spark, tmp):
    p = _write(f"{tmp}/cars.json", CARS)
    schema = T.StructType([T.StructField("Name", T.StringType()), T.StructField("Cylinders", T.LongType()),
                           T.StructField("Year", T.DateType())])
    df = read_json(spark, p, schema=schema, dateFormat="yyyy-MM-dd")
    assert df.schema == schema
    assert df.where("Name = 'alpha'").collect()[0].Year == dt.date(1970, 1, 1)


def test_parse_modes(spark, tmp):
    p = _write(f"{tmp}/m.json", '{"a":1,"b":"x"}\n{"a":2,"b":"y"}\n{"a":"oops","b":"z"}\n{"a":3,\n')
    schema = "a long, b string"
    assert len(read_json(spark, p, schema=schema, mode="PERMISSIVE").collect()) == 4
    # Rows are judged on the columns actually read: collect, not count().
    assert len(read_json(spark, p, schema=schema, mode="DROPMALFORMED").collect()) == 2
    with pytest.raises(Exception):
        read_json(spark, p, schema=schema, mode="FAILFAST").collect()
    q = read_json(spark, p, schema="a long, b string, _bad string", corrupt_column="_bad")
    good, bad = split_corrupt(q, "_bad")
    assert len(good.collect()) == 2 and len(bad.collect()) == 2


def test_options_map_with_path(spark, tmp):
    p = _write(f"{tmp}/cars.json", CARS)
    df = read_with_options(spark, "json", {"path": p, "mode": "FAILFAST"})
    assert df.count() == 2


STOCKS = "symbol,date,price\nMSFT,Jan 1 2000,39.81\nMSFT,Feb 1 2009,15.81\nabc,Mar 1 2000,NA\n"


def test_csv_schema_sep_null_and_date(spark, tmp):
    p = _write(f"{tmp}/stocks.csv", STOCKS.replace(",", "|"))
    schema = T.StructType([T.StructField("symbol", T.StringType()), T.StructField("date", T.DateType()),
                           T.StructField("price", T.DoubleType())])
    df = read_csv(spark, p, schema=schema, sep="|", null_value="NA", date_format="MMM d yyyy")
    rows = df.orderBy("date").collect()
    assert rows[0].date == dt.date(2000, 1, 1) and rows[-1].price == 15.81
    assert df.where("price IS NULL").count() == 1


def test_csv_inferred(spark, tmp):
    p = _write(f"{tmp}/stocks.csv", STOCKS.replace("NA", "1.0"))
    df = read_csv(spark, p)
    assert dict(df.dtypes)["price"] == "double" and df.count() == 3


def test_text_and_delimited_text_keep_lowercase_symbols(spark, tmp):
    p = _write(f"{tmp}/stocks.csv", STOCKS)
    assert read_text(spark, p).count() == 4
    df = read_delimited_text(spark, p, ["symbol", "date", "price"], ["string", "string", "double"])
    rows = df.collect()
    assert len(rows) == 3 and {r.symbol for r in rows} == {"MSFT", "abc"}
    assert [r.price for r in rows if r.symbol == "abc"] == [None]


def test_from_rows_and_schema_reuse(spark, tmp):
    first = from_rows(spark, [("iPhone", "X", "iOS", 12)], ["name", "model", "platform", "mp"])
    again = from_rows(spark, [("Pixel", "7", "Android", 50)], schema_of(first))
    assert again.schema == first.schema


def test_conform_casts_and_checks(spark):
    df = spark.createDataFrame([("1", "2.5", None), ("2", "x", "a")], "k string, v string, extra string")
    schema = T.StructType([T.StructField("v", T.DoubleType()), T.StructField("k", T.LongType(), False)])
    out = conform(df, schema, try_cast=True)
    assert out.columns == ["v", "k"]
    assert sorted((tuple(r) for r in out.collect()), key=repr) == [(2.5, 1), (None, 2)]
    bad = spark.createDataFrame([(None,)], "k string")
    with pytest.raises(Exception):
        conform(bad, T.StructType([T.StructField("k", T.LongType(), False)])).collect()
    assert conform(conform(df, schema, try_cast=True), schema).collect() == out.collect()


def test_save_modes(spark, tmp):
    df = spark.range(3)
    out = f"{tmp}/j"
    write_json(df, out, mode="overwrite")
    with pytest.raises(AnalysisException):
        write_json(df, out)  # errorifexists
    write_json(df, out, mode="ignore")
    assert spark.read.json(out).count() == 3
    write_json(df, out, mode="append")
    assert spark.read.json(out).count() == 6
    write_json(df, out, mode="overwrite")
    assert spark.read.json(out).count() == 3


def test_parquet_csv_round_trip(spark, tmp):
    df = spark.createDataFrame([(1, "a\tb"), (2, None)], "k long, s string")
    write_parquet(df, f"{tmp}/p", mode="overwrite")
    assert sorted(spark.read.parquet(f"{tmp}/p").collect()) == sorted(df.collect())
    write_csv(df, f"{tmp}/c", mode="overwrite", sep="\t")
    back = read_csv(spark, f"{tmp}/c", schema="k long, s string", sep="\t")
    assert sorted(back.collect(), key=lambda r: r.k) == sorted(df.collect(), key=lambda r: r.k)


def test_file_counts(spark, tmp):
    df = spark.range(0, 1000, numPartitions=4)
    write_parquet(with_files(df, 10), f"{tmp}/ten", mode="overwrite")
    assert len(glob.glob(f"{tmp}/ten/part-*.parquet")) == 10
    write_parquet(with_files(df, 2, shuffle=False), f"{tmp}/two", mode="overwrite")
    assert len(glob.glob(f"{tmp}/two/part-*.parquet")) == 2
    assert num_partitions(with_files(df, 3, shuffle=False)) == 3


def test_managed_tables_and_transfer(spark):
    from tablekit.catalog import create_database, list_databases, table_exists
    create_database(spark, "tk_demo")
    create_database(spark, "tk_demo")  # re-run is fine
    assert "tk_demo" in [r.namespace for r in list_databases(spark).collect()]
    df = spark.range(5)
    save_as_table(df, "tk_demo.nums")
    save_as_table(df, "tk_demo.nums")  # repeat overwrite works
    assert spark.table("tk_demo.nums").count() == 5
    sources = {"t_a": spark.range(2), "t_b": spark.range(3)}
    transfer_tables(spark, sources.__getitem__, ["t_a", "t_b"])
    assert spark.sql("SELECT count(*) FROM t_b").collect()[0][0] == 3
    assert table_exists(spark, "tk_demo.nums")


def test_sql_on_temp_view(spark):
    from tablekit.catalog import register_view
    df = spark.createDataFrame([("a", 3), ("b", 8)], "label string, height int")
    register_view(df, "towers")
    assert [r.label for r in spark.sql("select label from towers where height > 5").collect()] == ["b"]


def test_json_compression_and_single_quotes(spark, tmp):
    df = spark.range(5).selectExpr("id", "CAST(id AS STRING) AS s")
    write_json(df, f"{tmp}/gz", mode="overwrite", compression="gzip")
    assert glob.glob(f"{tmp}/gz/part-*.json.gz")
    assert sorted(r.id for r in read_json(spark, f"{tmp}/gz", schema="id long, s string").collect()) == list(range(5))
    p = _write(f"{tmp}/q.json", "{'a': 1, 'b': 'x'}\n")
    assert read_json(spark, p, schema="a long, b string", allowSingleQuotes="true").collect()[0].b == "x"
    bad = read_json(spark, p, schema="a long, b string", allowSingleQuotes="false", mode="DROPMALFORMED")
    assert bad.collect() == []


def test_delimited_text_literal_separator(spark, tmp):
    p = _write(f"{tmp}/pipes.txt", "a|b\n1|x\n2|y\n")
    rows = read_delimited_text(spark, p, ["a", "b"], ["int", "string"], sep="|").orderBy("a").collect()
    assert [tuple(r) for r in rows] == [(1, "x"), (2, "y")]


def test_conform_nested_by_name_with_declared_nullability(spark):
    from pyspark.errors import PySparkException
    from pyspark.sql import types as T
    from tablekit.sources.conform import conform
    inner = T.StructType([T.StructField("a", T.LongType(), False), T.StructField("b", T.IntegerType())])
    want = T.StructType([T.StructField("id", T.LongType(), False), T.StructField("s", inner),
                         T.StructField("l", T.ArrayType(inner))])
    df = spark.createDataFrame([("7", (3, 30), [(4, 40)]), ("8", None, None)],
                               "id string, s struct<b:long,a:long>, l array<struct<b:int,a:int>>")
    out = conform(df, want)
    assert [(f.name, f.nullable) for f in out.schema] == [("id", False), ("s", True), ("l", True)]
    rows = sorted(out.collect())
    assert rows[0].s.asDict() == {"a": 30, "b": 3} and rows[0].l[0].asDict() == {"a": 40, "b": 4}
    assert rows[1].s is None and rows[1].l is None
    bad = spark.createDataFrame([(None, None, None)], df.schema)
    with pytest.raises(PySparkException, match="non-nullable field id"):
        conform(bad, want).count()
    with pytest.raises(PySparkException, match="non-nullable field s.a"):
        conform(spark.createDataFrame([("1", (3, None), None)], df.schema), want).collect()


def test_delimited_text_is_one_scan(spark, tmp):
    from tablekit.sources.readers import read_delimited_text
    for i in range(3):
        with open(f"{tmp}/f{i}.txt", "w") as f:
            f.write(f"a|*|b\n{i}|*|\"x\"\noops|*|\n")
    out = read_delimited_text(spark, tmp, ["a", "b"], ["int", "string"], sep="|*|")
    assert sorted((r.a, r.b) for r in out.collect() if r.a is not None) == [(i, '"x"') for i in range(3)]
    assert out.count() == 6
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "Join" not in plan
