"""Readers for the formats the toolkit supports.

All are the stock Spark readers with the options made explicit; the notes say
where Spark 4 differs from older behaviour.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.types import StructType

from tablekit.functions import qcol

PARSE_MODES = ("PERMISSIVE", "DROPMALFORMED", "FAILFAST")


def _mode(mode: str) -> str:
    m = mode.upper()
    if m not in PARSE_MODES:
        raise ValueError(f"mode must be one of {PARSE_MODES}")
    return m


def read_json(spark: SparkSession, path: str | Sequence[str], schema: StructType | str | None = None,
              mode: str = "PERMISSIVE", corrupt_column: str | None = None,
              **options) -> DataFrame:
    """JSON lines (S1-S5).  Without ``schema`` the columns are inferred and come
    out in alphabetical order.  ``corrupt_column`` keeps the raw text of a bad
    line (PERMISSIVE only) so it can be quarantined.

    A line is judged on the columns a query reads: ``count()`` alone reads none,
    so DROPMALFORMED then drops only lines that are not JSON at all."""
    r = spark.read.option("mode", _mode(mode))
    if corrupt_column:
        r = r.option("columnNameOfCorruptRecord", corrupt_column)
    if schema is not None:
        r = r.schema(schema)
    return r.options(**{k: str(v) for k, v in options.items()}).json(path)


def quarantined(df: DataFrame, corrupt_column: str, stage_path: str | None = None, flag: str = "bad") -> DataFrame:
    """The parsed rows and the lines that did not parse, as two partitions (``flag``) of one table.

    One scan writes both to the shared checkpoint folder (or ``stage_path``); a filter on
    ``flag`` reads its partition only.  Spark refuses a raw JSON/CSV scan whose only
    referenced column is the corrupt-record column, which is what a plain ``count()`` of
    either side would be, so the rows have to be written once.  The table goes with
    ``session.remove_dir`` or ``remove_scratch``.
    """
    from tablekit.session import shared_dir
    spark = df.sparkSession
    path = stage_path or shared_dir(spark, "quarantine")
    rows = df.withColumn(flag, F.col(corrupt_column).isNotNull())
    rows.write.mode("overwrite").partitionBy(flag).parquet(path)
    # The schema as written (the flag last), so that an empty side is read as well.
    return spark.read.schema(rows.schema).parquet(path)


def split_corrupt(df: DataFrame, corrupt_column: str, stage_path: str | None = None
                  ) -> tuple[DataFrame, DataFrame]:
    """(good rows without the corrupt column, quarantined raw lines) of :func:`quarantined`."""
    flag = "__tk_bad"
    rows = quarantined(df, corrupt_column, stage_path, flag)
    cols = [c for c in df.columns if c != corrupt_column]
    good = rows.where(~F.col(flag)).select(*map(qcol, cols))
    bad = rows.where(flag).select(*map(qcol, cols), qcol(corrupt_column))
    return good, bad


def read_csv(spark: SparkSession, path: str | Sequence[str], schema: StructType | str | None = None,
             header: bool = True, sep: str = ",", null_value: str | None = None,
             date_format: str | None = None, mode: str = "PERMISSIVE", **options) -> DataFrame:
    """CSV (S6, S7).  With no ``schema`` types are inferred (one extra pass)."""
    r = spark.read.option("header", header).option("sep", sep).option("mode", _mode(mode))
    if null_value is not None:
        r = r.option("nullValue", null_value)
    if date_format is not None:
        r = r.option("dateFormat", date_format)
    if schema is not None:
        r = r.schema(schema)
    else:
        r = r.option("inferSchema", "true")
    return r.options(**{k: str(v) for k, v in options.items()}).csv(path)


def read_with_options(spark: SparkSession, fmt: str, options: Mapping[str, str],
                      schema: StructType | str | None = None) -> DataFrame:
    """Any format with its options as one map; ``path`` may be one of them."""
    r = spark.read.format(fmt)
    if schema is not None:
        r = r.schema(schema)
    return r.options(**{k: str(v) for k, v in options.items()}).load()


def read_text(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """One ``value`` row per line."""
    return spark.read.text(path)


def read_delimited_text(spark: SparkSession, path: str, names: Sequence[str], types: Sequence[str],
                        sep: str = ",", header: bool = True) -> DataFrame:
    """Text lines split into typed columns.

    One scan: Spark's CSV reader cuts the lines on the literal separator (no
    quoting, no escapes) and drops the first line of each file if there is a
    header; the fields are then converted, and one that does not convert is NULL.
    """
    raw = T.StructType([T.StructField(n, T.StringType()) for n in names])
    fields = (spark.read.schema(raw).option("sep", sep).option("header", header).option("quote", "")
              .option("escape", "").option("enforceSchema", "true").option("nullValue", "\u0000").csv(path))
    return fields.select(*[F.col(f"`{n}`").try_cast(t).alias(n) for n, t in zip(names, types)])


def read_jdbc(spark: SparkSession, url: str, table: str, user: str | None = None,
              password: str | None = None, driver: str | None = None,
              partition_column: str | None = None, lower_bound: int | None = None,
              upper_bound: int | None = None, num_partitions: int | None = None,
              **options) -> DataFrame:
    """A JDBC table (S10).  Give ``partition_column`` and bounds to read with
    ``num_partitions`` parallel range queries instead of one connection."""
    r = spark.read.format("jdbc").option("url", url).option("dbtable", table)
    for k, v in (("user", user), ("password", password), ("driver", driver)):
        if v is not None:
            r = r.option(k, v)
    if partition_column is not None:
        if None in (lower_bound, upper_bound, num_partitions):
            raise ValueError("partitioned JDBC read needs bounds and num_partitions")
        r = (r.option("partitionColumn", partition_column).option("lowerBound", lower_bound)
              .option("upperBound", upper_bound).option("numPartitions", num_partitions))
    return r.options(**{k: str(v) for k, v in options.items()}).load()


def read_table(spark: SparkSession, name: str) -> DataFrame:
    """A catalog table or view."""
    return spark.table(name)


def from_rows(spark: SparkSession, rows: Iterable, schema: StructType | Sequence[str] | str | None = None) -> DataFrame:
    """A small frame from local rows (S12, S13) -- fixtures and lookups only."""
    return spark.createDataFrame(list(rows), schema)


def schema_of(df: DataFrame) -> StructType:
    """The schema (S15); reuse it to read another source with the same layout."""
    return df.schema
