"""Queries that go through storage: conform to a schema (S14), Parquet round
trip (W2) and the audited CSV ingest (W8).  Files go to a fresh folder under
the shared checkpoint folder of the session."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablekit.catalog import create_database, list_databases
from tablekit.operators.feeds import ingest_run, read_ingested, read_manifest
from tablekit.operators.ingest import audit_ingest
from tablekit.session import scratch_database, shared_dir
from tablekit.sinks.writers import num_partitions, transfer_tables, with_files, write_csv, write_json, write_parquet
from tablekit.sources.conform import conform
from tablekit.sources.readers import (
    read_csv, read_delimited_text, read_json, read_table, read_text, quarantined, read_with_options,
)
from tablekit.plans.registry import register
from tablekit.plans.tables import table

ORDERS_CONFORMED = T.StructType([
    T.StructField("o_orderkey", T.LongType(), False),
    T.StructField("o_custkey", T.IntegerType(), True),
    T.StructField("o_orderdate", T.DateType(), True),
    T.StructField("o_totalprice", T.DoubleType(), True),
    T.StructField("o_orderpriority", T.StringType(), True),
])


@register("conform_orders", """
SELECT o_orderkey, CAST(o_custkey AS INTEGER) AS o_custkey, CAST(o_orderdate AS DATE) AS o_orderdate,
       o_totalprice, o_orderpriority FROM orders""")
def conform_orders(spark, d):
    return conform(table(spark, d, "orders"), ORDERS_CONFORMED)


@register("roundtrip_parquet", """SELECT * FROM orders""")
def roundtrip_parquet(spark, d):
    path = shared_dir(spark, "roundtrip") + "/orders"
    write_parquet(table(spark, d, "orders"), path, mode="overwrite")
    return spark.read.parquet(path)


ORDERS_CSV_SCHEMA = ("o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, "
                     "o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING")


def write_orders_by_month(spark, d, path: str) -> None:
    """Land ``orders`` as CSV files in a folder per order month, each file in key order.

    Rows are spread by month and key range, so a month is written by as many tasks
    as its rows need.
    """
    o = table(spark, d, "orders").withColumn("o_month", F.date_format("o_orderdate", "yyyy-MM"))
    n = spark.sparkContext.defaultParallelism
    (o.repartitionByRange(n, "o_month", "o_orderkey").sortWithinPartitions("o_month", "o_orderkey")
      .write.mode("overwrite").option("header", "true").partitionBy("o_month").csv(path))


@register("audit_ingest", """
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority,
       true AS numbered, true AS one_job FROM orders""")
def audit_ingest_q(spark, d):
    """Every row with its checks: its file is numbered 1..n in key order, and the job id
    is one valid id for the whole run (W8, X24, X25)."""
    src = shared_dir(spark, "landing")
    write_orders_by_month(spark, d, src)
    out = audit_ingest(spark, src, schema=ORDERS_CSV_SCHEMA)
    # How a month is cut into files follows the cluster, so files are checked by what
    # must hold for each: n rows, ids from 1 to n, and keys that rise with the ids.
    files = out.groupBy("source_file").agg(
        ((F.min("seq_id") == 1) & (F.max("seq_id") == F.count("*")) & (F.count_distinct("seq_id") == F.count("*"))
         & (F.max(F.struct("seq_id", "o_orderkey"))["o_orderkey"] == F.max("o_orderkey"))
         & (F.min(F.struct("seq_id", "o_orderkey"))["o_orderkey"] == F.min("o_orderkey"))).alias("numbered"))
    job = out.agg(F.min("job_id").alias("low"), F.max("job_id").alias("high"))
    valid = F.col("low").rlike("^[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}$") & (F.col("low") == F.col("high"))
    return (out.join(files, "source_file").withColumn("one_job", job.select(valid).scalar())
            .drop("job_id", "source_file", "seq_id"))


def _numbered(out):
    """One row for each file: whether its rows are numbered 1..n."""
    return out.groupBy("source_file").agg(
        ((F.min("seq_id") == 1) & (F.max("seq_id") == F.count("*")) & (F.count_distinct("seq_id") == F.count("*")))
        .alias("numbered"))


@register("ingest_mixed_headers", """
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate,
       CASE WHEN o_orderstatus <> 'P' THEN o_orderpriority END AS o_orderpriority, true AS numbered FROM orders""")
def ingest_mixed_headers(spark, d):
    """Files with headers of their own in one audited run (S16, W8): filled orders have their columns
    in reverse order, pending ones lack the priority and have a column more."""
    src, o = shared_dir(spark, "landing"), table(spark, d, "orders")
    landed = {"O": o.columns, "F": o.columns[::-1], "P": ["o_orderdate", "note", *[c for c in o.columns[:4]]]}
    for status, columns in landed.items():
        rows = o.withColumn("note", F.lit("pending")).where(F.col("o_orderstatus") == status)
        write_csv(rows.select(*columns), f"{src}/in/{status}")
    ingest_run(spark, f"{src}/in", f"{src}/out", schema=ORDERS_CSV_SCHEMA)
    out = read_ingested(spark, f"{src}/out")
    return out.join(_numbered(out), "source_file").select(*o.columns, "numbered")


@register("ingest_rerun", """
WITH runs AS (SELECT *, CASE WHEN CAST(o_orderdate AS DATE) < DATE '1998-01-01' THEN 1 ELSE 2 END AS run FROM orders)
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority, run,
       true AS numbered, true AS counted, true AS idle FROM runs""")
def ingest_rerun(spark, d):
    """Two deliveries and three runs (W8): a run opens only files that no earlier run has published,
    its manifest counts their rows, and the third run finds nothing to do."""
    src, o = shared_dir(spark, "landing"), table(spark, d, "orders")
    early = F.col("o_orderdate").cast("date") < F.lit("1998-01-01").cast("date")
    n = []
    for run, rows in (("1", o.where(early)), ("2", o.where(~early)), ("3", None)):
        if rows is not None:
            write_csv(rows, f"{src}/in/{run}")
        n.append(ingest_run(spark, f"{src}/in", f"{src}/out", schema=ORDERS_CSV_SCHEMA, job_id=run))
    out = read_ingested(spark, f"{src}/out")
    files = _numbered(out).join(read_manifest(spark, f"{src}/out").select("source_file", "rows"), "source_file")
    counts = out.groupBy("source_file").agg(F.count("*").alias("n"))
    files = files.join(counts, "source_file").withColumn("counted", F.col("n") == F.col("rows"))
    return out.join(files, "source_file").select(
        *o.columns, F.col("job_id").cast("int").alias("run"), "numbered", "counted", F.lit(n[2] == 0).alias("idle"))


ORDERS_DDL = ("o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, "
              "o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING")


@register("roundtrip_json", """SELECT * FROM orders""")
def roundtrip_json(spark, d):
    """JSON lines written with overwrite (W1), read back under a fixed schema."""
    path = shared_dir(spark, "json") + "/orders"
    write_json(table(spark, d, "orders"), path, mode="overwrite")
    return read_json(spark, path, schema=ORDERS_DDL, mode="FAILFAST")


@register("json_quarantine", """
SELECT false AS bad, o_orderkey, o_custkey, o_totalprice, CAST(NULL AS VARCHAR) AS line
FROM orders WHERE o_orderpriority <> '5-LOW'
UNION ALL
SELECT true, NULL, NULL, NULL, 'order ' || CAST(o_orderkey AS VARCHAR) || ' of ' || CAST(o_custkey AS VARCHAR)
FROM orders WHERE o_orderpriority = '5-LOW'""")
def json_quarantine(spark, d):
    """Lines that are not valid JSON go to quarantine (S3); the rest parse.  Both sides are returned,
    from the two partitions of one table that one scan has written."""
    o = table(spark, d, "orders")
    # Broken lines: the low-priority orders are plain text.
    broken = F.concat(F.lit("order "), F.col("o_orderkey").cast("string"), F.lit(" of "),
                      F.col("o_custkey").cast("string"))
    line = F.when(F.col("o_orderpriority") == "5-LOW", broken).otherwise(F.to_json(F.struct(*o.columns)))
    path = shared_dir(spark, "jsonl") + "/orders"
    o.select(line.alias("value")).write.mode("overwrite").text(path)
    rows = quarantined(
        read_json(spark, path, schema=ORDERS_DDL + ", _corrupt STRING", corrupt_column="_corrupt"), "_corrupt")
    return rows.select("bad", "o_orderkey", "o_custkey", "o_totalprice", F.col("_corrupt").alias("line"))


@register("roundtrip_tsv", """SELECT * FROM part""")
def roundtrip_tsv(spark, d):
    """Tab-separated CSV with header (W3), read with schema and separator."""
    p = table(spark, d, "part")
    path = shared_dir(spark, "tsv") + "/part"
    write_csv(p, path, mode="overwrite", sep="\t")
    return read_csv(spark, path, schema=p.schema, sep="\t")


@register("text_lines", """SELECT c_name AS value FROM customer""")
def text_lines(spark, d):
    """One string column written as text, read back as one ``value`` row per line."""
    path = shared_dir(spark, "text") + "/names"
    table(spark, d, "customer").select("c_name").write.mode("overwrite").text(path)
    return read_text(spark, path)


@register("delimited_text", """
SELECT o_orderkey, o_custkey, o_totalprice, CAST(o_orderdate AS DATE) AS o_orderdate FROM orders""")
def delimited_text(spark, d):
    """CSV lines parsed by hand from text (S9): header dropped by position, fields converted."""
    o = table(spark, d, "orders").select(
        "o_orderkey", "o_custkey", "o_totalprice", F.col("o_orderdate").cast("date").alias("o_orderdate"))
    path = shared_dir(spark, "lines") + "/orders"
    write_csv(o, path, mode="overwrite")
    return read_delimited_text(spark, path, ["o_orderkey", "o_custkey", "o_totalprice", "o_orderdate"],
                               ["bigint", "bigint", "double", "date"])


@register("json_inferred", """
SELECT c_custkey, c_name, c_mktsegment FROM customer""")
def json_inferred(spark, d):
    """JSON lines read without a schema: inferred types, columns in alphabetical order."""
    path = shared_dir(spark, "json") + "/customer"
    write_json(table(spark, d, "customer").select("c_name", "c_custkey", "c_mktsegment"), path)
    return read_json(spark, path)


@register("csv_inferred", """
SELECT CAST(p_partkey AS INTEGER) AS p_partkey, p_name, p_retailprice FROM part""")
def csv_inferred(spark, d):
    """CSV read without a schema: types are inferred from the values."""
    path = shared_dir(spark, "csv") + "/part"
    write_csv(table(spark, d, "part").select("p_partkey", "p_name", "p_retailprice"), path)
    return read_csv(spark, path)


@register("options_map", """
SELECT o_orderkey, CAST(o_orderdate AS DATE) AS o_orderdate, nullif(o_orderstatus, 'P') AS o_orderstatus FROM orders""")
def options_map(spark, d):
    """A reader set up by one map of options, the path among them."""
    path = shared_dir(spark, "options") + "/orders"
    o = table(spark, d, "orders").select("o_orderkey", F.col("o_orderdate").cast("date").alias("o_orderdate"), "o_orderstatus")
    write_csv(o, path, sep="|", dateFormat="dd.MM.yyyy")
    return read_with_options(spark, "csv", {"path": path, "sep": "|", "header": "true", "nullValue": "P",
                                            "dateFormat": "dd.MM.yyyy", "mode": "FAILFAST"}, schema=o.schema)


@register("json_flags", """
SELECT o_orderkey, o_orderpriority, CAST(NULL AS VARCHAR) AS missing FROM orders""")
def json_flags(spark, d):
    """JSON with single quotes and unquoted names, allowed by flags."""
    path = shared_dir(spark, "flags") + "/orders"
    line = F.concat(F.lit("{o_orderkey: "), F.col("o_orderkey").cast("string"), F.lit(", 'o_orderpriority': '"),
                    F.col("o_orderpriority"), F.lit("'}"))
    table(spark, d, "orders").select(line.alias("value")).write.text(path)
    return read_json(spark, path, schema="o_orderkey BIGINT, o_orderpriority STRING, missing STRING", mode="FAILFAST",
                     allowSingleQuotes=True, allowUnquotedFieldNames=True)


@register("save_modes", """
SELECT 'append' AS mode, 2 * count(*) AS n, true AS refused FROM supplier
UNION ALL SELECT 'ignore', count(*), true FROM supplier""")
def save_modes(spark, d):
    """append adds, ignore leaves what is there, errorIfExists refuses."""
    s, base = table(spark, d, "supplier"), shared_dir(spark, "modes")
    for mode in ("errorifexists", "append"):
        write_parquet(s, f"{base}/a", mode=mode)
    write_parquet(s, f"{base}/b")
    write_parquet(s.union(s), f"{base}/b", mode="ignore")
    try:
        write_parquet(s, f"{base}/b", mode="errorifexists")
        refused = False
    except AnalysisException:
        refused = True
    n = lambda path, mode: spark.read.parquet(path).agg(
        F.lit(mode).alias("mode"), F.count("*").alias("n"), F.lit(refused).alias("refused"))
    return n(f"{base}/a", "append").union(n(f"{base}/b", "ignore"))


@register("warehouse_tables", """
SELECT n.n_name, count(*) AS customers, true AS listed, true AS in_warehouse
FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey GROUP BY n.n_name""")
def warehouse_tables(spark, d):
    """Tables transferred to a database as views and managed tables, twice (overwrite), and
    joined by name; the database is listed and lives in the warehouse (W6, W7, S11, C2, C3, C5)."""
    name, before = scratch_database(f"tk_{uuid.uuid4().hex[:12]}"), spark.catalog.currentDatabase()
    create_database(spark, name, use=True)
    try:
        for _ in range(2):
            transfer_tables(spark, lambda t: table(spark, d, t), ["customer", "nation"], to_warehouse=True)
        for t in ("customer", "nation"):
            spark.catalog.dropTempView(t)
        place = spark.catalog.getDatabase(name).locationUri
        home = spark.conf.get("spark.sql.warehouse.dir")
        listed = not list_databases(spark).where(F.col("namespace") == name).isEmpty()
        c, n = read_table(spark, f"{name}.customer"), read_table(spark, f"{name}.nation")
    finally:
        spark.catalog.setCurrentDatabase(before)
    inside = place.replace("file:", "").lstrip("/").startswith(home.replace("file:", "").strip("/"))
    out = c.join(n, c.c_nationkey == n.n_nationkey).groupBy("n_name").agg(F.count("*").alias("customers"))
    return out.withColumns({"listed": F.lit(listed), "in_warehouse": F.lit(inside)})


@register("file_layout", """
SELECT 'repartition' AS layout, count(*) AS n_rows, true AS as_asked, 10 AS partitions FROM lineitem
UNION ALL SELECT 'coalesce', count(*), true, 5 FROM lineitem""")
def file_layout(spark, d):
    """repartition(10) writes ten files, coalesce(5) of these at most five; the partition count says so (L1-L3).

    The rows are shuffled once for the files: merging reads the ten, which are columns and half as
    large as the shuffled rows.  Each file is a frame of its own, so that there are ten partitions
    at least, however the scan packs small files; a table of fewer rows keeps its ten partitions.
    """
    rows, base = table(spark, d, "lineitem"), shared_dir(spark, "layout")
    spread = with_files(rows, 10)
    write_parquet(spread, f"{base}/spread")
    written = spark.read.schema(rows.schema).parquet(f"{base}/spread").inputFiles()
    parts = [spark.read.schema(rows.schema).parquet(f) for f in written]
    merged = with_files(reduce(DataFrame.union, parts) if len(parts) == 10 else spread, 5, shuffle=False)
    write_parquet(merged, f"{base}/merged")
    files = F.count_distinct(F.col("_metadata.file_path"))

    def found(name, path, as_asked, partitions):
        return spark.read.parquet(path).select("*", "_metadata").agg(
            F.lit(name).alias("layout"), F.count("*").alias("n_rows"), as_asked.alias("as_asked"),
            F.lit(partitions).alias("partitions"))

    return found("repartition", f"{base}/spread", files == 10, num_partitions(spread)).union(
        found("coalesce", f"{base}/merged", files <= 5, num_partitions(merged)))
