"""Mergeable aggregates, global row numbers, many needles, and a merge by files."""

from __future__ import annotations

from pyspark.sql import functions as F

from tablekit.operators import file_merge
from tablekit.operators.needles import find_needles
from tablekit.operators.rollups import (
    correlation, count_bitmaps, deviation, distinct_bitmaps, distinct_sketches, merge_bitmaps, merge_moments,
    merge_sketches, moments,
)
from tablekit.operators.staging import stage
from tablekit.operators.topk import with_row_number
from tablekit.plans.registry import register
from tablekit.plans.tables import table
from tablekit.plans.upsert_queries import KEY, UPSERT_SQL, _changes, _target
from tablekit.session import shared_dir
from tablekit.sinks.layout import write_clustered
from tablekit.streaming.latest_stream import start_latest_stream


@register("distinct_rollup", """
SELECT date_trunc('month', o_orderdate)::DATE AS month, count(DISTINCT o_custkey) AS customers, true AS near
FROM orders GROUP BY 1""")
def distinct_rollup(spark, d):
    """Customers per month estimated from stored daily sketches, without the rows (A4); the exact
    count, and whether the estimate is within four standard errors of it."""
    o = table(spark, d, "orders").withColumn("day", F.col("o_orderdate").cast("date"))
    month = F.trunc("day", "month").alias("month")
    days = stage(distinct_sketches(o, ["day"], "o_custkey"), "sketches")
    estimates = merge_sketches(days, [month]).select(F.col("month").alias("m"), "estimate")
    exact = o.groupBy(month).agg(F.count_distinct("o_custkey").alias("customers"))
    near = F.abs(F.col("estimate") - F.col("customers")) <= 1 + 4 * 0.0163 * F.col("customers")
    return exact.join(estimates, F.col("month") == F.col("m")).select("month", "customers", near.alias("near"))


@register("distinct_bitmaps", """
SELECT l_returnflag, NULL AS l_linestatus, count(DISTINCT l_partkey) AS parts FROM lineitem GROUP BY l_returnflag
UNION ALL SELECT l_returnflag, l_linestatus, count(DISTINCT l_partkey) FROM lineitem GROUP BY l_returnflag, l_linestatus""")
def distinct_bitmaps_q(spark, d):
    """Exact distinct parts by flag and status, and by flag from the same bitmaps (A3)."""
    both = ["l_returnflag", "l_linestatus"]
    maps = stage(distinct_bitmaps(table(spark, d, "lineitem"), both, "l_partkey"), "bitmaps")
    fine = count_bitmaps(maps, both, "parts")
    coarse = count_bitmaps(merge_bitmaps(maps, both), ["l_returnflag"], "parts")
    return coarse.select("l_returnflag", F.lit(None).cast("string").alias("l_linestatus"), "parts").unionByName(fine)


@register("moments_rollup", """
SELECT o_orderpriority, CAST(count(*) AS DOUBLE) AS n, round(stddev_samp(o_totalprice), 2) AS deviation,
       true AS same_deviation, true AS same_correlation FROM orders GROUP BY o_orderpriority""")
def moments_rollup(spark, d):
    """Deviation and correlation by priority, merged from monthly states (A8, A9).  The price is shifted
    by 10^9, where sums of squares lose their digits; the result is held against direct aggregates."""
    o = table(spark, d, "orders").withColumns({
        "price": F.col("o_totalprice") + 1e9, "day": F.unix_timestamp(F.col("o_orderdate").cast("timestamp")) / 86400,
        "month": F.date_format("o_orderdate", "yyyy-MM")})
    months = stage(moments(o, ["o_orderpriority", "month"], "price", "day"), "moments")
    s = F.col("state")
    merged = merge_moments(months, ["o_orderpriority"]).select(
        "o_orderpriority", s["n"].alias("n"), deviation(s).alias("deviation"), correlation(s).alias("correlation"))
    direct = o.groupBy(F.col("o_orderpriority").alias("p")).agg(
        F.stddev_samp("o_totalprice").alias("d"), F.corr("o_totalprice", "day").alias("c"))
    close = lambda a, b, by: F.abs(F.col(a) - F.col(b)) <= by
    return merged.join(direct, F.col("o_orderpriority") == F.col("p")).select(
        "o_orderpriority", "n", F.round("deviation", 2).alias("deviation"),
        close("deviation", "d", F.lit(1e-9) * F.col("d")).alias("same_deviation"),
        close("correlation", "c", 1e-9).alias("same_correlation"))


@register("row_numbers", """
SELECT l_orderkey, l_linenumber, l_extendedprice,
       row_number() OVER (ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber) AS row_number FROM lineitem""")
def row_numbers(spark, d):
    """Every line numbered in one global order, in parallel."""
    rows = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice")
    return with_row_number(rows, F.col("l_extendedprice").desc(), F.col("l_orderkey"), F.col("l_linenumber"))


@register("needles_found", """
WITH needles AS (SELECT DISTINCT unnest(regexp_extract_all(text, '[A-Za-z]{5,}')) AS needle FROM benchmark),
hits AS (SELECT doc_id, needle FROM documents JOIN needles ON contains(text, needle))
SELECT d.doc_id, count(needle) AS n_needles, min(needle) AS first_needle
FROM documents d LEFT JOIN hits h ON d.doc_id = h.doc_id GROUP BY d.doc_id""")
def needles_found(spark, d):
    """The longer words of all benchmark items, looked for in every document by one automaton."""
    words = table(spark, d, "benchmark").select(F.explode(F.regexp_extract_all("text", F.lit("[A-Za-z]{5,}"), F.lit(0))))
    found = find_needles(table(spark, d, "documents").select("doc_id", "text"), "text", words)
    return found.select("doc_id", F.size("needles").cast("long").alias("n_needles"), F.get("needles", F.lit(0)).alias("first_needle"))


@register("merge_by_files", UPSERT_SQL + """
SELECT * FROM target t WHERE NOT EXISTS (SELECT 1 FROM changes c WHERE c.o_orderkey = t.o_orderkey)
UNION ALL SELECT * FROM changes""")
def merge_by_files(spark, d):
    """The upsert of orders on a table of files with an index."""
    path = shared_dir(spark, "merge-table")
    file_merge.create(_target(spark, d), path, KEY, files=8)
    file_merge.merge(spark, path, _changes(spark, d), KEY)
    return file_merge.read(spark, path)


@register("latest_running", """
SELECT * FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1""")
def latest_running(spark, d):
    """The latest order per customer as a running table: orders replayed as a stream of four batches."""
    base, o = shared_dir(spark, "latest"), table(spark, d, "orders")
    o.repartition(4, "o_orderpriority", "o_orderkey").write.parquet(f"{base}/in")
    stream = spark.readStream.schema(o.schema).option("maxFilesPerTrigger", 1).parquet(f"{base}/in")
    query = start_latest_stream(stream, f"{base}/table", f"{base}/checkpoint", "o_custkey", ["o_orderdate", "o_orderkey"])
    query.awaitTermination()
    return file_merge.read(spark, f"{base}/table").select(*o.columns)


@register("layout_by_bytes", """SELECT count(*) AS n_rows, true AS sized, true AS few_by_part, true AS few_by_price FROM lineitem""")
def layout_by_bytes(spark, d):
    """``lineitem`` in files of a quarter megabyte along a curve over part and price (L1, L2): all but the
    smallest are within half and twice the target, and a tenth of either column is in half of the files."""
    rows, path, target = table(spark, d, "lineitem"), shared_dir(spark, "layout") + "/lineitem", 256 << 10
    asked = write_clustered(rows, path, "l_partkey", "l_extendedprice", target)
    length = F.col("length")
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(path).select("path", "length")
    n = files.agg(F.count("*")).first()[0]
    fit = files.agg((F.lit(n == asked) & (F.count_if(length.between(target // 2, 2 * target)) >= n - 1)).alias("fit"))
    written = spark.read.parquet(path).select("*", F.col("_metadata.file_path").alias("file"))

    def few(column):
        """Whether the lowest tenth of a column is in about half of the files at most."""
        tenth = rows.agg(F.percentile_approx(column, 0.1, 10_000)).scalar()
        return F.count_distinct(F.when(F.col(column) <= tenth, F.col("file"))) <= max(2, n / 2 + 1)

    return written.agg(F.count("*").alias("n_rows"), few("l_partkey").alias("few_by_part"), few("l_extendedprice").alias("few_by_price")).select(
        "n_rows", fit.scalar().alias("sized"), "few_by_part", "few_by_price")
