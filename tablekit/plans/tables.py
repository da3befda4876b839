"""Driver tables and the derived frames the queries share.

The driver's tables carry no NULLs and every foreign key matches, so the null
and outer-join queries derive their gaps from data attributes (a priority, a
status, a segment), never from id subsets.  Each derived frame has a SQL twin
used by the oracle texts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def orders_n(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``orders`` plus nullable twins of four columns."""
    o = table(spark, sf_dir, "orders")
    return o.select(
        "*",
        F.when(F.col("o_orderpriority") == "4-NOT SPECIFIED", F.lit(None))
         .otherwise(F.col("o_totalprice")).alias("price_n"),
        F.nullif(F.col("o_orderpriority"), F.lit("5-LOW")).alias("prio_n"),
        F.nullif(F.col("o_orderstatus"), F.lit("P")).alias("status_n"),
        F.when(F.col("o_orderstatus") == "O", F.lit(None))
         .otherwise(F.col("o_custkey")).alias("cust_n"),
    )


ORDERS_N_SQL = """orders_n AS (
  SELECT *,
         CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN NULL ELSE o_totalprice END AS price_n,
         nullif(o_orderpriority, '5-LOW') AS prio_n,
         nullif(o_orderstatus, 'P') AS status_n,
         CASE WHEN o_orderstatus = 'O' THEN NULL ELSE o_custkey END AS cust_n
  FROM orders)"""


def customers_left(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Left side of the join family: all customers with a key ``l_key`` that is null
    for one segment, so that some have no partner."""
    c = table(spark, sf_dir, "customer")
    return c.withColumn("l_key", F.when(F.col("c_mktsegment") != "BUILDING", F.col("c_custkey")))


def orders_right(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Right side: all orders with a key ``r_key`` that is null for one status and
    negative (no customer's) before 2000."""
    o = table(spark, sf_dir, "orders")
    late = F.col("o_orderdate").cast("date") >= F.lit("2000-01-01").cast("date")
    key = F.when(late, F.col("o_custkey")).otherwise(-F.col("o_custkey") - 1)
    return o.withColumn("r_key", F.when(F.col("o_orderstatus") != "P", key))


JOIN_SIDES_SQL = """cust_l AS (
  SELECT *, CASE WHEN c_mktsegment <> 'BUILDING' THEN c_custkey END AS l_key FROM customer),
orders_r AS (
  SELECT *, CASE WHEN o_orderstatus <> 'P' THEN
    CASE WHEN CAST(o_orderdate AS DATE) >= DATE '2000-01-01' THEN o_custkey ELSE -o_custkey - 1 END END AS r_key
  FROM orders)"""

# Fixed reference date for anything age- or pivot-related (never the wall clock).
AS_OF = "2026-01-01"
