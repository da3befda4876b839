"""The same operators on a skewed derivation of ``orders``: every urgent or
high-priority order (about 40 % of the rows) is moved to customer 0.  These
queries run the hot-key-safe forms (map-side combined per-key pick, outer join
as inner + anti join) over a key that holds a large share of all rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from tablekit.operators.aggregate import latest_per_key
from tablekit.operators.joins import join_on
from tablekit.plans.registry import register
from tablekit.plans.tables import table

HOT_SQL = """WITH hot_orders AS (
  SELECT o_orderkey,
         CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 0 ELSE o_custkey END AS o_custkey,
         o_orderstatus, o_totalprice, o_orderdate, o_orderpriority
  FROM orders)
"""


def hot_orders(spark, d):
    o = table(spark, d, "orders")
    hot = F.when(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"), F.lit(0).cast("bigint"))
    return o.withColumn("o_custkey", hot.otherwise(F.col("o_custkey")))


@register("latest_per_key_hot", HOT_SQL + """
SELECT o_custkey, o_orderdate, o_orderkey, o_orderpriority FROM hot_orders
QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1""")
def latest_per_key_hot(spark, d):
    o = hot_orders(spark, d).select("o_custkey", "o_orderdate", "o_orderkey", "o_orderpriority")
    return latest_per_key(o, "o_custkey", ["o_orderdate", "o_orderkey"])


@register("join_left_hot", HOT_SQL + """
SELECT c.c_custkey, c.c_name, o.o_orderkey, o.o_totalprice
FROM customer c LEFT OUTER JOIN hot_orders o ON c.c_custkey = o.o_custkey""")
def join_left_hot(spark, d):
    c, o = table(spark, d, "customer"), hot_orders(spark, d)
    return join_on(c, o, "c_custkey", "o_custkey", "left").select("c_custkey", "c_name", "o_orderkey", "o_totalprice")
