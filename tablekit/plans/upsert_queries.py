"""Keyed update / upsert of ``orders`` (U1-U6, the set-based form of W9/W10).

Target: all orders but the open ones from 2000 on.  Change set: open orders from
1999 on, with their status rewritten O -> F; the 1999 ones update, the later ones
insert.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tablekit.operators.upsert import change_set, classify, update_matched, upsert
from tablekit.plans.registry import register
from tablekit.plans.tables import table

KEY = "o_orderkey"

UPSERT_SQL = """WITH target AS (SELECT * FROM orders WHERE CAST(o_orderdate AS DATE) < DATE '2000-01-01' OR o_orderstatus <> 'O'),
changes AS (
  SELECT o_orderkey, o_custkey, regexp_replace(o_orderstatus, 'O', 'F', 'g') AS o_orderstatus,
         o_totalprice, o_orderdate, o_orderpriority
  FROM orders WHERE CAST(o_orderdate AS DATE) >= DATE '1999-01-01' AND o_orderstatus = 'O')
"""


def _target(spark, d):
    o = table(spark, d, "orders")
    return o.where((F.col("o_orderdate").cast("date") < F.lit("2000-01-01").cast("date")) | (F.col("o_orderstatus") != "O"))


def _changes(spark, d):
    o = table(spark, d, "orders")
    pred = (F.col("o_orderdate").cast("date") >= F.lit("1999-01-01").cast("date")) & (F.col("o_orderstatus") == "O")
    return change_set(o, pred, {"o_orderstatus": F.regexp_replace("o_orderstatus", "O", "F")})


@register("change_set", UPSERT_SQL + "SELECT * FROM changes")
def change_set_q(spark, d):
    return _changes(spark, d)


@register("upsert_classify", UPSERT_SQL + """
SELECT c.o_orderkey, CASE WHEN t.o_orderkey IS NULL THEN 'INSERT' ELSE 'UPDATE' END AS op
FROM changes c LEFT JOIN target t ON c.o_orderkey = t.o_orderkey""")
def upsert_classify(spark, d):
    return classify(_changes(spark, d), _target(spark, d), KEY).select(KEY, "op")


@register("upsert_orders", UPSERT_SQL + """
SELECT * FROM target t WHERE NOT EXISTS (SELECT 1 FROM changes c WHERE c.o_orderkey = t.o_orderkey)
UNION ALL SELECT * FROM changes""")
def upsert_orders(spark, d):
    return upsert(_target(spark, d), _changes(spark, d), KEY, validate=False)


@register("update_matched", UPSERT_SQL + """
SELECT * FROM target t WHERE NOT EXISTS (SELECT 1 FROM changes c WHERE c.o_orderkey = t.o_orderkey)
UNION ALL SELECT * FROM changes c WHERE EXISTS (SELECT 1 FROM target t WHERE t.o_orderkey = c.o_orderkey)""")
def update_matched_q(spark, d):
    return update_matched(_target(spark, d), _changes(spark, d), KEY, validate=False)


@register("upsert_dedup", UPSERT_SQL + """,
versions AS (
  SELECT *, 1 AS version FROM changes
  UNION ALL
  SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice * 2, o_orderdate, o_orderpriority, 2
  FROM changes WHERE o_orderpriority = '1-URGENT'),
best AS (
  SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM versions
  QUALIFY row_number() OVER (PARTITION BY o_orderkey ORDER BY version DESC) = 1)
SELECT * FROM target t WHERE NOT EXISTS (SELECT 1 FROM best b WHERE b.o_orderkey = t.o_orderkey)
UNION ALL SELECT * FROM best""")
def upsert_dedup(spark, d):
    ch = _changes(spark, d)
    v1 = ch.withColumn("version", F.lit(1))
    v2 = (ch.where(F.col("o_orderpriority") == "1-URGENT")
            .withColumn("o_totalprice", F.col("o_totalprice") * 2).withColumn("version", F.lit(2)))
    # Two versions of the urgent changes: the later version wins per key.
    return upsert(_target(spark, d), v1.unionByName(v2), KEY, order_by=["version"])
