"""Joins (J1-J19): equi-joins of every type, pair joins, the array-membership
join, and the aggregate-then-join queries of the employee exercises mapped to
customer (employee), orders (salary, title), nation (department)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tablekit.operators.aggregate import latest_per_key
from tablekit.operators.joins import (
    array_join, join_drop_right_key, join_on, join_using, join_with, max_per_key_join, never_matched,
)
from tablekit.operators.staging import stage
from tablekit.operators.topk import top_k
from tablekit.plans.registry import register
from tablekit.plans.tables import JOIN_SIDES_SQL, customers_left, orders_right, table

JS = f"WITH {JOIN_SIDES_SQL}\n"
PAIR_COLS = ["c_custkey", "c_name", "o_orderkey", "o_totalprice"]


def _pair(spark, d, how):
    c, o = customers_left(spark, d), orders_right(spark, d)
    return join_on(c, o, "l_key", "r_key", how).select(*PAIR_COLS)


def _pair_sql(kind):
    return JS + f"""SELECT c.c_custkey, c.c_name, o.o_orderkey, o.o_totalprice
FROM cust_l c {kind} JOIN orders_r o ON c.l_key = o.r_key"""


@register("join_inner", _pair_sql("INNER"))
def join_inner(spark, d):
    return _pair(spark, d, "inner")


@register("join_left", _pair_sql("LEFT OUTER"))
def join_left(spark, d):
    return _pair(spark, d, "left")


@register("join_right", _pair_sql("RIGHT OUTER"))
def join_right(spark, d):
    return _pair(spark, d, "right")


@register("join_full", _pair_sql("FULL OUTER"))
def join_full(spark, d):
    return _pair(spark, d, "full")


@register("join_semi", JS + """
SELECT * FROM cust_l c WHERE EXISTS (SELECT 1 FROM orders_r o WHERE o.r_key = c.l_key)""")
def join_semi(spark, d):
    return join_on(customers_left(spark, d), orders_right(spark, d), "l_key", "r_key", "left_semi")


@register("join_anti", JS + """
SELECT * FROM cust_l c WHERE NOT EXISTS (SELECT 1 FROM orders_r o WHERE o.r_key = c.l_key)""")
def join_anti(spark, d):
    return join_on(customers_left(spark, d), orders_right(spark, d), "l_key", "r_key", "left_anti")


@register("join_using", JS + """
SELECT coalesce(c.l_key, o.r_key) AS l_key, c.c_custkey, c.c_name, o.o_orderkey, o.o_custkey, o.o_totalprice
FROM cust_l c FULL OUTER JOIN orders_r o ON c.l_key = o.r_key""")
def join_using_q(spark, d):
    joined = join_using(customers_left(spark, d), orders_right(spark, d), "l_key", right_key="r_key", how="full")
    return joined.select("l_key", "c_custkey", "c_name", "o_orderkey", "o_custkey", "o_totalprice")


@register("join_drop_dup", JS + """
SELECT coalesce(c.l_key, o.r_key) AS l_key, c.c_custkey, c.c_name, o.o_orderkey, o.o_custkey, o.o_totalprice
FROM cust_l c RIGHT OUTER JOIN orders_r o ON c.l_key = o.r_key""")
def join_drop_dup(spark, d):
    joined = join_drop_right_key(customers_left(spark, d), orders_right(spark, d), "l_key", "r_key", "right")
    return joined.select("l_key", "c_custkey", "c_name", "o_orderkey", "o_custkey", "o_totalprice")


@register("join_renamed", """
SELECT c.c_custkey, c.c_name, n.n_nationkey AS nation_id, n.n_name
FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey""")
def join_renamed(spark, d):
    c = table(spark, d, "customer")
    n = table(spark, d, "nation").withColumnRenamed("n_nationkey", "nation_id")
    return c.join(n, c["c_nationkey"] == n["nation_id"]).select("c_custkey", "c_name", "nation_id", "n_name")


@register("join_with_pairs", JS + """
SELECT c.c_custkey AS l_custkey, o.o_orderkey AS r_orderkey,
       c.c_custkey IS NULL AS left_absent, o.o_orderkey IS NULL AS right_absent
FROM cust_l c FULL OUTER JOIN orders_r o ON c.l_key = o.r_key""")
def join_with_pairs(spark, d):
    c, o = customers_left(spark, d), orders_right(spark, d)
    pairs = join_with(c, o, "l_key", "r_key", "full")
    return pairs.select(F.col("_1.c_custkey").alias("l_custkey"), F.col("_2.o_orderkey").alias("r_orderkey"),
                        F.col("_1").isNull().alias("left_absent"), F.col("_2").isNull().alias("right_absent"))


# Array membership: each part's name words against the vocabulary of part
# types.  The join strategy is left to size statistics and adaptive execution.
def _words_and_vocab(spark, d):
    p = table(spark, d, "part")
    left = p.select("p_partkey", "p_name", F.split("p_name", " ").alias("words"))
    return left, p.select(F.lower("p_type").alias("type_word")).distinct()


ARRAY_SQL = """WITH vocab AS (SELECT DISTINCT lower(p_type) AS type_word FROM part)
SELECT p.p_partkey, p.p_name, v.type_word
FROM part p {kind} JOIN vocab v ON list_contains(string_split(p.p_name, ' '), v.type_word)"""


@register("join_array_inner", ARRAY_SQL.format(kind="INNER"))
def join_array_inner(spark, d):
    left, vocab = _words_and_vocab(spark, d)
    out = array_join(left, vocab, "words", "type_word", "inner")
    return out.select("p_partkey", "p_name", "type_word")


@register("join_array_outer", ARRAY_SQL.format(kind="FULL OUTER"))
def join_array_outer(spark, d):
    left, vocab = _words_and_vocab(spark, d)
    out = array_join(left, vocab, "words", "type_word", "full", left_key="p_partkey",
                     right_key="type_word")
    return out.select("p_partkey", "p_name", "type_word")


@register("join_array_left", ARRAY_SQL.format(kind="LEFT OUTER"))
def join_array_left(spark, d):
    left, vocab = _words_and_vocab(spark, d)
    out = array_join(left, vocab, "words", "type_word", "left", left_key="p_partkey")
    return out.select("p_partkey", "p_name", "type_word")


@register("join_array_right", ARRAY_SQL.format(kind="RIGHT OUTER"))
def join_array_right(spark, d):
    left, vocab = _words_and_vocab(spark, d)
    out = array_join(left, vocab, "words", "type_word", "right")
    return out.select("p_partkey", "p_name", "type_word")


def _max_price(spark, d):
    return max_per_key_join(table(spark, d, "customer"), table(spark, d, "orders"),
                            "c_custkey", "o_totalprice", "max_price", fact_key="o_custkey")


@register("max_per_key_join", """
SELECT c.c_custkey, c.c_name, m.max_price
FROM customer c JOIN (SELECT o_custkey, max(o_totalprice) AS max_price FROM orders GROUP BY o_custkey) m
ON c.c_custkey = m.o_custkey""")
def max_per_key_join_q(spark, d):
    return _max_price(spark, d).select("c_custkey", "c_name", "max_price")


@register("never_matched", """
SELECT c_custkey, c_name FROM customer c WHERE NOT EXISTS (
  SELECT 1 FROM orders o WHERE o.o_custkey = c.c_custkey
  AND o.o_orderpriority = '1-URGENT' AND CAST(o.o_orderdate AS DATE) >= DATE '2001-01-01')""")
def never_matched_q(spark, d):
    o = table(spark, d, "orders")
    managers = o.where((F.col("o_orderpriority") == "1-URGENT")
                       & (F.col("o_orderdate").cast("date") >= F.lit("2001-01-01").cast("date")))
    return never_matched(table(spark, d, "customer"), managers, "c_custkey", "o_custkey").select(
        "c_custkey", "c_name")


def _max_date_per_pair(spark, d):
    return (table(spark, d, "orders").groupBy("o_custkey", "o_orderpriority")
            .agg(F.max("o_orderdate").alias("max_date")))


@register("max_date_per_pair", """
SELECT o_custkey, o_orderpriority, max(o_orderdate) AS max_date FROM orders GROUP BY o_custkey, o_orderpriority""")
def max_date_per_pair(spark, d):
    return _max_date_per_pair(spark, d)


@register("latest_per_key", """
SELECT o_custkey, o_orderdate, o_orderkey, o_orderpriority FROM orders
QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1""")
def latest_per_key_q(spark, d):
    o = table(spark, d, "orders").select("o_custkey", "o_orderdate", "o_orderkey", "o_orderpriority")
    return latest_per_key(o, "o_custkey", ["o_orderdate", "o_orderkey"])


@register("topk_then_join", """
WITH m AS (SELECT o_custkey AS c_custkey, max(o_totalprice) AS max_price FROM orders GROUP BY o_custkey),
best AS (SELECT m.* FROM customer c JOIN m ON c.c_custkey = m.c_custkey
         ORDER BY max_price DESC, c_custkey LIMIT 10),
t AS (SELECT o_custkey, o_orderpriority, max(o_orderdate) AS max_date FROM orders GROUP BY o_custkey, o_orderpriority)
SELECT best.c_custkey, best.max_price, t.o_orderpriority, t.max_date
FROM best JOIN t ON best.c_custkey = t.o_custkey""")
def topk_then_join(spark, d):
    best = top_k(_max_price(spark, d).select("c_custkey", "max_price"), 10, ["max_price desc"], ["c_custkey"])
    # The k best are used twice (to filter the orders, then in the final join);
    # staging them once keeps the aggregate over all orders from running twice.
    best = stage(best, "topk")
    # At most k rows by construction, so broadcasting them is safe; they cut
    # the orders down to those customers before the second aggregate.
    keys = F.broadcast(best.select(F.col("c_custkey").alias("o_custkey")))
    titles = (table(spark, d, "orders").join(keys, "o_custkey", "left_semi")
              .groupBy("o_custkey", "o_orderpriority").agg(F.max("o_orderdate").alias("max_date"))
              .withColumnRenamed("o_custkey", "c_custkey"))
    # One row per (customer, priority): the top 10 customers give more than 10 rows.
    return best.join(titles, "c_custkey").select("c_custkey", "max_price", "o_orderpriority", "max_date")


# SQL text shared by Spark (tables bound as DataFrames) and the oracle (views).
COMMA_JOIN3_SQL = """
SELECT n.n_nationkey AS nation_key,
       CAST(sum(CAST(o.o_totalprice AS DECIMAL(18,2))) AS DOUBLE) / CAST(count(o.o_totalprice) AS DOUBLE) AS avg_price
FROM {customer} c, {orders} o, {nation} n
WHERE c.c_custkey = o.o_custkey AND c.c_nationkey = n.n_nationkey
  AND CAST(o.o_orderdate AS DATE) > DATE '1999-01-01' AND CAST(o.o_orderdate AS DATE) < DATE '2000-01-01'
GROUP BY n.n_nationkey"""

BEST_GROUP_SQL = """
SELECT CAST(sum(CAST(o.o_totalprice AS DECIMAL(18,2))) AS DOUBLE) / CAST(count(o.o_totalprice) AS DOUBLE) AS payments,
       n.n_name, r.r_name
FROM {customer} c, {orders} o, {nation} n, {region} r
WHERE c.c_custkey = o.o_custkey AND c.c_nationkey = n.n_nationkey AND n.n_regionkey = r.r_regionkey
  AND CAST(o.o_orderdate AS DATE) > DATE '1999-01-01' AND CAST(o.o_orderdate AS DATE) < DATE '2000-01-01'
GROUP BY n.n_name, r.r_name
ORDER BY payments DESC, n.n_name
LIMIT 1"""

_VIEWS = {t: t for t in ("customer", "orders", "nation", "region")}


def _sql_on_tables(spark, d, text):
    names = [t for t in _VIEWS if "{" + t + "}" in text]
    return spark.sql(text, **{t: table(spark, d, t) for t in names})


@register("sql_comma_join3", COMMA_JOIN3_SQL.format(**_VIEWS))
def sql_comma_join3(spark, d):
    # The comma join becomes equi-joins once the WHERE conjuncts are pushed in.
    return _sql_on_tables(spark, d, COMMA_JOIN3_SQL)


def best_group(spark, d, limit: int | None = 1):
    """Average order value per nation for orders placed in 1999, best first.

    Orders are first summed per customer (exact DECIMAL sum and count): the
    joins then see one row per customer instead of one per order, and a
    customer with a huge share of the orders is reduced map-side before any
    shuffle.  The per-nation mean is sum of sums over sum of counts, so the
    result equals the mean over the order rows.
    """
    o = table(spark, d, "orders").where(
        (F.col("o_orderdate").cast("date") > F.lit("1999-01-01").cast("date"))
        & (F.col("o_orderdate").cast("date") < F.lit("2000-01-01").cast("date")))
    per_cust = o.groupBy("o_custkey").agg(
        F.sum(F.col("o_totalprice").cast("decimal(18,2)")).alias("s"), F.count("o_totalprice").alias("n"))
    c, n, r = table(spark, d, "customer"), table(spark, d, "nation"), table(spark, d, "region")
    j = (per_cust.join(c, per_cust["o_custkey"] == c["c_custkey"])
                 .join(n, c["c_nationkey"] == n["n_nationkey"])
                 .join(r, n["n_regionkey"] == r["r_regionkey"]))
    g = j.groupBy("n_name", "r_name").agg(
        (F.sum("s").cast("double") / F.sum("n").cast("double")).alias("payments"))
    ranked = g.select("payments", "n_name", "r_name").orderBy(F.col("payments").desc(), "n_name")
    return ranked.limit(limit) if limit else ranked


@register("sql_best_group", BEST_GROUP_SQL.format(**_VIEWS))
def sql_best_group(spark, d):
    return _sql_on_tables(spark, d, BEST_GROUP_SQL)


@register("nation_payments", BEST_GROUP_SQL.format(**_VIEWS).replace("LIMIT 1", ""))
def nation_payments(spark, d):
    """The DataFrame-API twin of ``sql_best_group`` with every nation ranked."""
    return best_group(spark, d, limit=None)
