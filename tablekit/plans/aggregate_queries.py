"""Global and grouped aggregates.

Money sums and means use exact DECIMAL sums (``exact_sum``/``exact_avg``) so
that the result does not depend on how partial aggregates are combined;
``stddev`` and ``corr`` are rounded for the same reason.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tablekit.functions.scalars import exact_avg, exact_sum, row_sum
from tablekit.operators.aggregate import group_collect, group_collect_parts, mean_null_as_zero, min_record
from tablekit.operators.staging import stage
from tablekit.plans.registry import register
from tablekit.plans.tables import ORDERS_N_SQL, orders_n, table

ON = f"WITH {ORDERS_N_SQL}\n"


def _exact_avg_sql(col: str) -> str:
    return (f"CAST(sum(CAST({col} AS DECIMAL(18,2))) AS DOUBLE) / CAST(count({col}) AS DOUBLE)")


def _exact_sum_sql(col: str) -> str:
    return f"CAST(sum(CAST({col} AS DECIMAL(18,2))) AS DOUBLE)"


@register("agg_count_nonnull", ON + """
SELECT count(prio_n) AS n_prio, count(price_n) AS n_price FROM orders_n""")
def agg_count_nonnull(spark, d):
    return orders_n(spark, d).agg(F.count("prio_n").alias("n_prio"), F.count("price_n").alias("n_price"))


@register("agg_count_rows", ON + """
SELECT count(*) AS n_rows FROM orders_n""")
def agg_count_rows(spark, d):
    return orders_n(spark, d).agg(F.count(F.lit(1)).alias("n_rows"))


@register("agg_count_distinct", ON + """
SELECT count(DISTINCT prio_n) AS n_distinct_prio, count(DISTINCT cust_n) AS n_distinct_cust FROM orders_n""")
def agg_count_distinct(spark, d):
    return orders_n(spark, d).agg(F.count_distinct("prio_n").alias("n_distinct_prio"),
                                  F.count_distinct("cust_n").alias("n_distinct_cust"))


@register("agg_approx_distinct", """
SELECT count(DISTINCT o_custkey) AS customers, true AS estimate_near FROM orders""")
def agg_approx_distinct(spark, d):
    """The exact count, and whether the sketch (relative error 0.02) is within a tenth of it."""
    return table(spark, d, "orders").agg(
        F.count_distinct("o_custkey").alias("customers"),
        (F.abs(F.approx_count_distinct("o_custkey", 0.02) - F.count_distinct("o_custkey"))
         <= 0.1 * F.count_distinct("o_custkey")).alias("estimate_near"))


@register("is_empty", """
SELECT c_mktsegment, count(*) = 0 AS empty, false AS all_empty, true AS none_negative FROM customer GROUP BY c_mktsegment""")
def is_empty_q(spark, d):
    """Emptiness of a table and of a filtered table (K6), beside each segment."""
    c = table(spark, d, "customer")
    return c.groupBy("c_mktsegment").agg((F.count("*") == 0).alias("empty")).withColumns(
        {"all_empty": F.lit(c.isEmpty()), "none_negative": F.lit(c.where("c_custkey < 0").isEmpty())})


@register("current_date_time", """
SELECT o_orderkey, CAST(o_orderdate AS DATE) < current_date AS past, true AS same_day, true AS one_instant FROM orders""")
def current_date_time(spark, d):
    """current_date and current_timestamp are one instant for a whole query."""
    now = F.current_timestamp()
    return table(spark, d, "orders").select(
        "o_orderkey", (F.col("o_orderdate").cast("date") < F.current_date()).alias("past"),
        (now.cast("date") == F.current_date()).alias("same_day"), (now == F.now()).alias("one_instant"))


@register("uuid_ids", """
SELECT s_suppkey, true AS valid, true AS distinct_ids FROM supplier""")
def uuid_ids(spark, d):
    """A random id for each row (X24): well formed, and no two alike."""
    s = stage(table(spark, d, "supplier").select("s_suppkey", F.uuid().alias("id")), "uuid")
    alike = s.groupBy("id").agg(F.count("*").alias("n"))
    return s.join(alike, "id").select(
        "s_suppkey", F.col("id").rlike("^[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}$").alias("valid"),
        (F.col("n") == 1).alias("distinct_ids"))


@register("agg_min_max", ON + """
SELECT min(price_n) AS min_price, max(price_n) AS max_price,
       min(o_orderdate) AS first_order, max(o_orderdate) AS last_order FROM orders_n""")
def agg_min_max(spark, d):
    return orders_n(spark, d).agg(F.min("price_n").alias("min_price"), F.max("price_n").alias("max_price"),
                                  F.min("o_orderdate").alias("first_order"),
                                  F.max("o_orderdate").alias("last_order"))


@register("agg_sum", ON + f"""
SELECT {_exact_sum_sql('price_n')} AS sum_price, {_exact_sum_sql('o_totalprice')} AS sum_total FROM orders_n""")
def agg_sum(spark, d):
    return orders_n(spark, d).agg(exact_sum("price_n").alias("sum_price"),
                                  exact_sum("o_totalprice").alias("sum_total"))


@register("agg_avg", ON + f"""
SELECT {_exact_avg_sql('price_n')} AS avg_price, {_exact_avg_sql('o_totalprice')} AS mean_total FROM orders_n""")
def agg_avg(spark, d):
    return orders_n(spark, d).agg(exact_avg("price_n").alias("avg_price"),
                                  exact_avg("o_totalprice").alias("mean_total"))


@register("agg_stddev", ON + """
SELECT round(stddev_samp(price_n), 4) AS stddev_price FROM orders_n""")
def agg_stddev(spark, d):
    return orders_n(spark, d).agg(F.round(F.stddev("price_n"), 4).alias("stddev_price"))


@register("agg_corr", ON + """
SELECT round(corr(price_n, CAST(cust_n AS DOUBLE)), 6) AS corr_price_cust FROM orders_n""")
def agg_corr(spark, d):
    # F.corr skips pairs with a NULL (df.stat.corr would not).
    return orders_n(spark, d).agg(
        F.round(F.corr("price_n", F.col("cust_n").cast("double")), 6).alias("corr_price_cust"))


@register("sum_of_row_sum", ON + """
SELECT CAST(sum(CAST(price_n AS DECIMAL(18,2)) + CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total
FROM orders_n""")
def sum_of_row_sum(spark, d):
    parts = [F.col("price_n").cast("decimal(18,2)"), F.col("o_totalprice").cast("decimal(18,2)")]
    # A row with a NULL part has a NULL row sum and so leaves the total.
    return (orders_n(spark, d).select(row_sum(parts).alias("t"))
            .agg(F.sum("t").cast("double").alias("total")))


@register("mean_null_as_zero", ON + """
SELECT CAST(sum(coalesce(cust_n, 0)) AS BIGINT) // count(*) AS mean_int, avg(cust_n) AS avg_cust FROM orders_n""")
def mean_null_as_zero_q(spark, d):
    return orders_n(spark, d).agg(mean_null_as_zero("cust_n").alias("mean_int"),
                                  F.avg("cust_n").alias("avg_cust"))


@register("reduce_sum", """
SELECT CAST(sum(l_orderkey) AS BIGINT) AS total FROM lineitem""")
def reduce_sum(spark, d):
    return table(spark, d, "lineitem").agg(F.sum(F.col("l_orderkey").cast("bigint")).alias("total"))


@register("min_record", """
SELECT * FROM orders ORDER BY o_totalprice, o_orderkey LIMIT 1""")
def min_record_q(spark, d):
    return min_record(table(spark, d, "orders"), ["o_totalprice", "o_orderkey"])


@register("group_count", ON + """
SELECT prio_n, count(*) AS count FROM orders_n GROUP BY prio_n""")
def group_count(spark, d):
    # NULL forms its own group.
    return orders_n(spark, d).groupBy("prio_n").count()


@register("group_avg", ON + f"""
SELECT prio_n, {_exact_avg_sql('price_n')} AS avg_price FROM orders_n GROUP BY prio_n""")
def group_avg(spark, d):
    return orders_n(spark, d).groupBy("prio_n").agg(exact_avg("price_n").alias("avg_price"))


@register("group_multi_agg", ON + f"""
SELECT status_n, count(*) AS n_orders, {_exact_avg_sql('price_n')} AS avg_price,
       {_exact_sum_sql('o_totalprice')} AS sum_total
FROM orders_n GROUP BY status_n ORDER BY avg_price""")
def group_multi_agg(spark, d):
    return (orders_n(spark, d).groupBy("status_n")
            .agg(F.count(F.lit(1)).alias("n_orders"), exact_avg("price_n").alias("avg_price"),
                 exact_sum("o_totalprice").alias("sum_total"))
            .orderBy("avg_price"))


@register("group_agg_nulls_last", ON + f"""
SELECT o_custkey, o_orderpriority, {_exact_avg_sql('price_n')} AS avg_price, {_exact_sum_sql('price_n')} AS total_price
FROM orders_n GROUP BY o_custkey, o_orderpriority ORDER BY avg_price DESC NULLS LAST, o_custkey, o_orderpriority""")
def group_agg_nulls_last(spark, d):
    # One priority has no price, so its groups have no average.  The keys break ties, so
    # that equal or missing averages spread over the sort's ranges.
    return (orders_n(spark, d).groupBy("o_custkey", "o_orderpriority")
            .agg(exact_avg("price_n").alias("avg_price"), exact_sum("price_n").alias("total_price"))
            .orderBy(F.col("avg_price").desc_nulls_last(), "o_custkey", "o_orderpriority"))


@register("group_collect_parts", """
SELECT o_custkey, CAST(o_orderkey // 4096 AS BIGINT) AS part, count(*) AS n,
       array_to_string(list_sort(list(o_orderkey)), ',') AS orders
FROM orders GROUP BY o_custkey, o_orderkey // 4096""")
def group_collect_parts_q(spark, d):
    """All orders of each customer, in parts of a bounded key range."""
    parts = group_collect_parts(table(spark, d, "orders"), "o_custkey", "o_orderkey", 4096, "list")
    return parts.select("o_custkey", "part", F.size("list").cast("bigint").alias("n"),
                        F.array_join(F.col("list").cast("array<string>"), ",").alias("orders"))


@register("group_collect", """
SELECT o_custkey, array_to_string(list_sort(list(DISTINCT o_orderpriority)), ',') AS priorities
FROM orders GROUP BY o_custkey""")
def group_collect_q(spark, d):
    # collect_set is combined map-side and bounded by the distinct priorities.
    g = group_collect(table(spark, d, "orders"), "o_custkey", "o_orderpriority", distinct=True,
                      alias="plist")
    return g.select("o_custkey", F.array_join("plist", ",").alias("priorities"))


@register("group_avg_nonnull", ON + f"""
SELECT status_n, {_exact_avg_sql('price_n')} AS avg_price FROM orders_n
WHERE price_n IS NOT NULL GROUP BY status_n""")
def group_avg_nonnull(spark, d):
    return (orders_n(spark, d).where(F.col("price_n").isNotNull())
            .groupBy("status_n").agg(exact_avg("price_n").alias("avg_price")))
