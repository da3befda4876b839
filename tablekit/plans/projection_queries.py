"""Projections, predicates, set operations, null handling and sorting
(P1-P10, F1-F13, O1-O2, X17-X23, K1-K4, C1)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tablekit.functions.predicates import all_of, contains_any, regex_any
from tablekit.functions.scalars import row_sum
from tablekit.operators.project import rename, union_positional, where_flag, with_flag
from tablekit.operators.topk import sort, top_k
from tablekit.plans.registry import register
from tablekit.plans.tables import ORDERS_N_SQL, orders_n, table

ON = f"WITH {ORDERS_N_SQL}\n"

# --- projections -----------------------------------------------------------


@register("select_columns", """
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate FROM orders""")
def select_columns(spark, d):
    o = table(spark, d, "orders")
    # Five spellings of a column reference; all resolve to the same attribute.
    return o.select(F.col("o_orderkey"), F.column("o_custkey"), o["o_orderstatus"],
                    o.o_totalprice, F.expr("o_orderdate"))


@register("computed_column", """
SELECT p_partkey, p_retailprice / 2 AS half_price, p_size * 2 AS double_size FROM part""")
def computed_column(spark, d):
    p = table(spark, d, "part")
    return p.select("p_partkey", (F.col("p_retailprice") / 2).alias("half_price"),
                    F.expr("p_size * 2").alias("double_size"))


@register("select_expr", """
SELECT p_partkey, p_name, p_retailprice / CAST(2.2 AS DOUBLE) AS price_per_unit FROM part""")
def select_expr(spark, d):
    # 2.2D: a bare 2.2 in SQL text is DECIMAL, which would change the result type.
    return table(spark, d, "part").selectExpr(
        "p_partkey", "p_name", "p_retailprice / 2.2D AS price_per_unit")


@register("with_column", """
SELECT *, p_retailprice * 2 AS price_x2 FROM part""")
def with_column(spark, d):
    return table(spark, d, "part").withColumn("price_x2", F.col("p_retailprice") * 2)


@register("rename_column", """
SELECT p_partkey, p_retailprice AS "retail price", p_retailprice * 2 AS "double price" FROM part""")
def rename_column(spark, d):
    p = rename(table(spark, d, "part"), {"p_retailprice": "retail price"})
    return p.selectExpr("p_partkey", "`retail price`", "`retail price` * 2 AS `double price`")


@register("drop_columns", """
SELECT p_partkey, p_name, p_size, p_retailprice FROM part""")
def drop_columns(spark, d):
    return table(spark, d, "part").drop("p_type", "p_brand")


@register("literal_column", """
SELECT p_partkey, 2024 AS catalogue_year FROM part""")
def literal_column(spark, d):
    return table(spark, d, "part").select("p_partkey", F.lit(2024).alias("catalogue_year"))


@register("row_sum_nulls", ON + """
SELECT o_orderkey, price_n + o_totalprice + CAST(cust_n AS DOUBLE) AS total FROM orders_n""")
def row_sum_nulls(spark, d):
    o = orders_n(spark, d)
    total = row_sum([F.col("price_n"), F.col("o_totalprice"), F.col("cust_n").cast("double")])
    return o.select("o_orderkey", total.alias("total"))


# --- predicates ------------------------------------------------------------

@register("filter_ne", """
SELECT c_custkey, c_name, c_mktsegment FROM customer WHERE c_mktsegment <> 'BUILDING'""")
def filter_ne(spark, d):
    c = table(spark, d, "customer")
    return c.select("c_custkey", "c_name", "c_mktsegment").filter(F.col("c_mktsegment") != "BUILDING")


@register("filter_sql", """
SELECT c_custkey, c_name FROM customer WHERE c_mktsegment = 'MACHINERY'""")
def filter_sql(spark, d):
    return table(spark, d, "customer").where("c_mktsegment = 'MACHINERY'").select("c_custkey", "c_name")


@register("filter_and", """
SELECT c_custkey, c_acctbal FROM customer WHERE c_mktsegment = 'AUTOMOBILE' AND c_acctbal > 5000""")
def filter_and(spark, d):
    c = table(spark, d, "customer")
    # Chained filters; Catalyst combines them into one pushed-down conjunction.
    return (c.filter(F.col("c_mktsegment") == "AUTOMOBILE").where("c_acctbal > 5000")
             .select("c_custkey", "c_acctbal"))


def _preferred_part():
    economy = F.col("p_type") == "ECONOMY"
    pricey = F.col("p_retailprice") > 950
    return all_of([economy, pricey])


@register("filter_named", """
SELECT p_partkey, p_name FROM part WHERE p_type = 'ECONOMY' AND p_retailprice > 950""")
def filter_named(spark, d):
    return table(spark, d, "part").filter(_preferred_part()).select("p_partkey", "p_name")


@register("flag_true", """
SELECT p_partkey, p_name, true AS good_part FROM part
WHERE p_type = 'ECONOMY' AND p_retailprice > 950""")
def flag_true(spark, d):
    flagged = with_flag(table(spark, d, "part"), ["p_partkey", "p_name"], _preferred_part(), "good_part")
    return where_flag(flagged, "good_part")


@register("flag_false", ON + """
SELECT o_orderkey FROM orders_n
WHERE NOT (prio_n = '1-URGENT' AND price_n > 200000)""")
def flag_false(spark, d):
    pred = (F.col("prio_n") == "1-URGENT") & (F.col("price_n") > 200000)
    flagged = with_flag(orders_n(spark, d), ["o_orderkey"], pred, "flag")
    # NOT(NULL) is NULL, so rows with an unknown flag drop out.
    return where_flag(flagged, "flag", value=False, drop=True)


@register("filter_hidden_col", """
SELECT p_name, p_retailprice FROM part WHERE p_type = 'ECONOMY'""")
def filter_hidden_col(spark, d):
    # The analyzer resolves p_type below the projection that dropped it.
    return table(spark, d, "part").select("p_name", "p_retailprice").where(F.col("p_type") == "ECONOMY")


@register("contains", """
SELECT p_partkey, p_name FROM part WHERE contains(p_name, 'ring')""")
def contains(spark, d):
    return table(spark, d, "part").where(F.col("p_name").contains("ring")).select("p_partkey", "p_name")


# The list of names the list-predicate queries look for.
NAME_LIST = ["Red", "Blue", "Gear"]


@register("contains_any", """
SELECT p_partkey, p_name FROM part
WHERE contains(lower(p_name), 'red') OR contains(lower(p_name), 'blue') OR contains(lower(p_name), 'gear')""")
def contains_any_q(spark, d):
    p = table(spark, d, "part")
    return p.where(contains_any("p_name", NAME_LIST, lower=True)).select("p_partkey", "p_name")


@register("regex_any", """
SELECT p_partkey, p_name FROM part WHERE regexp_extract(lower(p_name), 'red|blue|gear', 0) <> ''""")
def regex_any_q(spark, d):
    p = table(spark, d, "part")
    return p.where(regex_any(F.lower(F.col("p_name")), NAME_LIST, lower=True)).select("p_partkey", "p_name")


@register("typed_filter_count", ON + """
SELECT count(*) AS n FROM orders_n WHERE coalesce(price_n, 0) > 140000""")
def typed_filter_count(spark, d):
    return (orders_n(spark, d).where(F.coalesce(F.col("price_n"), F.lit(0)) > 140000)
            .agg(F.count(F.lit(1)).alias("n")))


@register("date_range_count", """
SELECT count(*) AS n FROM orders
WHERE CAST(o_orderdate AS DATE) > DATE '1999-01-01' AND CAST(o_orderdate AS DATE) < DATE '2000-01-01'""")
def date_range_count(spark, d):
    return spark.sql(
        "SELECT count(*) AS n FROM {o} "
        "WHERE CAST(o_orderdate AS DATE) > DATE'1999-01-01' AND CAST(o_orderdate AS DATE) < DATE'2000-01-01'",
        o=table(spark, d, "orders"))


@register("sql_filter", """
SELECT c_name FROM customer WHERE c_mktsegment = 'AUTOMOBILE'""")
def sql_filter(spark, d):
    return spark.sql("SELECT c_name FROM {customer} WHERE c_mktsegment = 'AUTOMOBILE'",
                     customer=table(spark, d, "customer"))


@register("is_null", ON + """
SELECT * FROM orders_n WHERE price_n IS NULL""")
def is_null(spark, d):
    return orders_n(spark, d).select("*").where(F.col("price_n").isNull())


@register("is_not_null", ON + """
SELECT o_orderkey, prio_n FROM orders_n WHERE prio_n IS NOT NULL""")
def is_not_null(spark, d):
    return orders_n(spark, d).where(F.col("prio_n").isNotNull()).select("o_orderkey", "prio_n")


# --- set operations --------------------------------------------------------

@register("union_all", """
SELECT p_partkey, p_name, p_retailprice FROM part
UNION ALL
SELECT s_suppkey, s_name, s_nationkey FROM supplier""")
def union_all(spark, d):
    p = table(spark, d, "part").select("p_partkey", "p_name", "p_retailprice")
    s = table(spark, d, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    # By position: s_nationkey (int) widens to double under p_retailprice.
    return union_positional(p, s)


@register("distinct_values", """
SELECT DISTINCT p_brand FROM part""")
def distinct_values(spark, d):
    return table(spark, d, "part").select("p_brand").distinct()


# --- null handling ---------------------------------------------------------

@register("null_coalesce", ON + """
SELECT o_orderkey, price_n, coalesce(price_n, o_totalprice * 10) AS price_or_10x FROM orders_n""")
def null_coalesce(spark, d):
    o = orders_n(spark, d)
    return o.select("o_orderkey", "price_n",
                    F.coalesce(F.col("price_n"), F.col("o_totalprice") * 10).alias("price_or_10x"))


@register("null_functions", ON + """
SELECT o_orderkey,
       coalesce(price_n, cust_n * 10) AS if_null,
       coalesce(price_n, cust_n * 10) AS nvl,
       nullif(prio_n, '1-URGENT') AS null_if,
       CASE WHEN price_n IS NOT NULL THEN cust_n * 10 ELSE 0 END AS nvl2
FROM orders_n""")
def null_functions(spark, d):
    return orders_n(spark, d).selectExpr(
        "o_orderkey",
        "ifnull(price_n, cust_n * 10) AS if_null",
        "nvl(price_n, cust_n * 10) AS nvl",
        "nullif(prio_n, '1-URGENT') AS null_if",
        "nvl2(price_n, cust_n * 10, 0) AS nvl2")


@register("na_drop", ON + """
SELECT o_orderkey, price_n, prio_n FROM orders_n WHERE price_n IS NOT NULL AND prio_n IS NOT NULL""")
def na_drop(spark, d):
    return orders_n(spark, d).select("o_orderkey", "price_n", "prio_n").na.drop()


@register("na_fill_list", ON + """
SELECT o_orderkey, coalesce(price_n, 0) AS price_n, coalesce(cust_n, 0) AS cust_n FROM orders_n""")
def na_fill_list(spark, d):
    return (orders_n(spark, d).select("o_orderkey", "price_n", "cust_n")
            .na.fill(0, subset=["price_n", "cust_n"]))


@register("na_fill_map", ON + """
SELECT o_orderkey, coalesce(price_n, 0) AS price_n, coalesce(cust_n, 10) AS cust_n,
       coalesce(prio_n, 'Unknown') AS prio_n FROM orders_n""")
def na_fill_map(spark, d):
    return (orders_n(spark, d).select("o_orderkey", "price_n", "cust_n", "prio_n")
            .na.fill({"price_n": 0, "cust_n": 10, "prio_n": "Unknown"}))


# --- sorting and top-k -----------------------------------------------------

@register("sort_asc", ON + """
SELECT o_orderkey, price_n FROM orders_n ORDER BY price_n ASC NULLS FIRST, o_orderkey""")
def sort_asc(spark, d):
    # A full ascending sort: range-partitioned by sampled bounds, every row kept.
    return sort(orders_n(spark, d).select("o_orderkey", "price_n"), ["price_n", "o_orderkey"])


@register("sort_asc_limit", ON + """
SELECT o_orderkey, price_n FROM orders_n ORDER BY price_n ASC NULLS FIRST, o_orderkey LIMIT 10""")
def sort_asc_limit(spark, d):
    # Ascending puts NULLs first in Spark (DuckDB would put them last by default).
    return top_k(orders_n(spark, d), 10, ["price_n"], ["o_orderkey"]).select("o_orderkey", "price_n")


@register("topk", """
SELECT o_orderkey, o_custkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10""")
def topk(spark, d):
    o = table(spark, d, "orders")
    return top_k(o, 10, ["o_totalprice desc"], ["o_orderkey"]).select("o_orderkey", "o_custkey", "o_totalprice")


@register("topk_nulls_last", ON + """
SELECT o_orderkey, price_n FROM orders_n ORDER BY price_n DESC NULLS LAST, o_orderkey LIMIT 10""")
def topk_nulls_last(spark, d):
    o = orders_n(spark, d)
    return top_k(o, 10, ["price_n desc_nulls_last"], ["o_orderkey"]).select("o_orderkey", "price_n")
