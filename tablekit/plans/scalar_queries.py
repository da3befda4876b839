"""String, array, struct, date and arithmetic functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from tablekit.functions.scalars import age_years, element_at0, parse_date
from tablekit.plans.registry import register
from tablekit.plans.tables import AS_OF, table


@register("str_case", """
SELECT p_partkey, upper(p_name) AS name_upper, lower(p_brand) AS brand_lower FROM part""")
def str_case(spark, d):
    p = table(spark, d, "part")
    return p.select("p_partkey", F.upper("p_name").alias("name_upper"), F.lower("p_brand").alias("brand_lower"))


@register("str_initcap", """
SELECT p_partkey,
  array_to_string(list_transform(string_split(lower(p_name), ' '), lambda x: concat(upper(x[1]), x[2:])), ' ') AS name_initcap,
  array_to_string(list_transform(string_split(lower(p_type), ' '), lambda x: concat(upper(x[1]), x[2:])), ' ') AS type_initcap
FROM part""")
def str_initcap(spark, d):
    p = table(spark, d, "part")
    return p.select("p_partkey", F.initcap("p_name").alias("name_initcap"),
                    F.initcap("p_type").alias("type_initcap"))


@register("regex_extract_filter", r"""
SELECT p_partkey, p_name, regexp_extract(p_name, '(red|blue) (\w+)', 2) AS noun FROM part
WHERE regexp_extract(p_name, '(red|blue) (\w+)', 2) <> ''""")
def regex_extract_filter(spark, d):
    p = table(spark, d, "part")
    # No match gives '' (not NULL); the filter keeps the matches.
    return (p.select("p_partkey", "p_name", F.regexp_extract("p_name", r"(red|blue) (\w+)", 2).alias("noun"))
             .where(F.col("noun") != ""))


@register("regex_replace", """
SELECT p_partkey, regexp_replace(p_name, 'red|blue', 'owner''s', 'g') AS replaced FROM part""")
def regex_replace(spark, d):
    p = table(spark, d, "part")
    return p.select("p_partkey", F.regexp_replace("p_name", "red|blue", "owner's").alias("replaced"))


@register("split_words", """
SELECT doc_id,
       CAST(generate_subscripts(words, 1) - 1 AS INTEGER) AS pos,
       unnest(words) AS word
FROM (SELECT doc_id, string_split_regex(text, ' |,') AS words FROM documents)""")
def split_words(spark, d):
    # split keeps empty pieces (between a comma and a blank); posexplode gives 0-based positions.
    return table(spark, d, "documents").select("doc_id", F.posexplode(F.split("text", " |,")).alias("pos", "word"))


@register("array_first", """
SELECT doc_id, string_split(text, ' ')[1] AS first_word, string_split(text, ' ')[6] AS sixth_word
FROM documents""")
def array_first(spark, d):
    words = F.split("text", " ")
    return table(spark, d, "documents").select(
        "doc_id", element_at0(words, 0).alias("first_word"), element_at0(words, 5).alias("sixth_word"))


@register("array_size", """
SELECT p_partkey, CAST(len(string_split(p_name, ' ')) AS INTEGER) AS n_words FROM part""")
def array_size(spark, d):
    return table(spark, d, "part").select("p_partkey", F.size(F.split("p_name", " ")).alias("n_words"))


@register("array_contains", """
SELECT p_partkey, list_contains(string_split(p_name, ' '), 'ring') AS has_ring FROM part""")
def array_contains(spark, d):
    return table(spark, d, "part").select(
        "p_partkey", F.array_contains(F.split("p_name", " "), "ring").alias("has_ring"))


@register("struct_field", """
SELECT o_orderkey, o_totalprice AS profit_price FROM orders""")
def struct_field(spark, d):
    o = table(spark, d, "orders")
    s = o.select("o_orderkey", F.struct("o_totalprice", "o_custkey").alias("profit"))
    return s.select("o_orderkey", F.col("profit").getField("o_totalprice").alias("profit_price"))


@register("struct_expr", """
SELECT o_orderkey, o_totalprice AS profit_price, o_custkey AS profit_cust FROM orders""")
def struct_expr(spark, d):
    o = table(spark, d, "orders")
    s = o.selectExpr("o_orderkey", "(o_totalprice, o_custkey) AS profit")
    return s.selectExpr("o_orderkey", "profit.o_totalprice AS profit_price", "profit.o_custkey AS profit_cust")


@register("parse_date_short", """
SELECT o_orderkey,
       CAST(try_strptime(CASE WHEN o_orderstatus = 'P' THEN 'Unknown'
                              ELSE strftime(o_orderdate, '%d-%b-%y') END, '%d-%b-%y') AS DATE) AS release_date
FROM orders""")
def parse_date_short(spark, d):
    o = table(spark, d, "orders")
    text = F.when(F.col("o_orderstatus") == "P", F.lit("Unknown")).otherwise(
        F.date_format("o_orderdate", "d-MMM-yy"))
    # Two-digit years: a date after AS_OF is moved back a century.
    return o.select("o_orderkey", parse_date(text, "d-MMM-yy", as_of=AS_OF).alias("release_date"))


@register("parse_date_long", """
SELECT o_orderkey,
       CAST(try_strptime(CASE WHEN o_orderstatus = 'P' THEN 'bad date'
                              ELSE strftime(o_orderdate, '%b %-d %Y') END, '%b %-d %Y') AS DATE) AS actual_date
FROM orders""")
def parse_date_long(spark, d):
    o = table(spark, d, "orders")
    text = F.when(F.col("o_orderstatus") == "P", F.lit("bad date")).otherwise(
        F.date_format("o_orderdate", "MMM d yyyy"))
    return o.select("o_orderkey", parse_date(text, "MMM d yyyy").alias("actual_date"))


@register("age_years", f"""
SELECT o_orderkey, date_diff('day', CAST(o_orderdate AS DATE), DATE '{AS_OF}') / 365 AS age_years FROM orders""")
def age_years_q(spark, d):
    o = table(spark, d, "orders")
    return o.select("o_orderkey", age_years(F.col("o_orderdate").cast("date"), AS_OF).alias("age_years"))


@register("rating_blend", """
SELECT p_partkey, (p_size / 10 + p_retailprice) / 2 AS blend, p_size * 10 AS size_x10 FROM part""")
def rating_blend(spark, d):
    p = table(spark, d, "part")
    return p.select("p_partkey", ((F.col("p_size") / 10 + F.col("p_retailprice")) / 2).alias("blend"),
                    (F.col("p_size") * 10).alias("size_x10"))
