"""Aggregates kept as states that are merged later without the rows.

``distinct_sketches``  HyperLogLog sketches by group; unions estimate distinct counts
``distinct_bitmaps``   bitmaps of integers by group; unions count distinct values exactly
``moments``            (n, means, co-moments) by group; merged pairwise they give variance,
                       deviation and correlation, also where the mean is large

A state has a fixed size (a bitmap: 4 KB for each 32,768 numbers in use), is combined
before the shuffle and can be stored; a longer period is rolled up from its parts.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablekit.functions import qcol

#: log2 of a sketch's buckets: a standard error of about 1.04 / 64 = 1.6 percent.
SKETCH_BITS = 12


def _columns(names: Sequence[str | Column]) -> list[Column]:
    return [qcol(c) if isinstance(c, str) else c for c in names]


def distinct_sketches(df: DataFrame, by: Sequence[str | Column], value: str, bits: int = SKETCH_BITS) -> DataFrame:
    """(by, sketch): one sketch of the values for each group."""
    return df.groupBy(*_columns(by)).agg(F.hll_sketch_agg(qcol(value), F.lit(bits)).alias("sketch"))


def merge_sketches(sketches: DataFrame, by: Sequence[str | Column]) -> DataFrame:
    """(by, sketch, estimate) of the unions."""
    return sketches.groupBy(*_columns(by)).agg(F.hll_union_agg("sketch").alias("sketch")).withColumn(
        "estimate", F.hll_sketch_estimate("sketch"))


def distinct_bitmaps(df: DataFrame, by: Sequence[str | Column], value: str) -> DataFrame:
    """(by, bucket, bitmap): which integers occur in each group; nulls are left out."""
    v = qcol(value)
    return df.where(v.isNotNull()).groupBy(*_columns(by), F.bitmap_bucket_number(v).alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(v)).alias("bitmap"))


def merge_bitmaps(bitmaps: DataFrame, by: Sequence[str | Column]) -> DataFrame:
    return bitmaps.groupBy(*_columns(by), "bucket").agg(F.bitmap_or_agg("bitmap").alias("bitmap"))


def count_bitmaps(bitmaps: DataFrame, by: Sequence[str | Column], name: str = "n") -> DataFrame:
    """(by, n): the exact number of different values."""
    merged = merge_bitmaps(bitmaps, by)
    return merged.groupBy(*_columns(by)).agg(F.sum(F.bitmap_count("bitmap")).alias(name))


MOMENTS = "struct<n:double,mean_x:double,mean_y:double,m2_x:double,m2_y:double,c:double>"


def moments(df: DataFrame, by: Sequence[str | Column], x: str, y: str) -> DataFrame:
    """(by, state): count, means, sums of squared deviations and of their products, over rows
    that have both values."""
    a, b = qcol(x).cast("double"), qcol(y).cast("double")
    n = F.count(F.lit(1)).cast("double")
    return df.where(a.isNotNull() & b.isNotNull()).groupBy(*_columns(by)).agg(F.struct(
        n.alias("n"), F.avg(a).alias("mean_x"), F.avg(b).alias("mean_y"), (F.var_pop(a) * n).alias("m2_x"),
        (F.var_pop(b) * n).alias("m2_y"), (F.covar_pop(a, b) * n).alias("c")).alias("state"))


def _added(a: Column, b: Column) -> Column:
    """Two states as one: the means' distance goes into the sums, so nothing large is subtracted."""
    n, dx, dy = a["n"] + b["n"], b["mean_x"] - a["mean_x"], b["mean_y"] - a["mean_y"]
    share = F.when(n > 0, b["n"] / n).otherwise(0.0)
    joint = a["n"] * share
    return F.struct(n.alias("n"), (a["mean_x"] + dx * share).alias("mean_x"), (a["mean_y"] + dy * share).alias("mean_y"),
                    (a["m2_x"] + b["m2_x"] + dx * dx * joint).alias("m2_x"),
                    (a["m2_y"] + b["m2_y"] + dy * dy * joint).alias("m2_y"),
                    (a["c"] + b["c"] + dx * dy * joint).alias("c"))


def merge_moments(states: DataFrame, by: Sequence[str | Column]) -> DataFrame:
    """(by, state): the states of a group as one, in a fixed order, so that the sums always round alike."""
    parts = F.array_sort(F.collect_list("state"))
    zero = F.lit(None).cast(MOMENTS)
    folded = F.aggregate(parts, zero, lambda a, b: F.when(a.isNull(), b).otherwise(_added(a, b)))
    return states.groupBy(*_columns(by)).agg(folded.alias("state"))


def deviation(state: Column, of: str = "x") -> Column:
    """The sample standard deviation; NULL for fewer than two rows."""
    return F.when(state["n"] > 1, F.sqrt(state[f"m2_{of}"] / (state["n"] - 1)))


def correlation(state: Column) -> Column:
    """Pearson's correlation; NULL where one side does not vary."""
    spread = F.sqrt(state["m2_x"]) * F.sqrt(state["m2_y"])
    return F.when(spread > 0, state["c"] / spread)
