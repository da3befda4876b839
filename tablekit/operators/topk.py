"""Sorting and top-k (K1-K4).

``orderBy(...).limit(k)`` plans as ``TakeOrderedAndProject``: every task keeps
its own k best rows and only those reach the final merge, so no full sort or
shuffle of the input happens.  A unique tie-break makes the k rows well defined.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablekit.functions import qcol
from tablekit.operators.staging import stage


def _order(spec) -> Column:
    if isinstance(spec, Column):
        return spec
    # "name [direction]": the direction is the last word, if it is one, so a
    # column name may itself contain blanks.
    directions = {
        "asc": "asc", "desc": "desc", "asc_nulls_last": "asc_nulls_last",
        "asc_nulls_first": "asc_nulls_first", "desc_nulls_last": "desc_nulls_last",
        "desc_nulls_first": "desc_nulls_first",
    }
    head, _, last = spec.rpartition(" ")
    if head and last.lower() in directions:
        name, direction = head, directions[last.lower()]
    else:
        name, direction = spec, "asc"
    return getattr(qcol(name), direction)()


def sort(df: DataFrame, order: Sequence) -> DataFrame:
    return df.orderBy(*[_order(o) for o in order])


def top_k(df: DataFrame, k: int, order: Sequence, tie_break: Sequence = ()) -> DataFrame:
    """The first ``k`` rows under ``order`` then ``tie_break`` (unique columns)."""
    return sort(df, list(order) + list(tie_break)).limit(k)


def with_row_number(df: DataFrame, *order: Column, name: str = "row_number", partitions: int | None = None) -> DataFrame:
    """The rows numbered 1..n in a global order, without gaps and without a single-task window.

    Rows are range-partitioned and sorted, written once, and counted by partition; the
    driver holds one count for each partition, and a row's number is the rows of the
    partitions before it plus its place in its own.  ``order`` should end in a unique
    column; rows that tie are numbered in any order.
    """
    spark, place = df.sparkSession, "__tk_place"
    ranged = df.repartitionByRange(partitions, *order) if partitions else df.repartitionByRange(*order)
    rows = stage(ranged.sortWithinPartitions(*order).withColumn(place, F.monotonically_increasing_id()), "numbered")
    part = F.shiftright(place, 33)
    counts = sorted(rows.groupBy(part.alias("part")).count().collect())
    before, offsets = 0, []
    for p, n in counts:
        offsets.append((p, before))
        before += n
    known = spark.createDataFrame(offsets, "__tk_part long, __tk_before long")
    within = F.col(place).bitwiseAND((1 << 33) - 1)
    return rows.join(F.broadcast(known), part == F.col("__tk_part")).select(
        *[qcol(c) for c in df.columns], (F.col("__tk_before") + within + 1).alias(name))
