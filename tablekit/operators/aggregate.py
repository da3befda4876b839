"""Aggregates (A1-A19) and per-key selection.

"Latest row per key" and "record with the smallest value" are written as
``max``/``min`` over a struct whose leading fields are the ordering.  Unlike a
``row_number`` window, this aggregate is combined map-side, so a key that holds
a third of the rows is reduced inside every input task before the shuffle and
no task ever sees the whole group.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablekit.functions import qcol

_W = "__tk_pick"


def _names(cols) -> list[str]:
    return [cols] if isinstance(cols, str) else list(cols)


def pick_per_key(df: DataFrame, key, order_by, latest: bool = True,
                 payload: Sequence[str] | None = None) -> DataFrame:
    """One row per ``key``: the one with the largest (or smallest) ``order_by``.

    ``order_by`` must end with a column that is unique within a key so that the
    choice is deterministic.  Result columns: keys, then the other columns in
    the input order.
    """
    keys = _names(key)
    order = _names(order_by)
    rest = [c for c in (payload or df.columns) if c not in keys and c not in order]
    fields = [qcol(c).alias(f"o{i}") for i, c in enumerate(order)]
    fields += [qcol(c).alias(f"p{i}") for i, c in enumerate(rest)]
    agg = F.max if latest else F.min
    picked = df.groupBy(*keys).agg(agg(F.struct(*fields)).alias(_W))
    out_cols = [qcol(k) for k in keys]
    names = {c: f"o{i}" for i, c in enumerate(order)}
    names.update({c: f"p{i}" for i, c in enumerate(rest)})
    for c in df.columns:
        if c in keys:
            continue
        if c in names:
            out_cols.append(F.col(f"{_W}.{names[c]}").alias(c))
    return picked.select(*out_cols)


def latest_per_key(df: DataFrame, key, order_by) -> DataFrame:
    """Most recent row per key (J16b); ties broken by the last ``order_by`` column."""
    return pick_per_key(df, key, order_by, latest=True)


def min_record(df: DataFrame, order_by) -> DataFrame:
    """The whole row with the smallest ``order_by`` (A17), as one row.

    Each task keeps its own minimum; the final merge sees one row per task.
    """
    order = _names(order_by)
    rest = [c for c in df.columns if c not in order]
    fields = [qcol(c).alias(f"o{i}") for i, c in enumerate(order)]
    fields += [qcol(c).alias(f"p{i}") for i, c in enumerate(rest)]
    picked = df.agg(F.min(F.struct(*fields)).alias(_W))
    names = {c: f"o{i}" for i, c in enumerate(order)}
    names.update({c: f"p{i}" for i, c in enumerate(rest)})
    return picked.select(*[F.col(f"{_W}.{names[c]}").alias(c) for c in df.columns])


def group_collect(df: DataFrame, key, value: str, distinct: bool = True,
                  sort: bool = True, alias: str | None = None) -> DataFrame:
    """Values of each group as an array.

    ``distinct=True`` (``collect_set``) is combined map-side and its size is
    bounded by the number of distinct values; ``collect_list`` keeps every row
    and should only be used where groups are known to be small.
    """
    coll = F.collect_set(value) if distinct else F.collect_list(value)
    if sort:
        coll = F.sort_array(coll)
    return df.groupBy(*_names(key)).agg(coll.alias(alias or f"{value}_list"))


def group_collect_parts(df: DataFrame, key, value: str, width: int, alias: str) -> DataFrame:
    """All values per key (A18), sorted, in parts by value range.

    Part p holds the key's values from ``p * width`` on, so for an integer column
    that is unique within a key a part has at most ``width`` values, however many
    rows the key has.  The parts in order are the whole collection.
    """
    part = F.floor(qcol(value) / F.lit(width)).cast("bigint").alias("part")
    return df.groupBy(*_names(key), part).agg(F.sort_array(F.collect_list(qcol(value))).alias(alias))


def mean_null_as_zero(col: str) -> Column:
    """Sum with NULL as 0, integer-divided by the row count."""
    return F.expr(f"CAST(sum(coalesce(`{col}`, 0)) AS BIGINT) div count(1)")
