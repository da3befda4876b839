"""Projection, selection and set helpers.

These are thin on purpose: Catalyst already prunes columns, combines and
pushes filters, and resolves a filter on a column the projection dropped.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame

from tablekit.functions import qcol


def with_flag(df: DataFrame, keep: Iterable[str], predicate: Column, name: str) -> DataFrame:
    """Project ``keep`` plus ``predicate`` as a boolean column ``name``."""
    return df.select(*[qcol(c) for c in keep], predicate.alias(name))


def where_flag(df: DataFrame, name: str, value: bool = True, drop: bool = False) -> DataFrame:
    """Rows whose flag is TRUE (or FALSE); a NULL flag matches neither."""
    cond = qcol(name) if value else ~qcol(name)
    out = df.where(cond)
    return out.drop(name) if drop else out


def rename(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Rename several columns at once; names may contain spaces."""
    return df.withColumnsRenamed(dict(mapping))


def union_positional(first: DataFrame, *others: DataFrame, check_types: bool = True) -> DataFrame:
    """UNION ALL by position (O1).

    Spark widens numeric types by position, but also resolves ``string`` with
    ``bigint`` to ``bigint`` and then fails at run time on the first non-number.
    With ``check_types`` such pairs are refused before anything runs.
    """
    out = first
    for other in others:
        if len(other.columns) != len(first.columns):
            raise ValueError("union by position needs the same number of columns")
        if check_types:
            for a, b in zip(first.schema.fields, other.schema.fields):
                sa, sb = a.dataType.simpleString(), b.dataType.simpleString()
                if (sa == "string") != (sb == "string"):
                    raise TypeError(f"column {a.name!r}: {sa} cannot be unioned with {sb}")
        out = out.union(other)
    return out


def union_by_name(first: DataFrame, *others: DataFrame, allow_missing: bool = False) -> DataFrame:
    out = first
    for other in others:
        out = out.unionByName(other, allowMissingColumns=allow_missing)
    return out
