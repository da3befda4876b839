"""Joins (J1-J19), including the array-membership join.

Equi-joins are left to the planner: with AQE a side that turns out small at
run time becomes a broadcast, and a skewed partition of a sort-merge join is
split.  ``array_contains`` as a join condition has no equi-key, so Spark plans
it as a cartesian product (inner) or a broadcast nested loop (outer).  Here the
array is exploded once per row and the join becomes an equi-join on the
element, which hashes, sorts and splits for skew like any other key.
"""

from __future__ import annotations

import functools
import operator
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablekit.functions import qcol

_E = "__tk_elem"


def _names(cols) -> list[str]:
    return [cols] if isinstance(cols, str) else list(cols)


def _ref(df: DataFrame, name: str) -> Column:
    """``df[name]`` taken literally (a dot is part of the name, not a field path)."""
    return df["`" + name.replace("`", "``") + "`"]


def _null_cols(df: DataFrame):
    return [F.lit(None).cast(f.dataType).alias(f.name) for f in df.schema.fields]


def join_on(left: DataFrame, right: DataFrame, left_on, right_on, how: str = "inner",
            skew_safe: bool = True) -> DataFrame:
    """Equi-join on differently named keys; both key columns are kept.

    With ``skew_safe`` (the default) a key holding a large share of the rows
    cannot pin one task:

    * semi / anti joins probe the right side's *distinct* keys, which are
      reduced map-side before the shuffle;
    * outer joins are built as inner join + anti joins.  AQE can split a skewed
      partition of an inner join on either side and of the streamed side of an
      anti join, but not the non-preserved side of an outer join.

    Rows with a null key match nothing and bypass the joins.  What is left of a
    side is the same shuffled input for its inner and its anti join, so Spark
    shuffles it once (a reused exchange); the price of the outer form is a
    shuffle of each other side's distinct keys.  Where keys are known to be
    evenly spread, ``skew_safe=False`` gives the single join.
    """
    lk, rk = _names(left_on), _names(right_on)
    how = {"left_outer": "left", "right_outer": "right", "outer": "full", "full_outer": "full",
           "semi": "left_semi", "anti": "left_anti", "leftsemi": "left_semi",
           "leftanti": "left_anti"}.get(how, how)

    def cond(a, b):
        return [_ref(a, x) == _ref(b, y) for x, y in zip(lk, rk)]

    if not skew_safe or how in ("inner", "cross"):
        return left.join(right, cond(left, right), how)
    if how in ("left_semi", "left_anti"):
        keys = right.select(*[qcol(c) for c in rk]).distinct()
        return left.join(keys, cond(left, keys), how)
    if how not in ("left", "right", "full"):
        return left.join(right, cond(left, right), how)
    lnull = functools.reduce(operator.or_, [qcol(c).isNull() for c in lk])
    rnull = functools.reduce(operator.or_, [qcol(c).isNull() for c in rk])
    keyed_left, keyed_right = left.where(~lnull), right.where(~rnull)
    parts = [keyed_left.join(keyed_right, cond(keyed_left, keyed_right), "inner")]
    if how in ("left", "full"):
        rkeys = keyed_right.select(*[qcol(c) for c in rk]).distinct()
        for only in (keyed_left.join(rkeys, cond(keyed_left, rkeys), "left_anti"), left.where(lnull)):
            parts.append(only.select(*[qcol(c) for c in left.columns], *_null_cols(right)))
    if how in ("right", "full"):
        lkeys = keyed_left.select(*[qcol(c) for c in lk]).distinct()
        for only in (keyed_right.join(lkeys, [_ref(keyed_right, y) == _ref(lkeys, x) for x, y in zip(lk, rk)],
                                      "left_anti"), right.where(rnull)):
            parts.append(only.select(*_null_cols(left), *[qcol(c) for c in right.columns]))
    out = parts[0]
    for p in parts[1:]:
        out = out.union(p)
    return out


def join_using(left: DataFrame, right: DataFrame, key, right_key=None, how: str = "inner") -> DataFrame:
    """USING join: the key appears once and first (J7); outer forms are hot-key safe."""
    keys, right_keys = _names(key), _names(right_key if right_key is not None else key)
    if how in ("left_semi", "left_anti", "semi", "anti"):
        return join_on(left, right, keys, right_keys, how)
    joined = _positions(join_on(left, right, keys, right_keys, how))
    at_left = [left.columns.index(k) for k in keys]
    at_right = [len(left.columns) + right.columns.index(k) for k in right_keys]
    names = left.columns + right.columns
    once = [F.coalesce(_at(i), _at(j)).alias(k) for i, j, k in zip(at_left, at_right, keys)]
    rest = [_at(i).alias(n) for i, n in enumerate(names) if i not in at_left and i not in at_right]
    return joined.select(*once, *rest)


def _at(i: int) -> Column:
    return F.col(f"__tk_c{i}")


def _positions(df: DataFrame) -> DataFrame:
    """``df`` with columns named by position, so that equal names can be told apart."""
    return df.toDF(*[f"__tk_c{i}" for i in range(len(df.columns))])


def join_drop_right_key(left: DataFrame, right: DataFrame, left_on: str, right_on: str,
                        how: str = "inner") -> DataFrame:
    """Join, then drop the right-hand copy of the key by reference.

    A row that only the right side has keeps its key, in the left key's column.
    """
    joined = _positions(join_on(left, right, left_on, right_on, how))
    names = left.columns + right.columns
    kept, dropped = left.columns.index(left_on), len(left.columns) + right.columns.index(right_on)
    return joined.select(*[(F.coalesce(_at(i), _at(dropped)) if i == kept else _at(i)).alias(n)
                           for i, n in enumerate(names) if i != dropped])


def join_with(left: DataFrame, right: DataFrame, left_on, right_on, how: str = "inner",
              names: tuple[str, str] = ("_1", "_2"), skew_safe: bool = True) -> DataFrame:
    """Pair join on equal keys: each side kept whole as one struct.

    On an outer join the side without a match is a NULL struct, not a struct of
    NULLs.  The keys are given by name, so the join always has an equality to
    hash or sort on; the outer forms are those of :func:`join_on`.
    """
    pair = "__tk_side"
    whole = lambda df: F.struct(*[_ref(df, c) for c in df.columns]).alias(pair)
    lk, rk = _names(left_on), _names(right_on)
    a = left.select(whole(left), *[_ref(left, k).alias(f"__tk_l{i}") for i, k in enumerate(lk)])
    b = right.select(whole(right), *[_ref(right, k).alias(f"__tk_r{i}") for i, k in enumerate(rk)])
    joined = _positions(join_on(a, b, [f"__tk_l{i}" for i in range(len(lk))],
                                [f"__tk_r{i}" for i in range(len(rk))], how, skew_safe))
    return joined.select(_at(0).alias(names[0]), _at(len(a.columns)).alias(names[1]))


def _explode_distinct(left: DataFrame, array_col: str) -> DataFrame:
    # NULL arrays, empty arrays and NULL elements produce no rows: none of them
    # can satisfy array_contains.
    return (left.withColumn(_E, F.explode(F.array_distinct(qcol(array_col))))
                .where(F.col(_E).isNotNull()))


def array_join(left: DataFrame, right: DataFrame, array_col: str, value_col: str,
               how: str = "inner", left_key: Sequence[str] | str | None = None,
               right_key: Sequence[str] | str | None = None) -> DataFrame:
    """Rows of ``left`` and ``right`` where ``array_contains(left[array_col], _ref(right, value_col))``.

    ``how`` is ``inner``, ``left``, ``right`` or ``full``.  Each matching pair
    appears once even if the element repeats in the array.  The outer forms
    need a unique row key on each side that lacks a partner (``left_key`` /
    ``right_key``): unmatched rows are found with anti-joins on the element,
    never by exploding them into a spurious NULL row.
    """
    if how not in ("inner", "left", "right", "full"):
        raise ValueError(f"unsupported join type {how!r}")
    exploded = _explode_distinct(left, array_col)
    pairs = (exploded.join(right, _ref(exploded, _E) == _ref(right, value_col), "inner")
                     .select(*[_ref(exploded, c) for c in left.columns],
                             *[_ref(right, c) for c in right.columns]))
    if how == "inner":
        return pairs
    parts = [pairs]
    if how in ("left", "full"):
        if left_key is None:
            raise ValueError("outer array join needs left_key")
        lk = _names(left_key)
        values = right.select(qcol(value_col).alias(_E)).distinct()
        matched_left = exploded.join(values, _E, "left_semi").select(*[qcol(c) for c in lk])
        unmatched = left.join(matched_left, lk, "left_anti")
        parts.append(unmatched.select(*[qcol(c) for c in left.columns],
                                      *[F.lit(None).cast(f.dataType).alias(f.name)
                                        for f in right.schema.fields]))
    if how in ("right", "full"):
        if right_key is None and how == "full":
            raise ValueError("outer array join needs right_key")
        # Distinct elements, reduced map-side first: a hot element reaches the
        # shuffle once per task instead of once per row.
        elems = exploded.select(F.col(_E)).distinct()
        unmatched = right.join(elems, _ref(right, value_col) == _ref(elems, _E), "left_anti")
        parts.append(unmatched.select(*[F.lit(None).cast(f.dataType).alias(f.name)
                                        for f in left.schema.fields],
                                      *[qcol(c) for c in right.columns]))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def max_per_key_join(entities: DataFrame, facts: DataFrame, key: str, value: str,
                     alias: str, fact_key: str | None = None) -> DataFrame:
    """Aggregate facts per key, then USING-join back to the entities."""
    fk = fact_key or key
    agg = facts.groupBy(F.col(fk).alias(key)).agg(F.max(value).alias(alias))
    return entities.join(agg, key)


def never_matched(entities: DataFrame, roles: DataFrame, key: str, role_key: str | None = None) -> DataFrame:
    """Entities with no row in ``roles`` (J15): a left anti join."""
    return join_on(entities, roles, key, role_key or key, "left_anti")
