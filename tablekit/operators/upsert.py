"""Keyed update and upsert of one table from another.

The change set is applied as one set-based plan instead of per-row
SELECT/UPDATE/INSERT statements:

* update  = the target, every row with a changed key replaced by the change row
* upsert  = update UNION ALL the changes whose key is not in the target

A change row wins whole, NULLs included.  If the target holds a key more than
once, every one of its rows is updated, as SQL's UPDATE does.  Duplicate keys in the change set are
resolved by an explicit ``order_by`` (largest wins) through a map-side combined
aggregate; without ``order_by`` duplicates are an error.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablekit.functions import qcol

from tablekit.operators.aggregate import pick_per_key


def _names(cols) -> list[str]:
    return [cols] if isinstance(cols, str) else list(cols)


def _q(names):
    return [qcol(c) for c in names]


def change_set(df: DataFrame, predicate: Column | str, rewrites: Mapping[str, Column]) -> DataFrame:
    """Filter, then rewrite columns in place, keeping the column order."""
    out = df.where(predicate)
    return out.withColumns(dict(rewrites))


def assert_unique_keys(df: DataFrame, key) -> None:
    """Raise if any key occurs twice (runs one aggregate job)."""
    dup = df.groupBy(*_names(key)).count().where(F.col("count") > 1).limit(1).count()
    if dup:
        raise ValueError(f"change set has duplicate keys on {key}; pass order_by to pick one")


def dedup_changes(changes: DataFrame, key, order_by) -> DataFrame:
    """Keep the change with the largest ``order_by`` per key."""
    return pick_per_key(changes, key, order_by, latest=True).select(*_q(changes.columns))


def classify(changes: DataFrame, target: DataFrame, key, op_col: str = "op") -> DataFrame:
    """Tag each change UPDATE (key exists in target) or INSERT.

    The target's keys are first reduced to those present in the change set (a
    semi join, which streams the target past the usually small change keys);
    the changes are then tagged with a left join to that reduced key set.
    """
    k = _names(key)
    hit = "__tk_hit"
    # The change keys are reduced map-side before the probe; the matched
    # target keys are de-duplicated after it, where they number at most the
    # change set (the whole target's keys are never aggregated).
    present = (target.select(*_q(k)).join(changes.select(*_q(k)).distinct(), k, "left_semi")
                     .distinct().withColumn(hit, F.lit(True)))
    tagged = changes.join(present, k, "left")
    op = F.when(F.col(hit), F.lit("UPDATE")).otherwise(F.lit("INSERT"))
    return tagged.select(*_q(changes.columns), op.alias(op_col))


def _prepare(target: DataFrame, changes: DataFrame, key, order_by, validate: bool) -> DataFrame:
    missing = [c for c in target.columns if c not in changes.columns]
    if missing:
        raise ValueError(f"change set lacks target columns {missing}")
    if order_by is not None:
        changes = dedup_changes(changes, key, order_by)
    elif validate:
        assert_unique_keys(changes, key)
    return changes.select(*_q(target.columns))


def estimated_bytes(df: DataFrame) -> int:
    """The planner's estimate of a frame's size, from file sizes; filters and projections do not lower it much."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def upsert(target: DataFrame, changes: DataFrame, key, order_by: Sequence[str] | str | None = None,
           validate: bool = True, stream_target: bool | None = None) -> DataFrame:
    """The full new target after UPDATE-or-INSERT of ``changes`` by ``key``.

    Both sides are read once and meet in one full outer join on the change set's unique
    keys.  With ``stream_target`` the target is not shuffled: it streams past a broadcast
    of the changes and, its keys alone, past them again to find the inserts.  By default
    that is done if the changes are estimated below the broadcast limit and a tenth of the
    target.
    """
    ch = _prepare(target, changes, key, order_by, validate)
    if stream_target is None:
        limit = int(target.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold())
        size = estimated_bytes(ch)
        stream_target = size <= limit and 10 * size <= estimated_bytes(target)
    if not stream_target:
        return _merged(target, ch, _names(key))
    op = "__tk_op"
    inserts = classify(ch, target, key, op).where(F.col(op) == "INSERT").select(*_q(target.columns))
    return _updated(target, ch, key).unionByName(inserts)


def _merged(target: DataFrame, ch: DataFrame, key: list[str]) -> DataFrame:
    """Every row of either side; where both have the key, the change row."""
    hit = "__tk_hit"
    theirs = ch.select(*[qcol(c).alias(f"__tk_c_{c}") for c in ch.columns], F.lit(True).alias(hit))
    same = [qcol(c) == qcol(f"__tk_c_{c}") for c in key]
    on = same[0]
    for more in same[1:]:
        on = on & more
    return target.join(theirs, on, "full").select(*[
        F.when(F.col(hit), qcol(f"__tk_c_{c}")).otherwise(qcol(c)).alias(c) for c in target.columns])


def update_matched(target: DataFrame, changes: DataFrame, key,
                   order_by: Sequence[str] | str | None = None, validate: bool = True) -> DataFrame:
    """The full new target after UPDATE only; changes without a target row are ignored (U4).

    One left join of the target to the (key-unique) changes: a matched row
    takes the change row whole, NULLs included; an unmatched row is kept.
    """
    return _updated(target, _prepare(target, changes, key, order_by, validate), key)


def _updated(target: DataFrame, ch: DataFrame, key) -> DataFrame:
    k = _names(key)
    hit = "__tk_hit"
    ch2 = ch.select(*[qcol(c).alias(f"__tk_c_{c}") if c not in k else qcol(c) for c in ch.columns],
                    F.lit(True).alias(hit))
    joined = target.join(ch2, k, "left")
    cols = [qcol(c) if c in k else
            F.when(F.col(hit), qcol(f"__tk_c_{c}")).otherwise(qcol(c)).alias(c)
            for c in target.columns]
    return joined.select(*cols)
