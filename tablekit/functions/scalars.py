"""Scalar helpers whose Spark 4 defaults differ from what callers expect.

* ANSI mode is on: ``to_date`` raises on bad input and ``arr[i]`` raises out of
  range, so the null-returning forms ``try_to_date`` and ``get`` are used.
* Two-digit years parse into 2000-2099; ``parse_date(pivot=...)`` moves dates
  after ``as_of`` back by a century.
* Money sums are done in DECIMAL so the result does not depend on the order in
  which partitions are combined.
"""

from __future__ import annotations

import datetime as _dt
import functools
import operator
import re
from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x):
    return F.col(x) if isinstance(x, str) else x


def _date_lit(d) -> Column:
    if isinstance(d, Column):
        return d
    if isinstance(d, (_dt.date, _dt.datetime)):
        d = d.isoformat()[:10]
    return F.to_date(F.lit(str(d)))


def parse_date(col, fmt: str, as_of=None) -> Column:
    """String to DATE; unparsable text gives NULL.

    With ``as_of`` set and a two-digit year in ``fmt``, a result later than
    ``as_of`` is moved back 100 years (``12-Jun-98`` -> 1998-06-12 rather than
    2098-06-12).  Years written in full are left alone.
    """
    d = F.try_to_date(_c(col), fmt)
    if as_of is None or not re.search("(?<![yu])(?:yy|uu)(?![yu])", re.sub("'[^']*'", "", fmt)):
        return d
    ref = _date_lit(as_of)
    return F.when(d > ref, F.add_months(d, -1200)).otherwise(d)


def age_years(date_col, as_of) -> Column:
    """Days from ``date_col`` to ``as_of`` divided by 365 (past dates positive)."""
    return F.datediff(_date_lit(as_of), _c(date_col)) / F.lit(365)


def row_sum(cols: Iterable, skip_nulls: bool = False) -> Column:
    """Sum across columns of one row; NULL if any part is NULL unless ``skip_nulls``."""
    parts = [_c(c) for c in cols]
    if skip_nulls:
        parts = [F.coalesce(p, F.lit(0)) for p in parts]
    return functools.reduce(operator.add, parts)


def exact_sum(col, scale: int = 2, precision: int = 18) -> Column:
    """Order-independent sum of a money column: DECIMAL inside, DOUBLE out."""
    return F.sum(_c(col).cast(f"decimal({precision},{scale})")).cast("double")


def exact_avg(col, scale: int = 2, precision: int = 18) -> Column:
    """Mean as exact DECIMAL sum over non-null count; NULL for an empty group."""
    c = _c(col)
    return (F.sum(c.cast(f"decimal({precision},{scale})")).cast("double")
            / F.count(c).cast("double"))


def element_at0(arr, index: int) -> Column:
    """Zero-based element access that yields NULL when out of range (ANSI safe)."""
    return F.get(_c(arr), index)
