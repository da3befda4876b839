"""Reusable predicates.

Predicates are plain Column values, so they compose with ``&``/``|`` and stay
inside whole-stage codegen; Catalyst's boolean simplification removes the
neutral ``lit(False)`` / ``lit(True)`` seeds of the folds.
"""

from __future__ import annotations

import functools
import operator
import re
from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F


def any_of(predicates: Iterable[Column]) -> Column:
    """OR-fold of predicates seeded with FALSE: an empty list matches nothing."""
    return functools.reduce(operator.or_, predicates, F.lit(False))


def all_of(predicates: Iterable[Column]) -> Column:
    """AND-fold of predicates seeded with TRUE: an empty list matches everything."""
    return functools.reduce(operator.and_, predicates, F.lit(True))


def contains_any(col: Column | str, needles: Iterable[str], lower: bool = False) -> Column:
    """True when ``col`` contains any of ``needles`` (case sensitive unless ``lower``)."""
    c = F.col(col) if isinstance(col, str) else col
    if lower:
        c = F.lower(c)
        needles = [n.lower() for n in needles]
    return any_of(c.contains(n) for n in needles)


def regex_alternation(needles: Iterable[str], lower: bool = False) -> str:
    """One regex matching any literal in ``needles``; each literal is escaped."""
    items = [n.lower() if lower else n for n in needles]
    return "|".join(re.escape(n) for n in items)


def regex_any(col: Column | str, needles: Iterable[str], lower: bool = False) -> Column:
    """Same result as :func:`contains_any` with one regex evaluation per row.

    An empty list has no regex form (the empty pattern matches everything), so
    it returns FALSE, as the OR-fold does.
    """
    items = list(needles)
    if not items:
        return F.lit(False)
    c = F.col(col) if isinstance(col, str) else col
    # rlike, not regexp_extract(...) != '': an empty needle must match every
    # string, as contains('') does, and nothing needs to be extracted.
    return c.rlike(regex_alternation(items, lower))
