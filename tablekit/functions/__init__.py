"""Column-level helpers: predicates, scalar string/array/date functions."""

from tablekit.functions.predicates import (
    all_of, any_of, contains_any, regex_any, regex_alternation,
)
from tablekit.functions.scalars import (
    age_years, parse_date, row_sum, exact_sum, exact_avg, element_at0,
)

__all__ = [
    "qcol",
    "all_of", "any_of", "contains_any", "regex_any", "regex_alternation",
    "age_years", "parse_date", "row_sum", "exact_sum", "exact_avg", "element_at0",
]


def qcol(name: str):
    """Column by exact name, even with dots, spaces or backticks in it."""
    from pyspark.sql import functions as F
    return F.col("`" + name.replace("`", "``") + "`")
