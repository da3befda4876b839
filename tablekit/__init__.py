"""tablekit: everyday table operations expressed as PySpark DataFrame plans.

Every operator takes DataFrames and returns a DataFrame; planning is left to
Catalyst (predicate pushdown, column pruning, partial aggregation, join
selection) and Adaptive Query Execution (skew splits, partition coalescing).
"""

from tablekit.session import get_session, shared_dir

__all__ = ["get_session", "shared_dir"]
