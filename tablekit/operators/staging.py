"""Tables written once to the shared folder, for frames that are read more than once."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tablekit.session import shared_dir


def stage(df: DataFrame, name: str = "stage", path: str | None = None) -> DataFrame:
    """Write ``df`` once as Parquet in the shared checkpoint folder and read it back.

    The plan above runs once, its result can no longer change with the scan's
    parallelism, and a lost executor repeats only its own tasks.  Remove the table
    with ``session.remove_dir`` when its last reader is done (give ``path`` to know
    where it is), or all of a session's tables with ``session.remove_scratch``.
    """
    path = path or shared_dir(df.sparkSession, name)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
