"""Writers with explicit save modes (W1-W6) and file-count control (L1-L3)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

SAVE_MODES = ("append", "overwrite", "ignore", "error", "errorifexists")


def _mode(mode: str) -> str:
    m = mode.lower()
    if m not in SAVE_MODES:
        raise ValueError(f"save mode must be one of {SAVE_MODES}")
    return m


def write_json(df: DataFrame, path: str, mode: str = "errorifexists", **options) -> None:
    df.write.mode(_mode(mode)).options(**{k: str(v) for k, v in options.items()}).json(path)


def write_parquet(df: DataFrame, path: str, mode: str = "errorifexists",
                  partition_by: Sequence[str] | None = None) -> None:
    w = df.write.mode(_mode(mode))
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def write_csv(df: DataFrame, path: str, mode: str = "errorifexists", header: bool = True,
              sep: str = ",", **options) -> None:
    (df.write.mode(_mode(mode)).option("header", header).option("sep", sep)
       .options(**{k: str(v) for k, v in options.items()}).csv(path))


def write_jdbc(df: DataFrame, url: str, table: str, mode: str = "errorifexists",
               properties: Mapping[str, str] | None = None, column_types: str | None = None,
               batch_size: int | None = None) -> None:
    """JDBC write (W4).  ``column_types`` sets the DDL types of created columns
    (``createTableColumnTypes``), e.g. ``"name VARCHAR(64)"``."""
    w = df.write.format("jdbc").mode(_mode(mode)).option("url", url).option("dbtable", table)
    for k, v in (properties or {}).items():
        w = w.option(k, v)
    if column_types:
        w = w.option("createTableColumnTypes", column_types)
    if batch_size:
        w = w.option("batchsize", batch_size)
    w.save()


def save_as_table(df: DataFrame, name: str, mode: str = "overwrite", fmt: str = "parquet") -> None:
    """Managed table in the warehouse."""
    df.write.mode(_mode(mode)).format(fmt).saveAsTable(name)


def save_bucketed(df: DataFrame, name: str, key: Sequence[str] | str, buckets: int,
                  mode: str = "overwrite", fmt: str = "parquet") -> None:
    """Managed table hash-bucketed and sorted by ``key``.

    Later joins on ``key`` (for example, repeated upserts into this table)
    read it already partitioned and sorted, so the big side is not shuffled.
    ``buckets`` should follow the table size (about one bucket per 256 MB).
    """
    keys = [key] if isinstance(key, str) else list(key)
    (df.write.mode(_mode(mode)).format(fmt).bucketBy(buckets, *keys).sortBy(*keys)
       .saveAsTable(name))


def with_files(df: DataFrame, n: int, shuffle: bool = True, keys: Sequence[str] | None = None) -> DataFrame:
    """Set the number of output partitions (files): ``repartition`` shuffles
    (L1, optionally hashing on ``keys``), ``coalesce`` merges without a
    shuffle and can only lower the count (L2)."""
    if shuffle:
        return df.repartition(n, *(keys or []))
    return df.coalesce(n)


def num_partitions(df: DataFrame) -> int:
    """Partition count of the planned frame (L3)."""
    return df.rdd.getNumPartitions()


def transfer_tables(spark: SparkSession, read, names: Sequence[str], to_warehouse: bool = False) -> None:
    """Register each source table as a temp view, optionally also saving it as a
    managed table (W7).  ``read(name)`` returns the DataFrame for ``name``."""
    for name in names:
        df = read(name)
        df.createOrReplaceTempView(name)
        if to_warehouse:
            save_as_table(df, name, mode="overwrite")
