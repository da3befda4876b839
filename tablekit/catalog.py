"""Catalog surface (C1-C5): temp views, databases, managed tables."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

_IDENT = re.compile(r"^[A-Za-z_][A-Za-z0-9_]*$")


def _ident(name: str) -> str:
    if not _IDENT.match(name):
        raise ValueError(f"not a plain identifier: {name!r}")
    return name


def register_view(df: DataFrame, name: str) -> None:
    """Session-scoped name for SQL."""
    df.createOrReplaceTempView(_ident(name))


def create_database(spark: SparkSession, name: str, use: bool = False) -> None:
    """``CREATE DATABASE IF NOT EXISTS``, so re-running does not fail."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {_ident(name)}")
    if use:
        spark.catalog.setCurrentDatabase(name)


def list_databases(spark: SparkSession) -> DataFrame:
    """``SHOW DATABASES``; the column is ``namespace``."""
    return spark.sql("SHOW DATABASES")


def table_exists(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(name)
