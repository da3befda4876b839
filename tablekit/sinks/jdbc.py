"""Keyed write-back to a JDBC table.

The change rows are first written by Spark, in parallel, to a staging table;
then one set-based statement merges staging into the target inside the
database.  There is no per-row SELECT/UPDATE/INSERT round trip.

The statement is sent over a plain ``java.sql`` connection opened in the
driver JVM (the JDBC driver jar is already on Spark's class path); it carries
no data, only the statement text.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Mapping, Sequence

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablekit.sinks.writers import write_jdbc

_IDENT = re.compile(r"^[A-Za-z_][A-Za-z0-9_.]*$")


def _ident(name: str) -> str:
    if not _IDENT.match(name):
        raise ValueError(f"not a plain identifier: {name!r}")
    return name


def merge_statement(target: str, staging: str, key: Sequence[str], columns: Sequence[str],
                    update_only: bool = False, dialect: str = "standard") -> str:
    """The MERGE (or MySQL upsert) text for ``staging`` into ``target``.

    Column names are quoted because Spark's JDBC writer creates them quoted
    (case preserved); table names are used as given.
    """
    t, s = _ident(target), _ident(staging)
    q = "`" if dialect == "mysql" else '"'

    def col(c: str) -> str:
        return f"{q}{_ident(c)}{q}"

    key_set = set(key)
    cols = [col(c) for c in columns]
    rest = [col(c) for c in columns if c not in key_set]
    on = " AND ".join(f"t.{col(k)} = s.{col(k)}" for k in key)
    if dialect == "mysql":
        if update_only:
            sets = ", ".join(f"t.{c} = s.{c}" for c in rest)
            return f"UPDATE {t} t JOIN {s} s ON {on} SET {sets}"
        sets = ", ".join(f"{c} = VALUES({c})" for c in rest)
        return (f"INSERT INTO {t} ({', '.join(cols)}) SELECT {', '.join(cols)} FROM {s} "
                f"ON DUPLICATE KEY UPDATE {sets}")
    sql = f"MERGE INTO {t} t USING {s} s ON {on}"
    if rest:
        sql += " WHEN MATCHED THEN UPDATE SET " + ", ".join(f"{c} = s.{c}" for c in rest)
    if not update_only:
        sql += (f" WHEN NOT MATCHED THEN INSERT ({', '.join(cols)}) "
                f"VALUES ({', '.join('s.' + c for c in cols)})")
    return sql


def execute_statement(spark: SparkSession, url: str, sql: str,
                      properties: Mapping[str, str] | None = None) -> int:
    """Run one statement over a JDBC connection from the driver; returns the update count."""
    props = dict(properties or {})
    jvm = spark.sparkContext._jvm
    if "driver" in props:
        jvm.java.lang.Class.forName(props["driver"])
    jprops = jvm.java.util.Properties()
    for k, v in props.items():
        if k != "driver":
            jprops.setProperty(k, str(v))
    conn = jvm.java.sql.DriverManager.getConnection(url, jprops)
    try:
        stmt = conn.createStatement()
        try:
            return int(stmt.executeUpdate(sql))
        finally:
            stmt.close()
    finally:
        conn.close()


def _drop_if_there(spark: SparkSession, url: str, table: str, properties: Mapping[str, str] | None) -> None:
    try:
        execute_statement(spark, url, f"DROP TABLE {_ident(table)}", properties)
    except Py4JJavaError as e:
        # The write may have failed before it made the table.
        if "SQL" not in e.java_exception.getClass().getName():
            raise


def merge_into_jdbc(spark: SparkSession, changes: DataFrame, url: str, target: str, key: Sequence[str] | str,
                    properties: Mapping[str, str] | None = None, staging: str | None = None,
                    update_only: bool = False, dialect: str = "standard",
                    column_types: str | None = None, writers: int | None = None,
                    order_by: Sequence[str] | str | None = None, validate: bool = True) -> int:
    """Upsert (or update only) ``changes`` into the JDBC table ``target`` by ``key``.

    As in ``operators.upsert.upsert``: with ``order_by`` the change with the
    largest ordering wins per key; without it duplicate keys raise (checked
    before anything is written, unless ``validate=False``).  ``writers`` limits
    the parallel connections used for the staging write.  The changes must have
    exactly the target's columns (in any case), apart from those of ``order_by``.
    The ``mysql`` dialect's upsert relies on a unique index on the key.  Returns the number of
    target rows touched as reported by the database.
    """
    from tablekit.operators.upsert import assert_unique_keys, dedup_changes
    keys = [key] if isinstance(key, str) else list(key)
    if order_by is not None:
        changes = dedup_changes(changes, keys, order_by)
    elif validate:
        assert_unique_keys(changes, keys)
    # Only the target's columns go to the database (an ordering column such as
    # a version number may not exist there).  Reading the schema runs no query
    # over the rows.
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", target)
    for k, v in (properties or {}).items():
        reader = reader.option(k, v)
    target_cols = {c.lower(): c for c in reader.load().columns}
    ordering = {re.split(r"\s+", c.strip())[0].lower() for c in (
        [order_by] if isinstance(order_by, str) else order_by or [])}
    unknown = [c for c in changes.columns if c.lower() not in target_cols and c.lower() not in ordering]
    missing = [c for low, c in target_cols.items() if low not in {x.lower() for x in changes.columns}]
    if unknown or missing:
        raise ValueError(f"columns not in {target}: {unknown}; columns of {target} not in the changes: {missing}")
    # Named as the target names them: quoted identifiers are case-sensitive.
    changes = changes.select(*[F.col(f"`{c}`").alias(target_cols[c.lower()]) for c in changes.columns
                               if c.lower() in target_cols])
    keys = [target_cols[k.lower()] for k in keys]
    if update_only and len(keys) == len(changes.columns):
        raise ValueError("an update needs at least one column besides the key")
    # A private staging table per call: concurrent merges into one target do
    # not see each other's rows, and the table is dropped afterwards.
    own_staging = staging is None
    staging = staging or f"{target}_stg_{uuid.uuid4().hex[:12]}"
    df = changes.repartition(writers) if writers else changes
    try:
        write_jdbc(df, url, staging, mode="overwrite", properties=properties, column_types=column_types)
        # A task that is retried after its commit would leave its rows twice.
        staged = spark.read.format("jdbc").options(**dict(properties or {}), url=url, dbtable=staging).load()
        if validate:
            assert_unique_keys(staged, keys)
        sql = merge_statement(target, staging, keys, changes.columns, update_only, dialect)
        return execute_statement(spark, url, sql, properties)
    finally:
        if own_staging:
            _drop_if_there(spark, url, staging, properties)
