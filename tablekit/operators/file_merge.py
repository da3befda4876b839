"""Keyed merge that rewrites only the files it touches.

A table is a set of Parquet files and, for each version, an index of them: rows, smallest
and largest key.  Beside the files lies a Bloom filter of each file's keys (bitmaps of a
key hash, ``BITS`` for each row), written with the files and never again.  A merge asks the index which files can hold a changed key, reads the key column of
those, and rewrites the files that do hold one, together with the inserts; all others are
carried over unread.  Data files are never changed in place, and a version becomes visible
by one rename of its index, so readers see the old table or the new one, and a merge that
is lost has changed nothing.

Files are written by key range, so that near keys share files.  For whole-number keys the
ranges are matched through cells of the key domain (an equi-join); other keys go by the
smallest and largest changed key only.  The driver holds the files' paths, as Spark's own
listing does.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablekit.functions import qcol
from tablekit.operators.aggregate import pick_per_key
from tablekit.operators.staging import stage
from tablekit.operators.upsert import dedup_changes, upsert
from tablekit.session import publish_dir, remove_dir, shared_dir

#: Bits of a file's Bloom filter for each row, and numbers in one bitmap.
BITS, BITMAP = 16, 32_768
#: Cells of the key domain for each file; a file over more cells than ``WIDE`` is always looked into.
CELLS, WIDE = 4, 64
#: Files whose bitmaps are picked by name.
ASKED = 1000


@dataclass(frozen=True)
class Merge:
    """What a merge did: files of the table before it, looked into, rewritten, and written."""

    files: int
    opened: int
    rewritten: int
    written: int


def _path(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def versions(spark: SparkSession, path: str) -> list[int]:
    fs, _ = _path(spark, path)
    found = fs.globStatus(spark._jvm.org.apache.hadoop.fs.Path(f"{path}/versions/v=*"))
    return sorted(int(str(x.getPath().getName())[2:]) for x in found or [])


def index(spark: SparkSession, path: str) -> DataFrame:
    """(file, n, low, high, buckets, batch) of the newest version; ``batch`` names the write that made the file."""
    known = versions(spark, path)
    if not known:
        raise ValueError(f"{path} holds no table")
    return spark.read.parquet(f"{path}/versions/v={known[-1]}")


def read(spark: SparkSession, path: str) -> DataFrame:
    files = [r.file for r in index(spark, path).select("file").collect()]
    return spark.read.parquet(*files)


def _bit(key: str, buckets: Column) -> tuple[Column, Column]:
    """The bitmap and the bit in it that stand for a key."""
    at = F.pmod(F.xxhash64(qcol(key)), buckets * BITMAP)
    return F.floor(at / BITMAP).cast("int"), F.pmod(at, F.lit(BITMAP))


def _indexed(spark: SparkSession, path: str, batch: str, key: str) -> DataFrame:
    """The index of a batch's files; their bitmaps are written, sorted by file."""
    rows = spark.read.parquet(f"{path}/data/{batch}").select(qcol(key).alias("key"), F.col("_metadata.file_path").alias("file"))
    files = rows.groupBy("file").agg(F.count("*").alias("n"), F.min("key").alias("low"), F.max("key").alias("high"))
    files = stage(files.withColumn("buckets", F.ceil(F.col("n") * BITS / BITMAP).cast("int")), "file-index")
    # One row for each file on the broadcast side.
    bucket, bit = _bit("key", F.col("buckets"))
    bitmaps = rows.join(F.broadcast(files.select("file", "buckets")), "file").select("file", bucket.alias("bucket"), bit.alias("bit"))
    (bitmaps.groupBy("file", "bucket").agg(F.bitmap_construct_agg("bit").alias("bitmap"))
     .repartitionByRange("file", "bucket").sortWithinPartitions("file", "bucket").write.parquet(f"{path}/bitmaps/{batch}"))
    return files.withColumn("batch", F.lit(batch))


def _publish(spark: SparkSession, path: str, version: int, rows: DataFrame) -> None:
    hidden = f"{path}/versions/_v-{uuid.uuid4().hex}"
    rows.write.parquet(hidden)
    try:
        publish_dir(spark, hidden, f"{path}/versions/v={version}")
    finally:
        remove_dir(spark, hidden)


def _write(df: DataFrame, path: str, key: str, files: int) -> str:
    batch = uuid.uuid4().hex
    df.repartitionByRange(files, qcol(key)).sortWithinPartitions(qcol(key)).write.parquet(f"{path}/data/{batch}")
    return batch


def create(df: DataFrame, path: str, key: str, files: int) -> None:
    """A new table at ``path``, in at most ``files`` files by ranges of ``key``."""
    _publish(df.sparkSession, path, 0, _indexed(df.sparkSession, path, _write(df, path, key, files), key))


def candidates(path: str, files: DataFrame, changes: DataFrame, key: str) -> DataFrame:
    """(file): the files whose index does not rule out that they hold a changed key."""
    spark = files.sparkSession
    keys = changes.select(qcol(key).alias("key")).where("key IS NOT NULL").distinct()
    first, last = keys.agg(F.min("key"), F.max("key")).first()
    near = files.where((F.col("low") <= F.lit(last)) & (F.col("high") >= F.lit(first)))
    if isinstance(changes.schema[key].dataType, T.IntegralType):
        domain = files.agg(F.min("low").alias("l"), F.max("high").alias("h"), F.count("*").alias("n")).first()
        width = max(1, -(-((domain.h or 0) - (domain.l or 0) + 1) // (CELLS * max(1, domain.n))))
        cell = lambda c: F.floor((F.col(c).cast("decimal(38,0)") - (domain.l or 0)) / width).cast("long")
        near = near.withColumn("wide", cell("high") - cell("low") >= WIDE)
        some = near.where("NOT wide").withColumn("cell", F.explode(F.sequence(cell("low"), cell("high"))))
        pairs = some.join(keys.withColumn("cell", cell("key")), "cell").where("key BETWEEN low AND high")
        sure = near.where("wide").select("file")
    else:
        return near.select("file")
    bucket, bit = _bit("key", F.col("buckets"))
    pairs = stage(pairs.select("file", "batch", bucket.alias("bucket"), bit.alias("bit")), "file-pairs")
    asked = pairs.select("file", "batch").distinct().collect()
    if not asked:
        return sure
    bitmaps = spark.read.parquet(*sorted({f"{path}/bitmaps/{r.batch}" for r in asked}))
    if len(asked) <= ASKED:      # few files: their bitmaps only are read
        bitmaps = bitmaps.where(F.col("file").isin([r.file for r in asked]))
    byte = F.conv(F.hex(F.substring("bitmap", (F.floor(F.col("bit") / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    is_set = F.floor(byte / F.pow(F.lit(2), F.col("bit") % 8)).cast("int") % 2 == 1
    return pairs.join(bitmaps, ["file", "bucket"]).where(is_set).select("file").union(sure).distinct()


def merge(spark: SparkSession, path: str, changes: DataFrame, key: str, order_by=None, rows_per_file: int | None = None,
          newest: bool = False) -> Merge:
    """UPDATE or INSERT the changes by ``key``; duplicates need ``order_by`` (the largest wins).

    With ``newest`` a row of the table that is larger by ``order_by`` (columns of the table)
    stays, so changes may come late, or twice.
    """
    version, files = versions(spark, path)[-1], index(spark, path)
    scratch = shared_dir(spark, "file-merge")
    try:
        if order_by is not None:
            changes = dedup_changes(changes, key, order_by)
        ch = stage(changes, path=f"{scratch}/changes")
        old = {r.file: r.n for r in files.select("file", "n").collect()}
        opened = [r.file for r in candidates(path, files, ch, key).collect()]
        keys = ch.select(qcol(key)).where(qcol(key).isNotNull()).distinct()
        touched = [] if not opened else [r.file for r in (
            spark.read.parquet(*opened).select(qcol(key), F.col("_metadata.file_path").alias("file"))
            .join(keys, key, "left_semi").select("file").distinct().collect())]
        columns = read(spark, path).columns
        rows = ch.select(*map(qcol, columns))
        if touched:
            old_rows = spark.read.parquet(*touched).select(*map(qcol, columns))
            if newest:
                rows = pick_per_key(old_rows.unionByName(rows), key, order_by).select(*map(qcol, columns))
            else:
                rows = upsert(old_rows, rows, key, validate=order_by is None)
        rows = stage(rows, path=f"{scratch}/rows")
        size = rows_per_file or max(1, sum(old.values()) // len(old))
        n = rows.count()
        if not n:
            return Merge(len(old), len(opened), 0, 0)
        new = _indexed(spark, path, _write(rows, path, key, -(-n // size)), key)
        kept = files.join(spark.createDataFrame([(f,) for f in touched], "file string"), "file", "left_anti")
        _publish(spark, path, version + 1, kept.select(*new.columns).unionByName(new))
        return Merge(len(old), len(opened), len(touched), index(spark, path).count() - len(old) + len(touched))
    finally:
        remove_dir(spark, scratch)
