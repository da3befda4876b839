"""Audited ingestion of a directory of CSV files.

Every output row carries

* ``job_id``  - one id for the whole run (``uuid()`` per row would give every
  row its own id and change again if a task is retried),
* ``source_file`` - the file it came from,
* ``seq_id`` - 1, 2, 3, ... in file order, restarting for each file, with no
  gaps (``monotonically_increasing_id`` jumps by 2**33 between partitions).

Files are listed and split by Spark itself; there is no driver-side loop over
files.  The parsed rows are scanned once and written to a staged table together
with their file, the start of their split and a running id; the row counts, the
numbers and the output all come from that table.  How the scan was cut, which
depends on the number of executors at that moment, is thereby fixed, and a parse
mode that drops lines drops the same ones for every projection.  A file split is
one run of rows in one task, so a summary with one row per split gives each split
its offset within its file, without sorting the data.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tablekit.functions import qcol
from tablekit.operators.staging import stage
from tablekit.session import remove_dir, shared_dir

_MID = "__tk_mid"
_BLK = "__tk_block"
_PART, _HASH, _SHIFT = "__tk_task", "__tk_file", "__tk_shift"
#: File splits whose offsets are broadcast at once (28 bytes each).
SPLITS_AT_ONCE = 500_000


def read_csv_dir(spark: SparkSession, path: str, schema: StructType | str | None = None,
                 header: bool = True, sep: str = ",", glob: str = "*.csv",
                 recursive: bool = True, **options) -> DataFrame:
    """All ``*.csv`` files under ``path`` with ``source_file`` and split start columns."""
    reader = spark.read.option("header", header).option("sep", sep).option("pathGlobFilter", glob)
    if header:   # a file with other columns, or another order of them, is an error (see feeds.read_feed)
        reader = reader.option("enforceSchema", "false")
    if recursive:
        reader = reader.option("recursiveFileLookup", "true")
    if schema is not None:
        reader = reader.schema(schema)
    else:
        reader = reader.option("inferSchema", "true")
    for k, v in options.items():
        reader = reader.option(k, v)
    df = reader.csv(path)
    return df.select("*", F.col("_metadata.file_path").alias("source_file"),
                     F.col("_metadata.file_block_start").alias(_BLK))


def add_file_seq_id(df: DataFrame, file_col: str = "source_file", block_col: str = _BLK,
                    name: str = "seq_id", path: str | None = None,
                    splits_at_once: int = SPLITS_AT_ONCE) -> DataFrame:
    """Contiguous 1-based row number per file, in file order, without a sort.

    ``df`` must be the direct scan from :func:`read_csv_dir` (rows of one file
    split are then consecutive in one task).  It is scanned once, here, into two
    staged tables under ``path`` (a fresh shared folder if not given).
    """
    path = path or shared_dir(df.sparkSession, "ingest")
    split = [_PART, block_col, _HASH]
    numbered = df.withColumn(_MID, F.monotonically_increasing_id()).withColumns({
        _PART: F.spark_partition_id(), _HASH: F.xxhash64(file_col)})
    rows = stage(numbered, path=f"{path}/rows")
    summary = rows.groupBy(*split, file_col).agg(F.count(F.lit(1)).alias("__n"), F.min(_MID).alias("__first"))
    per_file = Window.partitionBy(file_col).orderBy(block_col).rowsBetween(Window.unboundedPreceding, -1)
    # seq_id is the running id plus a shift that is the same for all rows of a split.
    shift = F.coalesce(F.sum("__n").over(per_file), F.lit(0)) - F.col("__first") + F.lit(1)
    shifts = stage(summary.select(*split, shift.alias(_SHIFT)), path=f"{path}/shifts")
    joined = None
    for low, high in _ranges(shifts, splits_at_once):
        some = lambda x: x.where(F.col(_PART).between(low, high)) if high is not None else x
        part = some(rows).join(F.broadcast(some(shifts)), split, "left")
        joined = part if joined is None else joined.unionAll(part)
    # A split without a shift would be lost rows: fail instead.
    shift = F.coalesce(F.col(_SHIFT), F.raise_error(F.concat(
        F.lit("no row offset for a split of "), F.col(file_col))).cast("bigint"))
    out = joined.withColumn(name, (F.col(_MID) + shift).cast("bigint"))
    return out.select(*[qcol(c) for c in df.columns], name)


def _ranges(shifts: DataFrame, splits_at_once: int) -> list[tuple[int, int | None]]:
    """Ranges of scan tasks with a bounded number of splits each (a task's splits stay together).

    The shifts of a range are broadcast (three numbers a split), so the rows are never
    shuffled, whatever the number of files; a range reads only its own rows, by the
    staged files' statistics.
    """
    if shifts.count() <= splits_at_once:
        return [(0, None)]
    out, held = [], 0
    for task, n in shifts.groupBy(_PART).count().orderBy(_PART).toLocalIterator():
        if not out or held + n > splits_at_once:
            out.append((task, task))
            held = 0
        out[-1], held = (out[-1][0], task), held + n
    return out


def audit_ingest(spark: SparkSession, src: str, schema: StructType | str | None = None,
                 job_id: str | None = None, skip_files: DataFrame | None = None,
                 path: str | None = None, **options) -> DataFrame:
    """Read every CSV under ``src`` and add ``job_id``, ``source_file`` and ``seq_id``.

    ``skip_files`` (a frame with a ``source_file`` column, e.g. the existing
    output) leaves out files already ingested, so a re-run does not append the
    same rows twice.  Empty files contribute no rows.

    The rows are staged under ``path`` (or a fresh shared folder), which the result
    reads; remove it when the result has been written.

    All files must have one header; a file whose columns differ is an error (``feeds``
    reads every file under its own header).  The skipped files are still read (their rows
    are dropped after numbering, which keeps the numbering of the others exact).  For a
    landing folder that keeps growing use ``feeds.ingest_run`` or
    ``streaming.audit_stream.start_audit_stream``: they never open a file again.
    """
    df = read_csv_dir(spark, src, schema=schema, **options)
    # Ids are taken straight off the scan; skipping whole files afterwards
    # cannot change the numbering of the files that remain.
    out = add_file_seq_id(df, path=path)
    if skip_files is not None:
        done = skip_files.select("source_file").distinct()
        out = out.join(done, "source_file", "left_anti")
    jid = job_id or str(uuid.uuid4())
    cols = [c for c in out.columns if c not in ("source_file", "seq_id", _BLK)]
    return out.select(*cols, F.lit(jid).alias("job_id"), "source_file", "seq_id")


def ingest_to(spark: SparkSession, src: str, out: str, mode: str = "append", fmt: str = "csv",
              **settings) -> None:
    """Ingest ``src`` into one output folder (header kept for CSV) and remove the staged rows."""
    path = shared_dir(spark, "ingest")
    try:
        writer = audit_ingest(spark, src, path=path, **settings).write.mode(mode).format(fmt)
        (writer.option("header", "true") if fmt == "csv" else writer).save(out)
    finally:
        remove_dir(spark, path)
