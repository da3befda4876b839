"""Continuous audited ingest of a landing folder (the streaming form of W8).

The file source keeps the list of files it has already read in the query's
checkpoint, so a restart or a re-run never ingests a file twice.  Each micro-batch gets
the same columns as the batch ingest: ``job_id`` (one per run), ``batch_id``,
``source_file`` and a contiguous per-file ``seq_id``; a file is never split
across micro-batches, so numbering restarts at 1 per file as in batch.

Batches are written to ``out/batch_id=<n>`` with overwrite, so a batch that is
retried after a failure replaces its own output instead of duplicating it.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from tablekit.operators.ingest import _BLK, add_file_seq_id
from tablekit.session import remove_dir, shared_dir


def batch_writer(out: str, job_id: str, out_format: str = "parquet"):
    """The ``foreachBatch`` function: number the batch's rows and write them to
    ``out/batch_id=<n>`` with overwrite, so a retried batch replaces itself."""

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        path = shared_dir(batch.sparkSession, "ingest-batch")
        rows = add_file_seq_id(batch, path=path)
        cols = [c for c in rows.columns if c not in ("source_file", "seq_id", _BLK)]
        rows = rows.select(*cols, F.lit(job_id).alias("job_id"), "source_file", "seq_id")
        # batch_id is carried by the folder name (read back as a partition column).
        try:
            (rows.write.mode("overwrite").format(out_format)
                 .save(f"{out.rstrip('/')}/batch_id={batch_id}"))
        finally:
            remove_dir(batch.sparkSession, path)

    return write_batch


def start_audit_stream(spark: SparkSession, src: str, out: str, checkpoint: str,
                       schema: StructType | str, job_id: str | None = None,
                       available_now: bool = True, out_format: str = "parquet",
                       max_files_per_trigger: int | None = None) -> StreamingQuery:
    """Start the stream; with ``available_now`` it stops after the files present."""
    reader = (spark.readStream.schema(schema).option("header", "true").option("enforceSchema", "false")
              .option("pathGlobFilter", "*.csv"))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    stream = reader.csv(src).select(
        "*", F.col("_metadata.file_path").alias("source_file"),
        F.col("_metadata.file_block_start").alias(_BLK))
    write_batch = batch_writer(out, job_id or str(uuid.uuid4()), out_format)
    w = stream.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="10 seconds")
    return w.start()
