"""The latest row of every key as a running table (J16b over a stream).

Each micro-batch is reduced to one row per key with a combinable aggregate, so a key that
holds a third of a batch is reduced in the map tasks, and merged into a table of files
(``operators.file_merge``): only files that hold one of the batch's keys are rewritten, and
a row that is older than the table's does not replace it.  The table is the state, so it
needs no expiry, late rows do no harm, and a batch that is run again after a failure
changes nothing.  Readers see the version of the last finished batch.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from tablekit.operators import file_merge
from tablekit.operators.aggregate import pick_per_key


def batch_merger(path: str, key: str, order_by: Sequence[str], files: int = 8):
    """The ``foreachBatch`` function."""

    def merge_batch(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        latest = pick_per_key(batch, key, order_by).select(*[f"`{c}`" for c in batch.columns])
        if file_merge.versions(spark, path):
            file_merge.merge(spark, path, latest, key, order_by=order_by, newest=True)
        else:
            file_merge.create(latest, path, key, files)

    return merge_batch


def start_latest_stream(rows: DataFrame, path: str, checkpoint: str, key: str, order_by: Sequence[str],
                        files: int = 8, available_now: bool = True) -> StreamingQuery:
    """Keep the latest row per ``key`` of a streaming frame at ``path`` (read it with ``file_merge.read``).

    ``order_by`` ends with a column that is unique within a key.
    """
    w = rows.writeStream.foreachBatch(batch_merger(path, key, order_by, files)).option("checkpointLocation", checkpoint)
    return (w.trigger(availableNow=True) if available_now else w.trigger(processingTime="10 seconds")).start()
