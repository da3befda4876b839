"""Helpers shared by the training-data operators: tables, staging, Arrow batches.

Texts reach Python tasks as Arrow batches.  A batch can hold ten thousand rows,
and one text can be very long, so every task walks its batches in slices of
bounded bytes (``slices``); the only thing that must fit a task is one document.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from tablekit.session import remove_dir, shared_dir

#: Bytes of text that a task works on at once.
SLICE_BYTES = 8 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


class Staging:
    """Tables written once to the folder shared by all executors.

    ``put`` writes a frame as Parquet and reads it back: the plan above runs once
    and a lost executor repeats only its own tasks.  ``drop`` removes tables that
    nothing reads any more, so that the folder holds what is in use.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.root, self.paths = spark, shared_dir(spark, name), {}

    def put(self, name: str, df: DataFrame) -> DataFrame:
        self.paths[name] = f"{self.root}/{name}"
        df.write.parquet(self.paths[name])
        return self.spark.read.schema(df.schema).parquet(self.paths[name])

    def drop(self, *names: str) -> None:
        for name in names:
            remove_dir(self.spark, self.paths.pop(name))


def binary(column: pa.Array | pa.ChunkedArray) -> pa.Array:
    """A string column as UTF-8 bytes, nulls as empty; no copy of the text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    kind = pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()
    column = column.cast(kind)
    return column.fill_null(b"") if column.null_count else column


def slices(batches: Iterator[pa.RecordBatch], column: str,
           limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The rows of the batches in order, in slices of at most ``limit`` bytes of text
    (one row at least)."""
    for batch in batches:
        if not batch.num_rows:
            continue
        ends = _ends(binary(batch.column(column)))
        start = 0
        while start < batch.num_rows:
            stop = int(np.searchsorted(ends, ends[start] + limit, "right")) - 1
            stop = min(max(stop, start + 1), batch.num_rows)
            yield batch.slice(start, stop - start)
            start = stop


def _ends(column: pa.Array) -> np.ndarray:
    width = np.int64 if pa.types.is_large_binary(column.type) else np.int32
    offsets = np.frombuffer(column.buffers()[1], width)[column.offset:column.offset + len(column) + 1]
    return offsets.astype(np.int64) - int(offsets[0])


def concatenated(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a binary column as one array, and the n + 1 row borders."""
    ends = _ends(column)
    width = np.int64 if pa.types.is_large_binary(column.type) else np.int32
    first = int(np.frombuffer(column.buffers()[1], width)[column.offset])
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[first:first + int(ends[-1])], ends
