"""A count-min sketch of 64-bit keys over all partitions, kept as "seen more than once" bits.

Every partition builds its own sketch; it is sent in pieces (chunks of counters, only
the counters in use), and equal pieces are added up where they meet, one piece after
the other, so neither a task nor the driver holds all partitions' sketches.  What
comes back is one bit per counter: its sum is at least two.  A key is estimated as
repeated if its bit is set in every row; as sums only overestimate, no repeated key
is missed.

The sketch's size follows the input up to ``MAX_BITS``, so the broadcast is bounded;
beyond that more keys pass that are not repeated, and none is lost.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tablekit.llm.windows import mixed

#: Rows of the sketch; counters in a chunk; log2 of the counters in a row.
ROWS, CHUNK = 2, 1 << 16
MIN_BITS, MAX_BITS = 18, 29


def row_bits(keys: float) -> int:
    """log2 of the counters in a row for about so many keys: eight counters for each."""
    return min(MAX_BITS, max(MIN_BITS, int(np.ceil(np.log2(max(1.0, 8 * keys))))))


def counters(keys: np.ndarray, bits: int, row: int) -> np.ndarray:
    """The counter of each key in a row; rows follow one another."""
    h = mixed(keys + np.uint64(row + 1) * np.uint64(0x632BE59BD9B4E019))
    return (h >> np.uint64(64 - bits)).astype(np.int64) + (row << bits)


class Repeated:
    """The merged sketch: one bit for each counter."""

    def __init__(self, bits: int, packed: np.ndarray):
        self.bits, self.packed = bits, packed

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        out = np.ones(len(keys), bool)
        for row in range(ROWS):
            c = counters(keys, self.bits, row)
            out &= (self.packed[c >> 3] >> (c & 7).astype(np.uint8) & 1).astype(bool)
        return out


def _pieces(keys: np.ndarray, bits: int) -> Iterator[pa.RecordBatch]:
    """A partition's sketch: for each chunk the 16-bit places of its counters, twice if above one."""
    for row in range(ROWS):
        c, n = np.unique(counters(keys, bits, row), return_counts=True)
        c = np.repeat(c, np.minimum(n, 2))
        chunk = c // CHUNK
        first = np.flatnonzero(np.append(True, chunk[1:] != chunk[:-1])) if len(c) else np.zeros(0, np.int64)
        places, stops = (c % CHUNK).astype("<u2"), np.append(first[1:], len(c))
        yield pa.RecordBatch.from_arrays(
            [pa.array(chunk[first], pa.int32()),
             pa.array([places[a:b].tobytes() for a, b in zip(first, stops)], pa.binary())], ["chunk", "places"])


def _added(batches: Iterator[pa.RecordBatch], least: int) -> Iterator[pa.RecordBatch]:
    """Adds up the pieces of a chunk, which follow one another."""
    at, total = None, None

    def done() -> pa.RecordBatch:
        packed = np.packbits(total >= least, bitorder="little").tobytes()
        return pa.RecordBatch.from_arrays([pa.array([at], pa.int32()), pa.array([packed], pa.binary())],
                                          ["chunk", "packed"])

    for batch in batches:
        for chunk, places in zip(batch.column("chunk").to_pylist(), batch.column("places").to_pylist()):
            if chunk != at:
                if at is not None:
                    yield done()
                at, total = chunk, np.zeros(CHUNK, np.int64)
            total += np.bincount(np.frombuffer(places, "<u2"), minlength=CHUNK)
    if at is not None:
        yield done()


def merged(rows: DataFrame, keys_of: Callable[[Iterator[pa.RecordBatch]], Iterator[np.ndarray]],
           bits: int, least: int = 2) -> Repeated:
    """The merged sketch of the keys of all partitions; ``keys_of`` gives a partition's keys.

    With ``least`` 1 it is a Bloom filter: the bit of every key is set.
    """
    def partition(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [np.zeros(0, np.uint64)], 0
        for keys in keys_of(batches):
            held.append(keys)
            n += len(keys)
            if n > 1 << 22:  # a long partition sends its sketch in parts
                yield from _pieces(np.concatenate(held), bits)
                held, n = [np.zeros(0, np.uint64)], 0
        yield from _pieces(np.concatenate(held), bits)

    chunks = (ROWS << bits) // CHUNK
    pieces = rows.mapInArrow(partition, "chunk int, places binary").repartition("chunk").sortWithinPartitions("chunk")
    packed = np.zeros(chunks * CHUNK // 8, np.uint8)
    for r in pieces.mapInArrow(lambda b: _added(b, least), "chunk int, packed binary").toLocalIterator():
        packed[r.chunk * CHUNK // 8:(r.chunk + 1) * CHUNK // 8] = np.frombuffer(r.packed, np.uint8)
    return Repeated(bits, packed)
