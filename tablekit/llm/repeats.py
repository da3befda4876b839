"""Finding repeated windows of a corpus: what substring removal by words and by bytes share.

    sketch    which family anchors are estimated to occur more than once (count-min)
    families  the families of windows that pass, with a hash of all they cover
    classes   families of equal content, counted exactly; one that is repeated as a
              whole settles all its windows
    open      classes whose anchor also occurs in other content: only these are looked
              at window by window

Copies of a passage are one class however many they are, so the window-by-window
work follows the number of different contents, not of copies.  Counts are aggregates
(combined before the shuffle) that are joined back, so no group is gathered.

Rolling hashes only pick anchors.  Whether contents or windows are equal is decided by a
cryptographic 128-bit hash of the bytes they cover (for words: of the words joined by
blanks), so text that differs is not taken for a repeat, whoever wrote it.

A document's rows are told apart by id and the hash of the text (``ver``).
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from hashlib import blake2b
from itertools import accumulate

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablekit.llm import sketch
from tablekit.llm.common import binary, concatenated, slices
from tablekit.llm.windows import BASE, Families, Powers, Rolling, families, mixed

#: Words whose hashes a task remembers.
REMEMBERED = 150_000


class WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        out = xxhash.xxh64_intdigest(word)
        if len(self) < REMEMBERED and len(word) <= 64:
            self[word] = out
        return out


@dataclass(frozen=True)
class Plan:
    """What a window is: ``length`` symbols (bytes or words), anchored by grams of ``gram``."""

    length: int
    gram: int
    of_words: bool

    @property
    def slice_bytes(self) -> int:
        return 2 << 20

    @property
    def family_bytes(self) -> float:
        """About how many bytes of text make one family."""
        return (self.length - self.gram + 2) / 2 * (5 if self.of_words else 1)


class Reader:
    """Turns text columns into symbols; one for each task."""

    def __init__(self, plan: Plan):
        self.plan, self.words, self.powers = plan, WordHashes(), Powers(BASE)
        # Bytes need symbols with all 64 bits in use; any fixed scrambling will do.
        self.table = mixed(np.arange(1, 257, dtype=np.uint64))

    def symbols(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray, Spelling]:
        """The symbols of all rows, the row borders, and the symbols' bytes."""
        if not self.plan.of_words:
            data, borders = concatenated(column)
            return self.table[data], borders, Spelling(data.tobytes())
        texts = [x.split() for x in column.to_pylist()]
        borders = np.array([0, *accumulate(map(len, texts))], np.int64)
        words = [w for t in texts for w in t]
        symbols = np.fromiter(map(self.words.__getitem__, words), np.uint64, len(words))
        return symbols, borders, Spelling(words=words)

    def families(self, column: pa.Array) -> tuple[Spelling, np.ndarray, Families, np.ndarray]:
        """The symbols' bytes, row borders, families and each family's row."""
        symbols, borders, spelling = self.symbols(column)
        found = families(Rolling(symbols, self.powers), borders, self.plan.length, self.plan.gram)
        return spelling, borders, found, np.searchsorted(borders, found.low, "right") - 1


class Spelling:
    """The bytes of a run of symbols: the symbols themselves, or words, which are joined when first asked for."""

    def __init__(self, data: bytes | None = None, words: list[bytes] | None = None):
        self.data, self.words, self.starts = data, words, None

    def _join(self) -> None:
        if self.data is None:
            size = np.fromiter(map(len, self.words), np.int64, len(self.words))
            self.starts = np.concatenate([[0], np.cumsum(size + 1)])
            self.data, self.words = b" ".join(self.words), None

    def cut(self, start: np.ndarray, stop: np.ndarray) -> Iterator[bytes]:
        """The bytes from one symbol to another."""
        self._join()
        if self.starts is not None:
            start, stop = self.starts[start], self.starts[stop] - 1
        data = self.data
        return (data[a:b] for a, b in zip(start.tolist(), stop.tolist()))

    def digests(self, start: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The 128-bit hash of the bytes from one symbol to another, as two 64-bit numbers."""
        both = b"".join(blake2b(x, digest_size=16).digest() for x in self.cut(start, stop))
        both = np.frombuffer(both, "<u8").reshape(-1, 2)
        return np.ascontiguousarray(both[:, 0]), np.ascontiguousarray(both[:, 1])


def versions(column: pa.Array) -> np.ndarray:
    return np.array([xxhash.xxh64_intdigest(x) for x in column.to_pylist()], np.uint64)


def estimated(docs: DataFrame, plan: Plan) -> sketch.Repeated:
    """The count-min sketch of the anchors of all families."""
    n_bytes = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
        reader = Reader(plan)
        for part in slices(batches, "text", plan.slice_bytes):
            yield reader.families(binary(part.column("text")))[2].core

    return sketch.merged(docs.select("text"), keys, sketch.row_bits(n_bytes / plan.family_bytes))


def candidate_families(docs: DataFrame, plan: Plan, repeated: sketch.Repeated) -> DataFrame:
    """(doc_id, ver, place, low, high, core, content, content2): families whose anchor is estimated repeated.

    ``low`` and ``high`` are the first and last window start in the document; ``content``
    and ``content2`` are the hash of all that the windows cover.
    """
    held = docs.sparkSession.sparkContext.broadcast(repeated)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(plan)
        for part in slices(batches, "text", plan.slice_bytes):
            column = binary(part.column("text"))
            spelling, borders, found, row = reader.families(column)
            some = held.value(found.core)
            found, row = found[some], row[some]
            content = spelling.digests(found.low, found.high + plan.length)
            ver = versions(column)
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id").take(pa.array(row)), pa.array(ver[row].view(np.int64)),
                 pa.array(documents(part.column("doc_id"), ver)[row].view(np.int64)),
                 pa.array((found.low - borders[row]).astype(np.int32)),
                 pa.array((found.high - borders[row]).astype(np.int32)), pa.array(found.core.view(np.int64)),
                 *(pa.array(x.view(np.int64)) for x in content)],
                ["doc_id", "ver", "place", "low", "high", "core", "content", "content2"])

    return docs.select("doc_id", "text").mapInArrow(
        work, f"doc_id {kind}, ver long, place long, low int, high int, core long, content long, content2 long")


def classes(fams: DataFrame) -> DataFrame:
    """(core, content, content2, n, first, place, variants): families by content.

    ``n`` counts them, ``first`` is the smallest doc_id, ``place`` names one document that
    has it, ``variants`` is the number of contents around the same anchor.
    """
    by_content = fams.groupBy("core", "content", "content2").agg(
        F.count("*").alias("n"), F.min("doc_id").alias("first"), F.min("place").alias("place"))
    variants = by_content.groupBy("core").agg(F.count("*").alias("variants"))
    return by_content.join(variants, "core")


def same_content(fams: DataFrame, some: DataFrame, *columns: str) -> DataFrame:
    """The families whose content is in ``some``, with ``columns`` of it."""
    key = ["core", "content", "content2"]
    return fams.join(some.select(*key, *columns), key)


def documents(doc_id: pa.Array, ver: np.ndarray) -> np.ndarray:
    """A hash of each row's id and text."""
    if not pa.types.is_integer(doc_id.type):
        ids = versions(binary(doc_id.cast(pa.string())))
    else:
        ids = doc_id.cast(pa.int64()).fill_null(-1).to_numpy(zero_copy_only=False).view(np.uint64)
    return mixed(mixed(ver) + ids)


def place_key(owner: np.ndarray, content: np.ndarray) -> np.ndarray:
    """The key under which a class is looked up again: an owner (id or place) and a content."""
    return mixed(mixed(owner) ^ content)


def open_places(open_classes: DataFrame, owner: str, n: int) -> sketch.Repeated:
    """A Bloom filter of the (owner, content) of classes that need a closer look.

    It only decides which windows are looked at; looking at more changes no result.
    """
    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
        for b in batches:
            owners, contents = (b.column(k).to_numpy(zero_copy_only=False).view(np.uint64) for k in ("owner", "content"))
            yield place_key(owners, contents)

    rows = open_classes.select(F.col(owner).cast("long").alias("owner"), "content")
    return sketch.merged(rows, keys, sketch.row_bits(n), least=1)


def looked_at(docs: DataFrame, plan: Plan, places: sketch.Repeated, owner: str, schema: str,
              rows_of: Callable[..., pa.RecordBatch]) -> DataFrame:
    """A pass over the documents that gives ``rows_of`` the families in ``places``."""
    held = docs.sparkSession.sparkContext.broadcast(places)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(plan)
        for part in slices(batches, "text", plan.slice_bytes):
            column = binary(part.column("text"))
            spelling, borders, found, row = reader.families(column)
            ver = versions(column)
            content = spelling.digests(found.low, found.high + plan.length)
            owners = documents(part.column("doc_id"), ver) if owner == "place" else part.column("doc_id").cast(pa.int64()).to_numpy(
                zero_copy_only=False).astype(np.int64).view(np.uint64)
            some = held.value(place_key(owners[row], content[0]))
            yield rows_of(part, spelling, borders, found[some], row[some], ver, tuple(x[some] for x in content))

    return docs.select("doc_id", "text").mapInArrow(work, schema)


def windows_at(docs: DataFrame, plan: Plan, places: sketch.Repeated, owner: str) -> DataFrame:
    """(doc_id, ver, at, a, b): each window of the families in ``places`` with its 128-bit hash."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def rows_of(part, spelling, borders, found, row, ver, content):
        count = found.high - found.low + 1
        at = np.repeat(found.low - (np.cumsum(count) - count), count) + np.arange(count.sum())
        row = np.repeat(row, count)
        a, b = spelling.digests(at, at + plan.length)
        return pa.RecordBatch.from_arrays(
            [part.column("doc_id").take(pa.array(row)), pa.array(ver[row].view(np.int64)),
             pa.array((at - borders[row]).astype(np.int32)),
             pa.array(a.view(np.int64)), pa.array(b.view(np.int64))],
            ["doc_id", "ver", "at", "a", "b"])

    return looked_at(docs, plan, places, owner, f"doc_id {kind}, ver long, at int, a long, b long", rows_of)


def runs_by_document(intervals: DataFrame) -> DataFrame:
    """(doc_id, ver, runs): the distinct (start, stop) of each document, as one array.

    An array has at most as many entries as its document has windows.
    """
    return intervals.groupBy("doc_id", "ver").agg(F.collect_set(F.struct("start", "stop")).alias("runs"))


def merged_runs(runs: list[dict] | None) -> list[tuple[int, int]]:
    """Sorted runs; those that overlap or touch are one."""
    out: list[tuple[int, int]] = []
    for start, stop in sorted((r["start"], r["stop"]) for r in runs or ()):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], stop))
        else:
            out.append((start, stop))
    return out


def with_runs(docs: DataFrame, runs: DataFrame) -> DataFrame:
    """(doc_id, text, runs) for every document; runs are null where nothing repeats."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            column = binary(part.column("text"))
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), column.cast(pa.binary()), pa.array(versions(column).view(np.int64))],
                ["doc_id", "text", "ver"])

    rows = docs.select("doc_id", "text").mapInArrow(work, f"doc_id {kind}, text binary, ver long")
    runs = runs.select(F.col("doc_id").alias("run_id"), F.col("ver").alias("run_ver"), "runs")
    return rows.join(runs, F.col("doc_id").eqNullSafe(F.col("run_id")) & (F.col("ver") == F.col("run_ver")),
                     "left").select("doc_id", "text", "runs")
