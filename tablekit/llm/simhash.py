"""SimHash near-duplicates with vantage-point trees.

Documents of equal fingerprints are one class; everything below works on the
distinct fingerprints.  A vantage-point tree, built on a bounded sample, cuts them
into shards: at a node, a fingerprint within the node's radius of the vantage
point goes left, the others go right.  By the triangle inequality, fingerprints
that differ in at most d bits have distances from the vantage point that differ by
at most d, so only those within d of the radius can have a partner on the other
side; they also go right.  Hence any two linked fingerprints meet in at least one
shard, whatever the vantage points are: the sample decides the balance, never the
result.  In a shard, the same split goes on until a few hundred are left, which
are compared exactly.

A shard returns one link per member at most (a forest), so that a dense group does
not give the square of its size; ``components`` joins the shards' forests.

Defined results for odd input: a null text is empty; a text without words has
fingerprint 0 and is linked like any other; repeated rows are in one class; a
component whose documents have no id has a null component_id; extra columns are
ignored by ``near_duplicates`` and kept by ``keep_one``.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablekit.llm.common import Staging, binary, slices
from tablekit.llm.components import components

#: Words in a shingle, the hash's seed, and the bits in which linked fingerprints may differ.
SHINGLE, SEED, MAX_BITS = 3, 42, 3
#: Fingerprints that a shard should hold; sampled ones per shard; the largest sample.
SHARD, SAMPLED, MAX_SAMPLE = 32_768, 64, 1 << 18
#: Fingerprints that are compared pairwise without another split, and looked at to choose one.
FEW, LOOKED_AT = 256, 2048

LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def fingerprint(text: bytes, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """Bit b is set if it is set in over half of the shingles' hashes."""
    words = text.translate(LOWER).split()
    if not words:
        return 0
    if len(words) < shingle:
        return xxhash.xxh64_intdigest(b" ".join(words), seed)
    n, bits = len(words) - shingle + 1, np.zeros(64, np.int64)
    for start in range(0, n, 1 << 16):
        some = words[start:start + (1 << 16) + shingle - 1]
        hashes = np.fromiter(map(xxhash.xxh64_intdigest, map(b" ".join, zip(*(some[k:] for k in range(shingle)))),
                                 repeat(seed)), "<u8")
        bits += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * bits > n, bitorder="little").view("<u8")[0])


def with_fingerprints(docs: DataFrame, into: str = "fp", text: str = "text", shingle: int = SHINGLE,
                      seed: int = SEED, keep_text: bool = True) -> DataFrame:
    """``docs`` plus the fingerprint as a signed long."""
    kept = [f for f in docs.schema if keep_text or f.name != text]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept) + f", `{into}` long"

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, text):
            values = [fingerprint(x, shingle, seed) for x in binary(part.column(text)).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*(part.column(f.name) for f in kept), pa.array(np.array(values, np.uint64).view(np.int64))],
                [*(f.name for f in kept), into])

    return docs.mapInArrow(work, schema)


def distance(x: np.ndarray, point: int) -> np.ndarray:
    return np.bitwise_count(x ^ np.uint64(point)).astype(np.int64)


def split(points: np.ndarray, bits: int, tries: int = 4) -> tuple[int, int] | None:
    """(vantage point, radius) that cuts the points best, or None if no cut saves work.

    Of some members, evenly spaced in order of their values, the one whose cut puts the
    fewest points on the larger side; judged on at most LOOKED_AT of the points.
    """
    points = points[::-(-len(points) // LOOKED_AT)]
    best, cost = None, 0.85 * len(points)
    ordered = np.sort(points)
    for point in ordered[np.linspace(0, len(ordered) - 1, tries).astype(int)].tolist():
        d = distance(points, point)
        for radius in np.unique(np.quantile(d, (0.4, 0.5, 0.6)).astype(int)).tolist():
            left, right = int((d <= radius).sum()), int((d > radius - bits).sum())
            if max(left, right) < cost and left and right:
                best, cost = (point, radius), max(left, right)
    return best


class Tree:
    """A vantage-point tree whose leaves are shards; nodes are (point, radius, left, right)."""

    def __init__(self, sample: np.ndarray, leaf: int, bits: int):
        self.bits, self.nodes, self.leaves = bits, [], 0
        self.root = self._grow(sample, leaf)

    def _grow(self, points: np.ndarray, leaf: int) -> int:
        """The node's index, or -1 - the leaf's number."""
        cut = split(points, self.bits) if len(points) > leaf else None
        if cut is None:
            self.leaves += 1
            return -self.leaves
        d = distance(points, cut[0])
        at = len(self.nodes)
        self.nodes.append(None)
        self.nodes[at] = (*cut, self._grow(points[d <= cut[1]], leaf),
                          self._grow(points[d > cut[1] - self.bits], leaf))
        return at

    def route(self, points: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        """(leaf, its points); a point within the bits of a border goes to both sides."""
        todo = [(self.root, points)]
        while todo:
            at, some = todo.pop()
            if not len(some):
                continue
            if at < 0:
                yield -1 - at, some
                continue
            point, radius, left, right = self.nodes[at]
            d = distance(some, point)
            todo += [(left, some[d <= radius]), (right, some[d > radius - self.bits])]


def merge(labels: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Labels (the smallest member of each component) after joining i and j."""
    while True:
        a, b = labels[i], labels[j]
        if (a == b).all():
            return labels
        least = np.minimum(a, b)
        np.minimum.at(labels, a, least)
        np.minimum.at(labels, b, least)
        while True:
            further = labels[labels]
            if (further == labels).all():
                break
            labels = further


def forest(points: np.ndarray, bits: int) -> np.ndarray:
    """For each distinct point the index of the smallest one that links of at most ``bits`` reach."""
    labels, todo = np.arange(len(points)), [np.arange(len(points))]
    while todo:
        own = todo.pop()
        cut = split(points[own], bits) if len(own) > FEW else None
        if cut is not None:
            d = distance(points[own], cut[0])
            todo += [own[d <= cut[1]], own[d > cut[1] - bits]]
            continue
        x = points[own]
        for start in range(0, len(x), FEW):  # blocks, so that memory stays bounded
            near = np.bitwise_count(x[start:start + FEW, None] ^ x[None, start:]) <= bits
            i, j = np.nonzero(near)
            more = j > i
            labels = merge(labels, own[start + i[more]], own[start + j[more]])
    return labels


def links(points: DataFrame, bits: int = MAX_BITS, shard: int = SHARD) -> DataFrame:
    """(a, b): links that join all distinct fingerprints within ``bits`` of each other."""
    spark = points.sparkSession
    n = points.count()
    size = min(MAX_SAMPLE, max(1, -(-n // shard)) * SAMPLED)
    sample = points.orderBy(F.xxhash64("fp"), "fp").limit(size).collect()
    tree = spark.sparkContext.broadcast(Tree(
        np.array([r.fp for r in sample], np.int64).view(np.uint64), max(1, len(sample) * shard // max(1, n)), bits))

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for leaf, some in tree.value.route(batch.column("fp").to_numpy().view(np.uint64)):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(some), leaf, np.int32)), pa.array(some.view(np.int64))], ["leaf", "fp"])

    def join(table: pa.Table) -> pa.Table:
        x = np.unique(table.column("fp").to_numpy().view(np.uint64))
        labels = forest(x, bits)
        linked = np.flatnonzero(labels != np.arange(len(x)))
        return pa.table({"a": x[linked].view(np.int64), "b": x[labels[linked]].view(np.int64)})

    return (points.select("fp").mapInArrow(route, "leaf int, fp long")
            .groupBy("leaf").applyInArrow(join, "a long, b long"))


def classes(fingerprints: DataFrame, staging: Staging, bits: int = MAX_BITS, shard: int = SHARD) -> DataFrame:
    """(fp, component): the component of each distinct fingerprint, named by its smallest member."""
    points = staging.put("points", fingerprints.select("fp").distinct())
    found = components(links(points, bits, shard), staging)
    return points.join(found, points.fp == found.node, "left").select(
        "fp", F.coalesce("root", "fp").alias("component"))


def near_duplicates(docs: DataFrame, bits: int = MAX_BITS, shingle: int = SHINGLE, seed: int = SEED,
                    shard: int = SHARD) -> DataFrame:
    """One row per document: doc_id, fingerprint (hex), component_id (smallest doc_id reachable)."""
    staging = Staging(docs.sparkSession, "simhash")
    prints = staging.put("prints", with_fingerprints(docs.select("doc_id", "text"), "fp", shingle=shingle,
                                                     seed=seed, keep_text=False))
    found = staging.put("classes", classes(prints, staging, bits, shard))
    staging.drop("points")
    smallest = prints.groupBy("fp").agg(F.min("doc_id").alias("least")).join(found, "fp")
    named = smallest.groupBy("component").agg(F.min("least").alias("component_id"))
    by_print = found.join(named, "component").select("fp", "component_id")
    return prints.join(by_print, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, bits: int = MAX_BITS, shingle: int = SHINGLE, seed: int = SEED) -> DataFrame:
    """``docs`` with one document of each component: the smallest id, then the smallest fingerprint,
    then the smallest hash of the text.

    A missing id counts as larger than any other; of rows with the same id and text one stays.
    The row is chosen by its keys; texts are shuffled only where an id and text come more than once.
    """
    staging = Staging(docs.sparkSession, "simhash-keep")
    mark = "simhash__text"
    text = F.sha2(F.coalesce("text", F.lit("")), 256)
    prints = staging.put("prints", with_fingerprints(docs.select("doc_id", "text", text.alias("hash")), "fp", shingle=shingle,
                                                     seed=seed, keep_text=False).groupBy("doc_id", "fp", "hash").agg(
        F.count("*").alias("n")))
    found = classes(prints.select("doc_id", "fp").distinct(), staging, bits)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("missing"), "doc_id", "fp", "hash", "n")).alias("first")
    by_print = prints.groupBy("fp").agg(first).join(found, "fp")
    kept = staging.put("kept", by_print.groupBy("component").agg(F.min("first").alias("first")).select(
        F.col("first.doc_id").alias("kept_id"), F.col("first.hash").alias("kept_hash"), F.col("first.n").alias("kept_n")))
    staging.drop("points", "prints")
    rows = docs.withColumn(mark, text)
    columns = [F.col(f"`{c}`") for c in docs.columns]

    def chosen(some: DataFrame) -> DataFrame:
        return rows.join(some, (F.col(mark) == F.col("kept_hash")) & F.col("doc_id").eqNullSafe(F.col("kept_id")), "left_semi")

    once = chosen(kept.where("kept_n = 1")).select(*columns)
    if kept.where("kept_n > 1").isEmpty():
        return once
    return once.unionAll(chosen(kept.where("kept_n > 1")).dropDuplicates([mark, "doc_id"]).select(*columns))
