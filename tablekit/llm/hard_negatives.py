"""Hard negatives for contrastive training by a secondary-sort shuffle.

Every (anchor, row) pair has an integer score, the inner product of the scaled vectors.
Pairs travel under packed keys (anchor, descending score, id), 24 bytes that sort as
bytes, and ``repartitionAndSortWithinPartitions`` brings an anchor's pairs into order.
A streaming iterator walks them: a row of the anchor's label opens a positive window,
rows of other labels inside an open window are emitted as its negatives.  It holds the
open windows and the negatives tied with the present score, never an anchor's pairs.

Anchors are a query set, read in blocks of bounded bytes, each block against all rows.
Before the shuffle every task keeps what can still count: per anchor its best positives,
and, once a first pass has fixed the positives' scores, per window its best negatives.
So a task sends a bounded number of pairs per anchor, whatever rows it has read, and no
pair is lost: a pair that is not among its task's best is not among all rows' best.

Defined results for odd input: rows with a null id, label or vector, or any null or
non-finite component take no part; a vector that is shorter than another counts as
followed by zeros; scores beyond 2^56 either way count as 2^56; equal scores are
ordered by id; a row repeated in full is a row of its own each time (also as an anchor:
its result rows repeat), and only the anchor's own row is left out of its positives;
an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablekit.llm.common import Staging

#: Bytes of the anchors of one block, and (anchor, row) scores that a task holds at once.
BLOCK_BYTES, SCORES = 8 << 20, 1 << 21
#: Scores are held within this bound, so that a hundredfold fits 64 bits.
LIMIT = 1 << 56
POSITIVE, NEGATIVE, TWIN = 0, 1, 2
_SIGN = np.uint64(1 << 63)


@dataclass(frozen=True)
class Rule:
    """The first ``positives`` rows of a label; for each the first ``negatives`` with
    low * positive <= 100 * negative <= high * positive."""

    positives: int = 5
    negatives: int = 5
    low: int = 80
    high: int = 100

    def __post_init__(self):
        if self.high > 100:
            raise ValueError("a window must not begin above its positive")


@dataclass
class Anchors:
    """A block of anchors: ids, labels, how often the row occurs, scaled vectors and their lengths."""

    ids: np.ndarray
    labels: np.ndarray
    copies: np.ndarray
    vectors: np.ndarray
    sizes: np.ndarray


def usable(vectors: DataFrame, vec_id: str, vector: str, label: str, scale: int) -> DataFrame:
    """(id, label, vector) of the rows that take part; components are scaled and floored."""
    parts = F.transform(F.col(vector), lambda x: x.cast("double"))
    odd = F.exists("vector", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = vectors.select(F.col(vec_id).cast("long").alias("id"), F.col(label).cast("long").alias("label"),
                          parts.alias("vector"))
    rows = rows.where(F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("vector").isNotNull() & ~odd)
    # floor of a double as a double: SQL's floor would give a 64-bit integer.
    floored = F.transform("vector", lambda x: F.when(F.abs(x * scale) < 2.0 ** 52, F.floor(x * scale).cast("double"))
                          .otherwise(x * scale))
    return rows.select("id", "label", floored.alias("vector"))


def _column(batch, name: str) -> np.ndarray:
    return batch.column(name).to_numpy(zero_copy_only=False)


def matrix(column: pa.Array, width: int) -> np.ndarray:
    """The vectors as rows of ``width`` components; short ones are followed by zeros."""
    out = np.zeros((len(column), width))
    size = np.array(column.value_lengths().fill_null(0))
    if len(size) and (size == size[0]).all():
        keep = min(width, int(size[0]))
        out[:, :keep] = column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)[:, :keep]
        return out
    row = np.repeat(np.arange(len(size)), size)
    at = np.arange(len(row)) - np.repeat(np.cumsum(size) - size, size)
    inside = at < width
    out[row[inside], at[inside]] = column.flatten().to_numpy(zero_copy_only=False)[inside]
    return out


def scores(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact integer inner products of the rows of ``a`` with the rows of ``b``."""
    if not a.size or not b.size:
        return np.zeros((len(a), len(b)), np.int64)
    if float(np.abs(a).max()) * float(np.abs(b).max()) * a.shape[1] < 2.0 ** 53:
        return (a @ b.T).astype(np.int64)
    a, b = np.nan_to_num(a), np.nan_to_num(b)        # scaled beyond a double: its largest value
    exact = [[int(x) for x in row] for row in b]     # sums beyond a double's integers
    return np.array([[max(-LIMIT, min(LIMIT, sum(map(int.__mul__, x, y)))) for y in exact]
                     for x in ([int(v) for v in row] for row in a)], np.int64)


class Best:
    """For each of n lists the ``size`` best entries so far, by descending score, id, and order of arrival."""

    def __init__(self, n: int, size: int):
        self.size = size
        self.down = np.full((n, size), np.iinfo(np.int64).max)    # -1 - score
        self.ids = np.full((n, size), np.iinfo(np.int64).max)
        self.seq = np.full((n, size), -1)                         # -1: no entry
        self.kind = np.zeros((n, size), np.int8)

    def add(self, some: np.ndarray, down: np.ndarray, ids: np.ndarray, seq: np.ndarray, kind: np.ndarray) -> None:
        """Entries (one row for each list in ``some``) join; the best stay."""
        have = [np.concatenate([getattr(self, k)[some], new], 1)
                for k, new in (("down", down), ("ids", ids), ("seq", seq), ("kind", kind))]
        order = np.lexsort((have[1], have[0], have[2] < 0))[:, :self.size]
        for k, x in zip(("down", "ids", "seq", "kind"), have):
            getattr(self, k)[some] = np.take_along_axis(x, order, 1)


def candidates(batches: Iterator[pa.RecordBatch], anchors: Anchors, rule: Rule,
               opened: np.ndarray | None) -> Iterator[pa.RecordBatch]:
    """(key, kind): the pairs of a task's rows that can still count.

    ``opened`` holds the positives' scores of each anchor, best first (``LIMIT`` + 1 where
    there is none); without it only positives are looked for.
    """
    n, width = anchors.vectors.shape
    positives = Best(n, rule.positives + 1)          # one more: the anchor's own row may be among them
    negatives = [Best(n, rule.negatives) for _ in range(0 if opened is None else rule.positives)]
    every, seen = np.arange(n), 0
    step = max(1, SCORES // max(1, n))
    by_id = np.argsort(anchors.ids, kind="stable")
    for batch in batches:
        for at in range(0, batch.num_rows, step):
            part = batch.slice(at, step)
            ids, labels, vectors = _column(part, "id"), _column(part, "label"), matrix(part.column("vector"), width)
            order = np.argsort(ids, kind="stable")   # ties come by id
            ids, labels, vectors = ids[order], labels[order], vectors[order]
            size = part.column("vector").value_lengths().to_numpy(zero_copy_only=False)[order]
            seq = seen + np.arange(len(ids))
            seen += len(ids)
            down = ~scores(anchors.vectors, vectors)
            same = anchors.labels[:, None] == labels[None, :]
            kind = np.where(same, POSITIVE, NEGATIVE).astype(np.int8)
            low = np.searchsorted(anchors.ids[by_id], ids, "left")
            high = np.searchsorted(anchors.ids[by_id], ids, "right")
            for row in np.flatnonzero(low < high):   # rows that are an anchor, or a copy of one
                for j in by_id[low[row]:high[row]]:
                    if same[j, row] and size[row] == anchors.sizes[j] and (vectors[row] == anchors.vectors[j]).all():
                        kind[j, row] = TWIN
            end = np.iinfo(np.int64).max
            least = np.argsort(np.where(same, down, end), axis=1, kind="stable")[:, :positives.size]
            _join(positives, every, least, down, ids, seq, kind, np.take_along_axis(same, least, 1))
            if opened is None:
                continue
            other = np.where(same, end, down)
            rank = np.argsort(other, axis=1, kind="stable")
            ordered = np.take_along_axis(other, rank, 1)
            for w, best in enumerate(negatives):
                p = opened[:, w]
                some = np.flatnonzero(p <= LIMIT)
                if not len(some):
                    continue
                score = ~ordered[some]
                first = (100 * score > rule.high * p[some, None]).sum(1)
                take = first[:, None] + np.arange(rule.negatives)
                inside = take < len(ids)
                take = np.minimum(take, len(ids) - 1)
                got = np.take_along_axis(score, take, 1)
                inside &= (np.take_along_axis(ordered[some], take, 1) != end) & (100 * got >= rule.low * p[some, None])
                _join(best, some, np.take_along_axis(rank[some], take, 1), down, ids, seq, kind, inside)
    yield _packed([positives, *negatives])


def _join(best: Best, some: np.ndarray, take: np.ndarray, down, ids, seq, kind, valid) -> None:
    end = np.iinfo(np.int64).max
    best.add(some, np.where(valid, np.take_along_axis(down[some], take, 1), end), np.where(valid, ids[take], end),
             np.where(valid, seq[take], -1), np.take_along_axis(kind[some], take, 1))


def _packed(lists: list[Best]) -> pa.RecordBatch:
    """The entries as keys (anchor, descending score, id), each row of the task once per anchor."""
    found = []
    for best in lists:
        anchor, at = np.nonzero(best.seq >= 0)
        found.append(np.stack([anchor, best.seq[anchor, at], best.down[anchor, at], best.ids[anchor, at],
                               best.kind[anchor, at]], 1))
    found = np.unique(np.concatenate(found), axis=0)
    keys = np.empty((len(found), 3), ">u8")
    keys[:, 0] = found[:, 0]
    keys[:, 1], keys[:, 2] = (found[:, k].astype(np.int64).view(np.uint64) ^ _SIGN for k in (2, 3))
    packed = pa.FixedSizeBinaryArray.from_buffers(pa.binary(24), len(found), [None, pa.py_buffer(keys.tobytes())])
    return pa.RecordBatch.from_arrays([packed.cast(pa.binary()), pa.array(found[:, 4].astype(np.int32))], ["key", "kind"])


def unpacked(key: bytes) -> tuple[int, int, int]:
    """(anchor, score, id) of a key."""
    anchor, down, other = struct.unpack(">QQQ", key)
    return anchor, ~(down - (1 << 63)), other - (1 << 63)


class Window:
    """A positive whose negatives are being looked for."""

    def __init__(self, positive: int, score: int):
        self.positive, self.score, self.given = positive, score, 0

    def offer(self, rule: Rule, score: int, other: int) -> tuple | None:
        """The result (positive, rank, negative, scores) if the row is one of its negatives."""
        if self.given >= rule.negatives or not rule.low * self.score <= 100 * score <= rule.high * self.score:
            return None
        self.given += 1
        return self.positive, self.given, other, self.score, score


def walk(entries: Iterator[tuple[bytes, int]], rule: Rule) -> Iterator[tuple[int, tuple | None, int, int]]:
    """(anchor, result or None, score, opened) in key order.

    A result is a negative of a window; None marks that a window was opened.
    """
    for anchor, pairs in groupby(((*unpacked(k), kind) for k, kind in entries), key=lambda e: e[0]):
        windows, opened, own, tied, at = [], 0, False, [], None
        for _, score, other, kind in pairs:
            if score != at:
                at, tied = score, []
                windows = [w for w in windows if w.given < rule.negatives and rule.low * w.score <= 100 * score]
            if kind == NEGATIVE:
                for w in windows:
                    if got := w.offer(rule, score, other):
                        yield anchor, got, score, opened
                if len(tied) < rule.negatives:
                    tied.append(other)
            elif kind == TWIN and not own:
                own = True                            # the anchor itself
            elif opened < rule.positives:
                opened += 1
                windows.append(Window(other, score))
                yield anchor, None, score, opened
                for before in tied:                   # as high as the positive, with smaller ids
                    if got := windows[-1].offer(rule, score, before):
                        yield anchor, got, score, opened


def mine(vectors: DataFrame, is_anchor: Column, rule: Rule = Rule(), vec_id: str = "vec_id", vector: str = "embedding",
         label: str = "label", scale: int = 256, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    ``is_anchor`` is a condition on ``id`` (the row's id as a long) that picks the query set.
    """
    spark, staging = vectors.sparkSession, Staging(vectors.sparkSession, "hard-negatives")
    rows = usable(vectors, vec_id, vector, label, scale)
    queries = rows.where(is_anchor).groupBy("id", "label", "vector").agg(F.count("*").alias("copies"))
    queries = staging.put("anchors", queries)
    size = queries.agg(F.sum(24 + 8 * F.size("vector"))).first()[0] or 0
    blocks = max(1, -(-size // block_bytes))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    schema = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    done = []
    for b in range(blocks):
        block = queries.where(F.pmod(F.xxhash64("id", "label", "vector"), F.lit(blocks)) == b).toArrow()
        if block.num_rows:
            done.append(staging.put(f"block{b}", spark.createDataFrame(_block(rows, _anchors(block), rule, parts), schema)))
    staging.drop("anchors")
    if not done:
        return spark.createDataFrame([], schema)
    out = done[0]
    for more in done[1:]:
        out = out.unionAll(more)
    return out


def _anchors(block: pa.Table) -> Anchors:
    block = block.combine_chunks()
    vectors = block.column("vector").combine_chunks()
    sizes = vectors.value_lengths().to_numpy(zero_copy_only=False)
    return Anchors(*(_column(block, c) for c in ("id", "label", "copies")), matrix(vectors, max(1, int(sizes.max()))), sizes)


def _block(rows: DataFrame, anchors: Anchors, rule: Rule, parts: int):
    """The results of one block of anchors against all rows, as an RDD of tuples."""
    held = rows.sparkSession.sparkContext.broadcast(anchors)

    def sorted_pairs(opened):
        def work(batches):
            return candidates(batches, held.value, rule, opened.value if opened else None)

        pairs = rows.mapInArrow(work, "key binary, kind int").rdd.map(lambda r: (bytes(r.key), r.kind))
        return pairs.repartitionAndSortWithinPartitions(parts, lambda key: int.from_bytes(key[:8], "big"))

    def first_scores(entries):
        return ((anchor, opened, score) for anchor, got, score, opened in walk(entries, rule) if got is None)

    def results(entries):
        for anchor, got, _, _ in walk(entries, rule):
            if got:
                for _ in range(held.value.copies[anchor]):
                    yield int(held.value.ids[anchor]), *got

    opened = np.full((len(anchors.ids), rule.positives), LIMIT + 1)
    for anchor, k, score in sorted_pairs(None).mapPartitions(first_scores).collect():   # at most ``positives`` an anchor
        opened[anchor, k - 1] = score
    return sorted_pairs(rows.sparkSession.sparkContext.broadcast(opened)).mapPartitions(results)


def op13_rows(embeddings: DataFrame) -> DataFrame:
    """The stated labels (every seventh id's is moved by one) and query set (ids divisible by 100)."""
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine(embeddings.withColumn("label", moved), F.col("id") % 100 == 0)


MINE_SQL = """
WITH r AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         [CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT) for x in embedding] AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same,
         CAST(list_sum([z[1] * z[2] for z in list_zip(a.v, b.v)]) AS BIGINT) AS score
  FROM r a JOIN r b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0),
p AS (
  SELECT anchor_id, id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5)
SELECT p.anchor_id, positive_id, CAST(row_number() OVER w AS INTEGER) AS rank, s.id AS negative_id,
       positive_score, s.score AS negative_score
FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT same
  AND 80 * positive_score <= 100 * s.score AND 100 * s.score <= 100 * positive_score
WINDOW w AS (PARTITION BY p.anchor_id, positive_id ORDER BY s.score DESC, s.id)
QUALIFY row_number() OVER w <= 5"""
