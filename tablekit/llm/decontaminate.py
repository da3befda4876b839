"""Benchmark decontamination with suffix arrays of the training text.

Every task takes its documents as shards of bounded bytes and builds a suffix
array of each shard's words: the positions sorted by the next ``WINDOW`` words.
The test suffixes (all windows of all benchmark items) are found in it by binary
search; each interval gives all locations.  Test windows of equal words are one
window with one set of items, so a phrase that many items and many documents share
costs one search and one set.  Among the test suffixes of a window, which are kept
in order of all their words, the longest match with a place is one of the two
neighbours of the place's own suffix.  Words that no item has break the shard: a
suffix that cannot hold a whole test window is not sorted.

The benchmark is broadcast in blocks of at most ``BLOCK_WORDS`` words, each one a
pass over the documents; what a pass found is kept beside the document.

Defined results for odd input: null texts have no words and are never
contaminated; an item without words matches nothing; an item without an id is
named by the empty string; repeated items count once; repeated documents are
scanned each on their own; extra columns stay (``find_contamination`` replaces one
named like its result).
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablekit.llm.common import Staging, binary, slices
from tablekit.llm.license_scan import CANONICAL

#: Words in a window, and in a block of the benchmark (about a hundred bytes each when broadcast).
WINDOW, BLOCK_WORDS = 10, 1_000_000

STATE = pa.struct([
    ("n_words", pa.int64()),
    ("hits", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
    ("items", pa.list_(pa.string())),
    ("longest", pa.int64()), ("longest_item", pa.string()), ("longest_at", pa.int64())])
STATE_SQL = ("struct<n_words:bigint,hits:array<struct<start:bigint,end:bigint>>,items:array<string>,"
             "longest:bigint,longest_item:string,longest_at:bigint>")


def words(text: bytes) -> list[bytes]:
    return text.translate(CANONICAL).split()


class TestSuffixes:
    """The windows of a block of benchmark items, sorted once and without repeats."""

    __test__ = False  # not a test class

    def __init__(self, items: list[tuple[str, bytes]], window: int = WINDOW):
        texts = [(name, words(text)) for name, text in items]
        texts = [(name, w) for name, w in texts if w]
        self.window, self.names = window, [name for name, _ in texts]
        self.vocabulary = {w: i + 1 for i, w in enumerate(sorted({x for _, w in texts for x in w}))}
        ids = [[self.vocabulary[x] for x in w] for _, w in texts]
        #: All items' words, each item followed by enough zeros that no window crosses it.
        self.words = np.array([x for w in ids for x in [*w, *[0] * window]], np.int64)
        starts = np.cumsum([0, *(len(w) + window for w in ids)])[:-1]
        at = [(s + q, min(window, len(w)), i) for i, (s, w) in enumerate(zip(starts, ids))
              for q in range(max(1, len(w) - window + 1))]
        self.at, self.length, self.item = (np.array([x[k] for x in at], np.int64) for k in range(3))
        self.shortest = int(self.length.min()) if at else window
        keys = suffix_keys(self.words, self.at, window)
        whole = suffix_ranks(self.words)
        order = np.lexsort((whole[self.at], self.length, keys)) if len(at) else np.zeros(0, np.int64)
        self.at, self.length, self.item, keys = self.at[order], self.length[order], self.item[order], keys[order]
        new = np.ones(len(at), bool)
        new[1:] = (keys[1:] != keys[:-1]) | (self.length[1:] != self.length[:-1])
        #: Windows of equal words stand together: first[k] to first[k + 1].
        self.first = np.append(np.flatnonzero(new), len(at))
        self.keys, self.key_length = keys[self.first[:-1]], self.length[self.first[:-1]]
        #: All words as bytes that compare like them, and the items of each window.
        self.spelled = self.words.astype(">u4").tobytes() + bytes(4)
        self.items = [np.unique(self.item[a:b]) for a, b in zip(self.first, self.first[1:])]
        self.above = np.array([k.ljust(4 * window, b"\0")[:4 * n] + b"\xff" * 4 * (window - n)
                               for k, n in zip(self.keys.tolist(), self.key_length.tolist())], keys.dtype)


    def nearest(self, spelled: bytes, place: int, end: int, window: int) -> tuple[int, int]:
        """(length, item) of the longest match of the words from ``place`` to ``end`` with the
        test suffixes of a window; of equal ones the first in the benchmark's order of suffixes."""
        own, theirs = spelled[4 * place:4 * end], self.spelled
        low, high = int(self.first[window]), int(self.first[window + 1])
        a, b = low, high
        while a < b:
            k = (a + b) // 2
            at = 4 * int(self.at[k])
            if theirs[at:at + len(own)] < own:
                a = k + 1
            else:
                b = k
        found = [(common(own, theirs, 4 * int(self.at[k])), -k) for k in (a - 1, a) if low <= k < high]
        length, k = max(found)
        return length, int(self.item[-k])


def common(own: bytes, theirs: bytes, at: int) -> int:
    """How many words from the start of ``own`` and from ``at`` are the same (four bytes each)."""
    most = min(len(own), len(theirs) - at) // 4
    a, b = np.frombuffer(own, "<u4", most), np.frombuffer(theirs, "<u4", most, at)
    done, step = 0, 64
    while done < most:
        differ = a[done:done + step] != b[done:done + step]
        if differ.any():
            return done + int(differ.argmax())
        done, step = done + step, 2 * step
    return most


def suffix_ranks(ids: np.ndarray) -> np.ndarray:
    """The rank of each place's suffix by all words up to the next break, by doubling."""
    n, rank, done = len(ids), np.unique(ids, return_inverse=True)[1] if len(ids) else ids, 1
    zero = ids == 0
    while done < n:
        behind = np.zeros(n, np.int64)
        behind[:n - done] = rank[done:]
        behind[np.append(zero, np.ones(done, bool))[done - 1:n + done - 1] | zero] = 0
        new = np.unique(rank * (n + 1) + behind, return_inverse=True)[1]
        if (new == rank).all():
            break
        rank, done = new, 2 * done
    return rank


def suffix_keys(ids: np.ndarray, at: np.ndarray, window: int) -> np.ndarray:
    """The next ``window`` words from each place as comparable bytes; zeros from the first break on."""
    wide = np.append(ids, np.zeros(window, ids.dtype))
    rows = np.empty((len(at), window), ">u4")
    alive = np.ones(len(at), bool)
    for k in range(window):
        column = wide[at + k]
        alive &= column > 0
        rows[:, k] = np.where(alive, column, 0)
    return rows.view(f"S{4 * window}").ravel()


class Shard:
    """The words of some documents and the suffix array of the places that can match."""

    def __init__(self, texts: list[bytes], tests: TestSuffixes):
        found, get, self.tests = [], tests.vocabulary.get, tests
        for text in texts:
            w = words(text)
            found.append(np.fromiter(map(get, w, repeat(0)), np.int64, len(w)))
        self.sizes = np.array([len(x) for x in found], np.int64)
        self.starts = np.cumsum(self.sizes + 1) - self.sizes - 1  # a break follows each document
        self.ids = np.concatenate([y for x in found for y in (x, np.zeros(1, np.int64))])
        n = len(self.ids)
        breaks = np.where(self.ids == 0, np.arange(n), n)
        run = np.minimum.accumulate(breaks[::-1])[::-1] - np.arange(n)
        places = np.flatnonzero(run >= tests.shortest)
        keys = suffix_keys(self.ids, places, tests.window)
        order = np.argsort(keys, kind="stable")
        self.suffixes, self.keys = places[order], keys[order]

    def search(self) -> tuple[np.ndarray, np.ndarray]:
        """(place, window) of all places of all test windows, by two binary searches for each."""
        low = np.searchsorted(self.keys, self.tests.keys, "left")
        high = np.searchsorted(self.keys, self.tests.above, "right")
        count = np.maximum(high - low, 0)
        window = np.repeat(np.arange(len(count)), count)
        within = np.arange(len(window)) - np.repeat(np.cumsum(count) - count, count)
        return self.suffixes[np.repeat(low, count) + within], window

    def covered(self, place: np.ndarray, window: np.ndarray) -> np.ndarray:
        """Whether each word lies inside a found window."""
        edge = np.zeros(len(self.ids) + 1, np.int64)
        np.add.at(edge, place, 1)
        np.add.at(edge, place + self.tests.key_length[window], -1)
        return np.cumsum(edge[:-1]) > 0

    def longest(self, place: np.ndarray, window: np.ndarray) -> Iterator[tuple[int, int, int, int]]:
        """(document, length, item, place): the longest match of each document, the first of several.

        Places are walked in order; one that could not beat the document's best before its
        run of known words ends is passed over.
        """
        t, spelled = self.tests, self.ids.astype(">u4").tobytes() + bytes(4)
        breaks = np.flatnonzero(np.append(self.ids, 0) == 0)
        order = np.lexsort((t.key_length[window], place))
        place, window = place[order], window[order]
        end = breaks[np.searchsorted(breaks, place)]
        doc = np.searchsorted(self.starts, place, "right") - 1
        now, best = -1, (0, 0, 0)
        for p, w, e, d in zip(place.tolist(), window.tolist(), end.tolist(), doc.tolist()):
            if d != now:
                if now >= 0:
                    yield now, *best
                now, best = d, (0, 0, 0)
            if e - p <= best[0]:
                continue
            length, item = t.nearest(spelled, p, e, w)
            if length > best[0]:
                best = length, item, p - int(self.starts[d])
        if now >= 0:
            yield now, *best


def scan(texts: list[bytes], tests: TestSuffixes) -> list[dict]:
    """The state (see STATE) of each text after one block."""
    shard = Shard(texts, tests)
    out = [dict(n_words=int(n), hits=[], items=[], longest=0, longest_item=None, longest_at=None) for n in shard.sizes]
    place, window = shard.search()
    if not len(place):
        return out
    inside = np.concatenate([[False], shard.covered(place, window), [False]])
    turns = np.flatnonzero(inside[1:] != inside[:-1])
    doc_of = lambda p: np.searchsorted(shard.starts, p, "right") - 1
    for d, a, b in zip(doc_of(turns[::2]), turns[::2], turns[1::2]):
        out[d]["hits"].append({"start": int(a - shard.starts[d]), "end": int(b - shard.starts[d])})
    for d, length, item, at in shard.longest(place, window):
        out[d] |= dict(longest=length, longest_item=tests.names[item], longest_at=at)
    # Documents that hit the same windows share one list of items.
    doc, lists = doc_of(place), {}
    order = np.argsort(doc, kind="stable")
    for hits in np.split(order, np.flatnonzero(np.diff(doc[order])) + 1):
        windows = np.unique(window[hits])
        key = windows.tobytes()
        if key not in lists:
            found = np.unique(np.concatenate([tests.items[w] for w in windows]))
            lists[key] = sorted({tests.names[i] for i in found.tolist()})
        out[doc[hits[0]]]["items"] = lists[key]
    return out


def joined(a: dict, b: dict) -> dict:
    """What two blocks found in one document."""
    hits: list[dict] = []
    for h in sorted(a["hits"] + b["hits"], key=lambda h: (h["start"], h["end"])):
        if hits and h["start"] <= hits[-1]["end"]:
            hits[-1] = {"start": hits[-1]["start"], "end": max(hits[-1]["end"], h["end"])}
        else:
            hits.append(h)
    return max((a, b), key=lambda x: x["longest"]) | {"hits": hits, "items": sorted({*a["items"], *b["items"]})}


def find_contamination(docs: DataFrame, benchmark: DataFrame, into: str = "contamination",
                       window: int = WINDOW, block_words: int = BLOCK_WORDS) -> DataFrame:
    """``docs`` plus the struct ``into``: word count, covered word spans, items found, the
    longest verbatim match with its item and place."""
    spark = docs.sparkSession
    items = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item_id"),
                             F.coalesce("text", F.lit("")).alias("text"))
    # A text of b bytes has at most (b + 1) / 2 words.
    most = items.agg(F.sum((F.octet_length("text") + 1) / 2)).first()[0] or 0
    n_blocks = max(1, -(-int(most) // block_words))
    out, staging = docs.drop(into), Staging(spark, "decontaminate")
    for block in range(n_blocks):
        rows = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n_blocks)) == block).distinct().collect()
        held = spark.sparkContext.broadcast(TestSuffixes([(r.item_id, r.text.encode()) for r in rows], window))
        out = _pass(out, held, into)
        if block + 1 < n_blocks:
            out = staging.put(f"block{block}", out)
            held.unpersist()
            if block:
                staging.drop(f"block{block - 1}")
    return out


def _pass(docs: DataFrame, held, into: str) -> DataFrame:
    kept = [f for f in docs.schema if f.name != into]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept) + f", `{into}` {STATE_SQL}"

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            found = scan(binary(part.column("text")).to_pylist(), held.value)
            if into in part.schema.names:
                found = [joined(a, b) for a, b in zip(part.column(into).to_pylist(), found)]
            yield pa.RecordBatch.from_arrays([*(part.column(f.name) for f in kept), pa.array(found, STATE)],
                                             [*(f.name for f in kept), into])

    return docs.mapInArrow(work, schema)


def digests(docs: DataFrame, benchmark: DataFrame, **settings) -> DataFrame:
    """Counts by document, the items found as a SHA-256, and the longest match."""
    c = F.col("contamination")
    n_hit = F.aggregate(c["hits"], F.lit(0).cast("long"), lambda a, h: a + h["end"] - h["start"])
    return find_contamination(docs.select("doc_id", "text"), benchmark, **settings).select(
        "doc_id", c["n_words"].alias("n_words"), n_hit.alias("n_hit"),
        F.size(c["items"]).cast("long").alias("n_items"),
        F.sha2(F.array_join(c["items"], ","), 256).alias("items_sha256"),
        (F.size(c["hits"]) > 0).alias("contaminated"))


def remove_contaminated(docs: DataFrame, benchmark: DataFrame, **settings) -> DataFrame:
    """``docs`` without the documents that hold a test window."""
    return (find_contamination(docs, benchmark, "decontaminate__found", **settings)
            .where(F.size(F.col("decontaminate__found.hits")) == 0).select(*(F.col(f"`{c}`") for c in docs.columns)))


DIGEST_SQL = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
i AS (
  SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item_id, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
iw AS (
  SELECT DISTINCT item_id, k, array_to_string(w[q:q + k - 1], ' ') AS g
  FROM (SELECT item_id, w, least(10, len(w)) AS k, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS q
        FROM i WHERE len(w) > 0)),
dw AS (
  SELECT doc_id, p, k, array_to_string(w[p:p + k - 1], ' ') AS g
  FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS p
        FROM d, (SELECT DISTINCT k FROM iw) WHERE len(w) >= k)),
h AS (SELECT DISTINCT doc_id, p, k, item_id FROM dw JOIN iw USING (k, g)),
c AS (SELECT doc_id, count(DISTINCT x) AS n_hit
      FROM (SELECT doc_id, unnest(range(p, p + k)) AS x FROM h) GROUP BY doc_id),
m AS (SELECT doc_id, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT item_id, ',' ORDER BY item_id) AS items
      FROM h GROUP BY doc_id)
SELECT d.doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN c USING (doc_id) LEFT JOIN m USING (doc_id)"""
