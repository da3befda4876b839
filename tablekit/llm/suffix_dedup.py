"""Removing repeated byte strings by refining the order of suffixes.

A byte goes if a string of 200 bytes that covers it also starts anywhere else.

``repeats`` settles what repeats as a whole and leaves, for each anchor that occurs in
different contents, every content once.  Those go to buckets by anchor (equal strings
have equal anchors), and in a bucket the suffixes of all contents are put into blocks by
their first 8 bytes, then 16, 32, 64, 128 and 200: a block by 2h bytes is a block by h
bytes whose suffixes also share the block h bytes on, so no suffixes are compared.  A
block with one suffix is finished and leaves; one that lasts to 200 bytes is a repeated
interval.

No Burrows-Wheeler transform is kept per shard and merged, the method this operator is
named after; the README says why, with figures.

An anchor with very many different contents (``HOT`` or more) would make one large
bucket; its windows are counted by the hash of their bytes instead, as aggregates.

Defined results for odd input: a null text has no bytes; rows without an id, with
the same id or the same text are all occurrences of their own; texts under 200
bytes stay; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablekit.llm import repeats
from tablekit.llm.common import Staging, binary, slices

#: Bytes in a window, in an anchor gram, and by which suffixes are first put into blocks.
WINDOW, GRAM, STEP = 200, 48, 8
#: Contents in a bucket; contents of one anchor from which its windows are counted by hash.
BUCKET, HOT = 3000, 20_000


def first_symbols(data: np.ndarray) -> np.ndarray:
    """The STEP bytes that start at each place as one number, first byte highest."""
    n = max(0, len(data) - STEP + 1)
    out = np.zeros(len(data), np.uint64)
    for k in range(STEP):
        out[:n] = (out[:n] << np.uint64(8)) | data[k:k + n]
    return out


def blocks_of_several(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(which, block): the keys that occur more than once, by key, and their blocks from 1 on."""
    order = np.argsort(keys)
    keys = keys[order]
    new = np.append(True, keys[1:] != keys[:-1]) if len(keys) else np.zeros(0, bool)
    shared = ~(new & np.append(new[1:], True)) if len(keys) else new
    return order[shared], np.cumsum(new & shared)[shared]


def refine(data: np.ndarray, borders: np.ndarray, window: int) -> np.ndarray:
    """The places whose next ``window`` bytes, inside one string, also start at another place.

    ``borders`` (n + 1 places) cut the strings.  ``block`` holds each place's block by the
    bytes seen so far, 0 once it is alone or has too few bytes left.
    """
    room = np.repeat(borders[1:], np.diff(borders)) - np.arange(len(data))
    places = np.flatnonzero(room >= STEP)
    which, found = blocks_of_several(first_symbols(data)[places])
    seen = STEP
    while True:
        block = np.zeros(len(data) + window, np.int64)
        block[places[which]] = found
        if seen == window:
            return np.sort(places[which])
        step = min(seen, window - seen)
        places = np.sort(places[which])
        # In a block with others now and ``step`` bytes on, and enough bytes left for that.
        places = places[(block[places + step] > 0) & (room[places] >= seen + step)]
        which, found = blocks_of_several(block[places] << 32 | block[places + step])
        seen += step


def repeated_starts(strings: list[bytes], window: int = WINDOW) -> list[np.ndarray]:
    """For each string, the starts of its windows that occur at another place of any string."""
    borders = np.cumsum([0, *map(len, strings)])
    places = refine(np.frombuffer(b"".join(strings), np.uint8), borders, window)
    cut = np.searchsorted(places, borders)
    return [places[a:b] - o for a, b, o in zip(cut, cut[1:], borders)]


def contents_at(docs: DataFrame, plan: repeats.Plan, places, n_buckets: int) -> DataFrame:
    """(bucket, doc_id, ver, low, bytes): what the families in ``places`` cover, each content once."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def rows_of(part, spelling, borders, found, row, ver, content):
        return pa.RecordBatch.from_arrays(
            [pa.array((found.core % np.uint64(n_buckets)).astype(np.int32)), *(pa.array(x.view(np.int64)) for x in (found.core, *content)),
             part.column("doc_id").take(pa.array(row)), pa.array(ver[row].view(np.int64)),
             pa.array((found.low - borders[row]).astype(np.int32)),
             pa.array(list(spelling.cut(found.low, found.high + plan.length)), pa.binary())],
            ["bucket", "core", "content", "content2", "doc_id", "ver", "low", "bytes"])

    rows = repeats.looked_at(docs, plan, places, "place", "bucket int, core long, content long, content2 long, "
                             f"doc_id {kind}, ver long, low int, bytes binary", rows_of)
    # Rows with one id and text are one place: their contents would come once for each row.
    one = rows.groupBy("core", "content", "content2").agg(F.any_value(F.struct("bucket", "doc_id", "ver", "low", "bytes")).alias("one"))
    return one.select("one.*")


def _bucket_runs(window: int):
    """Runs of repeated windows of a bucket's contents."""
    def work(table: pa.Table) -> pa.Table:
        contents = table.column("bytes").to_pylist()
        row, start, stop = [], [], []
        for k, (at, low) in enumerate(zip(repeated_starts(contents, window), table.column("low").to_pylist())):
            if len(at):
                first = np.flatnonzero(np.append(True, at[1:] != at[:-1] + 1))
                row += [k] * len(first)
                start += (at[first] + low).tolist()
                stop += (at[np.append(first[1:], len(at)) - 1] + low + window).tolist()
        row = pa.array(row, pa.int64())
        return pa.table({"doc_id": table.column("doc_id").take(row), "ver": table.column("ver").take(row),
                         "start": pa.array(start, pa.int32()), "stop": pa.array(stop, pa.int32())})
    return work


def removed_runs(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, hot: int = HOT,
                 bucket: int = BUCKET) -> DataFrame:
    """(doc_id, ver, runs): the byte runs to remove, by document."""
    if window < STEP:
        raise ValueError(f"the window must be at least {STEP} bytes")
    plan, staging = repeats.Plan(window, gram, of_words=False), Staging(docs.sparkSession, "suffix-dedup")
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, ver long, start int, stop int"
    fams = staging.put("families", repeats.candidate_families(docs, plan, repeats.estimated(docs, plan)))
    found = staging.put("classes", repeats.classes(fams))
    whole = repeats.same_content(fams, found.where("n > 1")).select(
        "doc_id", "ver", F.col("low").alias("start"), (F.col("high") + window).alias("stop"))
    runs = [whole]
    # Contents that occur once have to be compared with the others around the same anchor.
    counts = found.agg(F.count_if((F.col("variants") > 1) & (F.col("variants") < hot)).alias("cool"),
                       F.count_if(F.col("variants") >= hot).alias("hot")).first()
    if counts.cool:
        places = repeats.open_places(found.where((F.col("variants") > 1) & (F.col("variants") < hot)), "place", counts.cool)
        contents = contents_at(docs, plan, places, max(1, -(-counts.cool // bucket)))
        runs.append(contents.groupBy("bucket").applyInArrow(_bucket_runs(window), schema))
    if counts.hot:
        places = repeats.open_places(found.where(F.col("variants") >= hot), "place", counts.hot)
        seen = staging.put("windows", repeats.windows_at(docs, plan, places, "place"))
        often = seen.groupBy("a", "b").count().where("count > 1").select(F.col("a").alias("x"), F.col("b").alias("y"))
        runs.append(seen.join(often, (F.col("a") == F.col("x")) & (F.col("b") == F.col("y"))).select(
            "doc_id", "ver", F.col("at").alias("start"), (F.col("at") + window).alias("stop")))
    every = runs[0]
    for more in runs[1:]:
        every = every.union(more)
    out = staging.put("runs", repeats.runs_by_document(every))
    staging.drop("families", "classes", *(["windows"] if counts.hot else []))
    return out


def remove_repeats(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, hot: int = HOT) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept): ``kept`` is the remaining bytes."""
    rows = repeats.with_runs(docs, removed_runs(docs, window, gram, hot))
    kind = docs.schema["doc_id"].dataType.simpleString()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            n, gone, spans, left = [], [], [], []
            for text, found in zip(binary(part.column("text")).to_pylist(), part.column("runs").to_pylist()):
                runs = repeats.merged_runs(found)
                stops = [0, *(b for _, b in runs)]
                kept = b"".join(text[a:b] for a, b in zip(stops, [*(a for a, _ in runs), len(text)]))
                n.append(len(text))
                gone.append(len(text) - len(kept))
                spans.append(len(runs))
                left.append(kept)
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), *(pa.array(x, pa.int64()) for x in (n, gone, spans)), pa.array(left, pa.binary())],
                ["doc_id", "n_bytes", "n_removed", "n_spans", "kept"])

    return rows.mapInArrow(work, f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept binary")


def digests(docs: DataFrame) -> DataFrame:
    return remove_repeats(docs).select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
