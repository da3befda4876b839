"""Substring removal by word windows with a count-min prefilter.

A word goes if a window of 50 words that covers it also starts in a document with a
smaller id.  Every partition sketches its windows (by their families' anchors, see
``windows``); the merged count-min sketch overestimates how often each occurs.  A
second pass groups the windows estimated as repeated by a cryptographic hash of their
words, whole families first, single windows where contents differ; so none is lost, and
none is removed whose words differ.

Defined results for odd input: a null text has no words; a document without an id is
neither removed from nor a source (no id is smaller); rows with the same id are not
each other's source; texts under 50 words stay; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablekit.llm import repeats
from tablekit.llm.common import Staging, binary, slices

WINDOW, GRAM = 50, 8


def removed_runs(docs: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """(doc_id, ver, runs): the word runs to remove, by document."""
    plan, staging = repeats.Plan(window, gram, of_words=True), Staging(docs.sparkSession, "substring-dedup")
    known = docs.select("doc_id", "text").where(F.col("doc_id").isNotNull())
    fams = staging.put("families", repeats.candidate_families(known, plan, repeats.estimated(known, plan)))
    found = staging.put("classes", repeats.classes(fams))
    whole = repeats.same_content(fams, found, "first").where("doc_id > first").select(
        "doc_id", "ver", F.col("low").alias("start"), (F.col("high") + window).alias("stop"))
    several = found.where("variants > 1")
    places = repeats.open_places(several, "first", several.count())
    seen = staging.put("windows", repeats.windows_at(known, plan, places, "doc_id"))
    least = seen.groupBy("a", "b").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last"))
    least = least.where("first < last").select(F.col("a").alias("x"), F.col("b").alias("y"), "first")
    single = seen.join(least, (F.col("a") == F.col("x")) & (F.col("b") == F.col("y")) & (
        F.col("doc_id") > F.col("first"))).select(
        "doc_id", "ver", F.col("at").alias("start"), (F.col("at") + window).alias("stop"))
    out = staging.put("runs", repeats.runs_by_document(whole.union(single)))
    staging.drop("families", "classes", "windows")
    return out


def remove_repeats(docs: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """(doc_id, n_words, n_removed, kept): ``kept`` is the remaining words joined by blanks."""
    rows = repeats.with_runs(docs, removed_runs(docs, window, gram))
    kind = docs.schema["doc_id"].dataType.simpleString()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            out = []
            for text, runs in zip(binary(part.column("text")).to_pylist(), part.column("runs").to_pylist()):
                words = text.split()
                n, kept, at = len(words), [], 0
                for start, stop in repeats.merged_runs(runs):
                    kept += words[at:start]
                    at = stop
                kept += words[at:]
                out.append((n, n - len(kept), b" ".join(kept)))
            n, gone, kept = zip(*out)
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array(n, pa.int64()), pa.array(gone, pa.int64()), pa.array(kept, pa.binary())],
                ["doc_id", "n_words", "n_removed", "kept"])

    return rows.mapInArrow(work, f"doc_id {kind}, n_words long, n_removed long, kept binary")


def digests(docs: DataFrame) -> DataFrame:
    return remove_repeats(docs).select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


DIGEST_SQL = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
p AS (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM d WHERE len(w) >= 50),
g AS (SELECT doc_id, i, array_to_string(w[i:i + 49], ' ') AS g FROM p),
f AS (SELECT g, min(doc_id) AS first FROM g GROUP BY g HAVING min(doc_id) < max(doc_id)),
r AS (SELECT DISTINCT doc_id, x FROM (
  SELECT doc_id, unnest(range(i, i + 50)) AS x FROM g JOIN f USING (g) WHERE doc_id > first)),
c AS (SELECT doc_id, count(*) AS n_removed, list(x) AS gone FROM r GROUP BY doc_id),
k AS (
  SELECT d.doc_id, w, coalesce(n_removed, 0) AS n_removed, coalesce(gone, []) AS gone FROM d LEFT JOIN c USING (doc_id)),
u AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS x FROM d),
t AS (SELECT u.doc_id, string_agg(word, ' ' ORDER BY u.x) AS kept
      FROM u ANTI JOIN r ON u.doc_id = r.doc_id AND u.x = r.x GROUP BY u.doc_id)
SELECT k.doc_id, len(w) AS n_words, n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM k LEFT JOIN t USING (doc_id)"""
