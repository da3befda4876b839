"""Fuzzy short-notice search for licence texts.

A notice of m bytes with at most k edits, cut into k + 1 pieces, contains at
least one piece unchanged (pigeonhole principle).  So the exact places of the
pieces locate all candidates; around each one, the ``regex`` library's
bounded-error matching verifies the edits and gives the span.  Nothing else is
compared, so the cost is a few substring searches per notice.

Texts are compared in a canonical form: A-Z in lower case, words of letters,
digits and all non-ASCII characters, joined by single blanks.

Defined results for odd input: a null or empty text has no words, no labels,
score 0 and null positions; repeated rows are scanned each on their own;
further columns are ignored; a text of any length is scanned whole.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import lru_cache
from heapq import heappop, heappush

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablekit.llm.common import binary, slices


@dataclass(frozen=True)
class Notice:
    """A short notice in canonical form and the edits (in bytes) that are allowed."""

    label: str
    words: str
    edits: int


#: Exact phrases and their labels (fixed values).
PHRASES = (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"))

#: Notices of the fuzzy search; about one edit for each ten characters.
NOTICES = (
    Notice("apache", "licensed under the apache license version", 4),
    Notice("bsd", "redistribution and use in source and binary forms", 4),
    Notice("cc-by", "licensed under a creative commons attribution", 4),
    Notice("cc-by-nc", "licensed under cc by nc", 2),
    Notice("gpl", "licensed under the gnu general public license", 4),
    Notice("mit", "released under the mit license", 3),
    Notice("mit", "permission is hereby granted free of charge to any person", 5),
    Notice("mpl", "subject to the terms of the mozilla public license", 5),
    Notice("public-domain", "free and unencumbered software released into the public domain", 6),
)

SCHEMA = ("n_words long, n_base long, first_word long, last_word long, base_labels string, "
          "labels string, score double, "
          "spans array<struct<label:string,first_word:long,last_word:long,edits:int>>")

#: Bytes that are not part of a word become blanks, A-Z lower case; all others stay.
CANONICAL = bytes(
    c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32
    for c in range(256))


def canonical(text: bytes) -> tuple[bytes, int]:
    """`` w1 w2 ... wn `` (blanks at both ends) and n."""
    words = text.translate(CANONICAL).split()
    return b" %s " % b" ".join(words) if words else b" ", len(words)


def pieces(notice: bytes, k: int) -> list[tuple[int, bytes]]:
    """k + 1 pieces of nearly equal length with their offsets."""
    cuts = [len(notice) * i // (k + 1) for i in range(k + 2)]
    return [(a, notice[a:b]) for a, b in zip(cuts, cuts[1:])]


@lru_cache(maxsize=64)
def fuzzy(words: str, edits: int) -> regex.Pattern:
    return regex.compile(rb"(?b)(?:%s){e<=%d}" % (regex.escape(words.encode()), edits))


def places(text: bytes, needle: bytes) -> Iterator[int]:
    at = text.find(needle)
    while at >= 0:
        yield at
        at = text.find(needle, at + 1)


def candidates(text: bytes, notice: Notice) -> list[tuple[int, int]]:
    """Windows of ``text``, each as long as a match at most, one of which contains every match of the notice."""
    words, k = notice.words.encode(), notice.edits
    return sorted({(max(0, at - offset - k), min(len(text), at - offset + len(words) + k))
                   for offset, piece in pieces(words, k) for at in places(text, piece)})


class Taken:
    """Spans that do not overlap, in order."""

    def __init__(self):
        self.starts, self.ends = [], []

    def add(self, start: int, end: int) -> None:
        at = bisect_right(self.starts, start)
        self.starts.insert(at, start)
        self.ends.insert(at, end)

    def free(self, start: int, end: int) -> list[tuple[int, int]]:
        """What is left of a window."""
        at, out = bisect_right(self.ends, start), []
        while at < len(self.starts) and self.starts[at] < end:
            if start < self.starts[at]:
                out.append((start, self.starts[at]))
            start = max(start, self.ends[at])
            at += 1
        return out + [(start, end)] if start < end else out


def fuzzy_matches(text: bytes, notices: Sequence[Notice]) -> list[tuple[int, int, int, Notice]]:
    """(start, end, edits, notice) of the verified matches, by notice and position.

    The match with the fewest edits of all windows is taken first (the leftmost of several);
    windows that it overlaps are searched again in what is left of them, so matches of one
    notice never overlap.  A window is no longer than a match and is cut by the few matches
    around it only, so the cost follows the number of windows, however dense they are.
    """
    out = []
    for notice in notices:
        pattern, heap, taken = fuzzy(notice.words, notice.edits), [], Taken()

        def search(a: int, b: int) -> None:
            if b - a >= len(notice.words.encode()) - notice.edits and (m := pattern.search(text, a, b)):
                heappush(heap, (sum(m.fuzzy_counts), m.start(), m.end(), a, b))

        for a, b in candidates(text, notice):
            search(a, b)
        while heap:
            edits, start, end, a, b = heappop(heap)
            left = taken.free(a, b)
            if any(x <= start and end <= y for x, y in left):
                taken.add(start, end)
                out.append((start, end, edits, notice))
                left = taken.free(a, b)
            for x, y in left:
                search(x, y)
    return out


def scan(text: bytes, notices: Sequence[Notice] = NOTICES,
         phrases: Sequence[tuple[str, str]] = PHRASES) -> tuple:
    """The values of SCHEMA for one text."""
    canon, n_words = canonical(text)
    base, labels, at_bytes = set(), set(), []
    for phrase, label in phrases:
        if found := list(places(canon, b" %s " % phrase.encode())):
            base.add(label)
            at_bytes += found
    spans, best, matches = [], 1.0 if base else 0.0, fuzzy_matches(canon, notices)
    blanks = np.flatnonzero(np.frombuffer(canon, np.uint8) == 32) if matches else None
    for start, end, edits, notice in matches:
        labels.add(notice.label)
        best = max(best, 1.0 - edits / len(notice.words))
        body = canon[start:end]
        lead, tail = start + len(body) - len(body.lstrip()), end - len(body) + len(body.rstrip())
        first, last = np.searchsorted(blanks, [lead + 1, tail]) - 1
        spans.append((notice.label, int(first), int(last), edits))
    spans.sort()
    at = [canon.count(b" ", 0, x) for x in (min(at_bytes), max(at_bytes))] if at_bytes else [None, None]
    return (n_words, len(at_bytes), *at, ",".join(sorted(base)), ",".join(sorted(base | labels)), best,
            [dict(zip(("label", "first_word", "last_word", "edits"), s)) for s in spans])


def scan_licenses(docs: DataFrame, notices: Sequence[Notice] = NOTICES,
                  phrases: Sequence[tuple[str, str]] = PHRASES) -> DataFrame:
    """One row per document: doc_id and the columns of SCHEMA."""
    source = docs.select("doc_id", "text")
    schema = f"doc_id {source.schema['doc_id'].dataType.simpleString()}, {SCHEMA}"
    names = ["n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "spans"]
    kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64(), pa.list_(pa.struct(
        [("label", pa.string()), ("first_word", pa.int64()), ("last_word", pa.int64()), ("edits", pa.int32())]))]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            rows = [scan(x, notices, phrases) for x in binary(part.column("text")).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), *(pa.array(c, k) for c, k in zip(zip(*rows), kinds))],
                ["doc_id", *names])

    return source.select(F.col("doc_id"), F.col("text")).mapInArrow(work, schema)
