"""Thousands of needles at once (F9, F10): one automaton instead of one test for each.

``functions.predicates.contains_any`` evaluates a test per needle and row, which is right
for a few.  Here the needles become one Aho-Corasick automaton per task, and a text is
walked once however many there are.  The needles are collected and broadcast, so their
number and bytes are bounded (``MAX_NEEDLES``, ``MAX_BYTES``); the texts are not.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

MAX_NEEDLES, MAX_BYTES = 1_000_000, 64 << 20


def bounded(needles: DataFrame | Iterable[str]) -> list[str]:
    """The different needles, nulls left out; more than the bounds allow are an error."""
    if isinstance(needles, DataFrame):
        column = needles.columns[0]
        needles = (r[0] for r in needles.select(column).where(f"`{column}` IS NOT NULL").distinct().limit(MAX_NEEDLES + 1).collect())
    out = sorted({n for n in needles if n is not None})
    if len(out) > MAX_NEEDLES or sum(len(n.encode()) for n in out) > MAX_BYTES:
        raise ValueError("too many needles for one automaton; join by words instead")
    return out


def find_needles(df: DataFrame, text: str, needles: DataFrame | Iterable[str], into: str = "needles") -> DataFrame:
    """``df`` plus ``into``: the different needles that ``text`` contains, sorted; NULL for a NULL text.

    Case counts, needles may overlap, and the empty needle is in every text, as with ``contains``.
    """
    known = df.sparkSession.sparkContext.broadcast(bounded(needles))
    kept = df.drop(into)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema) + f", `{into}` array<string>"

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import ahocorasick

        automaton, everywhere = ahocorasick.Automaton(), [n for n in known.value if not n]
        for needle in known.value:
            if needle:
                automaton.add_word(needle, needle)
        automaton.make_automaton()

        def found(value: str | None) -> list[str] | None:
            if value is None:
                return None
            return sorted({*everywhere, *(n for _, n in automaton.iter(value))} if len(automaton) else everywhere)

        for batch in batches:
            column = batch.column(text)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array([found(x.as_py()) for x in column], pa.list_(pa.string()))],
                [*batch.schema.names, into])

    return kept.mapInArrow(work, schema)
