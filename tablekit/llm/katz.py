"""Katz backoff language model: discounted n-gram counts in partitioned tables.

    P(w | h) = d(c) c(hw) / c(h)         if hw occurs in the training documents
             = alpha(h) P(w | h')        else, h' being h without its first word

d is the Good-Turing discount of counts up to ``CUT`` and 1 above; alpha(h) is the mass
that the discounts leave, divided by one minus the shorter model's mass of the words seen
after h, so that every distribution sums to one exactly.  A history without a discounted
count keeps 1 / (c(h) + 1) for unseen words.  The shortest model gives its left mass to
one class of unknown words.

Documents become blocks of numbered words.  At each order a block sends its distinct
n-grams (keys of history and word, training count, the shorter model's probability) to
partitions by history.  A partition adds up what it receives into its table and answers
every block with the counts and sums of what that block asked for (``level{n}``, one table
per order).  With the answers of orders 1..n a block evaluates P recursively for each of
its tokens.  All tasks hold one block or one partition, whose number follows the bytes of
the input.  Histories with over N / ``HEAVY`` tokens (fewer than ``HEAVY`` exist) are spread
over all partitions by word, their sums are added up and broadcast.

Words are told apart by 64-bit hashes: among n distinct ones about n^2 / 2^65 pairs share
one and would share a count, none expected up to 10^9 of them.  Longer histories are told
apart exactly, by the numbers that the tables give their n-grams.  What blocks and parts
send is compressed byte plane by byte plane, sorted numbers as differences.

Defined results for odd input: a null or empty text is the end token alone; rows without
an id are not held out; repeated rows count as often as they occur; without any training
token every probability is 1; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablekit.llm.common import Staging, binary, slices
from tablekit.llm.windows import mixed

#: Counts up to this are discounted.
CUT = 5
#: Bytes of text in a block and to a partition of a level.
BLOCK_BYTES, PART_BYTES = 8 << 20, 8 << 20
#: A history is heavy if more than one in so many training tokens follow it.
HEAVY = 1024
#: Local numbers of the start (before the first word) and of the end token.
START, END = 0, 1
_SPACE = re.compile(rb"[\x20\x09-\x0D]")


def packed(values: np.ndarray) -> bytes:
    """Fixed-width numbers, compressed byte plane by byte plane."""
    values = np.ascontiguousarray(values)
    planes = values.view(np.uint8).reshape(-1, values.itemsize).T
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def unpacked(data: bytes, kind: str) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    return np.ascontiguousarray(planes.reshape(np.dtype(kind).itemsize, -1).T).view(kind).reshape(-1)


def rising(values: np.ndarray) -> bytes:
    """Sorted numbers as their differences."""
    return packed(np.diff(values.astype("<u8"), prepend=np.uint64(0)))


def risen(data: bytes) -> np.ndarray:
    return np.cumsum(unpacked(data, "<u8"), dtype=np.uint64)


def words(text: bytes, piece: int = 1 << 20) -> Iterator[list[bytes]]:
    """The lower-cased words of a text, piece by piece."""
    at = 0
    while at < len(text):
        cut = _SPACE.search(text, at + piece)
        stop = cut.start() if cut else len(text)
        yield text[at:stop].lower().split()
        at = stop


class Numbers(dict):
    """Words by order of appearance in a block, from 2 on."""

    def __missing__(self, word: bytes) -> int:
        self[word] = out = len(self) + 2
        return out


def blocks(docs: DataFrame, block_bytes: int) -> DataFrame:
    """One row for each block: its documents, the hashes of its words, and its tokens by number."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId() << 32
        for part in slices(batches, "text", block_bytes):
            number, tokens, ends, n = Numbers(), [], [], 0
            for text in binary(part.column("text")):
                for some in words(text.as_py()):
                    tokens.append(np.fromiter(map(number.__getitem__, some), np.int32, len(some)))
                    n += len(some)
                tokens.append(np.full(1, END, np.int32))
                n += 1
                ends.append(n)
            held = part.column("held_out").to_numpy(zero_copy_only=False).astype(bool)
            keys = np.array([0, 1, *map(xxhash.xxh3_64_intdigest, number)], np.uint64)
            yield pa.RecordBatch.from_arrays(
                [pa.array([block]), pa.array([part.column("doc_id").to_pylist()], pa.list_(part.column("doc_id").type)),
                 pa.array([held.tolist()]), pa.array([packed(keys)]), pa.array([packed(np.concatenate(tokens))]),
                 pa.array([int(np.diff(ends, prepend=0)[~held].sum())])],
                ["block", "doc_ids", "held", "words", "tokens", "n_train"])
            block += 1

    return docs.mapInArrow(work, f"block long, doc_ids array<{kind}>, held array<boolean>, words binary, tokens binary, n_train long")


@dataclass
class Level:
    """What is known of the n-grams of one order besides their tables.

    ``heavy`` are the spread histories, sorted, with their ``totals`` (tokens), ``lower``
    (the shorter model's mass of the seen words) and ``left`` (mass of the discounts, in
    tokens); ``discount`` is d by count, from 0 to CUT.
    """

    order: int
    parts: int
    heavy: np.ndarray
    discount: np.ndarray = field(default_factory=lambda: np.ones(CUT + 1))
    totals: np.ndarray | None = None
    lower: np.ndarray | None = None
    left: np.ndarray | None = None

    def part(self, history: np.ndarray, word: np.ndarray) -> np.ndarray:
        at = np.minimum(np.searchsorted(self.heavy, history), len(self.heavy) - 1)
        spread = np.where(self.heavy[at] == history, ~mixed(word), history)
        return (mixed(spread) % np.uint64(self.parts)).astype(np.uint32)


class Block:
    """A block's tokens, and its n-grams order by order."""

    def __init__(self, row: dict):
        self.number = row["block"]
        self.tokens = unpacked(row["tokens"], "<i4")
        self.words = unpacked(row["words"], "<u8")
        end = np.flatnonzero(self.tokens == END)
        self.first = np.concatenate([[0], end[:-1] + 1])
        self.length = np.diff(np.concatenate([self.first, [len(self.tokens)]]))
        self.held = np.array(row["held"], bool)
        self.train = np.repeat(~self.held, self.length)
        self.history = self.word = None

    def advance(self, level: Level, numbers: np.ndarray) -> None:
        """The next order's histories: the n-gram that ends before each token; 0 at a text's start."""
        if level.order == 1:
            self.word = numbers         # from now on words go by their numbers, too
        self.history = np.append(np.uint64(0), numbers[:-1])
        self.history[self.first] = 0


def sorted_by(*columns: np.ndarray) -> np.ndarray:
    """The order by several columns of unsigned numbers, the first one above all; in one sort if one number holds them."""
    columns = [c for c in columns if len(c) and c.max() != c.min()] or list(columns[:1])
    spans = [int(c.max()) + 1 if len(c) else 1 for c in columns]
    if len(columns) > 1 and math.prod(spans) >= 1 << 64:
        return np.lexsort(columns[::-1])
    key = columns[0].astype(np.uint64)
    for c, span in zip(columns[1:], spans[1:]):
        key = key * np.uint64(span) + c.astype(np.uint64)
    return np.argsort(key)


class Grams:
    """The distinct n-grams of a block in the order in which they are sent: part, history, word."""

    def __init__(self, block: Block, level: Level):
        self.level = level
        if level.order == 1:    # the block's words are numbered already, from END on
            history, word, which = np.zeros(len(block.words) - END, np.uint64), block.words[END:], block.tokens - END
        else:
            history, word, which = block.history, block.word, None
        part = level.part(history, word)
        order = sorted_by(part, history, word)
        part, history, word = part[order], history[order], word[order]
        differs = lambda x: np.append(True, x[1:] != x[:-1])
        run = differs(part) | differs(history)
        new = run | differs(word)
        self.first = None if which is not None else order[new]  # a token of each n-gram
        self.part, self.history, self.word = part[new], history[new], word[new]
        place = np.empty(len(order), np.int64)
        place[order] = np.cumsum(new) - 1
        self.which = place if which is None else place[which]   # each token's n-gram
        self.count = np.bincount(self.which[block.train], minlength=len(self.part))
        # Runs of equal history inside a part.
        self.run, self.run_of = np.flatnonzero(run[new]), np.cumsum(run[new]) - 1

    def messages(self, block: int, lower: np.ndarray | None) -> Iterator[dict]:
        """What the block sends to each part; ``lower`` is the shorter model's probability by token."""
        lower = np.zeros(len(self.part)) if lower is None else lower[self.first]
        sizes = np.diff(np.append(self.run, len(self.part)))
        cuts = np.flatnonzero(np.append(True, self.part[1:] != self.part[:-1]))
        for a, b in zip(cuts, np.append(cuts[1:], len(self.part))):
            some = slice(*np.searchsorted(self.run, [a, b]))
            values, index = np.unique(lower[a:b], return_inverse=True)
            yield {"part": int(self.part[a]), "block": block, "histories": rising(self.history[self.run[some]]),
                   "sizes": packed(sizes[some].astype("<u4")), "words": packed(self.word[a:b]),
                   "counts": packed(self.count[a:b].astype("<u4")), "values": packed(values), "lower": packed(index.astype("<u4"))}

    def probability(self, answers: list[dict], lower: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
        """(count, probability) by token; ``answers`` in order of their parts."""
        level = self.level
        count, total = (np.concatenate([unpacked(x[c], "<i8") for x in answers]) for c in ("counts", "totals"))
        few = np.concatenate([unpacked(x["few"], "<u4").reshape(CUT, -1).T for x in answers])
        left = few @ ((1 - level.discount[1:]) * np.arange(1, CUT + 1))
        mass = np.zeros(len(total))
        mass[_asked(count, total, self.run_of)] = np.concatenate([unpacked(x["masses"], "<f8") for x in answers])
        history = self.history[self.run]
        heavy = np.minimum(np.searchsorted(level.heavy, history), len(level.heavy) - 1)
        spread = level.heavy[heavy] == history
        total = np.where(spread, level.totals[heavy], total)
        mass, left = np.where(spread, level.lower[heavy], mass), np.where(spread, level.left[heavy], left)
        whole = left <= 0                                       # nothing is discounted after this history
        over, left = total + whole, np.where(whole, 1.0, left)
        alpha = np.where(total > 0, left / over / (1 - mass), 1.0)
        shorter = np.ones(len(count)) if lower is None else lower[self.first]
        seen = np.where(count > CUT, count, count * level.discount[np.minimum(count, CUT)]) / over[self.run_of]
        p = np.where(count > 0, seen, alpha[self.run_of] * shorter)
        return count[self.which], p[self.which]

    def numbers(self, answers: list[dict]) -> np.ndarray:
        """The number of each token's n-gram in the tables."""
        rank = np.concatenate([risen(x["ranks"]) for x in answers])
        return gram_number(rank, self.part.astype(np.uint64), self.level.parts)[self.which]


def gram_number(rank: np.ndarray, part, parts: int) -> np.ndarray:
    """From 1 on; 0 is the history at a text's start."""
    return rank * np.uint64(parts) + part + np.uint64(1)


def _asked(count: np.ndarray, total: np.ndarray, run_of: np.ndarray) -> np.ndarray:
    """The runs whose history has an unseen word: only they need the shorter model's mass."""
    unseen = np.zeros(len(total), bool)
    unseen[run_of[count == 0]] = True
    return unseen & (total > 0)


MESSAGE = "part int, block long, histories binary, sizes binary, words binary, counts binary, values binary, lower binary"
#: Rows of a level: answers (block >= 0), sums of heavy histories (-1), one row of statistics for each part (-2).
LEVEL = ("block long, part int, counts binary, totals binary, masses binary, few binary, ranks binary, "
         "history long, total long, mass double, numbers array<long>, heavy array<long>")
HEAVY_ROW, STATISTICS = -1, -2


def _rows(rows: list[dict], schema: pa.Schema) -> pa.Table:
    return pa.Table.from_pylist(rows, schema)


_MESSAGE = pa.schema([("part", pa.int32()), ("block", pa.int64()),
                      *((c, pa.binary()) for c in ("histories", "sizes", "words", "counts", "values", "lower"))])
_LEVEL = pa.schema([("block", pa.int64()), ("part", pa.int32()), *((c, pa.binary()) for c in ("counts", "totals", "masses", "few", "ranks")),
                    ("history", pa.int64()), ("total", pa.int64()), ("mass", pa.float64()),
                    ("numbers", pa.list_(pa.int64())), ("heavy", pa.list_(pa.int64()))])


def merged(table: pa.Table, level: Level, bound: float, last: bool) -> pa.Table:
    """A part's table from all blocks' messages, and the answer to each of them.

    ``bound``: n-grams with more tokens are the heavy histories of the next order.
    """
    got = sorted(table.to_pylist(), key=lambda x: x["block"])
    histories, runs = [risen(x["histories"]) for x in got], [unpacked(x["sizes"], "<u4") for x in got]
    history = np.concatenate([np.repeat(h, n) for h, n in zip(histories, runs)])
    word, count = (np.concatenate([unpacked(x[c], kind) for x in got]) for c, kind in (("words", "<u8"), ("counts", "<u4")))
    lower = np.concatenate([unpacked(x["values"], "<f8")[unpacked(x["lower"], "<u4")] for x in got])
    borders = np.cumsum([0, *(int(n.sum()) for n in runs)])
    order = sorted_by(history, word)
    new = np.append(True, (history[order][1:] != history[order][:-1]) | (word[order][1:] != word[order][:-1]))
    start = np.flatnonzero(new)
    gram = np.empty(len(order), np.int64)
    gram[order] = np.cumsum(new) - 1
    count = np.add.reduceat(count[order].astype(np.int64), start)
    owner, lower = history[order][start], lower[order][start]
    every, first, own = np.unique(owner, return_index=True, return_inverse=True)
    seen = count > 0
    total = np.add.reduceat(count, first)
    mass = np.add.reduceat(np.where(seen, lower, 0.0), first)
    few = np.bincount((own * (CUT + 1) + count)[seen & (count <= CUT)], minlength=len(every) * (CUT + 1))
    few = few.reshape(-1, CUT + 1)[:, 1:]
    part, rows = got[0]["part"], []
    for x, h, n, a, b in zip(got, histories, runs, borders, borders[1:]):
        at, own_counts = np.searchsorted(every, h), count[gram[a:b]]
        asked = _asked(own_counts, total[at], np.repeat(np.arange(len(n)), n))
        rows.append({"block": x["block"], "part": part, "counts": packed(own_counts), "totals": packed(total[at]),
                     "masses": packed(mass[at][asked]), "few": packed(few[at].T.astype("<u4")),
                     "ranks": None if last else rising(gram[a:b])})
    for at in np.flatnonzero(np.isin(every, level.heavy)).tolist():
        rows.append({"block": HEAVY_ROW, "part": part, "history": int(every[at]), "total": int(total[at]),
                     "mass": float(mass[at]), "numbers": few[at].tolist()})
    heavy = gram_number(np.flatnonzero(count > bound).astype(np.uint64), np.uint64(part), level.parts)
    rows.append({"block": STATISTICS, "part": part, "total": int(seen.sum()), "heavy": heavy.astype(np.int64).tolist(),
                 "numbers": np.bincount(count[seen & (count <= CUT + 1)], minlength=CUT + 2)[1:].tolist()})
    return _rows(rows, _LEVEL)


def discounts(numbers: list[int]) -> np.ndarray:
    """Good-Turing discounts d(0..CUT) from how many n-grams occur 1..CUT + 1 times.

    A discount that is not between 0 and 1 (too few n-grams to tell) is 1.
    """
    out, n = np.ones(CUT + 1), [0, *numbers]
    if n[1]:
        common = (CUT + 1) * n[CUT + 1] / n[1]
        for r in range(1, CUT + 1):
            if n[r] and n[r + 1] and common < 1:
                d = ((r + 1) * n[r + 1] / n[r] / r - common) / (1 - common)
                out[r] = d if 0 < d < 1 else 1.0
    return out


@dataclass
class Model:
    """The levels of a trained model, and the answers of their tables to the blocks."""

    levels: list[Level]
    answers: DataFrame
    n: int
    vocabulary: int


def _evaluated(block: Block, answers: list[dict], levels: list[Level]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(count, probability) of each token in the model of order 1, 2, ..."""
    p = None
    for level in levels:
        own = sorted((x for x in answers if x["level"] == level.order), key=lambda x: x["part"])
        grams = Grams(block, level)
        count, p = grams.probability(own, p)
        if own[0]["ranks"]:
            block.advance(level, grams.numbers(own))
        yield count, p


def train(rows: DataFrame, order: int, text_bytes: int, part_bytes: int, heavy: int, staging: Staging) -> Model:
    """Builds the tables order by order; ``rows`` are the staged blocks."""
    spark = rows.sparkSession
    n = rows.agg(F.sum("n_train")).first()[0] or 0
    parts, bound = max(1, -(-text_bytes // part_bytes)), n / heavy
    level, levels, tables, vocabulary = Level(1, parts, np.zeros(1, np.uint64)), [], [], 0
    for k in range(1, order + 1):
        if k == 1:
            sent = rows.mapInArrow(_first_messages(level), MESSAGE)
        else:
            known = spark.sparkContext.broadcast((list(levels), level))
            sent = _met(rows, tables).applyInArrow(_next_messages(known), MESSAGE)
        level_table = staging.put(f"level{k}", sent.groupBy("part").applyInArrow(_adder(level, bound, k == order), LEVEL))
        level = _finished(level, level_table)
        levels.append(level)
        tables.append(level_table.where("block >= 0").withColumn("level", F.lit(k)).select(
            "block", "level", "part", "counts", "totals", "masses", "few", "ranks"))
        statistics = level_table.where(F.col("block") == STATISTICS)
        if k == 1:
            vocabulary = statistics.agg(F.sum("total")).first()[0] or 0
        if k < order:   # fewer than ``heavy`` n-grams have so many tokens
            keys = [r[0] for r in statistics.select(F.explode("heavy")).collect()]
            level = Level(k + 1, parts, np.unique(np.array([0, *keys], np.uint64)))
    answers = tables[0]
    for more_rows in tables[1:]:
        answers = answers.unionAll(more_rows)
    return Model(levels, answers, n, vocabulary)


def _first_messages(level: Level):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                block = Block(row)
                yield from _rows(list(Grams(block, level).messages(block.number, None)), _MESSAGE).to_batches()
    return work


def _next_messages(known):
    def work(left: pa.Table, right: pa.Table) -> pa.Table:
        levels, level = known.value
        block = Block(left.to_pylist()[0])
        *_, (_, p) = _evaluated(block, right.to_pylist(), levels)
        return _rows(list(Grams(block, level).messages(block.number, p)), _MESSAGE)
    return work


def _adder(level: Level, bound: float, last: bool):
    return lambda messages: merged(messages, level, bound, last)


def _met(rows: DataFrame, tables: list[DataFrame]):
    answers = tables[0]
    for more in tables[1:]:
        answers = answers.unionAll(more)
    return rows.groupBy("block").cogroup(answers.groupBy("block"))


def _finished(level: Level, table: DataFrame) -> Level:
    """The level with its discounts and the sums of its heavy histories."""
    numbers = table.where(F.col("block") == STATISTICS).select(F.posexplode("numbers").alias("r", "n"))
    numbers = dict(numbers.groupBy("r").agg(F.sum("n")).collect())
    level.discount = discounts([numbers.get(r, 0) for r in range(CUT + 1)])
    # Sums over the parts in their order, so that they come out the same every time.
    by_part = table.where(F.col("block") == HEAVY_ROW).groupBy("history").agg(
        F.sort_array(F.collect_list(F.struct("part", "total", "mass", "numbers"))).alias("parts"))
    def added(kind: str, value) -> Column:
        return F.aggregate("parts", F.lit(0).cast(kind), lambda total, part: total + value(part))

    few = [added("long", lambda x, r=r: x["numbers"][r]).alias(f"n{r}") for r in range(CUT)]
    found = {r[0]: r[1:] for r in by_part.select(
        "history", added("long", lambda x: x["total"]), added("double", lambda x: x["mass"]), *few).collect()}
    values = [found.get(h, (0, 0.0, *[0] * CUT)) for h in level.heavy.tolist()]
    level.totals, level.lower = (np.array([v[i] for v in values], kind) for i, kind in ((0, np.int64), (1, float)))
    level.left = np.array([v[2:] for v in values]) @ ((1 - level.discount[1:]) * np.arange(1, CUT + 1))
    return level


def score(docs: DataFrame, held_out: Column, order: int = 2, block_bytes: int = BLOCK_BYTES, part_bytes: int = PART_BYTES,
          heavy: int = HEAVY) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) for every document.

    The model learns from the documents that are not held out.  ``base_score`` is that of
    single words with one added to each count, ``score`` the Katz model's log10 probability.
    """
    staging = Staging(docs.sparkSession, "katz")
    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", "text", F.coalesce(held_out, F.lit(False)).alias("held_out"))
    text_bytes = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    rows = staging.put("blocks", blocks(rows, block_bytes))
    model = train(rows, order, text_bytes, part_bytes, heavy, staging)
    known = docs.sparkSession.sparkContext.broadcast((model.levels, model.n, model.vocabulary))

    def work(left: pa.Table, right: pa.Table) -> pa.Table:
        levels, n, vocabulary = known.value
        row = left.to_pylist()[0]
        block, counts = Block(row), None
        for count, p in _evaluated(block, right.to_pylist(), levels):
            counts = count if counts is None else counts
        sums = lambda values: np.add.reduceat(values, block.first)
        return pa.table({
            "doc_id": left.column("doc_ids").combine_chunks().flatten(), "held_out": block.held, "n_tokens": block.length,
            "n_known": sums((counts > 0).astype(np.int64)), "train_tokens": np.full(len(block.first), n, np.int64),
            "base_score": sums(np.log10((counts + 1) / (n + vocabulary + 1))), "score": sums(np.log10(p))})

    return rows.groupBy("block").cogroup(model.answers.groupBy("block")).applyInArrow(
        work, f"doc_id {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")


def op12_rows(docs: DataFrame) -> DataFrame:
    """The stated fold (crc32 of the id, 2 modulo 7, is held out)."""
    return score(docs, F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 2)
