import math
import random
import zlib
from collections import Counter, defaultdict
from functools import cache

import pytest
from pyspark.sql import functions as F

from tablekit.llm import katz as K
from tests.conftest import SF_SMALL


class Brute:
    """The model from dictionaries of counts, word by word."""

    def __init__(self, texts, order):
        self.order, self.counts = order, [None, *(defaultdict(Counter) for _ in range(order))]
        for text in texts:
            for h, w in self.places(text):
                for k in range(1, order + 1):
                    self.counts[k][h[len(h) - k + 1:]][w] += 1
        self.d = [None, *(self.discounts(self.counts[k]) for k in range(1, order + 1))]

    def places(self, text):
        words = [w for w in "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").replace("\x0b", " ")
                 .replace("\x0c", " ").replace("\t", " ").replace("\n", " ").replace("\r", " ").split(" ") if w]
        past = ("<s>",) * (self.order - 1)
        for w in [*words, None]:
            yield past, w
            past = (*past, w)[1:] if self.order > 1 else ()

    @staticmethod
    def discounts(table):
        n = Counter(c for row in table.values() for c in row.values())
        out = {}
        for r in range(1, 6):
            if n[1] and n[r] and n[r + 1] and 6 * n[6] / n[1] < 1:
                d = ((r + 1) * n[r + 1] / n[r] / r - 6 * n[6] / n[1]) / (1 - 6 * n[6] / n[1])
                out[r] = d if 0 < d < 1 else 1.0
        return out

    @cache
    def row(self, h):
        """(kept counts, total, left, the shorter model's mass) of a history."""
        row = self.counts[len(h) + 1].get(h)
        if not row:
            return None
        kept, total = {x: c * self.d[len(h) + 1].get(c, 1.0) for x, c in row.items()}, sum(row.values())
        left = total - sum(kept.values())
        if left <= 1e-9:
            total, left = total + 1, 1.0
        return kept, total, left, sum(self.p(h[1:], x) for x in row) if h else 0.0

    def p(self, h, w):
        shorter = lambda: self.p(h[1:], w) if h else 1.0
        if (known := self.row(h)) is None:
            return shorter()
        kept, total, left, mass = known
        return kept[w] / total if w in kept else left / total / (1 - mass) * shorter()


def brute(rows, order):
    held = [i is not None and zlib.crc32(str(i).encode()) % 7 == 2 for i, _ in rows]
    model = Brute([t for (_, t), h in zip(rows, held) if not h], order)
    unigrams = model.counts[1].get((), Counter())
    n, v = sum(unigrams.values()), len(unigrams)
    out = []
    for (i, text), h in zip(rows, held):
        places = list(model.places(text))
        out.append((i, h, len(places), sum(unigrams[w] > 0 for _, w in places), n,
                    sum(math.log10((unigrams[w] + 1) / (n + v + 1)) for _, w in places),
                    sum(math.log10(model.p(past, w)) for past, w in places)))
    return model, out


def same(got, want):
    key = lambda r: (r[0] is not None, r[0] or 0, r[2], r[6])
    got, want = sorted(map(tuple, got), key=key), sorted(want, key=key)
    assert [r[:5] for r in got] == [r[:5] for r in want]
    for a, b in zip(got, want):
        assert a[5] == pytest.approx(b[5], rel=1e-9, abs=1e-9) and a[6] == pytest.approx(b[6], rel=1e-9, abs=1e-9)


def some_texts(n, seed):
    rng = random.Random(seed)
    return [(i, " ".join(rng.choice("abcdeFGhij"[:1 + int(rng.expovariate(0.4)) % 10]) * rng.choice((1, 1, 2))
                         for _ in range(rng.randrange(25)))) for i in range(n)]


@pytest.mark.parametrize("order", [1, 2, 3])
def test_equals_brute_force(spark, order):
    rows = some_texts(150, order)
    frame = spark.createDataFrame([(i, t, 0) for i, t in rows], "doc_id long, text string, block int").repartition(3)
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 2
    model, want = brute(rows, order)
    same(K.score(frame, held, order, block_bytes=300, part_bytes=500, heavy=10).collect(), want)
    same(K.score(frame, held, order).collect(), want)       # one block, one part
    vocabulary = [*model.counts[1][()], "unheard"]
    for h in list(model.counts[order])[:20] + [("x",) * (order - 1)]:
        assert sum(model.p(h, w) for w in vocabulary) == pytest.approx(1, abs=1e-9)


def test_odd_rows(spark):
    rows = [(None, "a b"), (None, "a b"), (3, None), (4, ""), (5, " \t\n"), (6, "A\x0bb c É"), (7, "a " * 3000), (7, "a")]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    same(K.op12_rows(frame).collect(), brute(rows, 2)[1])
    assert K.op12_rows(frame.limit(0)).collect() == []
    everything = K.score(frame, F.lit(True)).collect()
    assert {(r.n_known, r.train_tokens, r.base_score, r.score) for r in everything} == {(0, 0, 0.0, 0.0)}


def test_words_of_long_texts_come_in_pieces():
    text = b"ab Cd\x0cef\n" * 50 + b"x" * 40
    assert [w for some in K.words(text, 7) for w in some] == text.lower().split()


def test_documents(spark):
    frame = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text")
    rows = [tuple(r) for r in frame.collect()]
    same(K.op12_rows(frame).collect(), brute(rows, 2)[1])
