"""Toxicity categories by a chain of linear classifiers.

The categories are predicted one after the other: each model sees which telling
words a document has and the probabilities of the categories before it.  For
training, those probabilities are out-of-fold predictions (a document's own label
never helps to make its features), so later models meet the same kind of input as
in use.  The decision threshold of each category is the one with the best F1 on its
out-of-fold predictions.

The last category is the label itself.  The ones before it are learned from the same
sample: words that occur almost only in toxic documents are put into groups by which of
them occur together, and a category is the label where a word of its group occurs
(``learned_categories``; or groups given by the caller).  Models are fitted on at most ``MAX_LABELLED``
labelled documents (by hash of their ids) and applied to all documents.  The fits
of a category, one without each fold and one on all, run in parallel tasks, each
on that bounded sample.  Copies of a text under one id count once in it.

Defined results for odd input: a null or empty text has no words; repeated rows are
scored each on their own; labels without an id or a label are not learned from, of
several labels for one id the largest counts; a category with only one class (or
without labels) gets that constant probability (to 13 places); further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablekit.llm.common import Staging, binary, slices

#: Labelled documents to learn from at most; words the models use; labelled documents a
#: word must be in; folds.
MAX_LABELLED, MAX_WORDS, MIN_DOCS, FOLDS = 20_000, 1000, 4, 3
#: Passes of a fit over its sample, and the weight of its squared penalty.
STEPS, PENALTY = 300, 1e-4

#: Groups of words before the label; words in them at most; the least share of toxic documents
#: among those with such a word; words that a group may start from.
GROUPS, STRONG_WORDS, STRONG, SEEDS = 2, 32, 0.8, 8
LAST = "toxic"

WORD = regex.compile(r"\p{L}+")


@dataclass(frozen=True)
class Link:
    """One category of the chain: weights (intercept, earlier categories, words) and threshold."""

    name: str
    weights: np.ndarray
    threshold: float


@dataclass(frozen=True)
class Chain:
    words: tuple[str, ...]
    links: tuple[Link, ...]


def words_of(text: bytes) -> set[str]:
    return set(WORD.findall(text.decode().lower()))


def probability(z):
    return 1.0 / (1.0 + np.exp(-np.clip(z, -30, 30)))


def labelled(docs: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED) -> DataFrame:
    """(words, label, fold, place) of labelled documents of at most ``max_labelled`` ids,
    one row for each text under an id; ``place`` is a hash of both."""
    known = (labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL")
             .groupBy(F.col("doc_id").alias("label_id")).agg(F.max("toxic").alias("label"))
             .orderBy(F.xxhash64("label_id"), "label_id").limit(max_labelled))
    # At most max_labelled pairs of numbers, so the broadcast is bounded.
    rows = docs.select("doc_id", "text").join(F.broadcast(known), F.col("doc_id") == F.col("label_id"))
    # Copies under one id are one row; combined in the map tasks, so they meet nowhere.
    rows = rows.groupBy("label_id", F.sha2(F.coalesce("text", F.lit("")), 256).alias("hash")).agg(
        F.max("label").alias("label"), F.first("text").alias("text"))
    rows = rows.select("text", (F.col("label") == 1).cast("double").alias("label"),
                       F.pmod(F.xxhash64(F.col("label_id"), F.lit("fold")), F.lit(FOLDS)).cast("int").alias("fold"),
                       F.xxhash64("label_id", "hash").alias("place"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            found = [sorted(words_of(x)) for x in binary(part.column("text")).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(found, pa.list_(pa.string())), *(part.column(c) for c in ("label", "fold", "place"))],
                ["words", "label", "fold", "place"])

    return rows.mapInArrow(work, "words array<string>, label double, fold int, place long")


def bounded(rows: DataFrame, max_labelled: int) -> DataFrame:
    """The ``max_labelled`` rows of smallest place; all of them if ids do not have several texts."""
    last = rows.select("place").orderBy("place").limit(max_labelled).agg(F.max("place")).first()[0]
    return rows.where(F.col("place") <= F.lit(last).cast("long"))


def telling_words(rows: DataFrame) -> list[tuple[str, int, int]]:
    """(word, documents, toxic documents) of the words whose presence goes with the label most
    clearly (chi-squared), the clearest first."""
    total, yes = rows.agg(F.count("*"), F.sum("label")).first()
    if not yes or yes == total:
        return []
    n, k = F.col("n"), F.col("k")
    off = k * total - n * F.lit(yes)
    score = off * off / (n * (F.lit(total) - n + 1))
    found = (rows.select(F.explode("words").alias("word"), "label").groupBy("word")
             .agg(F.count("*").alias("n"), F.sum("label").alias("k")).where(n >= MIN_DOCS)
             .where(off > 0).orderBy(score.desc(), "word").limit(MAX_WORDS))
    return [(r.word, r.n, int(r.k)) for r in found.select("word", "n", "k").collect()]


def grouped(strong: list[tuple[str, int]], together: dict[tuple[str, str], int], groups: int = GROUPS) -> list[list[str]]:
    """Words (with their toxic documents, clearest first) in groups that occur together.

    Groups start from the words among the first ``SEEDS`` that occur together least; every
    other word joins the group with which it occurs most on average (cosine of their documents).
    """
    count = dict(strong)

    def near(a: str, b: str) -> float:
        return together.get((min(a, b), max(a, b)), 0) / (count[a] * count[b]) ** 0.5

    out: list[list[str]] = [[strong[0][0]]] if strong else []
    while out and len(out) < min(groups, len(strong)):
        rest = [w for w, _ in strong[:max(SEEDS, groups)] if all(w not in g for g in out)]
        out.append([min(rest, key=lambda w: max(near(w, g[0]) for g in out))])
    for word, _ in strong:
        if all(word not in g for g in out):
            best = max(out, key=lambda g: (sum(near(word, x) for x in g) / len(g), -len(g)))
            best.append(word)
    return out + [[]] * (groups - len(out))


def learned_categories(rows: DataFrame, telling: list[tuple[str, int, int]]) -> tuple[tuple[str, tuple[str, ...]], ...]:
    """(name, words) of the groups; counts come from the toxic documents of the bounded sample."""
    strong = [(w, k) for w, n, k in telling if k >= STRONG * n][:STRONG_WORDS]
    names = F.array(*(F.lit(w) for w, _ in strong)) if strong else F.array().cast("array<string>")
    held = rows.where("label = 1").select(F.array_intersect("words", names).alias("held"))
    pairs = (held.select("held", F.explode("held").alias("a")).select("a", F.explode("held").alias("b")).where("a < b")
             .groupBy("a", "b").count())        # at most STRONG_WORDS^2 / 2 rows
    together = {(r.a, r.b): r["count"] for r in pairs.collect()} if strong else {}
    return tuple((f"kind_{i + 1}", tuple(g)) for i, g in enumerate(grouped(strong, together)))


def fit(bags: list[list[int]], before: np.ndarray, y: np.ndarray, n_words: int) -> np.ndarray:
    """Logistic regression by full-batch gradient steps (Adam): intercept, earlier categories, words."""
    n, k = before.shape
    weights = np.zeros(1 + k + n_words)
    if not n or y.min() == y.max():
        weights[0] = 30.0 if n and y[0] else -30.0
        return weights
    row = np.repeat(np.arange(n), [len(b) for b in bags])
    word = np.array([w for b in bags for w in b], np.int64) + 1 + k
    first, second = np.zeros_like(weights), np.zeros_like(weights)
    for step in range(1, STEPS + 1):
        z = weights[0] + before @ weights[1:1 + k] + np.bincount(row, weights[word], minlength=n)
        off = (probability(z) - y) / n
        gradient = np.bincount(word, off[row], minlength=len(weights))
        gradient[0], gradient[1:1 + k] = off.sum(), off @ before
        gradient[1:] += PENALTY * weights[1:]
        first, second = 0.9 * first + 0.1 * gradient, 0.99 * second + 0.01 * gradient * gradient
        weights -= 0.3 * (first / (1 - 0.9 ** step)) / (np.sqrt(second / (1 - 0.99 ** step)) + 1e-8)
    return weights


def _fits(rows: DataFrame, y: str, before: list[str], n_words: int) -> list[np.ndarray]:
    """The weights without each fold, then those on all rows; each fit is a task of its own."""
    variants = F.filter(F.array(*map(F.lit, range(FOLDS + 1))), lambda v: v != F.col("fold"))
    held = F.array(*map(F.col, before)) if before else F.array().cast("array<double>")

    def one(table: pa.Table) -> pa.Table:
        p = np.array(table.column("before").to_pylist(), float).reshape(table.num_rows, len(before))
        weights = fit(table.column("bag").to_pylist(), p, table.column("y").to_numpy(), n_words)
        return pa.table({"variant": table.column("variant").slice(0, 1), "weights": pa.array([weights.tolist()])})

    got = (rows.select("bag", F.col(y).alias("y"), held.alias("before"), F.explode(variants).alias("variant"))
           .groupBy("variant").applyInArrow(one, "variant int, weights array<double>").collect())
    found = {r.variant: np.array(r.weights) for r in got}
    none = fit([], np.zeros((0, len(before))), np.zeros(0), n_words)
    return [found.get(v, none) for v in range(FOLDS + 1)]


def _out_of_fold(rows: DataFrame, weights: list[np.ndarray], before: list[str], into: str) -> DataFrame:
    """``rows`` plus the probability by the model that has not seen the row's fold."""
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema) + f", {into} double"

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for bag, fold, *p in zip(*(batch.column(c).to_pylist() for c in ("bag", "fold", *before))):
                w = weights[fold]
                out.append(probability(w[0] + np.dot(p, w[1:1 + len(p)]) + w[1 + len(p):][bag].sum()))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.float64())], [*batch.schema.names, into])

    return rows.mapInArrow(work, schema)


def _threshold(rows: DataFrame, y: str, p: str) -> float:
    """The probability from which saying yes has the best F1, in steps of 1/100."""
    bins = rows.groupBy(F.floor(F.col(p) * 100).cast("int").alias("bin")).agg(
        F.sum(y).alias("yes"), F.count("*").alias("n")).collect()
    total, best = sum(r.yes for r in bins), (-1.0, 0.5)
    if not total:
        return 0.5
    for cut in range(5, 100):
        hit = sum(r.yes for r in bins if r.bin >= cut)
        said = sum(r.n for r in bins if r.bin >= cut)
        f1 = 2 * hit / (total + said)
        if (f1, -abs(cut - 50)) > (best[0], -abs(best[1] * 100 - 50)):
            best = (f1, cut / 100)
    return best[1]


def learn(docs: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED, categories=None) -> Chain:
    """Fit the chain; ``categories`` are (name, words) in chain order, learned if not given."""
    staging = Staging(docs.sparkSession, "toxicity")
    rows = bounded(staging.put("labelled", labelled(docs, labels, max_labelled)), max_labelled)
    telling = telling_words(rows)
    words = [w for w, _, _ in telling]
    categories = learned_categories(rows, telling) if categories is None else categories
    place = {w: i for i, w in enumerate(words)}

    def bags(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found, label = b.column("words").to_pylist(), b.column("label").to_numpy()
            marks = [pa.array([float(t and not told.isdisjoint(f)) for f, t in zip(found, label)], pa.float64())
                     for told in (set(ws) for _, ws in categories)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([[place[w] for w in f if w in place] for f in found], pa.list_(pa.int32())),
                 b.column("fold"), *marks, b.column("label")],
                ["bag", "fold", *(f"y_{name}" for name, _ in categories), f"y_{LAST}"])

    names = [*(name for name, _ in categories), LAST]
    rows = staging.put("bags", rows.mapInArrow(
        bags, "bag array<int>, fold int, " + ", ".join(f"y_{name} double" for name in names)))
    links, before = [], []
    for name in names:
        weights = _fits(rows, f"y_{name}", before, len(words))
        rows = staging.put(f"link_{name}", _out_of_fold(rows, weights, before, f"p_{name}"))
        links.append(Link(name, weights[FOLDS], _threshold(rows, f"y_{name}", f"p_{name}")))
        before = [*before, f"p_{name}"]
    staging.drop(*list(staging.paths))
    return Chain(tuple(words), tuple(links))


def score(docs: DataFrame, chain: Chain) -> DataFrame:
    """doc_id, a probability ``p_<category>`` and a decision for each category of the chain."""
    place, links = {w: i for i, w in enumerate(chain.words)}, chain.links
    kind = docs.schema["doc_id"].dataType.simpleString()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            p = np.zeros((part.num_rows, len(links)))
            for i, text in enumerate(binary(part.column("text")).to_pylist()):
                bag = [place[w] for w in place.keys() & words_of(text)]
                for k, link in enumerate(links):
                    w = link.weights
                    p[i, k] = probability(w[0] + p[i, :k] @ w[1:1 + k] + w[1 + k:][bag].sum())
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), *(pa.array(p[:, k]) for k in range(len(links))),
                 *(pa.array(p[:, k] >= link.threshold) for k, link in enumerate(links))],
                ["doc_id", *(f"p_{x.name}" for x in links), *(x.name for x in links)])

    return docs.select("doc_id", "text").mapInArrow(
        work, f"doc_id {kind}, " + ", ".join([*(f"p_{x.name} double" for x in links), *(f"{x.name} boolean" for x in links)]))


def score_toxicity(docs: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED, categories=None) -> DataFrame:
    """Learn the chain from the labels and score every document."""
    return score(docs, learn(docs, labels, max_labelled, categories))
