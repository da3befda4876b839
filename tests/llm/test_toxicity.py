import math
import random

from pyspark.sql import functions as F

from tablekit.llm import toxicity as T
from tablekit.llm.common import table


# Two groups of words for tests of a chain with given categories.
LISTS = (("insult", ("idiot", "moron", "stupid", "clown", "loser")),
         ("contempt", ("worthless", "trash", "scum", "pathetic", "disgusting")))


def test_held_out_accuracy(spark):
    docs, labels = (table(spark, "/root/testdata/sf0.1", t) for t in ("documents", "labels"))
    held = F.pmod(F.xxhash64("doc_id", F.lit("test")), F.lit(4)) == 0
    chain = T.learn(docs, labels.where(~held), 3000)
    truth = labels.where(held).select("doc_id", F.col("toxic").alias("truth"))
    got = T.score(docs.join(truth.select("doc_id"), "doc_id"), chain).join(truth, "doc_id").agg(
        F.count_if(F.col("toxic") & (F.col("truth") == 1)).alias("hit"),
        F.count_if(F.col("toxic")).alias("said"), F.sum("truth").alias("all"), F.count("*").alias("n")).first()
    # Three quarters of the small table label each telling word only a few times.
    assert got.all > 60 and got.hit >= 0.85 * got.all and got.hit >= 0.93 * got.said


def test_odd_rows_and_columns(spark):
    rng = random.Random(1)
    word = lambda: rng.choice(["red", "blue", "tree", "sky", "sun", "sea"])
    rows = [(i, " ".join(word() for _ in range(12)) + (" you idiot" if i % 4 == 0 else ""), 1, "x") for i in range(120)]
    odd = [(None, None, 0, "y"), (500, "", 0, "y"), (500, "", 0, "y"), (501, "IDIOT! " + "sky " * 100_000, 0, "y")]
    docs = spark.createDataFrame(rows + odd, "doc_id long, text string, toxic int, words string")
    labels = spark.createDataFrame([(i, int(i % 4 == 0), "t") for i in range(100)] + [(None, 1, "t"), (3, None, "t"), (7, 0, "t"), (999, 1, "t")],
                                   "doc_id long, toxic int, text string")
    out = T.score_toxicity(docs, labels, categories=LISTS).collect()
    assert len(out) == len(rows) + len(odd)
    assert all(r.toxic == (r.doc_id % 4 == 0) and r.insult == r.toxic and not r.contempt for r in out if (r.doc_id or 999) < 120)
    assert all(r.toxic == (r.doc_id == 501) for r in out if r.doc_id is None or r.doc_id >= 500)
    assert all(0 <= r.p_toxic <= 1 and r.p_contempt < 1e-9 for r in out)
    for few in (labels.limit(0), labels.where("doc_id = 5")):
        assert not any(r.toxic for r in T.score_toxicity(docs, few).collect())
    assert T.score_toxicity(docs.limit(0), labels).count() == 0


def test_copies_of_a_labelled_row_are_one_row_of_the_sample(spark):
    rows = [(1, "same text")] * 500 + [(1, "other text")] + [(2, "same text")] * 3 + [(3, None), (3, ""), (None, "same text")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1), (2, 0), (3, 0)], "doc_id long, toxic int")
    got = sorted((r.words, r.label) for r in T.labelled(docs, labels).collect())
    assert got == [([], 0.0), (["other", "text"], 1.0), (["same", "text"], 0.0), (["same", "text"], 1.0)]
    many = spark.createDataFrame([(1, f"text {i}") for i in range(300)], "doc_id long, text string")
    assert T.bounded(T.labelled(many, labels, 20), 20).count() == 20
    assert T.bounded(T.labelled(many, labels, 300), 300).count() == 300
    assert T.bounded(T.labelled(many.limit(0), labels), 5).count() == 0


def brute_fit(bags, before, y, n_words):
    """The same descent, one number after the other."""
    k = len(before[0]) if before else 0
    w = [0.0] * (1 + k + n_words)
    if not y or min(y) == max(y):
        w[0] = 30.0 if y and y[0] else -30.0
        return w
    a, b = [0.0] * len(w), [0.0] * len(w)
    rows = [[(0, 1.0)] + [(1 + i, p) for i, p in enumerate(ps)] + [(1 + k + j, 1.0) for j in bag] for ps, bag in zip(before, bags)]
    for step in range(1, T.STEPS + 1):
        g = [0.0] * len(w)
        for row, target in zip(rows, y):
            z = min(30.0, max(-30.0, sum(w[i] * v for i, v in row)))
            off = (1 / (1 + math.exp(-z)) - target) / len(y)
            for i, v in row:
                g[i] += off * v
        for i in range(len(w)):
            g[i] += T.PENALTY * w[i] if i else 0.0
            a[i], b[i] = 0.9 * a[i] + 0.1 * g[i], 0.99 * b[i] + 0.01 * g[i] * g[i]
            w[i] -= 0.3 * (a[i] / (1 - 0.9 ** step)) / (math.sqrt(b[i] / (1 - 0.99 ** step)) + 1e-8)
    return w


def brute_chain(rows, categories):
    """(words, [(weights, threshold)]) from (words of a document, label, fold)."""
    n, yes = len(rows), sum(y for _, y, _ in rows)
    worth = {}
    for word in {w for f, _, _ in rows for w in f}:
        with_it = [y for f, y, _ in rows if word in f]
        off = sum(with_it) * n - len(with_it) * yes
        if len(with_it) >= T.MIN_DOCS and off > 0:
            worth[word] = off * off / (len(with_it) * (n - len(with_it) + 1))
    words = sorted(worth, key=lambda w: (-worth[w], w))[:T.MAX_WORDS]
    bags = [[j for j, w in enumerate(words) if w in f] for f, _, _ in rows]
    targets = [[float(y and any(w in f for w in told)) for f, y, _ in rows] for _, told in categories] + [[y for _, y, _ in rows]]
    before, links = [[] for _ in rows], []
    for y in targets:
        weights = []
        for held in range(T.FOLDS + 1):
            some = [i for i, r in enumerate(rows) if r[2] != held]
            weights.append(brute_fit([bags[i] for i in some], [before[i] for i in some], [y[i] for i in some], len(words)))
        p = []
        for i, r in enumerate(rows):
            w, k = weights[r[2]], len(before[i])
            z = w[0] + sum(x * v for x, v in zip(before[i], w[1:])) + sum(w[1 + k + j] for j in bags[i])
            p.append(1 / (1 + math.exp(-min(30.0, max(-30.0, z)))))
        best = (-1.0, 0.5)
        for cut in range(5, 100) if sum(y) else ():
            said = [t for t, x in zip(y, p) if math.floor(x * 100) >= cut]
            f1 = 2 * sum(said) / (sum(y) + len(said))
            if (f1, -abs(cut - 50)) > (best[0], -abs(best[1] * 100 - 50)):
                best = (f1, cut / 100)
        links.append((weights[T.FOLDS], best[1]))
        before = [[*b, x] for b, x in zip(before, p)]
    return words, links


def test_whole_chain_against_plain_python(spark):
    rng = random.Random(9)
    texts = []
    for i in range(90):
        words = [rng.choice("red blue tree sky sun sea you are".split()) for _ in range(8)]
        if i % 3 == 0:
            words += rng.sample(["idiot", "moron", "scum", "trash", "red"], 2)
        texts.append((i, " ".join(words)))
    docs = spark.createDataFrame(texts, "doc_id long, text string").repartition(3)
    truth = {i: int(i % 3 == 0 or i % 17 == 1) for i, _ in texts}
    labels = spark.createDataFrame(sorted(truth.items()), "doc_id long, toxic int")
    fold = {r.doc_id: r.fold for r in docs.select("doc_id", F.pmod(F.xxhash64("doc_id", F.lit("fold")), F.lit(T.FOLDS)).alias("fold")).collect()}
    words, links = brute_chain([(set(t.split()), float(truth[i]), fold[i]) for i, t in texts], LISTS)
    chain = T.learn(docs, labels, categories=LISTS)
    assert list(chain.words) == words and [x.threshold for x in chain.links] == [t for _, t in links]
    for link, (weights, _) in zip(chain.links, links):
        assert max(abs(a - b) for a, b in zip(link.weights, weights)) < 1e-7
    for r in T.score(docs, chain).collect():
        before, text = [], set(dict(texts)[r.doc_id].split())
        for name, (w, threshold) in zip([*(c for c, _ in LISTS), T.LAST], links):
            z = w[0] + sum(x * v for x, v in zip(before, w[1:])) + sum(w[1 + len(before) + j] for j, x in enumerate(words) if x in text)
            before.append(1 / (1 + math.exp(-min(30.0, max(-30.0, z)))))
            assert abs(r[f"p_{name}"] - before[-1]) < 1e-7 and (r[name] == (before[-1] >= threshold) or abs(before[-1] - threshold) < 1e-7)


def test_groups_are_learned_from_what_occurs_together(spark):
    rng = random.Random(4)
    kinds = [["idiot", "moron", "clown"], ["scum", "trash", "filth"]]
    texts = []
    for i in range(240):
        words = [rng.choice("red blue tree sky sun sea you are".split()) for _ in range(8)]
        if i % 3 == 0:
            words += rng.sample(kinds[i // 3 % 2], 2)
        texts.append((i, " ".join(words)))
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i, _ in texts], "doc_id long, toxic int")
    rows = T.labelled(docs, labels)
    found = T.learned_categories(rows, T.telling_words(rows))
    assert sorted(sorted(w) for _, w in found) == sorted(sorted(k) for k in kinds)
    out = T.score_toxicity(docs, labels).collect()
    first = 1 if "idiot" in found[0][1] else 2
    assert all(r.toxic == (r.doc_id % 3 == 0) for r in out)
    assert all(r[f"kind_{first}"] == (r.doc_id % 6 == 0) and r[f"kind_{3 - first}"] == (r.doc_id % 6 == 3) for r in out)
    assert T.learned_categories(rows, []) == (("kind_1", ()), ("kind_2", ()))
    assert T.grouped([("a", 3)], {}) == [["a"], []]
