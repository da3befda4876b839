import random
import re

import numpy as np
import xxhash

from tablekit.llm import simhash as S
from tablekit.llm.common import Staging, table
from tablekit.llm.components import components
from tests.conftest import SF_SMALL


def brute_print(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    h = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_roots(points, bits=3):
    """Index of the smallest reachable point, by comparing all pairs."""
    x = np.array(points, np.uint64)
    near = np.bitwise_count(x[:, None] ^ x[None, :]) <= bits
    labels = np.arange(len(x))
    while True:
        new = np.where(near, labels[None, :], len(x)).min(1)
        if (new == labels).all():
            return labels
        labels = new


def some_points(n, seed):
    rng, out = random.Random(seed), set()
    while len(out) < n:
        p = rng.getrandbits(64) if rng.random() < 0.3 or not out else rng.choice(sorted(out)[:50])
        for _ in range(rng.randint(0, 6)):
            p ^= 1 << rng.randrange(64)
        out.add(p)
    return sorted(out)


def test_forest_equals_all_pairs():
    for seed in range(3):
        x = some_points(1500, seed)
        assert (S.forest(np.array(x, np.uint64), 3) == brute_roots(x)).all()


def test_tree_sends_linked_points_to_a_common_shard():
    x = np.array(some_points(1500, 7), np.uint64)
    tree = S.Tree(x[::8], 8, 3)
    assert tree.leaves > 8
    places = {}
    for leaf, some in tree.route(x):
        for p in some.tolist():
            places.setdefault(p, set()).add(leaf)
    i, j = np.nonzero(np.bitwise_count(x[:, None] ^ x[None, :]) <= 3)
    assert all(places[a] & places[b] for a, b in zip(x[i].tolist(), x[j].tolist()))


def check(rows, texts):
    """rows: (doc_id, fingerprint, component_id); texts: [(doc_id, text)]."""
    prints = [brute_print(t) for _, t in texts]
    points = sorted(set(prints))
    roots = dict(zip(points, brute_roots(points).tolist()))
    least = {}
    for (i, _), p in zip(texts, prints):
        least[roots[p]] = min((x for x in (least.get(roots[p]), i) if x is not None), default=None)
    want = sorted(((i, f"{p:016x}", least[roots[p]]) for (i, _), p in zip(texts, prints)), key=repr)
    assert sorted(rows, key=repr) == want
    return roots


ODD = [(5, None), (4, ""), (9, " \n"), (1, "One two"), (2, "one  TWO"), (3, "a b c"), (3, "a b c"), (None, "x y z w"),
       (None, "x y z w"), (7, "w " * 100_000), (8, "z" * 200_000), (10, "é Ü a b"), (11, "é ü a b")]


def test_odd_rows(spark):
    rng = random.Random(1)
    base = [rng.choice(["red", "blue", "tree", "sky", "Sun", "é"]) + str(rng.randint(0, 99)) for _ in range(400)]
    texts = ODD + [(100 + i, " ".join(base[:399 - i % 5] + ["q"] * (i % 3))) for i in range(60)]
    df = spark.createDataFrame([(i, t, "e", 0) for i, t in texts], "doc_id long, text string, component_id string, fp int")
    roots = check([tuple(r) for r in S.near_duplicates(df, shard=16).collect()], texts)
    kept = S.keep_one(df).collect()
    assert len(kept) == len(set(roots.values())) and kept[0].component_id == "e" and kept[0].fp == 0
    assert {r.doc_id for r in kept} >= {1, 3, 4, 7, 8, None}
    assert S.near_duplicates(df.limit(0)).count() == 0 and S.keep_one(df.limit(0)).count() == 0


def test_components_of_a_path_and_a_star(spark):
    pairs = [(i, i + 1) for i in range(40)] + [(100, 200 + i) for i in range(50)] + [(7, 7), (None, 3), (300, 301), (301, 300)]
    df = spark.createDataFrame(pairs, "a long, b long")
    got = {r.node: r.root for r in components(df, Staging(spark, "t")).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{100: 100}, **{200 + i: 100 for i in range(50)}, 300: 300, 301: 300}


def test_table_against_all_pairs(spark):
    docs = table(spark, SF_SMALL, "documents")
    check([tuple(r) for r in S.near_duplicates(docs, shard=32).collect()], [(r.doc_id, r.text) for r in docs.collect()])
