import hashlib
import random
import re

import duckdb
import numpy as np

from tablekit.llm import sketch
from tablekit.llm import substring_dedup as D
from tablekit.llm.common import table
from tablekit.llm.windows import BASE, Powers, Rolling, families
from tests.conftest import SF_SMALL

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(docs, window=50):
    first = {}
    split = [(i, WORD.findall(t or "")) for i, t in docs]
    for i, w in split:
        if i is not None:
            for p in range(len(w) - window + 1):
                g = " ".join(w[p:p + window])
                first[g] = min(first.get(g, i), i)
    out = []
    for i, w in split:
        gone = set()
        if i is not None:
            for p in range(len(w) - window + 1):
                if first[" ".join(w[p:p + window])] < i:
                    gone.update(range(p, p + window))
        kept = " ".join(x for k, x in enumerate(w) if k not in gone)
        out.append((i, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=repr)


def corpus(seed=4):
    rng = random.Random(seed)
    say = lambda n: [rng.choice(["a", "b", "the", "é", "Foo,"]) + str(rng.randint(0, 30)) for _ in range(n)]
    shared = [say(n) for n in (49, 50, 51, 60, 140, 400)]
    docs = []
    for i in range(70):
        words = say(rng.randint(0, 40))
        for _ in range(rng.randint(0, 3)):
            s = rng.choice(shared)
            a = rng.randint(0, max(0, len(s) - 50))
            part = list(s[a:a + rng.randint(45, 200)])
            if part and rng.random() < 0.4:
                part[rng.randrange(len(part))] = "edited"
            words += part + say(rng.randint(0, 5))
        docs.append((i, rng.choice([" ", "\n", " \t"]).join(words)))
    docs += [(200 + i, docs[3][1]) for i in range(5)] + [(300, "x " * 500), (301, "x " * 49), (302, "x " * 50),
             (303, None), (304, ""), (None, docs[3][1]), (3, docs[3][1]), (5, docs[3][1]), (305, "z" * 200_000),
             (306, "y " * 120), (306, "y " * 120)]
    return docs


def test_against_brute_force(spark):
    docs = corpus()
    df = spark.createDataFrame([(i, t, 0, "c") for i, t in docs], "doc_id long, text string, ver int, core string").repartition(5)
    got = sorted((tuple(r) for r in D.digests(df).collect()), key=repr)
    assert got == brute(docs)
    assert sum(r[2] > 0 for r in got) > 20
    assert D.digests(df.limit(0)).count() == 0


def test_families_cover_each_window_once():
    rng = np.random.default_rng(1)
    symbols = rng.integers(1, 5, 3000).astype(np.uint64)
    borders = np.array([0, 0, 10, 60, 61, 1500, 3000])
    f = families(Rolling(symbols, Powers(BASE)), borders, 50, 8)
    got = [p for a, b in zip(f.low, f.high) for p in range(a, b + 1)]
    assert got == [p for a, b in zip(borders, borders[1:]) for p in range(a, b - 49)]
    assert ((f.anchor >= f.high) & (f.anchor + 8 <= f.low + 50)).all()


def test_sketch_overestimates(spark):
    keys = [k % 700 for k in range(1000)]
    df = spark.createDataFrame([(k,) for k in keys], "k long").repartition(6)
    one = sketch.merged(df, lambda bs: (b.column("k").to_numpy().view(np.uint64) for b in bs), 18)
    assert one(np.arange(300, dtype=np.uint64)).all()
    assert one(np.arange(300, 700, dtype=np.uint64)).mean() < 0.05


def test_table_matches_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{SF_SMALL}/documents.parquet')")
    got = sorted(map(tuple, D.digests(table(spark, SF_SMALL, "documents")).collect()))
    assert got == sorted(con.sql(D.DIGEST_SQL).fetchall()) and any(r[2] for r in got)


def test_words_that_share_rolling_hashes_stay(spark):
    """Two words in Thue-Morse order, and swapped, have equal polynomial hashes in both documents."""
    rng = random.Random(0)
    shared = [f"s{rng.randrange(10 ** 6)}" for _ in range(18)]
    texts = [" ".join(shared + [("w18553842", "w22892066")[(bin(k).count("1") + flip) % 2] for k in range(32)]) for flip in (0, 1)]
    df = spark.createDataFrame([(1, texts[0]), (2, texts[1])], "doc_id long, text string")
    assert {r.n_removed for r in D.remove_repeats(df).collect()} == {0}
