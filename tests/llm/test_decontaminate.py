import hashlib
import random
import re

import duckdb

from tablekit.llm import decontaminate as D
from tablekit.llm.common import table
from tests.conftest import SF_SMALL

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute(text, items):
    w, hit, names, longest = words(text), set(), set(), 0
    for name, item in items:
        x = words(item)
        k = min(10, len(x))
        grams = {tuple(x[q:q + k]) for q in range(len(x) - k + 1)} if x else set()
        for p in range(len(w) - k + 1):
            if k and tuple(w[p:p + k]) in grams:
                hit.update(range(p, p + k))
                names.add(name)
                longest = max(longest, *(next((n for n in range(k, len(x) + 1) if w[p:p + n + 1] != x[q:q + n + 1]
                                               or p + n >= len(w) or q + n >= len(x)), k)
                                         for q in range(len(x) - k + 1) if w[p:p + k] == x[q:q + k]))
    return (len(w), len(hit), len(names), hashlib.sha256(",".join(sorted(names)).encode()).hexdigest(), bool(hit)), longest


def row(r):
    return (r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated)


def test_random_texts_in_one_and_many_blocks(spark):
    rng = random.Random(2)
    say = lambda n: " ".join(rng.choice(["a", "b", "The", "é"]) for _ in range(n))
    items = [(i, say(rng.choice([1, 3, 9, 10, 12, 25]) if i > 4 else 25)) for i in range(12)]
    items = [x for x in items if len(x[1].split()) > 5] + [(90, None), (91, ""), (92, "..."), (None, "a a a a a a a a a a"), items[0]]
    docs = [(i, say(rng.randint(0, 60))) for i in range(80)] + [(i, (items[i % 3][1] or "") + " zz " + say(5)) for i in range(80, 90)]
    docs += [(100, None), (100, None), (None, ""), (101, "a " * 30_000), (102, "z" * 100_000)]
    df = spark.createDataFrame([(i, t, "x", 1) for i, t in docs], "doc_id long, text string, contamination string, n_hit int")
    bench = spark.createDataFrame(items, "item_id long, text string")
    named = [("" if i is None else str(i), t) for i, t in items]
    wants = {t: brute(t, named) for _, t in docs}
    want = sorted(((i, *wants[t][0]) for i, t in docs), key=repr)
    for block_words in (10_000, 40):
        got = D.digests(df, bench, block_words=block_words).collect()
        assert sorted(((r.doc_id, *row(r)) for r in got), key=repr) == want
    full = D.find_contamination(df, bench).collect()
    for r in full:
        assert r.contamination.longest == wants[r.text][1]
        if r.contamination.longest:
            at, n = r.contamination.longest_at, r.contamination.longest
            assert " ".join(words(r.text)[at:at + n]) in " ".join(words(dict(named)[r.contamination.longest_item]))
    kept = D.remove_contaminated(df, bench)
    assert kept.schema == df.schema and {r.contamination for r in kept.collect()} == {"x"}
    assert sorted(map(repr, (r.doc_id for r in kept.collect()))) == sorted(repr(i) for i, t in docs if not wants[t][0][4])


def test_empty_tables(spark):
    none = spark.createDataFrame([], "item_id long, text string")
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    assert [row(r)[:3] for r in D.digests(docs, none).collect()] == [(2, 0, 0)]
    assert D.digests(docs.limit(0), none).count() == 0


def test_table_matches_sql(spark):
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    got = sorted(map(tuple, D.digests(table(spark, SF_SMALL, "documents"), table(spark, SF_SMALL, "benchmark")).collect()))
    assert got == sorted(con.sql(D.DIGEST_SQL).fetchall()) and any(r[5] for r in got)
