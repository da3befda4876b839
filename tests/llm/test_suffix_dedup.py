import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from tablekit.llm import suffix_dedup as D
from tablekit.llm.common import table
from tests.conftest import SF_SMALL


def brute(docs, window=200):
    data = [(i, (t or "").encode()) for i, t in docs]
    count = Counter(hash(b[p:p + window]) for _, b in data for p in range(len(b) - window + 1))
    out = []
    for i, b in data:
        gone = np.zeros(len(b) + 1, np.int64)
        for p in range(len(b) - window + 1):
            if count[hash(b[p:p + window])] > 1:
                gone[p] += 1
                gone[p + window] -= 1
        out_of = np.cumsum(gone)[:len(b)] > 0
        turns = int((np.diff(np.concatenate([[0], out_of.astype(np.int8)])) == 1).sum())
        kept = bytes(np.frombuffer(b, np.uint8)[~out_of])
        out.append((i, len(b), int(out_of.sum()), turns, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def corpus():
    rng = random.Random(6)
    say = lambda n: "".join(rng.choice("abcdé \n") for _ in range(n))
    shared = [say(n) for n in (150, 190, 200, 230, 500, 1500)]
    docs = []
    for i in range(60):
        text = say(rng.randint(0, 150))
        for _ in range(rng.randint(0, 3)):
            s = rng.choice(shared)
            a = rng.randint(0, len(s) // 2)
            part = s[a:a + rng.randint(150, 700)]
            if rng.random() < 0.4:
                k = rng.randrange(len(part))
                part = part[:k] + "#" + part[k + 1:]
            text += part + say(rng.randint(0, 20))
        docs.append((i, text))
    docs += [(100, docs[1][1]), (1, docs[1][1]), (None, docs[2][1]), (None, shared[5]), (101, None), (102, ""),
             (103, "x" * 199), (104, "y" * 200), (105, "z" * 201), (106, "ab" * 3000), (107, say(100) * 5)]
    return docs


@pytest.mark.parametrize("hot", [D.HOT, 2])
def test_against_brute_force(spark, hot):
    docs = corpus()
    df = spark.createDataFrame([(i, t, 0, "c") for i, t in docs], "doc_id long, text string, ver int, content string").repartition(5)
    rows = D.remove_repeats(df, hot=hot).collect()
    got = sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, hashlib.sha256(r.kept).hexdigest()) for r in rows), key=repr)
    assert got == brute(docs)
    assert sum(r[2] > 0 for r in got) > 20


@pytest.mark.parametrize("window", [8, 9, 16, 40, 50])
def test_refined_blocks_are_the_repeated_windows(window):
    rng = random.Random(window)
    strings = [bytes(rng.choice(b"ab") for _ in range(rng.randint(0, 60))) for _ in range(40)] + [b"abab" * 20] * 2 + [b""]
    count = Counter(s[p:p + window] for s in strings for p in range(len(s) - window + 1))
    want = [[p for p in range(len(s) - window + 1) if count[s[p:p + window]] > 1] for s in strings]
    assert [x.tolist() for x in D.repeated_starts(strings, window)] == want


def test_texts_that_share_rolling_hashes_stay(spark):
    """Blocks in Thue-Morse order of two strings and of the strings swapped have equal polynomial hashes."""
    turns = [bin(k).count("1") % 2 for k in range(32)]
    shared = "".join(random.Random(0).choice("abcdefgh ") for _ in range(72))
    texts = [shared + "".join(("n0za", "2ard")[t ^ flip] for t in turns) for flip in (0, 1)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for hot in (D.HOT, 2):
        assert [r.n_removed for r in D.remove_repeats(df, hot=hot).collect()] == [0, 0]


def test_copies_without_an_id_are_compared_once(spark):
    """Rows with one id and text reach a bucket as one content, however many they are."""
    base = "".join(random.Random(5).choice("abcdefgh ") for _ in range(400))
    docs = [(None, base)] * 60 + [(1, base[:200] + "#" + base[201:]), (2, "%" + base[1:250])]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    rows = D.remove_repeats(df).collect()
    got = sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, hashlib.sha256(r.kept).hexdigest()) for r in rows), key=repr)
    assert got == brute(docs)


def test_empty_and_wrong_settings(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert D.digests(df).count() == 0
    with pytest.raises(ValueError, match="at least"):
        D.remove_repeats(df, window=7)


def test_table_against_brute_force(spark):
    docs = table(spark, SF_SMALL, "documents")
    assert sorted(map(tuple, D.digests(docs).collect()), key=repr) == brute([(r.doc_id, r.text) for r in docs.collect()])
