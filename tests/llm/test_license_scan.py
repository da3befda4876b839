import re

import pytest
import regex

from tablekit.llm import license_scan as L
from tablekit.llm.common import table
from tests.conftest import SF_SMALL

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lowered(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def brute_base(text):
    words = WORD.findall(lowered(text))
    hits = [(i, label) for phrase, label in L.PHRASES for i in range(len(words))
            if words[i:i + len(phrase.split())] == phrase.split()]
    at = [i for i, _ in hits]
    return (len(words), len(hits), min(at, default=None), max(at, default=None),
            ",".join(sorted({x for _, x in hits})))


def edit_distance_within(text, notice, k):
    """True if a substring of text is within k edits (plain dynamic programme)."""
    row = list(range(len(notice) + 1))
    for c in text:
        new = [0]
        for j, p in enumerate(notice):
            new.append(min(row[j] + (c != p), row[j + 1] + 1, new[j] + 1))
        row = new
        if row[-1] <= k:
            return True
    return row[-1] <= k


def check(row, text):
    assert (row.n_words, row.n_base, row.first_word, row.last_word, row.base_labels) == brute_base(text)
    assert set(filter(None, row.base_labels.split(","))) <= set(row.labels.split(",")) | {""}
    assert 0 <= row.score <= 1 and (row.score > 0) == bool(row.labels)


CASES = [
    (0, None), (1, ""), (2, "MIT License MIT license, mit-license"), (3, "This is Licensed under the Apache Licence, Verson 2.0!"),
    (4, "GNU General Public License general public license"), (5, "limit license mit licenses"), (6, "é MIT\x0bLicense ü"),
    (7, "Relased undr the M1T license"), (8, "word " * 50_000 + "released under teh mit license"), (2, "again the same id"),
    (None, "permission is hereby grantd, free of charge, to any person"), (9, "licensed under cc by nc 4.0"),
    (10, "released under the mit license released under the mit license"),
]


def test_small_cases(spark):
    df = spark.createDataFrame([(i, t, 1, "x") for i, t in CASES], "doc_id long, text string, n_words int, labels string")
    rows = L.scan_licenses(df).collect()
    assert len(rows) == len(CASES)
    for row, (_, text) in zip(sorted(rows, key=lambda r: (r.doc_id is None, r.doc_id, r.n_words)),
                              sorted(CASES, key=lambda c: (c[0] is None, c[0], brute_base(c[1])[0]))):
        check(row, text)
        canon = L.canonical((text or "").encode())[0]
        if len(canon) < 1000:
            want = {n.label for n in L.NOTICES if edit_distance_within(canon, n.words.encode(), n.edits)}
            assert {s.label for s in row.spans} == want
    by = {r.doc_id: r for r in rows if r.doc_id not in (2, None)}
    assert by[3].labels == "apache" and by[3].base_labels == "" and by[3].spans[0].first_word == 2
    assert by[7].labels == "mit" and by[8].labels == "mit" and by[8].spans[0].first_word == 50_000
    assert len(by[10].spans) == 2 and by[10].score == 1.0


def test_pigeonhole_finds_all_that_a_full_search_finds():
    import random
    rng = random.Random(5)
    for _ in range(300):
        notice = rng.choice(L.NOTICES)
        body = list(notice.words)
        for _ in range(rng.randint(0, notice.edits + 2)):
            at, kind = rng.randrange(len(body)), rng.randrange(3)
            body[at:at + (kind > 0)] = [] if kind == 2 else [rng.choice("abcxyz ")]
        text = f" foo {''.join(body)} bar ".encode()
        want = regex.search(rb"(?:%s){e<=%d}" % (regex.escape(notice.words.encode()), notice.edits), text) is not None
        assert bool(L.fuzzy_matches(text, [notice])) == want


def test_dense_near_copies_are_all_found():
    spans = L.scan(b"Released under the mxt license! " * 400)[-1]
    assert [(s["first_word"], s["last_word"], s["edits"]) for s in spans] == [(5 * k, 5 * k + 4, 1) for k in range(400)]


def test_best_matches_come_first():
    notice = L.Notice("x", "abcdefgh ijkl", 2)
    text = b" abcdefgh ijklabcdeXgh ijkl abcdefgh iXXl "
    found = L.fuzzy_matches(text, [notice])
    assert [(s, text[s:e], k) for s, e, k, _ in sorted(found)] == [
        (1, b"abcdefgh ijkl", 0), (14, b"abcdeXgh ijkl", 1), (28, b"abcdefgh iXXl", 2)]


def test_empty_table(spark):
    assert L.scan_licenses(spark.createDataFrame([], "doc_id long, text string")).count() == 0


@pytest.mark.parametrize("sf", [SF_SMALL])
def test_whole_table_matches_brute_force(spark, sf):
    docs = table(spark, sf, "documents")
    texts = {r.doc_id: r.text for r in docs.collect()}
    rows = L.scan_licenses(docs).collect()
    assert len(rows) == len(texts)
    for r in rows:
        check(r, texts[r.doc_id])
