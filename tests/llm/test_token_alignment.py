import hashlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers as public
import pytest
from pyspark.sql import functions as F

from tablekit.llm import token_alignment as T
from tests.conftest import SF_SMALL


@pytest.fixture(scope="module")
def files():
    return T.Tokenizers.load(public.path("byte_bpe_50k.json"), public.path("piece_bpe_32k.model"))


def brute(texts, files):
    """Token by token with all pairs of a text compared."""
    aligner = T.Aligner(files)
    found = []
    for text in texts:
        spans, want = [], (" " + (text or "")).encode()
        if text:
            a = aligner.a.encode(" " + text, add_special_tokens=False).ids
            for ids, table in ((a, aligner.bytes_a), (aligner.b.encode(text), aligner.bytes_b)):
                at, own = 0, []
                for i in ids:
                    own.append((at, at + len(table[i]), i))
                    at += len(table[i])
                spans.append(own)
        if not text or any(b"".join(t[i] for _, _, i in own) != want for own, t in zip(spans, (aligner.bytes_a, aligner.bytes_b))):
            found.append(None)
            continue
        a, b = spans
        links, first = [], 0
        for s, e, i in a:
            while first < len(b) and b[first][1] <= s:
                first += 1
            k = first
            while k < len(b) and b[k][0] < e:
                links.append((i, b[k][2]))
                k += 1
        groups, ia, ib = [], 0, 0
        for end in sorted({e for _, e, _ in a} & {e for _, e, _ in b}):
            ga, gb = [], []
            while ia < len(a) and a[ia][1] <= end:
                ga.append(str(a[ia][2]))
                ia += 1
            while ib < len(b) and b[ib][1] <= end:
                gb.append(str(b[ib][2]))
                ib += 1
            groups.append(",".join(ga) + "|" + ",".join(gb))
        found.append((len(a), len(b), groups, links))
    docs, times = Counter(), Counter()
    for f in found:
        if f:
            docs.update(set(f[3]))
            times.update(f[3])
    best = defaultdict(int)
    for (i, _), n in docs.items():
        best[i] = max(best[i], n)
    rows = [(f[0], f[1], len(f[2]), len(f[3]), sum(docs[p] == best[p[0]] for p in f[3]), sum(docs[p] for p in f[3]),
             hashlib.sha256(";".join(f[2]).encode()).hexdigest()) if f else (0, 0, 0, 0, 0, 0, "") for f in found]
    return rows, {(*p, n, times[p], n == best[p[0]]) for p, n in docs.items()}


ODD = ["", None, " ", "\n\n\t x", "<|endoftext|> </s> <unk>", "a" * 3000, "héllo wörld ▁ ﬁ １２", "日本語のテキスト 🙂",
       "x y", "x y", "x y", "word " * 500, "tab\tand  two blanks ", "\x00 zero"]


def test_equals_brute_force(spark, files):
    texts = ODD + [r.text for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").limit(60).collect()]
    frame = spark.createDataFrame([(k, x, 1) for k, x in enumerate(texts)], "doc_id long, text string, pair int").repartition(4)
    rows, pairs = brute(texts, files)
    got = {r[0]: tuple(r)[1:] for r in T.align(frame, files).collect()}
    assert [got[k] for k in range(len(texts))] == rows
    assert {tuple(r) for r in T.alignment(frame, files).collect()} == pairs


def test_dense_bitmaps(spark, files):
    texts = [f"same words {k % 7}" for k in range(5000)] + ["one more " * 40]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    rows, _ = brute(texts, files)
    assert [tuple(r)[1:] for r in T.align(frame, files).orderBy("doc_id").collect()] == rows
    assert T.index(frame, files).where(F.octet_length("docs") == 2 * T.DENSE).count() > 0


def test_bitmaps_round_trip():
    runs = [[0, 5, 65535], [], list(range(0, 65536, 13)), [7]]
    packed = T.bitmaps(np.array([x for r in runs for x in r]), np.array(list(map(len, runs))))
    assert [T.places(x).tolist() for x in packed.to_pylist()] == runs


def test_postings_hold_multiplicities():
    rng = np.random.default_rng(0)
    pair, place = rng.integers(0, 6, 4000), rng.integers(0, 30, 4000)
    keys = (pair.astype(np.uint64) << np.uint64(16)) | place.astype(np.uint64)
    got = {}
    for batch in T.postings(3, keys):
        for p, docs, planes in zip(*(batch.column(c).to_pylist() for c in ("pair", "docs", "planes"))):
            for at in T.places(docs):
                got[p, at] = 1 + sum((at in T.places(x)) << k for k, x in enumerate(planes))
    assert got == Counter(zip(pair.tolist(), place.tolist()))
    assert list(T.postings(0, np.zeros(0, np.uint64))) == []


def test_containers_close(spark, files):
    """A container ends with its links; the counts are those of all containers together."""
    texts = [f"a b c {k % 3}" * 20 for k in range(25)]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    frame.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "4")
    try:
        assert T.index(frame, files, max_links=1).select("container").distinct().count() > 3
        got = [tuple(r)[1:] for r in T.align(frame, files, max_links=1).orderBy("doc_id").collect()]
    finally:
        frame.sparkSession.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert got == brute(texts, files)[0]


def test_empty_and_null_ids(spark, files):
    assert T.align(spark.createDataFrame([], "doc_id long, text string"), files).collect() == []
    rows = T.align(spark.createDataFrame([(None, "a b"), (None, "a b"), (3, None)], "doc_id long, text string"), files).collect()
    assert sorted((r.doc_id is None, r.n_links > 0) for r in rows) == [(False, False), (True, True), (True, True)]


def test_ranks_give_the_library_s_ids(spark, files):
    aligner = T.Aligner(files)
    assert aligner.ranked
    texts = [" " + (r.text or "") for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    texts += [" " + x for x in ODD if x] + [" I'll've don't's  \n\n  x 12ab 3½ ä'S", " " * 50, " a" + " " * 9 + "b\t\tc"]
    assert aligner.ids_a(texts) == [e.ids for e in aligner.a.encode_batch(texts, add_special_tokens=False)]
