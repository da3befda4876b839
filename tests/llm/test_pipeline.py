"""The pipeline against the brute-force versions of its stages."""

import re
import struct

import pytest
import tiktoken
from pyspark.sql import functions as F

import corpus_pipeline as C
from tablekit.llm import quality_rules
from tablekit.llm.common import table
from tablekit.llm.queries import public_vocabulary
from tests.conftest import SF_SMALL
from tests.llm import test_decontaminate, test_pii, test_quality_rules, test_simhash


def rejects(rules, text):
    """The learned list in plain Python."""
    n, chars, symbols, dup, rep, failed = test_quality_rules.brute(text)
    words = test_quality_rules.WORD.findall(text or "")
    lines = [x for x in (text or "").split("\n") if test_quality_rules.WORD.search(x)]
    ratio = lambda a, b: a / b if b else 0.0
    count = lambda p: len(re.findall(p, text or ""))
    m = dict(symbol_ratio=ratio(symbols, n), upper_ratio=ratio(count("[A-Z]"), chars), bang_ratio=ratio(count("[!?]"), n),
             digit_ratio=ratio(count("[0-9]"), chars), dup_line_ratio=ratio(dup, len(lines)), repeat_ratio=ratio(rep, n),
             distinct_ratio=ratio(len(set(words)), n), mean_word_chars=ratio(chars, n))
    return failed or any(all((m[c.measure] >= c.bound) == c.above for c in r.conditions) for r in rules)


def redacted(text):
    spans = sorted((int(a), int(b), k) for k, a, b in (x.split(":") for x in test_pii.brute(text)))
    out, at = "", 0
    for a, b, k in spans:
        if a >= at:
            out += text[at:a] + f"<{k.upper()}>"
        at = max(at, b)
    return out + text[at:]


def brute_run(rows, rules, benchmark):
    kept = [r for r in rows if not rejects(rules, r["text"])]
    prints = [test_simhash.brute_print(r["text"]) for r in kept]
    points = sorted(set(prints))
    roots = dict(zip(points, test_simhash.brute_roots(points).tolist()))
    first = {}
    for r, p in zip(kept, prints):
        first[roots[p]] = min(first.get(roots[p], r["doc_id"]), r["doc_id"])
    kept = [r for r, p in zip(kept, prints) if first[roots[p]] == r["doc_id"]]
    kept = [r for r in kept if not test_decontaminate.brute(r["text"], benchmark)[0][4]]
    return {r["doc_id"]: redacted(r["text"]) for r in kept}


def test_run_against_brute_force(spark):
    docs = table(spark, SF_SMALL, "documents")
    rules = quality_rules.learn(docs, table(spark, SF_SMALL, "labels"))
    bench = [(str(r.item_id), r.text) for r in table(spark, SF_SMALL, "benchmark").collect()]
    want = brute_run([r.asDict() for r in docs.collect()], rules, bench)
    out = C.run(spark, SF_SMALL)
    assert out.columns == [*docs.columns, "ids", "n_tokens", "decodes"]
    rows = out.collect()
    assert {r.doc_id: r.text for r in rows} == want and len(rows) == len(want) < docs.count()
    vocabulary = public_vocabulary()
    library = tiktoken.Encoding("own", pat_str=vocabulary.pattern, special_tokens={},
                                mergeable_ranks={t: i for i, t in enumerate(vocabulary.tokens)})
    for r in rows:
        assert list(struct.unpack(f"<{r.n_tokens}I", r.ids)) == library.encode_ordinary(r.text)
        assert r.decodes and r.n_chars == len(r.text)


ODD = "doc_id long, text string, lang string, source string, n_chars long, verdict int, fp long, ids string"


@pytest.mark.parametrize("stage", C.STAGES, ids=lambda s: s[0])
def test_each_stage_on_odd_rows(spark, stage):
    text = "this is a plain text with more than ten different words in a row, mail me@x.org"
    rows = [(1, text, None, "s", 3, 1, 2, "i"), (1, text, None, "s", 3, 1, 2, "i"), (None, None, None, None, None, None, None, None),
            (2, "", "en", "", 0, 1, 2, "i"), (None, text + " and so on for ever and ever more", "en", "s", 1, 1, 1, "i")]
    docs = spark.createDataFrame(rows, ODD)
    name, function = stage
    out = function(spark, docs, SF_SMALL)
    assert set(docs.columns) <= set(out.columns)
    if name != "tokens":
        assert out.columns == docs.columns and [f.dataType for f in out.schema] == [f.dataType for f in docs.schema]
    got = sorted(out.select("doc_id", "text").collect(), key=repr)
    if name == "quality":
        assert [r.doc_id for r in got] == [1, 1, None]
    elif name == "near_duplicates":
        assert [r.doc_id for r in got] == [1, 2, None]
    else:
        assert len(got) == 5
    if name == "pii":
        assert got[0].text.endswith("mail <EMAIL>") and out.where("n_chars is null").count() == 1
    assert function(spark, docs.limit(0), SF_SMALL).count() == 0
    assert out.select(F.col("lang")).count() == len(got)
