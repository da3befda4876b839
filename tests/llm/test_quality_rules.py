import re
from collections import Counter

from tablekit.llm import quality_rules as Q
from tablekit.llm.common import table
from tests.conftest import SF_SMALL

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    words = WORD.findall(text)
    grams = [tuple(words[i:i + 5]) for i in range(len(words) - 4)]
    count = Counter(grams)
    covered = {j for i, g in enumerate(grams) if count[g] > 1 for j in range(i, i + 5)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    n, rep = len(words), len(covered)
    return (n, sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), rep,
            n < 10 or 100 * rep > 20 * n)


COLUMNS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
ODD = [(1, None), (2, ""), (3, " \t\n\x0b "), (4, "a b c d e a b c d e f g h"), (4, "x x x x x x x"), (None, "## <b> $% | é"),
       (5, "same\nsame\n \n same\nsame\r\n"), (6, "one two three four five six seven eight nine ten"),
       (7, "long words here " * 40_000), (8, "z" * 300_000), (9, "a b c \x85 d")]


def test_measures_of_odd_rows(spark):
    df = spark.createDataFrame([(i, t, 5, 0) for i, t in ODD], "doc_id long, text string, n_words int, measures int")
    labels = spark.createDataFrame([], "doc_id long, quality int")
    rows = Q.score_quality(df, labels).collect()
    key = lambda x: repr(x)
    assert sorted(((r.doc_id, *(r[c] for c in COLUMNS)) for r in rows), key=key) == \
        sorted(((i, *brute(t)) for i, t in ODD), key=key)
    assert all(r.kept == (not r.base_failed) and r.rule is None for r in rows)
    assert Q.score_quality(spark.createDataFrame([], "doc_id long, text string"), labels).count() == 0


def test_learned_list_on_the_table(spark):
    docs, labels = table(spark, "/root/testdata/sf0.01", "documents"), table(spark, "/root/testdata/sf0.01", "labels")
    texts = {r.doc_id: r.text for r in docs.collect()}
    rows = {r.doc_id: r for r in Q.score_quality(docs, labels).collect()}
    assert len(rows) == len(texts)
    assert all(tuple(rows[i][c] for c in COLUMNS) == brute(t) for i, t in texts.items())
    known = {r.doc_id: r.quality for r in labels.collect()}
    bad = [rows[i] for i, q in known.items() if q == 0 and not rows[i].base_failed]
    good = [rows[i] for i, q in known.items() if q == 1 and not rows[i].base_failed]
    assert sum(not r.kept for r in bad) >= 0.8 * len(bad)
    assert sum(not r.kept for r in good) <= 0.02 * len(good)


def test_planted_rule_is_found_and_pruned(spark):
    text = F_text = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu {}"
    docs = spark.createDataFrame([(i, F_text.format(f"n{i}") + (" ## ## ##" if i % 5 == 0 else "")) for i in range(600)],
                                 "doc_id long, text string")
    labels = spark.createDataFrame([(i, 0 if i % 5 == 0 else 1, None) for i in range(600)] +
                                   [(None, 0, None), (3, None, None), (9999, 0, None)], "doc_id long, quality int, text string")
    rules = Q.learn(docs, labels)
    assert len(rules) == 1 and len(rules[0].conditions) == 1 and rules[0].good == 0
    rows = Q.score_quality(docs, labels).collect()
    assert all(r.kept == (r.doc_id % 5 != 0) for r in rows)
    assert Q.learn(docs, labels.where("quality = 1")) == [] and "{}" in text


def test_small_table_runs(spark):
    rows = Q.score_quality(table(spark, SF_SMALL, "documents"), table(spark, SF_SMALL, "labels"))
    assert rows.count() == 200
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Exchange" not in plan


def test_rare_junk_with_few_symbols_is_split_off(spark):
    def text(i):  # 30 of 2100 rows are junk, most of it with 1 to 3 symbols, two with 20
        k = 0 if i % 70 else 20 if i in (0, 70) else 1 + i // 70 % 3
        return f"alpha beta gamma delta epsilon zeta eta theta iota kappa n{i:04d}{'#' * k}{'z' * (20 - k)}"

    docs = spark.createDataFrame([(i, text(i)) for i in range(2100)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 70 > 0)) for i in range(2100)], "doc_id long, quality int")
    assert all(r.kept == (r.doc_id % 70 != 0) for r in Q.score_quality(docs, labels).collect())


def test_bound_holds_for_rows(spark):
    """An id with very many texts brings in no more rows than allowed, and copies count once."""
    text = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda {}"
    docs = spark.createDataFrame([(1, text.format(i)) for i in range(300)] + [(2, text.format("x"))] * 50,
                                 "doc_id long, text string")
    labels = spark.createDataFrame([(1, 0), (2, 1)], "doc_id long, quality int")
    assert Q.labelled_measures(docs, labels, max_labelled=20).count() <= 20
    assert Q.labelled_measures(docs, labels).count() == 301
