import hashlib
import random
import re

from tablekit.llm import pii as P
from tablekit.llm.common import table
from tests.conftest import SF_SMALL

PLAIN = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
         "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def luhn(d):
    x = [int(c) for c in reversed(d)]
    return sum(v if i % 2 == 0 else v * 2 - 9 * (v > 4) for i, v in enumerate(x)) % 10 == 0


def ok(kind, m):
    d = re.sub("[^0-9]", "", m)
    return {"email": True, "ip": all(int(p) <= 255 for p in m.split(".")) if kind == "ip" else 0,
            "card": 13 <= len(d) <= 19 and luhn(d), "phone": 9 <= len(d) <= 15}[kind]


def brute(text):
    return [f"{k}:{m.start()}:{m.end()}" for k, p in PLAIN.items() for m in re.finditer(p, text or "") if ok(k, m[0])]


def check(row, text):
    want = brute(text)
    assert row.base_sha256 == hashlib.sha256(",".join(want).encode()).hexdigest(), (row, want)
    assert [row[f"n_{k}"] for k in PLAIN] == [sum(x.startswith(k) for x in want) for k in PLAIN]
    got = row.spans.split(",") if row.spans else []
    assert [x for x in got if x.split(":")[0] in PLAIN] == want
    return [x for x in got if x.split(":")[0] not in PLAIN]


ODD = ["", None, "a@b.c_d@e.f x@y z@w.", "é🙂 mail me@x.org, 1.2.3.4.5.6.7.8 256.1.1.1 0001.02.3.255",
       "4111 1111 1111 1111 and 4111-1111-1111-1112 5 4111111111111111 1-2", "tel +1 (415) 555-0100. +49--- 5",
       "IBAN GB82 WEST 1234 5698 7654 32; GB82 WEST 1234 5698 7654 33", "SSN 123-45-6789", "order 123-45-6789",
       "8" * 50_000, "1 " * 20_000, "a" * 50_000 + "@b.co", "a@" * 5_000, "+1" * 3_000, "x@y.zz " * 400]


def test_odd_and_random_texts(spark):
    rng = random.Random(8)
    texts = ODD + ["".join(rng.choice("a1.@ -+5(é") for _ in range(rng.randint(0, 60))) for _ in range(600)]
    texts += ["".join(rng.choice("0123456789 -") for _ in range(40)) for _ in range(300)]
    df = spark.createDataFrame([(i, t, "n", 1) for i, t in enumerate(texts)], "doc_id long, text string, found string, n_ip int")
    rows = {r.doc_id: r for r in P.digests(df).collect()}
    extra = [check(rows[i], t) for i, t in enumerate(texts)]
    assert extra[6] == ["iban:5:32"] and extra[7] == ["ssn:4:15"] and extra[8] == []
    assert rows[3].max_score > 0.9 and rows[0].max_score is None
    again = P.digests(spark.createDataFrame([(None, "a@b.cc")] * 2, "doc_id long, text string")).collect()
    assert len(again) == 2 and again[0].n_email == 1
    assert P.digests(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    clean = {r.doc_id: r for r in P.redact(df).collect()}
    assert clean[1].text is None and clean[0].text == "" and clean[7].text == "SSN <SSN>" and clean[3].found == "n"
    assert clean[2].text == "<EMAIL><EMAIL> x@y z@w."
    assert clean[3].text == "é🙂 mail <EMAIL>, <IP>.<IP> 256.1.1.1 <IP>"
    assert clean[14].text == "<EMAIL> " * 400 and clean[8].text == ODD[8]


def test_table_against_brute_force(spark):
    docs = table(spark, SF_SMALL, "documents")
    texts = {r.doc_id: r.text for r in docs.collect()}
    out = P.digests(docs)
    assert "Python" not in out._jdf.queryExecution().executedPlan().toString()
    for r in out.collect():
        check(r, texts[r.doc_id])


def test_account_numbers_before_other_words(spark):
    numbers = ["ES9121000418450200051332", "BE68 5390 0754 7034", "AT611904300234573201", "LU28 0019 4006 4475 0000",
               "PL61109010140000071219812874", "DE89 3704 0044 0532 0130 00", "NO93 8601 1117 947",
               "MT84MALT011000012345MTLCAST001S", "GB82 WEST 1234 5698 7654 32"]
    after = ["", " 2024", " BIC x", " USA", " 20245", " BANKS", " X1", " ABCDEFGHIJKLMNOPQRSTUVWXYZ", " in", " 1234 5678 9012", ".5"]
    cases = [("\u00e9 pay " + n + a, [(6, 6 + len(n))]) for n in numbers for a in after]
    for x, y in zip(numbers, numbers[1:]):
        cases.append((f"{x} {y}", [(0, len(x)), (len(x) + 1, len(x) + 1 + len(y))]))
        # A start that no valid number follows, and a number glued to more letters.
        cases.append((f"AB12 CDEF {x} {y}A", [(10, 10 + len(x))]))
    # Not in the list of countries: the last end at which mod-97 holds.
    other = next(f"ZZ{i:02d} 1234 5678" for i in range(2, 99) if int(f"123456783535{i:02d}") % 97 == 1)
    cases += [(other + a, [(0, len(other))]) for a in ("", " \u00e9", " lower")] + [("ES9121000418450200051333 2024", [])]
    df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(cases)], "doc_id long, text string")
    rows = {r.doc_id: r for r in P.digests(df).collect()}
    clean = {r.doc_id: r.text for r in P.redact(df, kinds=tuple(k for k in P.KINDS if k.name == "iban")).collect()}
    for i, (text, want) in enumerate(cases):
        got = [x for x in rows[i].spans.split(",") if x.startswith("iban")]
        assert got == [f"iban:{a}:{b}" for a, b in want], text
        for a, b in reversed(want):
            text = text[:a] + "<IBAN>" + text[b:]
        assert clean[i] == text


def test_very_many_spans(spark):
    """Blocks of matches join without a seam, and the time grows with the number of matches."""
    import time

    def run(n):
        text = " ".join(f"write a{i}@b.org, +1 415 555 {i % 10000:04d} or 10.0.{i % 300}.1;" for i in range(n))
        df = spark.createDataFrame([(1, text)], "doc_id long, text string")
        began = time.time()
        row = P.digests(df).first()
        check(row, text)
        clean = P.redact(df).first().text
        assert clean == " ".join("write <EMAIL>, <PHONE> or " + ("<IP>;" if i % 300 <= 255 else f"10.0.{i % 300}.1;") for i in range(n))
        return time.time() - began

    run(300)
    assert run(4_000) < 3 * run(2_000) + 2
