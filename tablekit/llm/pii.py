"""Personal data: regular expressions propose spans, checksums confirm them, context
words adjust their score.  SQL functions only; every text is handled in its own row.

Positions come from cutting a text at its matches: the pieces' and the matches'
lengths add up to the start of each match (in code points).  Arrays are folded, and
texts are read around spans, in blocks of ``BLOCK`` matches, so that a text with very
many matches does not cost the square of their number.  The patterns are
possessive and start only at the beginning of a run, so each is linear in the
text's length and finds the same spans as its plain form in ``KINDS``.  An account
number can go on into the words behind it, so its pattern proposes the start only
and ``iban`` picks the end among all places where it could be.

Defined results for odd input: a null text is an empty text and has no spans
(``redact`` leaves it null); repeated rows are scanned each on their own; further
columns are ignored by ``find_spans`` and kept by ``redact``.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Code points before and after a span in which context words count.
BEFORE, AFTER = 40, 20
#: What a context word adds to the score, and the score that a span must reach
#: (spans of the base kinds stay whatever their score).
CONTEXT_SCORE, MIN_SCORE = 0.4, 0.5
#: Matches that are handled together.
BLOCK = 128


@dataclass(frozen=True)
class Kind:
    """A kind of personal data.

    ``needs`` is a character that every match contains (a cheap test), ``valid``
    confirms a match, ``score`` is the score without context words.  With ``reach``,
    matches are only starts: ``whole`` gets the ``reach`` characters from there on and
    returns the value they begin with, null if there is none.
    """

    name: str
    pattern: str
    valid: Callable[[Column], Column]
    score: float
    context: str
    needs: str = ""
    base: bool = True
    reach: int = 0
    whole: Callable[[Column], Column] | None = None


def digits(x: Column) -> Column:
    return F.regexp_replace(x, "[^0-9]", "")


def luhn(x: Column) -> Column:
    """The digits pass Luhn's checksum: every second one from the right is doubled."""
    each = F.transform(F.split(F.reverse(digits(x)), ""), lambda c, i: F.when(
        i % 2 == 0, c.cast("int")).otherwise(c.cast("int") * 2 - F.when(c.cast("int") > 4, 9).otherwise(0)))
    return F.aggregate(each, F.lit(0), lambda a, d: a + F.coalesce(d, F.lit(0))) % 10 == 0


def mod97(x: Column) -> Column:
    """The account number leaves 1 modulo 97 with its first four characters moved to the end."""
    plain = F.regexp_replace(x, " ", "")
    moved = F.concat(F.substring(plain, 5, 64), F.substring(plain, 1, 4))
    step = lambda a, c: F.when(c == "", a).when(
        c.between("0", "9"), (a * 10 + c.cast("int")) % 97).otherwise((a * 100 + F.ascii(c) - 55) % 97)
    return F.aggregate(F.split(moved, ""), F.lit(0), step) == 1


#: Characters of an account number by country (the IBAN registry).
IBAN_CHARS = {15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK",
              21: "CH HR LI LV", 22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL",
              24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST", 26: "IS TR", 27: "BI DJ FR GR IT MC MR SM",
              28: "AL AZ BY CY DO GT HN HU LB NI PL SV", 29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC",
              32: "LC", 33: "RU"}
#: Blocks of four after the first four characters, at least and at most, and the characters
#: of the longest number with its blanks and the one behind it.
BLOCKS, IBAN_REACH = (2, 7), 4 + 7 * 5 + 4 + 1


def iban(x: Column) -> Column:
    """The account number that ``x`` begins with, null if there is none.

    Every end between two words is tried: the one at the country's length counts, and
    without it (or for other countries) the last at which mod-97 holds.
    """
    ends = [rf"^[A-Z]{{2}}[0-9]{{2}}(?: ?[A-Z0-9]{{4}}){{{n}}}{rest}(?![A-Za-z0-9])"
            for n in range(BLOCKS[1], BLOCKS[0] - 1, -1) for rest in ("(?: ?[A-Z0-9]{1,3})", "")]
    found = F.filter(F.array(*(F.regexp_extract(x, p, 0) for p in ends)), lambda v: (v != "") & mod97(v))
    country, size = F.substring(x, 1, 2), F.lit(0)
    for n, names in IBAN_CHARS.items():
        size = F.when(country.isin(names.split()), n).otherwise(size)
    exact = F.filter(found, lambda v: F.length(F.regexp_replace(v, " ", "")) == size)
    return F.coalesce(F.get(exact, F.lit(0)), F.get(found, F.lit(0)))


def _octets(x: Column) -> Column:
    octet = "0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"
    return x.rlike(rf"^{octet}(?:\.{octet}){{3}}$")


KINDS = (
    # [A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+
    Kind("email", r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
         lambda x: F.lit(True), 0.9, "mail|contact|write|courriel|correo", "@"),
    # [0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+), parts at most 255
    Kind("ip", r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", _octets, 0.6, "ip|host|server|address|login", "."),
    # [0-9]([ -]?[0-9])+ with 13 to 19 digits: the whole chain or nothing
    Kind("card", r"(?<![0-9])(?<![0-9][ -])[0-9](?:[ -]?[0-9]){12,18}+(?![ -]?[0-9])", luhn, 0.7,
         "card|visa|mastercard|credit|payment|carte|karte|tarjeta"),
    # \+[0-9][ ().0-9-]+[0-9] with 9 to 15 digits
    Kind("phone", r"\+[0-9][ ().0-9-]+[0-9]", lambda x: F.length(digits(x)).between(9, 15), 0.6,
         "phone|tel|call|mobile|fax|telefon", "+"),
    # [A-Z]{2}[0-9]{2}( ?[A-Z0-9]{4}){2,7}( ?[A-Z0-9]{1,3})? before the end of a word
    Kind("iban", r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?=(?: ?[A-Z0-9]{4}){2})", lambda x: F.lit(True),
         0.8, "iban|bank|account|konto|compte|cuenta", base=False, reach=IBAN_REACH, whole=iban),
    Kind("ssn", r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])", lambda x: ~x.rlike("^(?:000|666|9)|-00-|-0000$"),
         0.3, "ssn|social security|taxpayer", "-", base=False),
)

SPAN = "struct<start:int,end:int,value:string>"


def _blocks(items: Column) -> Column:
    """An array as an array of arrays with ``BLOCK`` elements."""
    starts = F.when(F.size(items) > 0, F.sequence(F.lit(0), F.floor((F.size(items) - 1) / BLOCK).cast("int"))).otherwise(
        F.array().cast("array<int>"))
    return F.transform(starts, lambda b: F.slice(items, b * BLOCK + 1, F.lit(BLOCK)))


def _folded(items: Column, step: Callable[[Column, Column], Column], kind: str) -> Column:
    """The array ``out`` (of ``kind``) that ``step`` grows from a struct (at, out), with ``at`` 0 at first."""
    zero = F.struct(F.lit(0).alias("at"), F.array().cast(f"array<array<{kind}>>").alias("out"))

    def block(a: Column, some: Column) -> Column:
        done = F.aggregate(some, F.struct(a["at"].alias("at"), F.array().cast(f"array<{kind}>").alias("out")), step)
        return F.struct(done["at"].alias("at"), F.concat(a["out"], F.array(done["out"])).alias("out"))

    return F.flatten(F.aggregate(_blocks(items), zero, block, lambda a: a["out"]))


def _read(text: Column, items: Column, low: Callable, high: Callable, one: Callable) -> Column:
    """``one(part, at, item)`` of each item, ``part`` being the text from ``at`` on that holds what
    lies between ``low`` and ``high`` of the items of a block (sorted by both)."""
    first = lambda b: F.greatest(low(F.element_at(b, 1)), F.lit(0))
    parts = F.transform(_blocks(items), lambda b: F.struct(
        F.substring(text, first(b) + 1, high(F.element_at(b, -1)) - first(b)).alias("part"), first(b).alias("at"), b.alias("items")))
    return F.flatten(F.transform(parts, lambda p: F.transform(p["items"], lambda x: one(p["part"], p["at"], x))))


def _located(text: Column, pattern: str, matches: Column) -> Column:
    """Start, end and value of each match, from the lengths of what lies between them."""
    gaps = F.transform(F.split(text, pattern, -1), lambda x: F.length(x))
    pairs = F.arrays_zip(matches.alias("m"), F.slice(gaps, 1, F.size(matches)).alias("g"))

    def step(a: Column, x: Column) -> Column:
        start = a["at"] + x["g"]
        end = start + F.length(x["m"])
        one = F.struct(start.alias("start"), end.alias("end"), x["m"].alias("value"))
        return F.struct(end.alias("at"), F.concat(a["out"], F.array(one)).alias("out"))

    return _folded(pairs, step, SPAN)


def with_spans(docs: DataFrame, text: str = "text", into: str = "spans",
               kinds: tuple[Kind, ...] = KINDS) -> DataFrame:
    """``docs`` plus ``into``: array<struct<kind, start, end, score>> by kind as listed, then start.

    Each step is a projection of its own, as later ones use its arrays more than once.
    """
    body, found = f"{into}__text", {k.name: f"{into}__{k.name}" for k in kinds}
    t = F.col(f"`{body}`")
    out = docs.withColumn(body, F.coalesce(F.col(f"`{text}`"), F.lit("")))
    none = F.array().cast("array<string>")
    out = out.withColumns({found[k.name]: F.when(t.contains(k.needs), F.regexp_extract_all(
        t, F.lit(k.pattern), F.lit(0))).otherwise(none) if k.needs else F.regexp_extract_all(
        t, F.lit(k.pattern), F.lit(0)) for k in kinds})
    columns = {k.name: F.col(f"`{found[k.name]}`") for k in kinds}
    out = out.withColumns({found[k.name]: F.when(
        F.exists(columns[k.name], k.valid),
        F.filter(_located(t, k.pattern, columns[k.name]), _valid_span(k))).otherwise(
        F.array().cast(f"array<{SPAN}>")) for k in kinds})
    for k in kinds:
        if k.whole:
            out = out.withColumn(found[k.name], _from_start(t, k, columns[k.name]))
            out = out.withColumn(found[k.name], _apart(columns[k.name]))
    # A one-element explode: else filters on the result would copy these expressions into themselves.
    out = out.withColumn(into, F.explode(F.array(F.flatten(F.array(*(
        F.filter(_scored(t, k, columns[k.name]), _kept(k)) for k in kinds))))))
    return out.drop(body, *found.values())


def _valid_span(kind: Kind) -> Callable[[Column], Column]:
    return lambda s: kind.valid(s["value"])


def _from_start(text: Column, kind: Kind, spans: Column) -> Column:
    return _read(text, spans, lambda s: s["start"], lambda s: s["start"] + kind.reach, lambda part, at, s: F.struct(
        s["start"].alias("start"), kind.whole(F.substring(part, s["start"] - at + 1, F.lit(kind.reach))).alias("value")))


def _apart(found: Column) -> Column:
    """The spans of the values found; one that starts inside the span before it is left out."""
    spans = F.transform(F.filter(found, lambda s: s["value"].isNotNull()), lambda s: F.struct(
        s["start"].alias("start"), (s["start"] + F.length(s["value"])).alias("end"), s["value"].alias("value")))
    return _folded(spans, lambda a, s: F.when(s["start"] >= a["at"], F.struct(
        s["end"].alias("at"), F.concat(a["out"], F.array(s)).alias("out"))).otherwise(a), SPAN)


def _scored(text: Column, kind: Kind, spans: Column) -> Column:
    def one(part: Column, at: Column, s: Column) -> Column:
        before = F.substring(part, F.greatest(s["start"] - BEFORE, F.lit(0)) - at + 1, F.least(s["start"], F.lit(BEFORE)))
        after = F.substring(part, s["end"] - at + 1, F.lit(AFTER))
        near = F.concat(before, F.lit(" \n "), after).rlike(rf"(?i)(?<![A-Za-z])(?:{kind.context})")
        score = F.least(F.lit(1.0), F.lit(kind.score) + F.when(near, CONTEXT_SCORE).otherwise(0.0))
        return F.struct(F.lit(kind.name).alias("kind"), s["start"].cast("long").alias("start"),
                        s["end"].cast("long").alias("end"), score.alias("score"))
    return _read(text, spans, lambda s: s["start"] - BEFORE, lambda s: s["end"] + AFTER, one)


def _kept(kind: Kind) -> Callable[[Column], Column]:
    return lambda s: F.lit(True) if kind.base else s["score"] >= MIN_SCORE


def find_spans(docs: DataFrame, kinds: tuple[Kind, ...] = KINDS) -> DataFrame:
    """doc_id and its scored spans."""
    return with_spans(docs.select("doc_id", "text"), into="found", kinds=kinds).select("doc_id", "found")


def digests(docs: DataFrame, kinds: tuple[Kind, ...] = KINDS) -> DataFrame:
    """Counts by base kind and the span lists as text and SHA-256."""
    listed = lambda a: F.array_join(F.transform(a, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
    base = [k.name for k in kinds if k.base]
    found = F.col("found")
    return find_spans(docs, kinds).select(
        "doc_id", *(F.size(F.filter(found, _of(k))).cast("long").alias(f"n_{k}") for k in base),
        F.sha2(listed(F.filter(found, lambda s: s["kind"].isin(base))), 256).alias("base_sha256"),
        listed(found).alias("spans"),
        F.array_max(F.transform(found, lambda s: s["score"])).alias("max_score"))


def _of(kind: str) -> Callable[[Column], Column]:
    return lambda s: s["kind"] == kind


def redact(docs: DataFrame, text: str = "text", kinds: tuple[Kind, ...] = KINDS) -> DataFrame:
    """``docs`` with every span replaced by its kind in angle brackets, such as ``<EMAIL>``.

    Overlapping spans are one replacement, named after the span that starts first.
    """
    own, spans, heads = docs.columns, "redact__spans", "redact__heads"
    t, s, h = F.col(f"`{text}`"), F.col(f"`{spans}`"), F.col(heads)
    out = with_spans(docs, text, spans, kinds)
    ordered = F.array_sort(F.transform(s, lambda x: F.struct(x["start"].cast("int").alias("start"), x["end"].cast("int").alias("end"),
                                                             x["kind"].alias("kind"))))

    def mark(a: Column, x: Column) -> Column:
        """A span that starts behind all before it heads a replacement; ``end`` is how far they reach."""
        far = F.greatest(a["at"], x["end"])
        one = F.struct(x["start"].alias("start"), far.alias("end"), x["kind"].alias("kind"), (x["start"] >= a["at"]).alias("head"))
        return F.struct(far.alias("at"), F.concat(a["out"], F.array(one)).alias("out"))

    out = out.withColumn(spans, _folded(ordered, mark, "struct<start:int,end:int,kind:string,head:boolean>"))
    out = out.withColumn(heads, F.filter(F.transform(s, lambda x, i: F.when(x["head"], i)), lambda i: i.isNotNull()))
    # (low, start, end, kind): what stands before the replacement begins at low.
    out = out.withColumn(spans, F.transform(h, lambda i, k: F.struct(
        F.coalesce(F.get(s, i - 1)["end"], F.lit(0)).alias("low"), F.get(s, i)["start"].alias("start"),
        F.get(s, F.coalesce(F.get(h, k + 1), F.size(s)) - 1)["end"].alias("end"), F.get(s, i)["kind"].alias("kind"))))
    pieces = _read(t, s, lambda x: x["low"], lambda x: x["start"], lambda part, at, x: F.concat(
        F.substring(part, x["low"] - at + 1, x["start"] - x["low"]), F.lit("<"), F.upper(x["kind"]), F.lit(">")))
    tail = F.substring(t, F.element_at(s, -1)["end"] + 1, F.length(t))
    clean = F.when(F.size(s) > 0, F.concat(F.array_join(pieces, ""), tail)).otherwise(t)
    return out.withColumn(text, F.explode(F.array(clean))).select(*(F.col(f"`{c}`") for c in own))
