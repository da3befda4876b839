"""Quality rules: document measures and a learned decision list, in SQL functions only.

``measured`` computes the measures of a text inside its own row: no shuffle, no
Python.  ``learn`` fits an ordered list of threshold conjunctions by sequential
covering (grow a rule on one part of the labelled rows, prune it on the other,
take away the rows it covers, repeat).  Every step tries all cuts between two
neighbouring values of a measure on the rows that are still left, as running counts
over the labelled rows' values, and the driver sees the best cut only.  ``judge``
turns the list into one ordered Spark conditional.

Defined results for odd input: a null or empty text has no words, so all counts
are 0 and the base test fails it; repeated rows are measured each on their own;
labels without a document, an id or a quality are not learned from, and of
several labels for one id the smallest counts; without usable labels the list is
empty and the base test alone decides; further columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablekit.llm.common import Staging

#: Labelled documents that a list is learned from at most (by hash of their ids).
MAX_LABELLED = 20_000
#: Conditions in a rule, rules in a list.
MAX_CONDITIONS, MAX_RULES = 3, 8
#: A rule must be this precise on the rows it was not grown on, and cover so many there.
MIN_PRECISION, MIN_COVER = 0.98, 5

SPACE = r"[\x20\x09-\x0D]+"
#: Measures that rules may test; each is a ratio, so long and short texts compare.
MEASURES = ("symbol_ratio", "upper_ratio", "bang_ratio", "digit_ratio", "dup_line_ratio",
            "repeat_ratio", "distinct_ratio", "mean_word_chars")


@dataclass(frozen=True)
class Condition:
    """``measure >= bound`` or ``measure < bound``."""

    measure: str
    above: bool
    bound: float

    def column(self, measures: Column) -> Column:
        x = measures[self.measure]
        return x >= F.lit(self.bound) if self.above else x < F.lit(self.bound)

    def __str__(self) -> str:
        return f"{self.measure} {'>=' if self.above else '<'} {self.bound:.6g}"


@dataclass(frozen=True)
class Rule:
    """A conjunction that rejects a document, with its counts on the held-back rows."""

    conditions: tuple[Condition, ...]
    bad: int = field(compare=False, default=0)
    good: int = field(compare=False, default=0)

    def column(self, measures: Column) -> Column:
        out = F.lit(True)
        for c in self.conditions:
            out = out & c.column(measures)
        return out

    def __str__(self) -> str:
        return " and ".join(map(str, self.conditions))


def measured(docs: DataFrame, text: str = "text", into: str = "measures") -> DataFrame:
    """``docs`` plus a struct column ``into`` with counts and ratios of the text.

    The steps are separate projections, as a later one uses an earlier one's array
    more than once per element; their names start with ``into``.
    """
    step = {k: f"{into}__{k}" for k in ("text", "words", "hashes", "grams", "sorted", "at", "lines")}
    c = {k: F.col(f"`{v}`") for k, v in step.items()}
    size = lambda a: F.greatest(F.size(a), F.lit(0))
    without = lambda pattern: F.length(c["text"]) - F.length(F.regexp_replace(c["text"], pattern, ""))
    out = docs.withColumn(step["text"], F.coalesce(F.col(f"`{text}`"), F.lit("")))
    out = (out.withColumn(step["words"], F.array_remove(F.split(c["text"], SPACE), ""))
           .withColumn(step["lines"], F.filter(F.split(c["text"], "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")))
           .withColumn(step["hashes"], F.transform(c["words"], lambda w: F.xxhash64(w))))
    h = c["hashes"]
    out = out.withColumn(step["grams"], F.transform(
        F.slice(h, 1, F.greatest(F.size(h) - 4, F.lit(0))),
        lambda x, i: F.xxhash64(x, h[i + 1], h[i + 2], h[i + 3], h[i + 4])))
    # Only a text with a repeated window pays for the sort by window.
    g = c["grams"]
    out = out.withColumn(step["sorted"], F.when(
        F.size(F.array_distinct(g)) < F.size(g),
        F.sort_array(F.transform(g, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))))
    s = c["sorted"]
    same = lambda x, k: ((k > 0) & (F.get(s, k - 1)["h"] == x["h"])) | F.coalesce(
        F.get(s, k + 1)["h"] == x["h"], F.lit(False))
    out = out.withColumn(step["at"], F.sort_array(F.transform(
        F.filter(s, same), lambda x: x["i"])))
    at = c["at"]
    repeated = F.coalesce(F.aggregate(
        F.transform(at, lambda x, k: F.least(F.lit(5), F.coalesce(F.get(at, k + 1) - x, F.lit(5)))),
        F.lit(0), lambda a, x: a + x), F.lit(0))
    counts = F.struct(
        size(c["words"]).cast("long").alias("n_words"),
        F.length(F.array_join(c["words"], "")).cast("long").alias("word_chars"),
        without(r"[#*$%&|<>]+").cast("long").alias("n_symbols"),
        (size(c["lines"]) - size(F.array_distinct(c["lines"]))).cast("long").alias("n_dup_lines"),
        repeated.cast("long").alias("n_repeat_words"),
        size(c["lines"]).cast("long").alias("n_lines"),
        size(F.array_distinct(c["words"])).cast("long").alias("n_distinct"),
        without(r"[A-Z]+").cast("long").alias("n_upper"),
        without(r"[!?]+").cast("long").alias("n_bang"),
        without(r"[0-9]+").cast("long").alias("n_digit"))
    # The one-element explode keeps the optimizer from copying these expressions into
    # filters on the result, where each copy would be evaluated again.
    out = out.withColumn(into, F.explode(F.array(counts)))
    m = F.col(f"`{into}`")
    per = lambda a, b: F.coalesce(F.try_divide(m[a].cast("double"), m[b]), F.lit(0.0))
    ratios = dict(symbol_ratio=per("n_symbols", "n_words"), upper_ratio=per("n_upper", "word_chars"),
                  bang_ratio=per("n_bang", "n_words"), digit_ratio=per("n_digit", "word_chars"),
                  dup_line_ratio=per("n_dup_lines", "n_lines"), repeat_ratio=per("n_repeat_words", "n_words"),
                  distinct_ratio=per("n_distinct", "n_words"), mean_word_chars=per("word_chars", "n_words"))
    return out.withColumn(into, F.struct(F.col(f"`{into}`.*"), *(ratios[k].alias(k) for k in MEASURES))).drop(*step.values())


def base_failed(m: Column) -> Column:
    """The fixed test: too few words, or over a fifth of them in repeated windows."""
    return (m["n_words"] < 10) | (100 * m["n_repeat_words"] > 20 * m["n_words"])


def labelled_measures(docs: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED) -> DataFrame:
    """(bad, held, m.<measures>) of labelled texts that pass the base test.

    At most ``max_labelled`` rows: a text under an id counts once, however often it occurs.
    """
    known = (labels.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull())
             .groupBy(F.col("doc_id").alias("label_id")).agg(F.min("quality").alias("quality"))
             .orderBy(F.xxhash64("label_id"), "label_id").limit(max_labelled))
    # At most max_labelled pairs of numbers, so the broadcast is bounded.
    rows = docs.select("doc_id", "text").join(F.broadcast(known), F.col("doc_id") == F.col("label_id")).select(
        "label_id", "quality", "text", F.sha2(F.coalesce("text", F.lit("")), 256).alias("hash"))
    # One row for each text under an id, and at most max_labelled of them by hash: an id
    # that very many rows share brings in no more.
    place = F.xxhash64("label_id", "hash")
    some = rows.select("label_id", "hash").distinct().orderBy(place, "label_id", "hash").limit(max_labelled)
    rows = rows.join(F.broadcast(some), ["label_id", "hash"]).groupBy("label_id", "hash").agg(
        F.first("quality").alias("quality"), F.first("text").alias("text"))
    rows = measured(rows.select("label_id", "quality", "text"), into="m")
    return rows.where(~base_failed(F.col("m"))).select(
        (F.col("quality") == 0).alias("bad"),
        (F.pmod(F.xxhash64(F.col("label_id"), F.lit("held")), F.lit(3)) == 0).alias("held"), "m")


def learn(docs: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED,
          min_precision: float = MIN_PRECISION, min_cover: int = MIN_COVER) -> list[Rule]:
    """An ordered list of rules that reject documents."""
    staging = Staging(docs.sparkSession, "quality-rules")
    rows = staging.put("labelled", labelled_measures(docs, labels, max_labelled))
    m = F.col("m")
    rules: list[Rule] = []
    while len(rules) < MAX_RULES:
        left = rows
        for rule in rules:
            left = left.where(~rule.column(m))
        grown = _grow(left.where(~F.col("held")))
        rule = _prune(left.where(F.col("held")), grown)
        if rule is None or rule.bad < min_cover or rule.bad < min_precision * (rule.bad + rule.good):
            break
        rules.append(rule)
    staging.drop("labelled")
    return rules


def _grow(rows: DataFrame) -> tuple[Condition, ...]:
    """Add the condition of highest information gain until no good row is covered."""
    rule: tuple[Condition, ...] = ()
    while len(rule) < MAX_CONDITIONS:
        best = _best_cut(rows.where(Rule(rule).column(F.col("m"))))
        if best is None:
            break
        rule += (best,)
    return rule


def _best_cut(rows: DataFrame) -> Condition | None:
    """The condition of highest information gain among all cuts between neighbouring values;
    none if no cut gains, as when only one class is left."""
    values = F.array(*(F.struct(F.lit(i).alias("measure"), F.col("m")[k].alias("value")) for i, k in enumerate(MEASURES)))
    counts = (rows.select("bad", F.explode(values).alias("v")).groupBy("v.measure", "v.value")
              .agg(F.count_if("bad").alias("bad"), F.count_if(~F.col("bad")).alias("good")))
    # One row per distinct value of the bounded sample, so a measure's window is bounded too.
    whole = Window.partitionBy("measure")
    below = whole.orderBy("value").rowsBetween(Window.unboundedPreceding, -1)
    c = {k: F.col(k) for k in ("bad", "good", "all_bad", "all_good", "below_bad", "below_good", "last", "value")}
    cuts = counts.select(
        "measure", "value", F.max("value").over(below).alias("last"),
        *(F.sum(k).over(w).alias(f"{name}_{k}") for name, w in (("below", below), ("all", whole)) for k in ("bad", "good")))
    sides = F.array(*(F.struct(F.lit(above).alias("above"), p.alias("p"), n.alias("n")) for above, p, n in (
        (True, c["all_bad"] - c["below_bad"], c["all_good"] - c["below_good"]), (False, c["below_bad"], c["below_good"]))))
    # The middle, or the upper value where the middle rounds to the lower one.
    middle = c["last"] + (c["value"] - c["last"]) / 2
    bound = F.when(middle > c["last"], middle).otherwise(c["value"])
    share = lambda p, n: F.log2(p / (p + n))
    gain = F.col("s.p") * (share(F.col("s.p"), F.col("s.n")) - share(c["all_bad"], c["all_good"]))
    best = (cuts.where("last IS NOT NULL AND all_bad > 0 AND all_good > 0")
            .select("measure", bound.alias("bound"), "all_bad", "all_good", F.explode(sides).alias("s"))
            .where("s.p > 0").withColumn("gain", F.round(gain, 9)).where("gain > 0")
            .agg(F.max(F.struct("gain", -F.col("measure"), -F.col("bound"), F.col("s.above")))).first()[0])
    return None if best is None else Condition(MEASURES[-best[1]], best[3], -best[2])


def _prune(rows: DataFrame, rule: tuple[Condition, ...]) -> Rule | None:
    """The prefix of the rule that separates the held-back rows best, with its counts."""
    if not rule:
        return None
    hits = [Rule(rule[:n + 1]).column(F.col("m")) for n in range(len(rule))]
    got = rows.agg(*(F.count_if(h & F.col("bad")).alias(f"bad{i}") for i, h in enumerate(hits)),
                   *(F.count_if(h & ~F.col("bad")).alias(f"good{i}") for i, h in enumerate(hits))).first()
    found = [Rule(rule[:i + 1], got[f"bad{i}"], got[f"good{i}"]) for i in range(len(rule))]
    worth = lambda r: (r.bad - r.good) / max(1, r.bad + r.good)
    return max(found, key=lambda r: (worth(r), -len(r.conditions)))


def rejected_by(rules: list[Rule], m: Column) -> Column:
    """The list as an ordered conditional: the number of the first rule that holds, else null."""
    out = None
    for i, rule in enumerate(rules):
        out = (F.when if out is None else out.when)(rule.column(m), F.lit(i + 1))
    return F.lit(None).cast("int") if out is None else out


def judge(docs: DataFrame, rules: list[Rule], text: str = "text", into: str = "verdict") -> DataFrame:
    """``docs`` plus the struct ``into``: the measures, base_failed, rule and kept."""
    m = F.col(f"`{into}`")
    out = measured(docs, text, into)
    rule = F.when(~base_failed(m), rejected_by(rules, m))
    return (out.withColumn(into, F.struct(F.col(f"`{into}`.*"), base_failed(m).alias("base_failed"), rule.alias("rule")))
            .withColumn(into, F.struct(F.col(f"`{into}`.*"), (~m["base_failed"] & m["rule"].isNull()).alias("kept"))))


def score_quality(docs: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED) -> DataFrame:
    """One row per document: its counts, base_failed, the rejecting rule and kept."""
    rules = learn(docs, labels, max_labelled)
    v = F.col("verdict")
    return judge(docs.select("doc_id", "text"), rules).select(
        "doc_id", *(v[k].alias(k) for k in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                                   "base_failed", "kept", "rule")))
