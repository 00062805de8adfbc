"""Quality rules with risk-controlled cutoffs: DataFrame functions only.

Every rule rejects documents whose measure exceeds a cutoff. Per stratum and rule, cutoffs are tested from the loosest to
the tightest on labelled good documents: "this cutoff rejects more than ``risk / rules`` of the good ones" is refuted when
the exact binomial probability of as few rejections is at most ``error / (strata * rules)``. Testing stops at the first
cutoff that is not refuted (fixed-sequence testing within a rule, Bonferroni across rules and strata), so with probability
``1 - error`` no stratum loses more than ``risk`` of its good documents. Of the cutoffs that hold, the loosest of those
that catch most labelled bad documents is used; a rule that catches none, or for which no cutoff holds, is off.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.keyed import measured_lookup
from .common import SPACE, stored

BLANKS = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
WINDOW = 8

#: Measure and cutoffs of each rule, from the loosest to the tightest.
RULES: dict[str, tuple[str, tuple[float, ...]]] = {
    "symbols": ("n_symbols / greatest(word_chars, 1)", (0.5, 0.3, 0.2, 0.1, 0.05, 0.02)),
    "capitals": ("n_capitals / greatest(word_chars, 1)", (0.9, 0.7, 0.5, 0.3, 0.2, 0.1)),
    "exclamations": ("n_exclamations / greatest(n_words, 1)", (1.0, 0.7, 0.5, 0.3, 0.2, 0.1)),
    "repeated_lines": ("n_dup_lines / greatest(n_lines, 1)", (0.9, 0.7, 0.5, 0.4, 0.3, 0.2)),
    "repeated_words": ("n_repeat_words / greatest(n_words, 1)", (0.3, 0.25, 0.2, 0.15, 0.1, 0.05)),
}


@dataclass(frozen=True)
class QualityRules:
    risk: float = 0.05
    error: float = 0.05
    min_words: int = 20
    max_repeat_percent: int = 30
    rules: dict[str, tuple[str, tuple[float, ...]]] = field(default_factory=lambda: RULES)

    def __post_init__(self):
        if not (0 < self.risk < 1 and 0 < self.error < 1):
            raise ValueError("risk and error lie between 0 and 1")
        if any(list(c) != sorted(c, reverse=True) for _, c in self.rules.values()):
            raise ValueError("cutoffs go from the loosest to the tightest")


def bound(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` with ``value`` computed once: inside a lambda an outer expression would be computed per element."""
    return F.transform(F.array(value), body)[0]


def repeat_words(words: Column) -> Column:
    """Words in windows of ``WINDOW`` words that occur twice or more in ``words``, the first occurrence included."""
    last = F.size(words) - WINDOW

    def exact(ws: Column) -> Column:
        windows = F.transform(
            F.sequence(F.lit(0), F.size(ws) - WINDOW),
            lambda i: F.struct(F.array_join(F.slice(ws, i + 1, WINDOW), " ").alias("window"), i.alias("start")),
        )

        def repeated(ordered: Column) -> Column:
            same = lambda a, b: F.coalesce(F.get(ordered, a)["window"] == F.get(ordered, b)["window"], F.lit(False))
            found = F.filter(ordered, lambda x, k: same(k, k - 1) | same(k, k + 1))
            return F.array_sort(F.transform(found, lambda x: x["start"]))

        covered = F.aggregate(
            bound(F.array_sort(windows), repeated),
            F.struct(F.lit(0).alias("n"), F.lit(0).alias("end")),
            lambda s, i: F.struct(
                (s["n"] + i + WINDOW - F.greatest(i, s["end"])).alias("n"), (i + WINDOW).alias("end")
            ),
        )
        return covered["n"]

    def hashed(h: Column) -> Column:
        return F.transform(
            F.sequence(F.lit(0), F.size(h) - WINDOW), lambda i: F.xxhash64(*[F.get(h, i + k) for k in range(WINDOW)])
        )

    # Hashes only tell which texts have no repeated window; the others are compared word by word.
    has = bound(
        bound(F.transform(words, lambda w: F.xxhash64(w)), hashed), lambda h: F.size(F.array_distinct(h)) < F.size(h)
    )
    return F.when(last < 1, 0).when(has, bound(words, exact)).otherwise(0).cast("long")


def measured(docs: DataFrame, stratum: str, how: QualityRules) -> DataFrame:
    """Narrow measures of every text, one row per row of ``docs``."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    base = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col(stratum).cast("string"), F.lit("")).alias("stratum"),
        text.alias("text"),
        F.array_remove(F.split(text, SPACE), "").alias("words"),
        F.filter(F.split(text, "\n"), lambda x: x.rlike("[^\\x20\\x09-\\x0D]")).alias("lines"),
    )
    counts = base.select(
        "doc_id",
        "stratum",
        F.xxhash64("text").alias("version"),
        F.size("words").cast("long").alias("n_words"),
        F.length(F.translate("text", BLANKS, "")).cast("long").alias("word_chars"),
        (F.length("text") - F.length(F.translate("text", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        repeat_words(F.col("words")).alias("n_repeat_words"),
        F.regexp_count("text", F.lit("\\p{Lu}")).cast("long").alias("n_capitals"),
        (F.length("text") - F.length(F.translate("text", "!", ""))).cast("long").alias("n_exclamations"),
    )
    failed = (F.col("n_words") < how.min_words) | (
        F.lit(100) * F.col("n_repeat_words") > F.lit(how.max_repeat_percent) * F.col("n_words")
    )
    return counts.withColumn("base_failed", failed)


def at_most(rejected: Column, total: Column, rate: float) -> Column:
    """Exact P(Binomial(total, rate) <= rejected), summed from logarithms of its terms."""
    odds = F.log(F.lit(rate / (1 - rate)))
    start = total * F.log(F.lit(1 - rate))
    summed = F.aggregate(
        F.when(rejected > 0, F.sequence(F.lit(1).cast("long"), rejected)).otherwise(F.array().cast("array<long>")),
        F.struct(start.alias("term"), F.exp(start).alias("sum")),
        lambda s, j: bound(
            s["term"] + F.log((total - j + 1) / j) + odds,
            lambda t: F.struct(t.alias("term"), (s["sum"] + F.exp(t)).alias("sum")),
        ),
    )
    return summed["sum"]


def cutoffs(measures: DataFrame, labels: DataFrame, how: QualityRules) -> DataFrame:
    """``stratum`` and one column per rule: the cutoff in use, null where the rule is off.

    ``labels`` has ``doc_id`` and ``quality`` (1 good, 0 bad); null labels are none, a document labelled both ways is bad.
    Documents that fail the base rules are no part of the holdout.
    """
    known = labels.filter("quality in (0, 1)").groupBy(F.col("doc_id").cast("long").alias("doc_id"))
    known = known.agg(F.min("quality").alias("_good"))
    held = measures.filter("not base_failed").join(known, "doc_id")
    good, bad = F.col("_good") == 1, F.col("_good") == 0
    counts = [F.count_if(good).alias("n")]
    for name, (measure, steps) in how.rules.items():
        over = lambda c, m=measure: F.expr(m) > F.lit(c)
        counts.append(F.array(*[F.count_if(good & over(c)) for c in steps]).alias(f"{name}_lost"))
        counts.append(F.array(*[F.count_if(bad & over(c)) for c in steps]).alias(f"{name}_caught"))
    strata = stored(held.groupBy("stratum").agg(*counts), "quality-holdout")
    level = how.error / (max(strata.count(), 1) * len(how.rules))
    rate = how.risk / len(how.rules)
    chosen = []
    for name, (_, steps) in how.rules.items():
        lost, caught = F.col(f"{name}_lost"), F.col(f"{name}_caught")
        refuted = F.transform(lost, lambda k: at_most(k, F.col("n"), rate) <= level)
        # Cutoffs before the first that is not refuted.
        holding = F.coalesce(F.array_position(refuted, False) - 1, F.lit(0))
        holding = F.when(F.array_contains(refuted, False), holding).otherwise(len(steps))
        usable = F.slice(caught, F.lit(1), holding.cast("int"))
        best = F.array_max(usable)
        place = F.when((holding > 0) & (best > 0), F.array_position(usable, best))
        chosen.append(F.get(F.array(*[F.lit(c) for c in steps]), (place - 1).cast("int")).alias(name))
    return strata.select("stratum", *chosen)


def quality_rules(
    docs: DataFrame, labels: DataFrame, stratum: str = "lang", how: QualityRules = QualityRules()
) -> DataFrame:
    """Counts, ``base_failed``, ``kept`` and ``reason`` for every row of ``docs`` (``doc_id`` long, ``text``, stratum).

    A document is kept unless it fails the base rules or exceeds a cutoff of its stratum; ``reason`` is ``base``, the
    first rule exceeded, or null; ``version`` is a hash of the text (null as empty). A null text has no words and fails; a null stratum counts as the empty string; a
    stratum without enough labels has no cutoffs. Repeated rows come back as often as they came, a null doc_id stays
    null, other columns are ignored. Without labels only the base rules hold; an empty table gives an empty result.
    """
    measures = stored(measured(docs, stratum, how), "quality-measures")
    limits = cutoffs(measures, labels, how)
    judged = measured_lookup(measures, limits, ["stratum"], ["doc_id"])
    reason = F.when(F.col("base_failed"), F.lit("base"))
    for name, (measure, _) in how.rules.items():
        reason = reason.when(F.expr(measure) > F.col(name), F.lit(name))
    return judged.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        reason.isNull().alias("kept"),
        reason.alias("reason"),
        "version",
    )
