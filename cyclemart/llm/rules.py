"""Quality rules with risk-controlled cutoffs, in DataFrame functions only.

Fixed rules of thumb reject what is hardly text. Beyond them each measure of a document (symbols, repeated lines, repeated
words, word length) is a rule with a cutoff per stratum. The cutoffs come from labelled documents: a cutoff may be used if an
exact binomial test shows that it rejects no more than its share of ``risk`` of the good documents of the stratum. Cutoffs of a
rule are tried from the mildest on, so they need no correction among themselves; rules and strata are corrected for by their
number (Bonferroni). With probability ``1 - failure`` over the draw of the labels, the rules together then reject at most
``risk`` of the good documents of every stratum that pass the fixed rules. Among the cutoffs allowed the one that tells
bad from good best is taken, none if all do harm.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cyclemart.llm.common import held_out, materialise

SPACE = r"[\x20\x09-\x0D]"
SPACES = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
#: Statistics are whole numbers from 0 to this, so that a stratum's histogram has a bounded size.
SCALE = 1000
#: A statistic per rule; a document is rejected if it lies above the cutoff.
RULES = ("symbols", "repeated_lines", "repeated_words", "word_length")


@dataclass(frozen=True)
class RuleSettings:
    """``window`` words count as repeated together. ``risk`` is the share of good documents that the rules together may
    reject in a stratum, ``failure`` the chance that this does not hold, ``harm`` how many bad documents a good one weighs
    when a cutoff is chosen."""

    window: int = 5
    least_words: int = 10
    repeat_percent: int = 20
    risk: float = 0.02
    failure: float = 0.05
    harm: float = 10.0


def measures(docs: DataFrame, keep: Sequence[str | Column], s: RuleSettings = RuleSettings(), text: str = "text") -> DataFrame:
    """The kept columns and ``n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words, base_failed``, one row per row.

    Words are what white space (U+0020, U+0009 to U+000D) separates. ``n_lines`` counts the lines with a word, ``n_dup_lines``
    those equal to an earlier one, ``n_repeat_words`` the words inside windows found twice or more. A null text counts as
    empty: no words, so it fails. Windows are told apart by 64-bit hashes. All work is done inside the row; only texts
    with a repeated window are sorted.
    """
    t = F.coalesce(F.col(text).cast("string"), F.lit(""))
    kept = [F.col(c) if isinstance(c, str) else c for c in keep]
    names = [f"_keep_{k}" for k in range(len(kept))]
    out = docs.select(*[c.alias(n) for c, n in zip(kept, names, strict=True)], t.alias("_text"))
    final = docs.select(*kept).columns
    out = out.select(
        *names,
        F.length(F.translate("_text", SPACES, "")).cast("long").alias("word_chars"),
        (F.length("_text") - F.length(F.translate("_text", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        F.filter(F.split("_text", "\n"), lambda x: F.length(F.translate(x, SPACES, "")) > 0).alias("_lines"),
        F.array_remove(F.split("_text", f"{SPACE}+"), "").alias("_words"),
    )
    last = s.window - 1
    grams = F.transform(F.slice("_words", 1, F.greatest(F.size("_words") - last, F.lit(0))), lambda x, i: F.xxhash64(
        x, *[F.get("_words", i + k) for k in range(1, s.window)]))
    out = out.select(*names, "word_chars", "n_symbols", F.size("_lines").cast("long").alias("n_lines"),
                     (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
                     F.size("_words").cast("long").alias("n_words"), grams.alias("_grams"))
    counted = ("word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_words")
    # Equal windows meet by sorting; what has none repeated is not sorted.
    ordered = F.when(F.size(F.array_distinct("_grams")) < F.size("_grams"), F.sort_array(
        F.transform("_grams", lambda h, i: F.struct(h.alias("h"), i.alias("i")))))
    out = out.select(*names, *counted, ordered.alias("_ordered"))

    def like(at: Column, gram: Column) -> Column:
        return F.coalesce(F.get("_ordered", at)["h"] == gram["h"], F.lit(False))

    twice = F.filter("_ordered", lambda g, i: like(i - 1, g) | like(i + 1, g))
    out = out.select(*names, *counted, F.sort_array(F.transform(twice, lambda g: g["i"])).alias("_at"))
    covered = F.aggregate(
        F.transform("_at", lambda p, i: F.least(F.lit(s.window), F.coalesce(F.get("_at", i + 1) - p, F.lit(s.window)))),
        F.lit(0).cast("long"), lambda done, x: done + x)
    out = out.select(*names, *counted, F.coalesce(covered, F.lit(0)).alias("n_repeat_words"))
    failed = (F.col("n_words") < s.least_words) | (100 * F.col("n_repeat_words") > s.repeat_percent * F.col("n_words"))
    return out.select(*[F.col(n).alias(c) for n, c in zip(names, final, strict=True)], "n_words", "word_chars", "n_symbols",
                      "n_lines", "n_dup_lines", "n_repeat_words", failed.alias("base_failed"))


def statistics() -> dict[str, Column]:
    """What each rule compares with its cutoff, from the columns of ``measures``."""
    def share(part: str, whole: str, scale: int) -> Column:
        value = F.try_divide(scale * F.col(part).cast("decimal(19,0)"), F.col(whole).cast("decimal(19,0)"))
        return F.least(F.coalesce(F.floor(value), F.lit(0)), F.lit(SCALE)).cast("int")

    return {
        "symbols": share("n_symbols", "word_chars", SCALE),
        "repeated_lines": share("n_dup_lines", "n_lines", SCALE),
        "repeated_words": share("n_repeat_words", "n_words", SCALE),
        "word_length": share("word_chars", "n_words", 10),
    }


def _log_factorial(n: Column) -> Column:
    """Logarithm of n!: exact to 20, beyond by Stirling's series, whose error is below 1e-12 there."""
    x = n.cast("double")
    series = x * F.log(x) - x + 0.5 * F.log(2 * math.pi * x) + 1 / (12 * x) - 1 / (360 * x**3) + 1 / (1260 * x**5)
    return F.when(n <= 20, F.log(F.factorial(F.least(n, F.lit(20)).cast("int")).cast("double"))).otherwise(series)


def binomial_tail(k: Column, n: Column, p: float) -> Column:
    """P(X <= k) for X of n trials with chance p; 1 where k reaches the mean, where it is at least a half.

    The terms are added from the k-th down. Each is smaller than the one above by a growing factor, so after some
    standard deviations what is left is below the last term's geometric series, which is added instead.
    """
    k, n = k.cast("long"), n.cast("long")
    top = _log_factorial(n) - _log_factorial(k) - _log_factorial(n - k) + k * math.log(p) + (n - k) * math.log1p(-p)

    def ratio(j: Column) -> Column:
        return j.cast("double") * (1 - p) / ((n - j + 1).cast("double") * p)

    steps = F.least(k, (50 * F.sqrt(n.cast("double") * p) + 100).cast("long"))
    added = F.aggregate(
        F.sequence(F.lit(1).cast("long"), F.greatest(steps, F.lit(1).cast("long"))),
        F.struct(F.lit(1.0).alias("term"), F.lit(1.0).alias("total")),
        lambda done, i: F.struct((done["term"] * ratio(k - i + 1)).alias("term"), (done["total"] + done["term"] * ratio(k - i + 1)).alias("total")))
    rest = F.when(k > steps, added["term"] * ratio(k) / (1 - ratio(k))).otherwise(F.lit(0.0))
    below = k.cast("double") < n.cast("double") * p
    return F.when(below, F.least(F.lit(1.0), F.exp(top) * (added["total"] + rest))).otherwise(F.lit(1.0))


def cutoffs(measured: DataFrame, labels: DataFrame, strata: Sequence[str], s: RuleSettings = RuleSettings(), doc_id: str = "doc_id",
            label_id: str = "doc_id", quality: str = "quality") -> DataFrame:
    """``(*strata, rule, cutoff, n_good, n_bad, good_rejected, bad_rejected, p_value)``, a row for each rule in use.

    Learned from all labelled rows that pass the fixed rules and are not held out. A document with several
    labels is good if all say so; null ids and null labels say nothing. A stratum with too few good documents has no rule.
    Histograms are counted before anything is ordered: a stratum has at most ``SCALE + 1`` values per rule.
    """
    known = labels.select(F.col(label_id).alias("_id"), F.col(quality).alias("_good")).where("_id IS NOT NULL AND _good IS NOT NULL")
    known = known.where(~held_out("_id")).groupBy("_id").agg(F.min("_good").alias("_good"))
    rows = measured.where(~F.col("base_failed")).join(known, F.col(doc_id) == F.col("_id"))
    pairs = F.array(*[F.struct(F.lit(rule).alias("rule"), value.alias("value")) for rule, value in statistics().items()])
    counted = rows.select(*strata, F.col("_good") == 1, F.inline(pairs)).toDF(*strata, "_good", "rule", "value").groupBy(
        *strata, "rule", "value").agg(F.count_if("_good").alias("good"), F.count_if(~F.col("_good")).alias("bad"))
    counted = materialise(counted, "rules-histogram")
    tests = counted.where("good > 0").agg(F.count_distinct(F.struct(*strata, "rule"))).scalar()
    whole = Window.partitionBy(*strata, "rule")
    above = whole.orderBy(F.desc("value")).rowsBetween(Window.unboundedPreceding, -1)
    tried = counted.select(
        *strata, "rule", F.col("value").alias("cutoff"), F.sum("good").over(whole).alias("n_good"), F.sum("bad").over(whole).alias("n_bad"),
        F.coalesce(F.sum("good").over(above), F.lit(0)).alias("good_rejected"), F.coalesce(F.sum("bad").over(above), F.lit(0)).alias("bad_rejected"))
    tried = tried.withColumn("p_value", binomial_tail(F.col("good_rejected"), F.col("n_good"), s.risk / len(RULES)))
    gain = F.try_divide(F.col("bad_rejected"), F.col("n_bad")) - s.harm * F.try_divide(F.col("good_rejected"), F.col("n_good"))
    allowed = tried.withColumn("_gain", gain).where((F.col("p_value") * tests <= s.failure) & (F.col("_gain") > 0))
    fields = ("cutoff", "n_good", "n_bad", "good_rejected", "bad_rejected", "p_value")
    best = allowed.groupBy(*strata, "rule").agg(F.max(F.struct("_gain", *fields)).alias("_best"))
    return best.select(*strata, "rule", *[F.col(f"_best.{c}").alias(c) for c in fields])


def apply_rules(docs: DataFrame, labels: DataFrame, s: RuleSettings = RuleSettings(), *, doc_id: str = "doc_id", text: str = "text",
                strata: Sequence[str] = ("lang",), quality: str = "quality", label_id: str = "doc_id") -> DataFrame:
    """``doc_id``, the columns of ``measures``, the statistic and cutoff of each rule (null where there is none), and ``kept``.

    One row per row of ``docs``, repeated ids included. A document is kept if it passes the fixed rules and no
    statistic lies above the cutoff of its stratum; null stratum columns count as empty. Without labels the fixed rules
    alone decide. Other columns of ``docs`` and ``labels`` are ignored, whatever their names. Empty tables give an empty result.
    """
    own = [f"_stratum_{k}" for k in range(len(strata))]
    stratum = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(n) for c, n in zip(strata, own, strict=True)]
    measured = measures(docs, [F.col(doc_id).alias("doc_id"), *stratum], s, text)
    measured = materialise(measured.withColumns(statistics()), "rules-measures")
    found = cutoffs(measured, labels, own, s, "doc_id", label_id, quality)
    # One row per stratum: as small as the number of strata.
    lines = found.groupBy(*own).agg(*[F.max(F.when(F.col("rule") == r, F.col("cutoff"))).alias(f"{r}_cutoff") for r in RULES])
    judged = measured.join(lines, own, "left")
    rejected = F.lit(False)
    for rule in RULES:
        rejected = rejected | F.coalesce(F.col(rule) > F.col(f"{rule}_cutoff"), F.lit(False))
    return judged.withColumn("kept", ~F.col("base_failed") & ~rejected).drop(*own)
