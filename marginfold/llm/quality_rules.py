"""Quality rules with cutoffs whose share of falsely rejected good documents is bounded with confidence.

Per stratum (language) and rule, cutoffs are tested from lenient to strict on labelled documents: an
exact binomial test must refute that more than ``limit`` of the good documents pass the cutoff.
The order of the tests is fixed and they end with the first that does not succeed, so the cutoffs of
one rule need no correction; across rules and strata the level is divided by their number
(Bonferroni). The limit is divided by the number of rules, so that it holds for all rules together.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from marginfold.sources.scratch import written

LEAST_WORDS = 50
MOST_REPEATED_PERCENT = 50


@dataclass(frozen=True)
class RiskControl:
    """At most ``limit`` of each stratum's good documents are rejected, with confidence 1 - ``error``."""

    limit: float = 0.1
    error: float = 0.1


# Rules by name, with their cutoffs from lenient to strict: documents above the cutoff are rejected.
RULES: dict[str, tuple[float, ...]] = {
    "symbols_per_word": (2.0, 1.5, 1.0, 0.75, 0.5, 0.3, 0.2, 0.1, 0.05),
    "capital_share": (0.9, 0.75, 0.6, 0.5, 0.4, 0.3, 0.2, 0.1),
    "repeated_share": (0.5, 0.4, 0.3, 0.25, 0.2, 0.15, 0.1),
    "repeated_line_share": (0.9, 0.7, 0.5, 0.4, 0.3, 0.2, 0.1),
}


def _repeated_words(words: Column, n_words: Column) -> Column:
    """How many words lie in three-word windows that occur twice or more in the text."""
    starts = F.sequence(F.lit(0), n_words - 3)
    hashes = F.transform(starts, lambda i: F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)))

    def covered(h: Column) -> Column:
        # Windows in the order of their hashes: equal ones are neighbours.
        ordered = F.array_sort(F.transform(h, lambda x, i: F.struct(x.alias("hash"), i.alias("at"))))

        def repeats(s: Column) -> Column:
            same = F.transform(
                s,
                lambda x, j: F.when(
                    (F.get(s, j - 1)["hash"] == x["hash"]) | (F.get(s, j + 1)["hash"] == x["hash"]), x["at"]
                ),
            )
            at = F.array_compact(same)
            return F.size(F.array_distinct(F.flatten(F.array(at, F.transform(at, lambda a: a + 1), F.transform(at, lambda a: a + 2)))))

        return F.transform(F.array(ordered), repeats)[0]

    def count(h: Column) -> Column:
        return F.when(F.size(F.array_distinct(h)) < F.size(h), covered(h)).otherwise(0)

    return F.when(n_words >= 4, F.transform(F.array(hashes), count)[0]).otherwise(0)


def measures(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text, lang): the counts, what the rules measure, and stratum.

    Words are runs of characters other than ASCII white space; a null text has none. Lines count if
    they have a word. The stratum is the language, or ``none``.
    """
    text = F.coalesce("text", F.lit(""))
    base = docs.select(
        "doc_id",
        F.coalesce("lang", F.lit("none")).alias("stratum"),
        text.alias("text"),
        F.regexp_extract_all(text, F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0)).alias("words"),
    )
    lines = F.filter(F.split("text", "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    counted = base.select(
        "doc_id",
        "stratum",
        "words",
        F.size("words").alias("n_words"),
        F.length(F.array_join("words", "")).cast("bigint").alias("word_chars"),
        F.regexp_count("text", F.lit("[#*$%&|<>]")).cast("bigint").alias("n_symbols"),
        F.length(F.regexp_replace("text", "[^A-Z]+", "")).alias("n_capitals"),
        lines.alias("lines"),
    )
    n_words = F.col("n_words")
    return counted.select(
        "doc_id",
        "stratum",
        n_words.cast("bigint").alias("n_words"),
        "word_chars",
        "n_symbols",
        "n_capitals",
        F.size("lines").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("bigint").alias("n_dup_lines"),
        _repeated_words(F.col("words"), n_words).cast("bigint").alias("n_repeat_words"),
    ).withColumns(
        {
            "base_failed": (n_words < LEAST_WORDS)
            | (F.lit(100) * F.col("n_repeat_words") > F.lit(MOST_REPEATED_PERCENT) * n_words),
            "symbols_per_word": _share("n_symbols", "n_words"),
            "capital_share": _share("n_capitals", "word_chars"),
            "repeated_share": _share("n_repeat_words", "n_words"),
            "repeated_line_share": _share("n_dup_lines", "n_lines"),
        }
    )


def _share(part: str, whole: str) -> Column:
    return F.col(part).cast("double") / F.greatest(F.col(whole), F.lit(1)).cast("double")


def _log_factorial(n: Column) -> Column:
    """Stirling's series for n + 8, exact to double precision, brought back by seven factors."""
    z = n + 8.0
    series = 1 / (12 * z) - 1 / (360 * z**3) + 1 / (1260 * z**5)
    factors = (n + 1.0) * (n + 2.0) * (n + 3.0) * (n + 4.0) * (n + 5.0) * (n + 6.0) * (n + 7.0)
    return (z - 0.5) * F.log(z) - z + 0.5 * math.log(2 * math.pi) + series - F.log(factors)


def binomial_at_most(k: Column, n: Column, share: float) -> Column:
    """P(X <= k) for X binomial of n trials, where k is below the mean; 1 where it is not.

    Terms are summed down from k. Each is smaller than the one above it, and those farther than twelve
    standard deviations are too small for double precision.
    """
    k, n = k.cast("double"), n.cast("double")
    top = (
        _log_factorial(n) - _log_factorial(k) - _log_factorial(n - k) + k * math.log(share) + (n - k) * math.log1p(-share)
    )
    reach = F.least(k, F.ceil(F.sqrt(n * share) * 12 + 60).cast("double")).cast("int")
    odds = (1 - share) / share

    def add(state: Column, step: Column) -> Column:
        i = k - step.cast("double")
        term = state["term"] * (i + 1) / (n - i) * odds
        return F.struct((state["sum"] + term).alias("sum"), term.alias("term"))

    start = F.struct(F.lit(1.0).alias("sum"), F.lit(1.0).alias("term"))
    total = F.aggregate(F.when(reach >= 1, F.sequence(F.lit(1), reach)).otherwise(F.array().cast("array<int>")), start, add)
    return F.when(k >= n * share, F.lit(1.0)).otherwise(F.exp(top) * total["sum"])


def cutoffs(measured: DataFrame, labels: DataFrame, control: RiskControl = RiskControl(), rules=RULES) -> DataFrame:
    """(stratum, rule, cutoff, n_good, k_good, k_bad): the chosen cutoff where one can be certified.

    Documents labelled 0 or 1 that pass the base rules are the holdout: nothing is fitted to them but
    the choice among certified cutoffs, which goes to the one that rejects most bad documents less
    good ones, then the most lenient. Of several labels of a document the least counts.
    """
    labelled = labels.where("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy("doc_id").agg(F.min("quality").alias("quality"))
    holdout = measured.where("NOT base_failed").join(labelled, "doc_id")
    tests = [(rule, place, cutoff) for rule, values in rules.items() for place, cutoff in enumerate(values)]
    good, bad = F.col("quality") == 1, F.col("quality") == 0
    counted = written(
        holdout.groupBy("stratum").agg(
            F.count_if(good).alias("n_good"),
            *[F.count_if(good & (F.col(r) > c)).alias(f"good_{r}_{p}") for r, p, c in tests],
            *[F.count_if(bad & (F.col(r) > c)).alias(f"bad_{r}_{p}") for r, p, c in tests],
        )
    )
    long = counted.select(
        "stratum",
        "n_good",
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(r).alias("rule"),
                        F.lit(p).alias("place"),
                        F.lit(c).alias("cutoff"),
                        F.col(f"good_{r}_{p}").alias("k_good"),
                        F.col(f"bad_{r}_{p}").alias("k_bad"),
                    )
                    for r, p, c in tests
                ]
            )
        ),
    )
    level = control.error / (len(rules) * max(1, counted.count()))
    passes_too_often = binomial_at_most(F.col("k_good"), F.col("n_good"), control.limit / len(rules)) > level
    tested = long.withColumn("fails", passes_too_often)
    in_order = Window.partitionBy("stratum", "rule").orderBy("place")
    certified = tested.withColumn("failed", F.max("fails").over(in_order)).where("NOT failed")
    return certified.groupBy("stratum", "rule").agg(
        F.max(
            F.struct(
                (F.col("k_bad") - F.col("k_good")).alias("gain"),
                (-F.col("place")).alias("lenient"),
                "cutoff",
                "n_good",
                "k_good",
                "k_bad",
            )
        ).alias("best")
    ).select("stratum", "rule", "best.cutoff", "best.n_good", "best.k_good", "best.k_bad")


def apply_rules(docs: DataFrame, labels: DataFrame, control: RiskControl = RiskControl(), rules=RULES) -> DataFrame:
    """``measures`` of every row of ``docs`` with ``kept``.

    ``kept`` is false for documents of fewer than 50 words or with more than half of the words in
    repeated windows, and for those above a certified cutoff of their stratum. A stratum or rule
    without enough labelled documents has no cutoff and rejects nothing. Repeated rows repeat, null
    ids stay, columns besides doc_id, text and lang are ignored; the measures are written to the
    shared folder once.
    """
    measured = written(measures(docs))
    chosen = cutoffs(measured, labels, control, rules)
    per_stratum = chosen.groupBy(F.col("stratum").alias("of_stratum")).agg(
        *[F.max(F.when(F.col("rule") == rule, F.col("cutoff"))).alias(f"most_{rule}") for rule in rules]
    )
    joined = measured.join(per_stratum, F.col("stratum") == F.col("of_stratum"), "left").drop("of_stratum")
    passes = [F.coalesce(F.col(rule) <= F.col(f"most_{rule}"), F.lit(True)) for rule in rules]
    kept = ~F.col("base_failed")
    for passed in passes:
        kept = kept & passed
    return joined.withColumn("kept", kept).drop(*[f"most_{rule}" for rule in rules])
