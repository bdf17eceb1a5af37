import math
import random
import re

import pytest
from pyspark.sql import functions as F

from marginfold.llm.quality_rules import RULES, RiskControl, apply_rules, binomial_at_most, cutoffs, measures

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    words = WORD.findall(text or "")
    trios = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    places = {p for i, trio in enumerate(trios) if trios.count(trio) > 1 for p in (i, i + 1, i + 2)}
    lines = [line for line in (text or "").split("\n") if WORD.search(line)]
    n_symbols = sum(c in "#*$%&|<>" for c in text or "")
    failed = len(words) < 50 or 100 * len(places) > 50 * len(words)
    return len(words), sum(map(len, words)), n_symbols, len(lines) - len(set(lines)), len(places), failed


def _texts():
    rng = random.Random(2)
    texts = [None, "", " \t\n ", "one", "a b c a b c", "a a a a", "x\ny\nx\n \n \nx", "é\u00a0ü 🙂 *#<>", "w " * 60, "long " * 40000]
    return texts + [" ".join(rng.choices("abcdefgh", k=rng.randrange(200))) for _ in range(40)]


def test_measures_equal_brute_force(spark):
    texts = _texts()
    frame = spark.createDataFrame([(i, t, None, 1) for i, t in enumerate(texts)] + [(None, "a b", "x", 1)], "doc_id long, text string, lang string, n_words int")
    got = {r["doc_id"]: r for r in measures(frame).collect()}
    assert len(got) == len(texts) + 1
    for i, text in enumerate(texts[:9] + texts[10:]):
        i += i >= 9
        r = got[i]
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"], r["base_failed"]) == brute(text), text
    assert got[9]["n_words"] == got[9]["n_repeat_words"] == 40000 and got[9]["base_failed"]
    assert got[None]["stratum"] == "x" and got[0]["stratum"] == "none"


@pytest.mark.parametrize(("n", "share"), [(1, 0.1), (50, 0.025), (1000, 0.025), (20000, 0.01), (3_000_000, 0.0125)])
def test_binomial_tail_is_exact(spark, n, share):
    mean = int(n * share)
    ks = sorted({0, 1, mean // 2, max(0, mean - 3), mean, n} | ({mean - 5 * int(math.sqrt(mean))} if mean > 30 else set()))
    frame = spark.createDataFrame([(k, n) for k in ks], "k long, n long")
    for k, _, p in frame.withColumn("p", binomial_at_most(F.col("k"), F.col("n"), share)).collect():
        term = lambda i: math.exp(math.lgamma(n + 1) - math.lgamma(i + 1) - math.lgamma(n - i + 1) + i * math.log(share) + (n - i) * math.log1p(-share))
        expected = 1.0 if k >= n * share else math.fsum(term(i) for i in range(max(0, k - 20000), k + 1))
        assert p == pytest.approx(expected, rel=1e-6)


def _labelled(spark, n, bad_symbols, good_symbols):
    rng = random.Random(n)
    rows, labels = [], []
    for i in range(n):
        bad = i % 5 == 0
        words = [f"{w}{'#' * (rng.random() < (bad_symbols if bad else good_symbols))}" for w in rng.sample(range(10**6), 80)]
        rows.append((i, " ".join(words), "en"))
        labels.append((i, 0 if bad else 1, "extra"))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    return docs, spark.createDataFrame(labels + [labels[0], (None, 1, ""), (5, None, "")], "doc_id long, quality int, text string")


def test_cutoffs_reject_the_bad_and_keep_the_good(spark):
    docs, labels = _labelled(spark, 500, 0.9, 0.02)
    judged = apply_rules(docs, labels).join(labels.select("doc_id", "quality").dropna().distinct(), "doc_id")
    rejected = dict(judged.groupBy("quality").agg(F.avg((~F.col("kept")).cast("double"))).collect())
    assert rejected[0] == 1.0 and rejected[1] <= 0.1


def test_too_few_labels_reject_nothing(spark):
    docs, labels = _labelled(spark, 60, 0.9, 0.0)
    assert cutoffs(measures(docs), labels).count() == 0
    assert apply_rules(docs, labels).where("kept").count() == 60
    assert apply_rules(docs, labels.limit(0)).where("kept").count() == 60
    assert apply_rules(docs.limit(0), labels).count() == 0


def test_false_rejections_are_limited(spark):
    """Bad documents look like good ones: cutoffs that reject too many good ones are not certified."""
    docs, labels = _labelled(spark, 600, 0.3, 0.3)
    control = RiskControl(limit=0.2, error=0.1)
    for r in cutoffs(measures(docs), labels, control).collect():
        assert r["k_good"] / r["n_good"] < control.limit / len(RULES)
