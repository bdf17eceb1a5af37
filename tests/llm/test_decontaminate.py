import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from marginfold.llm.decontaminate import (
    _filter_of,
    _passes,
    build_index,
    clean_documents,
    contamination,
    phrase_matches,
    proximity_matches,
    split_words,
)

WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORDS.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(docs, items):
    out = []
    for doc_id, text in docs:
        have, hit, ids = words(text), set(), set()
        for item_id, item_text in items:
            want = words(item_text)
            k = min(10, len(want))
            windows = {tuple(want[i : i + k]) for i in range(len(want) - k + 1)} if k else set()
            for at in range(len(have) - k + 1 if k else 0):
                if tuple(have[at : at + k]) in windows:
                    hit |= set(range(at, at + k))
                    ids.add(item_id)
        names = sorted(str(i) for i in ids if i is not None)
        out.append((doc_id, len(have), len(hit), len(names), hashlib.sha256(",".join(names).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=str)


def rows(frame):
    return sorted((tuple(r[c] for c in ("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")) for r in frame.collect()), key=str)


def frames(spark, docs, items):
    return (
        spark.createDataFrame([(*d, "x", 3) for d in docs], "doc_id long, text string, term string, position int"),
        spark.createDataFrame([(*i, "y") for i in items], "item_id long, text string, doc string"),
    )


def _cases():
    rng = random.Random(4)
    vocabulary = [f"w{int(rng.paretovariate(0.6)) % 60}" for _ in range(4000)]
    items = [(i, " ".join(rng.choices(vocabulary, k=rng.choice([3, 9, 10, 14, 40])))) for i in range(12)]
    docs = []
    for i in range(60):
        parts = rng.choices(vocabulary, k=rng.randrange(0, 120))
        for _ in range(rng.randrange(3)):
            want = items[rng.randrange(12)][1].split()
            start = rng.randrange(len(want))
            at = rng.randrange(len(parts) + 1)
            parts[at:at] = want[start : start + rng.randrange(1, 30)]
        docs.append((i, rng.choice([" ", "  ", ", ", "\n"]).join(parts)))
    return docs, items


def test_random_texts_equal_brute_force(spark):
    docs, items = _cases()
    assert rows(contamination(*frames(spark, docs, items))) == brute(docs, items)


def test_edge_cases(spark):
    items = [(1, "Alpha beta"), (2, "É une Été"), (3, ""), (4, None), (None, "no id here"), (1, "Alpha beta"), (5, "the " * 12), (7, "one two three four five six seven eight nine ten eleven")]
    docs = [
        (1, "x ALPHA, beta y alpha beta"), (2, "é une Été"), (3, "É UNE Été!"), (4, None), (5, ""), (6, "***"), (None, "alpha beta"), (1, "x ALPHA, beta y alpha beta"),
        (8, "no id here"), (9, "the " * 30), (10, "one two three four five six seven eight nine TEN"), (11, "two three four five six seven eight nine ten"), (12, ("filler " * 30000) + "alpha beta"), (1, "other text"),
    ]
    assert rows(contamination(*frames(spark, docs, items))) == brute(docs, items)
    assert rows(contamination(*frames(spark, docs, []))) == brute(docs, [])
    assert contamination(*frames(spark, [], items)).count() == 0


def test_more_terms_than_a_broadcast_holds(spark):
    docs, items = _cases()
    names = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    for name in names:
        spark.conf.set(name, "-1")
    try:
        frame, benchmark = frames(spark, docs, items)
        assert rows(contamination(frame, benchmark)) == brute(docs, items)
        # What goes into the join with the terms: postings, and no word that is not a term.
        worded = split_words(frame)
        terms = spark.createDataFrame([("w0", True), ("w1", False), ("nowhere", True)], "term string, is_first boolean")
        index = build_index(worded, terms)
        want = sorted((d, p, w) for d, t in docs for p, w in enumerate(words(t)) if w in ("w0", "w1"))
        got = index.collect()
        assert sorted((r["doc_id"], r["position"], r["term"]) for r in got) == want
        texts = {d: words(t) for d, t in docs}
        for r in got:
            at = r["position"]
            assert r["around"] == (texts[r["doc_id"]][max(0, at - 9) : at + 10] if r["term"] == "w0" else None)
    finally:
        for name in names:
            spark.conf.unset(name)


@pytest.mark.parametrize("n", [0, 1, 5000])
def test_filter_passes_every_term_and_few_others(spark, n):
    terms = spark.range(n).select(F.concat(F.lit("t"), "id").alias("term"))
    tried = spark.range(20_000).select("id", F.concat(F.lit("t"), "id").alias("word"))
    passing = {r["id"] for r in tried.where(_passes(F.col("word"), _filter_of(terms))).collect()}
    assert passing >= set(range(n)) and len(passing) <= n + 50


def test_clean_documents_stay(spark):
    docs, items = _cases()
    frame, benchmark = frames(spark, docs + [(None, None)], items)
    kept = clean_documents(frame, benchmark)
    assert kept.columns == frame.columns
    clean = {r[0] for r in brute(docs, items) if not r[-1]} | {None}
    assert {r["doc_id"] for r in kept.collect()} == clean


def test_phrases_and_proximity(spark):
    text = "a b one two three four five six seven eight nine ten c"
    docs = [(1, text), (2, "ten nine eight seven six five four three two one"), (3, "one two")]
    frame, benchmark = frames(spark, docs, [(9, "one two three four five six seven eight nine ten")])
    assert {tuple(r) for r in phrase_matches(frame, benchmark).collect()} == {(1, 9, 2, 11)}
    near = {r["doc_id"] for r in proximity_matches(frame, benchmark).collect()}
    assert near == {1, 2}
