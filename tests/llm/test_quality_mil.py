import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from marginfold.llm import quality_mil
from marginfold.llm.queries import op9_quality_mil
from marginfold.llm.quality_mil import FEATURES, PASSAGE_BYTES, QualityModel, fit, held_out, passages, score_quality, train


def test_passages_cover_the_whole_text():
    assert passages(None).shape == passages("").shape == (0, FEATURES)
    text = "é" * 5000
    rows = passages(text)
    assert len(rows) == -(-len(text.encode()) // PASSAGE_BYTES)
    assert np.isfinite(rows).all()
    assert np.array_equal(passages("a" * 2000 + "b"), passages("a" * 2000 + "b"))
    assert not np.array_equal(passages("a" * 2000)[-1], passages("a" * 1999 + "b")[-1])


def _small_model(rng):
    shapes = {"encode": (FEATURES, 4), "encode_bias": (4,), "attend": (4, 3), "gate": (4, 3), "weigh": (3,), "score": (4,), "score_bias": ()}
    weights = {name: np.array(rng.standard_normal(shape) * 0.5) for name, shape in shapes.items()}
    return QualityModel(np.zeros(FEATURES), np.ones(FEATURES), weights, 0.5)


def test_gradients_equal_finite_differences():
    rng = np.random.default_rng(0)
    model = _small_model(rng)
    rows, starts = rng.standard_normal((7, FEATURES)), np.array([0, 3, 4])
    labels, importance = np.array([1.0, 0.0, 1.0]), np.array([1.0, 2.0, 0.5])

    def loss():
        p = model.forward(rows, starts)["p"]
        return -(importance * (labels * np.log(p) + (1 - labels) * np.log(1 - p))).sum() / 3

    slopes = model.gradients(rows, starts, labels, importance)
    for name, value in model.weights.items():
        at = tuple(rng.integers(n) for n in value.shape)
        before = value[at].copy()
        value[at] = before + 1e-6
        up = loss()
        value[at] = before - 1e-6
        down = loss()
        value[at] = before
        assert slopes[name][at] == pytest.approx((up - down) / 2e-6, rel=1e-4, abs=1e-8), name


def test_attention_finds_the_telling_passage():
    rng = random.Random(3)
    clean = lambda: " ".join(rng.choice(["plain", "words", "here", "again"]) for _ in range(85))[:PASSAGE_BYTES]
    junk = ("#*$%" * 200)[:PASSAGE_BYTES]
    bags, labels, places = [], [], []
    for i in range(300):
        parts = [clean().ljust(PASSAGE_BYTES) for _ in range(6)]
        if i % 2:
            places.append(rng.randrange(6))
            parts[places[-1]] = junk
        bags.append(passages("".join(parts)))
        labels.append(1 - i % 2)
    scores, tops = fit(bags, np.array(labels, float)).score(bags)
    assert ((scores >= 0.7) == (np.array(labels) == 1)).all()
    assert np.mean(tops[1::2] == np.array(places)) > 0.95


def test_one_label_or_none_gives_the_prior():
    bags = [passages("some text"), passages("")]
    for labels in ([1.0, 1.0], []):
        scores, tops = fit(bags[: len(labels)], np.array(labels), 0.8).score(bags)
        assert scores.tolist() == [0.8, 0.8] and tops.tolist() == [-1, -1]


def test_on_held_out_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    scored = score_quality(docs, train(docs, labels)).where(held_out(F.col("doc_id"))).join(labels, "doc_id")
    right = scored.agg(F.avg(((F.col("score") >= 0.7) == (F.col("quality") == 1)).cast("double"))).first()[0]
    assert right > 0.93


def test_nulls_repeats_and_no_labels(spark):
    rows = [(i, "some words " * (i + 1), 0.5) for i in range(12)] + [(3, "some words " * 4, 0.5), (50, None, 0.1), (51, "", 0.1), (None, "x", 0.2), (52, "long " * 100000, 0.1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score double")
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(12)] + [(3, None, 0), (None, 1, 0), (4, 7, 0)], "doc_id long, quality int, toxic int")
    model = train(docs, labels)
    got = {r["doc_id"]: r for r in score_quality(docs, model).collect()}
    assert score_quality(docs, model).count() == len(rows)
    assert got[50]["n_passages"] == got[51]["n_passages"] == 0 and got[50]["score"] == got[51]["score"] == model.prior
    assert all(0 <= r["score"] <= 1 for r in got.values())
    changed = labels.withColumn("quality", F.when(held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    assert np.array_equal(train(docs, changed).weights["encode"], model.weights["encode"])
    assert train(docs, labels.limit(0)).prior == 0.5
    assert score_quality(docs.limit(0), train(docs.limit(0), labels)).count() == 0
    assert quality_mil.THRESHOLD == 0.7


def plain_score(model, text):
    """Gated attention over the passages of a text, one after the other."""
    w, encoded = model.weights, []
    for row in passages(text):
        encoded.append(np.tanh(((row - model.mean) / model.spread) @ w["encode"] + w["encode_bias"]))
    if not encoded:
        return model.prior
    weigh = [np.exp(float((np.tanh(h @ w["attend"]) / (1 + np.exp(-(h @ w["gate"])))) @ w["weigh"])) for h in encoded]
    z = sum(a / sum(weigh) * h for a, h in zip(weigh, encoded))
    return 1 / (1 + np.exp(-(float(z @ w["score"]) + float(w["score_bias"]))))


def test_the_query_equals_plain_attention(spark):
    folder = "/root/testdata/sf0.001"
    docs, labels = (spark.read.parquet(f"{folder}/{name}.parquet") for name in ("documents", "labels"))
    model = train(docs, labels)
    texts = {row["doc_id"]: row["text"] for row in docs.select("doc_id", "text").collect()}
    found = op9_quality_mil(spark, folder).collect()
    assert len(found) == len(texts)
    for row in found:
        assert row["score"] == pytest.approx(plain_score(model, texts[row["doc_id"]]), abs=1e-4)
        assert row["predicted"] == (row["score"] >= 0.7) and row["held_out"] == (zlib.crc32(str(row["doc_id"]).encode()) % 4 == 2)


def test_all_passages_of_a_long_document_are_learned_from(spark):
    # The passage that earns the label is one of 200, at any place.
    rng = random.Random(9)
    good, bad = "A sentence of good prose, as it should be. " * 12, "buy now!!! $$$ >>> CLICK 0123456789 " * 16
    texts = []
    for i in range(80):
        parts = [bad[:PASSAGE_BYTES]] * 200
        if i % 2:
            parts[rng.randrange(200)] = good[:PASSAGE_BYTES]
        texts.append("".join(parts))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(80)], "doc_id long, quality int")
    assert {len(passages(text)) for text in texts} == {200}
    scored = score_quality(docs, train(docs, labels)).join(labels, "doc_id")
    assert scored.agg(F.avg(((F.col("score") >= 0.5) == (F.col("quality") == 1)).cast("double"))).first()[0] > 0.9


def test_fewer_documents_where_passages_are_too_many():
    assert quality_mil.fitting_documents([(3, "c", 4), (1, "a", 5), (2, "b", 9), (4, "d", 1)], 10) == ["a", "c", "d"]
