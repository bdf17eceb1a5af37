import itertools
import unicodedata
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from marginfold.llm.queries import op7_language_id
from marginfold.llm.language_id import LanguageModel, codewords, features, fit_bits, held_out, of_clear_language, predict_language, train

WORDS = {"aa": "kolu mira tavo selu", "bb": "xyth grun wock zapf", "cc": "éèau çoiê ôuvre été"}


@pytest.mark.parametrize("n", [2, 3, 4, 6, 7, 40])
def test_codewords_are_far_apart(n):
    code = codewords(n)
    assert code.shape[0] == n and set(np.unique(code)) <= {-1.0, 1.0}
    least = min((code[i] != code[j]).sum() for i, j in itertools.combinations(range(n), 2))
    assert least >= max(1, code.shape[1] // 4)


def test_nearest_codeword_survives_a_wrong_bit():
    code = codewords(4)
    model = LanguageModel(list("abcd"), code, np.eye(code.shape[1]), np.zeros(code.shape[1]))
    for language in range(4):
        for bit in range(code.shape[1]):
            received = 2 * code[language]
            received[bit] *= -0.4
            assert model.decode(received[None])[0][0] == language
    _, score, margin = model.decode(np.zeros((1, code.shape[1])))
    assert margin[0] == 0 and score[0] == pytest.approx(0.25)


def _docs(spark):
    rows = []
    for i in range(90):
        lang = "abc"[i % 3] * 2
        words = WORDS[lang].split()
        rows.append((i, " ".join(words[(i * k) % 4] for k in range(1, 12)), lang, i))
    rows += [(90, None, "aa", 0), (91, "", "bb", 0), (92, "123 !!", "cc", 0), (93, WORDS["bb"].upper(), None, 0), (None, WORDS["aa"], "aa", 0), (1, rows[1][1], "bb", 0)]
    rows.append((94, (WORDS["cc"] + "\n") * 20000, None, 0))
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, score int")


def test_predictions(spark):
    docs = _docs(spark)
    model = train(docs)
    assert model.languages == ["aa", "bb", "cc"]
    rows = predict_language(docs, model).collect()
    assert len(rows) == docs.count()
    by_id = {r["doc_id"]: r for r in rows}
    assert all(by_id[i]["lang_pred"] == "abc"[i % 3] * 2 for i in range(90))
    assert [by_id[i]["lang_pred"] for i in (90, 91, 92, 93, 94, None)] == ["und", "und", "und", "bb", "cc", "aa"]
    assert all(0 <= r["score"] <= 1 for r in rows)
    kept = of_clear_language(docs, model)
    assert kept.columns == docs.columns
    assert {r["doc_id"] for r in kept.collect()} == {r["doc_id"] for r in rows} - {90, 91, 92}


def test_no_table_or_no_labels(spark):
    docs = _docs(spark)
    assert predict_language(docs.limit(0), train(docs)).count() == 0
    unlabelled = train(docs.withColumn("lang", F.lit(None).cast("string")))
    assert {r["lang_pred"] for r in predict_language(docs, unlabelled).collect()} == {"und"}


def test_held_out_rows_teach_nothing(spark):
    docs = _docs(spark)
    changed = docs.withColumn("lang", F.when(held_out(F.col("doc_id")), F.lit("zz")).otherwise(F.col("lang")))
    assert np.array_equal(train(docs).weights, train(changed).weights)
    ids = [i for i in range(90) if zlib.crc32(str(i).encode()) % 3 == 1]
    assert sorted(r[0] for r in docs.where(held_out(F.col("doc_id"))).where("doc_id < 90 and score > 0").collect()) == [i for i in sorted(ids) if i]


def test_accuracy_on_held_out_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    predicted = predict_language(docs, train(docs)).where(held_out(F.col("doc_id")))
    joined = predicted.join(docs.select("doc_id", "lang"), "doc_id").where("lang is not null")
    share = joined.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("double"))).first()[0]
    assert share > 0.97


def decoded(model, text):
    """A language and its score by the definition, one codeword after the other in plain Python."""
    margins = [sum(x * w for x, w in zip(features(text), model.weights[:, bit])) + model.bias[bit] for bit in range(model.code.shape[1])]
    losses = [sum(np.log1p(np.exp(-m * c)) for m, c in zip(margins, word)) / len(word) for word in model.code]
    best = min(range(len(losses)), key=lambda i: losses[i])
    likely = [np.exp(-(loss - losses[best]) * len(margins)) for loss in losses]
    return model.languages[best], 1 / sum(likely), len(losses) > 1 and sorted(losses)[1] - losses[best] < 0.02


def test_the_query_equals_a_plain_decoding(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    model = train(docs)
    texts = {row["doc_id"]: row["text"] for row in docs.select("doc_id", "text").collect()}
    found = op7_language_id(spark, "/root/testdata/sf0.001").collect()
    assert len(found) == docs.count()
    for row in found:
        text = texts[row["doc_id"]]
        assert row["held_out"] == (zlib.crc32(str(row["doc_id"]).encode()) % 3 == 1)
        if not text or not any(unicodedata.category(c)[0] == "L" for c in text):
            assert (row["lang_pred"], row["score"]) == ("und", 0)
        else:
            language, score, ambiguous = decoded(model, text)
            assert (row["lang_pred"], row["ambiguous"]) == (language, ambiguous) and row["score"] == pytest.approx(score)


def test_numbers_and_marks_are_no_letters(spark):
    docs = spark.createDataFrame([(i, WORDS["aa"], "aa") for i in range(30)], "doc_id long, text string, lang string")
    odd = spark.createDataFrame(list(enumerate(["½", "①", "_ 1 Ⅷ", "🙂", "x"])), "doc_id long, text string")
    assert [row["lang_pred"] for row in predict_language(odd, train(docs)).orderBy("doc_id").collect()] == ["und"] * 4 + ["aa"]


def test_three_hundred_languages_are_all_learned(spark):
    rng = np.random.default_rng(5)
    letters = list("abcdefghijklmnopqrstuvwxyz")
    words = {f"l{n}": ["".join(rng.choice(letters, 5)) for _ in range(12)] for n in range(300)}
    rows = [(n * 100 + i, " ".join(rng.choice(words[f"l{n}"], 25)), f"l{n}") for n in range(300) for i in range(8)]
    # A language whose rows of least id have no letter is learned from the others.
    rows += [(-100 + i, "123" if i < 60 else " ".join(rng.choice(words["l7"], 25)[::-1]) + " ðððð þþþþ", "late") for i in range(80)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = train(docs)
    assert set(model.languages) == {f"l{n}" for n in range(300)} | {"late"}
    known = predict_language(docs.where("text <> '123'"), model).join(docs.drop("text"), "doc_id")
    assert known.agg(F.avg((F.col("lang_pred") == F.col("lang")).cast("double"))).first()[0] > 0.9
