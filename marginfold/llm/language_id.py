"""Language identification with error-correcting output codes over character n-grams."""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, functions as F, types as T

UNDETERMINED = "und"
FEATURE_BITS = 12
FEATURES = 1 << FEATURE_BITS
SAMPLE_DOCUMENTS = 1024
LEAST_DOCUMENTS = 4
EXCERPT_CHARS = 120
AMBIGUOUS_BELOW = 0.02
_ROUNDS = 150
_LETTER = regex.compile(r"\p{L}")
# ASCII characters other than letters count as one space; bytes of other characters stay.
_SPACED = bytes(c if c >= 128 or chr(c).isalpha() else 32 for c in range(256))


def held_out(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string")) % 3 == 1


def features(text: str) -> np.ndarray:
    """Relative frequencies of the hashed byte bigrams and trigrams of the lower-cased text, as square roots.

    The square root keeps frequent n-grams from drowning the rest; the vector has unit length.
    """
    data = np.frombuffer(b" " + b" ".join(text.lower().encode(errors="replace").translate(_SPACED).split()) + b" ", np.uint8)
    codes = data.astype(np.uint32)
    pairs = codes[:-1] * np.uint32(257) + codes[1:]
    triples = pairs[:-1] * np.uint32(263) + codes[2:] + np.uint32(1)
    counts = np.zeros(FEATURES)
    for grams, factor in ((pairs, 0x9E3779B1), (triples, 0x85EBCA6B)):
        hashed = (grams * np.uint32(factor)) >> np.uint32(32 - FEATURE_BITS)
        counts += np.bincount(hashed, minlength=FEATURES)
    return np.sqrt(counts / max(1.0, counts.sum()))


def codewords(n_languages: int, seed: int = 17) -> np.ndarray:
    """One row of +1/-1 bits per language.

    Up to six languages get the exhaustive code: every split of the languages in two, whose rows
    differ pairwise in half of the bits. More get random splits, the set with the largest least
    distance of 32 draws.
    """
    if n_languages < 2:
        return np.ones((n_languages, 1))
    if n_languages <= 6:
        splits = [(1, *rest) for rest in itertools.product((1, -1), repeat=n_languages - 1)]
        return np.array([s for s in splits if min(s) < 0], float).T
    rng = np.random.default_rng(seed)
    n_bits = int(np.ceil(10 * np.log2(n_languages)))
    draws = []
    for _ in range(32):
        code = rng.choice([-1.0, 1.0], (n_languages, n_bits))
        code = code[:, np.abs(code.sum(axis=0)) < n_languages]
        # Of two codewords the product counts bits that agree less those that differ.
        agree = code @ code.T
        np.fill_diagonal(agree, -np.inf)
        draws.append(((code.shape[1] - agree.max()) / 2, code))
    return max(draws, key=lambda draw: draw[0])[1]


@dataclass(frozen=True)
class LanguageModel:
    languages: list[str]
    code: np.ndarray
    weights: np.ndarray
    bias: np.ndarray

    def decode(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(language index, score, margin) of each row by loss-weighted decoding.

        The distance to a codeword is the mean logistic loss of the bit margins against its bits.
        The score is the share of the nearest codeword when likelihoods of all bits are normalised,
        the margin the loss by which the second nearest is farther.
        """
        margins = vectors @ self.weights + self.bias
        losses = np.logaddexp(0, -margins[:, None, :] * self.code[None, :, :]).mean(axis=2)
        order = np.argsort(losses, axis=1, kind="stable")
        nearest = order[:, 0]
        rows = np.arange(len(losses))
        if losses.shape[1] == 1:
            return nearest, np.ones(len(losses)), np.full(len(losses), np.inf)
        margin = losses[rows, order[:, 1]] - losses[rows, nearest]
        likely = np.exp(-(losses - losses[rows, nearest][:, None]) * self.code.shape[1])
        return nearest, 1 / likely.sum(axis=1), margin


def fit_bits(vectors: np.ndarray, targets: np.ndarray, weight: np.ndarray, ridge: float = 1e-4) -> tuple[np.ndarray, np.ndarray]:
    """Logistic regressions of all code bits at once by accelerated gradient descent."""
    vectors, targets = vectors.astype(np.float32), targets.astype(np.float32)
    weight = (weight / weight.sum()).astype(np.float32)[:, None]
    centre = (weight * vectors).sum(axis=0)
    spread = vectors - centre
    step = np.float32(4.0 / max(1e-6, float((weight * spread**2).sum())))
    ridge = np.float32(ridge)
    weights, bias = np.zeros((vectors.shape[1], targets.shape[1]), np.float32), np.zeros(targets.shape[1], np.float32)
    ahead, ahead_bias, momentum = weights, bias, 1.0
    for _ in range(_ROUNDS):
        slope = -weight * targets / (1 + np.exp(np.clip(targets * (spread @ ahead + ahead_bias), -40, 40)))
        new = ahead - step * (spread.T @ slope + ridge * ahead)
        new_bias = ahead_bias - 2 * slope.sum(axis=0)
        grown = (1 + np.sqrt(1 + 4 * momentum**2)) / 2
        push = np.float32((momentum - 1) / grown)
        ahead, ahead_bias = new + push * (new - weights), new_bias + push * (new_bias - bias)
        weights, bias, momentum = new, new_bias, grown
    return weights.astype(float), (bias - centre @ weights).astype(float)


def _sample(docs: DataFrame, per_language: int) -> DataFrame:
    """About ``per_language`` documents of each language: the least id of each of that many id buckets.

    A map-side aggregation, so a language with most of the rows is no hot key.
    """
    bucket = F.pmod(F.xxhash64("doc_id"), F.lit(per_language))
    chosen = docs.groupBy("lang", bucket.alias("bucket")).agg(F.min("doc_id").alias("chosen_id"))
    return chosen.select("chosen_id", F.col("lang").alias("label"))


def _examples(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        labels, vectors = [], []
        for label, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if not text or not _LETTER.search(text):
                continue
            third = len(text) // 3
            # A short excerpt beside the whole text teaches the bits what little text looks like.
            for piece in (text, text[third : third + EXCERPT_CHARS]):
                labels.append(label)
                vectors.append(features(piece).astype(np.float32).tobytes())
        yield pa.record_batch([pa.array(labels, pa.string()), pa.array(vectors, pa.binary())], names=["label", "vector"])


def train(docs: DataFrame) -> LanguageModel:
    """Fit the code bits on a bounded sample of the rows of ``docs`` that are not held out.

    Every lang value is learned. The vectors of about ``SAMPLE_DOCUMENTS`` documents in all, but up to
    ``LEAST_DOCUMENTS`` of each language, reach the driver. Rows without lang, doc_id or a letter are no
    examples, and none of them is chosen.
    """
    known = docs.where(
        F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")) & F.col("text").rlike(r"\p{L}")
    )
    n_languages = known.select("lang").distinct().count()
    if not n_languages:
        return LanguageModel([], np.ones((0, 1)), np.zeros((FEATURES, 1)), np.zeros(1))
    chosen = _sample(known, max(LEAST_DOCUMENTS, SAMPLE_DOCUMENTS // n_languages))
    rows = (
        known.select("doc_id", "lang", "text")
        .join(chosen, (F.col("doc_id") == F.col("chosen_id")) & (F.col("lang") == F.col("label")), "left_semi")
        .dropDuplicates(["doc_id", "lang"])
        .select("lang", "text")
        .mapInArrow(_examples, "label string, vector binary")
        .collect()
    )
    # The order in which rows arrive must not move the fit.
    rows = sorted((row["label"], bytes(row["vector"])) for row in rows)
    languages = sorted({label for label, _ in rows})
    if not languages:
        return LanguageModel([], np.ones((0, 1)), np.zeros((FEATURES, 1)), np.zeros(1))
    labels = np.array([languages.index(label) for label, _ in rows])
    code = codewords(len(languages))
    vectors = np.array([np.frombuffer(vector, np.float32) for _, vector in rows])
    weights, bias = fit_bits(vectors, code[labels], 1.0 / np.bincount(labels)[labels])
    return LanguageModel(languages, code, weights, bias)


def _predictor(model: LanguageModel, text_at: int, kept: list[int]):
    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            languages, scores, ambiguous = [UNDETERMINED] * n, np.zeros(n), np.zeros(n, bool)
            for start in range(0, n, 512):
                vectors, at = [], []
                for i, value in enumerate(batch.column(text_at).slice(start, 512), start):
                    text = value.as_py()
                    if text and model.languages and _LETTER.search(text):
                        vectors.append(features(text))
                        at.append(i)
                if at:
                    nearest, score, margin = model.decode(np.array(vectors))
                    scores[at] = score
                    ambiguous[at] = margin < AMBIGUOUS_BELOW
                    for i, language in zip(at, nearest):
                        languages[i] = model.languages[language]
            columns = [batch.column(i) for i in kept]
            names = [batch.schema.names[i] for i in kept]
            yield pa.record_batch(
                [*columns, pa.array(languages, pa.string()), pa.array(scores), pa.array(ambiguous)],
                names=[*names, "lang_pred", "score", "ambiguous"],
            )

    return predict


_PREDICTED = T.StructType(
    [
        T.StructField("lang_pred", T.StringType()),
        T.StructField("score", T.DoubleType()),
        T.StructField("ambiguous", T.BooleanType()),
    ]
)


def predict_language(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """(doc_id, lang_pred, score, ambiguous) of every whole text of ``docs``; no other column is read.

    A text that is null or has no letter is ``und`` with score 0. ``ambiguous`` marks texts whose two
    nearest codewords are about as near. Repeated rows repeat, null ids stay null.
    """
    schema = T.StructType([docs.schema["doc_id"], *_PREDICTED.fields])
    return docs.select("doc_id", "text").mapInArrow(_predictor(model, 1, [0]), schema)


def of_clear_language(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """The rows of ``docs``, with all their columns, whose text has a language that is not ambiguous."""
    names = [f"c{i}" for i in range(len(docs.columns))]
    plain = docs.toDF(*names)
    at = docs.columns.index("text")
    schema = T.StructType([*plain.schema.fields, *_PREDICTED.fields])
    predicted = plain.mapInArrow(_predictor(model, at, list(range(len(names)))), schema)
    clear = predicted.where((F.col("lang_pred") != UNDETERMINED) & ~F.col("ambiguous"))
    return clear.select(*names).toDF(*docs.columns)
