"""Document quality by attention-based multiple-instance learning over passages.

A document is a bag of passages of which only the whole has a label. Every passage is encoded, gated
attention weighs the passages of a document, and the weighted sum of their encodings is scored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

PASSAGE_BYTES = 512
HASHED = 256
TRAIN_DOCUMENTS = 2048
TRAIN_PASSAGES = 65_536
_HIDDEN, _ATTENTION = 32, 16
_EPOCHS, _BATCH, _RATE, _DECAY = 30, 128, 0.01, 1e-4
_CLASSES = ("upper", "lower", "digit", "space", "mark", "symbol", "line", "high")
FEATURES = HASHED + len(_CLASSES) + 2
THRESHOLD = 0.7


def _byte_classes() -> np.ndarray:
    """The class of each byte, as an index into ``_CLASSES``."""
    classes = np.full(256, _CLASSES.index("symbol"), np.int64)
    for name, bytes_of in {
        "upper": range(65, 91),
        "lower": range(97, 123),
        "digit": range(48, 58),
        "space": (9, 11, 12, 13, 32),
        "mark": b".,;:!?'\"()-",
        "line": (10,),
        "high": range(128, 256),
    }.items():
        classes[list(bytes_of)] = _CLASSES.index(name)
    return classes


_CLASS_OF = _byte_classes()


def passages(text: str | None) -> np.ndarray:
    """One row per passage of the whole text: square roots of the shares of hashed byte pairs, shares of
    byte classes, the variety of pairs, and the share of the most frequent one. No text, no rows."""
    data = np.frombuffer((text or "").encode(errors="replace"), np.uint8)
    if not len(data):
        return np.zeros((0, FEATURES), np.float32)
    n = -(-len(data) // PASSAGE_BYTES)
    of = np.arange(len(data)) // PASSAGE_BYTES
    codes = data.astype(np.uint32)
    pairs = (codes * np.uint32(257) + np.append(codes[1:], np.uint32(0))) * np.uint32(0x9E3779B1)
    hashed = (pairs >> np.uint32(24)).astype(np.int64)
    counts = np.bincount(of * HASHED + hashed, minlength=n * HASHED).reshape(n, HASHED)
    classes = np.bincount(of * len(_CLASSES) + _CLASS_OF[data], minlength=n * len(_CLASSES)).reshape(n, len(_CLASSES))
    total = counts.sum(axis=1, keepdims=True)
    variety = (counts > 0).sum(axis=1, keepdims=True) / np.sqrt(total)
    top = counts.max(axis=1, keepdims=True) / total
    return np.hstack([np.sqrt(counts / total), classes / total, variety / 10, top]).astype(np.float32)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


@dataclass
class QualityModel:
    """Parameters of the encoder, the gated attention and the classifier; ``prior`` scores an empty bag."""

    mean: np.ndarray
    spread: np.ndarray
    weights: dict[str, np.ndarray]
    prior: float

    def forward(self, rows: np.ndarray, starts: np.ndarray) -> dict[str, np.ndarray]:
        """All intermediate values for bags of consecutive ``rows`` that begin at ``starts``."""
        w = self.weights
        sizes = np.diff(np.append(starts, len(rows)))
        bag = np.repeat(np.arange(len(starts)), sizes)
        x = (rows - self.mean) / self.spread
        h = np.tanh(x @ w["encode"] + w["encode_bias"])
        t, g = np.tanh(h @ w["attend"]), _sigmoid(h @ w["gate"])
        s = (t * g) @ w["weigh"]
        e = np.exp(s - np.maximum.reduceat(s, starts)[bag])
        a = e / np.add.reduceat(e, starts)[bag]
        z = np.add.reduceat(a[:, None] * h, starts, axis=0)
        return {"x": x, "h": h, "t": t, "g": g, "a": a, "z": z, "p": _sigmoid(z @ w["score"] + w["score_bias"]), "bag": bag}

    def gradients(self, rows: np.ndarray, starts: np.ndarray, labels: np.ndarray, importance: np.ndarray) -> dict[str, np.ndarray]:
        """Of the mean weighted log loss, by parameter."""
        w, v = self.weights, self.forward(rows, starts)
        bag, a, h, t, g = v["bag"], v["a"], v["h"], v["t"], v["g"]
        dy = (v["p"] - labels) * importance / len(starts)
        dz = dy[:, None] * w["score"]
        da = (h * dz[bag]).sum(axis=1)
        ds = a * (da - np.add.reduceat(a * da, starts)[bag])
        dtg = ds[:, None] * w["weigh"]
        dt, dg = dtg * g * (1 - t**2), dtg * t * g * (1 - g)
        dh = a[:, None] * dz[bag] + dt @ w["attend"].T + dg @ w["gate"].T
        dpre = dh * (1 - h**2)
        return {
            "encode": v["x"].T @ dpre,
            "encode_bias": dpre.sum(axis=0),
            "attend": h.T @ dt,
            "gate": h.T @ dg,
            "weigh": (t * g).T @ ds,
            "score": v["z"].T @ dy,
            "score_bias": np.array(dy.sum()),
        }

    def score(self, bags: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """(score, place of the passage with most attention or -1) of each bag."""
        scores, tops = np.full(len(bags), self.prior), np.full(len(bags), -1)
        full = [i for i, bag in enumerate(bags) if len(bag)]
        if full and self.weights:
            sizes = np.array([len(bags[i]) for i in full])
            starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
            v = self.forward(np.concatenate([bags[i] for i in full]), starts)
            scores[full] = v["p"]
            tops[full] = [int(v["a"][s : s + n].argmax()) for s, n in zip(starts, sizes)]
        return scores, tops


def fit(bags: list[np.ndarray], labels: np.ndarray, prior: float = 0.5, seed: int = 7) -> QualityModel:
    """Train on labelled bags by Adam; both labels weigh the same in all. With one label there is only the prior."""
    full = [i for i, bag in enumerate(bags) if len(bag)]
    targets = labels[full].astype(np.float32)
    if not full or targets.min() == targets.max():
        return QualityModel(np.zeros(FEATURES), np.ones(FEATURES), {}, prior)
    rows = np.concatenate([bags[i] for i in full])
    rng = np.random.default_rng(seed)

    def drawn(*shape: int) -> np.ndarray:
        return (rng.standard_normal(shape) / np.sqrt(shape[0])).astype(np.float32)

    weights = {
        "encode": drawn(FEATURES, _HIDDEN),
        "encode_bias": np.zeros(_HIDDEN, np.float32),
        "attend": drawn(_HIDDEN, _ATTENTION),
        "gate": drawn(_HIDDEN, _ATTENTION),
        "weigh": drawn(_ATTENTION),
        "score": drawn(_HIDDEN),
        "score_bias": np.zeros((), np.float32),
    }
    model = QualityModel(rows.mean(axis=0), rows.std(axis=0) + np.float32(0.01), weights, prior)
    share = np.array([1 - targets.mean(), targets.mean()])
    importance = (0.5 / share[targets.astype(int)]).astype(np.float32)
    first = {name: np.zeros_like(value) for name, value in weights.items()}
    second = {name: np.zeros_like(value) for name, value in weights.items()}
    step = 0
    for _ in range(_EPOCHS):
        order = rng.permutation(len(full))
        for at in range(0, len(order), _BATCH):
            part = order[at : at + _BATCH]
            sizes = np.array([len(bags[full[i]]) for i in part])
            starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
            batch = np.concatenate([bags[full[i]] for i in part])
            step += 1
            for name, slope in model.gradients(batch, starts, targets[part], importance[part]).items():
                slope = slope + _DECAY * weights[name]
                first[name] = 0.9 * first[name] + 0.1 * slope
                second[name] = 0.999 * second[name] + 0.001 * slope**2
                rate = _RATE * np.sqrt(1 - 0.999**step) / (1 - 0.9**step)
                weights[name] = (weights[name] - rate * first[name] / (np.sqrt(second[name]) + 1e-8)).astype(np.float32)
    return model


def held_out(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string")) % 4 == 2


def _bags(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        bags = [passages(value.as_py()).tobytes() for value in batch.column("text")]
        yield pa.record_batch([batch.column("quality"), pa.array(bags, pa.binary())], names=["quality", "bag"])


def fitting_documents(sizes: list[tuple], most: int = TRAIN_PASSAGES) -> list:
    """Ids of (mix, doc_id, passages) in the order of mix, as long as their passages are ``most`` in all; larger ones are passed over."""
    chosen, total = [], 0
    for _, doc_id, n in sorted(sizes):
        if total + n <= most:
            chosen.append(doc_id)
            total += n
    return chosen


def train(docs: DataFrame, labels: DataFrame) -> QualityModel:
    """Fit on a bounded sample of the labelled documents that are not held out.

    At most ``TRAIN_DOCUMENTS`` documents, as many of either label, with all their passages reach the driver.
    Where these are more than ``TRAIN_PASSAGES`` passages, fewer documents are taken: in the order of a hash
    of their id, alike for both labels, those that still fit. Of several labels of a document the least
    counts; only 0 and 1 are labels.
    """
    known = (
        labels.where(F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1) & ~held_out(F.col("doc_id")))
        .groupBy("doc_id")
        .agg(F.min("quality").cast("int").alias("quality"))
    )
    # The least id of each of a bounded number of id buckets: no label is a hot key.
    bucket = F.pmod(F.xxhash64("doc_id"), F.lit(TRAIN_DOCUMENTS // 2))
    chosen = (
        known.groupBy("quality", bucket.alias("bucket"))
        .agg(F.min("doc_id").alias("doc_id"))
        .select(F.col("doc_id").alias("chosen_id"), "quality")
    )
    # At most TRAIN_DOCUMENTS rows.
    size = F.max(F.ceil(F.octet_length("text") / PASSAGE_BYTES)).alias("n")
    found = docs.select("doc_id", "text").join(F.broadcast(chosen), F.col("doc_id") == F.col("chosen_id"))
    sizes = found.groupBy("doc_id").agg(size).select("doc_id", "n", F.xxhash64("doc_id").alias("mix")).collect()
    fitting = fitting_documents([(row["mix"], row["doc_id"], row["n"] or 0) for row in sizes])
    rows = (
        found.where(F.col("doc_id").isin(fitting))
        .dropDuplicates(["doc_id"])
        .select("text", "quality")
        .mapInArrow(_bags, "quality int, bag binary")
        .collect()
    )
    # The order in which rows arrive must not move the fit.
    rows = sorted((row["quality"], bytes(row["bag"])) for row in rows)
    bags = [np.frombuffer(bag, np.float32).reshape(-1, FEATURES) for _, bag in rows]
    prior = known.agg(F.avg("quality")).first()[0]
    return fit(bags, np.array([quality for quality, _ in rows], float), 0.5 if prior is None else prior)


def _scorer(model: QualityModel):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 64):
                part = batch.slice(start, 64)
                bags = [passages(value.as_py()) for value in part.column("text")]
                scores, tops = model.score(bags)
                sizes = pa.array([len(bag) for bag in bags], pa.int64())
                yield pa.record_batch(
                    [part.column("doc_id"), pa.array(scores, pa.float64()), sizes, pa.array(tops, pa.int64())],
                    names=["doc_id", "score", "n_passages", "most_weighted"],
                )

    return run


def score_quality(docs: DataFrame, model: QualityModel) -> DataFrame:
    """(doc_id, score, n_passages, most_weighted) of every whole text; no other column is read.

    ``score`` is the estimated probability of label 1 when both are equally frequent, and
    ``most_weighted`` the place of the passage with most attention. A null or empty text has no
    passages, most_weighted -1 and the share of label 1 among the labels not held out as its score.
    Repeated rows repeat, null ids stay null.
    """
    schema = T.StructType(
        [
            docs.schema["doc_id"],
            T.StructField("score", T.DoubleType()),
            T.StructField("n_passages", T.LongType()),
            T.StructField("most_weighted", T.LongType()),
        ]
    )
    return docs.select("doc_id", "text").mapInArrow(_scorer(model), schema)
