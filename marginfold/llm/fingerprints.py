"""Lempel-Ziv phrase fingerprints: texts that compress alike share the phrases of their parses.

A text, closed by an end mark that no text holds, is parsed from left to right into dictionary phrases:
each is the longest phrase met before, longer by one character, and joins the dictionary. The set of
phrases is hashed, and of each of ``SLOTS`` hash functions the least value over the set is kept, by one
byte. The share of equal bytes estimates the likeness (Jaccard) of two phrase sets; chance makes one
byte in 256 equal, which is taken off.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F, types as T

from marginfold.llm.worker import kept
from marginfold.sources.scratch import written

SLOTS = 128
_END = 0x110000
_CODE_BITS = 21
_PHRASES_AT_ONCE = 2048
# Odd multipliers: any would do, but the same ones must be used for all fingerprints ever compared.
_BASE = 0x9E3779B97F4A7C15
_SEED = 20240229


def _mixed(values: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer: every bit of the input moves about half the bits of the output."""
    values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


def parse(codes: list[int], phrases: dict[int, int], node: int = 0, place: int = 0) -> tuple[list[int], int]:
    """Continue a parse: the places where new phrases end, and the node of the phrase left open.

    ``phrases`` is the dictionary as a tree, from a node and a character to the node of the longer phrase;
    it grows by one entry for each phrase that ends. Time is linear in ``codes``.
    """
    ends = []
    find = phrases.get
    for code in codes:
        place += 1
        key = node << _CODE_BITS | code
        node = find(key)
        if node is None:
            phrases[key] = len(phrases) + 1
            ends.append(place)
            node = 0
    return ends, node


class Hasher:
    """Hashes of phrases as polynomials of their characters, and their least values; keeps powers of the base."""

    def __init__(self) -> None:
        self._powers = np.ones(1, np.uint64)
        self._inverse = np.ones(1, np.uint64)
        self._multipliers = np.random.default_rng(_SEED).integers(0, 1 << 63, SLOTS, np.uint64) * np.uint64(2) + np.uint64(1)

    def _grow(self, size: int) -> None:
        if len(self._powers) < size:
            size = max(size, 2 * len(self._powers))
            for name, base in (("_powers", _BASE), ("_inverse", pow(_BASE, -1, 1 << 64))):
                factors = np.full(size, base, np.uint64)
                factors[0] = 1
                setattr(self, name, np.cumprod(factors))

    def phrases(self, codes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """64-bit hashes of the parts of ``codes``; equal parts have equal hashes wherever they stand."""
        self._grow(len(codes))
        terms = _mixed(codes.astype(np.uint64) + np.uint64(1)) * self._powers[: len(codes)]
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(terms, dtype=np.uint64)])
        return _mixed((sums[ends] - sums[starts]) * self._inverse[starts] + (ends - starts).astype(np.uint64))

    def least(self, hashes: np.ndarray) -> np.ndarray:
        """For each hash function, its least value over the phrases."""
        found = np.full(SLOTS, np.iinfo(np.uint64).max, np.uint64)
        for at in range(0, len(hashes), _PHRASES_AT_ONCE):
            part = hashes[at : at + _PHRASES_AT_ONCE, None] * self._multipliers
            np.minimum(found, part.min(axis=0), out=found)
        return found


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le"), "<u4")


def _signature(least: np.ndarray) -> bytes:
    return (_mixed(least) >> np.uint64(56)).astype("u1").tobytes()


def fingerprints(hasher: Hasher, head: str, *tails: str) -> list[bytes]:
    """The fingerprint of ``head`` followed by each tail; the head is parsed and hashed once."""
    phrases: dict[int, int] = {}
    front = _codes(head)
    ends, node = parse(front.tolist(), phrases)
    n_front = len(phrases)
    bounds = np.array([0, *ends], np.int64)
    least_front = hasher.least(hasher.phrases(front, bounds[:-1], bounds[1:]))
    open_from = int(bounds[-1])
    found = []
    for tail in tails:
        rest = np.append(_codes(tail), np.uint32(_END))
        ends, _ = parse(rest.tolist(), phrases, node, len(front))
        while len(phrases) > n_front:
            phrases.popitem()
        # The end mark ends a phrase, so all of the text is in some phrase.
        bounds = np.array([open_from, *ends], np.int64) - open_from
        hashes = hasher.phrases(np.concatenate([front[open_from:], rest]), bounds[:-1], bounds[1:])
        found.append(_signature(np.minimum(least_front, hasher.least(hashes))))
    return found


def likeness(left: bytes, right: bytes) -> float:
    """The estimated likeness of two phrase sets, 0 to 1; 1 for equal fingerprints."""
    equal = float(np.mean(np.frombuffer(left, "u1") == np.frombuffer(right, "u1")))
    return max(0.0, (equal - 1 / 256) / (1 - 1 / 256))


def _hasher() -> Hasher:
    return kept("phrase hasher", Hasher)


def _fingerprint_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    hasher = _hasher()
    for batch in batches:
        found = [fingerprints(hasher, "", text.as_py() or "")[0].hex() for text in batch.column("text")]
        yield pa.record_batch([batch.column("doc_id"), pa.array(found, pa.string())], names=["doc_id", "fingerprint"])


def fingerprint_texts(docs: DataFrame) -> DataFrame:
    """(doc_id, fingerprint) of every whole text, hexadecimal; a null text is empty, and repeated rows repeat.

    Equal texts have equal fingerprints. The empty text has one too: of the end mark alone.
    """
    schema = T.StructType([docs.schema["doc_id"], T.StructField("fingerprint", T.StringType())])
    return docs.select("doc_id", "text").mapInArrow(_fingerprint_batches, schema)


def replaced_tail(text: str, following: str) -> tuple[str, str]:
    """The part of a text that an edit keeps, and what stands behind it then: the beginning of ``following``."""
    n_replaced = len(text) // 4
    return text[: len(text) - n_replaced], following[:n_replaced]


_RESULT = ["n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
_ROW, _FIRST, _LAST = 0, 1, 2


def _compared(hasher: Hasher, text: str, following: str) -> tuple[bytes, bytes, bytes]:
    """Hash of the edited text, fingerprint of the text, fingerprint of the edited text."""
    head, tail = replaced_tail(text, following)
    own, edited = fingerprints(hasher, head, text[len(head) :], tail)
    return hashlib.sha256((head + tail).encode()).digest(), own, edited


def _in_order(schema: pa.Schema):
    """Compares each text of a sorted part with the next one; the part's ends are left to be joined.

    The part's first text is given as a row ``_FIRST`` besides, and the last one as a row ``_LAST``.
    """

    def row(kind, bucket, doc_id, text=None, n_chars=None, digest=None, own=None, edited=None, near_edited=None, near_next=None):
        return kind, bucket, doc_id, text, n_chars, digest, own, edited, near_edited, near_next

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        hasher = _hasher()
        before = waiting = None
        for batch in batches:
            for doc_id, value, bucket in zip(batch.column("doc_id").to_pylist(), batch.column("text"), batch.column("bucket").to_pylist()):
                text = value.as_py() or ""
                if before is None:
                    yield row(_FIRST, bucket, doc_id, text)
                else:
                    digest, own, edited = _compared(hasher, before[1], text)
                    if waiting:
                        yield (*waiting, likeness(waiting[6], own))
                    waiting = (_ROW, bucket, before[0], None, len(before[1]), digest, own, edited, likeness(own, edited))
                before = (doc_id, text, bucket)
        if before:
            own = fingerprints(hasher, "", before[1])[0]
            if waiting:
                yield (*waiting, likeness(waiting[6], own))
            yield row(_LAST, before[2], before[0], before[1])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for found in rows(batches):
            held.append(found)
            size += len(found[3] or "") + 1000
            if size > 1 << 22:
                yield pa.record_batch([pa.array(column, field.type) for column, field in zip(zip(*held), schema)], schema=schema)
                held, size = [], 0
        if held:
            yield pa.record_batch([pa.array(column, field.type) for column, field in zip(zip(*held), schema)], schema=schema)

    return run


def _joined_ends(schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = _hasher()
        for batch in batches:
            found = []
            for doc_id, text, following in zip(*(batch.column(name).to_pylist() for name in ("doc_id", "text", "following"))):
                digest, own, edited = _compared(hasher, text, following)
                near_next = likeness(own, fingerprints(hasher, "", following)[0])
                found.append((doc_id, len(text), digest, own, edited, likeness(own, edited), near_next))
            if found:
                yield pa.record_batch([pa.array(column, field.type) for column, field in zip(zip(*found), schema)], schema=schema)

    return run


def near_next_and_edited(docs: DataFrame) -> DataFrame:
    """Every text's fingerprint compared with that of an edited text and that of the next document.

    The next document follows in ascending order of doc_id, nulls first, and rows that repeat an id in the
    order of a hash of their text; the last is followed by the first, and a lone document by itself. The
    edited text has the last quarter of the text's characters replaced by the next text's first ones.
    Returns (doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next),
    one row per row. A null text is empty; other columns are ignored; no rows give none.

    Texts are shuffled once, into ranges of doc_id. Each range is compared in order as it is read, one
    text and the next at a time; only the last text of each range meets the first of the following one
    in a join, by the number of the range.
    """
    spark = docs.sparkSession
    order = ["doc_id", "mix", "place"]
    dealt = (
        docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
        # Rows alike in id and text are in no order; the place lets them be split all the same.
        .select("doc_id", "text", F.xxhash64("text").alias("mix"), F.monotonically_increasing_id().alias("place"))
        .repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .select("doc_id", "text", F.spark_partition_id().alias("bucket"))
    )
    doc_id = docs.schema["doc_id"]
    result = T.StructType(
        [
            doc_id,
            T.StructField("n_chars", T.LongType()),
            T.StructField("edited_sha256", T.BinaryType()),
            T.StructField("fingerprint", T.BinaryType()),
            T.StructField("edited_fingerprint", T.BinaryType()),
            T.StructField("near_edited", T.DoubleType()),
            T.StructField("near_next", T.DoubleType()),
        ]
    )
    parted = T.StructType(
        [T.StructField("kind", T.IntegerType()), T.StructField("bucket", T.IntegerType()), doc_id, T.StructField("text", T.StringType()), *result.fields[1:]]
    )
    # Written, as a second reading would draw other ranges.
    parts = written(dealt.mapInArrow(_in_order(_arrow(parted)), parted))
    firsts = parts.where(F.col("kind") == _FIRST).select(F.col("bucket").alias("next_bucket"), F.col("text").alias("following"))
    # One number per range.
    buckets = parts.where(F.col("kind") == _FIRST).select("bucket")
    ahead = Window.orderBy("bucket")
    whole = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    next_of = buckets.select("bucket", F.coalesce(F.lead("bucket").over(ahead), F.first("bucket").over(whole)).alias("next_bucket"))
    ends = (
        parts.where(F.col("kind") == _LAST)
        .select("bucket", "doc_id", "text")
        .join(next_of, "bucket")
        .join(firsts, "next_bucket")
        .select("doc_id", "text", "following")
        .mapInArrow(_joined_ends(_arrow(result)), result)
    )
    found = parts.where(F.col("kind") == _ROW).select(*result.names).union(ends)
    return found.select(
        "doc_id",
        "n_chars",
        *[F.lower(F.hex(name)).alias(name) for name in ("edited_sha256", "fingerprint", "edited_fingerprint")],
        "near_edited",
        "near_next",
    )


def _arrow(schema: T.StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(schema)
