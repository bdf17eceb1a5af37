"""SimHash fingerprints of documents, and groups of those that differ in few bits."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from marginfold.llm.components import connected_components
from marginfold.sources.scratch import written

SHINGLE_WORDS = 3
SEED = 42
BITS = 64
MAX_DIFFERENCE = 2
SEGMENT_BITS = 32
FULL_BUCKET = 48


def fingerprint(text: bytes | None) -> int:
    """The unsigned 64-bit SimHash of a text's 3-word shingles, repeats included.

    A-Z are lower-cased, and words are split at ASCII white space. A text of fewer words is one
    shingle; one without words, or null, has fingerprint zero.
    """
    words = (text or b"").lower().split()
    if not words:
        return 0
    shingles = map(b" ".join, zip(words, words[1:], words[2:])) if len(words) >= SHINGLE_WORDS else [b" ".join(words)]
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(shingle, SEED) for shingle in shingles], dtype=">u8")
    ones = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(hashes)).tobytes(), "big")


def _with_fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = batch.column(1).cast(pa.binary())
        prints = np.fromiter((fingerprint(text.as_py()) for text in texts), np.uint64, len(texts))
        yield pa.record_batch([batch.column(0), pa.array(prints.view(np.int64))], names=["doc_id", "print"])


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, print) of every document; ``print`` is the fingerprint as a signed long."""
    id_type = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", F.col("text").cast("binary").alias("text")).mapInArrow(
        _with_fingerprints, f"doc_id {id_type}, print bigint"
    )


# A print is cut into two segments of 32 bits. Where two prints differ in at most two bits, one of
# the segments differs in at most one, so both prints have a variant of it with one bit taken out
# in common. ``bit`` numbers the variants, 0-31 for the low segment and 32-63 for the high one.
_INDEX = {
    "own": "shiftrightunsigned(print, 32 * (bit div 32)) & 4294967295L",
    "other": "shiftrightunsigned(print, 32 * (1 - bit div 32)) & 4294967295L",
    "wild": "shiftleft(1L, bit % 32)",
    "key": "shiftleft(cast(bit as bigint), 32) | (own & ~wild)",
}

# A link is found once: at the differing bit of the segment, or at its first bit if none differs.
_LINK = """
    a.print < b.print AND bit_count(a.print ^ b.print) <= 2
    AND ((a.own ^ b.own) = a.wild OR (a.own = b.own AND a.wild = 1L))
"""


def _index(prints: DataFrame) -> DataFrame:
    indexed = prints.select("print", F.explode(F.sequence(F.lit(0), F.lit(BITS - 1))).alias("bit"))
    for name, value in _INDEX.items():
        indexed = indexed.withColumn(name, F.expr(value))
    return indexed.select("print", "own", "other", "wild", "key")


def _links_in_full_buckets(members: DataFrame) -> DataFrame:
    """Links inside buckets too full for comparing their pairs.

    Every member gets keys with a second bit taken out: of the other segment, or both of the other
    segment where the own one is equal. Prints that share such a key differ in at most those two
    bits, so a key has at most four prints and each pair of them is a link.
    """
    positions = F.sequence(F.lit(0), F.lit(SEGMENT_BITS - 1))
    one = members.withColumn("j", F.explode(positions)).select(
        "print", F.col("key").alias("k1"), F.expr("shiftleft(cast(j as bigint), 32) | (other & ~shiftleft(1L, j))").alias("k2")
    )
    two = (
        members.where("wild = 1L")
        .withColumn("j", F.explode(positions))
        .withColumn("k", F.explode(positions))
        .where("j < k")
        .select(
            "print",
            F.expr("-1 - (own | (shiftrightunsigned(key, 37) << 32))").alias("k1"),
            F.expr(
                "shiftleft(cast(64 + 32 * j + k as bigint), 32) | (other & ~(shiftleft(1L, j) | shiftleft(1L, k)))"
            ).alias("k2"),
        )
    )
    return (
        one.union(two)
        .groupBy("k1", "k2")
        .agg(F.min("print").alias("a"), F.collect_set("print").alias("all"))
        .where(F.size("all") > 1)
        .select("a", F.explode("all").alias("b"))
        .where("a <> b")
        .distinct()
    )


def links(prints: DataFrame, full_bucket: int = FULL_BUCKET) -> DataFrame:
    """(a, b): pairs of different prints that keep all links of at most two differing bits connected.

    Deletion-variant index: every print is stored under its 64 one-wildcard segment variants, prints
    with a variant in common are joined on it and verified. Variants of more than ``full_bucket``
    prints are cut finer instead of comparing their pairs; no candidate is dropped.
    """
    index = _index(prints)
    full = index.groupBy("key").count().where(F.col("count") > full_bucket).select("key")
    full = written(full)
    if full.isEmpty():
        return _linked_by_key(index)
    usual = index.join(full, "key", "left_anti")
    return _linked_by_key(usual).union(_links_in_full_buckets(index.join(full, "key", "left_semi")))


def _linked_by_key(index: DataFrame) -> DataFrame:
    """(a, b): links among index rows that share a key.

    Both sides are sorted and merged: the planner does not see that a print has 64 rows here, and would
    broadcast an index of a hundred times its threshold.
    """
    pairs = index.alias("a").join(index.alias("b").hint("merge"), F.expr("a.key = b.key AND " + _LINK))
    return pairs.select(F.col("a.print").alias("a"), F.col("b.print").alias("b"))


def near_duplicates(docs: DataFrame, full_bucket: int = FULL_BUCKET) -> DataFrame:
    """(doc_id, fingerprint, component_id) of every document of ``docs`` (doc_id, text, ...).

    ``component_id`` is the least doc_id that a chain of links of at most two differing bits
    reaches, itself included. Copies share one fingerprint and are linked as one; texts without
    words, empty or null, share fingerprint zero. A null doc_id gives a row but never a
    component_id, which is null only where no document of the group has an id; repeated rows are
    returned as often as they occur. Columns besides doc_id and text are ignored. Fingerprints are
    computed once and written to the shared folder.
    """
    prints = written(fingerprints(docs))
    nodes = prints.groupBy("print").agg(F.min("doc_id").alias("least_id"))
    nodes = written(nodes)
    roots = written(connected_components(written(links(nodes.select("print"), full_bucket))))
    rooted = nodes.join(roots.withColumnRenamed("node", "print"), "print")
    grouped = rooted.groupBy("root").agg(F.min("least_id").alias("component_id"))
    grouped = rooted.select("print", "root").join(grouped, "root").select("print", "component_id")
    alone = nodes.join(roots, nodes["print"] == roots["node"], "left_anti").select(
        "print", F.col("least_id").alias("component_id")
    )
    return prints.join(grouped.union(alone), "print").select(
        "doc_id", F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"), "component_id"
    )


def one_of_each_group(docs: DataFrame) -> DataFrame:
    """The documents whose id is the component_id of their group, with all their columns.

    Of rows that repeat an id, one stays. Groups without any id are kept whole.
    """
    groups = written(near_duplicates(docs))
    leaving = groups.where("doc_id <> component_id OR (doc_id IS NULL AND component_id IS NOT NULL)")
    kept = docs.join(
        leaving.select(F.col("doc_id").alias("__leaving")).distinct(),
        docs["doc_id"].eqNullSafe(F.col("__leaving")),
        "left_anti",
    )
    repeated = groups.where("doc_id IS NOT NULL").groupBy("doc_id").count().where("count > 1")
    if repeated.isEmpty():
        return kept
    twice = kept.join(repeated.select("doc_id"), "doc_id", "left_semi").select(*docs.columns)
    once = kept.join(repeated.select(F.col("doc_id").alias("__id")), kept["doc_id"] == F.col("__id"), "left_anti")
    return once.unionByName(twice.dropDuplicates(["doc_id"]))
