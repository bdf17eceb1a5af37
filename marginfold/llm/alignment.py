"""Alignment of the tokens of two tokenizers over the same bytes, by merge-path partitioning.

The ends of a text's tokens, as byte offsets, are two ascending lists. Merging them is a path through a
grid; each diagonal of the grid meets it in one point, found by binary search. So diagonals at equal
distances cut the merge of all texts of a block into pieces of equal work that need nothing of one
another, however long one text is. A piece emits the ends that both lists have in it; an end that a cut
separates, the one list's in the piece before and the other's in the piece behind, is stitched. Common
ends close the groups: the least runs of tokens of both sides that cover the same bytes.

Which pairs of ids end together how often in the whole corpus is counted with Spark: a block lists its
distinct pairs once, these are added up by pair, and each block gets back the totals of its own pairs.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import sentencepiece
import tiktoken
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F, types as T
from tokenizers import Tokenizer

from marginfold.llm import byte_bpe
from marginfold.llm.token_counts import PATTERN, Vocabulary
from marginfold.llm.worker import kept
from marginfold.sources.scratch import written

BLOCK_BYTES = 8 << 20
PIECE_STEPS = 1 << 16
_LONG_TEXT = 1 << 16
# Libraries agree on which of these characters are letters; newer letters are in some tables only.
_OTHER = re.compile("[^\x00-ӿ]")


def diagonal_cuts(a_ends: np.ndarray, b_ends: np.ndarray, diagonals: np.ndarray) -> np.ndarray:
    """For each diagonal d the number of a's among the first d merged ends, equal ends of a before those of b."""
    low = np.maximum(0, diagonals - len(b_ends))
    high = np.minimum(diagonals, len(a_ends))
    while True:
        searched = low < high
        if not searched.any():
            return low
        middle = (low + high) // 2
        at = middle[searched]
        further = np.zeros(len(low), bool)
        further[searched] = a_ends[at] <= b_ends[diagonals[searched] - at - 1]
        low = np.where(searched & further, middle + 1, low)
        high = np.where(searched & ~further, middle, high)


def _merged_piece(a_ends: np.ndarray, b_ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places in a and in b of the ends that both have."""
    if not len(a_ends) or not len(b_ends):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    at = np.searchsorted(a_ends, b_ends)
    both = a_ends[np.minimum(at, len(a_ends) - 1)] == b_ends
    return at[both], np.flatnonzero(both)


def common_ends(a_ends: np.ndarray, b_ends: np.ndarray, piece_steps: int = PIECE_STEPS) -> tuple[np.ndarray, np.ndarray]:
    """Places in ``a_ends`` and ``b_ends``, both strictly ascending, of the ends that they share, in order."""
    total = len(a_ends) + len(b_ends)
    diagonals = np.append(np.arange(0, total, piece_steps), total)
    a_cuts = diagonal_cuts(a_ends, b_ends, diagonals)
    b_cuts = diagonals - a_cuts
    found = []
    for a_from, a_to, b_from, b_to in zip(a_cuts, a_cuts[1:], b_cuts, b_cuts[1:]):
        if found and a_from and b_from < len(b_ends) and a_ends[a_from - 1] == b_ends[b_from]:
            found.append((np.array([a_from - 1]), np.array([b_from])))
        in_a, in_b = _merged_piece(a_ends[a_from:a_to], b_ends[b_from:b_to])
        found.append((in_a + a_from, in_b + b_from))
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return tuple(np.concatenate(places) for places in zip(*found))


class Sides:
    """Both tokenizers: a text behind a space to its ids, and the bytes of each id."""

    def __init__(self, a_path: str, b_path: str) -> None:
        vocabulary = Vocabulary.read(a_path)
        self._a = tiktoken.Encoding("a", pat_str=PATTERN, mergeable_ranks=vocabulary.tokens, special_tokens={})
        self._a_library = Tokenizer.from_file(a_path)
        # Strings of special tokens are plain text.
        self._a_library.encode_special_tokens = True
        self._b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        pieces = [self._b.id_to_piece(number) for number in range(self._b.get_piece_size())]
        self.b_bytes = [bytes([int(piece[3:5], 16)]) if self._b.is_byte(number) else piece.replace("▁", " ").encode() for number, piece in enumerate(pieces)]
        self.a_bytes = [b""] * (max(vocabulary.tokens.values()) + 1)
        for token, number in vocabulary.tokens.items():
            self.a_bytes[number] = token
        self.a_lengths = np.array([len(token) for token in self.a_bytes], np.int64)
        self.b_lengths = np.array([len(token) for token in self.b_bytes], np.int64)
        # No token reaches from another character over a space: a text can be cut there.
        self._b_splits = not any(re.search("[^▁]▁", piece) for piece in pieces)
        # Ids in decimal as they stand in a list of groups: within a side of a group, or at its end.
        a_names, b_names = ([str(number).encode() for number in range(len(side))] for side in (self.a_bytes, self.b_bytes))
        endings = [(a_names, b","), (a_names, b"|"), (b_names, b","), (b_names, b";")]
        self.names = np.array([name + mark for names, mark in endings for name in names], object)

    def _encode_a(self, text: str) -> np.ndarray:
        if _OTHER.search(text):
            return np.array(self._a_library.encode(text, add_special_tokens=False).ids, np.int64)
        return byte_bpe.encode(self._a, text).astype(np.int64)

    def encode(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """Ids of both sides; none where the text is empty or one side's bytes are not those of the text."""
        none = np.zeros(0, np.int64), np.zeros(0, np.int64)
        if not text:
            return none
        spaced = " " + text
        parts = byte_bpe.safe_pieces(spaced, _LONG_TEXT) if self._b_splits else [spaced]
        a, b = zip(*((self._encode_a(part), np.array(self._b.encode(part[1:]), np.int64)) for part in parts))
        a, b = np.concatenate(a), np.concatenate(b)
        data = spaced.encode()
        for ids, lengths, tokens in ((a, self.a_lengths, self.a_bytes), (b, self.b_lengths, self.b_bytes)):
            if lengths[ids].sum() != len(data) or b"".join(map(tokens.__getitem__, ids.tolist())) != data:
                return none
        return a, b


@dataclass
class Block:
    """The tokens of some texts one after another, cut into groups. All ends are offsets in the joined texts."""

    a_ids: np.ndarray
    b_ids: np.ndarray
    a_per_text: np.ndarray
    b_per_text: np.ndarray
    link_a: np.ndarray
    link_b: np.ndarray

    @classmethod
    def of(cls, sides: Sides, encoded: list[tuple[np.ndarray, np.ndarray]], piece_steps: int = PIECE_STEPS) -> Block:
        a_ids, b_ids = (np.concatenate([np.zeros(0, np.int64), *ids]) for ids in zip(*encoded))
        counts = [np.array([len(ids) for ids in side], np.int64) for side in zip(*encoded)]
        links = common_ends(np.cumsum(sides.a_lengths[a_ids]), np.cumsum(sides.b_lengths[b_ids]), piece_steps)
        return cls(a_ids, b_ids, *counts, *links)

    def links_before(self) -> np.ndarray:
        """Number of links before each text, and behind the last."""
        return np.searchsorted(self.link_a, np.append(0, np.cumsum(self.a_per_text)))

    def group_sizes(self) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of tokens of each side in each group."""
        return np.diff(self.link_a, prepend=-1), np.diff(self.link_b, prepend=-1)

    def digests(self, sides: Sides) -> list[str]:
        """SHA-256 of each text's groups written as decimal ids, ``a1,a2|b1;a3|b2,b3``; '' without tokens."""
        a_sizes, b_sizes = self.group_sizes()
        n_a, n_b = len(sides.a_bytes), len(sides.b_bytes)
        a_names, b_names = self.a_ids.copy(), self.b_ids + 2 * n_a
        a_names[self.link_a] += n_a
        b_names[self.link_b] += n_b
        names = np.empty(len(a_names) + len(b_names), np.int64)
        # Before a token of a stand the groups before it, of both sides; before one of b also its group's a's.
        names[np.arange(len(a_names)) + np.repeat(np.append(0, self.link_b + 1)[:-1], a_sizes)] = a_names
        names[np.arange(len(b_names)) + np.repeat(self.link_a + 1, b_sizes)] = b_names
        written_out = sides.names[names].tolist()
        ends = np.cumsum(self.a_per_text + self.b_per_text).tolist()
        parts = (written_out[start:end] for start, end in zip([0, *ends], ends))
        return [hashlib.sha256(b"".join(part)[:-1]).hexdigest() if part else "" for part in parts]


def _blocks(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[tuple[list, list[str]]]:
    ids, texts, held = [], [], 0
    for batch in batches:
        for doc_id, value in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
            text = value.as_py() or ""
            ids.append(doc_id)
            texts.append(text)
            held += len(text) + 64
            if held >= size:
                yield ids, texts
                ids, texts, held = [], [], 0
    if ids:
        yield ids, texts


def _sides(a_path: str, b_path: str) -> Sides:
    return kept(f"tokenizers {a_path} {b_path}", lambda: Sides(a_path, b_path))


def _counted_blocks(a_path: str, b_path: str, schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sides = _sides(a_path, b_path)
        first = TaskContext.get().partitionId() << 32
        for number, (ids, texts) in enumerate(_blocks(batches, BLOCK_BYTES)):
            block = Block.of(sides, [sides.encode(text) for text in texts])
            before = block.links_before()
            links = block.a_ids[block.link_a] * len(sides.b_bytes) + block.b_ids[block.link_b]
            pairs, place, n = np.unique(links, return_inverse=True, return_counts=True)
            text_of = np.repeat(np.arange(len(texts)), np.diff(before))
            cells, in_text = np.unique(text_of * max(1, len(pairs)) + place, return_counts=True)
            packed = zstandard.compress(np.diff(cells, prepend=0).astype("<i8").tobytes() + in_text.astype("<i8").tobytes(), 1)
            columns = zip(ids, block.a_per_text.tolist(), block.b_per_text.tolist(), np.diff(before).tolist(), block.digests(sides))
            docs = [dict(zip(("doc_id", "n_a", "n_b", "n_groups", "groups_sha256"), row)) for row in columns]
            listed = [{"pair": pair, "n": times} for pair, times in zip(pairs.tolist(), n.tolist())]
            row = {"block": first + number, "docs": docs, "cells": packed, "pairs": listed}
            yield pa.RecordBatch.from_pylist([row], schema)

    return run


def _scored(schema: pa.Schema):
    """Adds up what the corpus-wide counts of a block's pairs give each of its texts."""

    def run(block: pa.Table, told: pa.Table) -> pa.Table:
        found = block.to_pylist()[0]
        docs = found["docs"]
        n_pairs = told.num_rows
        count, best = np.zeros(n_pairs, np.int64), np.zeros(n_pairs, np.int64)
        place = told.column("place").to_numpy()
        count[place] = told.column("count").to_numpy()
        best[place] = told.column("best").to_numpy(zero_copy_only=False)
        # Cells are pairs within texts in order: their number, and how often the pair is in the text.
        cells, in_text = np.frombuffer(zstandard.decompress(found["cells"]), "<i8").reshape(2, -1)
        cells = np.cumsum(cells)
        text, pair = cells // max(1, n_pairs), cells % max(1, n_pairs)
        starts = np.flatnonzero(np.diff(text, prepend=-1))
        sums = {name: np.zeros(len(docs), np.int64) for name in ("n_links", "n_best", "count_sum")}
        if len(starts):
            for name, weight in (("n_links", 1), ("n_best", best[pair]), ("count_sum", count[pair])):
                sums[name][text[starts]] = np.add.reduceat(in_text * weight, starts)
        columns = [pa.array(sums[field.name]) if field.name in sums else pa.array([doc[field.name] for doc in docs], field.type) for field in schema]
        return pa.table(columns, schema=schema)

    return run


def _arrow(schema: T.StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(schema)


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))


def align_texts(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """(doc_id, a_ids, b_ids, groups) of every whole text: the tokens of both sides and how they are grouped.

    ``groups`` are structs (n_a, n_b): how many of the next tokens of each side form the group. ``a_path``
    is a byte-level BPE file, given the text behind a space; ``b_path`` a sentencepiece model, which adds
    that space. A text that is null or empty, or whose tokens of a side do not spell it (as one with the
    character that stands for spaces), has no tokens. Repeated rows repeat, other columns are ignored.
    """
    pair = T.StructType([T.StructField("n_a", T.IntegerType()), T.StructField("n_b", T.IntegerType())])
    ids = T.ArrayType(T.IntegerType())
    schema = T.StructType([docs.schema["doc_id"], T.StructField("a_ids", ids), T.StructField("b_ids", ids), T.StructField("groups", T.ArrayType(pair))])
    out = _arrow(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sides = _sides(a_path, b_path)
        for doc_ids, texts in _blocks(batches, BLOCK_BYTES // 8):
            encoded = [sides.encode(text) for text in texts]
            block = Block.of(sides, encoded)
            sizes = [{"n_a": a, "n_b": b} for a, b in zip(*(side.tolist() for side in block.group_sizes()))]
            ends = block.links_before().tolist()
            rows = [
                {"doc_id": doc_id, "a_ids": a.tolist(), "b_ids": b.tolist(), "groups": sizes[start:end]}
                for doc_id, (a, b), start, end in zip(doc_ids, encoded, ends, ends[1:])
            ]
            yield pa.RecordBatch.from_pylist(rows, out)

    return _texts(docs).mapInArrow(run, schema)


def alignment_counts(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) of every whole text.

    A link is a pair of tokens, one of each side, that end together; the count of its pair of ids is the
    number of links between such tokens in all texts. ``n_best`` links have the highest count that a pair
    with their b has, ties included; ``count_sum`` adds the counts of the links. Texts, nulls, repeats
    and other columns as in ``align_texts``; no rows give none.

    Tokens never leave their block of about ``BLOCK_BYTES`` of texts. What is shuffled is one row per block
    and distinct pair of ids, so a pair that is in every text is no larger than its number of blocks.
    """
    doc = T.StructType(
        [
            docs.schema["doc_id"],
            *[T.StructField(name, T.LongType()) for name in ("n_a", "n_b", "n_groups")],
            T.StructField("groups_sha256", T.StringType()),
        ]
    )
    pair = T.StructType([T.StructField("pair", T.LongType()), T.StructField("n", T.LongType())])
    blocks_schema = T.StructType(
        [
            T.StructField("block", T.LongType()),
            T.StructField("docs", T.ArrayType(doc)),
            T.StructField("cells", T.BinaryType()),
            T.StructField("pairs", T.ArrayType(pair)),
        ]
    )
    blocks = written(_texts(docs).mapInArrow(_counted_blocks(a_path, b_path, _arrow(blocks_schema)), blocks_schema))
    asked = blocks.select("block", F.posexplode("pairs").alias("place", "one")).select("block", "place", "one.pair", "one.n")
    n_b = sentencepiece.SentencePieceProcessor(model_file=b_path).get_piece_size()
    # A window holds the pairs of one id of b: at most the other vocabulary.
    highest = F.max("count").over(Window.partitionBy(F.col("pair") % n_b))
    counted = asked.groupBy("pair").agg(F.sum("n").alias("count")).withColumn("best", F.col("count") == highest)
    told = asked.join(counted, "pair").select(F.col("block").alias("of"), "place", "count", "best")
    result = T.StructType(
        [*doc.fields[:4], *[T.StructField(name, T.LongType()) for name in ("n_links", "n_best", "count_sum")], doc.fields[4]]
    )
    return blocks.select("block", "docs", "cells").groupBy("block").cogroup(told.groupBy("of")).applyInArrow(_scored(_arrow(result)), result)
