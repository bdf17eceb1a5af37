"""Byte-level BPE: whole texts to token ids with the tiktoken library, and ids back to bytes."""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame, functions as F

LONG_TEXT = 1 << 16
# A place between a character other than white space and a space followed by such a character is a
# boundary of the pre-splitting pattern: a space before another character always begins a match.
_SAFE = re.compile(r"(?<=\S)(?= \S)")
# The library gives up on longer runs of white space; they are split here as the pattern would.
_LONG_RUN = re.compile("[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]{4096,}")


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes and ranks of a rank file: base64 of the token, a space and the rank on each line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}


def encoding(path: str, pattern: str) -> tiktoken.Encoding:
    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=read_ranks(path), special_tokens={})


def safe_pieces(text: str, size: int = LONG_TEXT) -> Iterator[str]:
    """The text in pieces of about ``size`` characters, cut only where the pattern has a boundary.

    Text without such a place, as one very long word, stays in one piece.
    """
    start = 0
    while len(text) - start > size:
        cut = _SAFE.search(text, start + size)
        if not cut:
            break
        yield text[start : cut.start()]
        start = cut.start()
    yield text[start:] if start else text


def long_runs(text: str) -> Iterator[tuple[str, bool]]:
    """The text cut around long runs of white space, and whether a part is such a run: one match of the pattern.

    A match that begins with white space takes the run up to its last character, which goes with what
    follows; at the end of the text it takes all of the run.
    """
    start = 0
    for run in _LONG_RUN.finditer(text):
        end = run.end() if run.end() == len(text) else run.end() - 1
        if run.start() > start:
            yield text[start : run.start()], False
        yield text[run.start() : end], True
        start = end
    if start < len(text):
        yield text[start:], False


def encode(encoder: tiktoken.Encoding, text: str, long_text: int = LONG_TEXT) -> np.ndarray:
    """Token ids of a whole text; special strings in it are ordinary text.

    Texts longer than ``long_text`` are given to the library in parts, cut where the byte-level pattern has
    boundaries: the ids are the same.
    """
    if len(text) <= long_text:
        return encoder.encode_to_numpy(text, disallowed_special=())
    parts = []
    for part, is_run in long_runs(text):
        if is_run:
            parts.append(np.array(encoder._encode_single_piece(part), np.uint32))
        else:
            parts += [encoder.encode_to_numpy(piece, disallowed_special=()) for piece in safe_pieces(part, long_text)]
    return np.concatenate(parts)


def _round_trip(path: str, pattern: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoding(path, pattern)
        for batch in batches:
            counts, ids_hashes, text_hashes = [], [], []
            for value in batch.column(1):
                ids = encode(encoder, value.as_py() or "")
                counts.append(len(ids))
                ids_hashes.append(hashlib.sha256(ids.astype("<u4").tobytes()).hexdigest())
                text_hashes.append(hashlib.sha256(encoder.decode_bytes(ids.tolist())).hexdigest())
            yield pa.record_batch(
                [batch.column(0), pa.array(counts, pa.int64()), pa.array(ids_hashes, pa.string()), pa.array(text_hashes, pa.string())],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    return run


def _encoder(path: str, pattern: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoding(path, pattern)
        for batch in batches:
            ids = [encode(encoder, value.as_py() or "").astype("<i4") for value in batch.column(1)]
            ends = np.cumsum([0, *map(len, ids)], dtype=np.int32)
            flat = np.concatenate([np.zeros(0, np.int32), *ids])
            lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))
            yield pa.record_batch([batch.column(0), lists], names=["doc_id", "ids"])

    return run


def _decoder(path: str, pattern: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoding(path, pattern)
        for batch in batches:
            decoded = [encoder.decode_bytes(value.as_py() or []) for value in batch.column(1)]
            yield pa.record_batch([batch.column(0), pa.array(decoded, pa.binary())], names=["doc_id", "decoded"])

    return run


def _id_type(frame: DataFrame) -> str:
    return frame.schema["doc_id"].dataType.simpleString()


def encode_texts(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """(doc_id, ids array<int>) of every whole text; a null text has no ids. Other columns are ignored."""
    return docs.select("doc_id", "text").mapInArrow(_encoder(path, pattern), f"doc_id {_id_type(docs)}, ids array<int>")


def decode_ids(encoded: DataFrame, path: str, pattern: str) -> DataFrame:
    """(doc_id, decoded binary) of rows (doc_id, ids): the raw bytes, which need not be whole characters."""
    return encoded.select("doc_id", "ids").mapInArrow(_decoder(path, pattern), f"doc_id {_id_type(encoded)}, decoded binary")


def round_trip(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256): every text encoded and the ids decoded in one pass.

    The hashes are of the ids as little-endian unsigned 32-bit integers and of the decoded bytes. A
    null text counts as empty; repeated rows repeat, and columns besides doc_id and text are ignored.
    """
    return docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).mapInArrow(
        _round_trip(path, pattern), f"doc_id {_id_type(docs)}, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    )
