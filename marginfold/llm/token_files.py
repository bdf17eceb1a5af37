"""Token ids in seekable zstandard files: one independent frame per group of documents.

A file holds whole documents in ascending order of their ids. Its layout:

* frames: each an independent zstandard frame of the ids of some documents as little-endian unsigned
  32-bit integers; a document is never cut, and a large one has a frame of its own;
* a skippable frame (magic 0x184D2A50) with the document index: per document its id (signed 64 bits),
  whether the id is null (1 byte) and its number of tokens (unsigned 64 bits), column by column;
* a skippable frame (magic 0x184D2A5E) with the seek table of the public seekable format: per frame
  its compressed and decompressed size and the low 32 bits of the XXH64 of its content, then the number
  of frames, a descriptor byte and the magic number 0x8F92EAB1.

So a reader finds from the end of the file which frames hold a document and decompresses only those.
"""

from __future__ import annotations

import re
import struct
import uuid
import zlib
from array import array
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from operator import attrgetter

import numpy as np
import pyarrow as pa
import pyarrow.fs as fs
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window, functions as F
from tokenizers import Tokenizer

from marginfold.llm.worker import kept
from marginfold.sources.scratch import written

END_OF_DOCUMENT = 0
FRAME_TOKENS = 1 << 18
LEVEL = 3
_INDEX_MAGIC, _TABLE_MAGIC, _SEEKABLE = 0x184D2A50, 0x184D2A5E, 0x8F92EAB1
_CHECKSUMS = 1 << 7
_CACHE_PIECES = 600_000
# Punctuation of one class of the pre-splitter that is part of no contraction and no special token.
MARKS = '.,!?;:()"%&$#*'
FILE_TOKENS = 1 << 24
DOCUMENTS_PER_FILE = 1 << 20
_LONE_SPACE = re.compile(r"(?<=\S)(?= \S)")
_ID = attrgetter("id")
_END = array("I", [END_OF_DOCUMENT]).tobytes()
MOST_READERS = 10_000


def _skippable(magic: int, content: bytes) -> bytes:
    return struct.pack("<II", magic, len(content)) + content


def write_file(sink, documents: Iterable[tuple[int | None, np.ndarray]], frame_tokens: int = FRAME_TOKENS) -> tuple[int, int]:
    """Write (doc_id, ids) pairs to an open binary file; returns the numbers of documents and of tokens."""
    compressor = zstandard.ZstdCompressor(level=LEVEL, write_content_size=True)
    table, ids, nulls, counts = [], [], [], []
    pending: list[np.ndarray] = []
    n_pending = 0

    def flush() -> None:
        nonlocal n_pending
        content = b"".join(part.astype("<u4").tobytes() for part in pending)
        frame = compressor.compress(content)
        sink.write(frame)
        table.append(struct.pack("<III", len(frame), len(content), xxhash.xxh64_intdigest(content) & 0xFFFFFFFF))
        pending.clear()
        n_pending = 0

    for doc_id, tokens in documents:
        if n_pending and n_pending + len(tokens) > frame_tokens:
            flush()
        pending.append(tokens)
        n_pending += len(tokens)
        ids.append(doc_id or 0)
        nulls.append(doc_id is None)
        counts.append(len(tokens))
    if pending:
        flush()
    index = np.array(ids, "<i8").tobytes() + np.array(nulls, "u1").tobytes() + np.array(counts, "<u8").tobytes()
    sink.write(_skippable(_INDEX_MAGIC, index))
    sink.write(_skippable(_TABLE_MAGIC, b"".join(table) + struct.pack("<IBI", len(table), _CHECKSUMS, _SEEKABLE)))
    return len(ids), sum(counts)


@dataclass
class TokenFile:
    """Random access to one file given as an object that can seek and read."""

    source: object

    def __post_init__(self) -> None:
        end = self.source.seek(0, 2)
        self.source.seek(end - 9)
        n_frames, flags, magic = struct.unpack("<IBI", self.source.read(9))
        if magic != _SEEKABLE or flags != _CHECKSUMS:
            raise ValueError("no seek table with checksums at the end of the file")
        table_at = end - 9 - 12 * n_frames - 8
        self.source.seek(table_at)
        head = struct.unpack("<II", self.source.read(8))
        if head != (_TABLE_MAGIC, 12 * n_frames + 9):
            raise ValueError("the seek table is damaged")
        self.frames = np.frombuffer(self.source.read(12 * n_frames), "<u4").reshape(n_frames, 3).astype(np.int64)
        self.offsets = np.concatenate([[0], np.cumsum(self.frames[:, 0])]).astype(np.int64)
        self.source.seek(int(self.offsets[-1]))
        magic, size = struct.unpack("<II", self.source.read(8))
        if magic != _INDEX_MAGIC or size % 17 or int(self.offsets[-1]) + 8 + size != table_at:
            raise ValueError("the document index is damaged")
        index, n = self.source.read(size), size // 17
        nulls = np.frombuffer(index, "u1", n, 8 * n).astype(bool)
        self.doc_ids = [None if null else int(i) for i, null in zip(np.frombuffer(index, "<i8", n), nulls)]
        self.counts = np.frombuffer(index[9 * n :], "<u8").astype(np.int64)
        self.starts = np.concatenate([[0], np.cumsum(self.counts)]).astype(np.int64)
        self.frame_starts = np.concatenate([[0], np.cumsum(self.frames[:, 1] // 4)]).astype(np.int64)

    def frame(self, number: int) -> np.ndarray:
        """The ids of one frame, checked against its size and checksum."""
        self.source.seek(int(self.offsets[number]))
        packed_size, size, checksum = self.frames[number]
        content = zstandard.ZstdDecompressor().decompress(self.source.read(int(packed_size)), max_output_size=int(size))
        if len(content) != size or xxhash.xxh64_intdigest(content) & 0xFFFFFFFF != checksum:
            raise ValueError(f"frame {number} is damaged")
        return np.frombuffer(content, "<u4")

    def document(self, place: int) -> np.ndarray:
        """The ids of the document at a place in the file, from its frame alone."""
        number = int(np.searchsorted(self.frame_starts, self.starts[place], "right")) - 1
        start = int(self.starts[place] - self.frame_starts[number])
        return self.frame(number)[start : start + int(self.counts[place])]

    def documents(self) -> Iterator[tuple[int | None, np.ndarray]]:
        """All documents in order; every frame is decompressed once."""
        place = 0
        for number in range(len(self.frames)):
            ids = self.frame(number)
            until = self.frame_starts[number + 1]
            while place < len(self.counts) and self.starts[place + 1] <= until:
                start = int(self.starts[place] - self.frame_starts[number])
                yield self.doc_ids[place], ids[start : start + int(self.counts[place])]
                place += 1


class _Known(dict):
    """Ids of pieces, learned when first asked for."""

    def __init__(self, learn) -> None:
        self._learn = learn

    def __missing__(self, piece: str) -> bytes:
        ids = self[piece] = self._learn(piece)
        return ids


class Encoder:
    """The tokenizers library on whole texts, a word at a time.

    A text is cut only where the byte-level pre-splitter and special tokens cannot reach across, so
    the ids of the pieces joined are those of the text. Words of letters go to the library's BPE model
    directly, other pieces through its whole pipeline. Ids of pieces are kept in a table of bounded size.
    """

    def __init__(self, path: str) -> None:
        self.tokenizer = Tokenizer.from_file(path)
        self.known = _Known(self._ids)
        self._letters = byte_letters()
        self._space = self._letters[ord(" ")]

    def _word(self, word: str) -> bytes:
        """Ids of letters, with or without a space before them: one match of the pre-splitter."""
        letters = word.replace(" ", chr(self._space)) if word.isascii() else word.encode().decode("latin-1").translate(self._letters)
        return array("I", map(_ID, self.tokenizer.model.tokenize(letters))).tobytes()

    def _ids(self, piece: str) -> bytes:
        if (piece[1:] if piece[:1] == " " else piece).isalpha():
            return self._word(piece)
        word = piece.rstrip(MARKS)
        if len(word) < len(piece) and (word[1:] if word[:1] == " " else word).isalpha():
            # Marks behind a word are a match of their own.
            return self.known[word] + self.known[piece[len(word) :]]
        return array("I", self.tokenizer.encode(piece, add_special_tokens=False).ids).tobytes()

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text with the end-of-document id behind them."""
        if len(self.known) > _CACHE_PIECES:
            self.known.clear()
        ids = self.known.__getitem__
        return [np.frombuffer(b"".join(map(ids, pieces_of(text))) + _END, np.uint32) for text in texts]


def byte_letters() -> dict[int, int]:
    """The character that stands for each byte in the vocabulary: itself where it prints, else one from U+0100 on."""
    printed = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [byte for byte in range(256) if byte not in set(printed)]
    return {byte: byte for byte in printed} | {byte: 256 + place for place, byte in enumerate(others)}


def _cut_at_spaces(text: str) -> list[str]:
    words = text.split(" ")
    if all(words) and list(map(str.strip, words)) == words:
        return [words[0], *map(" ".__add__, words[1:])]
    return _LONE_SPACE.split(text)


def pieces_of(text: str) -> list[str]:
    """The text cut before spaces, and before and after line ends, that stand alone between other characters.

    A space before another character always begins a match of the pre-splitter, and a line end alone
    is one. Where a line is empty or begins or ends with white space, the text is cut at spaces only.
    """
    lines = text.split("\n")
    if len(lines) == 1 or not all(lines) or list(map(str.strip, lines)) != lines:
        return _cut_at_spaces(text)
    pieces = _cut_at_spaces(lines[0])
    for line in lines[1:]:
        pieces.append("\n")
        pieces += _cut_at_spaces(line)
    return pieces


def _filesystem(folder: str) -> tuple[fs.FileSystem, str]:
    if folder.startswith("/"):
        return fs.LocalFileSystem(), folder
    if folder.startswith("file:"):
        return fs.LocalFileSystem(), "/" + folder.removeprefix("file:").lstrip("/")
    return fs.FileSystem.from_uri(folder)


def _qualified(spark: SparkSession, folder: str) -> str:
    """The folder with its store: one without is in Spark's default store, not on each executor's disk."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    store = path.getFileSystem(spark._jsc.hadoopConfiguration())
    return path.makeQualified(store.getUri(), store.getWorkingDirectory()).toString()


def _rolled(documents: Iterator[tuple], most_documents: int, most_tokens: int) -> Iterator[Iterator[tuple]]:
    """The documents in runs, one for each file; a run ends with the document that reaches a limit."""
    ahead = next(documents, None)

    def run() -> Iterator[tuple]:
        nonlocal ahead
        n_documents = n_tokens = 0
        while ahead is not None and n_documents < most_documents and n_tokens < most_tokens:
            n_documents += 1
            n_tokens += len(ahead[1])
            yield ahead
            ahead = next(documents, None)

    while ahead is not None:
        yield run()


def _writer(tokenizer_path: str, folder: str, most_documents: int, most_tokens: int):
    """Encodes and writes the documents of one partition, which come in order; yields a manifest row for each file."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = _filesystem(folder)
        encoder = kept(f"encoder of {tokenizer_path}", lambda: Encoder(tokenizer_path))
        bucket = None

        def documents() -> Iterator[tuple[int | None, np.ndarray]]:
            nonlocal bucket
            for batch in batches:
                for start in range(0, batch.num_rows, 256):
                    part = batch.slice(start, 256)
                    bucket = part.column("bucket")[0].as_py()
                    texts = [text or "" for text in part.column("text").to_pylist()]
                    yield from zip(part.column("doc_id").to_pylist(), encoder.encode(texts))

        for number, contents in enumerate(_rolled(documents(), most_documents, most_tokens)):
            # A task that runs twice writes its files twice; only manifest rows of the one that counts are kept.
            name = f"tokens-{bucket:06d}-{number:06d}-{uuid.uuid4().hex}.zst"
            store.create_dir(base, recursive=True)
            ids: list[int] = []

            def noted() -> Iterator[tuple]:
                for doc_id, tokens in contents:
                    if doc_id is not None and len(ids) < 2:
                        ids.append(doc_id)
                    elif doc_id is not None:
                        ids[1] = doc_id
                    yield doc_id, tokens

            with store.open_output_stream(f"{base}/{name}", compression=None) as sink:
                n_docs, n_tokens = write_file(sink, noted())
            row = {"bucket": bucket, "number": number, "file": name, "n_docs": n_docs, "n_tokens": n_tokens}
            yield pa.RecordBatch.from_pylist([row | {"first_id": min(ids, default=None), "last_id": max(ids, default=None)}], _MANIFEST_FIELDS)

    return run


_MANIFEST = "bucket int, number int, file string, n_docs bigint, n_tokens bigint, first_id bigint, last_id bigint"
_MANIFEST_FIELDS = pa.schema(
    [("bucket", pa.int32()), ("number", pa.int32()), ("file", pa.string()), *((name, pa.int64()) for name in ("n_docs", "n_tokens", "first_id", "last_id"))]
)


def write_tokens(
    docs: DataFrame, tokenizer_path: str, folder: str, documents_per_file: int = DOCUMENTS_PER_FILE, file_tokens: int = FILE_TOKENS
) -> DataFrame:
    """Encode ``docs`` (doc_id, text) and write files in ascending doc_id order; returns their manifest.

    Manifest rows (bucket, number, file, n_docs, n_tokens, first_id, last_id), a table written to the folder,
    name the files; bucket and number give their order. Documents are range-partitioned by doc_id, nulls
    first, into the session's number of shuffle partitions; each writes as many files as its documents
    fill. Rows that repeat an id are ordered by a hash of their text, and equal rows may be split. A null
    text is empty, and a table without rows makes no file. ``folder`` must be one that all executors share.
    """
    order = ["doc_id", "mix", "any"]
    dealt = (
        docs.select(
            F.col("doc_id").cast("bigint").alias("doc_id"), "text", F.xxhash64("text").alias("mix"), F.monotonically_increasing_id().alias("any")
        )
        .repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .select("doc_id", "text", F.spark_partition_id().alias("bucket"))
    )
    writer = _writer(tokenizer_path, _qualified(docs.sparkSession, folder), documents_per_file, file_tokens)
    return written(dealt.mapInArrow(writer, _MANIFEST), f"{folder}/manifest")


def _reader(folder: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = _filesystem(folder)
        for batch in batches:
            for name, start in zip(batch.column("file").to_pylist(), batch.column("start").to_pylist()):
                ids, starts, counts, checks = [], [], [], []
                with store.open_input_file(f"{base}/{name}") as source:
                    for doc_id, tokens in TokenFile(source).documents():
                        ids.append(doc_id)
                        starts.append(start)
                        counts.append(len(tokens))
                        checks.append(zlib.crc32(tokens.astype("<u4").tobytes()))
                        start += len(tokens)
                columns = [pa.array(values, pa.int64()) for values in (ids, starts, counts, checks)]
                yield pa.record_batch(columns, names=["doc_id", "start", "n_tokens", "ids_crc32"])

    return run


def read_tokens(manifest: DataFrame, folder: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, from the files of a manifest.

    ``start`` counts the ids of all documents before, over all files.
    """
    before = Window.orderBy("bucket", "number").rowsBetween(Window.unboundedPreceding, -1)
    placed = manifest.withColumn("start", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)).cast("bigint"))
    n_files = max(1, manifest.count())
    return (
        placed.select("file", "start")
        .repartition(min(n_files, MOST_READERS))
        .mapInArrow(_reader(_qualified(manifest.sparkSession, folder)), "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")
    )


def _chosen(folder: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = _filesystem(folder)
        for batch in batches:
            for name, doc_ids in zip(batch.column("file").to_pylist(), batch.column("wanted").to_pylist()):
                with store.open_input_file(f"{base}/{name}") as source:
                    tokens, wanted = TokenFile(source), set(doc_ids)
                    rows = [
                        {"doc_id": doc_id, "ids": tokens.document(place).tolist()}
                        for place, doc_id in enumerate(tokens.doc_ids)
                        if doc_id in wanted
                    ]
                yield pa.RecordBatch.from_pylist(rows, pa.schema([("doc_id", pa.int64()), ("ids", pa.list_(pa.int64()))]))

    return run


def read_documents(manifest: DataFrame, folder: str, doc_ids: Iterable[int]) -> DataFrame:
    """(doc_id, ids) of every document with one of some ids; one row for each row that was written.

    The manifest tells which files can hold them, and of these only the frames that do are decompressed.
    """
    given = F.array(*[F.lit(int(doc_id)).cast("bigint") for doc_id in doc_ids]).cast("array<bigint>")
    wanted = F.filter(given, lambda doc_id: doc_id.between(F.col("first_id"), F.col("last_id")))
    files = manifest.select("file", wanted.alias("wanted")).where("size(wanted) > 0")
    return files.mapInArrow(_chosen(_qualified(manifest.sparkSession, folder)), "doc_id bigint, ids array<bigint>")
