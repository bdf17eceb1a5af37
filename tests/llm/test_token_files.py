import random
import struct
import time
import zlib
from io import BytesIO

import numpy as np
import public_tokenizers
import pytest
import zstandard
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from marginfold.llm.token_files import Encoder, TokenFile, pieces_of, read_documents, read_tokens, write_file, write_tokens
from marginfold.sources.scratch import scratch_folder

PATH = public_tokenizers.path("byte_bpe_50k.json")
LIBRARY = Tokenizer.from_file(PATH)
ENCODER = Encoder(PATH)


@given(st.lists(st.sampled_from([" ", "  ", "a", "É", "'s", "1", ".", "\n", "\t", "\x1c", "\x85", "\u3000", "<|endoftext|>", "word", "🙂", ".,!", "²", "ñ.", "'", "\r"]), max_size=25))
@settings(max_examples=1500, deadline=None)
def test_pieces_give_the_ids_of_the_text(parts):
    text = "".join(parts)
    assert "".join(pieces_of(text)) == text
    assert ENCODER.encode([text])[0].tolist() == [*LIBRARY.encode(text, add_special_tokens=False).ids, 0]


def _documents(n=200):
    rng = random.Random(1)
    return [(None if i == 0 else i, np.array([rng.randrange(50257) for _ in range(rng.choice([0, 1, 30, 900]))], np.uint32)) for i in range(n)]


def _file(documents, frame_tokens=1000):
    sink = BytesIO()
    write_file(sink, documents, frame_tokens)
    return sink


def test_file_round_trip_and_random_access():
    documents = _documents()
    tokens = TokenFile(_file(documents))
    assert len(tokens.frames) > 10
    assert [(i, t.tolist()) for i, t in tokens.documents()] == [(i, t.tolist()) for i, t in documents]
    for place in (0, 1, 57, 199):
        assert tokens.document(place).tolist() == documents[place][1].tolist()


def test_any_zstandard_reader_reads_the_frames():
    documents = _documents()
    content = zstandard.ZstdDecompressor().stream_reader(BytesIO(_file(documents).getvalue()), read_across_frames=True).read()
    assert content == b"".join(t.astype("<u4").tobytes() for _, t in documents)


def test_one_document_reads_one_frame():
    sink = _file(_documents())
    tokens = TokenFile(sink)
    damaged = bytearray(sink.getvalue())
    damaged[int(tokens.offsets[0]) + 12] ^= 1
    last = TokenFile(BytesIO(bytes(damaged)))
    assert last.document(199).tolist() == _documents()[199][1].tolist()
    with pytest.raises((ValueError, zstandard.ZstdError)):
        list(last.documents())


def test_damaged_tail_is_noticed():
    content = _file(_documents()).getvalue()
    for broken in (content[:-1], content[:-9] + struct.pack("<IBI", 3, 128, 0x8F92EAB1)):
        with pytest.raises(ValueError):
            TokenFile(BytesIO(broken))


def test_empty_file():
    assert list(TokenFile(_file([])).documents()) == []


def test_documents_read_back(spark):
    texts = {5: "five words and more", 3: "", 9: None, 4: "É 🙂 <|endoftext|> x", 7: "long " * 60000, None: "no id"}
    rows = [(i, t, 1) for i, t in texts.items()] + [(3, "", 2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, start int")
    folder = scratch_folder(spark)
    manifest = write_tokens(docs, PATH, folder, documents_per_file=2)
    assert manifest.count() > 1
    start, expected = 0, []
    for doc_id in [None, 3, 3, 4, 5, 7, 9]:
        ids = [*LIBRARY.encode(texts[doc_id] or "", add_special_tokens=False).ids, 0]
        expected.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    got = [tuple(r) for r in read_tokens(manifest, folder).collect()]
    assert sorted(got, key=lambda r: r[1]) == expected
    assert [row["ids"] for row in read_documents(manifest, folder, [9]).collect()] == [[0]]
    some = read_documents(manifest, folder, [3, 5, 8]).collect()
    by_id = [(doc_id, [*LIBRARY.encode(texts[doc_id], add_special_tokens=False).ids, 0]) for doc_id in (3, 3, 5)]
    assert sorted((row["doc_id"], row["ids"]) for row in some) == by_id
    assert read_documents(manifest, folder, []).count() == 0
    empty = write_tokens(docs.limit(0), PATH, scratch_folder(spark))
    assert read_tokens(empty, folder).count() == 0


def test_files_roll_over_and_equal_rows_split(spark):
    docs = spark.createDataFrame([(1, "same text")] * 300 + [(i, "word " * i) for i in range(2, 40)], "doc_id long, text string")
    folder = scratch_folder(spark)
    manifest = write_tokens(docs.repartition(3), PATH, folder, file_tokens=100)
    assert manifest.groupBy("bucket").count().where("count > 2").count() > 0
    found = read_tokens(manifest, folder).orderBy("start").collect()
    assert [row["doc_id"] for row in found] == [1] * 300 + list(range(2, 40))
    assert [row["start"] for row in found] == np.cumsum([0, *[row["n_tokens"] for row in found[:-1]]]).tolist()
    assert read_documents(manifest, folder, [1]).count() == 300


@pytest.mark.parametrize("text", [" " * 2_000_000, "x" + "\n" * 1_000_000 + "y", "x " + " \t" * 700_000 + "y z", "a" * 2_000_000, "\u3000" * 500_000 + "b"])
def test_very_long_texts(text):
    started = time.process_time()
    assert ENCODER.encode([text])[0].tolist() == [*LIBRARY.encode(text, add_special_tokens=False).ids, 0]
    assert time.process_time() - started < 60
