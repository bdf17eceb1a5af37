import hashlib
import re

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings, strategies as st

from marginfold.llm import byte_bpe
from marginfold.llm.byte_bpe import decode_ids, encode, encode_texts, encoding, round_trip, safe_pieces

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
TEXTS = ["", None, "One two  three\n\n four's", "É ñandú 你好 🙂 <|endoftext|>", "x" * 5000, ("word " * 30 + "\n\n  ") * 400]


@pytest.fixture(scope="module")
def encoder():
    return encoding(PATH, public_tokenizers.PATTERN)


@given(st.text(alphabet="aé '1 .\n\t  s<|", max_size=60))
@settings(max_examples=300, deadline=None)
def test_pieces_change_no_ids(text):
    encoder = test_pieces_change_no_ids.encoder
    assert "".join(safe_pieces(text, 3)) == text
    assert encode(encoder, text, 3).tolist() == encoder.encode_ordinary(text)


test_pieces_change_no_ids.encoder = encoding(PATH, public_tokenizers.PATTERN)


def test_round_trip_equals_library(spark, encoder):
    rows = [(i, text, "clash") for i, text in enumerate(TEXTS)] + [(None, "null id", "x"), (1, None, "again")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_tokens string")
    got = round_trip(docs, PATH, public_tokenizers.PATTERN).collect()
    expected = []
    for doc_id, text, _ in rows:
        ids = encoder.encode_ordinary(text or "")
        expected.append(
            (doc_id, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest())
        )
    assert sorted(map(tuple, got), key=str) == sorted(expected, key=str)
    assert round_trip(docs.limit(0), PATH, public_tokenizers.PATTERN).count() == 0


def test_encode_and_decode_apart(spark, encoder):
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    encoded = encode_texts(docs, PATH, public_tokenizers.PATTERN)
    assert {r["doc_id"]: r["ids"] for r in encoded.collect()} == {i: encoder.encode_ordinary(t or "") for i, t in enumerate(TEXTS)}
    decoded = decode_ids(encoded, PATH, public_tokenizers.PATTERN)
    assert {r["doc_id"]: bytes(r["decoded"]) for r in decoded.collect()} == {i: (t or "").encode() for i, t in enumerate(TEXTS)}


def test_decoding_part_of_a_character(spark, encoder):
    ids = encoder.encode_ordinary("🙂")
    frame = spark.createDataFrame([(1, ids[:1])], "doc_id long, ids array<int>")
    assert bytes(decode_ids(frame, PATH, public_tokenizers.PATTERN).first()["decoded"]) == encoder.decode_bytes(ids[:1])


@given(st.lists(st.sampled_from([" ", "  ", "\n", "\t", "\xa0", "　", "\x1c", "\x85", "a", "'s", "1", ".,", "É"]), max_size=30))
@settings(max_examples=500, deadline=None)
def test_long_runs_are_split_as_the_pattern_does(parts):
    text = "".join(parts)
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(byte_bpe, "_LONG_RUN", re.compile(byte_bpe._LONG_RUN.pattern.replace("4096", "3")))
        assert encode(test_pieces_change_no_ids.encoder, text, 4).tolist() == test_pieces_change_no_ids.encoder.encode_ordinary(text)


@pytest.mark.parametrize("unit", [" ", "\n", "\t", "\xa0", " \n", "a", "1", "!", "é"])
def test_five_million_characters_in_a_row(encoder, unit):
    text = "x" + unit * (5_000_000 // len(unit)) + "y"
    assert encoder.decode_bytes(encode(encoder, text).tolist()) == text.encode()
