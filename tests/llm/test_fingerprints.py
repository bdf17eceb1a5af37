import hashlib
import random

import numpy as np
import pytest

from marginfold.llm import fingerprints as lz
from marginfold.llm.queries import op13_fingerprints, table

FOLDER = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]


def phrases(text):
    """The set of phrases by the definition, the text's end being a character of its own."""
    found, phrase = set(), ""
    for character in [*text, "END"]:
        phrase += character
        if phrase not in found:
            found.add(phrase)
            phrase = ""
    return found


def brute_force(rows):
    """By whole texts: fingerprints of the edited text itself, parsed from its beginning."""
    hasher = lz.Hasher()
    own = [lz.fingerprints(hasher, "", text or "")[0] for _, text in rows]
    found = []
    for place, (doc_id, text) in enumerate(rows):
        text = text or ""
        following = (place + 1) % len(rows)
        n = len(text) // 4
        edited = text[: len(text) - n] + (rows[following][1] or "")[:n]
        print_of_edited = lz.fingerprints(hasher, "", edited)[0]
        found.append(
            (
                doc_id,
                len(text),
                hashlib.sha256(edited.encode()).hexdigest(),
                own[place].hex(),
                print_of_edited.hex(),
                lz.likeness(own[place], print_of_edited),
                lz.likeness(own[place], own[following]),
            )
        )
    return found


def test_the_parse_finds_the_phrases_of_the_definition():
    rng = random.Random(5)
    for _ in range(200):
        text = "".join(rng.choice("abé\U0001f600") for _ in range(rng.randint(0, 60)))
        codes = [*map(ord, text), lz._END]
        ends, _ = lz.parse(codes, {})
        parts = [tuple(codes[start:end]) for start, end in zip([0, *ends], ends)]
        letters = {"".join(map(chr, part[:-1])) + ("END" if part[-1] == lz._END else chr(part[-1])) for part in parts}
        assert len(parts) == len(set(parts)) and letters == phrases(text)


def test_a_shared_head_gives_the_fingerprints_of_whole_texts():
    hasher, rng = lz.Hasher(), random.Random(6)
    for _ in range(50):
        text = "".join(rng.choice("abcd ") for _ in range(rng.randint(0, 400)))
        cut = rng.randint(0, len(text))
        assert lz.fingerprints(hasher, text[:cut], text[cut:], "other") == [
            lz.fingerprints(hasher, "", whole)[0] for whole in (text, text[:cut] + "other")
        ]


def test_likeness_estimates_the_share_of_common_phrases():
    hasher, rng = lz.Hasher(), random.Random(7)
    errors = []
    for _ in range(40):
        left = "".join(rng.choice("abcdefgh ") for _ in range(800))
        right = left[: rng.randint(0, 800)] + "".join(rng.choice("abcdefgh ") for _ in range(200))
        a, b = phrases(left), phrases(right)
        estimated = lz.likeness(*(lz.fingerprints(hasher, "", text)[0] for text in (left, right)))
        errors.append(estimated - len(a & b) / len(a | b))
    assert abs(np.mean(errors)) < 0.02 and np.max(np.abs(errors)) < 0.2
    assert lz.likeness(*2 * lz.fingerprints(hasher, "", "")) == 1


def test_the_query_equals_brute_force(spark):
    rows = sorted((row.doc_id, row.text) for row in table(spark, FOLDER, "documents").select("doc_id", "text").collect())
    found = op13_fingerprints(spark, FOLDER)
    assert found.columns == COLUMNS
    assert sorted(map(tuple, found.collect())) == brute_force(rows)


def test_edits_stay_near_and_next_documents_do_not(spark):
    found = op13_fingerprints(spark, FOLDER).where("n_chars > 400").collect()
    assert sum(row.near_edited > row.near_next for row in found) > 0.95 * len(found)
    assert np.median([row.near_edited for row in found]) > 0.4


def test_nulls_repeats_ties_and_other_columns(spark):
    rows = [(None, "before all", 1), (3, None, 2), (3, None, 2), (5, "", 3), (7, "a" * 30, 4), (7, "a" * 30, 4), (9, "last of all", 5)]
    docs = spark.createDataFrame(rows, "doc_id int, text string, near_next int")
    found = lz.near_next_and_edited(docs)
    assert found.columns == COLUMNS and found.schema["doc_id"].dataType.simpleString() == "int"
    expected = brute_force([row[:2] for row in rows])
    assert sorted(map(tuple, found.collect()), key=str) == sorted(expected, key=str)
    other = lz.fingerprint_texts(docs).collect()
    assert sorted((row.doc_id, row.fingerprint) for row in other if row.doc_id) == sorted((row[0], row[3]) for row in expected if row[0])


def test_one_document_and_none(spark):
    one = spark.createDataFrame([(1, "abcdefgh")], "doc_id bigint, text string")
    assert [tuple(row) for row in lz.near_next_and_edited(one).collect()] == brute_force([(1, "abcdefgh")])
    assert lz.near_next_and_edited(one.limit(0)).count() == 0


@pytest.mark.parametrize("text", ["a" * 5_000_000, " \n" * 1_000_000, "".join(random.Random(1).choices("abc Ж", k=1_000_000))])
def test_very_long_texts(text):
    hasher = lz.Hasher()
    own, edited = lz.fingerprints(hasher, text[:-1000], text[-1000:], "other")
    assert own == lz.fingerprints(hasher, "", text)[0] and lz.likeness(own, edited) > 0.7
