import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from marginfold.llm import alignment as al
from marginfold.llm.queries import op11_alignment, table

FOLDER = "/root/testdata/sf0.001"
A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
ODD = [*"ab  \n\t.,'s't1é中\x1c\x85\xa0　▁\x00", "<0x0A>", "<|endoftext|>", "<s>", "  ", " x", "\U000323b0", "🙂"]


class Libraries:
    """Both libraries on whole texts, and token bytes by the contract's rules."""

    def __init__(self):
        self.a = Tokenizer.from_file(A)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=B)
        self.a_names = {number: name for name, number in self.a.get_vocab().items()}
        printed = [*range(33, 127), *range(161, 173), *range(174, 256)]
        others = [byte for byte in range(256) if byte not in printed]
        self.byte_of = {chr(byte): byte for byte in printed} | {chr(256 + place): byte for place, byte in enumerate(others)}

    def a_bytes(self, number):
        return bytes(self.byte_of[letter] for letter in self.a_names[number])

    def b_bytes(self, number):
        piece = self.b.id_to_piece(number)
        return bytes([int(piece[1:-1], 16)]) if self.b.is_byte(number) else piece.replace("▁", " ").encode()

    def __call__(self, text):
        data = (" " + (text or "")).encode()
        a, b = self.a.encode(data.decode(), add_special_tokens=False).ids, self.b.encode(text or "")
        spelled = [b"".join(map(side, ids)) == data for side, ids in ((self.a_bytes, a), (self.b_bytes, b))]
        return (a, b) if text and all(spelled) else ([], [])


@pytest.fixture(scope="module")
def libraries():
    return Libraries()


@pytest.fixture(scope="module")
def sides():
    return al.Sides(A, B)


def groups_of(libraries, a, b):
    """Groups of ids by walking both lists, and the links."""
    groups, links, i, j = [], [], 0, 0
    while i < len(a):
        left, right = [a[i]], [b[j]]
        n_left, n_right = len(libraries.a_bytes(a[i])), len(libraries.b_bytes(b[j]))
        while n_left != n_right:
            if n_left < n_right:
                i += 1
                left.append(a[i])
                n_left += len(libraries.a_bytes(a[i]))
            else:
                j += 1
                right.append(b[j])
                n_right += len(libraries.b_bytes(b[j]))
        groups.append((left, right))
        links.append((a[i], b[j]))
        i, j = i + 1, j + 1
    return groups, links


def brute_force(libraries, rows):
    """One row per document from (doc_id, text)."""
    aligned = []
    for doc_id, text in rows:
        a, b = libraries(text)
        aligned.append((doc_id, a, b, *groups_of(libraries, a, b)))
    counts = Counter(link for *_, links in aligned for link in links)
    highest = {}
    for (_, b), n in counts.items():
        highest[b] = max(highest.get(b, 0), n)
    found = []
    for doc_id, a, b, groups, links in aligned:
        line = ";".join("|".join(",".join(map(str, side)) for side in group) for group in groups)
        digest = hashlib.sha256(line.encode()).hexdigest() if a else ""
        n_best = sum(counts[link] == highest[link[1]] for link in links)
        found.append((doc_id, len(a), len(b), len(groups), len(links), n_best, sum(map(counts.get, links)), digest))
    return found


def test_pieces_of_any_size_find_the_common_ends():
    rng = np.random.default_rng(1)
    for _ in range(2000):
        a, b = (np.unique(rng.integers(1, 60, rng.integers(0, 40))) for _ in range(2))
        in_a, in_b = al.common_ends(a, b, int(rng.integers(1, 9)))
        assert a[in_a].tolist() == sorted(set(a) & set(b)) == b[in_b].tolist()


def test_diagonals_cut_the_merge_into_equal_work():
    rng = np.random.default_rng(2)
    for _ in range(500):
        a, b = (np.unique(rng.integers(1, 60, rng.integers(0, 40))) for _ in range(2))
        merged = sorted([(end, 0) for end in a] + [(end, 1) for end in b])
        diagonals = np.arange(len(merged) + 1)
        cuts = al.diagonal_cuts(a, b, diagonals)
        assert cuts.tolist() == [sum(side == 0 for _, side in merged[:d]) for d in diagonals]


def test_encoding_in_parts_equals_both_libraries(libraries, sides, monkeypatch):
    monkeypatch.setattr(al, "_LONG_TEXT", 7)
    rng = random.Random(3)
    for _ in range(4000):
        text = "".join(rng.choices(ODD, k=rng.randint(0, 30)))
        assert tuple(ids.tolist() for ids in sides.encode(text)) == tuple(libraries(text)), text


@pytest.mark.parametrize("text", ["a" * 2_000_000, "x" + " \n" * 1_000_000 + "y", " " * 2_000_000, "é" * 500_000])
def test_very_long_texts_are_spelled_by_both_sides(sides, text):
    a, b = sides.encode(text)
    in_a, in_b = al.common_ends(np.cumsum(sides.a_lengths[a]), np.cumsum(sides.b_lengths[b]))
    for ids, tokens, last in ((a, sides.a_bytes, in_a), (b, sides.b_bytes, in_b)):
        assert b"".join(map(tokens.__getitem__, ids.tolist())) == (" " + text).encode()
        assert last[-1] == len(ids) - 1


def test_the_query_equals_brute_force(spark, libraries):
    rows = [tuple(row) for row in table(spark, FOLDER, "documents").select("doc_id", "text").collect()]
    found = op11_alignment(spark, FOLDER)
    assert found.columns == COLUMNS
    assert sorted(map(tuple, found.collect())) == sorted(brute_force(libraries, rows))


def test_blocks_change_nothing_and_odd_rows_are_defined(spark, libraries, monkeypatch):
    monkeypatch.setattr(al, "BLOCK_BYTES", 200)
    rng = random.Random(4)
    rows = [(number, "".join(rng.choices(ODD + ["the cat", " sat"] * 8, k=rng.randint(0, 40)))) for number in range(150)]
    rows += [(1, None), (None, "the cat sat"), (3, ""), (3, ""), *[(9, "the cat sat")] * 60, (10, "under▁score"), (11, "the cat " * 3000)]
    frame = spark.createDataFrame([(*row, "clash") for row in rows], "doc_id int, text string, n_a string")
    found = al.alignment_counts(frame.repartition(4), A, B)
    assert found.schema["doc_id"].dataType.simpleString() == "int"
    assert sorted(map(tuple, found.collect()), key=str) == sorted(brute_force(libraries, rows), key=str)
    none = al.alignment_counts(frame.limit(0), A, B)
    assert none.columns == COLUMNS and none.count() == 0


def test_groups_as_rows(spark, libraries):
    rows = [(1, "One  two\nthree été 中文 <|endoftext|>"), (2, None), (3, "▁"), (4, "again and again")]
    found = al.align_texts(spark.createDataFrame(rows, "doc_id long, text string"), A, B).collect()
    for (doc_id, text), row in zip(rows, sorted(found, key=lambda row: row.doc_id)):
        a, b = libraries(text)
        assert (row.doc_id, row.a_ids, row.b_ids) == (doc_id, a, b)
        assert [(one.n_a, one.n_b) for one in row.groups] == [(len(x), len(y)) for x, y in groups_of(libraries, a, b)[0]]
