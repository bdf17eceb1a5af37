"""Token counts of texts by a tokenizer compiled to a finite-state transducer, without making the tokens.

Byte-pair encoding has a property that makes it finite-state: the tokens of a text without its last
token are the tokens of the text before it, and a sequence of tokens is the encoding of its text
exactly if each pair of neighbours is the encoding of the pair. So the last token after each byte follows
from the last tokens at the places where it could begin, none of which is farther back than the longest
suffix that begins some token. That suffix, with the last tokens and relative counts at its places, is
a state; reading a byte leads to the next state and changes the count by an amount that depends on the
state and the byte alone. States and transitions are made when first met.

A text is cut into chunks anywhere, a short one being one chunk. A chunk's map leads from the state in which
it is entered to the state in which it leaves and the count between. Between the first and the last
place where pieces certainly end the count does not depend on the state; before and after, the map keeps
the text, and for letters the state and count that the transducer reaches from its start. From another state
the same letters are read only until both readings are in one state, mostly some bytes; what follows is
the same. So maps compose without reading a chunk again, and chunks are joined by a prefix scan.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F, types as T

from marginfold.llm.token_files import MARKS, byte_letters, pieces_of
from marginfold.llm.worker import kept

CHUNK_CHARS = 1 << 16
TOKEN_LIMIT = 1024
_MOST_TRANSITIONS = 400_000
_MOST_PIECES = 500_000
_MOST_PAIRS = 300_000
# The byte-level pre-splitter's pattern, a fixed value of the format.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


# A state of the transducer, and the tokens counted up to it.
Exit = tuple[dict, int]
# Letters that are encoded at once where two readings go side by side.
_LOCKSTEP_CHARS = 64


def _is_letters(text: str) -> bool:
    """Whether a text is one match of letters, with or without a space before them."""
    return text.isalpha() or text[:1] == " " and text[1:].isalpha()


@dataclass(frozen=True)
class Vocabulary:
    """Byte-level BPE: tokens by their bytes, and the token that each mergeable pair makes, by rank."""

    tokens: dict[bytes, int]
    merges: dict[tuple[int, int], tuple[int, int]]
    special: tuple[str, ...]

    @classmethod
    def read(cls, path: str) -> Vocabulary:
        with open(path, encoding="utf-8") as file:
            content = json.load(file)
        byte_of = {chr(letter): byte for byte, letter in byte_letters().items()}

        def as_bytes(letters: str) -> bytes:
            return bytes(byte_of[letter] for letter in letters)

        special = tuple(token["content"] for token in content["added_tokens"])
        ids = {token: number for token, number in content["model"]["vocab"].items() if token not in special}
        merges = {}
        for rank, pair in enumerate(content["model"]["merges"]):
            left, right = pair if isinstance(pair, list) else pair.split(" ")
            merges[ids[left], ids[right]] = (rank, ids[left + right])
        return cls({as_bytes(token): number for token, number in ids.items()}, merges, special)

    def encode(self, data: bytes) -> list[int]:
        """Tokens of one piece by the definition: the pair of least rank is merged, leftmost first."""
        ids = [self.tokens[data[i : i + 1]] for i in range(len(data))]
        while len(ids) > 1:
            best = min((self.merges[pair] for pair in zip(ids, ids[1:]) if pair in self.merges), default=None)
            if best is None:
                break
            merged, i = [], 0
            while i < len(ids):
                if i + 1 < len(ids) and self.merges.get((ids[i], ids[i + 1])) == best:
                    merged.append(best[1])
                    i += 2
                else:
                    merged.append(ids[i])
                    i += 1
            ids = merged
        return ids


class Transducer:
    """The lazily compiled transducer of one vocabulary: counts the tokens of a piece byte by byte."""

    def __init__(self, vocabulary: Vocabulary) -> None:
        self.vocabulary = vocabulary
        self.bytes_of = {number: token for token, number in vocabulary.tokens.items()}
        self.beginnings = {token[:n] for token in vocabulary.tokens for n in range(1, len(token) + 1)}
        self._pairs: dict[tuple[int, int], bool] = {}
        self._clear()

    def _clear(self) -> None:
        # A state is a row of transitions by byte, with what it stands for under -1: the suffix, and for
        # each place in it where a token may yet begin the offset, the last token and the relative count.
        start = (b"", ((0, None, 0),))
        self.start: dict = {-1: start}
        self._states = {start: self.start}
        self._n_transitions = 0

    def _bound(self) -> None:
        if self._n_transitions > _MOST_TRANSITIONS:
            self._clear()

    def _follows(self, before: int | None, token: int) -> bool:
        """Whether the token, alone or behind the one before it, is what its bytes are encoded as."""
        pair = (-1 if before is None else before, token)
        known = self._pairs.get(pair)
        if known is None:
            if len(self._pairs) > _MOST_PAIRS:
                self._pairs.clear()
            expected = [token] if before is None else [before, token]
            data = b"".join(self.bytes_of[t] for t in expected)
            known = self._pairs[pair] = self.vocabulary.encode(data) == expected
        return known

    def _compile(self, state: dict, byte: int) -> tuple[dict, int]:
        """The transition of a state by a byte: next state, and by how much the count changes."""
        suffix, places = state[-1]
        grown = suffix + bytes((byte,))
        tokens, beginnings = self.vocabulary.tokens, self.beginnings
        for offset, last, count in places:
            token = tokens.get(grown[offset:])
            if token is not None and self._follows(last, token):
                change = count + 1
                break
        else:
            raise ValueError("the vocabulary lacks a byte")
        still = [place for place in places if grown[place[0] :] in beginnings]
        cut = still[0][0] if still else len(grown)
        moved = [(offset - cut, last, count - change) for offset, last, count in still]
        key = (grown[cut:], (*moved, (len(grown) - cut, token, 0)))
        target = self._states.setdefault(key, {-1: key})
        step = state[byte] = (target, change)
        self._n_transitions += 1
        return step

    def read(self, entered: Exit, text: str) -> Exit:
        """The state behind a text and the count up to there, from those before the text."""
        state, total = entered
        for byte in text.encode():
            step = state.get(byte) or self._compile(state, byte)
            state = step[0]
            total += step[1]
        return state, total

    def exit(self, text: str) -> Exit:
        """Where a text leads from the start: a state of its own, apart from the table of transitions."""
        self._bound()
        state, total = self.read((self.start, 0), text)
        return {-1: state[-1]}, total

    def follow(self, entered: Exit, text: str, own: Exit) -> Exit:
        """As ``read``, where the text is known to lead from the start to ``own``.

        Both readings go on until they are in one state. A state fixes all that follows, so the rest of
        the text adds what it adds to the reading from the start.
        """
        (state, total), (alike, apart) = entered, (self.start, 0)
        for begin in range(0, len(text), _LOCKSTEP_CHARS):
            for byte in text[begin : begin + _LOCKSTEP_CHARS].encode():
                step = state.get(byte) or self._compile(state, byte)
                other = alike.get(byte) or self._compile(alike, byte)
                state, alike = step[0], other[0]
                total += step[1]
                apart += other[1]
                if state[-1] == alike[-1]:
                    return own[0], total + own[1] - apart
        return state, total

    def count(self, piece: bytes) -> int:
        """The number of tokens of a piece of the pre-splitter."""
        self._bound()
        state, total = self.start, 0
        for byte in piece:
            step = state.get(byte) or self._compile(state, byte)
            state = step[0]
            total += step[1]
        return total


@dataclass(frozen=True)
class ChunkMap:
    """What a chunk does to the open piece that it is entered with.

    ``head`` goes to the open piece. With ``tail`` None the chunk has no certain end of a piece and
    leaves the piece open; else it ends there, ``inner`` tokens follow, and ``tail`` is left open.
    Where head or tail is one match of letters, its exit is the state that it leads to from the start.
    """

    head: str
    inner: int = 0
    tail: str | None = None
    head_exit: Exit | None = field(default=None, compare=False)
    tail_exit: Exit | None = field(default=None, compare=False)


class Counter:
    """Counts the tokens of whole texts; counts of frequent pieces are kept in a table of bounded size."""

    def __init__(self, vocabulary: Vocabulary) -> None:
        self.transducer = Transducer(vocabulary)
        self.split = regex.compile(PATTERN).findall
        self.special = regex.compile("|".join(map(regex.escape, vocabulary.special))) if vocabulary.special else None
        self.known: dict[str, int] = {}

    def _piece(self, piece: str) -> int:
        """The tokens of a text between certain ends of pieces."""
        if _is_letters(piece):
            return self.transducer.count(piece.encode())
        word = piece.rstrip(MARKS)
        if word and word != piece and _is_letters(word):
            # Marks behind a word are a match of their own.
            return sum(self._pieces([part]) for part in (word, piece[len(word) :]))
        if self.special and self.special.search(piece):
            parts = self.special.split(piece)
            return len(parts) - 1 + sum(self._piece(part) for part in parts if part)
        return sum(self.transducer.count(part.encode()) for part in self.split(piece))

    def _pieces(self, pieces: list[str]) -> int:
        try:
            return sum(map(self.known.__getitem__, pieces))
        except KeyError:
            known = self.known
            for piece in set(pieces).difference(known):
                known[piece] = self._piece(piece)
            return sum(map(self.known.__getitem__, pieces))

    def _exit(self, text: str) -> Exit | None:
        return self.transducer.exit(text) if _is_letters(text) else None

    def _joined_exit(self, left: str, left_exit: Exit | None, right: str, right_exit: Exit | None) -> Exit | None:
        """The exit of two texts in a row, where they are one match of letters."""
        if not left or not right:
            return right_exit if right else left_exit
        if left_exit and right_exit and right.isalpha():
            return self.transducer.follow(left_exit, right, right_exit)
        # A space at a chunk's end and letters behind it.
        return self._exit(left + right) if left == " " else None

    def _open_count(self, text: str, read: Exit | None) -> int:
        """The tokens of an open piece that ends."""
        return read[1] if read else self._pieces(pieces_of(text))

    def _seam_count(self, left: str, left_exit: Exit | None, right: str, right_exit: Exit | None) -> int:
        """The tokens of a left open piece and the head that ends it."""
        joined = self._joined_exit(left, left_exit, right, right_exit)
        if joined or not left_exit or not right[:1].isalpha():
            return self._open_count(left + right, joined)
        # The match of letters ends at the first other character; what follows is matched afresh.
        letters = next((at for at, char in enumerate(right) if not char.isalpha()), len(right))
        return self.transducer.read(left_exit, right[:letters])[1] + self._pieces(pieces_of(right[letters:]))

    def chunk_map(self, chunk: str) -> ChunkMap:
        pieces = pieces_of(chunk)
        # Whether the chunk's own ends are ends of pieces depends on its neighbours.
        if len(pieces) < 3:
            return ChunkMap(chunk, head_exit=self._exit(chunk))
        head, tail = pieces[0], pieces[-1]
        return ChunkMap(head, self._pieces(pieces[1:-1]), tail, self._exit(head), self._exit(tail))

    def compose(self, left: ChunkMap, right: ChunkMap) -> ChunkMap:
        """The map of two chunks in a row."""
        if left.tail is None:
            head_exit = self._joined_exit(left.head, left.head_exit, right.head, right.head_exit)
            return ChunkMap(left.head + right.head, right.inner, right.tail, head_exit, right.tail_exit)
        seam = (left.tail, left.tail_exit, right.head, right.head_exit)
        if right.tail is None:
            return ChunkMap(left.head, left.inner, left.tail + right.head, left.head_exit, self._joined_exit(*seam))
        inner = left.inner + self._seam_count(*seam) + right.inner
        return ChunkMap(left.head, inner, right.tail, left.head_exit, right.tail_exit)

    def scan(self, maps: list[ChunkMap]) -> ChunkMap:
        """All maps composed, neighbours first: the last element of their prefix scan."""
        while len(maps) > 1:
            maps = [self.compose(*maps[i : i + 2]) if i + 1 < len(maps) else maps[i] for i in range(0, len(maps), 2)]
        return maps[0] if maps else ChunkMap("")

    def count(self, text: str, chunk_chars: int = CHUNK_CHARS) -> int:
        if len(self.known) > _MOST_PIECES:
            self.known.clear()
        whole = self.scan([self.chunk_map(text[i : i + chunk_chars]) for i in range(0, len(text), chunk_chars)])
        if whole.tail is None:
            return self._open_count(whole.head, whole.head_exit)
        return self._open_count(whole.head, whole.head_exit) + whole.inner + self._open_count(whole.tail, whole.tail_exit)


def _count_batches(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = kept(f"counter of {path}", lambda: Counter(Vocabulary.read(path)))
        for batch in batches:
            counts = [counter.count(value.as_py() or "") for value in batch.column("text")]
            yield pa.record_batch([batch.column("doc_id"), batch.column("n_bytes"), pa.array(counts, pa.int64())], names=["doc_id", "n_bytes", "n_tokens"])

    return run


def count_tokens(docs: DataFrame, path: str, limit: int = TOKEN_LIMIT) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) of every whole text, by a byte-level BPE file.

    Counts are those of the tokenizers library without added special tokens; a special string inside
    a text is one token. A null text is empty, repeated rows repeat, null ids stay; other columns
    are ignored.
    """
    schema = T.StructType([docs.schema["doc_id"], T.StructField("n_bytes", T.LongType()), T.StructField("n_tokens", T.LongType())])
    text = F.coalesce("text", F.lit(""))
    sized = docs.select("doc_id", F.octet_length(text).cast("bigint").alias("n_bytes"), text.alias("text"))
    counted = sized.mapInArrow(_count_batches(path), schema)
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
